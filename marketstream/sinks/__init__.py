"""Writers: keyed topics, JSON lines, batch-numbered tables."""

from pyspark.sql.streaming import DataStreamWriter


def triggered(writer: DataStreamWriter, trigger: str | None) -> DataStreamWriter:
    """A processing-time trigger such as ``60 seconds``, or everything available once when there is none."""
    return writer.trigger(processingTime=trigger) if trigger else writer.trigger(availableNow=True)
