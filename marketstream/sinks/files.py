"""JSON lines and batch-numbered tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from marketstream.sinks import triggered


def append_json_lines(df: DataFrame, path: str, checkpoint: str | None = None, trigger: str | None = None) -> StreamingQuery | None:
    """One JSON object per line below ``path``; a table is written at once, a stream as it comes."""
    if not df.isStreaming:
        df.write.mode("append").json(path)
        return None
    writer = df.writeStream.format("json").outputMode("append").option("checkpointLocation", checkpoint)
    return triggered(writer, trigger).start(path)


def write_batch(df: DataFrame, path: str, batch_id: int) -> None:
    """One micro-batch as its own folder. Running the batch again replaces the folder, so nothing is doubled."""
    df.write.mode("overwrite").parquet(batch_folder(path, batch_id))


def batch_folder(path: str, batch_id: int) -> str:
    return f"{path}/batch_id={batch_id}"
