"""Session settings and the shared working folder."""

from __future__ import annotations

import os
import tempfile
import uuid
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

# Settable on a running session, so an engine call works on whatever session it is given.
RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.streaming.stateStore.providerClass": ROCKSDB,
}


def build_session(app: str = "marketstream", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the engine's settings; ``conf`` keys use ``__`` for dots."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return prepare(builder.getOrCreate())


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the settings every operator relies on (UTC, RocksDB state).

    Python workers look for the package where the driver found it, unless they are told a place already; on a cluster it is shipped.
    """
    spark.sparkContext.environment.setdefault("PYTHONPATH", ROOT)
    for key, value in RUNTIME_SETTINGS.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A new folder below ``spark.checkpoint.dir``, which all executors can reach.

    Only a local master may fall back to a temporary folder: on a cluster other machines
    could not read it, so a missing setting is an error there.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        root = tempfile.mkdtemp(prefix="marketstream-")
    return f"{root.rstrip('/')}/marketstream/{name}-{uuid.uuid4().hex}"


def is_directory(spark: SparkSession, path: str) -> bool:
    """True when the Parquet table at ``path`` is a folder of files, on whichever file system it names."""
    name = path.rstrip("/").rpartition("/")[2]
    found = spark.read.parquet(path).inputFiles()
    return len(found) != 1 or unquote(found[0].rpartition("/")[2]) != name


def delete_folder(spark: SparkSession, path: str) -> None:
    """Remove a folder the engine wrote itself; a missing one is fine."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hadoop_path, True)


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write a result that several branches of a query read to the shared folder, and continue from there.

    The branches then do not repeat the work behind it, and a lost executor costs no more than its own tasks.
    """
    path = scratch_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
