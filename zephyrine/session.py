"""Session settings the operators rely on, and where durable intermediate data goes."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    # Timestamps are instants; every date and hour in the library is a UTC one.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Rows of many like columns take many times their compressed, shuffled bytes in a task that sorts them.
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8m",
    # Table writers replace only the date partitions they produce.
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # Files keep statistics of timestamps, so that filters on time skip row groups.
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
}


def configure(spark: SparkSession) -> SparkSession:
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def keep_state_in_rocksdb(spark: SparkSession) -> None:
    """Streaming state outside the heap; operators with timers need this store."""
    spark.conf.set(
        "spark.sql.streaming.stateStore.providerClass",
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    )


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder; a throw-away one only in local mode without a setting."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    made = tempfile.mkdtemp(prefix="zephyrine-")
    atexit.register(shutil.rmtree, made, ignore_errors=True)
    spark.conf.set("spark.checkpoint.dir", made)
    return made


_scratch: list[str] = []


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder."""
    path = f"{shared_dir(spark)}/zephyrine/{name}-{uuid.uuid4().hex}"
    _scratch.append(path)
    return path


def clean_scratch(spark: SparkSession) -> int:
    """Delete the scratch folders this process made; call it when their results are no longer read."""
    made = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    settings = spark.sparkContext._jsc.hadoopConfiguration()
    removed = 0
    while _scratch:
        path = made(_scratch.pop())
        removed += path.getFileSystem(settings).delete(path, True)
    return removed


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: the result survives the loss of any executor."""
    spark = df.sparkSession
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_dir(spark))
    return df.checkpoint(eager=True)
