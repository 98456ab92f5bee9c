"""Message streams.  Kafka needs the spark-sql-kafka package; landed files need nothing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from zephyrine.operators.anomalies import anomaly_messages


def read_raw_stream(
    spark: SparkSession,
    servers: str,
    topic: str = "raw_data",
    starting: str = "earliest",
    **options: str,
) -> DataFrame:
    """Messages with ``value`` as text; the checkpoint of the query keeps the offsets."""
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", starting)
    )
    for name, value in options.items():
        reader = reader.option(name, value)
    return reader.load().selectExpr(
        "cast(key as string) as key",
        "cast(value as string) as value",
        "timestamp as message_time",
        "partition",
        "offset",
    )


def read_landed_stream(
    spark: SparkSession, path: str, files_per_batch: int | None = None
) -> DataFrame:
    """The same messages as lines of landed text files."""
    reader = spark.readStream.format("text")
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(path)


def write_anomaly_stream(
    anomalies: DataFrame, servers: str, checkpoint: str, topic: str = "anomalies"
) -> StreamingQuery:
    return (
        anomaly_messages(anomalies)
        .writeStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("topic", topic)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .start()
    )


def write_anomaly_files(
    anomalies: DataFrame, path: str, checkpoint: str, once: bool = True
) -> StreamingQuery:
    """The anomaly messages as JSON files."""
    writer = (
        anomaly_messages(anomalies)
        .writeStream.format("json")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
    )
    return (writer.trigger(availableNow=True) if once else writer).start()
