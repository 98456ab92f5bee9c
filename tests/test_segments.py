import glob
import os

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from zephyrine.sources import segments
from zephyrine.sources.segments import append_segments, commit_group, read_segment_stream, read_segments, start_segment_sink


def produce(spark, topic, first, last, parts=3):
    made = spark.range(first, last, numPartitions=parts).selectExpr(
        "concat('k', id % 7) key", "cast(id as string) value"
    )
    append_segments(made, topic)


def consume(spark, folder, **options):
    stream = read_segment_stream(spark, f"{folder}/topic", **options)
    query = start_segment_sink(
        stream.withColumn("value", F.concat("value", F.lit("!"))), f"{folder}/out", f"{folder}/checkpoint", once=True
    )
    query.awaitTermination()
    return rows(read_segments(spark, f"{folder}/out"), "value")


def test_offsets_are_dense_and_keys_stay_together(spark, folder):
    for first in (0, 50, 100):
        produce(spark, folder, first, first + 50)
    found = read_segments(spark, folder)
    assert rows(found, "value") == sorted((str(n),) for n in range(150))
    counts = F.count("*").alias("n"), F.max("offset").alias("top"), F.countDistinct("offset").alias("d")
    dense = found.groupBy("partition").agg(*counts)
    assert all(r["n"] == r["d"] == r["top"] + 1 for r in dense.collect())
    assert found.groupBy("key").agg(F.countDistinct("partition").alias("n")).filter("n > 1").isEmpty()


def test_a_stopped_stream_resumes_and_repeats_nothing(spark, folder):
    topic = f"{folder}/topic"
    produce(spark, topic, 0, 100)
    assert consume(spark, folder) == sorted((f"{n}!",) for n in range(100))
    produce(spark, topic, 100, 160)
    produce(spark, topic, 160, 200)
    assert consume(spark, folder) == sorted((f"{n}!",) for n in range(200))
    # A failure after the sink's commit and before the query's: the batch is run again.
    last = max(glob.glob(f"{folder}/checkpoint/commits/[0-9]*"), key=lambda p: int(os.path.basename(p)))
    os.remove(last)
    os.remove(f"{folder}/checkpoint/commits/.{os.path.basename(last)}.crc")
    staged = len(os.listdir(f"{folder}/out/segments"))
    assert consume(spark, folder) == sorted((f"{n}!",) for n in range(200))
    assert len(os.listdir(f"{folder}/out/segments")) == staged


def test_groups_commit_their_offsets(spark, folder):
    topic = f"{folder}/topic"
    produce(spark, topic, 0, 40)

    def seen(name, **options):
        stream = read_segment_stream(spark, topic, **options)
        out = f"{folder}/{name}"
        query = start_segment_sink(stream, out, f"{out}-checkpoint", once=True)
        query.awaitTermination()
        if "group" in options:
            commit_group(query, topic, options["group"])
        return read_segments(spark, out).count()

    assert seen("a", group="g") == 40
    produce(spark, topic, 40, 60)
    assert seen("b", group="g") == 20
    assert seen("c", group="g") == 0
    assert seen("d", group="other") == 60
    assert seen("e", starting="latest") == 0


def test_an_aborted_write_leaves_no_message(spark, folder):
    produce(spark, folder, 0, 10)
    broken = spark.range(30).select(
        F.lit("k").alias("key"),
        F.when(F.col("id") == 29, F.raise_error(F.lit("broken"))).otherwise(F.col("id").cast("string")).alias("value"),
    )
    with pytest.raises(Exception, match="broken"):
        append_segments(broken, folder)
    assert read_segments(spark, folder).count() == 10
    produce(spark, folder, 10, 20)
    assert read_segments(spark, folder).count() == 20


def test_an_empty_topic(spark, folder):
    assert read_segments(spark, f"{folder}/none").collect() == []
    assert consume(spark, folder) == []


def test_large_partitions_close_segments(folder):
    writing = segments._Writing({"path": folder, "partitions": "1"})
    made = writing.write(iter({"key": "k", "value": str(n)} for n in range(segments.SEGMENT_ROWS + 5)))
    assert [s["count"] for s in made.segments] == [segments.SEGMENT_ROWS, 5]
    writing.finish([made, None], 3)
    writing.finish([writing.write(iter([{"key": None, "value": None}]))], 3)  # a repeated batch
    assert segments._Topic(folder).last()["ends"] == {"0": segments.SEGMENT_ROWS + 5}
