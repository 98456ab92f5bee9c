"""Topics of keyed messages in landed segments, as a source and sink of Spark.

A topic is a folder.  A write leaves Parquet segments, one or more per task and topic partition, and one manifest in
``_log`` that gives each of them its offsets; the manifest is what makes them part of the topic, so readers see a write
whole or not at all.  A manifest also holds where every partition ends and the last batch of every writer:

* a streaming query that repeats a batch after a failure finds it committed, and its new segments are dropped;
* readers start at the earliest message, or where their ``group`` has committed, and then at their checkpoint's offsets.

Messages with equal keys go to one partition.  One writer at a time may write to a topic; ``writer`` names a query along
with its checkpoint.  Works on every store that ``pyarrow.fs`` opens (local folders, hdfs, s3, gs).
"""

from __future__ import annotations

import json
import os
import re
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql.datasource import (
    DataSource,
    DataSourceReader,
    DataSourceStreamReader,
    DataSourceStreamWriter,
    DataSourceWriter,
    InputPartition,
    WriterCommitMessage,
)
from pyspark.sql.streaming import StreamingQuery

SCHEMA = "partition int, offset long, key string, value string"
PARTITIONS = 3
#: Messages that a task holds before it closes a segment.
SEGMENT_ROWS = 50_000


class _Topic:
    def __init__(self, path: str):
        local = re.sub("^file:/+", "/", path)
        self.fs, self.root = fs.FileSystem.from_uri(local if "://" in local else f"file://{os.path.abspath(local)}")
        self.known: dict[str, dict] = {}

    def names(self) -> list[str]:
        found = self.fs.get_file_info(fs.FileSelector(f"{self.root}/_log", allow_not_found=True))
        return sorted(f.base_name for f in found if f.base_name.endswith(".json"))

    def manifest(self, name: str) -> dict:
        if name not in self.known:
            self.known[name] = self.load(f"_log/{name}")
        return self.known[name]

    def last(self) -> dict:
        names = self.names()
        return self.manifest(names[-1]) if names else {"number": -1, "ends": {}, "writers": {}, "segments": []}

    def load(self, name: str) -> dict | None:
        try:
            with self.fs.open_input_stream(f"{self.root}/{name}") as file:
                return json.loads(file.read())
        except FileNotFoundError:
            return None

    def store(self, name: str, content: dict) -> None:
        """Whole or not at all: written aside, then moved into place."""
        path = f"{self.root}/{name}"
        self.fs.create_dir(path.rsplit("/", 1)[0])
        with self.fs.open_output_stream(f"{path}.part") as file:
            file.write(json.dumps(content).encode())
        self.fs.move(f"{path}.part", path)

    def between(self, start: dict, end: dict) -> list[Stretch]:
        """The parts of segments with offsets from ``start`` up to ``end``, newest manifests first."""
        found: list[Stretch] = []
        for name in reversed(self.names()):
            content = self.manifest(name)
            for s in content["segments"]:
                first = max(s["first"], start.get(s["partition"], 0))
                last = min(s["first"] + s["count"], end.get(s["partition"], 0))
                if first < last:
                    found.append(Stretch(int(s["partition"]), s["file"], s["first"], first, last))
            if all(content["starts"].get(p, 0) <= start.get(p, 0) for p in content["ends"]):
                break
        return found[::-1]


@dataclass
class Stretch(InputPartition):
    partition: int
    file: str
    base: int
    first: int
    last: int


@dataclass
class Written(WriterCommitMessage):
    segments: list


def _messages(path: str, stretch: Stretch) -> Iterator[pa.RecordBatch]:
    topic = _Topic(path)
    skip = stretch.first - stretch.base
    with topic.fs.open_input_file(f"{topic.root}/{stretch.file}") as file:
        table = pq.read_table(file).slice(skip, stretch.last - stretch.first)
    for b in table.to_batches():
        offsets = pa.array(range(stretch.first, stretch.first + b.num_rows), pa.int64())
        stretch.first += b.num_rows
        place = pa.array([stretch.partition] * b.num_rows, pa.int32())
        columns = [place, offsets, b.column("key"), b.column("value")]
        yield pa.RecordBatch.from_arrays(columns, ["partition", "offset", "key", "value"])


class _Reader(DataSourceReader):
    def __init__(self, options: dict):
        self.path = options["path"]

    def partitions(self) -> list[Stretch]:
        topic = _Topic(self.path)
        return topic.between({}, topic.last()["ends"])

    def read(self, partition: Stretch) -> Iterator[pa.RecordBatch]:
        return _messages(self.path, partition) if partition is not None else iter(())


class _StreamReader(DataSourceStreamReader):
    def __init__(self, options: dict):
        self.path, self.group = options["path"], options.get("group")
        self.starting = options.get("starting", "earliest")
        self.topic = _Topic(self.path)

    def initialOffset(self) -> dict:  # noqa: N802
        committed = self.topic.load(f"_groups/{self.group}.json") if self.group else None
        if committed is not None:
            return committed
        return dict(self.topic.last()["ends"]) if self.starting == "latest" else {}

    def latestOffset(self) -> dict:  # noqa: N802
        return dict(self.topic.last()["ends"])

    def partitions(self, start: dict, end: dict) -> list[Stretch]:
        return self.topic.between(start, end)

    def read(self, partition: Stretch) -> Iterator[pa.RecordBatch]:
        return _messages(self.path, partition)

    def commit(self, end: dict) -> None:
        if self.group:
            self.topic.store(f"_groups/{self.group}.json", end)

    def __getstate__(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if k != "topic"}

    def __setstate__(self, state: dict) -> None:
        self.__dict__.update(state)
        self.topic = _Topic(self.path)


class _Writing:
    def __init__(self, options: dict):
        self.path, self.writer = options["path"], options.get("writer", "main")
        self.partitions = int(options.get("partitions", PARTITIONS))

    def write(self, iterator: Iterator[Row]) -> Written:
        topic, made = _Topic(self.path), []
        topic.fs.create_dir(f"{topic.root}/segments")
        held: dict[int, list[tuple]] = {}

        def close(partition: int) -> None:
            rows = held.pop(partition)
            name = f"segments/{uuid.uuid4().hex}.parquet"
            columns = [pa.array([r[c] for r in rows], pa.string()) for c in (0, 1)]
            table = pa.table(columns, ["key", "value"])
            with topic.fs.open_output_stream(f"{topic.root}/{name}") as file:
                pq.write_table(table, file)
            made.append({"partition": str(partition), "count": len(rows), "file": name})

        for row in iterator:
            partition = zlib.crc32((row["key"] or "").encode()) % self.partitions
            rows = held.setdefault(partition, [])
            rows.append((row["key"], row["value"]))
            if len(rows) >= SEGMENT_ROWS:
                close(partition)
        for partition in sorted(held):
            close(partition)
        return Written(made)

    def finish(self, messages: list[Written | None], batch_id: int | None) -> None:
        topic = _Topic(self.path)
        last = topic.last()
        if batch_id is not None and last["writers"].get(self.writer, -1) >= batch_id:
            self.drop(messages)  # a repeated batch
            return
        ends, segments = dict(last["ends"]), []
        for segment in (s for m in messages if m is not None for s in m.segments):
            first = ends.get(segment["partition"], 0)
            ends[segment["partition"]] = first + segment["count"]
            segments.append({**segment, "first": first})
        writers = last["writers"] | ({self.writer: batch_id} if batch_id is not None else {})
        number = last["number"] + 1
        content = {"number": number, "starts": last["ends"], "ends": ends, "writers": writers, "segments": segments}
        topic.store(f"_log/{number:020d}.json", content)

    def drop(self, messages: list[Written | None]) -> None:
        topic = _Topic(self.path)
        for segment in (s for m in messages if m is not None for s in m.segments):
            topic.fs.delete_file(f"{topic.root}/{segment['file']}")


class _Writer(_Writing, DataSourceWriter):
    def commit(self, messages) -> None:
        self.finish(messages, None)

    def abort(self, messages) -> None:
        self.drop(messages)


class _StreamWriter(_Writing, DataSourceStreamWriter):
    def commit(self, messages, batchId: int) -> None:  # noqa: N803
        self.finish(messages, batchId)

    def abort(self, messages, batchId: int) -> None:  # noqa: N803
        self.drop(messages)


class SegmentSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "segments"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return _Reader(self.options)

    def streamReader(self, schema) -> DataSourceStreamReader:  # noqa: N802
        return _StreamReader(self.options)

    def writer(self, schema, overwrite: bool) -> DataSourceWriter:
        if overwrite:
            raise ValueError("a topic can only be added to")
        return _Writer(self.options)

    def streamWriter(self, schema, overwrite: bool) -> DataSourceStreamWriter:  # noqa: N802
        return _StreamWriter(self.options)


def _registered(spark: SparkSession) -> SparkSession:
    spark.dataSource.register(SegmentSource)
    return spark


def read_segments(spark: SparkSession, path: str) -> DataFrame:
    """All messages of a topic: partition, offset, key, value."""
    return _registered(spark).read.format("segments").load(path)


def read_segment_stream(
    spark: SparkSession, path: str, group: str | None = None, starting: str = "earliest"
) -> DataFrame:
    """The messages of a topic as a stream, from the checkpoint, else from the group's committed offsets, else from
    ``starting`` (earliest or latest)."""
    reader = _registered(spark).readStream.format("segments").option("starting", starting)
    return (reader.option("group", group) if group else reader).load(path)


def commit_group(query: StreamingQuery, path: str, group: str) -> None:
    """Commit for ``group`` what a query that has ended read from the topic.

    While a query runs, the group follows one batch behind, since Spark reports a batch as done when it plans the next.
    """
    progress = json.loads(query.lastProgress.json) if query.lastProgress else {"sources": []}
    for source in progress["sources"]:
        if source["endOffset"]:
            _Topic(path).store(f"_groups/{group}.json", source["endOffset"])


def append_segments(messages: DataFrame, path: str, partitions: int = PARTITIONS) -> None:
    """Add a batch of messages (key, value) to a topic."""
    _registered(messages.sparkSession)
    rows = messages.select("key", "value")
    rows.write.format("segments").mode("append").option("partitions", partitions).save(path)


def start_segment_sink(
    messages: DataFrame,
    path: str,
    checkpoint: str,
    writer: str = "main",
    partitions: int = PARTITIONS,
    once: bool = False,
) -> StreamingQuery:
    """A stream of messages (key, value) into a topic, each batch once."""
    _registered(messages.sparkSession)
    sink = (
        messages.select("key", "value").writeStream.format("segments").outputMode("append")
        .option("partitions", partitions).option("writer", writer).option("checkpointLocation", checkpoint)
    )
    return (sink.trigger(availableNow=True) if once else sink).start(path)
