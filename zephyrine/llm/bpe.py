"""Byte-level BPE encoding and decoding with the tiktoken library and a local rank file.

The rank file (base64 token and rank per line) is read once by the driver and broadcast: its size is
checked against ``max_rank_bytes``.  Every worker builds the encoding once.  Texts are encoded whole, one
Arrow batch at a time, and decoded from their ids to raw bytes, which need not be valid UTF-8 for part of
the ids.

Long texts are cut where the split pattern must end a match, so that the pieces have the ids of the whole:

* between a character that is not white space and one that is.  White space stands only at the start of
  a match that holds anything else, so no match spans such a place, and none looks behind itself;
* a run of white space of ``LONG_RUN`` characters or more is one match but for its last character (all
  of it at the end of the text); the library's matcher overflows its stack on very long ones, so the run
  goes straight to the merges.

Null and empty texts have no ids.  Repeated rows and ids are encoded each for itself, ties do not arise.
Special tokens have no meaning: their strings are ordinary text.  An empty table gives no rows; columns
besides id and text are ignored, whatever their names.  A text without white space is one piece.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: The characters with the property White_Space, which ``\s`` stands for in the split pattern.
WHITE = r"\t-\r \x85\xa0" + "".join(map(chr, (0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)))
#: Characters of a text that go to the library at once.
PIECE = 1 << 16
LONG_RUN = 1 << 12
#: Tokens that are gathered before a batch is handed on.
BATCH_TOKENS = 1 << 21

_SAFE = re.compile(f"(?<=[^{WHITE}])(?=[{WHITE}])")
_RUN = re.compile(f"[{WHITE}]{{{LONG_RUN},}}")


def load_ranks(spark: SparkSession, path: str, max_rank_bytes: int = 64 << 20) -> Broadcast:
    """The rank file of the driver's machine, for all workers."""
    with open(path, "rb") as file:
        content = file.read(max_rank_bytes + 1)
    if len(content) > max_rank_bytes:
        raise ValueError(f"{path} holds more than {max_rank_bytes} bytes")
    return spark.sparkContext.broadcast(content)


@lru_cache(maxsize=4)
def encoding(content: bytes, pattern: str) -> tiktoken.Encoding:
    ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, content.splitlines())}
    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def safe_pieces(text: str) -> Iterator[tuple[str, bool]]:
    """(piece, whether it is one match) in order; the ids of the pieces are the ids of the text."""
    start, end = 0, len(text)
    run = _RUN.search(text) if end > PIECE else None
    while start < end:
        stop = run.start() if run else end
        while stop - start > PIECE:
            cut = _SAFE.search(text, start + PIECE, stop)
            if cut is None:
                break
            yield text[start : cut.start()], False
            start = cut.start()
        if stop > start:
            yield text[start:stop], False
        if run is None:
            return
        start = run.end() - (run.end() < end)
        yield text[run.start() : start], True
        run = _RUN.search(text, run.end())


def encode(coder: tiktoken.Encoding, text: str) -> np.ndarray:
    """The ids of a whole text."""
    if len(text) <= PIECE:
        return np.array(coder.encode_ordinary(text), np.int32)
    made = [
        coder._encode_single_piece(piece) if single else coder.encode_ordinary(piece)
        for piece, single in safe_pieces(text)
    ]
    return np.concatenate([np.array(ids, np.int32) for ids in made])


def decode(coder: tiktoken.Encoding, ids: np.ndarray) -> bytes:
    """The bytes of all ids, a million at a time."""
    return b"".join(coder.decode_bytes(ids[k : k + 1_000_000].tolist()) for k in range(0, len(ids), 1_000_000))


def _lists(parts: list[np.ndarray]) -> pa.ListArray:
    ends = np.cumsum([0, *map(len, parts)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(parts)))


def encode_texts(
    docs: DataFrame, ranks: Broadcast, pattern: str, id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """(key_id, ids) per row of ``docs``; ``ids`` is an array of int."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoding(ranks.value, pattern)
        for b in batches:
            first, held, parts = 0, 0, []
            for k, body in enumerate(b.column("body")):
                parts.append(encode(coder, body.as_py() or ""))
                held += len(parts[-1])
                if held >= BATCH_TOKENS or k + 1 == b.num_rows:
                    keys = b.column("key_id").slice(first, len(parts))
                    yield pa.RecordBatch.from_arrays([keys, _lists(parts)], ["key_id", "ids"])
                    first, held, parts = k + 1, 0, []

    rows = docs.select(F.col(f"`{id}`").cast("long").alias("key_id"), F.col(f"`{text}`").alias("body"))
    return rows.mapInArrow(scan, "key_id long, ids array<int>")


def decode_ids(encoded: DataFrame, ranks: Broadcast, pattern: str) -> DataFrame:
    """The rows of ``encoded`` (key_id, ids) with ``decoded``, the bytes the ids stand for."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoding(ranks.value, pattern)
        for b in batches:
            ids = b.column("ids")
            flat, ends = ids.flatten().to_numpy(zero_copy_only=False), ids.offsets.to_numpy() - ids.offsets[0].as_py()
            made = [decode(coder, flat[a:z]) for a, z in zip(ends[:-1], ends[1:], strict=True)]
            yield pa.RecordBatch.from_arrays(
                [b.column("key_id"), ids, pa.array(made, pa.binary())], ["key_id", "ids", "decoded"]
            )

    return encoded.select("key_id", "ids").mapInArrow(scan, "key_id long, ids array<int>, decoded binary")
