"""Operator 10: token ids packed into rows of a fixed length.

Texts become token ids with a public byte-level BPE vocabulary (a file whose path is a
parameter, read by Spark and sent to the tasks; its size is checked). An end mark
follows every document. Documents longer than a row are split into pieces without loss.
Pieces are packed best-fit-decreasing: the longest first, each into the row whose free
space is the smallest that suffices. Rows are found by free space through a segment
tree over the capacities 0..length, so a search is a walk of its height.

A task packs what it reads, in buffers of at most ``buffer_tokens``: nothing is
shuffled, memory is bounded, and a row lost with its executor is made again from the
same split. Within a buffer the packing is best-fit-decreasing; a buffer leaves at most
its last rows partly filled.

Each packed row has the ids (little-endian, padded to the full length), the cumulative
segment lengths, positions that start again at 0 with every segment, and for every
segment its ``doc_id`` and the number of the piece. ``unpack`` gives the documents back.

Defined cases: null or empty text is the end mark alone; a null ``doc_id`` stays null in
the row; repeated rows are packed as often as they occur. Other columns are ignored.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newsloom.llm.common import ship

ship(__name__)

RANKS = "/opt/tokenizers/byte_bpe_50k.tiktoken"
MAX_RANKS_BYTES = 32 << 20
# Fixed value: the split pattern that belongs to the vocabulary.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


class Tokenizer:
    """Ids of a text, of the smallest unsigned kind that holds them, with the end mark."""

    def __init__(self, ranks_file: bytes):
        import tiktoken

        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, ranks_file.splitlines())}
        self.end = len(ranks)
        self.kind = "<u2" if self.end < 1 << 16 else "<u4"
        self.encoding = tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})

    def ids(self, text: str | None) -> np.ndarray:
        return np.append(self.encoding.encode_to_numpy(text or "", disallowed_special=()), self.end).astype(self.kind)


class CapacityTree:
    """Segment tree over free space 0..size: how many open rows have each, and the least that suffices."""

    def __init__(self, size: int):
        self.leaves = 1 << size.bit_length()
        self.count = [0] * (2 * self.leaves)
        self.rows: list[list[int]] = [[] for _ in range(size + 1)]

    def add(self, free: int, row: int) -> None:
        self.rows[free].append(row)
        at = free + self.leaves
        while at:
            self.count[at] += 1
            at >>= 1

    def take(self, need: int) -> tuple[int, int] | None:
        """(free, row) of an open row with the smallest free space of at least ``need``."""
        count, at = self.count, need + self.leaves
        if not count[at]:
            while at > 1 and (at & 1 or not count[at + 1]):
                at >>= 1
            if at <= 1:
                return None
            at += 1
            while at < self.leaves:
                at = 2 * at if count[2 * at] else 2 * at + 1
        free = at - self.leaves
        while at:
            count[at] -= 1
            at >>= 1
        return free, self.rows[free].pop()


def best_fit_decreasing(lengths: list[int], size: int) -> list[list[int]]:
    """Rows of piece numbers; every length is 1..size."""
    tree, rows = CapacityTree(size), []
    for i in sorted(range(len(lengths)), key=lambda i: (-lengths[i], i)):
        found = tree.take(lengths[i]) if lengths[i] < size else None
        if found is None:
            found = size, len(rows)
            rows.append([])
        free, row = found
        rows[row].append(i)
        if free > lengths[i]:
            tree.add(free - lengths[i], row)
    return rows


PACKED = (
    "shard int, row long, n_tokens int, doc_ids array<long>, pieces array<int>, cu_seqlens array<int>, "
    "ids binary, positions binary"
)
_ARROW = pa.schema([
    ("shard", pa.int32()), ("row", pa.int64()), ("n_tokens", pa.int32()), ("doc_ids", pa.list_(pa.int64())),
    ("pieces", pa.list_(pa.int32())), ("cu_seqlens", pa.list_(pa.int32())), ("ids", pa.binary()), ("positions", pa.binary()),
])


def _rows(pieces: list[tuple[int | None, int, np.ndarray]], size: int, pad: int, kind, shard: int, start: int):
    made = best_fit_decreasing([len(p[2]) for p in pieces], size)
    for at in range(0, len(made), 256):
        columns = [[] for _ in _ARROW]
        for k, members in enumerate(made[at:at + 256], start + at):
            parts = [pieces[i][2] for i in members]
            ends = np.cumsum([0] + [len(p) for p in parts])
            ids, places = np.full(size, pad, kind), np.zeros(size, "<u4" if size > 1 << 16 else "<u2")
            ids[:ends[-1]] = np.concatenate(parts)
            places[:ends[-1]] = np.arange(ends[-1]) - np.repeat(ends[:-1], np.diff(ends))
            for column, value in zip(columns, (
                shard, k, int(ends[-1]), [pieces[i][0] for i in members], [pieces[i][1] for i in members], ends.tolist(),
                ids.tobytes(), places.tobytes(),
            )):
                column.append(value)
        yield pa.record_batch([pa.array(c, f.type) for c, f in zip(columns, _ARROW)], schema=_ARROW)


def ranks_bytes(spark: SparkSession, path: str) -> bytes:
    """The vocabulary file, through Spark's reader; refused beyond its size bound."""
    path = path if "://" in path else f"file://{path}"
    found = spark.read.format("binaryFile").load(path).select("length", F.when(F.col("length") <= MAX_RANKS_BYTES, F.col("content")).alias("c")).first()
    if found.c is None:
        raise ValueError(f"vocabulary of {found.length} bytes; at most {MAX_RANKS_BYTES}")
    return bytes(found.c)


def pack_tokens(
    docs: DataFrame, length: int = 2048, ranks: str = RANKS, buffer_tokens: int = 4 << 20
) -> DataFrame:
    """Packed rows of the texts, see ``PACKED``."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(ranks_bytes(spark, ranks))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = Tokenizer(shared.value)
        end, shard = tokenizer.end, TaskContext.get().partitionId()
        kind = tokenizer.kind
        pieces, held, start = [], 0, 0
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = tokenizer.ids(text.as_py())
                for k, at in enumerate(range(0, len(ids), length)):
                    pieces.append((doc_id, k, ids[at:at + length]))
                    held += len(pieces[-1][2])
                    if held >= buffer_tokens:
                        for out in _rows(pieces, length, end, kind, shard, start):
                            start += out.num_rows
                            yield out
                        pieces, held = [], 0
        if pieces:
            yield from _rows(pieces, length, end, kind, shard, start)

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(pack, PACKED)


def unpack(packed: DataFrame, kind: str = "<u2") -> DataFrame:
    """(doc_id, ids) again: the pieces of a document, in order, put together."""
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.to_pylist()
            yield pa.RecordBatch.from_pylist([
                {"doc_id": d, "piece": p, "ids": np.frombuffer(r["ids"], kind)[a:b].tolist()}
                for r in rows for d, p, a, b in zip(r["doc_ids"], r["pieces"], r["cu_seqlens"], r["cu_seqlens"][1:])
            ], pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("ids", pa.list_(pa.int32()))]))

    pieces = packed.select("doc_ids", "pieces", "cu_seqlens", "ids").mapInArrow(cut, "doc_id long, piece int, ids array<int>")
    return pieces.groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("piece", "ids"))).alias("p")).select(
        "doc_id", F.flatten(F.col("p.ids")).alias("ids")
    )
