"""Operator 3: mix sources to target weights, block by block.

The words of a source are laid end to end (a global position per document, from sums
per group of documents) and cut into blocks of ``block_words``; only the last block of
a source is shorter. A source's slots are its target in blocks, rounded once, so it meets
its target within a block or two however many shards there are. Each output shard draws how many
slots every source gets: a source's slots fall on the shards by a seeded multinomial draw, made as
a tree of binomial draws, which also numbers them (shards have ``shard_slots`` slots on average).
Slot s reads block ``perm(s mod n)`` of pass ``s div n``, where ``perm`` is a keyed permutation
of the source's n blocks, another one in each pass. Blocks and slots meet in a join on (source, block).

So no block is read more often than the number of passes: no document exceeds ``cap``
times its size. Everything is keyed by (seed, shard, source, pass): reruns agree.

What comes to the driver is one row per source (``weights`` are given per source, so
sources are configuration; more than ``max_sources`` is refused, not cut).

Defined cases: null or blank text has size 0 and is taken 0 times; a null source is a
source, last in order; a row without ``doc_id`` is mixed like any other; rows that repeat
a ``doc_id``, with equal or other texts, are separate rows of the same source (texts are cut
by a written row number, never by ``doc_id``). An empty table gives an empty result. Other
columns, whatever their names, pass through ``mixed_documents``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from fractions import Fraction

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from newsloom.llm.common import mix, n_words, ship, stored, temporary

ship(__name__)

GROUP_WORDS = 1 << 18                       # documents laid out by one task
TASK_SHARDS = 32                            # shards of one group; a task deals one group or more
MAX_TASKS = 20_000
ROW, ID, SPANS, SIZE = (temporary(name) for name in ("row", "id", "spans", "size"))


def source_targets(
    sizes: list[tuple[str | None, int]], weights: tuple[int, ...] = (3, 1, 2), percent: int = 150, cap: int = 2
) -> list[tuple[str | None, int, float]]:
    """(source, size, target) by code point, null last. Targets stop at ``cap`` times the
    size; what is above is shared again by weight among the others."""
    rows = sorted(sizes, key=lambda r: (r[0] is None, r[0] or ""))
    weight = {i: weights[i % len(weights)] for i in range(len(rows))}
    target, left = {}, Fraction(percent * sum(n for _, n in rows), 100)
    active = set(weight)
    while active:
        total = sum(weight[i] for i in active)
        full = {i for i in active if left * weight[i] / total > cap * rows[i][1]}
        if not full:
            target.update({i: left * weight[i] / total for i in active})
            break
        target.update({i: Fraction(cap * rows[i][1]) for i in full})
        left -= sum(target[i] for i in full)
        active -= full
    return [(s, n, float(target[i])) for i, (s, n) in enumerate(rows)]


def permuted(index: np.ndarray, n: np.ndarray, key: np.ndarray) -> np.ndarray:
    """Keyed permutation of 0..n-1: a four-round Feistel network, walked until below n."""
    half = np.maximum(1, (np.ceil(np.log2(np.maximum(n, 2))).astype(np.int64) + 1) // 2).astype(np.uint64)
    low = (np.uint64(1) << half) - np.uint64(1)
    at, todo = index.astype(np.uint64), np.ones(len(index), bool)
    while todo.any():
        left, right = at[todo] >> half[todo], at[todo] & low[todo]
        for turn in range(4):
            fold = mix(right + key[todo] + np.uint64(turn << 60)) & low[todo]
            left, right = right, left ^ fold
        at[todo] = (left << half[todo]) | right
        todo &= at >= n.astype(np.uint64)
    return at.astype(np.int64)


@dataclass
class Mix:
    sources: list[tuple[str | None, int, float]]
    rows: DataFrame                         # row, doc_id, src, size, start, place
    slots: DataFrame                        # shard, src, block, turn
    block_words: int

    def pieces(self, rows: DataFrame | None = None) -> DataFrame:
        """Every row cut at block borders: block, from_word, to_word."""
        n, start, end = self.block_words, F.col("start"), F.col("start") + F.col("size")
        blocks = F.sequence((start / n).cast("long"), ((end - 1) / n).cast("long"))
        return (self.rows if rows is None else rows).where("size > 0").withColumn("block", F.explode(blocks)).select(
            "row", "doc_id", "src", "size", "start", "place", "block",
            (F.greatest(F.col("block") * n, start) - start).alias("from_word"),
            (F.least((F.col("block") + 1) * n, end) - start).alias("to_word"),
        )

    def taken(self) -> DataFrame:
        """(doc_id, size, source_size, target, taken) per row."""
        uses = self.slots.groupBy("src", "block").agg(F.count("*").alias("uses"))
        words = (
            self.pieces().join(uses, ["src", "block"])
            .groupBy("src", "start", "place", "doc_id").agg(F.sum(F.expr("uses * (to_word - from_word)")).alias("taken"))
        )
        spark = self.rows.sparkSession
        facts = spark.createDataFrame(
            [(i, n, t) for i, (_, n, t) in enumerate(self.sources)], "src int, source_size long, target double"
        )
        key = ["src", "start", "place"]
        return (
            self.rows.join(words.drop("doc_id"), key, "left").join(F.broadcast(facts), "src")
            .select("doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"))
        )


def shard_counts(wanted: np.ndarray, n_shards: int, first: int, last: int, seed: int) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """(shard, sources, their slots in it, their slots in earlier shards) for shards first..last-1. Every source's
    ``wanted`` slots fall on all shards by a multinomial draw, made as a tree of binomial draws: a node's slots are
    dealt to its halves, seeded by the node, so any task finds the same counts on the way down to its own shards."""
    every = np.flatnonzero(wanted)
    nodes = [(0, 1 << max(0, n_shards - 1).bit_length(), every, wanted[every], np.zeros(len(every), np.int64))]
    while nodes:
        start, width, src, n, before = nodes.pop()
        if start >= min(last, n_shards) or start + width <= first or not len(src):
            continue
        if width == 1:
            yield start, src, n, before
            continue
        half, inside = width // 2, min(width, n_shards - start)
        left = n if half >= inside else np.random.default_rng([seed, start, width]).binomial(n, half / inside)
        more = n > left
        nodes.append((start + half, half, src[more], (n - left)[more], (before + left)[more]))
        some = left > 0
        nodes.append((start, half, src[some], left[some], before[some]))


def _slots(spark, sources, block_words: int, cap: int, shard_slots: int, seed: int) -> DataFrame:
    blocks = np.array([-(-n // block_words) for _, n, _ in sources], np.int64)
    wanted = np.array([min(cap * b, round(t * b / n)) if n else 0 for (_, n, t), b in zip(sources, blocks.tolist())], np.int64)
    n_shards = -(-int(wanted.sum()) // shard_slots)

    def deal(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for group in frame["id"]:
                for shard, some, n, before in shard_counts(wanted, n_shards, group * TASK_SHARDS, (group + 1) * TASK_SHARDS, seed):
                    src = np.repeat(some, n)
                    slot = np.arange(len(src)) + np.repeat(before - np.cumsum(n) + n, n)
                    turn = slot // blocks[src]
                    key = mix(mix(np.uint64(seed) + src.astype(np.uint64)) + turn.astype(np.uint64))
                    yield pd.DataFrame({
                        "shard": shard, "src": src.astype(np.int32), "turn": turn.astype(np.int32),
                        "block": permuted(slot % blocks[src], blocks[src], key),
                    })

    groups = -(-n_shards // TASK_SHARDS)
    shards = spark.range(0, groups, 1, max(1, min(groups, MAX_TASKS)))
    # stored, so that the planner knows how large it is
    return stored(shards.mapInPandas(deal, "shard long, src int, turn int, block long"), "slots")


def mix_sources(
    docs: DataFrame, weights: tuple[int, ...] = (3, 1, 2), percent: int = 150, cap: int = 2,
    block_words: int = 128, shard_slots: int = 4096, seed: int = 17, max_sources: int = 100_000,
) -> Mix:
    spark = docs.sparkSession
    sized = _sized(docs.withColumn(ROW, F.monotonically_increasing_id()))
    totals = sized.groupBy("source").agg(F.sum("size").alias("n")).limit(max_sources + 1).collect()
    if len(totals) > max_sources:
        raise ValueError(f"more than {max_sources} sources: give weights to fewer, larger ones")
    sources = source_targets([(r.source, r.n) for r in totals], weights, percent, cap)
    return Mix(sources, _laid(sized, sources), _slots(spark, sources, block_words, cap, shard_slots, seed), block_words)


def _sized(numbered: DataFrame) -> DataFrame:
    text = F.col("text").cast("string")
    return stored(numbered.select(
        F.col(ROW).alias("row"), F.col("doc_id").cast("long"), F.col("source").cast("string"), n_words(text).alias("size"),
        F.xxhash64(F.col("doc_id").cast("long"), text).alias("h"),
    ), "sized")


def _laid(sized: DataFrame, sources: list[tuple[str | None, int, float]]) -> DataFrame:
    """The rows of every source end to end. The order is by content, so that it is the same however
    rows are numbered; only rows equal in id and text are told apart by their number."""
    named = sized.sparkSession.createDataFrame(
        [(s, i, -(-n // GROUP_WORDS) or 1) for i, (s, n, _) in enumerate(sources)], "name string, src int, groups long"
    )
    keyed = sized.join(F.broadcast(named), F.col("source").eqNullSafe(F.col("name"))).select(
        "row", "doc_id", "size", "src", "h", F.pmod(F.xxhash64(F.lit(1), "h"), F.col("groups")).alias("part"),
    )
    order = Window.partitionBy("src", "part").orderBy("h", F.col("doc_id"), "size", "row")
    laid = keyed.withColumn("end", F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, 0))).withColumn(
        "place", F.row_number().over(order)
    )
    parts = keyed.groupBy("src", "part").agg(F.sum("size").alias("n"))
    base = parts.withColumn("base", F.coalesce(
        F.sum("n").over(Window.partitionBy("src").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
    )).drop("n")
    rows = laid.join(base, ["src", "part"]).select(
        "row", "doc_id", "src", "size", (F.col("base") + F.col("end") - F.col("size")).alias("start"),
        (F.col("part") * (1 << 32) + F.col("place")).alias("place"),
    )
    return stored(rows, "laid")


def mixed_documents(docs: DataFrame, made: Mix) -> DataFrame:
    """The mix as documents: per pass one row for each row of which it takes words, with the
    taken text (runs of words keep their own spacing; gaps become line breaks). ``docs`` are
    those of ``made``; they are written once with a row number, by which texts are cut, so
    null and repeated ``doc_id`` are rows like any other. Other columns pass through."""
    numbered = stored(docs.withColumn(ROW, F.monotonically_increasing_id()), "numbered")
    spans = (
        made.pieces(_laid(_sized(numbered), made.sources)).join(made.slots, ["src", "block"])
        .groupBy(F.col("row").alias(ID), "turn")
        .agg(F.array_sort(F.collect_list(F.struct("from_word", "to_word"))).alias(SPANS), F.max("size").alias(SIZE))
    )
    joined = numbered.join(spans.drop("turn"), F.col(ROW) == F.col(ID)).drop(ID, ROW)
    out = docs.schema
    at = [i for i, f in enumerate(out) if f.name == "text"][0]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans, sizes = batch.column(batch.num_columns - 2).to_pylist(), batch.column(batch.num_columns - 1).to_pylist()
            texts = [taken_text(t, [(s["from_word"], s["to_word"]) for s in sp], n)
                     for t, sp, n in zip(batch.column(at).to_pylist(), spans, sizes)]
            columns = list(batch.columns[:-2])
            columns[at] = pa.array(texts, pa.string())
            yield pa.record_batch(columns, names=[f.name for f in out])

    return joined.mapInArrow(cut, out)


def taken_text(text: str, spans: list[tuple[int, int]], size: int) -> str:
    runs: list[list[int]] = []
    for a, b in spans:
        if runs and a <= runs[-1][1]:
            runs[-1][1] = max(b, runs[-1][1])
        else:
            runs.append([a, b])
    if runs == [[0, size]]:
        return text
    raw = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    space = (raw == 32) | ((raw >= 9) & (raw <= 13))
    edge = np.diff(np.concatenate(([True], space, [True])).astype(np.int8))
    begin, end = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    return "\n".join(raw[begin[a]:end[b - 1]].tobytes().decode("utf-8", "replace") for a, b in runs)
