"""Operator 7: passages repeated across documents, by content-defined chunks and their digests.

A gear hash rolls over the bytes of a text (each byte's gear value, shifted by its distance, over the last
``WINDOW`` bytes). A chunk border lies where the hash is the smallest of some ``SPAN`` neighbouring
places, so borders depend on nearby bytes alone: an insertion moves none but those next to it, and no chunk is longer than
``SPAN``. A border opens a chunk run: the chunks from there on until they have ``min_bytes``. Runs are
deduplicated by digest; a shared digest is at least ``min_bytes`` equal bytes, so short common phrases mark nothing.

Two texts that share ``SURE`` bytes more than ``min_bytes`` share a run for certain, wherever the passage stands in
them; a passage is a chain of overlapping shared runs. The first border in a passage and the last run in it
may leave up to ``ENDS`` bytes of it outside, both ends together. The run with the smallest (doc_id, start) is the first,
others are copies of it. What a copy covers is dropped, cut on borders of characters. Every
dropped byte has an equal one at a smaller (doc_id, place), so one of each stays.

Runs are shuffled once, by digest (24 bytes each), and a window over a digest tells its first and its last place;
a hot digest's rows are one window, which spills. Passages are
found per document from its own shared runs. A long text is cut in stretches.

Defined cases: a null text and one of less than ``min_bytes`` bytes have no run and stay
as they are; rows that repeat a ``doc_id`` are one document, their runs count once per
place; a row without ``doc_id`` takes no part. The output columns of ``dedup_passages`` replace input columns of
the same names; others pass through.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from newsloom.llm.common import mix, replaced, ship, temporary

ship(__name__)

WINDOW = 16                                 # bytes that the gear hash of a place sees
SPAN = 64                                   # neighbouring places of which the smallest is a border
SURE = WINDOW + 3 * SPAN                    # a passage this much longer than a run holds one for certain
ENDS = WINDOW + 3 * SPAN                    # bytes of a found passage that may stay, both ends together
_STRETCH = 1 << 20
_BASE = 0x9E3779B97F4A7C15
_PLACE = 1 << 12                            # a run is start * _PLACE + length


def _gear() -> np.ndarray:
    return np.random.default_rng(7).integers(0, 2**32, 256, np.uint32)


def _sliding(values: np.ndarray, size: int, pick) -> np.ndarray:
    """``pick`` (minimum or maximum) of every run of ``size`` values; ``size`` is a power of two."""
    span = 1
    while span < size:
        values, span = pick(values[:-span], values[span:]), 2 * span
    return values


def borders(raw: np.ndarray, gear: np.ndarray) -> np.ndarray:
    """Starts of the content-defined chunks of a text, 0 first. The hash of a place sums gear values of the last
    bytes, each shifted by its distance; doubling the span takes log2(WINDOW) steps."""
    found = [np.zeros(min(1, len(raw)), np.int64)]
    for at in range(0, len(raw), _STRETCH):
        lo = max(0, at - SPAN - WINDOW)
        part = raw[lo:at + _STRETCH + SPAN]
        h, span = gear[part], 1
        while span < WINDOW:
            moved = np.zeros_like(h)
            moved[span:] = h[:-span] << np.uint32(2 * span)
            h, span = h + moved, 2 * span
        h = h * np.uint32(0x9E3779B1)
        if len(h) < SPAN:
            continue
        least, edge = _sliding(h, SPAN, np.minimum), np.zeros(SPAN - 1, np.uint32)
        low = np.flatnonzero(_sliding(np.concatenate((edge, least, edge)), SPAN, np.maximum) == h) + lo
        found.append(low[(low >= at) & (low < at + _STRETCH)])
    return np.unique(np.concatenate(found))


def _byte_values() -> np.ndarray:
    return mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_BASE))


@cache
def _powers(base: int) -> np.ndarray:
    out = np.full(_STRETCH + 2 * _PLACE, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def run_digests(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit digests of byte runs, sorted by start, from sums over their bytes times powers of an inverse."""
    out, inverse = np.empty(len(starts), np.uint64), pow(_BASE, -1, 1 << 64)
    for at in range(0, len(raw), _STRETCH):
        a, b = np.searchsorted(starts, (at, at + _STRETCH))
        if a == b:
            continue
        part = _byte_values()[raw[at:int(ends[a:b].max())]]
        sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(part * _powers(inverse)[:len(part)], dtype=np.uint64)))
        lo, hi = starts[a:b] - at, ends[a:b] - at
        out[a:b] = mix((sums[hi] - sums[lo]) * _powers(_BASE)[lo] + (hi - lo).astype(np.uint64))
    return out


def chunk_runs(raw: np.ndarray, size: int, gear: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, lengths, digests): from every border the chunks that together have ``size`` bytes; one run more that ends with the text."""
    cuts = borders(raw, gear)
    starts = cuts[cuts + size <= len(raw)]
    if not len(starts):
        return starts, starts, np.empty(0, np.uint64)
    edges = np.append(cuts, len(raw))
    ends = edges[np.searchsorted(edges, starts + size)]
    if ends[-1] < len(raw):
        starts, ends = np.append(starts, starts[-1]), np.append(ends, len(raw))
    return starts, ends - starts, run_digests(raw, starts, ends)


def _encoded(text: str | None) -> bytes:
    return (text or "").encode("utf-8", "surrogatepass")


def chunked(docs: DataFrame, min_bytes: int) -> DataFrame:
    """(doc_id, place, digest) of every chunk run; ``place`` holds start and length."""
    schema = pa.schema([("doc_id", pa.int64()), ("place", pa.int64()), ("digest", pa.int64())])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gear = _gear()
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                columns = [[] for _ in schema]
                for doc_id, text in zip(batch.column(0)[at:at + 512].to_pylist(), batch.column(1)[at:at + 512]):
                    starts, lengths, digests = chunk_runs(np.frombuffer(_encoded(text.as_py()), np.uint8), min_bytes, gear)
                    if len(starts):
                        columns[0].append(np.full(len(starts), doc_id, np.int64))
                        columns[1].append(starts * _PLACE + lengths)
                        columns[2].append(digests.view(np.int64))
                if columns[0]:
                    yield pa.record_batch([pa.array(np.concatenate(c), f.type) for c, f in zip(columns, schema)], schema=schema)

    return docs.where("doc_id is not null").select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        cut, "doc_id long, place long, digest long"
    )


def shared_runs(docs: DataFrame, min_bytes: int) -> DataFrame:
    """Per document its chunk runs that occur elsewhere too: array of (place, first, other)."""
    spot, alike = F.struct("doc_id", "place"), Window.partitionBy("digest")
    placed = chunked(docs, min_bytes).withColumns({"low": F.min(spot).over(alike), "high": F.max(spot).over(alike)})
    found = placed.where("low <> high").select(
        "doc_id", F.struct(
            "place", (spot == F.col("low")).alias("first"),
            F.when(F.col("low.doc_id") == F.col("doc_id"), F.col("high.doc_id")).otherwise(F.col("low.doc_id")).alias("other"),
        ).alias("c"),
    )
    return found.groupBy("doc_id").agg(F.array_sort(F.collect_set("c")).alias("found"))


def joined_runs(places: list[int]) -> list[tuple[int, int]]:
    """(start, end) of the stretches that runs cover; sorted places."""
    out: list[tuple[int, int]] = []
    for place in places:
        a, b = place // _PLACE, place // _PLACE + place % _PLACE
        if out and a <= out[-1][1]:
            out[-1] = out[-1][0], max(b, out[-1][1])
        else:
            out.append((a, b))
    return out


def without_copies(text: str | None, found: list[dict] | None) -> tuple:
    """(kept text, repeated bytes, dropped bytes, passages, first document that shares one)."""
    if not found:
        return text, 0, 0, 0, None
    runs = joined_runs([c["place"] for c in found])
    data, out, at, dropped = _encoded(text), [], 0, 0
    for a, b in joined_runs([c["place"] for c in found if not c["first"]]):
        while a < b and data[a] & 0xC0 == 0x80:
            a += 1
        while b > a and b < len(data) and data[b] & 0xC0 == 0x80:
            b -= 1
        out.append(data[at:a])
        at, dropped = b, dropped + b - a
    out.append(data[at:])
    return (
        b"".join(out).decode("utf-8", "surrogatepass"), sum(b - a for a, b in runs), dropped, len(runs),
        min(c["other"] for c in found),
    )


MADE = "kept_text string, repeated_bytes long, dropped_bytes long, n_passages int, shared_with long"


def dedup_passages(docs: DataFrame, min_bytes: int = 100) -> DataFrame:
    """The rows with ``kept_text`` (copies dropped, first occurrences stay), bytes in repeated
    passages, bytes dropped, number of passages and a document that shares one."""
    names = [c.split()[0] for c in MADE.split(", ")]
    docs = replaced(docs, *names)
    key, runs_of, result = temporary("id"), temporary("found"), temporary("made")
    found = shared_runs(docs, min_bytes).select(F.col("doc_id").alias(key), F.col("found").alias(runs_of))
    joined = docs.join(found, F.col("doc_id").cast("long") == F.col(key), "left")

    @F.pandas_udf(MADE)
    def drop(texts, found):
        rows = [without_copies(t, None if f is None else list(f)) for t, f in zip(texts, found)]
        frame = pd.DataFrame(rows, columns=["kept_text", "repeated_bytes", "dropped_bytes", "n_passages", "shared_with"])
        return frame.astype({"repeated_bytes": "int64", "dropped_bytes": "int64", "n_passages": "int32", "shared_with": "Int64"})

    return joined.withColumn(result, drop.asNondeterministic()(F.col("text").cast("string"), F.col(runs_of))).select(
        *(F.col(f"`{c}`") for c in docs.columns), *(F.col(f"{result}.{n}") for n in names)
    )
