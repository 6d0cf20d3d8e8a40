"""Operator 13: importance resampling towards a target distribution.

Hashed runs of words ("features") are counted in the corpus and in a target; a bucket's
gain is the log-ratio of its smoothed shares, a document's weight the sum of the gains of
its features. Documents are drawn without repeats by the highest weight plus Gumbel noise
that a hash of the ``doc_id`` fixes.

The bucket of a feature is its CRC-32. Each document is normalised (A-Z in lower case,
words joined by one space) and scanned once; the CRC of every prefix that ends with a
word is kept. The CRC of a run of words then follows from two prefixes: moving the shorter
prefix's CRC over the run's bytes is a product in GF(2)[x] modulo the CRC polynomial, done
by tables of powers of two, and it cancels out of the longer prefix's CRC. So longer runs cost
no further scan. A text is scanned in pieces, with the last words carried over, so
memory does not grow with its length.

Counts are ``buckets`` numbers per task, added up by Spark; only the ``buckets`` gains come to the
driver. Ranks are positions in a range-partitioned sort, not a one-task window.

Defined cases: a null or empty text has no features and weight 0. A row without
``doc_id`` has a weight, but no score; it counts in the corpus and is never drawn. Rows that
repeat a ``doc_id`` are rows of their own (ties: fewer features, then smaller weight first).
An empty target leaves the smoothed ratio alone. Other columns are not read;
``resampled`` returns them as they are.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from collections.abc import Iterator
from functools import cache
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsloom.llm.common import ship, stored
from newsloom.operators.numbering import number_rows

ship(__name__)

PIECE = 1 << 20                             # bytes of text scanned at once
_BYTES = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


@cache
def byte_table() -> np.ndarray:
    """CRC-32 register after one byte, by the low eight bits before it."""
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(0xEDB88320), table >> 1).astype(np.uint32)
    return table


def _by_tables(tables: np.ndarray, crc: np.ndarray) -> np.ndarray:
    return tables[0][crc & 255] ^ tables[1][(crc >> 8) & 255] ^ tables[2][(crc >> 16) & 255] ^ tables[3][crc >> 24]


@cache
def power_tables() -> np.ndarray:
    """[k]: the linear map of a register over 2**k zero bytes, as four tables by byte."""
    values = np.arange(256, dtype=np.uint32)
    out = np.empty((40, 4, 256), np.uint32)
    for j in range(4):
        moved = values << np.uint32(8 * j)
        out[0][j] = (moved >> np.uint32(8)) ^ byte_table()[moved & 255]
    for k in range(1, len(out)):
        out[k] = _by_tables(out[k - 1], out[k - 1])
    return out


def shifted(crc: np.ndarray, n_bytes: np.ndarray) -> np.ndarray:
    """What a prefix's CRC has become ``n_bytes`` bytes later, apart from those bytes' own part."""
    crc, k = crc.copy(), 0
    while len(n_bytes) and (n_bytes >> k).any():
        rows = np.flatnonzero((n_bytes >> k) & 1)
        crc[rows] = _by_tables(power_tables()[k], crc[rows])
        k += 1
    return crc


def _pieces(text: str) -> Iterator[list[bytes]]:
    """Words, some at a time."""
    raw = text.encode("utf-8", "surrogatepass").translate(_BYTES)
    at = 0
    while at < len(raw):
        end = len(raw)
        if end - at > PIECE:
            end = raw.rfind(b" ", at, at + PIECE) + 1 or raw.find(b" ", at + PIECE) + 1 or end
        if found := raw[at:end].split():
            yield found
        at = end


def feature_crcs(text: str | None, longest: int = 1) -> Iterator[tuple[int, np.ndarray]]:
    """(words, CRC-32 of each run of 1 to ``longest`` words that ends in them) per piece of the text."""
    before, crc, length = (np.empty(0, np.uint32), np.empty(0, np.int64)), 0, 0  # prefixes of the words carried over
    for words in _pieces(text or ""):
        glue = b" " if length else b""
        tokens = [glue + words[0], *(b" " + w for w in words[1:])]
        ends = np.fromiter(accumulate(tokens, lambda c, w: zlib.crc32(w, c), initial=crc), np.uint32, len(tokens) + 1)
        places = length + np.cumsum([0, *map(len, tokens)])
        # a run starts after the space behind the word before it; the very first has no space
        opens = ~ends[:-1]
        opens = ~((opens >> np.uint32(8)) ^ byte_table()[(opens ^ 32) & 255])
        begins = places[:-1] + 1
        if not glue:
            opens[0], begins[0] = 0, 0
        crc, length = int(ends[-1]), int(places[-1])
        ends, places, n = ends[1:], places[1:], len(words)
        opens, begins = np.concatenate((before[0], opens)), np.concatenate((before[1], begins))
        held, out = len(opens) - n, []
        for size in range(1, longest + 1):
            first = max(held, size - 1)     # the first word that such a run can end in
            a, b = slice(first - size + 1, max(first, held + n) - size + 1), first - held
            out.append(ends[b:] ^ shifted(opens[a], places[b:] - begins[a]))
        keep = min(longest - 1, len(opens))
        before = (opens[len(opens) - keep:], begins[len(begins) - keep:])
        yield n, np.concatenate(out)


def gumbel(seed: int, doc_id: int) -> int:
    """Gumbel noise in thousandths."""
    h = int(hashlib.sha256(f"{seed}:{doc_id}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def features(docs: DataFrame, longest: int = 1, buckets: int = 10000) -> DataFrame:
    """(doc_id, n_words, n_features, found): ``found`` holds the bucket of every feature, packed."""
    kind = np.dtype("<u2" if buckets <= 1 << 16 else "<u4")

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words, sizes, found = [], [], []
            for text in batch.column(1):
                n, parts = 0, []
                for k, crcs in feature_crcs(text.as_py(), longest):
                    n += k
                    parts.append((crcs % np.uint32(buckets)).astype(kind).tobytes())
                words.append(n)
                found.append(b"".join(parts))
                sizes.append(len(found[-1]) // kind.itemsize)
            yield pa.record_batch(
                [batch.column(0), pa.array(words, pa.int64()), pa.array(sizes, pa.int64()), pa.array(found, pa.binary())],
                names=["doc_id", "n_words", "n_features", "found"],
            )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(scan, "doc_id long, n_words long, n_features long, found binary")


def bucket_counts(found: DataFrame, buckets: int) -> DataFrame:
    """(bucket, n) over all rows; a task hands on one count per bucket."""
    kind = np.dtype("<u2" if buckets <= 1 << 16 else "<u4")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for value in batch.column(0):
                total += np.bincount(np.frombuffer(value.as_buffer(), kind), minlength=buckets)
        at = np.flatnonzero(total)
        yield pa.record_batch([pa.array(at, pa.int64()), pa.array(total[at], pa.int64())], names=["bucket", "n"])

    return found.select("found").mapInArrow(count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(corpus: DataFrame, target: DataFrame, buckets: int) -> np.ndarray:
    """Gain of every bucket, in thousandths; ``buckets`` rows come to the driver."""
    sides = []
    for table in (corpus, target):
        counts = [0] * buckets
        for row in bucket_counts(table, buckets).collect():
            counts[row.bucket] = row.n
        sides.append(counts)
    (s, t), (total_s, total_t) = sides, map(sum, sides)
    return np.array([
        math.floor(1000 * math.log(float((t[b] + 1) * (total_s + buckets)) / float((s[b] + 1) * (total_t + buckets))))
        for b in range(buckets)
    ], np.int64)


def scores(
    docs: DataFrame, target: DataFrame, longest: int = 1, buckets: int = 10000, seed: int = 2024
) -> DataFrame:
    """(doc_id, n_words, n_features, weight, score) of every row."""
    kind = np.dtype("<u2" if buckets <= 1 << 16 else "<u4")
    found = stored(features(docs, longest, buckets), "features")
    gain = gains(found, features(target.select(F.lit(None).alias("doc_id"), "text"), longest, buckets), buckets)

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            weights = [int(gain[np.frombuffer(v.as_buffer(), kind)].sum()) for v in batch.column(3)]
            score = [None if i is None else w + gumbel(seed, i) for i, w in zip(batch.column(0).to_pylist(), weights)]
            yield pa.record_batch(
                [*batch.columns[:3], pa.array(weights, pa.int64()), pa.array(score, pa.int64())],
                names=["doc_id", "n_words", "n_features", "weight", "score"],
            )

    return found.mapInArrow(weigh, "doc_id long, n_words long, n_features long, weight long, score long")


def ranked(
    docs: DataFrame, target: DataFrame, longest: int = 1, buckets: int = 10000, min_words: int = 20, percent: int = 10,
    seed: int = 2024,
) -> DataFrame:
    """``scores`` with ``rank``: 1, 2, ... of the documents drawn, else null."""
    scored = stored(scores(docs, target, longest, buckets, seed), "scored")
    fits = (F.col("n_words") >= min_words) & F.col("score").isNotNull()
    order = scored.where(fits).withColumns({"down": -F.col("score"), "at": F.monotonically_increasing_id()})
    placed = number_rows(order, "down", "doc_id", "n_features", "weight", "at", rn="rn", total="fitting")
    drawn = F.col("rn") <= F.floor(F.col("fitting") * percent / 100)
    placed = placed.select(*scored.columns, F.when(drawn, F.col("rn")).cast("long").alias("rank"))
    return placed.unionByName(scored.where(~F.coalesce(fits, F.lit(False))).withColumn("rank", F.lit(None).cast("long")))


def resampled(docs: DataFrame, target: DataFrame, **rule) -> DataFrame:
    """The rows of ``docs`` that are drawn; rows that share a ``doc_id`` are drawn together."""
    drawn = ranked(docs, target, **rule).where("rank is not null").select(F.col("doc_id").alias("__drawn")).distinct()
    return docs.join(drawn, docs["doc_id"].cast("long") == F.col("__drawn"), "left_semi")
