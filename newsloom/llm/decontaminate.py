"""Operator 8: benchmark passages in documents, found by SimHash.

Items and documents become words (letters and digits, lower case) and shingles of five
words. For every item length, windows of that many words slide over a document; a
window's fingerprint is the 64-bit SimHash of its shingles, taken from running sums.
Fingerprints are looked up in a multi-index: eight blocks of eight bits, each searched
within two bits. A fingerprint within distance 23 differs by at most two bits in some
block (eight blocks of three would make 24), so all items within the radius are found.
Each is then verified by the weighted similarity of the shingles, which weigh as often
as they occur: sum of the smaller counts over the sum of the larger ones.

Before any fingerprint is made, windows are dropped that cannot be verified: a window
of m shingles with similarity s shares at least 2ms/(1+s) with an item, so it must hold
that many shingles of the benchmark. Nothing that could be verified is lost by it.

Documents are only mapped: no shuffle, and a passage that a third of all documents
share costs each of them its own search. The benchmark is taken in blocks of bounded
size, one pass each, so what is sent to the tasks never grows with it.

Defined cases: null or empty texts and items match nothing; an item shorter than a
shingle is its whole sequence; a document shorter than an item is one window; repeated
items are reported under each of their ids; rows without an id take part with a null id,
and ``decontaminated`` drops them too when they hold a passage.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsloom.llm.common import WordHashes, rolling_hashes, ship

ship(__name__)

SHINGLE = 5
BLOCK_CHARS = 4_000_000                     # of benchmark text sent to the tasks in one pass
BLOCK_BITS = 2                              # searched around each byte of a fingerprint
RADIUS = 8 * (BLOCK_BITS + 1) - 1
_WORDS = re.compile(rb"[a-z0-9\x80-\xff]+")
_ONES = np.array([bin(i).count("1") for i in range(256)], np.uint8)
_TABLE_BITS = 22


def passage_words(text: str | None) -> list[bytes]:
    return _WORDS.findall((text or "").lower().encode("utf-8", "surrogatepass"))


def _signs(hashes: np.ndarray) -> np.ndarray:
    """+1 or -1 per bit of each hash: (n, 64)."""
    bits = np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1)
    return bits.astype(np.int32) * 2 - 1


def _bytes(sums: np.ndarray) -> np.ndarray:
    return np.packbits(sums > 0, axis=1)


def similarity(a: Counter, b: Counter) -> float:
    low = sum((a & b).values())
    return low / (sum(a.values()) + sum(b.values()) - low) if low else 0.0


class Index:
    """Items by length in words, with the multi-index over their fingerprints."""

    def __init__(self, items: list[tuple[int | None, str | None]], threshold: float):
        hashes, self.threshold, self.by_length = WordHashes(), threshold, {}
        grouped: dict[int, list] = {}
        for item_id, text in items:
            words = passage_words(text)
            if words:
                grouped.setdefault(len(words), []).append((item_id, rolling_hashes(words, SHINGLE, hashes)))
        known = [h for rows in grouped.values() for _, h in rows]
        self.known = np.unique(np.concatenate(known)) if known else np.empty(0, np.uint64)
        self.maybe = np.zeros(1 << _TABLE_BITS, bool)
        self.maybe[(self.known >> np.uint64(64 - _TABLE_BITS)).astype(np.int64)] = True
        for n, rows in grouped.items():
            prints = _bytes(np.stack([_signs(h).sum(axis=0) for _, h in rows]))
            near = _ONES[np.arange(256, dtype=np.uint8)[None, :, None] ^ prints.T[:, None, :]] <= BLOCK_BITS
            self.by_length[n] = [i for i, _ in rows], [Counter(h.tolist()) for _, h in rows], prints, near

    def hits(self, shingles: np.ndarray) -> np.ndarray:
        """Which shingles occur in the benchmark."""
        found = self.maybe[(shingles >> np.uint64(64 - _TABLE_BITS)).astype(np.int64)]
        at = np.flatnonzero(found)
        if len(at):
            place = np.minimum(np.searchsorted(self.known, shingles[at]), len(self.known) - 1)
            found[at] = self.known[place] == shingles[at]
        return found

    def search(self, words: list[bytes], hashes: WordHashes) -> list[tuple]:
        """(item_id, spans, best similarity, first word of the best) in one document."""
        out = []
        shingles = rolling_hashes(words, SHINGLE, hashes)
        hit = self.hits(shingles) if len(shingles) and len(self.known) else np.zeros(0, bool)
        short = [n for n in self.by_length if n < SHINGLE]
        if hit.any():
            out += self._windows(words, shingles, hit, [n for n in self.by_length if n >= SHINGLE])
        for n in short:                     # items shorter than a shingle: runs of their own length
            own = rolling_hashes(words, n, hashes) if len(words) >= n else np.empty(0, np.uint64)
            seen = self.hits(own) if len(own) else np.zeros(0, bool)
            if seen.any():
                out += self._matches(n, own, 1, np.flatnonzero(seen))
        return out

    def _windows(self, words, shingles, hit, lengths) -> list[tuple]:
        out, total = [], np.concatenate(([0], np.cumsum(hit)))
        first, last = np.flatnonzero(hit)[[0, -1]]
        for n in lengths:
            m = min(n - SHINGLE + 1, len(shingles))
            # a document shorter than the item is one window, whose shingles must be most of the item's
            need = np.ceil(2 * m * self.threshold / (1 + self.threshold) - 1e-9) if len(words) >= n else 1
            lo, hi = max(0, first - m + 1), min(last, len(shingles) - m)
            starts = np.arange(lo, hi + 1)
            starts = starts[total[starts + m] - total[starts] >= need]
            if not len(starts):
                continue
            out += self._matches(n, shingles, m, starts)
        return out

    def _matches(self, n, shingles, m, starts) -> list[tuple]:
        ids, counts, prints, near = self.by_length[n]
        found: dict[int, list[tuple[int, float]]] = {}
        for run in np.split(starts, np.flatnonzero(np.diff(starts) > m) + 1):
            for at in range(0, len(run), 4096):
                part = run[at:at + 4096]
                base = part[0]
                sums = np.concatenate((np.zeros((1, 64), np.int32), np.cumsum(_signs(shingles[base:part[-1] + m]), axis=0, dtype=np.int32)))
                made = _bytes(sums[part - base + m] - sums[part - base])
                candidate = near[0][made[:, 0]]
                for k in range(1, 8):
                    candidate = candidate | near[k][made[:, k]]
                for w, i in zip(*np.nonzero(candidate)):
                    if int(_ONES[made[w] ^ prints[i]].sum()) > RADIUS:
                        continue
                    start = int(part[w])
                    got = similarity(Counter(shingles[start:start + m].tolist()), counts[i])
                    if got >= self.threshold:
                        found.setdefault(int(i), []).append((start, got))
        out = []
        for i, windows in found.items():
            spans, reach = 0, -1
            for start, _got in sorted(windows):
                if start >= reach:
                    spans, reach = spans + 1, start + n
            best = max(windows, key=lambda w: (w[1], -w[0]))
            out.append((ids[i], spans, round(best[1], 6), best[0]))
        return out


FOUND = "doc_id long, item_id long, n_spans int, similarity double, first_word long"
_ARROW = pa.schema([
    ("doc_id", pa.int64()), ("item_id", pa.int64()), ("n_spans", pa.int32()), ("similarity", pa.float64()), ("first_word", pa.int64()),
])


def contaminated(docs: DataFrame, benchmark: DataFrame, threshold: float = 0.8) -> DataFrame:
    """One row per document and benchmark item found in it."""
    texts, found = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")), None
    for shared in _blocks(benchmark):
        def search(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            index, hashes = Index(shared.value, threshold), WordHashes()
            for batch in batches:
                out = [
                    (doc_id, *row) for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1))
                    for row in index.search(passage_words(text.as_py()), hashes)
                ]
                if out:
                    yield pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*out), _ARROW)], schema=_ARROW)

        part = texts.mapInArrow(search, FOUND)
        found = part if found is None else found.union(part)
    return found


def _blocks(benchmark: DataFrame) -> Iterator[Broadcast]:
    """The items, in blocks of bounded size."""
    items = benchmark.select(F.col("item_id").cast("long"), F.col("text").cast("string"))
    chars = items.agg(F.coalesce(F.sum(F.length("text")), F.lit(0))).first()[0]
    passes = max(1, -(-chars // BLOCK_CHARS))
    for block in range(passes):
        rows = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(passes)) == block)
        yield benchmark.sparkSession.sparkContext.broadcast([tuple(r) for r in rows.collect()])


def decontaminated(docs: DataFrame, benchmark: DataFrame, threshold: float = 0.8) -> DataFrame:
    """Rows in whose text no item was found. Every row is judged by its own text, whether its
    ``doc_id`` is null, repeated or neither."""
    out, left = docs.schema, docs
    at = [i for i, f in enumerate(out) if f.name == "text"][0]
    for shared in _blocks(benchmark):
        def clean(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            index, hashes = Index(shared.value, threshold), WordHashes()
            for batch in batches:
                texts = batch.column(at).cast(pa.string())
                yield batch.filter(pa.array([not index.search(passage_words(t.as_py()), hashes) for t in texts], pa.bool_()))

        left = left.mapInArrow(clean, out)
    return left
