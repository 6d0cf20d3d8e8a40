"""Operator 5: toxicity by a convolutional text classifier, trained in numpy.

A word's embedding is the sum of hashed embeddings of its parts (the word, prefixes of
three to six bytes, a suffix). Filters of one, two and three words slide over the
text; each passes its highest response on (max pooling), and a logistic unit reads
them. One embedding dimension starts as the smoothed log-odds of a part among toxic
documents, the others at random; gradients flow only through the pooled positions.
Scores are calibrated on labelled rows that were not trained on; a threshold of its own
is calibrated for every language with enough labels.

Every labelled document teaches, except those whose crc32(doc_id) mod 5 is 0. They are cut by hash into parts of
some ``PART_ROWS``. The log-odds count all of them. Each round every part descends from the common model
on its own, ``ROUND`` passes, and the changes are averaged: of an embedding over the parts that changed it, of
the rest by documents. Only the model (8 MB, fixed) passes through the driver. Calibration counts all documents
put aside for it, by class and logit in steps of 1 / ``STEPS``; scoring is a map. Inputs of a score are the
words of the whole text alone. The same rows give the same model, however they are laid out.

Defined cases: a text without words (null, empty, blank, punctuation) is scored, and learned
from, as three empty words; a null ``doc_id`` is not held out and not trained on; of rows that
repeat a labelled ``doc_id`` one is trained on; null labels teach nothing; without both
classes every score is 0.0. The output columns replace input columns of the same names;
all others pass through.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsloom.llm.common import ship, stored
from newsloom.llm.quality_model import platt

ship(__name__)

BUCKETS, DIM, PARTS = 1 << 18, 8, 6
FILTERS = 8                                 # per width
BLOCKS = ((1, 0), (2, 0), (2, 1), (3, 0), (3, 1), (3, 2))    # (width, word of the window)
PART_ROWS, MAX_PARTS = 4000, 256            # more rows make parts larger, which are read as a stream
BLOCK = 1 << 13                             # buckets that are merged together
STEPS = 256
MARKS = 1 << 26
ROUND = 3                                   # passes of a part over its documents between two averages
_WORDS = re.compile(rb"[a-z0-9\x80-\xff]+")
_CACHE = 200_000


def tox_words(text: str | None) -> list[bytes]:
    return _WORDS.findall((text or "").lower().encode("utf-8", "surrogatepass"))


def word_parts(word: bytes) -> list[int]:
    crc = zlib.crc32
    return [
        crc(word, 1) % BUCKETS, crc(word[:3], 2) % BUCKETS, crc(word[:4], 3) % BUCKETS,
        crc(word[:5], 4) % BUCKETS, crc(word[:6], 5) % BUCKETS, crc(word[-4:], 6) % BUCKETS,
    ]


def _sigmoid(z):
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


class Net:
    """Embeddings, filters (one matrix per width and word of the window), output unit."""

    def __init__(self, seed: int = 11):
        rng = np.random.default_rng(seed)
        self.embed = rng.normal(0, 0.02, (BUCKETS, DIM)).astype(np.float32)
        self.filters = rng.normal(0, 0.1, (len(BLOCKS), DIM, FILTERS)).astype(np.float32)
        self.filters[:, 0, :] += np.array([1 / w for w, _ in BLOCKS], np.float32)[:, None] * rng.uniform(0.5, 1, FILTERS).astype(np.float32)
        self.bias = np.full(3 * FILTERS, -0.5, np.float32)
        self.out = np.full(3 * FILTERS, 0.2, np.float32)
        self.rest = np.float32(-1.0)
        self.slope, self.offset = 1.0, 0.0
        self.thresholds: dict[str, float] = {}

    @classmethod
    def of(cls, values: dict) -> Net:
        """A net of its own from the values of one; a broadcast of plain values needs no module where it is read."""
        net = cls.__new__(cls)
        vars(net).update({k: v.copy() if isinstance(v, np.ndarray) else v for k, v in values.items()})
        return net

    def pooled(self, e: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
        """Highest response per filter and where its window begins; e: (words, DIM), padded."""
        best, where = [], []
        for width in (1, 2, 3):
            n = len(e) - width + 1
            response = sum(e[o:o + n] @ self.filters[k] for k, (w, o) in enumerate(BLOCKS) if w == width)
            at = response.argmax(axis=0)
            where.append(at)
            best.append(response[at, np.arange(FILTERS)])
        return np.concatenate(best), where

    def logit(self, e: np.ndarray) -> float:
        return float(np.maximum(self.pooled(e)[0] + self.bias, 0) @ self.out + self.rest)

    def step(self, parts: np.ndarray, y: float, importance: float, rate: float) -> None:
        """One document: forward, then back through the pooled windows."""
        e = self.embed[parts].sum(axis=1)
        best, where = self.pooled(e)
        h = np.maximum(best + self.bias, 0)
        dz = np.float32(importance * (_sigmoid(h @ self.out + self.rest) - y))
        if abs(dz) < 1e-3:
            return
        dh = dz * self.out * (h > 0)
        self.out -= rate * (dz * h + 1e-5 * self.out)
        self.rest -= rate * dz
        self.bias -= rate * dh
        for k, (width, o) in enumerate(BLOCKS):
            g, at = dh[(width - 1) * FILTERS:width * FILTERS], where[width - 1] + o
            de = self.filters[k].T * g[:, None]
            self.filters[k] -= rate * (e[at] * g[:, None]).T
            np.add.at(self.embed, parts[at], (-rate * de)[:, None, :])


class Recent:
    """A row of values for each of the words seen lately, made by ``make`` from a list of words."""

    def __init__(self, make, width: int, kind):
        self.make, self.place = make, {}
        self.rows = np.zeros((_CACHE, width), kind)

    def of(self, words: list[bytes]) -> np.ndarray:
        new = [w for w in dict.fromkeys(words) if w not in self.place]
        if len(self.place) + len(new) > _CACHE:
            self.place.clear()
            new = list(dict.fromkeys(words))
            if len(new) > len(self.rows):
                self.rows = np.zeros((len(new), self.rows.shape[1]), self.rows.dtype)
        if new:
            first = len(self.place)
            self.rows[first:first + len(new)] = self.make(new)
            self.place.update(zip(new, range(first, first + len(new))))
        return self.rows[np.fromiter(map(self.place.__getitem__, words), np.int64, len(words))]


def parts_of(words: list[bytes]) -> np.ndarray:
    return np.array([word_parts(w) for w in words], np.int32)


class Scorer:
    """Embeddings of words seen lately, and the score of a text."""

    def __init__(self, net: Net):
        self.net = net
        self.recent = Recent(lambda words: net.embed[parts_of(words)].sum(axis=1), DIM, np.float32)

    def embedded(self, words: list[bytes]) -> np.ndarray:
        return np.concatenate((self.recent.of(words), np.zeros((max(2, 3 - len(words)), DIM), np.float32)))

    def logit(self, text: str | None) -> float:
        """The highest responses over stretches of the text that overlap by two words: the whole text, in bounded memory."""
        words, best = tox_words(text), None
        for at in range(0, max(1, len(words)), 50_000):
            here = self.net.pooled(self.embedded(words[at:at + 50_002]))[0]
            best = here if best is None else np.maximum(best, here)
        return float(np.maximum(best + self.net.bias, 0) @ self.net.out + self.net.rest)


def best_threshold(p: np.ndarray, y: np.ndarray, n: np.ndarray) -> float:
    """Threshold of the highest F1 over ``n`` rows each, in the middle of the gap it lies in."""
    values, at = np.unique(-p, return_inverse=True)
    hit, every = np.cumsum(np.bincount(at, n * y)), np.cumsum(np.bincount(at, n))
    k = int((2 * hit / (every + hit[-1])).argmax())
    low = -values[k + 1] if k + 1 < len(values) else 0.0
    return round(float(low - values[k]) / 2, 6)


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, max_bytes: int = 16 << 20, epochs: int = 5) -> Net | None:
    """The model; ``max_bytes`` is the text that a task of training holds at once."""
    known = stored(
        labels.where("doc_id is not null and toxic is not null").where(~held_out(F.col("doc_id")))
        .groupBy(F.col("doc_id").cast("long").alias("i")).agg(F.max("toxic").cast("int").alias("y")), "known"
    )
    totals = {r["y"]: r["count"] for r in known.groupBy("y").count().collect()}
    parts = min(MAX_PARTS, -(-sum(totals.values()) // PART_ROWS)) or 1
    texts = docs.select(F.col("doc_id").cast("long").alias("i"), F.col("text").cast("string").alias("t"), F.col("lang").cast("string").alias("g"))
    texts = _marked(texts.where(~held_out(F.col("i"))), known)
    # always the same join, so that what it costs grows with the rows
    rows = texts.join(known.hint("merge"), "i").groupBy("i").agg(F.min_by(F.struct("y", "t", "g"), F.coalesce("t", F.lit(""))).alias("r"))
    rows = rows.select(
        F.pmod(F.xxhash64("i"), F.lit(parts)).cast("int").alias("part"), (F.pmod(F.xxhash64("i", F.lit("calibrate")), F.lit(5)) == 0).alias("hold"),
        "i", "r.y", "r.t", "r.g",
    )
    rows = stored(rows.repartitionById(parts, "part").sortWithinPartitions("part", F.hash("i"), "i"), "labelled")
    found = {(r["hold"], r["y"]): r["count"] for r in rows.groupBy("hold", "y").count().collect()}
    if any(not found.get((True, y), 0) + found.get((False, y), 0) for y in (0, 1)):
        return None
    taught = rows.where("not hold").select("part", "i", "y", "t")
    n0, n1 = (max(1, found.get((False, y), 0)) for y in (0, 1))
    net = Net()
    _start_from_odds(net, taught, n0, n1)
    weight = [min(3.0, (n0 + n1) / (2 * n)) for n in (n0, n1)]
    for first in range(0, epochs, ROUND):
        _descend(net, taught, weight, range(first, min(epochs, first + ROUND)), max_bytes)
    _calibrate(net, rows.where("hold").select("y", "t", "g"), totals.get(1, 0) / max(1, sum(totals.values())))
    return net


def _marked(texts: DataFrame, known: DataFrame) -> DataFrame:
    """Rows of ``texts`` whose id may be known: few texts without a label are shuffled. The marks are ``MARKS`` bits at most."""
    place = F.xxhash64("i").bitwiseAND(F.lit(MARKS - 1))
    word, bit = F.shiftright(place, 6).alias("__word"), place.bitwiseAND(F.lit(63)).cast("int").alias("__bit")
    marks = known.select(word, bit).groupBy("__word").agg(F.expr("bit_or(shiftleft(1L, __bit))").alias("__mask"))
    near = texts.select("*", word, bit).join(F.broadcast(marks), "__word")
    return near.where("shiftrightunsigned(__mask, __bit) & 1 = 1").select(*texts.columns)


def _start_from_odds(net: Net, taught: DataFrame, n0: int, n1: int) -> None:
    """The first dimension of the embeddings: smoothed log-odds of the documents that have a part."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        recent, seen = Recent(parts_of, PARTS, np.int32), np.zeros((BUCKETS, 2), np.int32)
        for batch in batches:
            for y, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                seen[np.unique(recent.of(list(set(tox_words(text.as_py()))))), y] += 1
        yield pa.record_batch(
            [pa.array(range(0, BUCKETS, BLOCK), pa.int32()), pa.array([seen[at:at + BLOCK].tobytes() for at in range(0, BUCKETS, BLOCK)], pa.binary())],
            names=["block", "seen"],
        )

    def add(group: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(v.as_py(), np.int32).astype(np.int64) for v in group.column("seen"))
        return pa.table({"block": group.column("block")[:1], "seen": pa.array([total.tobytes()], pa.binary())})

    form = "block int, seen binary"
    seen = np.zeros((BUCKETS, 2))
    for r in taught.select("y", "t").mapInArrow(count, form).groupBy("block").applyInArrow(add, form).collect():
        seen[r["block"]:r["block"] + BLOCK] = np.frombuffer(r["seen"], np.int64).reshape(-1, 2)
    often = seen.sum(axis=1)
    odds = np.log((seen[:, 1] + 1) / (n1 + 2)) - np.log((seen[:, 0] + 1) / (n0 + 2))
    net.embed[:, 0] = np.clip(odds * np.minimum(1, often / 8) * (often > 1), -3, 3) / PARTS


_REST = ("filters", "bias", "out", "rest")


def _descend(net: Net, taught: DataFrame, weight: list[float], epochs: range, max_bytes: int) -> None:
    """One round: every part goes over its documents from ``net``, whose parameters then move by the mean change."""
    shared = taught.sparkSession.sparkContext.broadcast(vars(net))
    form = "block int, part int, first long, n int, places binary, change binary"

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base, recent = Net.of(shared.value), Recent(parts_of, PARTS, np.int32)

        def begin(part, first):
            return Net.of(shared.value), part, first, np.random.default_rng((epochs.start, part)), [0]

        def teach(state, held):
            mine, _, _, rng, n = state
            for epoch in epochs:
                for k in rng.permutation(len(held)):
                    y, at = held[k]
                    mine.step(at, y, weight[y], 0.05 / (1 + epoch))
            n[0] += len(held)

        def changes(state):
            mine, part, first, _, n = state
            moved = np.flatnonzero((mine.embed != base.embed).any(axis=1))
            out = []
            for at in range(0, BUCKETS, BLOCK):
                here = moved[(moved >= at) & (moved < at + BLOCK)]
                if len(here):
                    out.append((at, here - at, mine.embed[here] - base.embed[here]))
            rest = np.concatenate([np.ravel(getattr(mine, k) - getattr(base, k)) for k in _REST])
            out.append((-1, np.empty(0, int), rest))
            return pa.record_batch([
                pa.array([o[0] for o in out], pa.int32()), pa.array([part] * len(out), pa.int32()), pa.array([first] * len(out), pa.int64()),
                pa.array([n[0]] * len(out), pa.int32()), pa.array([o[1].astype(np.int32).tobytes() for o in out], pa.binary()),
                pa.array([o[2].astype(np.float32).tobytes() for o in out], pa.binary()),
            ], names=["block", "part", "first", "n", "places", "change"])

        state, held, size = None, [], 0
        for batch in batches:
            for part, i, y, text in zip(*(batch.column(k).to_pylist() for k in range(3)), batch.column(3)):
                if state is None or state[1] != part:
                    if state is not None:
                        teach(state, held)
                        yield changes(state)
                    state, held, size = begin(part, i), [], 0
                text = text.as_py()
                words = tox_words(text)
                held.append((y, np.concatenate((recent.of(words), np.zeros((max(2, 3 - len(words)), PARTS), np.int32)))))
                size += len(text or "")
                if size >= max_bytes:
                    teach(state, held)
                    held, size = [], 0
        if state is not None:
            teach(state, held)
            yield changes(state)

    def merge(group: pa.Table) -> pa.Table:
        made = sorted(group.to_pylist(), key=lambda r: (r["part"], r["first"]))
        if made[0]["block"] < 0:
            total = sum(r["n"] for r in made)
            mean = sum(np.frombuffer(r["change"], np.float32) * (r["n"] / total) for r in made)
        else:
            mean, n = np.zeros((BLOCK, DIM)), np.zeros(BLOCK)
            for r in made:
                at = np.frombuffer(r["places"], np.int32)
                mean[at] += np.frombuffer(r["change"], np.float32).reshape(-1, DIM)
                n[at] += 1
            mean /= np.maximum(1, n)[:, None]
        return pa.table({"block": pa.array([made[0]["block"]], pa.int32()), "change": pa.array([mean.astype(np.float32).tobytes()], pa.binary())})

    for r in taught.mapInArrow(learn, form).groupBy("block").applyInArrow(merge, "block int, change binary").collect():
        change, at = np.frombuffer(r["change"], np.float32), 0
        if r["block"] >= 0:
            net.embed[r["block"]:r["block"] + BLOCK] += change.reshape(-1, DIM)
            continue
        for k in _REST:
            old = getattr(net, k)
            setattr(net, k, (old + change[at:at + np.size(old)].reshape(np.shape(old))).astype(np.float32))
            at += np.size(old)
    shared.unpersist()


def _calibrate(net: Net, aside: DataFrame, prior: float) -> None:
    """Slope and offset of the logit, and a threshold for every language with ten documents of each class."""
    shared = aside.sparkSession.sparkContext.broadcast(vars(net))

    def logits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(Net.of(shared.value))
        for batch in batches:
            z = [round(scorer.logit(text.as_py()) * STEPS) for text in batch.column(1)]
            yield pa.record_batch([pa.array(z, pa.int64()), batch.column(0), batch.column(2)], names=["z", "y", "g"])

    counted = stored(aside.mapInArrow(logits, "z long, y int, g string").groupBy("z", "y", "g").agg(F.count("*").alias("n")), "logits")
    # a row per class and step of the logit
    rows = sorted(tuple(r) for r in counted.groupBy("z", "y").agg(F.sum("n")).collect())
    z, y, n = (np.array(c, float) for c in zip(*rows)) if rows else [np.empty(0)] * 3
    if len(set(y)) == 2:
        share = (n * y).sum() / n.sum()
        net.slope, net.offset = platt(z / STEPS, y, n * np.where(y == 1, prior / share, (1 - prior) / (1 - share)))
    slope, offset = net.slope, net.offset

    def best(frame: pd.DataFrame) -> pd.DataFrame:
        n, y = frame.n.to_numpy(float), frame.y.to_numpy(float)
        enough = (n * y).sum() >= 10 and (n * (1 - y)).sum() >= 10
        cut = best_threshold(_sigmoid(slope * frame.z.to_numpy() / STEPS + offset), y, n) if enough else None
        return pd.DataFrame({"g": [frame.g.iloc[0]], "cut": [cut]})

    cuts = counted.where("g is not null").groupBy("g").applyInPandas(best, "g string, cut double").where("cut is not null")
    net.thresholds = {r["g"]: r["cut"] for r in cuts.collect()}
    shared.unpersist()


def score(docs: DataFrame, net: Net | None) -> DataFrame:
    """``docs`` with held_out, score, predicted (score of 0.5 or more), and the language's threshold and verdict."""
    if net is None:
        made = docs.withColumn("score", F.lit(0.0))
    else:
        shared = docs.sparkSession.sparkContext.broadcast(vars(net))

        @F.pandas_udf("double")
        def scores(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            model = Net.of(shared.value)
            scorer = Scorer(model)
            for texts in batches:
                z = np.array([scorer.logit(t) for t in texts], float)
                yield pd.Series(_sigmoid(model.slope * z + model.offset), dtype=float)

        made = docs.withColumn("score", scores.asNondeterministic()(F.col("text").cast("string")))
    limits = net.thresholds if net is not None else {}
    threshold = F.lit(0.5)
    for lang, cut in sorted(limits.items()):
        threshold = F.when(F.col("lang") == lang, F.lit(cut)).otherwise(threshold)
    return made.withColumns({
        "held_out": held_out(F.col("doc_id")), "predicted": (F.col("score") >= 0.5).cast("int"), "threshold": threshold,
    }).withColumn("flagged", F.col("score") >= F.col("threshold"))
