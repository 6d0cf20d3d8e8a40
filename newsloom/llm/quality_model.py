"""Operator 4: document quality by co-training two views.

The text view sees hashed byte pairs and the wording; the metadata view sees language,
source and length of the record and the layout of its page, which the text view does not get. Both
are logistic models, calibrated on held-out labels (a third of them, by id). In every round
each view scores all documents without a label, and of each class the ``per_round`` surest
(in the classes' proportion, by rank over the whole corpus) go to the other view with the label
it gave them; the surer it was, the more they weigh. Rounds end early when nothing new is handed over. At the
end the calibrated views are combined by a logistic model of their log-odds, with weights of 0 or
more, fitted on the held-out labels, and every document is scored.

What learns is bounded: ``max_labelled`` labelled rows, those of lowest hash, and ``per_round`` handed-over rows a
round and view; one task fits the models on their vectors, and only the models, a few kilobytes, and the numbers
of the handed-over rows come to the driver. Who is handed over is not: the views of all rows are written once as
vectors (about 1.6 kB a row before compression) and every row without a label is scored in every round. Scores cover all rows.

Defined cases: null or empty text has zero features and is scored from them; null
metadata are values of their own; null labels teach nothing; rows without an id have no label and
take part as such; rows that repeat an id share its label; without labels of both
kinds every score is 0.5 and nothing is rejected. ``text_score``, ``meta_score``, ``score`` and ``kept`` replace
input columns of these names in ``score`` and ``classify``; other columns pass through, in ``keep_good`` all do.
"""

from __future__ import annotations

import pickle
import zlib
from collections.abc import Iterator
from dataclasses import astuple, dataclass, replace

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsloom.llm.common import replaced, ship, stored, temporary
from newsloom.llm.features import TEXT_DIM, meta_matrix, meta_slots, text_features

ship(__name__)


def _sigmoid(z):
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


@dataclass
class Logistic:
    """Logistic model with its own scaling and a two-number calibration."""
    shift: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    slope: float = 1.0
    offset: float = 0.0

    @classmethod
    def fit(cls, x: np.ndarray, y: np.ndarray, importance: np.ndarray, steps: int = 250, decay: float = 1e-3) -> Logistic:
        """Adam on all rows at once; the last weight is the intercept."""
        shift, scale = x.mean(axis=0), 1 / (x.std(axis=0) + 1e-3)
        z = np.ones((len(x), x.shape[1] + 1), np.float32)
        np.subtract(x, shift, out=z[:, :-1])
        z[:, :-1] *= scale
        w = np.zeros(z.shape[1], np.float32)
        m, v, part = w.copy(), w.copy(), (importance / importance.sum()).astype(np.float32)
        y = y.astype(np.float32)            # else every step would copy z in double precision
        for t in range(1, steps + 1):
            g = z.T @ ((_sigmoid(z @ w) - y) * part) + decay * np.append(w[:-1], 0)
            m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
            w -= 0.05 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-8)
        return cls(shift.astype(np.float32), scale.astype(np.float32), w)

    def raw(self, x: np.ndarray) -> np.ndarray:
        return ((x - self.shift) * self.scale) @ self.weights[:-1] + self.weights[-1]

    def calibrated(self, x: np.ndarray) -> np.ndarray:
        """Calibrated log-odds."""
        return self.slope * self.raw(x) + self.offset

    def calibrate(self, x: np.ndarray, y: np.ndarray) -> None:
        self.slope, self.offset = platt(self.raw(x), y)


def platt(z: np.ndarray, y: np.ndarray, weight: np.ndarray | None = None) -> tuple[float, float]:
    """Slope (0 or more) and offset of a logistic curve through smoothed labels, by Newton steps."""
    weight = np.ones(len(y)) if weight is None else weight
    pos, neg = (weight * (y == 1)).sum(), (weight * (y == 0)).sum()
    goal = np.where(y == 1, (pos + 1) / (pos + 2), 1 / (neg + 2))
    spread = float(z.std()) or 1.0
    x = np.column_stack((z / spread, np.ones(len(z))))
    w = np.zeros(2)
    for _ in range(50):
        p = _sigmoid(x @ w)
        g = x.T @ (weight * (p - goal)) + 1e-6 * w
        h = (x * (weight * p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2)
        step = np.linalg.solve(h, g)
        w -= np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-6:
            break
    return max(0.0, float(w[0])) / spread, float(w[1])


@dataclass
class CoTrained:
    text: Logistic
    meta: Logistic
    mixed: np.ndarray                       # weights of the two log-odds (0 or more), intercept
    share: float                            # of good ones among the labels
    held_out: tuple[float, float, float]    # area under the curve on held-out labels: text view, metadata view, both
    exchanged: tuple = ()                   # per round: labels given to the text view, to the metadata view

    def odds(self, text: np.ndarray, meta: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return self.text.calibrated(text), self.meta.calibrated(meta)

    def score(self, text: np.ndarray, meta: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        a, b = self.odds(text, meta)
        return _sigmoid(a), _sigmoid(b), _sigmoid(a * self.mixed[0] + b * self.mixed[1] + self.mixed[2])


def learn(text: np.ndarray, meta: np.ndarray, y: np.ndarray, weight: np.ndarray, view: np.ndarray, held: np.ndarray) -> CoTrained | None:
    """Both views from labelled rows (``view`` is empty) and from rows handed to ``view``; ``held`` marks labelled rows that only calibrate."""
    known = (view == "") & ~held
    if min(len(set(y[known])), len(set(y[held]))) < 2:
        return None
    models = {}
    for name, x in (("text", text), ("meta", meta)):
        rows = known | (view == name)
        models[name] = Logistic.fit(x[rows], y[rows], weight[rows])
        models[name].calibrate(x[held], y[held])
    odds = np.column_stack((models["text"].calibrated(text[held]), models["meta"].calibrated(meta[held])))
    mixed = combine(odds, y[held])
    scores = (odds[:, 0], odds[:, 1], odds @ mixed[:2])
    return CoTrained(models["text"], models["meta"], mixed, float(y[known].mean()), tuple(area(z, y[held]) for z in scores))


def combine(odds: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Weights of the log-odds, none below 0, and an intercept, through smoothed labels; Newton steps, drawn towards the first view alone."""
    x, prior = np.column_stack((odds, np.ones(len(y)))), np.array([1.0, 0.0, 0.0])
    goal = np.where(y == 1, 1 - 1 / ((y == 1).sum() + 2), 1 / ((y == 0).sum() + 2))
    w, free = prior.copy(), np.ones(3, bool)
    while True:
        for _ in range(30):
            p, z = _sigmoid(x @ w), x[:, free]
            h = (z * (p * (1 - p))[:, None]).T @ z + 1e-2 * np.eye(free.sum())
            w[free] -= np.clip(np.linalg.solve(h, z.T @ (p - goal) + 1e-2 * (w - prior)[free]), -1, 1)
        below = (w < 0) & np.array([True, True, False])
        if not below.any():
            return w
        w[below], free = 0.0, free & ~below


def area(z: np.ndarray, y: np.ndarray) -> float:
    """Area under the curve, ties counted half."""
    good, bad = z[y == 1], np.sort(z[y == 0])
    below = np.searchsorted(bad, good, "left") + np.searchsorted(bad, good, "right")
    return float(below.sum() / (2 * len(good) * len(bad)))


_VECTORS = pa.schema([
    ("row", pa.int64()), ("h", pa.int64()), ("id", pa.int64()), ("y", pa.int32()), ("text", pa.binary()), ("meta", pa.binary()),
])


def _views(docs: DataFrame, chosen: DataFrame) -> DataFrame:
    """Number, hash, id, label (null: none) and the two vectors of every row, written once."""
    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, langs, sources, chars = (batch.column(i).to_pylist() for i in range(4, 8))
            yield pa.record_batch([
                *(batch.column(i).cast(_VECTORS.field(i).type) for i in range(4)),
                pa.array([text_features(t).astype(np.float16).tobytes() for t in texts], pa.binary()),
                pa.array([meta_slots(*m).tobytes() for m in zip(langs, sources, chars, texts)], pa.binary()),
            ], schema=_VECTORS)

    text, lang, source, chars = _inputs()
    plain = docs.select(
        F.monotonically_increasing_id().alias("row"), F.xxhash64(F.col("doc_id").cast("long"), text).alias("h"),
        F.col("doc_id").cast("long").alias("id"), text.alias("text"), lang.alias("lang"), source.alias("source"), chars.alias("chars"),
    )
    rows = plain.join(F.broadcast(chosen), "id", "left").select("row", "h", "id", "y", "text", "lang", "source", "chars")
    return stored(rows.mapInArrow(make, "row long, h long, id long, y int, text binary, meta binary"), "views")


def _matrices(text, meta) -> tuple[np.ndarray, np.ndarray]:
    """Both views of Arrow columns of vectors."""
    texts = np.empty((len(text), TEXT_DIM), np.float32)
    for at, value in enumerate(text):
        texts[at] = np.frombuffer(value.as_buffer(), np.float16)
    slots = [np.frombuffer(value.as_buffer(), np.int16) for value in meta]
    return texts, meta_matrix(np.array(slots, np.int64))


def _inputs():
    return (F.col("text").cast("string"), F.col("lang").cast("string"), F.col("source").cast("string"), F.col("n_chars").cast("long"))


def fit(docs: DataFrame, labels: DataFrame, max_labelled: int = 6000, rounds: int = 3, per_round: int = 500) -> CoTrained | None:
    spark = docs.sparkSession
    chosen = stored(
        labels.where("doc_id is not null and quality is not null")
        .groupBy(F.col("doc_id").cast("long").alias("id")).agg(F.min("quality").cast("int").alias("y"))
        .orderBy(F.xxhash64("id"), "id").limit(max_labelled), "chosen",
    )
    views = _views(docs, chosen)
    labelled = views.where("y is not null").orderBy(F.xxhash64("id"), "h", "row").limit(max_labelled)
    taught = stored(labelled.select("id", "y", F.lit("").alias("view"), F.lit(1.0).alias("weight"), "text", "meta"), "labelled")
    model, given, exchanged = _learned(taught), [], []
    for _ in range(rounds if model else 0):
        new = _surest(views, model, given, per_round)
        if not new:
            break                           # nothing new to learn from: a further round would fit the same models
        given += new
        exchanged.append(tuple(sum(g.view == name for g in new) for name in ("text", "meta")))
        named = spark.createDataFrame([tuple(g) for g in new], "row long, view string, y int, weight double")
        taught = taught.unionByName(stored(views.drop("y").join(F.broadcast(named), "row").select(taught.columns), "given"))
        model = _learned(taught)
    return replace(model, exchanged=tuple(exchanged)) if model else None


def _surest(views: DataFrame, model: CoTrained, given: list, per_round: int) -> list:
    """(row, the view to be taught, label, weight): of all rows without a label, those each view is surest of, per
    class at most the class's share of ``per_round``, without those the other view was given before."""
    spark, good = views.sparkSession, int(per_round * model.share)
    shared = spark.sparkContext.broadcast(model)

    def odds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                made = shared.value.odds(*_matrices(batch.column(2), batch.column(3)))
                yield pa.record_batch([*batch.columns[:2], *(pa.array(z, pa.float64()) for z in made)], names=["row", "h", "text", "meta"])

    free = views.where("y is null").select("row", "h", "text", "meta")
    scored = stored(free.mapInArrow(odds, "row long, h long, text double, meta double"), "odds")
    seen = spark.createDataFrame([(g.row, g.view) for g in given], "row long, view string")
    parts = None
    for giver, to in (("text", "meta"), ("meta", "text")):
        left = scored.join(F.broadcast(seen.where(F.col("view") == to)), "row", "left_anti").select("row", "h", F.col(giver).alias("z"))
        for y, most, order in ((1, good, -F.col("z")), (0, per_round - good, F.col("z"))):
            best = left.where("z > 0" if y else "z < 0").orderBy(order, "h", "row").limit(most).select(
                "row", F.lit(to).alias("view"), F.lit(y).alias("y"), (0.3 * F.tanh(F.abs("z") / 2)).alias("weight")
            )
            parts = best if parts is None else parts.union(best)
    return sorted(parts.collect())


def _learned(taught: DataFrame) -> CoTrained | None:
    made = taught.coalesce(1).mapInArrow(_fit_rows, "model binary").head()
    if made is None:
        return None
    text, meta, *rest = pickle.loads(made["model"])
    return CoTrained(Logistic(*text), Logistic(*meta), *rest)


def _fit_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The model of all vectors, as a pickled tuple; no row if there is nothing to learn."""
    batches = [b for b in batches if b.num_rows]
    if not batches:
        return
    rows = pa.Table.from_batches(batches)
    y, weight, view = (rows[name].to_numpy() for name in ("y", "weight", "view"))
    held = np.array([v == "" and zlib.crc32(str(i).encode()) % 3 == 0 for v, i in zip(view, rows["id"].to_pylist())])
    model = learn(*_matrices(rows["text"], rows["meta"]), y.astype(float), weight, view, held)
    if model is not None:
        yield pa.record_batch([pa.array([pickle.dumps(astuple(model))], pa.binary())], names=["model"])


NAMES = ("text_score", "meta_score", "score")


def _scores(docs: DataFrame, model: CoTrained | None):
    """A struct of the three scores, as a column of ``docs``."""
    if model is None:
        return F.struct(*(F.lit(0.5).alias(n) for n in NAMES))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("text_score double, meta_score double, score double")
    def scores(text, lang, source, chars):
        out = []
        for at in range(0, len(text), 512):
            cut = slice(at, at + 512)
            made = shared.value.score(
                np.stack([text_features(t) for t in text[cut]]),
                meta_matrix(np.stack([
                    meta_slots(*(None if v is None or v != v else v for v in m))
                    for m in zip(lang[cut], source[cut], chars[cut], text[cut])
                ])),
            )
            out.append(np.column_stack(made))
        return pd.DataFrame(np.vstack(out) if out else np.empty((0, 3)), columns=list(NAMES)).astype(float)

    return scores.asNondeterministic()(*_inputs())


def score(docs: DataFrame, model: CoTrained | None) -> DataFrame:
    """``docs`` with text_score, meta_score and score: how likely the document is good."""
    made = temporary("scores")
    scored = docs.withColumn(made, _scores(docs, model))
    return replaced(scored, *NAMES).select("*", *(F.col(f"{made}.{n}") for n in NAMES)).drop(made)


def classify(docs: DataFrame, labels: DataFrame, reject_below: float = 0.3) -> DataFrame:
    """All rows with their scores and ``kept``."""
    return replaced(score(docs, fit(docs, labels)), "kept").withColumn("kept", F.col("score") >= reject_below)


def keep_good(docs: DataFrame, labels: DataFrame, reject_below: float = 0.3) -> DataFrame:
    """The rows that are not rejected, with their columns as they were."""
    made = temporary("scores")
    return docs.withColumn(made, _scores(docs, fit(docs, labels))).where(F.col(f"{made}.score") >= reject_below).drop(made)
