"""Operator 11: nearest vectors by inner product, on pruned neighbour graphs.

Vectors are dealt to shards by a hash of their value. In a shard each vector gets one more
coordinate that gives all of them the same norm, so that the largest inner product with a
query is the smallest angle. A directed graph is built on them: a greedy search for every vector on
the graph so far proposes neighbours; of these, by distance, one is kept unless a kept one is closer to
it by the factor ``relax`` than the vector itself is (which keeps diverse edges); the kept ones
are linked back, and a vertex whose list overflows is pruned in the same way. A query walks
each shard with a beam of the best vertices met, which starts at spread-out entry points and
ends when all of the beam has been expanded; what it finds is scored again in double precision on the original
vectors, and the shards' answers are merged.

All searches and prunings are done for many vectors at a time in numpy. The number of shards grows
with the square root of the number of vectors (and so that none has more than
``shard_rows``): graphs stay in a task's memory while the number of graphs per query grows slowly.
Queries reach the shards as rows, in parts of ``query_rows`` at most; nothing is broadcast.

Equal vectors are one vertex, merged in each task before the shuffle and again in the shard; a vertex keeps
the ``k`` + 1 smallest ids, which is all that an answer of ``k`` can use. So a vector that a third of all rows
hold is one vertex.

Defined cases: rows whose id or vector is null, and vectors that are empty, zero or hold a null or non-finite
component, take no part; vectors meet only vectors of the same length. Of rows that repeat an id, equal ones
are one; different vectors under one id are candidates and queries of their own, whose answers are merged by the best
score. Ties go to the smaller id. Other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from newsloom.llm.common import runs, ship, stored

ship(__name__)

DEGREE = 28
BATCH = 512


# ---------------------------------------------------------------- graphs, in numpy

def same_norm(vectors: np.ndarray) -> np.ndarray:
    """Unit vectors with one more coordinate; their products rank as the products of the given ones do."""
    squares = np.einsum("ij,ij->i", vectors, vectors)
    top = squares.max()
    return np.column_stack((vectors / math.sqrt(top), np.sqrt(np.maximum(0, 1 - squares / top)))).astype(np.float32)


def _once(ids: np.ndarray) -> np.ndarray:
    """Rows of ids with repeats replaced by -1; the order changes."""
    ids = np.sort(ids, axis=1)
    ids[:, 1:][ids[:, 1:] == ids[:, :-1]] = -1
    return ids


class Graph:
    """Directed graph over the rows of ``points`` (unit vectors)."""

    def __init__(self, points: np.ndarray, edges: np.ndarray, entries: np.ndarray):
        self.points, self.edges, self.entries = points, edges, entries

    @classmethod
    def build(cls, points: np.ndarray, seed: int = 7, degree: int = DEGREE, relax: float = 1.2) -> Graph:
        rng, n = np.random.default_rng(seed), len(points)
        entries = np.sort(rng.permutation(n)[:max(64, int(2 * math.sqrt(n)))]).astype(np.int32)
        edges = rng.integers(0, n, (n, degree), dtype=np.int32) if n > 1 else np.full((n, degree), -1, np.int32)
        graph = cls(points, edges, entries)
        for beam, factor in ((32, 1.0), (64, relax)):
            order = rng.permutation(n)
            for at in range(0, n, BATCH):
                graph._insert(order[at:at + BATCH], beam, factor)
        return graph

    def _insert(self, rows: np.ndarray, beam: int, factor: float) -> None:
        found, _ = self.search(self.points[rows], beam)
        kept = self._pruned(rows, np.concatenate((found, self.edges[rows]), axis=1), factor)
        self.edges[rows] = kept
        sources, targets = np.repeat(rows, kept.shape[1]), kept.ravel()
        real = targets >= 0
        sources, targets = sources[real], targets[real]
        order = np.argsort(targets, kind="stable")
        sources, targets = sources[order], targets[order]
        heads, first, counts = np.unique(targets, return_index=True, return_counts=True)
        for at in range(0, len(heads), BATCH):
            part = slice(at, at + BATCH)
            wide = np.full((len(heads[part]), counts[part].max()), -1, np.int32)
            places = np.arange(wide.shape[1])
            inside = places < counts[part][:, None]
            wide[inside] = sources[first[part][0]:first[part][-1] + counts[part][-1]]
            wide = np.concatenate((self.edges[heads[part]], wide), axis=1)
            self.edges[heads[part]] = self._pruned(heads[part], wide, factor, lazily=True)

    def _pruned(self, rows: np.ndarray, offered: np.ndarray, factor: float, lazily: bool = False) -> np.ndarray:
        """Neighbours to keep; ``lazily``: all of them where they fit."""
        degree = self.edges.shape[1]
        offered = _once(np.where(offered == rows[:, None], -1, offered))
        near = np.einsum("bkd,bd->bk", self.points[offered], self.points[rows])
        near[offered < 0] = -np.inf
        order = np.argsort(-near, axis=1)[:, :3 * degree]
        offered, near = np.take_along_axis(offered, order, 1), np.take_along_axis(near, order, 1)
        away = 2 - 2 * near                 # squared distances
        out = np.full((len(rows), degree), -1, np.int32)
        fits = (offered >= 0).sum(axis=1) <= degree
        if lazily:
            width = min(degree, offered.shape[1])
            out[fits, :width] = offered[fits, :width]
            rest = np.flatnonzero(~fits)
        else:
            rest = np.arange(len(rows))
        if not len(rest):
            return out
        offered, away = offered[rest], away[rest]
        points = self.points[offered]
        between = (2 - 2 * points @ points.transpose(0, 2, 1)) * np.float32(factor * factor)
        alive, every = offered >= 0, np.arange(len(rest))
        spare, kept = alive.copy(), np.zeros(len(rest), int)
        for k in range(degree):
            first = alive.argmax(axis=1)
            real = alive[every, first]
            if not real.any():
                break
            out[rest[real], k] = offered[real, first[real]]
            kept += real
            spare[every[real], first[real]] = False
            alive &= between[every, first] > away
            alive[every, first] = False
        # room that is left goes to the nearest of the others
        line, place = np.nonzero(spare & (np.cumsum(spare, axis=1) <= (degree - kept)[:, None]))
        out[rest[line], (kept[:, None] + np.cumsum(spare, axis=1) - 1)[line, place]] = offered[line, place]
        return out

    def search(self, queries: np.ndarray, beam: int, step: int = 4) -> tuple[np.ndarray, np.ndarray]:
        """(ids, products) of the ``beam`` best vertices that a walk meets, best first; -1 where there are fewer."""
        n, b = len(self.points), len(queries)
        near = queries @ self.points[self.entries].T
        take = min(beam, near.shape[1])
        best = np.argsort(-near, axis=1)[:, :take]
        ids = np.full((b, beam), -1, np.int32)
        score = np.full((b, beam), -np.inf, np.float32)
        ids[:, :take], score[:, :take] = self.entries[best], np.take_along_axis(near, best, 1)
        done = ids < 0
        met = np.zeros((b, n), bool)
        met[:, self.entries] = True
        rows = np.arange(b)
        while len(rows):
            picks = np.argsort(done[rows], axis=1, kind="stable")[:, :step]
            expand = np.where(np.take_along_axis(done[rows], picks, 1), -1, np.take_along_axis(ids[rows], picks, 1))
            done[rows[:, None], picks] = True
            further = self.edges[expand]
            further[expand < 0] = -1
            further = _once(further.reshape(len(rows), -1))
            further[met[rows[:, None], further]] = -1
            line, place = np.nonzero(further >= 0)
            met[rows[line], further[line, place]] = True
            # rows lose their gaps before products are taken
            new = (further >= 0).sum(axis=1)
            width = max(1, int(new.max()))
            fresh = np.full((len(rows), width), -1, np.int32)
            fresh[np.arange(width) < new[:, None]] = further[line, place]
            product = np.einsum("bkd,bd->bk", self.points[fresh], queries[rows])
            product[fresh < 0] = -np.inf
            all_ids, all_score = np.concatenate((ids[rows], fresh), 1), np.concatenate((score[rows], product), 1)
            all_done = np.concatenate((done[rows], fresh < 0), 1)
            order = np.argsort(-all_score, axis=1, kind="stable")[:, :beam]
            ids[rows], score[rows] = np.take_along_axis(all_ids, order, 1), np.take_along_axis(all_score, order, 1)
            done[rows] = np.take_along_axis(all_done, order, 1)
            rows = rows[~done[rows].all(axis=1)]
        return ids, score


# ---------------------------------------------------------------- vectors as rows

def vectors(table: DataFrame, id_column: str = "vec_id", column: str = "embedding") -> DataFrame:
    """(id, dims, vector): the rows that take part, their vector packed as doubles (floats if the column holds floats)."""
    kind = np.dtype("<f4" if dict(table.dtypes)[column] == "array<float>" else "<f8")

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, dims, packed = [], [], []
            for i, value in zip(batch.column(0).to_pylist(), batch.column(1)):
                inner = value.values
                if i is None or inner is None or inner.null_count or not len(inner):
                    continue
                numbers = inner.to_numpy(zero_copy_only=False).astype(kind, copy=False)
                if np.isfinite(numbers).all() and numbers.any():
                    ids.append(i)
                    dims.append(len(numbers))
                    packed.append((numbers + kind.type(0)).tobytes())       # -0 is 0
            yield pa.record_batch(
                [pa.array(ids, pa.int64()), pa.array(dims, pa.int64()), pa.array(packed, pa.binary())], names=["id", "dims", "vector"]
            )

    numbers = F.col(f"`{column}`") if kind.itemsize == 4 else F.col(f"`{column}`").cast("array<double>")
    return table.select(F.col(f"`{id_column}`").cast("long"), numbers).mapInArrow(pack, "id long, dims long, vector binary")


def _distinct(keep: int, held_rows: int = 1 << 16):
    """Equal vectors of what a task reads as one row with the smallest ids."""
    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def flush():
            yield pa.record_batch(
                [pa.array([d for d, _ in held], pa.int64()), pa.array([v for _, v in held], pa.binary()),
                 pa.array([sorted(set(i))[:keep] for i in held.values()], pa.list_(pa.int64()))],
                names=["dims", "vector", "ids"],
            )

        held: dict[tuple[int, bytes], list[int]] = {}
        for batch in batches:
            for i, dims, vector in zip(*(c.to_pylist() for c in batch.columns)):
                same = held.setdefault((dims, vector), [])
                same.append(i)
                if len(same) > 64 * keep:
                    same[:] = sorted(set(same))[:keep]
            if len(held) >= held_rows:
                yield from flush()
                held = {}
        if held:
            yield from flush()

    return merge


_INDEX = "dims long, shard long, n long, vectors binary, ids array<array<long>>, edges binary, entries binary"
_INDEX_ARROW = pa.schema([
    ("dims", pa.int64()), ("shard", pa.int64()), ("n", pa.int64()), ("vectors", pa.binary()),
    ("ids", pa.list_(pa.list_(pa.int64()))), ("edges", pa.binary()), ("entries", pa.binary()),
])


def _built(keep: int, kind: str):
    """Rows (dims, shard, vector, ids), sorted by the first two, as one index row per shard."""
    def done(key, held):
        dims, shard = key
        points = np.frombuffer(b"".join(held), kind).reshape(len(held), dims)
        graph = Graph.build(same_norm(points.astype(np.float64)))
        values = (
            dims, shard, len(held), points.tobytes(), [sorted(set(i))[:keep] for i in held.values()],
            graph.edges.tobytes(), graph.entries.tobytes(),
        )
        return pa.record_batch([pa.array([v], f.type) for v, f in zip(values, _INDEX_ARROW)], schema=_INDEX_ARROW)

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, {}
        for key, part in runs(batches, 2):
            if key != now:
                if now:
                    yield done(now, held)
                now, held = key, {}
            for vector, ids in zip(part.column(2).to_pylist(), part.column(3).to_pylist()):
                held.setdefault(vector, []).extend(ids)
        if now:
            yield done(now, held)

    return build


class Index:
    """Graphs of all shards, as a stored table with one row per shard."""

    def __init__(self, rows: DataFrame, shards: int, k: int, kind: str):
        self.rows, self.shards, self.k, self.kind = rows, shards, k, kind


def build(points: DataFrame, k: int = 20, shard_rows: int = 500_000, kind: str = "<f4") -> Index:
    """Index of stored ``vectors``."""
    n = points.count()
    shards = max(1, math.ceil(math.sqrt(n / 1024)), math.ceil(n / shard_rows))
    merged = points.mapInArrow(_distinct(k + 1), "dims long, vector binary, ids array<long>")
    dealt = merged.select("dims", F.pmod(F.xxhash64("vector"), F.lit(shards)).cast("long").alias("shard"), "vector", "ids")
    dealt = dealt.repartitionById(shards, F.col("shard").cast("int")).sortWithinPartitions("dims", "shard")
    return Index(stored(dealt.mapInArrow(_built(k + 1, kind), _INDEX), "graphs"), shards, k, kind)


_ASK = ("dims", "shard", "part", "kind", "id", "vector", "n", "ids", "edges", "entries")


def _answers(k: int, beam: int, kind: str):
    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (dims, _, _, is_query), part in runs(batches, 4):
            column = {name: part.column(at) for at, name in enumerate(_ASK)}
            if not is_query:
                exact = np.frombuffer(column["vector"][0].as_buffer(), kind).reshape(-1, dims).astype(np.float64)
                edges = np.frombuffer(column["edges"][0].as_buffer(), np.int32).reshape(len(exact), -1)
                graph = Graph(same_norm(exact), edges, np.frombuffer(column["entries"][0].as_buffer(), np.int32))
                names = column["ids"][0].as_py()
                continue
            for at in range(0, part.num_rows, BATCH):
                ids = column["id"].slice(at, BATCH).to_pylist()
                asked = np.frombuffer(b"".join(column["vector"].slice(at, BATCH).to_pylist()), kind).reshape(-1, dims).astype(np.float64)
                unit = asked / np.linalg.norm(asked, axis=1, keepdims=True)
                met, _ = graph.search(np.column_stack((unit, np.zeros(len(unit)))).astype(np.float32), beam)
                out = []
                for own, query, nodes in zip(ids, asked, met):
                    nodes = nodes[nodes >= 0]
                    score = np.einsum("ij,j->i", exact[nodes], query)
                    found = [(own, i, s) for node, s in zip(nodes.tolist(), score.tolist()) for i in names[node] if i != own]
                    out += sorted(found, key=lambda x: (-x[2], x[1]))[:k]
                schema = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])
                yield pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*out), schema)] if out else [[], [], []], schema=schema)

    return ask


def _upto(n: int) -> Column:
    return F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long"))


def search(index: Index, queries: DataFrame, beam: int = 200, query_rows: int = 100_000) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest of every query in (id, dims, vector), its own id left out."""
    parts = max(1, math.ceil(queries.count() / query_rows))
    null = F.lit(None)
    asked = queries.select(
        "dims", F.explode(_upto(index.shards)).alias("shard"),
        F.pmod(F.xxhash64("id"), F.lit(parts)).cast("long").alias("part"), F.lit(1).alias("kind"), "id", "vector",
        null.cast("long").alias("n"), null.cast("array<array<long>>").alias("ids"), null.cast("binary").alias("edges"),
        null.cast("binary").alias("entries"),
    )
    graphs = index.rows.select(
        "dims", "shard", F.explode(_upto(parts)).alias("part"), F.lit(0).alias("kind"),
        null.cast("long").alias("id"), F.col("vectors").alias("vector"), "n", "ids", "edges", "entries",
    )
    task = (F.col("shard") * parts + F.col("part")).cast("int")
    together = graphs.unionByName(asked).repartitionById(index.shards * parts, task).sortWithinPartitions(*_ASK[:4])
    found = together.mapInArrow(_answers(index.k, beam, index.kind), "query_id long, vec_id long, score double")
    best = found.repartition("query_id").groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    place = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return best.withColumn("rank", place).where(F.col("rank") <= index.k).select("query_id", "rank", "vec_id", "score")


def nearest(table: DataFrame, every: int = 20, k: int = 20, id_column: str = "vec_id", column: str = "embedding", **settings) -> DataFrame:
    """``search`` of the rows whose id is divisible by ``every`` among all others."""
    kind = "<f4" if dict(table.dtypes)[column] == "array<float>" else "<f8"
    points = stored(vectors(table, id_column, column), "vectors")
    return search(build(points, k, kind=kind), points.where(F.col("id") % every == 0), **settings)
