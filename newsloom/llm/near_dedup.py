"""Operator 1: MinHash near-duplicates with sequential Bayesian verification.

1. Every document becomes its set of distinct word shingles, a digest of the set and a
   MinHash signature. Equal sets form a class; only its smallest ``doc_id`` goes on.
2. Signatures are cut into bands; classes that share a band are candidates.
3. Candidates are compared one batch of signature values after another. After each
   batch the posterior of the similarity (uniform prior, binomial matches) is bounded:
   when the probability of reaching the threshold falls below ``miss``, the pair goes.
4. Survivors are confirmed on their full sets.

No bucket is expanded into all of its pairs. In a round every bucket compares its
members with one leader; confirmed links are folded into components, and only members
of different components need further comparison. When few such pairs are left, all of
them are compared, so the components are those of all links between candidates. Two
exact bounds keep that remainder small: a shingle found in one candidate only can be in
no intersection, so ``shared`` (set size less such shingles) bounds every intersection.

Defined cases: null or blank text has an empty set and is linked with nothing; fewer
words than a shingle form one shingle; rows that repeat a ``doc_id`` are one document
(they end up in one component, each keeps its own row; ``one_of_equal_rows`` removes equal
ones); a row without ``doc_id`` takes no part and is kept, with a null component. Other
columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsloom.llm.common import WordHashes, rolling_hashes, ship, stored

ship(__name__)

BANDS, ROWS, BATCH = 36, 5, 30
STAR_ROUNDS = 6
GROUPS = 32


def shingle_set(text: str | None, size: int, hashes: dict) -> np.ndarray:
    """Sorted 64-bit hashes of the distinct shingles of one text."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    return np.unique(rolling_hashes(words, size, hashes))


def _multipliers() -> np.ndarray:
    return np.random.default_rng(20240229).integers(0, 2**64, BANDS * ROWS, np.uint64) | np.uint64(1)


def signature(shingles: np.ndarray, multipliers: np.ndarray) -> np.ndarray:
    """Per hash function the smallest value over the set, upper 32 bits."""
    least = np.full(len(multipliers), 2**64 - 1, np.uint64)
    for at in range(0, len(shingles), 1024):
        np.minimum(least, (shingles[at:at + 1024, None] * multipliers).min(axis=0), out=least)
    return (least >> np.uint64(32)).astype(np.uint32).view(np.int32)


def _features(docs: DataFrame, size: int) -> DataFrame:
    schema = pa.schema([
        ("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("digest", pa.binary()), ("sig", pa.list_(pa.int32())),
    ])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, multipliers = WordHashes(), _multipliers()
        for batch in batches:
            ids, out = batch.column(0).to_pylist(), ([], [], [])
            for text in batch.column(1):
                found = shingle_set(text.as_py(), size, hashes)
                out[0].append(len(found))
                out[1].append(hashlib.blake2b(found.tobytes(), digest_size=16).digest() if len(found) else None)
                out[2].append(signature(found, multipliers) if len(found) else None)
            yield pa.record_batch([pa.array(c, f.type) for c, f in zip((ids, *out), schema)], schema=schema)

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        read, "doc_id long, n_shingles long, digest binary, sig array<int>"
    )


def _sets(docs: DataFrame, size: int) -> DataFrame:
    """(rep, digest, n, sig, shingles) of the documents that are candidates."""
    schema = pa.schema([
        ("rep", pa.int64()), ("n", pa.int64()), ("sig", pa.list_(pa.int32())), ("shingles", pa.list_(pa.int64())),
    ])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, multipliers = WordHashes(), _multipliers()
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                found = [shingle_set(t.as_py(), size, hashes) for t in part.column(1)]
                yield pa.record_batch([
                    part.column(0), pa.array([len(s) for s in found], pa.int64()),
                    pa.array([signature(s, multipliers) for s in found], schema.field("sig").type),
                    pa.array([s.view(np.int64) for s in found], schema.field("shingles").type),
                ], schema=schema)

    return docs.mapInArrow(read, "rep long, n long, sig array<int>, shingles array<long>")


def least_matches(threshold: float, miss: float, batch: int = BATCH, total: int = BANDS * ROWS) -> list[tuple[int, int]]:
    """(compared, matches needed to go on) after each batch.

    With m of n equal values and a uniform prior the similarity is Beta(m+1, n-m+1), so
    P(similarity >= t) is the chance of at most m successes in n+1 trials of chance t.
    """
    bounds = []
    for n in range(batch, total + 1, batch):
        tail, m = 0.0, -1
        while tail < miss:
            m += 1
            tail += comb(n + 1, m) * threshold**m * (1 - threshold) ** (n + 1 - m)
        bounds.append((n, m))
    return bounds


def _plausible(a: Column, b: Column, bounds: list[tuple[int, int]]) -> Column:
    """Both signatures pass every bound, batch after batch; ``and`` stops at the first that fails."""
    def matches(n):
        return F.aggregate(
            F.zip_with(F.slice(a, 1, n), F.slice(b, 1, n), lambda x, y: (x == y).cast("int")), F.lit(0), lambda s, x: s + x
        )
    return reduce(lambda p, q: p & q, [matches(n) >= m for n, m in bounds])


def _confirmed(pairs: DataFrame, near: DataFrame, percent: int, bounds: list[tuple[int, int]]) -> DataFrame:
    """Links among distinct candidate pairs (x, y): Bayesian pruning, then the full sets."""
    sig_x = near.select(F.col("rep").alias("x"), F.col("sig").alias("sig_x"))
    sig_y = near.select(F.col("rep").alias("y"), F.col("sig").alias("sig_y"))
    alive = pairs.join(sig_x, "x").join(sig_y, "y").where(_plausible(F.col("sig_x"), F.col("sig_y"), bounds)).select("x", "y")
    set_x = near.select(F.col("rep").alias("x"), F.col("shingles").alias("set_x"), F.col("n").alias("n_x"))
    set_y = near.select(F.col("rep").alias("y"), F.col("shingles").alias("set_y"), F.col("n").alias("n_y"))
    both = F.size(F.array_intersect("set_x", "set_y"))
    return (
        alive.join(set_x, "x").join(set_y, "y").withColumn("both", both)
        .where(F.col("both") * 100 >= F.lit(percent) * (F.col("n_x") + F.col("n_y") - F.col("both")))
        .select("x", "y")
    )


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of an edge table (x, y): alternating stars until nothing changes.

    Every step is a minimum per node and a join; each round is a written table, and
    only its row count and a checksum come to the driver.
    """
    now, before = stored(edges.where("x <> y").distinct(), "edges"), None
    while True:
        both = now.select("x", "y").union(now.select(F.col("y").alias("x"), F.col("x").alias("y")))
        least = both.groupBy("x").agg(F.min("y").alias("m")).select("x", F.least("x", "m").alias("m"))
        large = both.join(least, "x").where("y > x").select(F.col("y").alias("x"), F.col("m").alias("y"))
        large = large.where("x <> y").distinct().select(F.greatest("x", "y").alias("x"), F.least("x", "y").alias("y"))
        low = large.groupBy("x").agg(F.min("y").alias("m"))
        small = large.join(low, "x")
        after = small.select("x", F.col("m").alias("y")).union(small.where("y <> m").select(F.col("y").alias("x"), F.col("m").alias("y")))
        now = stored(after.distinct(), "edges")
        state = tuple(now.agg(F.count("*"), F.coalesce(F.sum(F.xxhash64("x", "y").cast("decimal(38,0)")), F.lit(0))).first())
        if state == before:
            return now.groupBy(F.col("x").alias("node")).agg(F.min("y").alias("component"))
        before = state


def near_duplicates(
    docs: DataFrame, shingle_words: int = 5, percent: int = 80, miss: float = 1e-6
) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) per document; links have similarity >= percent/100."""
    features = stored(_features(docs, shingle_words), "features")
    # the smallest document of every distinct set
    classes = stored(
        features.where("digest is not null and doc_id is not null")
        .groupBy("digest").agg(F.min("doc_id").alias("rep")),
        "classes",
    )
    reps = features.join(classes, "digest").where("doc_id = rep").select("rep", "sig")
    keys = F.transform(
        F.sequence(F.lit(0), F.lit(BANDS - 1)), lambda b: F.xxhash64(b, F.slice("sig", b * ROWS + 1, ROWS))
    )
    bands = reps.select("rep", F.explode(keys).alias("key"))
    # a bucket with two different documents
    shared = stored(bands.groupBy("key").agg(F.min("rep").alias("lo"), F.max("rep").alias("hi")).where("lo <> hi").select("key"), "keys")
    members = stored(bands.join(shared, "key"), "members")
    links = _links(docs, members, shingle_words, percent, miss)
    named = classes.join(components(links), F.col("rep") == F.col("node"), "left").select(
        "digest", F.coalesce("component", "rep").alias("component")
    )
    return features.select("doc_id", "n_shingles", "digest").join(named, "digest", "left").select(
        "doc_id", "n_shingles",
        F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id")).alias("component_id"),
        F.coalesce(F.col("doc_id") == F.coalesce("component", "doc_id"), F.lit(True)).alias("kept"),
    )


def _links(docs, members, shingle_words, percent, miss) -> DataFrame:
    """Confirmed links (x, y) that have the components of all links between candidates."""
    bounds = least_matches(percent / 100, miss)
    ids = members.select("rep").distinct()
    texts = docs.select(F.col("doc_id").cast("long").alias("rep"), F.col("text").cast("string")).join(ids, "rep", "left_semi")
    raw = stored(_sets(texts, shingle_words), "sets")
    alone = (
        raw.select("rep", F.explode("shingles").alias("s")).groupBy("s")
        .agg(F.count("*").alias("c"), F.min("rep").alias("rep")).where("c = 1")
        .groupBy("rep").agg(F.collect_list("s").alias("alone"))
    )
    near = _shared(raw.join(alone, "rep", "left"))
    near = stored(near.where(F.col("shared") * 100 >= F.lit(percent) * F.col("n")), "near")
    # members that can have a link at all, with what bounds their intersections
    size = near.select("rep", F.col("n").cast("int").alias("n"), F.col("shared").cast("int").alias("shared")).distinct()
    live = stored(members.join(size, "rep"), "live")
    links, component, crossing_before = None, None, None
    for turn in range(STAR_ROUNDS + 1):
        if component is None:
            named = live.withColumn("c", F.col("rep"))
        else:
            named = live.join(component, F.col("rep") == F.col("node"), "left").select(
                "key", "rep", "n", "shared", F.coalesce("component", "rep").alias("c")
            )
        # the leader of a bucket is a member with few shingles of its own, another one in each round
        rank = F.struct(F.floor((F.col("n") - F.col("shared")) * 50 / F.col("n")).alias("own"), F.xxhash64(F.lit(turn), "rep").alias("h"), "rep", "c", "n", "shared")
        mixed = stored(named.groupBy("key").agg(
            F.min("c").alias("lo"), F.max("c").alias("hi"), F.min(rank).alias("lead"),
        ).where("lo <> hi").select("key", "lead"), "mixed")
        opened = stored(named.join(mixed, "key"), "open")
        largest = stored(opened.groupBy("key", "c").agg(F.count("*").alias("k")).groupBy("key").agg(
            F.max(F.struct("k", "c"))["c"].alias("big"), F.sum("k").alias("all"), F.max("k").alias("most")
        ), "largest")
        left, crossing = largest.agg(F.sum("all"), F.sum(F.expr("`all` * (`all` - most)"))).first()
        if not left:
            break
        slow = crossing_before is not None and crossing > 0.7 * crossing_before
        last = turn == STAR_ROUNDS or (turn > 0 and (slow or crossing <= 256 * left))
        crossing_before = crossing if turn else None
        if last:
            pairs = _crossing(opened.drop("lead"), largest.select("key", "big"), near, percent)
        else:
            pairs = opened.select("rep", "c", "n", "shared", *(F.col(f"lead.{c}").alias(f"{c}2") for c in ("rep", "c", "n", "shared")))
            pairs = pairs.where(F.col("c") != F.col("c2")).where(_reachable(F.least("shared", "shared2"), percent))
        pairs = pairs.select(F.least("rep", "rep2").alias("x"), F.greatest("rep", "rep2").alias("y")).distinct()
        found = stored(_confirmed(stored(pairs, "pairs"), near, percent, bounds), "links")
        links = found if links is None else links.union(found)
        if last:
            break
        # a bucket whose members are in one component stays closed
        live = opened.select("key", "rep", "n", "shared")
        component = stored(components(links), "component")
    if links is None:
        links = live.select(F.col("rep").alias("x"), F.col("rep").alias("y")).where("false")
    return links


def _reachable(both: Column, percent: int) -> Column:
    """Whether sets of n and n2 shingles can be similar enough with an intersection of at most ``both``."""
    return both * (100 + percent) >= F.lit(percent) * (F.col("n") + F.col("n2"))


def _shared(rows: DataFrame) -> DataFrame:
    """(rep, n, shared, sig, shingles, hist): shingles that another candidate has too, and their
    number per group of hashes. Sum over groups of the smaller number bounds an intersection."""
    schema = pa.schema([
        ("rep", pa.int64()), ("n", pa.int64()), ("shared", pa.int64()), ("sig", pa.list_(pa.int32())),
        ("shingles", pa.list_(pa.int64())), ("hist", pa.list_(pa.int32())),
    ])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                kept = []
                for has, alone in zip(part.column(2), part.column(3)):
                    has = has.values.to_numpy()
                    kept.append(has if not alone.is_valid else has[~np.isin(has, alone.values.to_numpy())])
                hist = [np.bincount((k.view(np.uint64) % np.uint64(GROUPS)).astype(np.int64), minlength=GROUPS) for k in kept]
                yield pa.record_batch([
                    part.column(0), part.column(1), pa.array([len(k) for k in kept], pa.int64()),
                    *(pa.array(c, f.type) for c, f in zip((part.column(4).to_pylist(), kept, hist), list(schema)[3:])),
                ], schema=schema)

    return rows.select("rep", "n", "shingles", "alone", "sig").mapInArrow(
        read, "rep long, n long, shared long, sig array<int>, shingles array<long>, hist array<int>"
    )


def _crossing(opened: DataFrame, largest: DataFrame, near: DataFrame, percent: int) -> DataFrame:
    """Pairs of one bucket that lie in different components: members outside the bucket's
    largest component, each with all of the others, every pair once. The bounds are part
    of the join's condition, so pairs that cannot be links are never made into rows."""
    rows = opened.join(largest, "key").join(near.select("rep", "hist"), "rep")
    a = stored(rows.where("c <> big").drop("big"), "minority")
    b = stored(rows.select(
        "key", (F.col("c") == F.col("big")).alias("in_big"),
        *(F.col(c).alias(f"{c}2") for c in ("rep", "c", "n", "shared", "hist")),
    ), "others")
    both = F.aggregate(F.zip_with("hist", "hist2", lambda p, q: F.least(p, q)), F.lit(0), lambda s, x: s + x)
    cheap = (F.col("c") != F.col("c2")) & (F.col("in_big") | (F.col("rep") < F.col("rep2"))) & _reachable(F.least("shared", "shared2"), percent)
    return a.withColumnRenamed("key", "k").join(b, (F.col("k") == F.col("key")) & F.when(cheap, _reachable(both, percent)).otherwise(False))


def one_per_group(docs: DataFrame, shingle_words: int = 5, percent: int = 80, miss: float = 1e-6) -> DataFrame:
    """The rows of ``docs`` less those that another document of their group stands for."""
    verdict = near_duplicates(docs, shingle_words, percent, miss)
    gone = verdict.where(~F.col("kept")).select(F.col("doc_id").alias("__gone")).distinct()
    return docs.join(gone, F.col("doc_id").cast("long") == F.col("__gone"), "left_anti")


def one_of_equal_rows(docs: DataFrame) -> DataFrame:
    """One of the rows that are equal in ``doc_id`` and text (the smallest by its columns); rows
    without ``doc_id`` all stay. Only rows whose (doc_id, hash of the text) repeats are grouped
    by their texts, with a combine before the shuffle; all others pass as they are."""
    text = F.xxhash64(F.col("text").cast("string"))
    keyed = docs.where("doc_id is not null").select(F.col("doc_id").alias("__id"), text.alias("__hash"))
    often = stored(keyed.groupBy("__id", "__hash").count().where("count > 1").drop("count"), "repeated")
    if often.isEmpty():
        return docs
    same = (docs["doc_id"] == F.col("__id")) & (text == F.col("__hash"))
    once = docs.join(often, same, "left_semi").groupBy("doc_id", "text").agg(F.min(F.struct(*(F.col(f"`{c}`") for c in docs.columns))).alias("r"))
    return docs.join(often, same, "left_anti").unionByName(stored(once.select("r.*"), "once"))
