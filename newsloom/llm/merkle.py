"""Operator 12: a Merkle manifest of a dataset, with a proof for every row.

A row's leaf is a hash over its fields. Within a group (the language) leaves stand in the order
of ``doc_id``; neighbours are hashed in twos, a last one alone, until one node, the group's
subroot, is left. The subroots, in the order of the groups, make the root in the same way.

Places come from rank queries, not from a sort. Ids are cut into containers of 1,024; each task
turns the ids it reads into compressed containers (a list of offsets, or a bitmap where that
is smaller), which are merged by group and container. A container's directory holds the
number of ids before each of its 64-bit words; the numbers of ids before each container are
summed radix by radix (16 bits at a time), so that no window sees more than 65,536 rows. A leaf's place is
the count before its container, plus that before its word, plus a popcount.

Levels are reduced in blocks: a block is the array of 1,024 neighbouring slots of a group,
filled by slot number, and ten levels of the tree are computed in it. The nodes of all
blocks are the slots of the next tier. Proofs go the other way: the path of a block's
node, found in the tier above, is appended to the paths inside the block.

Nothing grows with a group: a task holds one container or one block at a time. The driver
learns the number of tiers and the root.

Defined cases: a null field is ``-``. Rows without ``doc_id`` come first in their group. Rows that
share a ``doc_id``, or have none, are ordered by leaf; those rows alone are put in order by
a range-partitioned sort, inside the place that the rank query gives to their id. Equal
rows are leaves of their own. A null group is a group, the first. An empty table has no rows and no root. Columns
that are not fields are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from newsloom.llm.common import runs, ship, stored
from newsloom.operators.numbering import number_rows

ship(__name__)

ID_BITS = 10                                # ids of a container, as a power of two
BLOCK_BITS = 10                             # slots of a block, as a power of two
IDS, SLOTS = 1 << ID_BITS, 1 << BLOCK_BITS
FLUSH = 1 << 20                             # ids that a task turns into containers at once
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def leaf_of(values: list[Column]) -> Column:
    """SHA-256 over all fields, 32 bytes: ``-`` for null, else length in bytes, colon, value."""
    parts = []
    for value in values:
        text = value.cast("string")
        parts.append(F.when(text.isNull(), "-").otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text)))
    return F.unhex(F.sha2(F.concat(*parts), 256))


# ---------------------------------------------------------------- containers of ids

def packed_ids(low: np.ndarray) -> bytes:
    """Sorted distinct offsets, as two-byte numbers or as a bitmap."""
    if 2 * len(low) < IDS // 8:
        return low.astype("<u2").tobytes()
    bits = np.zeros(IDS, np.uint8)
    bits[low] = 1
    return np.packbits(bits, bitorder="little").tobytes()


def unpacked_ids(packed: bytes) -> np.ndarray:
    if len(packed) < IDS // 8:
        return np.frombuffer(packed, "<u2").astype(np.int64)
    return np.flatnonzero(np.unpackbits(np.frombuffer(packed, np.uint8), bitorder="little"))


class Directory:
    """Rank queries on one container. ``extra`` are further rows of ids that occur more than once."""

    def __init__(self, packed: bytes, repeated: bytes, extra: bytes):
        bits = np.zeros(IDS, np.uint8)
        bits[unpacked_ids(packed)] = 1
        self.words = np.packbits(bits, bitorder="little").view("<u8")
        self.before = np.concatenate(([0], np.cumsum(np.bitwise_count(self.words), dtype=np.int64)))
        self.repeated = np.frombuffer(repeated, "<u2")
        self.extra = np.concatenate(([0], np.cumsum(np.frombuffer(extra, "<i8"), dtype=np.int64)))

    def rank(self, low: np.ndarray) -> np.ndarray:
        """Number of rows whose id is smaller."""
        word, bit = low >> 6, (low & 63).astype(np.uint64)
        below = np.bitwise_count(self.words[word] & ((np.uint64(1) << bit) - np.uint64(1))).astype(np.int64)
        return self.before[word] + below + self.extra[np.searchsorted(self.repeated, low)]


_CONTAINER = "g long, chunk long, packed binary, repeated binary, extra binary"
_CONTAINER_ARROW = pa.schema([
    ("g", pa.int64()), ("chunk", pa.int64()), ("packed", pa.binary()), ("repeated", pa.binary()), ("extra", pa.binary()),
])


def _container(g: int, chunk: int, low: np.ndarray, counts: np.ndarray) -> tuple:
    more = counts > 1
    return g, chunk, packed_ids(low), low[more].astype("<u2").tobytes(), (counts[more] - 1).astype("<i8").tobytes()


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


def _containers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What one task has read, as containers."""
    def flush():
        g, ids = (np.concatenate(x) for x in zip(*held))
        order = np.lexsort((ids, g))
        g, ids = g[order], ids[order]
        first = np.flatnonzero(np.concatenate(([True], (g[1:] != g[:-1]) | (ids[1:] != ids[:-1]))))
        counts = np.diff(np.append(first, len(ids)))
        g, ids = g[first], ids[first]
        chunk = ids >> ID_BITS
        starts = np.flatnonzero(np.concatenate(([True], (g[1:] != g[:-1]) | (chunk[1:] != chunk[:-1]))))
        rows = [
            _container(int(g[a]), int(chunk[a]), ids[a:b] & (IDS - 1), counts[a:b])
            for a, b in zip(starts, np.append(starts[1:], len(ids)))
        ]
        for at in range(0, len(rows), 4096):
            yield _batch(rows[at:at + 4096], _CONTAINER_ARROW)

    held, n = [], 0
    for batch in batches:
        if batch.num_rows:
            held.append((batch.column(0).to_numpy(), batch.column(1).to_numpy()))
            n += batch.num_rows
        if n >= FLUSH:
            yield from flush()
            held, n = [], 0
    if held:
        yield from flush()


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Containers of the same group and range, sorted together, as one; ``n`` counts its rows."""
    schema = _CONTAINER_ARROW.append(pa.field("n", pa.int64()))
    now, counts, rows = None, None, []

    def done():
        low = np.flatnonzero(counts)
        return [(*_container(*now, low, counts[low]), int(counts.sum()))] if now else []

    for key, part in runs(batches, 2):
        if key != now:
            rows += done()
            now, counts = key, np.zeros(IDS, np.int64)
        for packed, repeated, extra in zip(*(part.column(k).to_pylist() for k in (2, 3, 4))):
            counts[unpacked_ids(packed)] += 1
            counts[np.frombuffer(repeated, "<u2")] += np.frombuffer(extra, "<i8")
        if len(rows) >= 4096:
            yield _batch(rows, schema)
            rows = []
    if rows := rows + done():
        yield _batch(rows, schema)


def id_directory(rows: DataFrame) -> DataFrame:
    """Containers of (g, doc_id) with ``base``, the number of rows of the group before each."""
    known = rows.where("doc_id is not null").select("g", "doc_id").mapInArrow(_containers, _CONTAINER)
    merged = known.repartition("g", "chunk").sortWithinPartitions("g", "chunk").mapInArrow(_merged, _CONTAINER + ", n long")
    merged = stored(merged, "containers")
    digits = [F.shiftright("chunk", 16 * k).alias(f"d{k}") for k in range(4)]
    sums = merged.select("g", "n", *digits)
    # d0 is the container; rows before it under the same d1, then of earlier d1 under the same d2, and so on
    base = merged.select("g", "chunk", "packed", "repeated", "extra", *digits)
    total = F.lit(0).cast("long")
    for k in range(4):
        level = sums.groupBy("g", *(f"d{j}" for j in range(k, 4))).agg(F.sum("n").alias("n"))
        place = Window.partitionBy("g", *(f"d{j}" for j in range(k + 1, 4))).orderBy(f"d{k}")
        level = level.select("g", *(f"d{j}" for j in range(k, 4)), (F.sum("n").over(place) - F.col("n")).alias(f"before{k}"))
        base = base.join(level, ["g", *(f"d{j}" for j in range(k, 4))])
        total = total + F.col(f"before{k}")
    unnamed = rows.where("doc_id is null").groupBy("g").agg(F.count("*").alias("unnamed"))
    base = base.join(unnamed, "g", "left").withColumn("base", total + F.coalesce("unnamed", F.lit(0)))
    return stored(base.select("g", "chunk", "packed", "repeated", "extra", "base"), "directory")


def _repeated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(g, doc_id, first): ids of several rows and the place of their first one."""
    for batch in batches:
        out = []
        for g, chunk, packed, repeated, extra, base in zip(*(c.to_pylist() for c in batch.columns)):
            low = np.frombuffer(repeated, "<u2").astype(np.int64)
            at = base + Directory(packed, repeated, extra).rank(low)
            out += [(g, (chunk << ID_BITS) + int(i), int(p)) for i, p in zip(low, at)]
        if out:
            yield _batch(out, pa.schema([("g", pa.int64()), ("doc_id", pa.int64()), ("first", pa.int64())]))


def _ranked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Slots of the rows behind each directory row."""
    directory = base = None
    for _, part in runs(batches, 3):
        packed, repeated, extra = (part.column(k)[0].as_py() for k in (3, 4, 5))
        if packed is not None:
            directory, base = Directory(packed, repeated, extra), part.column(6)[0].as_py()
            continue
        slot = base + directory.rank(part.column(7).to_numpy() & (IDS - 1))
        yield pa.record_batch(
            [part.column(0), pa.array(slot, pa.int64()), part.column(7), part.column(8), part.column(9)],
            names=["g", "slot", "doc_id", "leaf", "found"],
        )


def _joined(batches: Iterator[pa.RecordBatch], rows: int = 4096) -> Iterator[pa.RecordBatch]:
    """Small batches put together."""
    held, n = [], 0
    for batch in batches:
        held.append(batch)
        n += batch.num_rows
        if n >= rows:
            yield pa.concat_batches(held)
            held, n = [], 0
    if held:
        yield pa.concat_batches(held)


def _ranked_batches(batches):
    return _joined(_ranked(batches))


def slots(rows: DataFrame) -> DataFrame:
    """(g, slot, doc_id, leaf, found): rows with their place in the group, from 0."""
    directory = id_directory(rows)
    several = stored(directory.mapInArrow(_repeated, "g long, doc_id long, first long"), "several")
    marked = rows.join(several, ["g", "doc_id"], "left")
    tied = marked.where("first is not null or doc_id is null").select(
        "g", "doc_id", F.coalesce("first", F.lit(0)).cast("long").alias("first"), "leaf", "found",
        F.monotonically_increasing_id().alias("at"),
    )
    placed = number_rows(tied, "g", "first", "leaf", "found", "at")
    before = placed.groupBy("g", "first").agg(F.min("rn").alias("start"))
    tied_slots = placed.join(before, ["g", "first"]).select(
        "g", (F.col("first") + F.col("rn") - F.col("start")).alias("slot"), "doc_id", "leaf", "found"
    )
    null = F.lit(None)
    queries = marked.where("first is null and doc_id is not null").select(
        "g", F.shiftright("doc_id", ID_BITS).alias("chunk"), F.lit(1).alias("kind"), *(null.cast("binary").alias(c) for c in ("packed", "repeated", "extra")),
        null.cast("long").alias("base"), "doc_id", "leaf", "found",
    )
    heads = directory.select(
        "g", "chunk", F.lit(0).alias("kind"), "packed", "repeated", "extra", "base", null.cast("long").alias("doc_id"),
        null.cast("binary").alias("leaf"), null.cast("binary").alias("found"),
    )
    together = heads.unionByName(queries).repartition("g", "chunk").sortWithinPartitions("g", "chunk", "kind")
    return together.mapInArrow(_ranked_batches, "g long, slot long, doc_id long, leaf binary, found binary").unionByName(tied_slots)


# ---------------------------------------------------------------- the tree

def parent(nodes: list[str]) -> str:
    """Digest over the digests of one or two nodes, as hex text."""
    return hashlib.sha256("".join(nodes).encode()).hexdigest()


def reduced(nodes: list[str], levels: int) -> list[list[str]]:
    """The levels of a block, the given one first."""
    out = [nodes]
    for _ in range(levels):
        nodes = [parent(nodes[i:i + 2]) for i in range(0, len(nodes), 2)]
        out.append(nodes)
    return out


def levels_of(n: int) -> int:
    """Levels that a block computes in a tier of ``n`` nodes."""
    return min(BLOCK_BITS, (n - 1).bit_length())


# A step of a path: 0, no sibling; 1 or 2 and 32 bytes, a sibling to the left or to the right.
def local_path(tree: list[list[str]], at: int) -> bytes:
    steps = []
    for nodes in tree[:-1]:
        beside = at ^ 1
        steps.append(b"\0" if beside >= len(nodes) else (b"\1" if at & 1 else b"\2") + bytes.fromhex(nodes[beside]))
        at >>= 1
    return b"".join(steps)


def steps_of(path: bytes) -> Iterator[tuple[int, str]]:
    at = 0
    while at < len(path):
        side = path[at]
        yield side, path[at + 1:at + 33].hex() if side else ""
        at += 33 if side else 1


def fold(leaf: str, path: bytes) -> str:
    """The root that a leaf and the siblings on its way give."""
    for side, sibling in steps_of(path):
        leaf = parent([leaf] if not side else [sibling, leaf] if side == 1 else [leaf, sibling])
    return leaf


_BLOCK = "g long, block long, n long, ids array<long>, leaves binary, found binary, node binary"
_BLOCK_ARROW = pa.schema([
    ("g", pa.int64()), ("block", pa.int64()), ("n", pa.int64()), ("ids", pa.list_(pa.int64())),
    ("leaves", pa.binary()), ("found", pa.binary()), ("node", pa.binary()),
])


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (g, block, n, slot, doc_id, leaf, found), sorted by the first two, as arrays by slot."""
    def done():
        top = reduced([x.tobytes().hex() for x in leaves[:size]], levels_of(now[2]))[-1][0]
        return now[0], now[1], now[2], ids[:size], leaves[:size].tobytes(), found[:size].tobytes() if changed else None, bytes.fromhex(top)

    now, rows, held = None, [], 0
    for key, part in runs(batches, 3):
        if key != now:
            if now:
                rows.append(done())
            now, ids, changed = key, [None] * SLOTS, False
            size = min(SLOTS, key[2] - key[1] * SLOTS)
            leaves, found = np.zeros((SLOTS, 32), np.uint8), np.zeros((SLOTS, 32), np.uint8)
        at = part.column(3).to_numpy() & (SLOTS - 1)
        for i, name, leaf, other in zip(at.tolist(), *(part.column(k).to_pylist() for k in (4, 5, 6))):
            ids[i], leaves[i] = name, np.frombuffer(leaf, np.uint8)
            if other is not None:
                found[i], changed = np.frombuffer(other, np.uint8), True
        if len(rows) >= 64:
            yield _batch(rows, _BLOCK_ARROW)
            rows = []
    if now:
        rows.append(done())
        yield _batch(rows, _BLOCK_ARROW)


def tree(rows: DataFrame, sizes: DataFrame, most: int) -> tuple[list[DataFrame], DataFrame]:
    """Blocks of every tier over (g, slot, doc_id, leaf, found), and (g, node): the top of each group.

    ``sizes``: (g, n); ``most``: the largest n.
    """
    tiers, tops = [], None
    while True:
        sized = rows.join(sizes, "g").select("g", F.shiftright("slot", BLOCK_BITS).alias("block"), "n", "slot", "doc_id", "leaf", "found")
        blocks = stored(sized.repartition("g", "block").sortWithinPartitions("g", "block").mapInArrow(_blocks, _BLOCK), "blocks")
        tiers.append(blocks)
        ended = blocks.where(F.col("n") <= SLOTS).select("g", "node")
        tops = ended if tops is None else tops.unionByName(ended)
        if most <= SLOTS:
            return tiers, tops
        rows = blocks.where(F.col("n") > SLOTS).select(
            "g", F.col("block").alias("slot"), F.lit(None).cast("long").alias("doc_id"), F.col("node").alias("leaf"), F.lit(None).cast("binary").alias("found")
        )
        sizes = sizes.where(F.col("n") > SLOTS).select("g", F.ceil(F.col("n") / SLOTS).alias("n"))
        most = -(-most // SLOTS)


def _leaves_hex(blob: bytes) -> list[str]:
    return [blob[i:i + 32].hex() for i in range(0, len(blob), 32)]


_PATH = "g long, slot long, path binary"


def _paths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(g, slot, path) of the nodes in blocks (g, block, n, leaves, path of the block's node)."""
    schema = pa.schema([("g", pa.int64()), ("slot", pa.int64()), ("path", pa.binary())])
    for batch in batches:
        for g, block, n, blob, above in zip(*(c.to_pylist() for c in batch.columns)):
            levels = reduced(_leaves_hex(blob), levels_of(n))
            yield _batch([(g, block * SLOTS + i, local_path(levels, i) + above) for i in range(len(levels[0]))], schema)


def _proofs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([
        ("g", pa.int64()), ("slot", pa.int64()), ("doc_id", pa.int64()), ("leaf", pa.string()), ("path", pa.binary()),
        ("proof_sha256", pa.string()), ("folded_root", pa.string()),
    ])
    for batch in batches:
        for g, block, n, ids, blob, other, above in zip(*(c.to_pylist() for c in batch.columns)):
            leaves = _leaves_hex(blob)
            seen = _leaves_hex(other) if other is not None else [""] * len(leaves)
            levels, rows = reduced(leaves, levels_of(n)), []
            for i, (leaf, now) in enumerate(zip(leaves, seen)):
                path = local_path(levels, i) + above
                siblings = "".join(s for _, s in steps_of(path))
                start = now if now.strip("0") else leaf
                rows.append((g, block * SLOTS + i, ids[i], leaf, path, hashlib.sha256(siblings.encode()).hexdigest(), fold(start, path)))
            yield _batch(rows, schema)


def paths(tiers: list[DataFrame], above: DataFrame | None = None) -> DataFrame:
    """(g, block, path): for every block of the first tier the path from its node to the top, then ``above`` (g, path)."""
    known = None
    for tier in range(len(tiers) - 1, -1, -1):
        tops = tiers[tier].where(F.col("n") <= SLOTS).select("g", "block")
        tops = tops.withColumn("path", F.lit(b"")) if above is None else tops.join(above, "g")
        known = tops if known is None else known.unionByName(tops)
        if tier:
            inside = tiers[tier].join(known, ["g", "block"]).select("g", "block", "n", "leaves", "path")
            known = stored(inside.mapInArrow(_paths, _PATH), "paths").withColumnRenamed("slot", "block")
    return known


_PROOF = (
    "lang string, slot long, doc_id long, leaf string, path binary, subroot string, root string, proof_sha256 string, "
    "folded_root string, verified boolean"
)


def proofs(docs: DataFrame, found: dict[str, Column] | None = None, group: str = "lang") -> DataFrame:
    """(lang, slot, doc_id, leaf, path, subroot, root, proof_sha256, folded_root, verified) of every row.

    ``found`` names fields as they are met at verification, where that differs from what the
    manifest was built on; only rows in which such a field differs are hashed twice.
    """
    spark = docs.sparkSession
    own, other = [F.col(f"`{c}`") for c in FIELDS], [(found or {}).get(c, F.col(f"`{c}`")) for c in FIELDS]
    differs = F.lit(False)
    for c, a, b in zip(FIELDS, own, other):
        if c in (found or {}):
            differs = differs | ~a.eqNullSafe(b)
    rows = stored(docs.select(
        F.col(f"`{group}`").cast("string").alias("lang"), F.col("doc_id").cast("long").alias("doc_id"),
        leaf_of(own).alias("leaf"), F.when(differs, leaf_of(other)).alias("found"),
    ), "leaves")
    named = rows.groupBy("lang").agg(F.count("*").alias("n"))
    groups = stored(number_rows(named, "lang", rn="g"), "groups")
    # a null group joins under a flag, so that the join stays an equality
    key = [F.coalesce("lang", F.lit("")).alias("name"), F.col("lang").isNull().alias("none")]
    rows = rows.select("doc_id", "leaf", "found", *key).join(groups.select("g", *key), ["name", "none"]).select("g", "doc_id", "leaf", "found")
    most = groups.agg(F.max("n").alias("most"), F.count("*").alias("groups")).first()
    tiers, tops = tree(slots(rows), groups.select("g", "n"), most.most or 0)
    tops = stored(tops, "tops")
    upper = stored(tops.select(
        F.lit(0).cast("long").alias("g"), (F.col("g") - 1).alias("slot"), F.col("g").alias("doc_id"), F.col("node").alias("leaf"),
        F.lit(None).cast("binary").alias("found"),
    ), "subroots")
    roots, root = tree(upper, upper.groupBy("g").agg(F.count("*").alias("n")), most.groups)
    summit = root.first()
    if summit is None:
        return spark.createDataFrame([], _PROOF)
    ways = paths(roots).join(roots[0], ["g", "block"]).select("g", "block", "n", "leaves", "path").mapInArrow(_paths, _PATH)
    ways = stored(ways, "ways").select((F.col("slot") + 1).alias("g"), "path")
    low = tiers[0].join(paths(tiers, ways), ["g", "block"]).select("g", "block", "n", "ids", "leaves", "found", "path")
    made = low.mapInArrow(_proofs, "g long, slot long, doc_id long, leaf string, path binary, proof_sha256 string, folded_root string")
    tips = groups.select("g", "lang").join(tops.select("g", F.lower(F.hex("node")).alias("subroot")), "g")
    return made.join(tips, "g").withColumn("root", F.lit(summit["node"].hex())).select(
        "lang", "slot", "doc_id", "leaf", "path", "subroot", "root", "proof_sha256", "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"),
    )
