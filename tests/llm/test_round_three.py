"""Nearest vectors, Merkle manifest and importance resampling against plain versions."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from newsloom.llm import graph_index, importance, merkle, packing, substring_dedup, toxicity
from newsloom.llm import queries as llm
from tests.check import connect, difference
from tests.conftest import DATA

SF = f"{DATA}/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.mark.parametrize("name", ["op12_merkle_manifest", "op13_importance_resampling"])
def test_equals_sql(spark, name):
    assert difference(llm.QUERIES[name](spark, SF), connect(SF), llm.SQL[name]) is None


# ---------------------------------------------------------------- 13

def words_of(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def runs_of(text, longest):
    w = words_of(text)
    return [zlib.crc32(" ".join(w[i:i + k]).encode()) for k in range(1, longest + 1) for i in range(len(w) - k + 1)]


@pytest.mark.parametrize("piece", [1 << 20, 1, 7, 40])
def test_crcs_of_runs(monkeypatch, piece):
    monkeypatch.setattr(importance, "PIECE", piece)
    rng = random.Random(piece)
    for longest in (1, 2, 4):
        for size in (0, 1, 5, 40, 300):
            text = "".join(rng.choice("ab Z9é\n\t.ß`{ 漢\x1c") for _ in range(size))
            got = list(importance.feature_crcs(text, longest))
            assert sorted(int(c) for _, part in got for c in part) == sorted(runs_of(text, longest))
            assert sum(n for n, _ in got) == len(words_of(text))


def test_crc_of_long_words():
    text = "x" * 5000 + " " + "y" * 70000
    assert [int(c) for _, part in importance.feature_crcs(text, 2) for c in part] == runs_of(text, 2)
    assert list(importance.feature_crcs(None)) == []


def drawn(rows, target, longest, buckets, min_words, percent):
    found = [(i, [c % buckets for c in runs_of(t, longest)], len(words_of(t))) for i, t in rows]
    s = Counter(b for _, bs, _ in found for b in bs)
    t = Counter(c % buckets for x in target for c in runs_of(x, longest))
    total_s, total_t = sum(s.values()), sum(t.values())
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * (total_s + buckets) / ((s[b] + 1) * (total_t + buckets))))
    out = []
    for i, bs, n in found:
        weight, score = sum(map(gain, bs)), None
        if i is not None:
            h = int(hashlib.sha256(f"2024:{i}".encode()).hexdigest()[:8], 16)
            score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append((i, n, len(bs), weight, score))
    fits = sorted((r for r in out if r[1] >= min_words and r[4] is not None), key=lambda r: (-r[4], r[0], r[2], r[3]))
    ranks = Counter()
    places = {}
    for place, r in enumerate(fits[:len(fits) * percent // 100], 1):
        places.setdefault(r, []).append(place)
    for r in out:
        rank = places[r][ranks[r]] if ranks[r] < len(places.get(r, [])) else None
        ranks[r] += 1
        yield (*r, rank)


@pytest.mark.parametrize("longest,buckets", [(1, 50), (3, 70000)])
def test_resampling(spark, longest, buckets):
    rng = random.Random(4)
    names = ["Alpha", "beta", "gamma7", "δέλτα", "eps-ilon", "the", "of", "und"]
    rows = [(i, " ".join(rng.choice(names) for _ in range(rng.choice([0, 3, 6, 30])))) for i in range(90)]
    rows += [(None, "the of und the of und"), (None, None), (7, "beta beta beta beta beta beta"), (7, rows[7][1]), (-3, ""), (901, "\n \t"), (902, None)]
    rows += [(903, " ".join(["beta the"] * 3000))]
    target = ["beta gamma7 beta", None, "", "the beta"]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"rank": F.lit("x"), "score": F.lit(1), "at": F.lit(2)}).repartition(5)
    bench = spark.createDataFrame([(t, 1) for t in target], "text string, doc_id int")
    got = importance.ranked(docs, bench, longest, buckets, min_words=5, percent=30)
    want = list(drawn(rows, target, longest, buckets, 5, 30))
    key = lambda r: tuple((x is None, x or 0) for x in r)
    assert sorted((tuple(r) for r in got.collect()), key=key) == sorted(want, key=key)
    texts = importance.resampled(docs, bench, longest=longest, buckets=buckets, min_words=5, percent=30)
    chosen = {r[0] for r in want if r[5]}
    assert texts.columns == docs.columns
    assert sorted((r.doc_id, r.text) for r in texts.collect()) == sorted(r for r in rows if r[0] in chosen)


def test_resampling_of_nothing(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert importance.ranked(docs, docs).count() == 0
    assert importance.resampled(docs, docs).count() == 0


def test_resampling_prefers_the_target(spark):
    rng = random.Random(9)
    plain = [(i, " ".join(rng.choice(["ab", "cd", "ef", "gh"]) for _ in range(40))) for i in range(300)]
    like = [(1000 + i, " ".join(rng.choice(["ab", "xy", "zz"]) for _ in range(40))) for i in range(30)]
    docs = spark.createDataFrame(plain + like, "doc_id long, text string")
    bench = spark.createDataFrame([("xy zz ab",)] * 20, "text string")
    chosen = {r.doc_id for r in importance.resampled(docs, bench).collect()}
    assert len(chosen) == 33 and len([i for i in chosen if i >= 1000]) == 30


# ---------------------------------------------------------------- 12

def digest(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row):
    doc_id, text, lang, source, n_chars = row
    return digest(*("-" if x is None else f"{len(str(x).encode())}:{x}" for x in (doc_id, source, lang, n_chars, text)))


def climb(nodes):
    """All levels, the leaves first."""
    levels = [nodes]
    while len(nodes) > 1:
        nodes = [digest(*nodes[i:i + 2]) for i in range(0, len(nodes), 2)]
        levels.append(nodes)
    return levels


def beside(levels, at):
    out = []
    for nodes in levels[:-1]:
        run = nodes[at // 2 * 2:at // 2 * 2 + 2]
        out.append((at % 2, [x for k, x in enumerate(run) if k != at % 2]))
        at //= 2
    return out


def manifest(rows, tamper):
    groups = {}
    for r in rows:
        groups.setdefault(r[2], []).append(r)
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    ordered = {g: sorted(groups[g], key=lambda r: (r[0] is not None, r[0] or 0, leaf(r))) for g in names}
    trees = {g: climb([leaf(r) for r in ordered[g]]) for g in names}
    top = climb([trees[g][-1][0] for g in names])
    for k, g in enumerate(names):
        for slot, r in enumerate(ordered[g]):
            steps = beside(trees[g], slot) + beside(top, k)
            now = leaf(tamper(r))
            for right, others in steps:
                now = digest(*(others + [now] if right else [now] + others))
            proof = digest(*(x for _, others in steps for x in others))
            yield (g, slot, r[0], leaf(r), trees[g][-1][0], top[-1][0], proof, now, now == top[-1][0])


def odd_documents(n):
    rng = random.Random(5)
    rows = [(rng.randrange(-500, 5000) if i % 3 else 70 * i, f"text {i}", rng.choice(["en", "en", "de", None, "", "é"]), "s", i) for i in range(n)]
    rows = list({r[0]: r for r in rows}.values())
    rows += [(None, f"u{i % 3}", "en", None, None) for i in range(7)] + [(None, None, None, None, None)] * 2
    rows += [(77, f"v{i % 4}", "de", "t", i % 2) for i in range(9)] + [(2**62 + i, "far", "de", "t", 1) for i in range(3)]
    return rows + [(8001, "alone", "zz", "t", 3), (8002, "x" * 70000, "fr", "ü", 70000)]


def tampered(r):
    changed = r[0] is not None and r[4] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0
    return (*r[:4], r[4] + 1) if changed else r


@pytest.mark.parametrize("id_bits,block_bits", [(10, 10), (6, 2)])
def test_manifest(spark, monkeypatch, id_bits, block_bits):
    for name, value in (("ID_BITS", id_bits), ("IDS", 1 << id_bits), ("BLOCK_BITS", block_bits), ("SLOTS", 1 << block_bits)):
        monkeypatch.setattr(merkle, name, value)
    rows = odd_documents(160)
    docs = spark.createDataFrame(rows, DOCS).withColumns({c: F.lit("x") for c in ("leaf", "found", "g", "slot", "n", "path", "name")}).repartition(4)
    bad = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(7)) == 0
    got = merkle.proofs(docs, {"n_chars": F.when(bad, F.col("n_chars") + 1).otherwise(F.col("n_chars"))}).drop("path")
    want = list(manifest(rows, tampered))
    assert sum(not r[-1] for r in want) > 10
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, want))


def test_manifest_of_little(spark):
    docs = spark.createDataFrame([], DOCS)
    assert merkle.proofs(docs).count() == 0
    one = (5, "t", None, None, 1)
    row = merkle.proofs(spark.createDataFrame([one], DOCS)).first()
    assert row.root == row.subroot == row.leaf == leaf(one) and row.proof_sha256 == digest() and row.verified


def test_paths_prove_membership(spark):
    rows = odd_documents(40)
    for r in merkle.proofs(spark.createDataFrame(rows, DOCS)).collect():
        assert merkle.fold(r.leaf, bytes(r.path)) == r.root and merkle.fold(digest("no"), bytes(r.path)) != r.root


def test_ranks_in_containers():
    rng = np.random.default_rng(1)
    for size in (1, 3, 63, 64, 65, 500, 1024):
        low = np.sort(rng.permutation(1024)[:size])
        counts = np.where(rng.random(size) < 0.2, rng.integers(2, 5, size), 1)
        _, _, packed, repeated, extra = merkle._container(0, 0, low, counts)
        assert (merkle.unpacked_ids(packed) == low).all() and len(packed) <= 128
        got = merkle.Directory(packed, repeated, extra).rank(low)
        assert got.tolist() == (np.cumsum(counts) - counts).tolist()


# ---------------------------------------------------------------- 11

def nearest(rows, every, k):
    """rows: (id, vector); equal rows are one; the best score counts for an id."""
    rows = sorted({(i, tuple(v)) for i, v in rows if i is not None and v and None not in v and np.isfinite(v).all() and any(v)})
    out = {}
    for q, a in rows:
        if q % every == 0:
            best = out.setdefault(q, {})
            for i, b in rows:
                if i != q and len(a) == len(b):
                    best[i] = max(best.get(i, -math.inf), float(np.dot(np.array(a, float), np.array(b, float))))
    return {q: sorted(((-s, i) for i, s in best.items()))[:k] for q, best in out.items()}


def answers(found):
    out = {}
    for r in sorted(found.collect(), key=lambda r: (r.query_id, r["rank"])):
        out.setdefault(r.query_id, []).append((-r.score, r.vec_id))
        assert r["rank"] == len(out[r.query_id])
    return out


def test_nearest_of_few(spark):
    """Fewer rows than the beam: the answer is exact, with every odd row."""
    rng = np.random.default_rng(2)
    rows = [(i, [float(x) for x in rng.integers(-2, 3, 4)]) for i in range(90)]
    rows += [(100 + i, [2.0, 2.0, 2.0, 2.0]) for i in range(60)]                # ties go to the smaller id
    rows += [(None, [1.0, 1.0, 1.0, 1.0]), (200, None), (201, []), (202, [0.0] * 4), (203, [1.0, None, 1.0, 1.0]), (204, [1.0, float("nan"), 1.0, 1.0])]
    rows += [(205, [float("inf"), 0.0, 0.0, 0.0]), (40, [1.0, 1.0]), (41, [1.0, 2.0]), (40, [2.0, 2.0, 2.0, 2.0]), rows[3], (206, [-0.0, 0.0, 1.0, 0.0])]
    for kind in ("float", "double"):
        table = spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>").withColumns({"score": F.lit(1), "shard": F.lit(2), "id": F.lit("x")})
        got = answers(graph_index.nearest(table.repartition(3), every=10, k=20))
        assert got == {q: v for q, v in nearest(rows, 10, 20).items() if v}


def test_nearest_of_nothing(spark):
    table = spark.createDataFrame([(20, [1.0])], "vec_id long, embedding array<double>")
    assert graph_index.nearest(table).count() == 0
    assert graph_index.nearest(table.where("false")).count() == 0


@pytest.mark.parametrize("shards", [1, 5])
def test_recall(spark, shards):
    """Clusters of unequal norm, a third of all rows one vector: at least 0.95 of the nearest scores."""
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(12, 24))
    points = centres[rng.integers(0, 12, 3000)] + 0.4 * rng.normal(size=(3000, 24))
    points *= rng.uniform(0.7, 1.3, (3000, 1))
    points[::3] = points[0]
    rows = [(i, [float(x) for x in p]) for i, p in enumerate(points)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(4)
    points_table = graph_index.stored(graph_index.vectors(table), "vectors")
    index = graph_index.build(points_table, 20, shard_rows=3000 // shards, kind="<f8")
    got = answers(graph_index.search(index, points_table.where("id % 40 = 0")))
    scores = points @ points.T
    np.fill_diagonal(scores, -np.inf)
    hits = 0
    for q, found in got.items():
        want = np.lexsort((np.arange(3000), -scores[q]))[:20]
        hits += len(set(want.tolist()) & {i for _, i in found})
        for s, i in found:
            assert abs(-s - scores[q, i]) < 1e-9
    assert len(got) == 75 and hits >= 0.95 * 20 * 75
    assert index.rows.count() == index.shards


# ---------------------------------------------------------------- 5, 7, 10

def _toxic_rows(n, seed=5):
    rng, rows, labels = random.Random(seed), [], []
    for i in range(n):
        words = [rng.choice("river stone cloud paper green seven wheel table north music".split()) for _ in range(rng.randint(20, 60))]
        if i % 5 == 1:
            words[rng.randrange(len(words))] = rng.choice(["zorgath", "zorgathen", "blixid", "blixids"])
        rows.append((i, " ".join(words), "en", None, None))
        labels.append((i, 1, int(i % 5 == 1)))
    return rows, labels


@pytest.mark.parametrize("part_rows, max_bytes", [(60, 64 << 20), (4000, 2000)])
def test_every_label_teaches(spark, monkeypatch, part_rows, max_bytes):
    """In parts, or with room for a few texts at a time: no row is left out, and the layout of the rows changes nothing."""
    rows, labels = _toxic_rows(800)
    monkeypatch.setattr(toxicity, "PART_ROWS", part_rows, raising=False)
    docs, known = spark.createDataFrame(rows, DOCS), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    scores = []
    for laid in (docs.repartition(2), docs.repartition(5, "text")):
        got = toxicity.score(docs, toxicity.fit(laid, known, max_bytes=max_bytes)).collect()
        scores.append({r.doc_id: r.score for r in got})
    held = [r for r in got if r.held_out]
    assert scores[0] == scores[1] and sum(r.predicted == (r.doc_id % 5 == 1) for r in held) >= 0.95 * len(held)


def test_repeated_passages_are_found_with_one_shuffle_of_the_runs(spark):
    rng = random.Random(6)
    word = lambda: "".join(rng.choice("aeioulnrst") for _ in range(6))
    shared = " ".join(word() for _ in range(80))
    texts = [" ".join(word() for _ in range(60)) + (" " + shared + " " if i % 2 else " ") + word() for i in range(40)]
    docs = spark.createDataFrame([(i, t, "en", None, None) for i, t in enumerate(texts)], DOCS)
    runs = substring_dedup.shared_runs(docs, 100)
    plan = runs._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join") == 0 and plan.count("MapInArrow") == 1
    got = {r.doc_id: r for r in substring_dedup.dedup_passages(docs).collect()}
    assert all((r.n_passages > 0) == (i % 2 == 1) for i, r in got.items())
    assert got[1].dropped_bytes == 0 and got[1].kept_text == texts[1] and all(got[i].dropped_bytes > 300 for i in range(3, 40, 2))


def test_token_ids_of_whole_texts(spark):
    tokenizer = packing.Tokenizer(packing.ranks_bytes(spark, packing.RANKS))
    odd = "é　   x'll\r\n​\u0085\x1c\x1f 12٠½ <|endoftext|>\U0001f600 "
    for text in (None, "", " ", "a", " " * 5000 + "x", odd * 50):
        ids = tokenizer.ids(text)
        assert ids.dtype == np.dtype("<u2") and ids.tolist() == [*tokenizer.encoding.encode_ordinary(text or ""), tokenizer.end]
