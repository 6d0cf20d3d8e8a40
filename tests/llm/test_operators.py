"""Operators of the training-data pipeline against plain versions of the same rules."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from newsloom.llm import (
    decontaminate, features, line_dedup, mixing, near_dedup, packing, quality_model, quality_rules, substring_dedup, toxicity, warc,
)
from newsloom.llm import queries as llm
from newsloom.session import scratch
from tests.check import connect, difference
from tests.conftest import DATA
from tests.llm import brute

SF = f"{DATA}/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def docs_of(spark, rows):
    return spark.createDataFrame([(i, t, "en", s, None if t is None else len(t)) for i, t, s in rows], DOCS).repartition(3)


def prose(rng, n):
    return " ".join("".join(rng.choice(["the", "an", "re", "ti", "on", "es", "or"]) for _ in range(rng.randint(1, 4))) for _ in range(n))


ODD = [(900, None, None), (901, "", "a"), (902, "\n \t\n", "a"), (903, "one", None), (904, "one", "b"), (905, "ONE two", "b")]


@pytest.fixture(scope="module")
def corpus(spark):
    """Texts with copies, a chain of near copies, shared lines and odd rows."""
    rng = random.Random(3)
    rows = [(i, prose(rng, rng.randint(5, 120)), f"s{i % 4}") for i in range(60)]
    base = prose(rng, 200).split()
    for i in range(60, 110):                # every copy differs from the one before in one more word
        base = base[:]
        base[rng.randrange(len(base))] = prose(rng, 1) + "x"
        rows.append((i, " ".join(base), "s0"))
    rows += [(110 + i, rows[5][1], "s1") for i in range(8)]
    line = "This Line is long enough and many documents share it, so it goes."
    rows += [(130 + i, f"{prose(rng, 9)}\n  {line if i % 2 else line.upper()}\t\n{prose(rng, 4)}\n{line}", "s2") for i in range(9)]
    return rows + ODD


# ---------------------------------------------------------------- 1

@pytest.mark.parametrize("size,percent", [(3, 85), (5, 80)])
def test_near_duplicates(spark, corpus, size, percent):
    got = near_dedup.near_duplicates(docs_of(spark, corpus), size, percent).collect()
    want = brute.near_duplicates([(i, t) for i, t, _ in corpus], size, percent)
    assert {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in got} == want
    assert len(got) == len(corpus)


def test_near_duplicates_large_group(spark):
    """More variants of one text than are compared with each other; some are linked only through others."""
    rng = random.Random(8)
    base, rows = prose(rng, 120).split(), []
    for i in range(300):
        words = base[:]
        for _ in range(rng.choice([1, 1, 2, 3, 4, 6, 9])):
            words[rng.randrange(len(words))] = prose(rng, 1) + str(rng.randrange(9))
        rows.append((i, " ".join(words), None))
    got = near_dedup.near_duplicates(docs_of(spark, rows), 3, 85).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in got} == brute.near_duplicates([r[:2] for r in rows], 3, 85)


def test_near_duplicates_odd_rows(spark):
    rows = docs_of(spark, [(None, "a b c", None), (1, "a b c", None), (1, "a b c", None), (2, None, None)]).withColumn("sig", F.lit(1))
    got = sorted(near_dedup.near_duplicates(rows, 3, 85).collect(), key=str)
    assert sorted((r.doc_id or -1, r.component_id or -1, r.kept) for r in got) == [(-1, -1, True), (1, 1, True), (1, 1, True), (2, 2, True)]
    assert near_dedup.near_duplicates(rows.limit(0)).count() == 0
    assert near_dedup.one_per_group(rows).count() == 4


def test_bounds_keep_what_reaches_the_threshold():
    bounds = near_dedup.least_matches(0.85, 1e-6)
    assert [n for n, _ in bounds] == list(range(30, 181, 30))
    assert all(a < b for (_, a), (_, b) in zip(bounds, bounds[1:]))
    rng = np.random.default_rng(1)
    lost = sum(any((row := rng.random(180) < 0.85)[:n].sum() < m for n, m in bounds) for _ in range(3000))
    assert lost == 0


def test_components_of_chains_and_stars(spark):
    rng = random.Random(4)
    edges = [(i, i + 1) for i in range(1000, 1060)] + [(7, i) for i in range(2000, 2100)] + [(5, 7), (9, 9)]
    edges += [(rng.randrange(3000, 3060), rng.randrange(3000, 3060)) for _ in range(40)]
    got = {r.node: r.component for r in near_dedup.components(spark.createDataFrame(edges, "x long, y long")).collect()}
    root = {n: n for e in edges for n in e}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n
    for a, b in edges:
        x, y = sorted((find(a), find(b)))
        root[y] = x
    assert {n: got.get(n, n) for n in root} == {n: find(n) for n in root}


# ---------------------------------------------------------------- 2

def test_dedup_lines(spark, corpus):
    got = {r.doc_id: (r.n_lines, r.n_dropped, r.kept_text) for r in line_dedup.dedup_lines(docs_of(spark, corpus)).collect()}
    holders = defaultdict(set)
    key = lambda x: brute.folded(x.strip(brute.SPACES))
    for i, t, _ in corpus:
        for x in (t or "").split("\n"):
            if len(key(x)) >= 40:
                holders[key(x)].add(i)
    for i, t, _ in corpus:
        lines = (t or "").split("\n")
        kept = [x for x in lines if len(holders[key(x)]) < 5 or i == max(holders[key(x)])]
        assert got[i] == (len(lines), len(lines) - len(kept), "\n".join(kept))
    assert sum(v[1] for v in got.values()) > 10


def test_dedup_lines_odd_rows(spark):
    line = "x" * 40
    rows = docs_of(spark, [(i, f"{line}\n{line}", None) for i in range(5)] + [(None, line, None), (4, line, None), (9, None, None)])
    got = line_dedup.dedup_lines(rows.withColumn("drop", F.lit(1)).withColumn("n_chars", F.lit(None).cast("int")))
    out = sorted(((r.doc_id if r.doc_id is not None else -1), r.n_dropped, r.kept_text) for r in got.collect())
    assert out == [(-1, 0, line), (0, 2, ""), (1, 2, ""), (2, 2, ""), (3, 2, ""), (4, 0, line), (4, 0, f"{line}\n{line}"), (9, 0, "")]
    assert line_dedup.dedup_lines(rows.limit(0)).count() == 0


# ---------------------------------------------------------------- 3

def test_targets_are_shared_again_above_the_cap():
    got = mixing.source_targets([("b", 100), (None, 1000), ("a", 10)])
    assert [(s, n) for s, n, _ in got] == [("a", 10), ("b", 100), (None, 1000)]
    # a stops at 20, b (weight 1) and null (weight 2) share 1645: b stops at 200, null has the rest
    assert [t for _, _, t in got] == [20.0, 200.0, 1445.0]
    assert mixing.source_targets([]) == [] and mixing.source_targets([("a", 0)]) == [("a", 0, 0.0)]


@pytest.mark.parametrize("n", [1, 2, 3, 7, 64, 1000])
def test_permutation(n):
    at = mixing.permuted(np.arange(n), np.full(n, n), np.full(n, 5, np.uint64))
    assert sorted(at) == list(range(n))


def test_mixing(spark, corpus):
    docs = docs_of(spark, corpus)
    one = {r.doc_id: r for r in mixing.mix_sources(docs, block_words=16, shard_slots=64).taken().collect()}
    again = {r.doc_id: r for r in mixing.mix_sources(docs.repartition(2), block_words=16, shard_slots=64).taken().collect()}
    assert one == again and set(one) == {i for i, _, _ in corpus}
    sizes = {i: len(brute.words(t)) for i, t, _ in corpus}
    per = defaultdict(lambda: [0, 0, 0.0])
    for i, _, s in corpus:
        assert one[i]["size"] == sizes[i] and 0 <= one[i].taken <= 2 * sizes[i]
        per[s][0] += sizes[i]
        per[s][1] += one[i].taken
        per[s][2] = one[i].target
    want = mixing.source_targets([(s, v[0]) for s, v in per.items()])
    assert {s: (n, t) for s, n, t in want} == {s: (v[0], v[2]) for s, v in per.items()}
    for _, taken, target in per.values():
        assert abs(taken - target) <= 16 * 2


def test_small_sources_meet_their_slots_over_many_shards():
    """20 large and 2,000 small sources over 1,207 shards: totals are exact, and any task finds the same counts."""
    wanted, shards = np.array([240_000] * 20 + [70] * 2000 + [0, 1]), 1207
    rows = list(mixing.shard_counts(wanted, shards, 0, shards, 3))
    total, sizes = np.zeros(len(wanted), int), []
    for at, (shard, src, n, before) in enumerate(rows):
        assert shard == at and (n > 0).all() and (before == total[src]).all()
        total[src] += n
        sizes.append(n.sum())
    assert (total == wanted).all() and len(rows) == shards
    mean = wanted.sum() / shards
    assert 0.6 * mean < np.var(sizes) < 1.4 * mean       # as of a multinomial draw
    for first, last in ((0, 32), (32, 64), (1184, 1216)):
        for got, want in zip(mixing.shard_counts(wanted, shards, first, last, 3), rows[first:last], strict=True):
            assert all(np.array_equal(a, b) for a, b in zip(got, want))
    assert list(mixing.shard_counts(np.array([0, 0]), 0, 0, 32, 3)) == []


def test_mixed_documents(spark, corpus):
    rows = [r for r in corpus if r[0] < 60]
    docs = docs_of(spark, rows).withColumn("size", F.lit(1))
    made = mixing.mix_sources(docs, block_words=16, shard_slots=64)
    taken = {r.doc_id: r.taken for r in made.taken().collect()}
    got, texts = Counter(), {i: t for i, t, _ in rows}
    out = mixing.mixed_documents(docs, made)
    assert out.columns == docs.columns
    for r in out.collect():
        got[r.doc_id] += len(brute.words(r.text))
        assert all(part in texts[r.doc_id] for part in r.text.split("\n"))
    assert dict(got) == {i: n for i, n in taken.items() if n}


def test_mixing_empty(spark):
    empty = docs_of(spark, ODD).limit(0)
    assert mixing.mix_sources(empty).taken().count() == 0
    blank = mixing.mix_sources(docs_of(spark, [(1, None, None), (1, None, None), (None, " ", "a")])).taken().collect()
    assert len(blank) == 3 and all((r["size"], r.taken, r.target) == (0, 0, 0.0) for r in blank)


# ---------------------------------------------------------------- 4, 5, 6

def _labelled(n=240, seed=5):
    rng = random.Random(seed)
    rows, labels = [], []
    for i in range(n):
        bad, toxic = i % 4 == 0, i % 5 == 1
        text = prose(rng, rng.randint(20, 90))
        if toxic:
            words = text.split()
            words[rng.randrange(len(words))] = rng.choice(["zorgath", "zorgathen", "blixid", "blixids"])
            text = " ".join(words)
        if bad:
            text = " ".join(w.upper() + "!!" for w in text.split()) if i % 8 else " ".join(w + "***" for w in text.split())
        rows.append((i, text, "good" if not bad or i % 3 else "bad"))
        labels.append((i, int(not bad), int(toxic)))
    return rows, labels


def test_co_training(spark):
    rows, labels = _labelled()
    names = ("score", "text_score", "META_score", "kept", "row", "h", "id", "y", "view", "__id", "__y", "__scores")
    docs = docs_of(spark, rows + ODD + [(None, "x", None)]).withColumns({name: F.lit("clash") for name in names})
    known = spark.createDataFrame(labels[:160] + [(None, 1, 1), (3, None, None)], "doc_id long, quality int, toxic int")
    model = quality_model.fit(docs, known)
    assert model.exchanged and all(a + b for a, b in model.exchanged)
    assert (model.mixed[:2] >= 0).all() and all(0.5 < v <= 1 for v in model.held_out)
    got = quality_model.score(docs, model).collect()
    assert len(got) == len(rows) + len(ODD) + 1 and all(0 <= r.score <= 1 for r in got)
    truth = {i: q for i, q, _ in labels[160:]}
    wrong = sum((r.score >= 0.5) != truth[r.doc_id] for r in got if r.doc_id in truth)
    assert wrong <= 2
    kept = quality_model.keep_good(docs, known)
    assert kept.columns == docs.columns and {r["kept"] for r in kept.collect()} == {"clash"}
    out = quality_model.classify(docs, known)
    assert [c for c in out.columns if c.lower() in ("kept", "score", "meta_score")] == ["meta_score", "score", "kept"]


def test_labels_handed_over_are_the_surest_of_all_rows(spark):
    """Against brute force: every unlabelled row is scored by numpy alone and ranked within its class."""
    rows, labels = _labelled()
    rows += [(1000 + i, t, s) for i, (_, t, s) in enumerate(_labelled(300, seed=8)[0])]
    docs = docs_of(spark, rows + ODD + ODD + [(None, "x", None)])
    known = spark.createDataFrame(labels[:160], "doc_id long, quality int, toxic int")
    model = quality_model.fit(docs, known, rounds=0)
    chosen = known.selectExpr("doc_id as id", "quality as y")
    views = quality_model._views(docs, chosen)
    assert views.count() == docs.count() and views.where("y is not null").count() == 160
    free = views.where("y is null").collect()
    odds = {
        r.row: model.odds(
            np.frombuffer(r.text, np.float16).astype(np.float32)[None],
            features.meta_matrix(np.frombuffer(r.meta, np.int16).astype(int)[None]),
        ) for r in free
    }
    given = []
    for _ in range(2):
        got = quality_model._surest(views, model, given, 40)
        for at, to in ((0, "meta"), (1, "text")):
            taken = {g.row for g in given if g.view == to}
            for y, most, sign in ((1, int(40 * model.share), 1), (0, 40 - int(40 * model.share), -1)):
                sure = sorted((float(sign * v[at][0]) for r, v in odds.items() if r not in taken and sign * v[at][0] > 0), reverse=True)
                mine = sorted((float(sign * odds[g.row][at][0]) for g in got if (g.view, g.y) == (to, y)), reverse=True)
                assert np.allclose(mine, sure[:most], atol=1e-4) and mine
        assert not {(g.row, g.view) for g in got} & {(g.row, g.view) for g in given}
        given += got


def test_combined_views_never_count_against_a_label():
    rng = np.random.default_rng(1)
    y = (rng.random(600) < 0.7).astype(float)
    sure, noise = (2 * y - 1) * 2 + rng.normal(0, 1.5, 600), rng.normal(0, 1, 600)
    for odds in ((sure, noise), (sure, -sure * 0.2 + noise), (noise, sure)):
        w = quality_model.combine(np.column_stack(odds), y)
        assert (w[:2] >= 0).all() and w[0 if odds[0] is sure else 1] > 0.5
    pairs = [(a > b) + 0.5 * (a == b) for a in sure.round(1)[y == 1] for b in sure.round(1)[y == 0]]
    assert abs(quality_model.area(sure.round(1), y) - np.mean(pairs)) < 1e-9


def test_co_training_without_labels(spark):
    docs = docs_of(spark, ODD)
    none = spark.createDataFrame([(900, 1, 0)], "doc_id long, quality int, toxic int")
    for labels in (none, none.limit(0)):
        assert [r.score for r in quality_model.classify(docs, labels).collect()] == [0.5] * len(ODD)
    assert quality_model.classify(docs.limit(0), none).count() == 0
    assert quality_model.keep_good(docs, none).count() == len(ODD)


def test_toxicity(spark):
    rows, labels = _labelled(600)
    docs = docs_of(spark, rows + ODD + [(None, "zorgath", None)])
    known = spark.createDataFrame(labels + [(None, 1, 1), (3, None, None)], "doc_id long, quality int, toxic int")
    net = toxicity.fit(docs, known)
    got = toxicity.score(docs.withColumn("threshold0", F.lit(1)), net).collect()
    truth, right, held = {i: t for i, _, t in labels}, 0, 0
    for r in got:
        assert r.predicted == int(r.score >= 0.5) and 0 <= r.score <= 1
        if r.doc_id in truth:
            assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
            held += r.held_out
            right += r.held_out and r.predicted == truth[r.doc_id]
    assert len(got) == len(rows) + len(ODD) + 1 and right >= 0.95 * held
    assert not next(r for r in got if r.doc_id is None).held_out


WORDLESS = [None, "", "  ", "!!!", "\n\t", "x", "two words", "\u2603 ..."]


def test_toxicity_of_texts_without_words(spark):
    """Scored and learned from: null, empty, blank, punctuation, one word, two words."""
    rows, labels = _labelled(200)
    odd = [(5000 + i, t, None) for i, t in enumerate(WORDLESS * 6)]
    known = spark.createDataFrame(labels + [(i, 1, i % 2) for i, _, _ in odd], "doc_id long, quality int, toxic int")
    docs = docs_of(spark, rows + odd + odd[:3]).withColumns({c: F.lit("x") for c in ("score", "i", "y", "t", "g", "n", "threshold", "__id", "__y")})
    net = toxicity.fit(docs, known)
    got = toxicity.score(docs, net).select("doc_id", "score", "predicted", "held_out").collect()
    assert len(got) == len(rows) + len(odd) + 3
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got)
    blank = {r.score for r in got if r.doc_id >= 5000 and WORDLESS[(r.doc_id - 5000) % 8] in (None, "", "  ", "!!!", "\n\t")}
    assert len(blank) == 1
    few = toxicity.fit(docs, known, max_bytes=2000)
    assert toxicity.score(docs.limit(0), few).count() == 0


def test_toxicity_learns_nothing_from_held_out_rows(spark):
    rows, labels = _labelled(100)
    docs, known = docs_of(spark, rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    flipped = known.withColumn("toxic", F.when(toxicity.held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    a, b = (sorted((r.doc_id, r.score) for r in toxicity.score(docs, toxicity.fit(docs, k)).collect()) for k in (known, flipped))
    assert a == b
    assert {r.score for r in toxicity.score(docs, toxicity.fit(docs, known.limit(0))).collect()} == {0.0}


def test_toxicity_whole_text():
    net = toxicity.Net()
    scorer = toxicity.Scorer(net)
    words = [f"w{i % 9000}".encode() for i in range(120_000)]
    whole = net.pooled(scorer.embedded(words))[0]
    logit = float(np.maximum(whole + net.bias, 0) @ net.out + net.rest)
    assert scorer.logit(b" ".join(words).decode()) == pytest.approx(logit, abs=1e-5)


REPEATS = ["a b c d e a b c d e", "a a a a a a a", "a b c d e f", "x a b c d e y a b c d e z a b c d e", "a b c d", None, "", "é É é É é É é",
           "l one\nl one\n \nl one\n\n", "a b # * $ % & | < > ##"]


def test_statistics(spark, corpus):
    rows = [(i, t, None) for i, t in enumerate(REPEATS + [t for _, t, _ in corpus])]
    got = quality_rules.with_statistics(docs_of(spark, rows)).withColumn("f", quality_rules.base_failed()).select(
        "doc_id", "__s.w.n_words", "__s.word_chars", "__s.n_symbols", "__s.l.n_dup_lines", "__s.w.n_repeat_words", "f"
    ).collect()
    assert {r.doc_id: tuple(r)[1:] for r in got} == {i: brute.rule_counts(t) for i, t, _ in rows}


def test_rules(spark):
    rows, labels = _labelled(300)
    docs = docs_of(spark, rows + ODD + [(None, "x", None)])
    known = spark.createDataFrame(labels[:200] + [(None, 1, 1), (3, None, None)], "doc_id long, quality int, toxic int")
    rules = quality_rules.learn_rules(quality_rules.labelled_rows(docs, known))
    assert 1 <= len(rules) <= 4
    out = quality_rules.apply_rules(docs, known)
    plan = out._jdf.queryExecution().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "Arrow"))
    truth = {i: bool(q) for i, q, _ in labels}
    got = out.select("doc_id", "kept").collect()
    assert len(got) == len(rows) + len(ODD) + 1
    assert sum(r.kept != truth[r.doc_id] for r in got if r.doc_id in truth) <= 2
    assert quality_rules.apply_rules(docs, known.limit(0)).where("kept <> (not base_failed)").count() == 0
    assert quality_rules.apply_rules(docs.limit(0), known).count() == 0


# ---------------------------------------------------------------- 7

def test_borders_move_only_near_an_insertion():
    rng, gear = random.Random(2), substring_dedup._gear()
    data = prose(rng, 2000).encode()

    def cut(d):
        starts = substring_dedup.borders(np.frombuffer(d, np.uint8), gear).tolist()
        return {d[a:b] for a, b in zip(starts, [*starts[1:], len(d)])}

    before, after = cut(data), cut(data[:5000] + b"inserted" + data[5000:])
    assert len(before - after) <= 2 and len(before) > 100


def test_borders_of_long_texts_do_not_depend_on_stretches(monkeypatch):
    data = np.frombuffer(prose(random.Random(6), 900).encode(), np.uint8)
    whole = substring_dedup.borders(data, substring_dedup._gear())
    monkeypatch.setattr(substring_dedup, "_STRETCH", 97)
    assert substring_dedup.borders(data, substring_dedup._gear()).tolist() == whole.tolist()


def test_repeated_passages(spark):
    rng = random.Random(12)
    shared = prose(rng, 60)
    rows = [(i, prose(rng, 80), None) for i in range(30)]
    rows += [(100 + i, f"{prose(rng, 30 + i)} {shared} {prose(rng, 20)}", None) for i in range(12)]
    rows += [(200, rows[3][1], None), (201, None, None), (202, "", None), (None, shared, None), (203, "é" * 500, None)]
    docs = docs_of(spark, rows).withColumn("found", F.lit(0))
    got = {r.doc_id: r for r in substring_dedup.dedup_passages(docs).collect()}
    assert {i for i, r in got.items() if r.n_passages and r.shared_with != i} == {3, 200, *range(100, 112)}
    texts = {i: t for i, t, _ in rows}
    for i, r in got.items():
        assert len((r.kept_text or "").encode()) == len((texts[i] or "").encode()) - r.dropped_bytes
    assert got[3].dropped_bytes == got[100].dropped_bytes == 0 and got[200].kept_text == ""
    assert all(got[100 + i].dropped_bytes > 100 and got[100 + i].shared_with in (100, 111) for i in range(1, 12))
    assert got[201].kept_text is None and got[202].kept_text == "" and substring_dedup.dedup_passages(docs.limit(0)).count() == 0


def test_recall_of_passages_just_over_fifty_words(spark):
    rng = random.Random(31)
    shared = [prose(rng, 51) for _ in range(400)]
    rows = [(k * 400 + i, f"{prose(rng, rng.randint(5, 60))} {t} {prose(rng, rng.randint(5, 60))}", None)
            for k in range(2) for i, t in enumerate(shared)]
    docs = docs_of(spark, rows + [(1000 + i, prose(rng, 170), None) for i in range(50)])
    got = {r.doc_id: r for r in substring_dedup.dedup_passages(docs).collect()}
    assert all(got[i].shared_with == 400 + i and got[400 + i].shared_with == i for i in range(400))
    assert all(got[i].n_passages == 0 for i in range(1000, 1050))
    assert all(got[i].dropped_bytes == 0 for i in range(400))
    # what may stay at the ends, with a few bytes that agree by chance
    assert all(len(t) - substring_dedup.ENDS <= got[400 + i].dropped_bytes <= len(t) + 2 * 16 for i, t in enumerate(shared))
    assert sum(got[400 + i].dropped_bytes for i in range(400)) > 0.7 * sum(map(len, shared))


def test_chunk_runs(monkeypatch):
    """No chunk is longer than SPAN, runs start at borders, digests are those of their bytes, a long shared stretch shares a run."""
    rng, size, span, gear = random.Random(5), 100, substring_dedup.SPAN, substring_dedup._gear()
    data = (prose(rng, 500) + "é" * 300 + prose(rng, 300)).encode()
    raw = np.frombuffer(data, np.uint8)
    starts, lengths, digests = substring_dedup.chunk_runs(raw, size, gear)
    cuts = substring_dedup.borders(raw, gear)
    assert np.diff(cuts).max() <= span and starts[0] == 0 and starts[-1] + lengths[-1] == len(data)
    assert set(starts.tolist()) <= set(cuts.tolist()) and lengths.min() >= size and lengths.max() <= size + 2 * span
    by_content, by_digest = {}, {}
    for a, n, h in zip(starts.tolist(), lengths.tolist(), digests.tolist()):
        assert by_content.setdefault(data[a:a + n], h) == h and by_digest.setdefault(h, data[a:a + n]) == data[a:a + n]
    part = data[700:700 + size + substring_dedup.SURE]
    other = substring_dedup.chunk_runs(np.frombuffer(b"x" * 130 + part + b"y" * 130, np.uint8), size, gear)[2]
    assert set(other.tolist()) & set(digests.tolist())
    monkeypatch.setattr(substring_dedup, "_STRETCH", 197)
    again = substring_dedup.chunk_runs(raw, size, gear)
    assert all(a.tolist() == b.tolist() for a, b in zip(again, (starts, lengths, digests)))
    assert all(len(x) == 0 for x in substring_dedup.chunk_runs(raw[:99], size, gear))


def test_shared_passages_by_brute_force(spark):
    """Which documents share a run of chunks: the same as comparing all runs as bytes."""
    rng, gear = random.Random(77), substring_dedup._gear()
    parts = [prose(rng, rng.randint(10, 40)) for _ in range(25)]
    rows = [(i, " ".join(rng.choice(parts) for _ in range(rng.randint(0, 6))), None) for i in range(60)] + [(60, None, None), (61, "é" * 400, None)]
    runs = {}
    for i, t, _ in rows:
        data = (t or "").encode()
        starts, lengths, _ = substring_dedup.chunk_runs(np.frombuffer(data, np.uint8), 100, gear)
        for a, n in zip(starts.tolist(), lengths.tolist()):
            runs.setdefault(data[a:a + n], []).append((i, a, n))
    want = {i: {} for i, _, _ in rows}
    for places in runs.values():
        if len(set(places)) > 1:
            for i, a, n in places:
                for at in range(a, a + n):
                    want[i][at] = want[i].get(at, False) or (i, a, n) != min(places)
    clash = {c: F.lit("x") for c in ("kept_text", "N_passages", "found", "__id", "__r", "digest", "place")}
    got = substring_dedup.dedup_passages(docs_of(spark, rows).withColumns(clash))
    assert got.columns == ["doc_id", "text", "lang", "source", "n_chars", "found", "__id", "__r", "digest", "place", *(c.split()[0] for c in substring_dedup.MADE.split(", "))]
    assert sum(map(bool, want.values())) > 20
    for r in got.collect():
        assert (r.repeated_bytes, r.dropped_bytes if r.text and r.text.isascii() else 0) == (
            len(want[r.doc_id]), sum(want[r.doc_id].values()) if r.text and r.text.isascii() else 0)


# ---------------------------------------------------------------- 8

def test_decontamination(spark):
    rng = random.Random(21)
    items = [(i, prose(rng, n)) for i, n in enumerate([3, 5, 12, 20, 33, 47, 60, 60])] + [(50, None), (51, ""), (52, "...")]
    rows, want = [], {}
    for k in range(40):
        item = k % 8
        words = items[item][1].split()
        edits = k // 8 if item > 2 else 0
        for _ in range(edits):
            words[rng.randrange(len(words))] = "changed"
        rows.append((k, f"{prose(rng, rng.randint(0, 40))}\n{' '.join(words).upper()}! {prose(rng, rng.randint(0, 40))}", None))
    rows += [(60, items[4][1], None), (61, f"{items[3][1]} {prose(rng, 30)} {items[3][1]}", None), (62, None, None), (63, "", None)]
    rows += [(64, " ".join(items[6][1].split()[:55]), None)]
    shingle = lambda w: Counter(tuple(w[i:i + 5]) for i in range(len(w) - 4)) or Counter([tuple(w)])
    for d, t, _ in rows:
        w = decontaminate.passage_words(t)
        for i, text in items:
            v = decontaminate.passage_words(text)
            if not v or not w or len(w) < min(len(v), 5):
                continue
            n = len(v)
            best = max(decontaminate.similarity(shingle(w[s:s + n]), shingle(v)) for s in range(max(1, len(w) - n + 1)))
            if best >= 0.8:
                want[d, i] = round(best, 6)
    docs = docs_of(spark, rows).withColumn("item_id", F.lit(1))
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {(r.doc_id, r.item_id): r for r in decontaminate.contaminated(docs, bench).collect()}
    assert {k: r.similarity for k, r in got.items()} == want
    assert len(want) >= 25 and got[61, 3].n_spans == 2
    left = {r.doc_id for r in decontaminate.decontaminated(docs, bench).collect()}
    assert left == {d for d, _, _ in rows} - {d for d, _ in want}


def test_decontamination_in_blocks(spark, monkeypatch):
    docs, bench = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "benchmark"))
    whole = sorted(map(tuple, decontaminate.contaminated(docs, bench).collect()))
    monkeypatch.setattr(decontaminate, "BLOCK_CHARS", 2000)
    assert sorted(map(tuple, decontaminate.contaminated(docs, bench).collect())) == whole
    assert decontaminate.contaminated(docs, bench.limit(0)).count() == 0
    assert decontaminate.contaminated(docs.limit(0), bench).count() == 0


def test_multi_index_finds_all_within_the_radius():
    rng = np.random.default_rng(3)
    prints = rng.integers(0, 256, (300, 8), np.uint8)
    near = decontaminate._ONES[np.arange(256, dtype=np.uint8)[None, :, None] ^ prints.T[:, None, :]] <= decontaminate.BLOCK_BITS
    for _ in range(300):
        i = rng.integers(300)
        bits = np.unpackbits(prints[i])
        bits[rng.choice(64, decontaminate.RADIUS, replace=False)] ^= 1
        got = np.packbits(bits)
        assert any(near[k][got[k], i] for k in range(8))


# ---------------------------------------------------------------- 9

@pytest.mark.parametrize("version", [1, 2])
def test_arc_to_warc(spark, version):
    big = "<p>é</p>" * 30
    rows = [(1, "http://a/x y", big), (2, None, big), (3, "http://a/3", "small"), (4, "http://a/4", "small"), (5, "", None),
            (None, "http://a/n", big), (2, "http://a/2b", big), (6, "http://a/6", "\r\n\r\nWARC/1.0\r\n" * 12), (7, "http://a/7", "b\n" * 90)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("key", F.lit(9)).repartition(2)
    arc, out = scratch(spark, "arc"), scratch(spark, "warc")
    warc.write_arc(pages, arc, version=version)
    read = warc.read_arc(spark, arc)
    assert {(r.version, r.truncated) for r in read.collect()} == {(version, False)}
    warc.write_warc(warc.convert(read, key=warc.header("X-Key", F.col("head"))), out)
    got = warc.read_warc(spark, out).collect()
    want = Counter((i, None if not u else u, hashlib.sha256((h or "").encode()).hexdigest(), len((h or "").encode())) for i, u, h in rows)
    assert Counter((r.key, r.url, r.payload_digest, r.payload_bytes) for r in got) == want
    assert all(r.payload_digest == r.declared_digest and r.warc_date == "2024-01-01T00:00:00Z" for r in got)
    kinds = Counter((r.key, r.warc_type, r.refers_to_key) for r in got)
    assert kinds == Counter({(1, "response", None): 1, (2, "revisit", 1): 2, (None, "revisit", 1): 1, **{(i, "response", None): 1 for i in (3, 4, 5, 6, 7)}})
    ids = {r.record_id for r in got}
    assert len(ids) == len(rows) and {r.refers_to_id for r in got if r.refers_to_id} <= ids


def test_arc_damaged_lines():
    good = b"http://a 1.2.3.4 20200101000000 text/html 5\nhello\n"
    data = b"filedesc://f 0.0.0.0 20200101 text/plain 9\n1 0 x\nURL\n\n" + b"garbage line\n" + good + b"http://b 1.2.3.4 20200101000000 text/plain 50\ncut"
    got = list(warc.arc_records(data))
    assert [(r["url"], r["payload"], r["truncated"]) for r in got] == [("http://a", b"hello", False), ("http://b", b"cut", True)]
    assert list(warc.arc_records(b"")) == []


# ---------------------------------------------------------------- 10

def test_best_fit_decreasing():
    rng = random.Random(1)
    for _ in range(40):
        size = rng.choice([8, 31, 64, 100])
        lengths = [rng.randint(1, size) for _ in range(rng.randint(0, 200))]
        rows = packing.best_fit_decreasing(lengths, size)
        assert sorted(i for r in rows for i in r) == list(range(len(lengths)))
        free, plain = [], 0                 # the same by trying every open row
        for n in sorted(lengths, reverse=True):
            fits = [f for f in free if f >= n]
            plain += not fits
            best = min(fits, default=size)
            if fits:
                free.remove(best)
            free.append(best - n)
        assert len(rows) == plain and all(sum(lengths[i] for i in r) <= size for r in rows)


def test_packing_round_trip(spark, corpus):
    rng = random.Random(9)
    rows = [r for r in corpus] + [(700, "x'll   y z\t\n\n q\x1c<|endoftext|> 12a b" * 40, None), (701, prose(rng, 4000), None)]
    docs = docs_of(spark, rows).withColumn("ids", F.lit(1))
    packed = packing.pack_tokens(docs, length=128, buffer_tokens=3000)
    import tiktoken
    tokenizer = packing.Tokenizer(packing.ranks_bytes(spark, packing.RANKS))
    assert isinstance(tokenizer.encoding, tiktoken.Encoding)
    want = {i: [*tokenizer.encoding.encode_ordinary(t or ""), tokenizer.end] for i, t, _ in rows}
    assert {r.doc_id: r.ids for r in packing.unpack(packed).collect()} == want
    made = packed.collect()
    for r in made:
        ids, places = np.frombuffer(r.ids, "<u2"), np.frombuffer(r.positions, "<u2")
        assert len(ids) == len(places) == 128 and r.n_tokens == r.cu_seqlens[-1] and r.cu_seqlens[0] == 0
        for a, b in zip(r.cu_seqlens, r.cu_seqlens[1:]):
            assert places[a:b].tolist() == list(range(b - a))
        assert (ids[r.n_tokens:] == tokenizer.end).all()
    assert len({(r.shard, r.row) for r in made}) == len(made)
    assert packing.pack_tokens(docs.limit(0)).count() == 0


# ---------------------------------------------------------------- queries

@pytest.mark.parametrize("name", sorted(llm.SQL))
def test_query_agrees_with_sql(spark, name):
    assert difference(llm.QUERIES[name](spark, SF), connect(SF), llm.SQL[name]) is None


def test_queries_cover_the_operators():
    assert [n.split("_")[0] for n in llm.QUERIES] == [f"op{i}" for i in range(1, 11)]
