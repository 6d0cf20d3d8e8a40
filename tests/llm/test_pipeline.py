"""The pipeline's stages, each on what its predecessor kept."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline as pipeline
from newsloom.llm import decontaminate, mixing, packing, quality_model
from newsloom.llm.common import stored
from tests.conftest import DATA
from tests.llm import brute

SF = f"{DATA}/sf0.001"


@pytest.fixture(scope="module")
def steps(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = [docs]
    for name, stage in pipeline.STAGES:
        out.append(stored(stage(spark, out[-1], SF), name))
    return out


def test_columns(steps):
    assert all(tuple(s.columns) == pipeline.COLUMNS for s in steps[:-1])


def test_classifier_stage(spark, steps):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    kept = {r.doc_id for r in steps[1].select("doc_id").collect()}
    scores = quality_model.classify(steps[0], labels).collect()
    assert kept == {r.doc_id for r in scores if r.kept} and len(kept) < len(scores)
    good = {r.doc_id for r in labels.where("quality = 1").collect()}
    assert len(good - kept) <= 0.02 * len(good)


def test_near_dedup_stage(steps):
    before = [(r.doc_id, r.text) for r in steps[1].collect()]
    want = {i for i, (_, _, kept) in brute.near_duplicates(before, 5, 80).items() if kept}
    assert {r.doc_id for r in steps[2].collect()} == want and len(want) < len(before)


def test_decontamination_stage(spark, steps):
    bench = [decontaminate.passage_words(r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    held = {
        r.doc_id for r in steps[2].collect() for b in bench
        if b" ".join(b) in b" ".join(decontaminate.passage_words(r.text))
    }
    assert {r.doc_id for r in steps[3].collect()} == {r.doc_id for r in steps[2].collect()} - held and held


def test_mixing_stage(steps):
    want = {r.doc_id: r.taken for r in mixing.mix_sources(steps[3], block_words=512).taken().collect() if r.taken}
    got = {}
    for r in steps[4].collect():
        got[r.doc_id] = got.get(r.doc_id, 0) + len(brute.words(r.text))
        assert r.n_chars == len(r.text)
    assert got == want


def test_packing_stage(spark, steps):
    tokenizer = packing.Tokenizer(packing.ranks_bytes(spark, packing.RANKS))
    want = sum(len(tokenizer.ids(r.text)) for r in steps[4].collect())
    rows = steps[5].collect()
    assert sum(r.n_tokens for r in rows) == want
    assert all(len(np.frombuffer(r.ids, "<u2")) == 2048 for r in rows)


def test_odd_rows(spark):
    docs = spark.createDataFrame(
        [(1, None, None, None, None), (2, "", "en", None, 0), (None, "a b", None, "s", None), (3, "x y z " * 9000, "de", "s", 1), (3, "x y z " * 9000, "de", "s", 1)],
        "doc_id long, text string, lang string, source string, n_chars long",
    )
    now, empty = docs, docs.limit(0)
    for name, stage in pipeline.STAGES:
        before, now = [(r.doc_id, r.text) for r in now.select("doc_id", "text").collect()], stored(stage(spark, now, SF), name)
        empty = stored(stage(spark, empty, SF), name)
        assert empty.count() == 0
        if name == "token_packing":
            tokenizer = packing.Tokenizer(packing.ranks_bytes(spark, packing.RANKS))
            assert sum(r.n_tokens for r in now.collect()) == sum(len(tokenizer.ids(t)) for _, t in before)
            continue
        after = [(r.doc_id, r.text) for r in now.select("doc_id", "text").collect()]
        if name == "minhash_near_dedup":        # equal rows under one id: one stays; all others differ
            assert sorted(after, key=str) == sorted(set(before), key=str)
        elif name == "benchmark_decontamination":
            assert sorted(after, key=str) == sorted(before, key=str)
        else:                                   # nothing is made up; the mix may take a text in two passes
            assert {i for i, _ in after} <= {i for i, _ in before}


@pytest.mark.parametrize("name,stage", pipeline.STAGES[:-1])
def test_clashing_columns(spark, name, stage):
    """Extra columns, also some named like columns that operators use, change no stage's rows."""
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(120)
    names = ("score", "kept", "text_score", "component_id", "n_shingles", "__id", "__scores", "__row", "__spans", "row", "h", "id", "y", "view", "item_id", "src")
    docs = stored(docs, "plain")
    wide = docs.withColumns({n: F.lit("x") for n in names})
    got, want = (sorted(stage(spark, d, SF).collect(), key=str) for d in (wide, docs))
    assert got == want and want


def test_rows_without_id_stay_to_the_mix(spark):
    """Kept when clean, dropped when they hold a benchmark passage, mixed in full measure."""
    item = next(r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect() if len(r.text.split()) > 20)
    rows = [(None, " ".join(f"n{k}w{j}" for j in range(900 + k)), "en", "s", 1) for k in range(30)]
    rows += [(i, " ".join(f"d{i}w{j}" for j in range(900)), "en", "s", 1) for i in range(30)]
    rows += [(None, f"a b c {item} d e f", "en", "s", 1), (77, f"a b c {item} d e f", "en", "s", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(3)
    clean = stored(pipeline.benchmark_decontamination(spark, docs, SF), "clean")
    assert sorted(r.text for r in clean.collect()) == sorted(r[1] for r in rows[:60])
    taken = mixing.mix_sources(clean, block_words=512).taken().where("doc_id is null").agg({"taken": "sum"}).first()[0]
    got = [r for r in pipeline.source_mixing(spark, clean, SF).collect() if r.doc_id is None]
    assert sum(len(r.text.split()) for r in got) == taken > 30 * 900
    assert all(part in "\n".join(r[1] for r in rows[:30]) for r in got for part in r.text.split("\n"))


def test_repeated_ids(spark):
    """Equal rows under one id: one stays. Other texts under one id: each cut by its own words."""
    def text(tag, n):
        return " ".join(f"{tag}w{j}" for j in range(n))

    rows = [(5, text("e", 700), "en", "s", 1)] * 3 + [(6, text("long", 3000), "en", "s", 1), (6, text("short", 40), "de", "t", 1)]
    rows += [(7, text("g", 900), "en", "t", 1), (7, text("h", 1300), "en", "t", 1), (None, text("z", 600), "en", "s", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(3)
    kept = stored(pipeline.minhash_near_dedup(spark, docs, SF), "kept")
    assert sorted(r.text for r in kept.collect()) == sorted({r[1] for r in rows})
    for start in (docs, kept):
        made = mixing.mix_sources(start, block_words=64)
        want, got = {}, {}
        for r in made.taken().collect():
            want.setdefault((r.doc_id, r["size"]), []).append(r.taken)
        for r in mixing.mixed_documents(start, made).collect():
            whole = next(t for i, t, *_ in rows if i == r.doc_id and t.split()[0][:2] == r.text.split()[0][:2])
            assert all(part in whole for part in r.text.split("\n"))
            key = (r.doc_id, len(whole.split()))
            got[key] = got.get(key, 0) + len(r.text.split())
        assert got == {k: sum(v) for k, v in want.items() if sum(v)}
