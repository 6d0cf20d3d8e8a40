"""Input columns that are named like an operator's outputs or like columns it uses inside; files with limits that bite."""

from __future__ import annotations

import gzip
import os

import pytest
from pyspark.sql import functions as F

from newsloom.llm import line_dedup, mixing, quality_rules, warc

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
LINE = "a line that is long enough and that every document of this table has"


def docs(spark, n=8):
    return spark.createDataFrame([(i, f"first {i}\n{LINE}\nlast", "en", "s", 9) for i in range(n)], DOCS)


def clashing(df, *names):
    return df.withColumns({name: F.lit("x") for name in names})


def test_line_dedup(spark):
    plain = line_dedup.dedup_lines(docs(spark)).select("doc_id", "n_lines", "n_dropped", "kept_text")
    out = line_dedup.dedup_lines(clashing(docs(spark), "n_lines", "KEPT_text", "__id", "__drop", "__r", "drop", "salt", "a", "b", "keeper"))
    assert out.columns == [*docs(spark).columns, "__id", "__drop", "__r", "drop", "salt", "a", "b", "keeper", "n_lines", "n_dropped", "kept_text"]
    assert sorted(out.select(plain.columns).collect()) == sorted(plain.collect())
    assert {r.doc_id: r.n_dropped for r in plain.collect()} == {i: int(i != 7) for i in range(8)}
    assert {r["__id"] for r in out.collect()} == {"x"}


def test_quality_rules(spark):
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(8)], "doc_id long, quality int, toxic int")
    plain = quality_rules.apply_rules(docs(spark), labels).select("doc_id", "base_failed", "kept")
    out = quality_rules.apply_rules(clashing(docs(spark), "__s", "kept", "__id", "__q", "h", "bad", "base_failed"), labels)
    assert sorted(out.select(plain.columns).collect()) == sorted(plain.collect()) and out.columns.count("kept") == 1


def parts(path):
    return [gzip.open(os.path.join(path, f)).read() for f in sorted(os.listdir(path)) if f.endswith(".gz")]


@pytest.mark.parametrize("limit", [2, 4, 100])
def test_every_archive_file_begins_with_its_head_record(spark, tmp_path, limit):
    pages = spark.createDataFrame([(i, f"https://a/{i}", f"<p>{i}</p>" * 40) for i in range(10)], "page_id long, url string, html string").coalesce(1)
    warc.write_arc(pages, f"{tmp_path}/arc", max_records=limit)
    arcs = parts(f"{tmp_path}/arc")
    assert len(arcs) == -(-10 // (limit - 1)) and all(a.startswith(b"filedesc:") and a.count(b"filedesc:") == 1 for a in arcs)
    records = warc.read_arc(spark, f"{tmp_path}/arc")
    assert records.count() == 10
    warc.write_warc(warc.convert(records.coalesce(1), key=warc.header("X-Key", F.col("head"))), f"{tmp_path}/warc", max_records=limit)
    warcs = parts(f"{tmp_path}/warc")
    assert all(w.startswith(b"WARC/1.0\r\nWARC-Type: warcinfo") and w.count(b"WARC-Type: warcinfo") == 1 for w in warcs)
    assert sorted(r.key for r in warc.read_warc(spark, f"{tmp_path}/warc").collect()) == list(range(10))


def test_a_file_needs_room_for_a_record(spark, tmp_path):
    with pytest.raises(ValueError):
        warc.write_arc(spark.createDataFrame([(1, "u", "h")], "page_id long, url string, html string"), f"{tmp_path}/a", max_records=1)


def test_mixing(spark):
    names = ("__row", "__id", "__spans", "__size", "row", "src", "h", "block", "turn", "size", "target")
    plain = docs(spark).repartition(2)
    wide = clashing(plain, *names)
    out = mixing.mixed_documents(wide, mixing.mix_sources(wide, block_words=4, shard_slots=16))
    want = mixing.mixed_documents(plain, mixing.mix_sources(plain, block_words=4, shard_slots=16))
    assert out.columns == wide.columns and sorted(out.select(plain.columns).collect()) == sorted(want.collect())
    assert {r["__row"] for r in out.collect()} == {"x"} and out.count() > 0
