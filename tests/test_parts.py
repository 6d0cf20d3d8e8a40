"""Parts below a byte limit, archives in order, and what tells when either is not so."""

from __future__ import annotations

import os
import random

import pytest
from pyspark.sql import functions as F

from newsloom.sinks import parts
from newsloom.sources.files import file_position


def records(spark, n, rng):
    text = lambda i: rng.randbytes(rng.choice([0, 3, 40, 400, 1500])).hex() if i % 4 else "same words " * rng.randint(1, 300)
    return spark.createDataFrame([(i, text(i)) for i in range(n)], "id long, text string")


def sizes(path):
    return {d: os.path.getsize(os.path.join(d, f)) for d, _, names in os.walk(path) for f in names if f.endswith(".gz")}


@pytest.mark.parametrize("limit", [4000, 20_000, 10**9])
def test_no_part_is_above_the_limit(spark, tmp_path, limit):
    rows = records(spark, 700, random.Random(limit))
    assert parts.write_parts_below(rows, f"{tmp_path}/p", "id", part_bytes=limit).count() == 0
    assert max(sizes(tmp_path / "p").values()) <= limit
    back = spark.read.schema("id long, text string").json(f"{tmp_path}/p").select("id", "text")
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, rows.collect()))
    read = spark.read.schema("id long").json(f"{tmp_path}/p").withColumn("ingest_pos", file_position())
    proof = parts.is_in_order(read, "id").first()
    assert proof.ordered and (proof.records, proof.first.id, proof.last.id) == (700, 0, 699)


def test_parts_are_well_filled(spark, tmp_path):
    rows = records(spark, 3000, random.Random(1)).repartition(2)
    parts.write_parts_below(rows, f"{tmp_path}/p", "id", part_bytes=100_000)
    found = sorted(sizes(tmp_path / "p").values())
    assert sum(found) > 0.6 * 100_000 * (len(found) - 8)


def test_a_part_that_came_out_too_large_is_cut_again(spark, tmp_path, monkeypatch):
    """The measure sees a third of the size, as if the writer compressed worse."""
    fits = parts.Measure.fits
    monkeypatch.setattr(parts.Measure, "fits", lambda self, length, limit: fits(self, length, 3 * limit))
    rows = records(spark, 300, random.Random(2))
    assert parts.write_parts_below(rows, f"{tmp_path}/p", "id", part_bytes=8000).count() == 0
    assert max(sizes(tmp_path / "p").values()) <= 8000
    read = spark.read.schema("id long").json(f"{tmp_path}/p").withColumn("ingest_pos", file_position())
    assert parts.is_in_order(read, "id").first()[1:] [0] == 300 and parts.is_in_order(read, "id").first().ordered


def test_a_record_above_the_limit_is_reported(spark, tmp_path):
    rows = spark.createDataFrame([(1, "a"), (2, random.Random(3).randbytes(9000).hex()), (3, "b")], "id long, text string")
    over = parts.write_parts_below(rows, f"{tmp_path}/p", "id", part_bytes=3000).collect()
    assert [r.records for r in over] == [1] and over[0].bytes > 3000
    assert spark.read.schema("id long").json(f"{tmp_path}/p").count() == 3


def test_certificate_finds_swaps_inside_and_between_files(spark, tmp_path):
    def proof(name, *files):
        for ids in files:
            spark.createDataFrame([(i,) for i in ids], "id long").coalesce(1).write.mode("append").json(f"{tmp_path}/{name}/{len(os.listdir(tmp_path))}-{ids[0]}")
        rows = spark.read.option("recursiveFileLookup", True).schema("id long").json(f"{tmp_path}/{name}").withColumn("ingest_pos", file_position())
        return parts.is_in_order(rows, "id").first().ordered

    assert proof("a", [1, 2, 3], [3, 4, 5])
    assert not proof("b", [1, 3, 2], [4, 5])
    assert not proof("c", [1, 2, 6], [3, 4, 5])
    empty = spark.createDataFrame([], "id long, ingest_pos struct<file: string, block: long, line: long>")
    assert parts.is_in_order(empty, "id").first().ordered


def count_writes(monkeypatch):
    calls, write = [], parts._write
    monkeypatch.setattr(parts, "_write", lambda lines, path: calls.append(path) or write(lines, path))
    return calls


def test_text_that_packs_unevenly_is_measured_as_written(spark, tmp_path, monkeypatch):
    rng, calls = random.Random(4), count_writes(monkeypatch)
    word = lambda: "".join(rng.choice("aeioulnrst") for _ in range(rng.randint(2, 9)))
    texts = [rng.randbytes(6400).hex() if i % 17 == 0 else "" if i % 5 == 0 else " ".join(word() for _ in range(400)) for i in range(1500)]
    rows = spark.createDataFrame(list(enumerate(texts)), "id long, text string")
    assert parts.write_parts_below(rows, f"{tmp_path}/p", "id", part_bytes=100_000).count() == 0
    assert len(calls) == 1 and max(sizes(tmp_path / "p").values()) <= 100_000


def test_parts_above_the_limit_are_cut_in_one_job_a_round(spark, tmp_path, monkeypatch):
    calls, fits = count_writes(monkeypatch), parts.Measure.fits
    monkeypatch.setattr(parts.Measure, "fits", lambda self, length, limit: fits(self, length, 3 * limit))
    rows = records(spark, 900, random.Random(5))
    assert parts.write_parts_below(rows, f"{tmp_path}/p", "id", part_bytes=8000).count() == 0
    assert len(sizes(tmp_path / "p")) > 40 and len(calls) <= 14
    read = spark.read.schema("id long, text string").json(f"{tmp_path}/p")
    assert sorted(map(tuple, read.select("id", "text").collect())) == sorted(map(tuple, rows.collect()))
    assert parts.is_in_order(read.withColumn("ingest_pos", file_position()), "id").first().ordered
