from __future__ import annotations

import json
from datetime import datetime, timedelta, timezone

from pyspark.sql import functions as F

from newsloom import schemas
from newsloom.functions.article import extract_article
from newsloom.plans import jobs
from newsloom.profile import wordpress_site
from newsloom.streaming import operators, sinks
from newsloom.streaming.sources import stream_files

SITE = wordpress_site("https://news.example.com", "Example News")
T0 = datetime(2026, 1, 1, tzinfo=timezone.utc)
BODY = '<h1 class="tdb-title-text">T{0}</h1><div class="td-post-content">{1}</div>'


def land(spark, path, urls, word="x"):
    rows = [(u, BODY.format(u, word * 120)) for u in urls]
    spark.createDataFrame(rows, schemas.PAGES).coalesce(1).write.mode("append").parquet(path)


def test_stream_equals_batch_and_resumes(spark, tmp_path):
    pages, out, mark = f"{tmp_path}/pages", f"{tmp_path}/out", f"{tmp_path}/mark"
    land(spark, pages, ["a", "b"])
    jobs.stream_job(spark, pages, out, mark, SITE)
    first = spark.read.parquet(out).count()
    land(spark, pages, ["c"])
    jobs.stream_job(spark, pages, out, mark, SITE)
    rows = spark.read.parquet(out).drop("scraped_at")
    batch = extract_article(spark.read.parquet(pages), SITE).drop("scraped_at")
    assert first == 2 and sorted(rows.collect()) == sorted(batch.collect())


def test_redelivered_pages_are_ignored(spark, tmp_path):
    pages, out = f"{tmp_path}/pages", f"{tmp_path}/out"
    land(spark, pages, ["a", "b"])
    jobs.stream_job_once(spark, pages, out, f"{tmp_path}/m1", SITE)
    land(spark, pages, ["b", "c"], word="y")
    jobs.stream_job_once(spark, pages, out, f"{tmp_path}/m1", SITE)
    jobs.stream_job_once(spark, pages, out, f"{tmp_path}/m2", SITE)
    rows = spark.read.parquet(out)
    assert sorted((r.url, r.body_text[0]) for r in rows.collect()) == [("a", "x"), ("b", "x"), ("c", "y")]


def test_batch_that_runs_again_overwrites_itself(spark, tmp_path):
    pages, out = f"{tmp_path}/pages", f"{tmp_path}/out"
    land(spark, pages, ["a", "b"])
    jobs.stream_job_once(spark, pages, out, f"{tmp_path}/m", SITE)
    # A crash after the write and before the commit: the batch is planned, not committed.
    commit = tmp_path / "m" / "commits" / "0"
    assert commit.exists()
    commit.unlink()
    (tmp_path / "m" / "commits" / ".0.crc").unlink(missing_ok=True)
    jobs.stream_job_once(spark, pages, out, f"{tmp_path}/m", SITE)
    assert sorted(r.url for r in spark.read.parquet(out).collect()) == ["a", "b"]


def events(spark, tmp_path, rows, name="events"):
    data = [(i, k, T0 + timedelta(seconds=s), o) for i, (k, s, o) in enumerate(rows)]
    df = spark.createDataFrame(data, "n long, key string, ts timestamp, outcome string")
    df.coalesce(1).write.mode("append").parquet(f"{tmp_path}/{name}")
    return stream_files(spark, f"{tmp_path}/{name}", df.schema, files_per_trigger=1)


def test_dedup_within_the_watermark(spark, tmp_path):
    events(spark, tmp_path, [("a", 0, "ok"), ("b", 1, "ok")])
    stream = events(spark, tmp_path, [("a", 2, "ok"), ("c", 3, "ok"), ("c", 3, "ok")])
    rows = operators.dedup_stream(stream, "key").select("key")
    sinks.ingest_stream(rows, f"{tmp_path}/out", f"{tmp_path}/m")
    assert sorted(r.key for r in spark.read.parquet(f"{tmp_path}/out").collect()) == ["a", "b", "c"]


def test_state_of_bursts_survives_batches_and_restarts(spark, tmp_path):
    def run(stream):
        rows = operators.burst_with_reset(stream, "key", window_seconds=60, threshold=3)
        sinks.ingest_stream(rows, f"{tmp_path}/out", f"{tmp_path}/m")

    run(events(spark, tmp_path, [("k", 0, "e"), ("k", 10, "e"), ("j", 5, "e")]))
    run(events(spark, tmp_path, [("k", 30, "e"), ("k", 40, "e"), ("j", 70, "e"), ("j", 80, "e")]))
    run(events(spark, tmp_path, [("k", 50, "e"), ("k", 55, "e"), ("j", 90, "e")]))
    got = sorted((r.key, (r.ts_micros - int(T0.timestamp() * 1e6)) // 1_000_000) for r in spark.read.parquet(f"{tmp_path}/out").collect())
    assert got == [("j", 90), ("k", 30), ("k", 55)]


def test_progress_and_window_updates_keep_the_latest(spark, tmp_path):
    events(spark, tmp_path, [("a", 0, "ok"), ("a", 1, "error")])
    stream = events(spark, tmp_path, [("a", 2, "ok"), ("a", 20, "ok")])
    rows = operators.progress_stream(stream)
    sinks.write_updates(rows, f"{tmp_path}/p", f"{tmp_path}/m")
    latest = sinks.latest_updates(spark, f"{tmp_path}/p", rows.schema, "tick_micros").orderBy("tick_micros").collect()
    assert [(r.attempts, r.saved) for r in latest] == [(3, 2), (1, 1)]
    windows = operators.burst_windows(stream, threshold=3, window_seconds=10, slide_seconds=5)
    sinks.write_updates(windows, f"{tmp_path}/w", f"{tmp_path}/mw")
    found = sinks.latest_updates(spark, f"{tmp_path}/w", windows.schema, "start_micros").collect()
    start = int(T0.timestamp() * 1_000_000)
    assert sorted(((r.start_micros - start) // 1_000_000, r.failures) for r in found) == [(-5, 3), (0, 3)]


def test_posts_stream_in_as_json(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.jsonl").write_text(json.dumps({"url": "u", "category_slug": "s"}) + "\n")
    stream = stream_files(spark, f"{tmp_path}/in", schemas.URL_LIST, fmt="json")
    sinks.ingest_stream(stream, f"{tmp_path}/out", f"{tmp_path}/m")
    assert spark.read.parquet(f"{tmp_path}/out").select(F.max("url")).first()[0] == "u"


def test_a_long_backlog_of_archive_pages_takes_few_batches(spark, tmp_path):
    """Sixty page files, one of them broken, and a batch of one file: no batch for each, and every record once."""
    folder, out, mark = (f"{tmp_path}/{name}" for name in ("landed", "out", "mark"))
    pages = [(f'[{{"id":{2 * n},"slug":"a"}},{{"id":{2 * n - 1},"slug":"b"}}]',) for n in range(59)] + [('{"code":1}',)]
    spark.createDataFrame(pages, "value string").repartition(4).write.option("maxRecordsPerFile", 1).text(folder)
    for _ in range(2):
        jobs.archive_stream(spark, folder, out, mark, SITE, files_per_trigger=1)
        records, broken = jobs.read_archive_stream(spark, out)
        assert sorted(r.id for r in records.collect()) == list(range(-1, 117)) and broken.count() == 1
    batches = len(sinks.Manifest(spark, f"{out}/_manifest").entries())
    assert 1 < batches <= 16
