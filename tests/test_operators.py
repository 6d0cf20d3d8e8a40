from __future__ import annotations

import random
from collections import defaultdict
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from newsloom.operators import bursts, dedup, joins, ledger, listing, numbering, report
from newsloom.profile import wordpress_site

SITE = wordpress_site("https://news.example.com", "Example News")
T0 = datetime(2026, 1, 1, tzinfo=timezone.utc)


def sizes(rows, column):
    found = defaultdict(int)
    for r in rows:
        found[r[column]] += 1
    return [found[k] for k in sorted(found)]


# ------------------------------------------------------------------ numbering

def test_row_numbers_are_positions(spark):
    names = [f"k{n:05d}" for n in range(5000)]
    random.Random(1).shuffle(names)
    df = spark.createDataFrame([(n,) for n in names], "url string").repartition(7)
    rows = numbering.number_rows(df, "url", partitions=13, total="n").collect()
    assert {r.url: r.rn for r in rows} == {n: i + 1 for i, n in enumerate(sorted(names))}
    assert {r.n for r in rows} == {5000}


def test_row_numbers_with_equal_keys_are_still_a_sequence(spark):
    df = spark.range(3000).select(F.lit("same").alias("k"), F.col("id"))
    rows = numbering.number_rows(df, "k", "id", partitions=6).collect()
    assert [r.id for r in sorted(rows, key=lambda r: r.rn)] == list(range(3000))


@pytest.mark.parametrize("n,k,want", [(10, 4, {0: 2, 1: 2, 2: 2, 3: 4}), (3, 8, {7: 3}), (16, 4, {0: 4, 1: 4, 2: 4, 3: 4})])
def test_chunk_sizes(spark, n, k, want):
    rows = numbering.assign_chunk(spark.range(n), "id", chunks=k).collect()
    found = defaultdict(int)
    for r in rows:
        found[r.chunk] += 1
    assert dict(found) == want


def test_chunks_are_disjoint_contiguous_and_complete(spark):
    df = spark.range(103)
    parts = [[r.id for r in numbering.take_chunk(df, "id", chunks=5, number=i, first=1).collect()] for i in range(1, 6)]
    assert [sorted(p) for p in parts] == [list(range(i * 20, (i + 1) * 20)) for i in range(4)] + [list(range(80, 103))]
    assert numbering.take_chunk(df, "id", chunks=5, number=0, first=1).count() == 103
    with pytest.raises(ValueError):
        numbering.take_chunk(df, "id", chunks=5, number=6, first=1)


def test_shards(spark):
    rows = numbering.assign_shard(spark.range(1203), "id").collect()
    assert sizes(rows, "shard") == [500, 500, 203]


def test_empty_input_has_no_numbers(spark):
    assert numbering.assign_chunk(spark.range(0), "id", chunks=4).count() == 0


# ------------------------------------------------------------------ dedup

def skewed(spark, n=6000):
    """A third of all rows share one key."""
    rows = [(i, "hot" if i % 3 == 0 else f"k{i % 1500}", f"text {i}") for i in range(n)]
    random.Random(2).shuffle(rows)
    return rows, spark.createDataFrame(rows, "pos long, key string, text string").repartition(9)


def first_by_key(rows):
    kept = {}
    for pos, key, text in sorted(rows):
        kept.setdefault(key, (pos, key, text))
    return sorted(kept.values())


def test_first_row_per_key_with_a_hot_key(spark):
    rows, df = skewed(spark)
    got = sorted((r.pos, r.key, r.text) for r in dedup.dedup_keep_first(df, "key", "pos").collect())
    assert got == first_by_key(rows)


def test_dedup_is_idempotent_and_order_free(spark):
    rows, df = skewed(spark, 900)
    once = dedup.dedup_keep_first(df, "key", "pos")
    again = dedup.dedup_keep_first(once.orderBy(F.desc("pos")), "key", "pos")
    assert sorted(once.collect()) == sorted(again.select(*once.columns).collect())


def test_rows_without_a_key_all_stay(spark):
    df = spark.createDataFrame([(1, None), (2, None), (3, "a")], "pos long, key string")
    assert sorted(r.pos for r in dedup.dedup_keep_first(df, "key", "pos").collect()) == [1, 2, 3]


def test_merge_prefers_the_earlier_part(spark):
    a = spark.createDataFrame([(1, 5, "a")], "id long, pos long, run string")
    b = spark.createDataFrame([(1, 0, "b"), (2, 1, "b")], "id long, pos long, run string")
    rows = dedup.cross_chunk_merge([a, b], "id", "pos").collect()
    assert sorted((r.id, r.run) for r in rows) == [(1, "a"), (2, "b")]


def test_duplicates_report(spark):
    _, df = skewed(spark, 900)
    row = dedup.duplicates_report(df, "key").first()
    assert row.rows_in == 900 and row.rows_kept + row.rows_removed == 900
    clean = dedup.duplicates_report(dedup.dedup_keep_first(df, "key", "pos"), "key").first()
    assert clean.rows_removed == 0 and clean.rows_kept == row.rows_kept


# ------------------------------------------------------------------ joins

def test_pending_and_done_make_all(spark):
    work = spark.range(100).select(F.concat(F.lit("u"), F.col("id")).alias("url"))
    done = spark.createDataFrame([("u1",)] * 500 + [("u7",), ("u-none",)], "url string")
    pending = joins.pending_work(work, done, "url")
    assert pending.count() == 98
    assert pending.unionByName(work.join(done.distinct(), "url", "left_semi")).distinct().count() == 100


def test_found_category_keeps_one_row_per_article(spark):
    pages = spark.createDataFrame([("u1", None), ("u2", None), ("u3", "own")], "url string, category string")
    urls = spark.createDataFrame([("u1", "b"), ("u1", "a"), ("u2", None), ("u3", "c")], "url string, category_name string")
    rows = joins.attach_discovered_category(pages, urls).collect()
    assert sorted(map(tuple, rows)) == [("u1", "a"), ("u2", "unknown"), ("u3", "own")]


def test_fallback_only_when_sitemaps_are_empty(spark):
    a, b = spark.createDataFrame([("x",)], "url string"), spark.createDataFrame([("y",)], "url string")
    assert joins.discover_urls(a, b).first().url == "x"
    assert joins.discover_urls(a.where("false"), b).first().url == "y"


# ------------------------------------------------------------------ listing walk

def walk_of(spark, n, empty):
    return spark.createDataFrame([("s", p, 0 if p in empty else 1) for p in range(1, n + 1)], "category_slug string, page_num int, n_new long")


def test_walk_stops_at_the_end_of_the_batch(spark):
    rows = listing.listing_stop_rule(walk_of(spark, 120, {*range(3, 9), *range(58, 121)})).collect()
    assert max(r.page_num for r in rows) == 80


def test_streak_broken_inside_the_batch_stops_nothing(spark):
    rows = listing.listing_stop_rule(walk_of(spark, 40, set(range(15, 20)))).collect()
    assert max(r.page_num for r in rows) == 40


def test_missing_pages_count_as_empty(spark):
    links = spark.createDataFrame([("s", 1), ("s", 30)], "category_slug string, page_num int")
    rows = listing.listing_stop_rule(listing.page_walk(links)).collect()
    assert max(r.page_num for r in rows) == 20


def test_page_cap(spark):
    links = spark.createDataFrame([("s", p) for p in range(1, 61)], "category_slug string, page_num int")
    rows = listing.listing_stop_rule(listing.page_walk(links, max_pages=50), max_pages=50).collect()
    assert len(rows) == 50


def test_first_place_of_each_link(spark):
    data = [("s", 2, 0, "a"), ("s", 1, 3, "a"), ("s", 1, 1, "b"), ("t", 9, 9, "a")]
    rows = listing.first_seen(spark.createDataFrame(data, "category_slug string, page_num int, pos int, url string")).collect()
    assert sorted(map(tuple, rows)) == [("s", 1, 1, "b"), ("s", 1, 3, "a"), ("t", 9, 9, "a")]


# ------------------------------------------------------------------ bursts

def failures_frame(spark, rows):
    data = [(i, key, T0 + timedelta(seconds=s)) for i, (key, s) in enumerate(rows)]
    return spark.createDataFrame(data, "n long, key string, ts timestamp").repartition(5)


def micros(seconds):
    return int((T0 + timedelta(seconds=seconds)).timestamp() * 1_000_000)


def test_window_is_open_on_the_left(spark):
    df = failures_frame(spark, [("k", 0), ("k", 30), ("k", 60)])
    rows = bursts.failure_burst(df, "key", window_seconds=60, threshold=1).collect()
    assert [r.failures for r in sorted(rows, key=lambda r: r.ts_micros)] == [1, 2, 2]


@pytest.mark.parametrize("slices", [1, 2, 24])
def test_slices_change_nothing(spark, slices):
    rng = random.Random(3)
    rows = [("hot" if rng.random() < 0.7 else "cold", rng.randrange(0, 4000) / 2) for _ in range(1500)]
    df = failures_frame(spark, rows)
    got = {(r.key, r.ts_micros): r.failures for r in bursts.failure_burst(df, "key", window_seconds=30, threshold=5, slice_windows=slices).collect()}
    want = {}
    for key, at in rows:
        n = sum(1 for k, s in rows if k == key and at - 30 < s <= at)
        if n >= 5:
            want[(key, micros(at))] = n
    assert got == want


def test_a_full_window_is_not_summed_again_at_every_instant(spark):
    df = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, "a").alias("key"), F.timestamp_millis(F.col("id") % 29_000 + F.lit(86_390_000)).alias("ts")
    )
    found = bursts.failure_burst(df, "key", window_seconds=20, threshold=5)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "unboundedpreceding$()" in plan and "specifiedwindowframe(RangeFrame, -" not in plan
    seen = {}
    for n in range(30_000):
        key = "a" if n % 3 == 0 else None
        seen.setdefault((key, n % 29_000), 0)
        seen[key, n % 29_000] += 1
    want = {}
    for key in ("a", None):
        times = sorted(t for k, t in seen if k == key)
        upto, first = 0, 0
        for t in times:
            upto += seen[key, t]
            while times[first] <= t - 20_000:
                upto -= seen[key, times[first]]
                first += 1
            if upto >= 5:
                want[key, (t + 86_390_000) * 1000] = upto
    assert {(r.key, r.ts_micros): r.failures for r in found.collect()} == want


def brute_triggers(rows, width, need):
    held, out = defaultdict(list), []
    for key, at in sorted(rows, key=lambda r: r[1]):
        held[key] = [t for t in held[key] + [at] if t > at - width]
        if len(held[key]) >= need:
            out.append((key, micros(at)))
            held[key] = []
    return sorted(out)


@pytest.mark.parametrize("block_rows", [5, 7, 64, 200_000])
@pytest.mark.parametrize("need", [2, 3, 5])
def test_triggers_clear_the_list_across_blocks(spark, block_rows, need):
    rng = random.Random(block_rows + need)
    rows = [("hot" if rng.random() < 0.6 else f"c{rng.randrange(6)}", rng.randrange(0, 900) / 4) for _ in range(400)]
    df = failures_frame(spark, rows)
    got = bursts.failure_burst_reset(df, "key", "n", window_seconds=6, threshold=need, block_rows=block_rows)
    assert sorted((r.key, r.ts_micros) for r in got.collect()) == brute_triggers(rows, 6, need)


# ------------------------------------------------------------------ ledger

def attempts_frame(spark, rows):
    data = [(u, a, T0 + timedelta(seconds=s), o) for u, a, s, o in rows]
    return spark.createDataFrame(data, "url string, attempt int, ts timestamp, outcome string")


def test_latest_status_and_retries(spark):
    df = attempts_frame(spark, [("a", 0, 0, "error"), ("a", 1, 50, "ok"), ("b", 0, 5, "ok"), ("b", 1, 9, "throttled"), ("c", 3, 1, "gone")])
    status = ledger.latest_status(df)
    rows = {r.url: r for r in status.collect()}
    assert {u: r.outcome for u, r in rows.items()} == {"a": "ok", "b": "throttled", "c": "gone"}
    assert rows["a"].attempt == 1 and rows["a"].ts.replace(tzinfo=None) == (T0 + timedelta(seconds=50)).replace(tzinfo=None)
    retries = {r.url: r for r in ledger.retry_queue(status).collect()}
    assert set(retries) == {"b", "c"} and retries["c"].backoff_s == 8 and retries["b"].category_name == "unknown"
    summary = ledger.progress_summary(df).first()
    assert (summary.saved, summary.failed) == (1, 2)


def test_progress_rate(spark):
    day = 86_400
    df = attempts_frame(spark, [("a", 0, 0, "ok"), ("b", 0, 1, "error"), ("c", 0, 20, "ok"), ("d", 0, day + 40, "ok")])
    rows = ledger.progress_rate(df).orderBy("tick").collect()
    assert [(r.saved, r.failed, r.remaining) for r in rows] == [(1, 1, 2), (2, 1, 1), (3, 1, 0)]
    assert rows[0].rate == 1.0 and rows[1].rate == 0.1 and rows[1].eta == "??" and rows[0].eta == "00:00:02"
    assert rows[2].elapsed == "24:00:40"


# ------------------------------------------------------------------ reports

def test_validation_report_counts(spark):
    data = [
        (1, "ab", "t", "2026-01-02T00:00:00", None), (1, "ab", "t", "2026-01-02T00:00:00", None),
        (9, "", "tt", "2013-12-17T14:43:46", None), (None, None, None, None, "{bad"), (5, "پاک😀", "", "junk", None),
    ]
    df = spark.createDataFrame(data, "id long, text string, title string, published_at string, _corrupt_record string")
    row = report.validation_report(df, corrupt="_corrupt_record").first()
    assert (row.total_records, row.unique_ids, row.malformed, row.duplicates, row.empty_text) == (5, 3, 1, 1, 1)
    assert (row.chars_total, row.min_id, row.max_id) == (3 + 3 + 2 + 4, 1, 9)
    assert (row.first_published, row.last_published) == ("2013-12-17T14:43:46", "2026-01-02T00:00:00")
    again = report.validation_report(df.orderBy(F.desc("id")).repartition(4), corrupt="_corrupt_record").first()
    assert again == row


def test_checksum_ignores_order_and_sees_changes(spark):
    df = spark.range(1000).select("id", F.sha2(F.col("id").cast("string"), 256).alias("t"))
    one = report.dataset_checksum(df).first()
    assert report.dataset_checksum(df.orderBy(F.desc("id")).repartition(5)).first() == one
    changed = df.withColumn("t", F.when(F.col("id") == 17, "x").otherwise(F.col("t")))
    assert report.dataset_checksum(changed).first() != one


def test_preview_takes_the_latest_shard(spark):
    rows = [("s1", 0, "t" * 90, "b" * 200), ("s2", 1, "u" * 90, "c" * 200), ("s2", 0, "v", "d")]
    df = spark.createDataFrame(rows, "shard string, pos int, title string, body_text string")
    got = report.preview(df, "shard", "pos").collect()
    assert [(len(r.title), len(r.body_text)) for r in got] == [(1, 1), (80, 150)]


def test_category_counts_by_id(spark):
    df = spark.createDataFrame([([1, 2],), ([1],), ([],)], "categories array<bigint>")
    rows = {r.category_id: r.articles for r in report.count_by_category_id(df).collect()}
    assert rows == {1: 2, 2: 1, None: 1}
