"""Streams over several batches: late rows, restarts, replays, and what a batch has to read."""

from __future__ import annotations

import json
from datetime import datetime, timedelta, timezone

from pyspark.sql import functions as F
from pyspark.sql import types as T

from newsloom.streaming import operators, sinks
from newsloom.streaming.keystore import KeyStore
from newsloom.streaming.manifest import Manifest
from newsloom.streaming.sources import stream_files

T0 = datetime(2026, 1, 1, tzinfo=timezone.utc)
FAILURES = "key string, ts timestamp"


def land(spark, tmp_path, rows, name="failures"):
    spark.createDataFrame([(k, T0 + timedelta(seconds=s)) for k, s in rows], FAILURES).coalesce(1).write.mode("append").parquet(f"{tmp_path}/{name}")
    return stream_files(spark, f"{tmp_path}/{name}", T._parse_datatype_string(FAILURES), files_per_trigger=1)


def bursts(spark, tmp_path, stream):
    rows = operators.burst_with_reset_by_time(stream, "key", window_seconds=60, threshold=3, delay="100 seconds")
    sinks.ingest_stream(rows, f"{tmp_path}/out", f"{tmp_path}/mark")
    start = int(T0.timestamp() * 1e6)
    return sorted((r.key, (r.ts_micros - start) // 1_000_000) for r in spark.read.schema(rows.schema).parquet(f"{tmp_path}/out").collect())


def test_late_failures_count_until_the_watermark(spark, tmp_path):
    land(spark, tmp_path, [("k", 0), ("k", 30), ("j", 10)])
    assert bursts(spark, tmp_path, land(spark, tmp_path, [("k", 90), ("k", 95)])) == []
    # late but inside the delay: 20 makes 0, 20, 30 a burst, so 90 and 95 start anew
    assert bursts(spark, tmp_path, land(spark, tmp_path, [("k", 20), ("j", 260)])) == [("k", 30)]
    # 100 is behind the watermark (160) by now: 90, 95 and 100 are no burst
    assert bursts(spark, tmp_path, land(spark, tmp_path, [("k", 100), ("j", 270), ("j", 280)])) == [("k", 30)]
    assert bursts(spark, tmp_path, land(spark, tmp_path, [("z", 2000)])) == [("j", 280), ("k", 30)]


def test_idle_keys_leave_no_state(spark, tmp_path):
    land(spark, tmp_path, [(f"k{i}", i) for i in range(20)])
    bursts(spark, tmp_path, land(spark, tmp_path, [("z", 5000)]))
    bursts(spark, tmp_path, land(spark, tmp_path, [("z", 9000)]))
    state = spark.read.format("statestore").option("stateVarName", "held").option("flattenCollectionTypes", True).load(f"{tmp_path}/mark")
    assert {r.key[0] for r in state.select("key").collect()} <= {"z"}
    state = spark.read.format("statestore").option("stateVarName", "waiting").option("flattenCollectionTypes", True).load(f"{tmp_path}/mark")
    assert {r.key[0] for r in state.select("key").collect()} <= {"z"}


def test_waiting_failures_are_few_entries_of_state(spark, tmp_path):
    """Nine thousand failures wait; the next run decides them as brute force does."""
    at = [n // 3 * 7 % 99 for n in range(9000)]
    assert bursts(spark, tmp_path, land(spark, tmp_path, [("k", s) for s in at])) == []
    state = spark.read.format("statestore").option("stateVarName", "waiting").option("flattenCollectionTypes", True).load(f"{tmp_path}/mark")
    assert 1 <= state.count() <= 4
    got = bursts(spark, tmp_path, land(spark, tmp_path, [("z", 9000)]))
    want, held = [], []
    for s in sorted(at):
        held = [t for t in held + [s] if t > s - 60]
        if len(held) == 3:
            want.append(("k", s))
            held = []
    assert got == sorted(want)


def test_key_store_reads_little_and_knows_its_own(spark, tmp_path):
    """Twenty batches of new and old keys: every key once, few entries, own keys not taken for others'."""
    store = KeyStore(spark, f"{tmp_path}/keys", T.LongType(), buckets=4, fan=3)
    for batch in range(20):
        keys = spark.range(batch * 5, batch * 5 + 10).coalesce(1)
        fresh = keys.join(store.seen(keys, "id", "r", batch), "id", "left_anti")
        assert fresh.count() == (10 if not batch else 5)
        store.add(spark.createDataFrame(fresh.collect(), "id long"), "id", "r", batch)
        # a batch that runs again finds what it found before
        assert keys.join(store.seen(keys, "id", "r", batch), "id", "left_anti").count() == (10 if not batch else 5)
    entries = store.manifest.entries()
    assert len(entries) <= 2 * 3 and max(e["level"] for e in entries) == 2
    assert store.seen(spark.range(200), "id", "r", 99).count() == 105
    one = store.seen(spark.createDataFrame([(7,)], "id long"), "id", "r", 99)
    read = [f for f in one.inputFiles() if "/segments/" in f]
    assert read and len({f.rsplit("bucket=", 1)[1][0] for f in read}) == 1


def test_batches_read_no_old_rows(spark, tmp_path):
    out = f"{tmp_path}/out"
    rows = lambda n, word: spark.createDataFrame([(f"u{i}", word * 50, n) for i in range(n, n + 4)], "url string, body string, delivery int")
    for n in range(3):
        sinks.store_first_seen(rows(n, "abc"[n]), n, out, "mark", "url", "delivery")
    sinks.store_first_seen(rows(1, "b"), 1, out, "mark", "url", "delivery")
    got = spark.read.parquet(out)
    assert sorted((r.url, r.body[0]) for r in got.collect()) == [(f"u{i}", "aaaabc"[i]) for i in range(6)]
    store = KeyStore(spark, f"{out}/_keys", T.StringType())
    plan = store.seen(got, "url", "x", 0)._jdf.queryExecution().executedPlan().toString()
    assert "body" not in plan and f"{tmp_path}/out/run=" not in plan


def test_equal_deliveries_keep_one_row_for_certain(spark, tmp_path):
    rows = [("u", c, 1) for c in "qwertz"] + [(None, "x", 1), (None, "x", 1)]
    got = set()
    for n, order in enumerate((rows, rows[::-1])):
        batch = spark.createDataFrame(order, "url string, body string, delivery int").repartition(3)
        sinks.store_first_seen(batch, 0, f"{tmp_path}/{n}", "mark", "url", "delivery")
        kept = spark.read.parquet(f"{tmp_path}/{n}").collect()
        assert len(kept) == 3
        got.add(next(r.body for r in kept if r.url))
    assert len(got) == 1


def test_outputs_without_a_key_store_are_taken_over(spark, tmp_path):
    old = spark.createDataFrame([("a", "x", 1), ("b", "x", 1)], "url string, body string, delivery int")
    old.write.parquet(f"{tmp_path}/out/run=r/batch_id=0")
    new = spark.createDataFrame([("b", "y", 2), ("c", "y", 2)], old.schema)
    sinks.store_first_seen(new, 0, f"{tmp_path}/out", "mark", "url", "delivery")
    assert sorted((r.url, r.body) for r in spark.read.parquet(f"{tmp_path}/out").collect()) == [("a", "x"), ("b", "x"), ("c", "y")]


def test_updates_are_folded_and_ordered_by_commit(spark, tmp_path):
    """Nine batches, a snapshot every three, a second run: the last commit counts and readers read few folders."""
    path = f"{tmp_path}/p"
    for run in ("m1", "m2"):
        for second in range(5):
            stream = land(spark, tmp_path, [("a", 15 * second), ("a", 0)], name=run)
        counts = stream.withColumn("outcome", F.lit("ok"))
        rows = operators.progress_stream(counts)
        sinks.write_updates(rows, path, f"{tmp_path}/{run}-mark", "tick_micros", fold_every=3)
    latest = sinks.latest_updates(spark, path, rows.schema, "tick_micros")
    assert sorted(r.attempts for r in latest.collect()) == [1, 1, 1, 1, 6]
    assert len(Manifest(spark, f"{path}/_manifest").entries()) <= 4
    assert len({f.rsplit("/", 2)[1] for f in latest.inputFiles()}) <= 4


def test_manifest_versions(spark, tmp_path):
    manifest = Manifest(spark, f"{tmp_path}/m")
    assert manifest.entries() == []
    for n in range(6):
        manifest.commit([{"n": n}])
    assert manifest.entries() == [{"n": 5}] and len(manifest.versions()) <= 4
    assert json.loads((tmp_path / "m" / f"{manifest.versions()[-1]:012d}.json").read_text()) == [{"n": 5}]
