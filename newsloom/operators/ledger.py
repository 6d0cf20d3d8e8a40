"""What the attempt ledger says.

A ledger has one row per attempt. State is derived from it, never stored; every
reduction combines before its shuffle, so one busy key or source is no hot task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from newsloom.functions.scalars import backoff_seconds, floor_div, format_elapsed
from newsloom.session import scratch

TICK_SECONDS = 15  # Fixed value: seconds between two progress lines.


def micros_of(ts: Column) -> Column:
    return F.unix_micros(ts.cast("timestamp"))


def progress_rate(
    ledger: DataFrame, tick_seconds: int = TICK_SECONDS, work: DataFrame | None = None
) -> DataFrame:
    """Running totals, rate and time left at every tick with an attempt.

    What remains is counted against ``work``, the list of what was to be done; without
    one, against the attempts of the ledger, so that nothing remains at its end.

    Needs ``ts`` and ``outcome``. Attempts are reduced to ticks, which are stored: their
    number depends on the time a run takes, not on its size. Ticks are summed inside
    their day, and days (a few thousand rows in ten years) are summed after.
    """
    ok = F.col("outcome") == "ok"
    us = micros_of(F.col("ts"))
    total = None if work is None else work.count()
    day_us = 86_400_000_000
    tick_us = tick_seconds * 1_000_000
    counted = ledger.groupBy(floor_div(us, tick_us).alias("tick")).agg(
        F.count_if(ok).alias("ok"), F.count("*").alias("n"), F.min(us).alias("lo"), F.max(us).alias("hi"),
    ).withColumn("day", floor_div(F.col("tick") * tick_us, day_us))
    path = scratch(ledger.sparkSession, "ticks")
    counted.write.parquet(path)
    ticks = ledger.sparkSession.read.schema(counted.schema).parquet(path)
    days = ticks.groupBy("day").agg(F.sum("ok").alias("d_ok"), F.sum("n").alias("d_n"), F.min("lo").alias("d_lo"))
    earlier = Window.orderBy("day").rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy()
    days = days.select(
        "day",
        F.coalesce(F.sum("d_ok").over(earlier), F.lit(0)).alias("ok_before"),
        F.coalesce(F.sum("d_n").over(earlier), F.lit(0)).alias("n_before"),
        F.min("d_lo").over(every).alias("start"),
        F.sum("d_n").over(every).alias("pending"),
    )
    in_day = Window.partitionBy("day").orderBy("tick").rowsBetween(Window.unboundedPreceding, 0)
    run = ticks.select(
        "day", "tick", "hi", F.sum("ok").over(in_day).alias("ok"), F.sum("n").over(in_day).alias("n")
    ).join(days, "day")
    elapsed = F.floor((F.col("hi") - F.col("start")) / 1_000_000).cast("long")
    saved = F.col("ok_before") + F.col("ok")
    done = F.col("n_before") + F.col("n")
    run = run.select(
        "tick", elapsed.alias("elapsed_s"), saved.alias("saved"), (done - saved).alias("failed"),
        F.greatest((F.col("pending") if total is None else F.lit(total)) - done, F.lit(0)).alias("remaining"),
        (saved / F.greatest(elapsed, F.lit(1))).alias("rate"),
    )
    eta = F.when(F.col("rate") > 0.1, F.floor(F.col("remaining") / F.col("rate")).cast("long"))
    return run.select(
        "tick", "elapsed_s", format_elapsed(F.col("elapsed_s")).alias("elapsed"), "saved", "failed",
        "remaining", "rate", eta.alias("eta_s"), F.coalesce(format_elapsed(eta), F.lit("??")).alias("eta"),
    )


# The classes of F13. The place of a class in the list settles attempts of one time and number.
OUTCOMES = ("other", "error", "gone", "ok", "rejected", "throttled")
_TIME, _NUMBER = 10**13, 10


def packed_attempt(ts: Column, attempt: Column, outcome: Column) -> Column:
    """Time, number and outcome class of an attempt in one number of fixed width, which orders attempts.

    Such a number can be reduced in place by a hash aggregate; a struct or a text cannot.
    """
    code = F.coalesce(F.array_position(F.array(*map(F.lit, OUTCOMES)), outcome), F.lit(0))
    code = F.greatest(code - 1, F.lit(0))
    number = F.coalesce(attempt.cast("long") + 1, F.lit(0))
    return (
        micros_of(ts).cast("decimal(20,0)") * F.lit(_TIME).cast("decimal(14,0)") + (number * _NUMBER + code).cast("decimal(20,0)")
    ).cast("decimal(38,0)")


def unpacked_attempt(packed: Column) -> dict[str, Column]:
    """``ts``, ``attempt`` and ``outcome`` of ``packed_attempt``; an unknown class is ``other``."""
    rest = F.pmod(packed, F.lit(_TIME).cast("decimal(14,0)"))
    low = rest.cast("long")
    number = F.floor(low / _NUMBER)
    return {
        "attempt": F.when(number > 0, number - 1).cast("int"),
        "ts": F.timestamp_micros(((packed - rest) / F.lit(_TIME).cast("decimal(14,0)")).cast("long")),
        "outcome": F.element_at(F.array(*map(F.lit, OUTCOMES)), (F.pmod(low, F.lit(_NUMBER)) + 1).cast("int")),
    }


def key_state(ledger: DataFrame, key: str = "url") -> DataFrame:
    """(key, last, first_micros, attempts): what all later reports need, one hash aggregate over fixed-width values."""
    return ledger.groupBy(key).agg(
        F.max(packed_attempt(F.col("ts"), F.col("attempt"), F.col("outcome"))).alias("last"),
        F.min(micros_of(F.col("ts"))).alias("first_micros"), F.count("*").alias("attempts"),
    )


def merged_state(states: DataFrame, key: str = "url") -> DataFrame:
    """States of several parts of a ledger as one."""
    return states.groupBy(key).agg(
        F.max("last").alias("last"), F.min("first_micros").alias("first_micros"), F.sum("attempts").alias("attempts")
    )


def status_of(state: DataFrame, key: str = "url") -> DataFrame:
    """Last attempt and time of the first attempt per key, from ``key_state``.

    The last attempt has the latest time, then the highest attempt number, one without a number first. A later
    success takes a URL off the failed list.
    """
    parts = unpacked_attempt(F.col("last"))
    return state.select(key, *(c.alias(name) for name, c in parts.items()), "first_micros", "attempts")


def _key_status(ledger: DataFrame, key: str) -> DataFrame:
    return status_of(key_state(ledger, key), key).drop("attempts")


def latest_status(ledger: DataFrame, key: str = "url") -> DataFrame:
    """Outcome of the last attempt per key, with its time and number."""
    return _key_status(ledger, key).drop("first_micros")


def retry_queue(status: DataFrame) -> DataFrame:
    """Keys whose last attempt failed, category reset, with the earliest next time."""
    wait = backoff_seconds(F.col("attempt"))
    return status.where(F.col("outcome") != "ok").select(
        *[c for c in status.columns if c not in ("category_name",)],
        F.lit("unknown").alias("category_name"),
        wait.alias("backoff_s"),
        (F.col("ts") + F.make_dt_interval(secs=wait)).alias("next_at"),
    )


def progress_summary(ledger: DataFrame, key: str = "url") -> DataFrame:
    """A4: keys saved, keys still failing, first and last attempt."""
    return _key_status(ledger, key).agg(
        F.count_if(F.col("outcome") == "ok").alias("saved"),
        F.count_if(F.col("outcome") != "ok").alias("failed"),
        F.timestamp_micros(F.min("first_micros")).alias("start_time"),
        F.max("ts").alias("last_saved_at"),
    )


def sorted_done_pages(done: DataFrame, page: str = "page") -> DataFrame:
    """Done pages, each once, in order."""
    return done.select(page).distinct().orderBy(page)
