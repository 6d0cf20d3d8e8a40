"""Stateful operators over an attempt or record stream."""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import BinaryType, StructField, StructType

from newsloom.operators.bursts import burst_triggers
from newsloom.operators.ledger import TICK_SECONDS, micros_of
from newsloom.session import JOB_CONF

# Executors need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def event_time(rows: DataFrame, ts: str, delay: str) -> DataFrame:
    """Watermark on ``ts``; a time without zone is taken as UTC first."""
    return rows.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, delay)


def dedup_stream(rows: DataFrame, key: str, ts: str = "ts", delay: str = "1 day") -> DataFrame:
    """First copy of each key; copies within ``delay`` of each other are dropped.

    The watermark bounds the state. For exactness over any distance use
    ``append_first_seen``.
    """
    return event_time(rows, ts, delay).dropDuplicatesWithinWatermark([key])


def progress_stream(
    ledger: DataFrame, ts: str = "ts", seconds: int = TICK_SECONDS, delay: str = "10 minutes"
) -> DataFrame:
    """Attempts and successes per progress tick (update mode)."""
    ticks = event_time(ledger, ts, delay).groupBy(F.window(ts, f"{seconds} seconds"))
    counts = ticks.agg(
        F.count("*").alias("attempts"), F.count_if(F.col("outcome") == "ok").alias("saved")
    )
    return counts.select(F.unix_micros("window.start").alias("tick_micros"), "attempts", "saved")


def burst_windows(
    failures: DataFrame, ts: str = "ts", window_seconds: int = 60, slide_seconds: int = 5,
    threshold: int = 5, delay: str = "10 minutes",
) -> DataFrame:
    """T4: sliding windows with at least ``threshold`` failures (update mode)."""
    sliding = F.window(ts, f"{window_seconds} seconds", f"{slide_seconds} seconds")
    counts = event_time(failures, ts, delay).groupBy(sliding).agg(F.count("*").alias("failures"))
    return counts.where(F.col("failures") >= threshold).select(
        F.unix_micros("window.start").alias("start_micros"), "failures"
    )


def burst_with_reset(
    failures: DataFrame, key: str, ts: str = "ts", window_seconds: int = 60, threshold: int = 5
) -> DataFrame:
    """T5, at once: W5 in a stream, a trigger in the batch that brings its last failure. State is the last
    failures that still count, fewer than the threshold; a batch is read in time order. A
    failure earlier than the newest one that is held is late and does not count;
    ``burst_with_reset_by_time`` waits for such failures."""
    width, need = window_seconds * 1_000_000, threshold
    kind = failures.schema[key].dataType.simpleString()

    def step(group: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        held = np.array(state.get[0] if state.exists else [], dtype=np.int64)
        new = np.sort(np.concatenate([b.ts_micros.to_numpy() for b in batches]))
        new = new[new >= held[-1]] if len(held) else new
        times = np.concatenate([held, new])
        hits = burst_triggers(times, len(held), width, need)
        since = len(times) - 1 - hits[-1] if len(hits) else len(times)
        keep = times[len(times) - min(need - 1, since):]
        state.update((keep.tolist(),))
        yield pd.DataFrame({key: [group[0]] * len(hits), "ts_micros": times[hits]})

    rows = failures.select(key, micros_of(F.col(ts)).alias("ts_micros"))
    return rows.groupBy(key).applyInPandasWithState(
        step, f"{key} {kind}, ts_micros long", "held array<bigint>", "append",
        GroupStateTimeout.NoTimeout,
    )


_ENTRY = 1 << 16                            # times in an entry of a state list


def _packed(times: np.ndarray) -> list[tuple[bytes]]:
    return [(times[at:at + _ENTRY].astype("<i8").tobytes(),) for at in range(0, len(times), _ENTRY)]


def _unpacked(entries: Iterator[tuple[bytes]]) -> np.ndarray:
    return np.concatenate([np.empty(0, np.int64), *(np.frombuffer(values, "<i8") for values, in entries)])


class _TimedBursts(StatefulProcessor):
    """Failures of one key: those that wait for the watermark, and those before it that still count.

    An entry of a state list is up to ``_ENTRY`` times in a row of bytes: an entry each would cost more than the rule.
    """

    def __init__(self, key: str, width: int, need: int):
        self.key, self.width, self.need = key, width, need

    def init(self, handle: StatefulProcessorHandle) -> None:
        times = StructType([StructField("times", BinaryType())])
        self.handle = handle
        self.waiting = handle.getListState("waiting", times)
        self.held = handle.getListState("held", times)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        reached = timerValues.getCurrentWatermarkInMs() * 1000
        new = np.concatenate([b.ts_micros.to_numpy(np.int64) for b in rows])
        new = new[new > reached]            # what is older than the watermark has been decided without it
        if len(new):
            self.waiting.appendList(_packed(new))
            self._wake(int(new.min()))
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        reached = timerValues.getCurrentWatermarkInMs() * 1000
        waiting, held = np.sort(_unpacked(self.waiting.get())), _unpacked(self.held.get())
        due, later = waiting[waiting <= reached], waiting[waiting > reached]
        times = np.concatenate((held, due))
        hits = burst_triggers(times, len(held), self.width, self.need)
        since = len(times) - 1 - hits[-1] if len(hits) else len(times)
        keep = times[len(times) - min(self.need - 1, since):]
        keep = keep[keep > reached - self.width]
        for state, values in ((self.waiting, later), (self.held, keep)):
            state.clear()
            if len(values):
                state.put(_packed(values))
        # the next failure to decide, or the time when the last one held stops to count and nothing is left
        if len(later):
            self._wake(int(later[0]))
        elif len(keep):
            self._wake(int(keep[-1]) + self.width)
        if len(hits):
            yield pd.DataFrame({self.key: [key[0]] * len(hits), "ts_micros": times[hits]})

    def _wake(self, micros: int) -> None:
        self.handle.registerTimer(-(-micros // 1000))

    def close(self) -> None:
        pass


def burst_with_reset_by_time(
    failures: DataFrame, key: str, ts: str = "ts", window_seconds: int = 60, threshold: int = 5, delay: str = "10 minutes"
) -> DataFrame:
    """T5: W5 in a stream, exact for failures that are late by up to ``delay``.

    Failures wait in state until the watermark has passed them and are then decided in time order, so
    triggers come later by the delay and do not depend on how failures arrive. A key whose
    failures have all left the window keeps no state. A busy key's batch is handled in one task. Failures
    without a key are those of one key more. Needs the RocksDB state store, which is set here.
    """
    spark = failures.sparkSession
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", JOB_CONF["spark.sql.streaming.stateStore.providerClass"])
    kind = failures.schema[key].dataType.simpleString()
    rows = event_time(failures.where(F.col(ts).isNotNull()).select(key, ts), ts, delay).withColumn("ts_micros", F.unix_micros(ts))
    return rows.groupBy(key).transformWithStateInPandas(
        _TimedBursts(key, window_seconds * 1_000_000, threshold), f"{key} {kind}, ts_micros long", "Append", "EventTime"
    )
