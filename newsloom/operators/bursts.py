"""Bursts of failures per key."""

from __future__ import annotations

import sys

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from newsloom.functions.scalars import floor_div
from newsloom.operators.ledger import micros_of
from newsloom.operators.numbering import number_rows
from newsloom.session import scratch

# Executors need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def failure_burst(
    failures: DataFrame, key: str, ts: str = "ts", window_seconds: int = 60, threshold: int = 5,
    slice_windows: int = 24,
) -> DataFrame:
    """Instants at which ``threshold`` failures lie in ``(now - window, now]``.

    Each key's time line is cut into slices of ``slice_windows`` windows; the last
    window of a slice is also given to the next one, as context. So a busy key is
    spread over many tasks. Inside a slice failures are added at their instant and taken off again a window later,
    so a running sum gives the count, in one step per row however many a window holds.
    """
    width = window_seconds * 1_000_000
    length = width * slice_windows
    at = F.col("ts_micros")
    per_instant = failures.groupBy(key, micros_of(F.col(ts)).alias("ts_micros")).agg(
        F.count("*").alias("n")
    )
    own = floor_div(at, length)
    slices = F.when(at > (own + 1) * length - width, F.array(own, own + 1)).otherwise(F.array(own))
    sliced = per_instant.select("*", F.explode(slices).alias("__slice"))
    steps = F.array(*(
        F.struct(instant.alias("ts_micros"), n.alias("n"), F.lit(real).alias("__own"))
        for instant, n, real in ((at, F.col("n"), True), (at + width, -F.col("n"), False))
    ))
    stepped = sliced.select(key, "__slice", F.explode(steps).alias("__step")).select(key, "__slice", "__step.*")
    frame = Window.partitionBy(key, "__slice").orderBy("ts_micros").rangeBetween(Window.unboundedPreceding, 0)
    return (
        stepped.withColumn("failures", F.sum("n").over(frame))
        .where((F.col("__slice") == own) & F.col("__own") & (F.col("failures") >= threshold))
        .select(key, "ts_micros", "failures")
    )


def burst_triggers(times: np.ndarray, held: int, width: int, need: int) -> np.ndarray:
    """Places in a run where the count reaches ``need`` and is set to zero again.

    ``times`` starts with the ``held`` failures carried in; places count from there.
    """
    if len(times) < need:
        return np.array([], dtype=np.int64)
    reach = np.flatnonzero(times[need - 1:] - times[:len(times) - need + 1] < width) + need - 1
    hits, allowed = [], max(need - 1, held)
    while (i := np.searchsorted(reach, allowed)) < len(reach):
        hits.append(reach[i])
        allowed = reach[i] + need
    return np.array(hits, dtype=np.int64)


def _carry(times: np.ndarray, held: int, width: int, need: int) -> int:
    """How many of the last failures still count after the run."""
    hits = burst_triggers(times, held, width, need)
    since = len(times) - 1 - hits[-1] if len(hits) else len(times)
    return int(min(need - 1, since))


def failure_burst_reset(
    failures: DataFrame, key: str, order: str, ts: str = "ts", window_seconds: int = 60,
    threshold: int = 5, block_rows: int = 200_000,
) -> DataFrame:
    """As W4, but a trigger clears the list, so triggers do not overlap.

    The rule is sequential per key, but all it carries forward is how many of the last
    ``threshold - 1`` failures still count. So the sorted failures are cut into blocks
    of ``block_rows``; a first pass gives each block's answer for every carried-in
    count, a fold over these summaries fixes the count each block really starts with,
    and a second pass gives the triggers. A key may span any number of blocks.
    ``order`` is a unique column that settles equal times. Failures without a key are
    those of one key more, as in W4.
    """
    width, need = window_seconds * 1_000_000, threshold
    if need < 2 or block_rows < need:
        raise ValueError("threshold must be at least 2 and block_rows at least the threshold")
    kind = "string"
    # as text with a mark, so that a missing key is a key that compares like any other
    marked = F.coalesce(F.concat(F.lit("="), F.col(key).cast("string")), F.lit("-")).alias(key)
    rows = number_rows(failures.select(marked, micros_of(F.col(ts)).alias("ts_micros"), order), key, "ts_micros", order)
    rn = F.col("rn") - 1
    own = floor_div(rn, block_rows)
    in_tail = rn % block_rows >= block_rows - (need - 1)
    blocks = rows.select(
        F.col(key).alias("key"), "ts_micros", F.col("rn"),
        F.explode(F.when(in_tail, F.array(own, own + 1)).otherwise(F.array(own))).alias("block"),
    ).withColumn("context", floor_div(F.col("rn") - 1, block_rows) != F.col("block"))

    def split(part: pd.DataFrame):
        part = part.sort_values("rn")
        ahead, mine = part[part.context], part[~part.context]
        return ahead, mine

    def summarize(part: pd.DataFrame) -> pd.DataFrame:
        ahead, mine = split(part)
        if mine.empty:
            return pd.DataFrame(columns=["block", "first_key", "last_key", "spans", "carried"])
        first, last = mine.key.iloc[0], mine.key.iloc[-1]
        before = ahead.ts_micros[ahead.key == first].to_numpy()
        run = mine.ts_micros[mine.key == last].to_numpy()
        spans = bool(first == last)
        carried = []
        for held in range(need):
            lead = before[len(before) - held:] if spans and held <= len(before) else before[:0]
            carried.append(_carry(np.concatenate([lead, run]), len(lead), width, need))
        return pd.DataFrame(
            {"block": [part.block.iloc[0]], "first_key": [first], "last_key": [last],
             "spans": [spans], "carried": [carried]}
        )

    summary = blocks.groupBy("block").applyInPandas(
        summarize,
        f"block long, first_key {kind}, last_key {kind}, spans boolean, carried array<int>",
    )
    # one row per block; two branches read it
    path = scratch(failures.sparkSession, "blocks")
    summary.write.parquet(path)
    summary = failures.sparkSession.read.schema(summary.schema).parquet(path)

    def fold(chain: pd.DataFrame) -> pd.DataFrame:
        chain = chain.sort_values("block")
        held, previous, out = 0, None, []
        for block, spans, starts, carried in zip(chain.block, chain.spans, chain.starts, chain.carried):
            held = held if starts and previous == block - 1 else 0
            out.append(held)
            held, previous = int(carried[held if spans else 0]), block
        return pd.DataFrame({"start_block": chain.block, "held": out})

    # A block takes part in the chain of its last key, and in that of its first key when
    # that key began earlier: one summary row stands for block_rows failures.
    ends = summary.select(F.col("last_key").alias("chain"), "block", "spans", F.col("spans").alias("starts"), "carried")
    enters = summary.where(~F.col("spans")).select(
        F.col("first_key").alias("chain"), "block", F.lit(True).alias("spans"),
        F.lit(True).alias("starts"), F.array_repeat(F.lit(0), need).alias("carried"),
    )
    starts = ends.unionByName(enters).groupBy("chain").applyInPandas(fold, "start_block long, held int")
    starts = starts.groupBy("start_block").agg(F.max("held").alias("held"))
    ready = blocks.join(starts, F.col("block") == F.col("start_block"), "left").drop("start_block")

    def emit(part: pd.DataFrame) -> pd.DataFrame:
        ahead, mine = split(part)
        found = []
        for name, run in mine.groupby("key", sort=False):
            times, lead = run.ts_micros.to_numpy(), ahead.ts_micros[:0].to_numpy()
            if name == mine.key.iloc[0]:
                before = ahead.ts_micros[ahead.key == name].to_numpy()
                held = int(part.held.fillna(0).iloc[0])
                lead = before[len(before) - held:] if held else lead
            hits = burst_triggers(np.concatenate([lead, times]), len(lead), width, need) - len(lead)
            found.append(pd.DataFrame({"key": name, "ts_micros": times[hits]}))
        return pd.concat(found) if found else pd.DataFrame(columns=["key", "ts_micros"])

    triggers = ready.groupBy("block").applyInPandas(emit, f"key {kind}, ts_micros long")
    name = F.when(F.col("key") != "-", F.substring("key", 2, 2**31 - 1)).cast(failures.schema[key].dataType)
    return triggers.select(name.alias(key), "ts_micros")
