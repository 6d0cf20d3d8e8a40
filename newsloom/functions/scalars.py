"""Small scalar rules."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Outcome classes in the order of their codes.
OUTCOMES = ("ok", "gone", "throttled", "rejected", "error")


def backoff_seconds(attempt: Column) -> Column:
    """F12, archive form: 2^attempt, at most a minute."""
    return F.least(F.lit(60.0), F.pow(F.lit(2.0), attempt)).cast("int")


def page_backoff_seconds(attempt: Column, status: Column) -> Column:
    """F12, page form: 3 s, then 10 s; twice that after a throttling answer."""
    wait = F.when(attempt < 1, F.lit(3)).otherwise(F.lit(10))
    return F.when(status.isin(429, 503), wait * 2).otherwise(wait)


def classify_outcome(status: Column, valid: Column, archive: bool = False) -> Column:
    """class of one attempt; a fetched page without a valid article is ``rejected``."""
    gone = status.isin(400, 404) if archive else status == 404
    return (
        F.when((status == 200) & valid, "ok")
        .when(status == 200, "rejected")
        .when(gone, "gone")
        .when(status.isin(429, 503), "throttled")
        .otherwise("error")
    )


def to_json_line(*columns: str) -> Column:
    """F16: compact JSON with every key present and Unicode left as it is."""
    return F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})


def parse_progress_ts(text: Column) -> Column:
    """ISO timestamp with offset or ``Z``; null when it cannot be read."""
    return F.try_to_timestamp(text)


def format_elapsed(seconds: Column) -> Column:
    """HH:MM:SS, hours may pass 99; null for null."""
    whole = seconds.cast("long")
    text = F.format_string(
        "%02d:%02d:%02d",
        F.floor(whole / 3600).cast("long"), F.floor(whole % 3600 / 60).cast("long"), whole % 60,
    )
    return F.when(whole.isNotNull(), text)


def ceil_div(total: Column, size: int) -> Column:
    """number of pages for ``total`` rows."""
    return F.ceil(total / F.lit(size)).cast("long")


def floor_div(value: Column, size: int) -> Column:
    """Whole number of ``size`` below ``value``, exact for long and negative values."""
    return ((value - F.pmod(value, F.lit(size))) / size).cast("long")


def mebibytes(size: Column) -> Column:
    return size / F.lit(1048576.0)


def percent(part: Column, whole: Column) -> Column:
    return F.round(F.lit(100.0) * part / F.nullif(whole, F.lit(0)), 1)
