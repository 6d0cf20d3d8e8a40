"""One row per key, deterministically."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsloom.session import scratch


def distinct_urls(urls: DataFrame, column: str = "url") -> DataFrame:
    """The set of URLs (sort only when it is written or shown)."""
    return urls.select(column).where(F.col(column).isNotNull()).distinct()


def union_distinct_urls(parts: list[DataFrame], column: str = "url") -> DataFrame:
    """One set over all sitemap files."""
    return distinct_urls(reduce(DataFrame.unionByName, [p.select(column) for p in parts]), column)


def repeated_rows(df: DataFrame, key: Column, position: str) -> DataFrame:
    """Positions of the rows that have an earlier row with the same key.

    Key and position are stored first, so that the rows are read, and a key that is computed is
    computed, once. The counts are combined before the shuffle, so a
    key holding a third of all rows is one record per task; the join back has one row
    per repeated key on its right, which adaptive execution broadcasts when it is
    small and otherwise joins with the hot key split. A row without a key repeats nothing.
    """
    spark, path = df.sparkSession, scratch(df.sparkSession, "keys")
    narrow = df.select(key.alias("__key"), F.col(position).alias("__pos")).where("__key is not null")
    narrow.write.parquet(path)
    narrow = spark.read.schema(narrow.schema).parquet(path)
    first = (
        narrow.groupBy("__key")
        .agg(F.min("__pos").alias("__first"), F.count("*").alias("__n"))
        .where("__n > 1")
        .select(F.col("__key").alias("__k"), "__first")
    )
    return narrow.join(first, F.col("__key") == F.col("__k")).where(
        F.col("__pos") > F.col("__first")
    ).select(F.col("__pos").alias(position))


def dedup_keep_first(df: DataFrame, key: Column | str, position: str) -> DataFrame:
    """Keep, per key, the row with the lowest ``position``.

    ``position`` is unique per row and comes from the data or from a stored table (see
    ``land_articles``), because it is read twice.

    The repeats are stored in the shared folder first, so the planner knows their real
    size: few repeats are broadcast and the wide rows are not shuffled at all; many are
    joined on the position, which spreads evenly whatever the keys look like.
    """
    key = F.col(key) if isinstance(key, str) else key
    spark = df.sparkSession
    path = scratch(spark, "repeats")
    repeats = repeated_rows(df, key, position)
    repeats.write.parquet(path)
    stored = spark.read.schema(repeats.schema).parquet(path)
    return df.join(stored, position, "left_anti")


def cross_chunk_merge(parts: list[DataFrame], key: str, position: str) -> DataFrame:
    """Outputs of several runs put together, overlaps removed, earlier parts first."""
    numbered = [
        part.withColumn("__part", F.lit(i)).withColumn("__at", F.struct("__part", position))
        for i, part in enumerate(parts)
    ]
    merged = reduce(DataFrame.unionByName, numbered)
    return dedup_keep_first(merged, key, "__at").drop("__part", "__at")


def duplicates_report(df: DataFrame, key: Column | str, kept: DataFrame | None = None) -> DataFrame:
    """Rows in, rows that D1 keeps and removes (rows without a key are kept), and the duplicates
    that remain in ``kept``, the rows D1 gave."""
    key = F.col(key) if isinstance(key, str) else key

    def counted(rows: DataFrame) -> DataFrame:
        per_key = rows.groupBy(key.alias("__key")).agg(F.count("*").alias("n"))
        unique = F.when(F.col("__key").isNull(), F.col("n")).otherwise(1)
        return per_key.agg(
            F.coalesce(F.sum("n"), F.lit(0)).alias("rows_in"), F.coalesce(F.sum(unique), F.lit(0)).alias("rows_kept")
        )

    report = counted(df).select("rows_in", "rows_kept", (F.col("rows_in") - F.col("rows_kept")).alias("rows_removed"))
    if kept is None:
        return report
    left = counted(kept).first()
    return report.withColumn("remaining", F.lit(left.rows_in - left.rows_kept).cast("long"))
