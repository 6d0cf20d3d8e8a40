"""Global row numbers without a one-task window."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from newsloom.session import scratch

_FILE, _ROW, _BEFORE = "__file", "__row", "__before"


def number_rows(
    df: DataFrame, *order_by: str, rn: str = "rn", total: str | None = None, partitions: int | None = None
) -> DataFrame:
    """Add the 1-based position of every row in the order of ``order_by``.

    The rows are range-partitioned, sorted and written once to the shared folder; a
    row's number is the row count of the files before its own plus its place in the
    file. Files do not change when a task is lost and run again, and the only thing
    broadcast is one row per file. ``order_by`` should be a total order, so that ties
    cannot pile up in one range.
    """
    spark = df.sparkSession
    path = scratch(spark, "ranked")
    spread = (
        df.repartitionByRange(partitions, *order_by) if partitions else df.repartitionByRange(*order_by)
    )
    spread.sortWithinPartitions(*order_by).write.option("maxRecordsPerFile", 0).parquet(path)
    stored = spark.read.schema(df.schema).parquet(path)
    name = F.col("_metadata.file_name")
    counts = stored.groupBy(name.alias(_FILE)).agg(F.count("*").alias("__n"))
    by_part = Window.orderBy(F.regexp_extract(_FILE, r"^part-(\d+)", 1).cast("int"))
    whole = Window.partitionBy()
    offsets = counts.select(
        _FILE,
        (F.sum("__n").over(by_part) - F.col("__n")).alias(_BEFORE),
        F.sum("__n").over(whole).alias("__total"),
    )
    placed = stored.select("*", name.alias(_FILE), F.col("_metadata.row_index").alias(_ROW))
    extra = [F.col("__total").alias(total)] if total else []
    return placed.join(F.broadcast(offsets), _FILE).select(
        *df.columns, (F.col(_BEFORE) + F.col(_ROW) + 1).alias(rn), *extra
    )


def chunk_of(rn: Column, total: Column, chunks: int, first: int = 0) -> Column:
    """Contiguous slices of ``total // chunks`` rows; the last takes the remainder."""
    size = F.floor(total / chunks)
    return (
        F.when(size == 0, F.lit(chunks - 1))
        .otherwise(F.least(F.floor((rn - 1) / F.nullif(size, F.lit(0))), F.lit(chunks - 1)))
        .cast("int") + F.lit(first)
    )


def assign_chunk(df: DataFrame, *order_by: str, chunks: int, first: int = 0) -> DataFrame:
    """Add ``chunk``. ``first=1`` numbers the chunks from 1."""
    if chunks < 1:
        raise ValueError("chunks must be at least 1")
    numbered = number_rows(df, *order_by, rn="rn", total="__total_rows")
    return numbered.withColumn(
        "chunk", chunk_of(F.col("rn"), F.col("__total_rows"), chunks, first)
    ).drop("__total_rows")


def take_chunk(df: DataFrame, *order_by: str, chunks: int, number: int, first: int = 0) -> DataFrame:
    """One session's slice; ``number = first - 1`` asks for all rows."""
    if not first - 1 <= number < first + chunks:
        raise ValueError(f"number must be between {first - 1} and {first + chunks - 1}")
    if number == first - 1:
        return df
    mine = assign_chunk(df, *order_by, chunks=chunks, first=first).where(F.col("chunk") == number)
    return mine.drop("rn", "chunk")


def assign_shard(df: DataFrame, *order_by: str, shard_rows: int = 500) -> DataFrame:
    """Add ``shard``, the row position divided by the shard size."""
    if shard_rows < 1:
        raise ValueError("shard_rows must be at least 1")
    return number_rows(df, *order_by).withColumn(
        "shard", F.floor((F.col("rn") - 1) / shard_rows).cast("long")
    )


def line_count(df: DataFrame, chunks: int) -> DataFrame:
    """Number of rows and the share of each chunk."""
    return df.agg(F.count("*").alias("lines")).select(
        "lines", F.floor(F.col("lines") / chunks).alias("lines_per_chunk")
    )
