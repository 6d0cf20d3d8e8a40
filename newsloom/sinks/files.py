"""K1, K2, K4-K8: writers. Every write is one distributed, atomically committed job."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newsloom.operators.numbering import assign_shard
from newsloom.operators.report import shard_stats

SHARD_ROWS = 500  # Fixed value: records per shard.
PART_BYTES = 90_000_000  # Fixed value: bytes per part of a delivered archive.


def _gzip_lines(writer):
    return writer.option("compression", "gzip").option("ignoreNullFields", "false")


def write_article_shards(
    articles: DataFrame, path: str, shard_rows: int = SHARD_ROWS, mode: str = "error"
) -> None:
    """K1: gzip JSON lines, a new file at every ``shard_rows`` records, nulls written."""
    _gzip_lines(articles.write.mode(mode)).option("maxRecordsPerFile", shard_rows).json(path)


def write_numbered_shards(
    articles: DataFrame, path: str, *order_by: str, shard_rows: int = SHARD_ROWS
) -> None:
    """K1 with W2: folders ``shard=N`` of exactly ``shard_rows`` records in order.

    Rows come back sorted from the numbering step, so a task writes its few shards one
    after the other and no shuffle follows.
    """
    numbered = assign_shard(articles, *order_by, shard_rows=shard_rows).drop("rn")
    _gzip_lines(numbered.write.partitionBy("shard")).json(path)


def write_single_archive(
    records: DataFrame, path: str, *order_by: str, one_file: bool = False
) -> None:
    """K2: all records in order. The parts in name order are the archive, because gzip
    members may simply follow each other; ``one_file`` is for a small archive that has
    to be one physical file."""
    ordered = records.orderBy(*order_by)
    if one_file:
        ordered = ordered.coalesce(1)
    _gzip_lines(ordered.write).json(path)


def write_sized_parts(
    records: DataFrame, path: str, shards: DataFrame, part_bytes: int = PART_BYTES, fill: float = 0.8
) -> int:
    """K4: parts below ``part_bytes``, from the bytes per record of written ``shards``.

    ``fill`` leaves room for parts that compress worse than the average; check the
    result with ``oversize_parts``. Returns the records per part.
    """
    seen = shard_stats(shards).agg(F.sum("bytes").alias("b"), F.sum("records").alias("n")).first()
    per_record = (seen.b or part_bytes) / max(seen.n or 1, 1)
    rows = max(1, int(part_bytes * fill / per_record))
    write_article_shards(records, path, rows)
    return rows


def oversize_parts(spark: SparkSession, path: str, part_bytes: int = PART_BYTES) -> DataFrame:
    """K4, check: parts above the limit (none, if all is well). Sizes come from the listing."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path)
    return files.where(F.col("length") > part_bytes).select("path", "length")


def write_url_list(urls: DataFrame, path: str) -> None:
    """K5: sorted URL records as JSON lines."""
    urls.orderBy("url").write.json(path)


def append_ledger(attempts: DataFrame, path: str) -> None:
    """K6: add attempts; the commit is all or nothing and rewrites no earlier state."""
    attempts.write.mode("append").parquet(path)


def write_progress(summary: DataFrame, path: str) -> None:
    """K6: the counters of a run as one JSON record stamped with the time of saving."""
    summary.withColumn("last_saved_at", F.current_timestamp()).coalesce(1).write.mode(
        "overwrite"
    ).json(path)


def write_by_chunk(rows: DataFrame, path: str) -> None:
    """K7: one folder per chunk. Rows of ``assign_chunk`` arrive sorted, so a task
    holds few chunks open and no shuffle is needed."""
    _gzip_lines(rows.write.partitionBy("chunk")).json(path)


def write_report(report: DataFrame, path: str) -> None:
    """K8: a one-row report as a JSON record."""
    report.coalesce(1).write.mode("overwrite").json(path)
