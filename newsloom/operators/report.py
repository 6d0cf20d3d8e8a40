"""What a corpus holds and whether it is whole."""

from __future__ import annotations

import hashlib
import sys
import zlib
from collections.abc import Iterator

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from newsloom.functions.scalars import ceil_div, mebibytes

# Executors need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

_ISO = "yyyy-MM-dd'T'HH:mm:ss"


def validation_report(
    records: DataFrame, key: str = "id", text: str = "text", title: str | None = "title",
    published: str | None = "published_at", corrupt: str | None = None,
) -> DataFrame:
    """One row of counts over a corpus.

    Everything is combined on the map side; the only rows that move are the distinct
    keys. Published times are compared as instants: an offset counts, a time without one
    is taken as UTC. A record without a key is no id; it is counted as ``null_ids``.
    """
    good = F.col(corrupt).isNull() if corrupt else F.lit(True)
    length = F.length(text).cast("long")
    if title:
        length = length + F.length(title)
    per_key = records.groupBy(F.when(good, F.col(key)).alias("key"), good.alias("good")).agg(
        F.count("*").alias("n"),
        F.count_if(F.col(text) == "").alias("empty"),
        F.sum(length).alias("chars"),
        *([F.min(_instant(published)).alias("lo"), F.max(_instant(published)).alias("hi")] if published else []),
    )
    n, is_good = F.col("n"), F.col("good")
    has_key = is_good & F.col("key").isNotNull()
    kept = F.count_if(has_key)
    report = per_key.agg(
        F.coalesce(F.sum(n), F.lit(0)).alias("total_records"),
        kept.alias("unique_ids"),
        F.coalesce(F.sum(F.when(~is_good, n)), F.lit(0)).alias("malformed"),
        (F.coalesce(F.sum(F.when(has_key, n)), F.lit(0)) - kept).alias("duplicates"),
        F.coalesce(F.sum(F.when(is_good & F.col("key").isNull(), n)), F.lit(0)).alias("null_ids"),
        F.coalesce(F.sum(F.when(is_good, F.col("empty"))), F.lit(0)).alias("empty_text"),
        F.coalesce(F.sum(F.when(is_good, F.col("chars"))), F.lit(0)).alias("chars_total"),
        F.min("key").alias("min_id"),
        F.max("key").alias("max_id"),
        *(
            [F.date_format(F.min("lo"), _ISO).alias("first_published"),
             F.date_format(F.max("hi"), _ISO).alias("last_published")] if published else []
        ),
    )
    return report


def report_metrics(
    key: str = "id", text: str = "text", title: str | None = "title", published: str | None = "published_at"
) -> list[Column]:
    """A1 as plain aggregates, for records in which a key occurs once: what a write can count as it goes."""
    length = F.length(text).cast("long")
    if title:
        length = length + F.length(title)
    keyed = F.count(key)
    return [
        F.count("*").alias("total_records"), keyed.alias("unique_ids"), (F.count("*") - keyed).alias("null_ids"),
        F.count_if(F.col(text) == "").alias("empty_text"), F.coalesce(F.sum(length), F.lit(0)).alias("chars_total"),
        F.min(key).alias("min_id"), F.max(key).alias("max_id"),
        *(
            [F.date_format(F.min(_instant(published)), _ISO).alias("first_published"),
             F.date_format(F.max(_instant(published)), _ISO).alias("last_published")] if published else []
        ),
    ]


def _instant(column: str) -> Column:
    return F.col(column).try_cast("timestamp")


def count_by_category(articles: DataFrame, *columns: str) -> DataFrame:
    """A2: articles per category (or any other columns)."""
    return articles.groupBy(*(columns or ("category",))).agg(F.count("*").alias("articles"))


def count_by_category_id(records: DataFrame) -> DataFrame:
    """A2, archive form: a record counts once under each of its category ids."""
    ids = records.select(F.explode_outer("categories").alias("category_id"))
    return ids.groupBy("category_id").agg(F.count("*").alias("articles"))


def length_profile(records: DataFrame, text: str, *by: str) -> DataFrame:
    """Characters in all, shortest and longest text."""
    n = F.length(text).cast("long")
    return records.groupBy(*by).agg(
        F.count("*").alias("records"), F.coalesce(F.sum(n), F.lit(0)).alias("chars_total"),
        F.min(n).alias("chars_min"), F.max(n).alias("chars_max"),
    )


def shard_stats(shards: DataFrame) -> DataFrame:
    """A3: records and size of every file read by ``shards`` (a file-based DataFrame). Files are
    told apart by their path: folders of one output repeat the names of their files."""
    return shards.groupBy(F.col("_metadata.file_path").alias("file_path")).agg(
        F.first("_metadata.file_name").alias("file_name"),
        F.count("*").alias("records"), F.max("_metadata.file_size").alias("bytes"),
    ).withColumn("mb", F.round(mebibytes(F.col("bytes")), 2))


def shard_totals(stats: DataFrame) -> DataFrame:
    """A3: number of shards, records and MB over all of them."""
    return stats.agg(
        F.count("*").alias("shards"), F.sum("records").alias("records"),
        F.round(mebibytes(F.sum("bytes")), 1).alias("mb"),
    )


def latest_shards(stats: DataFrame, n: int = 5) -> DataFrame:
    """O3: the last shards by name."""
    return stats.orderBy(F.desc("file_path" if "file_path" in stats.columns else "file_name")).limit(n)


def preview(rows: DataFrame, shard: str, position: str, n: int = 3) -> DataFrame:
    """The first ``n`` records of the latest shard, cut for display.

    One top-n over (latest shard, first position) and a look at its ``n`` rows: no
    pass to find the shard before.
    """
    top = rows.orderBy(F.desc(shard), F.asc(position)).limit(n)
    latest = F.max(shard).over(Window.partitionBy())
    return (
        top.withColumn("__latest", latest).where(F.col(shard) == F.col("__latest"))
        .withColumn("title", F.substring("title", 1, 80))
        .withColumn("body_text", F.substring("body_text", 1, 150))
        .drop("__latest")
    )


def archive_size(responses: DataFrame, total: str = "total", per_page: int = 100) -> DataFrame:
    """A5: archive size (the largest total seen, for it grows) and its page count."""
    return responses.agg(F.max(total).alias("total")).select(
        "total", ceil_div(F.col("total"), per_page).alias("pages")
    )


def record_checksum(*columns: str) -> Column:
    """SHA-256 over the JSON form of a record."""
    return F.sha2(F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}), 256)


def checksum_parts(digest: Column) -> list[Column]:
    """A hex digest as five numbers of 13 digits (the last of 12), all 64 of them, that can be summed in any order."""
    return [F.conv(F.substring(digest, at, 13), 16, 10).cast("decimal(20,0)") for at in range(1, 65, 13)]


def dataset_checksum(records: DataFrame, digest: Column | None = None) -> DataFrame:
    """Row count and the sums of all parts of the record digests; independent of order and layout."""
    if digest is None:
        digest = record_checksum(*records.columns)
    return records.agg(
        F.count("*").alias("records"),
        F.concat_ws("-", *(
            F.coalesce(F.sum(part), F.lit(0)).cast("decimal(38,0)").cast("string") for part in checksum_parts(digest)
        )).alias("checksum"),
    )


def file_checksums(files: DataFrame) -> DataFrame:
    """Size, MD5 and SHA-256 of every file of a binary scan."""
    return files.select(
        F.regexp_extract("path", "[^/]+$", 0).alias("file_name"), F.col("length").alias("bytes"),
        F.md5("content").alias("md5"), F.sha2("content", 256).alias("sha256"),
    )


_GZIP_STATUS = "path string, file_name string, ok boolean, members int, lines long, bytes long, md5 string, sha256 string"


def gzip_test(files: DataFrame) -> DataFrame:
    """Does every gzip file of a binary scan decompress to its end?"""
    return gzip_report(files).select("file_name", "ok", "members", "lines")


def gzip_report(files: DataFrame) -> DataFrame:
    """A9, with A7: does every gzip file of a binary scan decompress to its end? And its size and digests.

    One bad file is reported and does not end the job. The bytes are read once for test and
    digests. Files are inflated in steps, so memory holds the compressed bytes of a batch
    (``spark.sql.execution.arrow.maxRecordsPerBatch`` files) and one step.
    """
    names = [field.split()[0] for field in _GZIP_STATUS.split(", ")]

    def inflate(content: bytes):
        rest, members, lines = content, 0, 0
        try:
            while rest:
                reader = zlib.decompressobj(wbits=31)
                while rest and not reader.eof:
                    lines += reader.decompress(rest, 1 << 20).count(b"\n")
                    rest = reader.unconsumed_tail
                if not reader.eof:
                    return False, members, lines
                members, rest = members + 1, reader.unused_data.lstrip(b"\0")
        except zlib.error:
            return False, members, lines
        return members > 0, members, lines

    def check(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [
                (path, path.rsplit("/", 1)[-1], *inflate(data), len(data),
                 hashlib.md5(data).hexdigest(), hashlib.sha256(data).hexdigest())
                for path, data in zip(batch.path, batch.content)
            ]
            yield pd.DataFrame(found, columns=names)

    return files.select("path", "content").mapInPandas(check, _GZIP_STATUS)
