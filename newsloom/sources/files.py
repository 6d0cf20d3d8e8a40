"""Readers of landed files. Schemas are explicit, nothing is inferred."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from newsloom import schemas
from newsloom.session import scratch


def _json(spark: SparkSession, schema: T.StructType, **options: str):
    return spark.read.schema(schema).options(**options)


def read_url_list(spark: SparkSession, path: str) -> DataFrame:
    """One URL record per line; blank lines are skipped, absent fields are null."""
    return _json(spark, schemas.URL_LIST).json(path)


def file_position() -> Column:
    """Place of a line: file path, block, line in the block. Paths sort like the files."""
    return F.struct(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("line"),
    )


def read_articles(
    spark: SparkSession, path: str, schema: T.StructType = schemas.ARTICLES_ARCHIVE
) -> DataFrame:
    """Article shards (a file, folder or glob), plain or gzip, multi-member gzip too.

    Adds ``_corrupt_record`` (the line, when it is malformed) and ``ingest_pos``.
    """
    rows = _json(spark, schemas.with_corrupt(schema)).json(path)
    return rows.withColumn("ingest_pos", file_position())


def land_articles(
    spark: SparkSession, path: str, schema: T.StructType = schemas.ARTICLES_ARCHIVE,
    counted: Callable[[DataFrame], DataFrame] = lambda rows: rows,
) -> DataFrame:
    """S2, once: parse the lines and store them as columns in the shared folder.

    Gzip text cannot be split and is parsed whole for every query; what follows reads
    only the columns it needs, and each row keeps the position it got here. ``counted`` may
    observe the rows on their way.
    """
    landed = scratch(spark, "landed")
    rows = read_articles(spark, path, schema)
    counted(rows).write.parquet(landed)
    return spark.read.schema(rows.schema).parquet(landed)


def drop_malformed(rows: DataFrame) -> DataFrame:
    """P10: complete records only."""
    return rows.where(F.col(schemas.CORRUPT).isNull()).drop(schemas.CORRUPT)


def malformed_lines(rows: DataFrame) -> DataFrame:
    """P10: the lines for quarantine (of landed rows)."""
    return rows.where(F.col(schemas.CORRUPT).isNotNull()).select("ingest_pos", schemas.CORRUPT)


def read_archive_files(spark: SparkSession, path: str) -> DataFrame:
    """S3: whole landed archive pages: (file, path, page, value, is_list).

    A page file has at most 100 posts, so one row per file is small. The page number is
    read from names like ``page_12.json``; any other name is a page without a number.
    """
    return _archive_files(spark.read.option("recursiveFileLookup", "true").text(path, wholetext=True))


def stream_archive_files(spark: SparkSession, path: str, files_per_trigger: int = 1000) -> DataFrame:
    """``read_archive_files`` of files as they arrive."""
    return _archive_files(spark.readStream.option("maxFilesPerTrigger", files_per_trigger).text(path, wholetext=True))


def _archive_files(pages: DataFrame) -> DataFrame:
    file = F.col("_metadata.file_name")
    return pages.select(
        file.alias("file"), F.col("_metadata.file_path").alias("path"),
        F.regexp_extract(file, r"(?i)^[a-z_-]*?0*(\d+)\.json(?:\.gz)?$", 1).try_cast("long").alias("page"),
        "value",
        F.ltrim("value").startswith("[").alias("is_list"),
    )


def posts_of(pages: DataFrame) -> DataFrame:
    """Posts of the list pages, with file path, page number and place inside the page."""
    # Expanded where it is parsed: a named array would be parsed again by the filter the
    # optimizer derives for it.
    posts = F.posexplode(F.from_json("value", T.ArrayType(schemas.ARCHIVE_POST))).alias("pos", "post")
    named = [c for c in ("path", "page") if c in pages.columns]
    return pages.where("is_list").select(*named, posts).select(*named, "pos", "post.*")


def posts_and_broken(pages: DataFrame) -> DataFrame:
    """S3 in one pass over ``read_archive_files``: the posts, and a row with ``broken`` for every page that has none to give."""
    parsed = pages.withColumn("__posts", F.from_json("value", T.ArrayType(schemas.ARCHIVE_POST)))
    bad = ~F.col("is_list") | F.col("__posts").isNull()
    rows = parsed.select(
        "path", "page", F.when(bad, F.struct("file", "path", "page", "value")).alias("broken"),
        F.posexplode_outer(F.when(~bad, F.col("__posts"))).alias("pos", "post"),
    )
    return rows.where("pos is not null or broken is not null").select("path", "page", "broken", "pos", "post.*")


def read_archive_pages(spark: SparkSession, path: str) -> DataFrame:
    """S3: posts of all landed archive pages; a page that is not a list gives no rows."""
    return posts_of(read_archive_files(spark, path))


def broken_pages(pages: DataFrame) -> DataFrame:
    """S3: of ``read_archive_files``, those that hold something other than a list, or a broken one."""
    broken = F.from_json("value", T.ArrayType(schemas.ARCHIVE_POST)).isNull()
    return pages.where(~F.col("is_list") | broken).select("file", "path", "page", "value")


def quarantined_pages(spark: SparkSession, path: str) -> DataFrame:
    """S3: page files for quarantine."""
    return broken_pages(read_archive_files(spark, path))


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """Pages with something in them."""
    return spark.read.parquet(path).where(F.col("html") != "")


def read_listing_pages(pages: DataFrame) -> DataFrame:
    """Landed listing pages (url, html) -> (category_slug, page_num, html)."""
    from newsloom.functions.urls import listing_page_num

    url = F.col("url")
    return pages.select(
        F.regexp_extract(url, r"/category/([^/]+)/", 1).alias("category_slug"),
        listing_page_num(url).alias("page_num"),
        "html",
    )


def _read_if_there(spark: SparkSession, schema: T.StructType, path: str) -> DataFrame:
    try:
        return _json(spark, schema, multiLine="true").json(path)
    except AnalysisException as problem:
        if "PATH_NOT_FOUND" not in str(problem.getCondition()):
            raise
        return spark.createDataFrame([], schema)


def read_progress(spark: SparkSession, path: str, field: str = "completed_urls") -> DataFrame:
    """URLs of one list of a progress document; empty when there is no such file."""
    state = _read_if_there(spark, schemas.PROGRESS, path)
    return state.select(F.explode(field).alias("url")).distinct()


def read_progress_counters(spark: SparkSession, path: str) -> DataFrame:
    """Counters of a progress document, absent ones as zero."""
    state = _read_if_there(spark, schemas.PROGRESS, path)
    zero = F.lit(0)
    return state.select(
        F.coalesce("total_saved", zero).alias("total_saved"),
        F.coalesce("current_shard_idx", zero).alias("current_shard_idx"),
        F.coalesce("current_shard_count", zero).alias("current_shard_count"),
        "start_time", "last_saved_at",
    )


def read_done_pages(spark: SparkSession, path: str) -> DataFrame:
    """S7, archive form: page numbers of a bare list; unreadable or absent is empty."""
    try:
        text = spark.read.text(path, wholetext=True)
    except AnalysisException as problem:
        if "PATH_NOT_FOUND" not in str(problem.getCondition()):
            raise
        text = spark.createDataFrame([], "value string")
    pages = F.from_json("value", T.ArrayType(T.LongType()))
    return text.select(F.explode(pages).alias("page")).where("page is not null").distinct()


def read_file_bytes(spark: SparkSession, path: str, glob: str = "*.gz") -> DataFrame:
    """Files as bytes (each below 2 GB)."""
    return spark.read.format("binaryFile").option("pathGlobFilter", glob).option(
        "recursiveFileLookup", "true"
    ).load(path)


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    """The attempt ledger; empty before the first attempt."""
    try:
        return spark.read.schema(schemas.LEDGER).parquet(path)
    except AnalysisException as problem:
        if "PATH_NOT_FOUND" not in str(problem.getCondition()):
            raise
        return spark.createDataFrame([], schemas.LEDGER)
