"""The jobs. Each takes landed input and writes finished output.

Options are keyword arguments; their bounds are checked where they are used.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from newsloom import schemas
from newsloom.functions.archive import map_archive_record
from newsloom.functions.article import extract_article
from newsloom.functions.scalars import classify_outcome
from newsloom.functions.urls import is_article_url, listing_link_rows
from newsloom.operators.dedup import dedup_keep_first, distinct_urls
from newsloom.operators.joins import (
    attach_discovered_category, category_names, discover_urls, only_post_sitemaps, pending_work,
)
from newsloom.operators.ledger_table import LedgerTable
from newsloom.operators.listing import first_seen, listing_stop_rule, page_walk
from newsloom.operators.report import report_metrics, validation_report
from newsloom.profile import SiteProfile
from newsloom.session import drop_scratch, scratch
from newsloom.sinks.files import SHARD_ROWS, write_article_shards, write_report, write_url_list
from newsloom.sources.files import (
    broken_pages, drop_malformed, land_articles, malformed_lines, posts_and_broken, posts_of, read_archive_files, read_articles,
    read_pages, stream_archive_files,
)
from newsloom.sources.sitemaps import read_sitemaps
from newsloom.streaming.keystore import KeyStore
from newsloom.streaming.sinks import append_first_seen, ingest_stream, read_committed, run_of, write_committed
from newsloom.streaming.sources import files_per_batch, stream_files


def archive_job(
    spark: SparkSession, pages_path: str, out: str, profile: SiteProfile, start_page: int = 1,
    done: DataFrame | None = None, shard_rows: int = SHARD_ROWS, ordered: bool = True,
) -> DataFrame:
    """Landed archive pages -> deduplicated 12-field shards, in the order of ids; returns the report.

    Pages may lie in several folders and have any names; of repeated records the first by
    (page, file path, place) stays, and records without an id all stay. Broken pages go to
    ``out/quarantine``. The report counts the input: what was malformed, repeated, kept. Input is read once, and
    the counts are taken by the writes themselves. ``ordered=False`` saves the shuffle that sorting takes.
    """
    landed = scratch(spark, "records")
    rows = page_range_or_broken(posts_and_broken(read_archive_files(spark, pages_path)), start_page)
    if done is not None:
        skip = done.select("page").distinct().withColumn("__done", F.lit(True))
        rows = rows.join(skip, "page", "left").where("__done is null or broken is not null").drop("__done")
    place = F.struct(F.coalesce("page", F.lit(2**62)).alias("page"), "path", "pos")
    seen = Observation("input")
    records = map_archive_record(rows.withColumn("__place", place), profile, keep=("__place", "broken"))
    records.observe(
        seen, F.count_if(F.col("broken").isNull()).alias("records"), F.count_if(F.col("broken").isNotNull()).alias("broken")
    ).write.parquet(landed)
    stored = spark.read.schema(records.schema).parquet(landed)
    stored.where("broken is not null").select("broken.*").write.json(f"{out}/quarantine")
    kept = dedup_keep_first(stored.where("broken is null").drop("broken"), "id", "__place").drop("__place")
    return write_with_report(kept.orderBy("id") if ordered else kept, out, shard_rows, schemas.ARTICLES_ARCHIVE, seen.get["records"], seen.get["broken"], landed)


def page_range_or_broken(rows: DataFrame, start_page: int) -> DataFrame:
    """P8 for ``posts_and_broken``: broken pages are never left out."""
    return rows.where(F.col("broken").isNotNull() | F.col("page").isNull() | (F.col("page") >= start_page))


def discover_job(
    spark: SparkSession, out: str, profile: SiteProfile, sitemaps_path: str | None = None,
    listings: DataFrame | None = None,
) -> DataFrame:
    """Sitemaps, or listing pages where there are none, -> sorted URL list."""
    empty = spark.createDataFrame([], schemas.URL_LIST)
    from_sitemaps = sitemap_urls(read_sitemaps(spark, sitemaps_path), profile) if sitemaps_path else empty
    from_listings = listing_urls(listings, profile) if listings is not None else empty
    write_url_list(discover_urls(from_sitemaps, from_listings), out)
    return spark.read.schema(schemas.URL_LIST).json(out)


def sitemap_urls(entries: DataFrame, profile: SiteProfile) -> DataFrame:
    """Distinct article URLs of the entries; sub-sitemaps are chosen when they are landed."""
    articles = entries.where((F.col("kind") == "url") & is_article_url(F.col("loc"), profile))
    return distinct_urls(articles.withColumnRenamed("loc", "url")).select(
        "url", F.lit("unknown").alias("category_slug"), F.lit("unknown").alias("category_name")
    )


def post_sitemap_list(entries: DataFrame) -> DataFrame:
    """Sub-sitemaps to land next."""
    return only_post_sitemaps(entries).select("loc").distinct()


def listing_urls(listings: DataFrame, profile: SiteProfile) -> DataFrame:
    """Links of numbered listing pages(category_slug, page_num, html) up to the stop rule.

    The links are stored once: three steps read them, and the pages are read only here.
    """
    spark = listings.sparkSession
    path = scratch(spark, "links")
    links = listing_link_rows(listings, profile, "category_slug", "page_num")
    first_seen(links).write.parquet(path)
    new = spark.read.parquet(path)
    walk = listing_stop_rule(page_walk(new, listings))
    kept = new.join(walk.select("category_slug", "page_num"), ["category_slug", "page_num"], "left_semi")
    return category_names(kept, profile).select("url", "category_slug", "category_name")


def page_job(
    spark: SparkSession, pages_path: str, out: str, profile: SiteProfile,
    url_list: DataFrame | None = None, done: DataFrame | None = None, shard_rows: int = SHARD_ROWS,
    ledger: str | None = None, run: str | None = None,
) -> None:
    """Landed pages -> 7-field shards, leaving out what is done.

    Articles are extracted before what is done is left out, so raw pages are not shuffled.
    With ``ledger`` every landed page that is not done becomes an attempt there, and a next run leaves out
    what the ledger says is done. The outcome follows F13: from the page's ``status`` where the landed table has
    such a column (a failed fetch is a row without ``html``), else as of a fetched page; a fetched page without
    a valid article is ``rejected``. ``run`` names a folder of its own for the articles of a further run.
    """
    pages = read_pages(spark, pages_path)
    table = LedgerTable(spark, ledger) if ledger is not None else None
    if table is not None:
        # what was done before this run, fixed now: the run itself adds to the ledger
        before = scratch(spark, "before")
        table.status().select("url", "attempt", "outcome").write.parquet(before)
        status = spark.read.parquet(before)
        saved_before = status.where("outcome = 'ok'").select("url")
        done = saved_before if done is None else done.select("url").unionByName(saved_before)
    articles = extract_article(pages, profile, default_category=None if url_list is not None else "unknown")
    if done is not None:
        articles = pending_work(articles, done, "url")
    if url_list is not None:
        articles = attach_discovered_category(articles, url_list)
    target = f"{out}/articles" if run is None else f"{out}/articles/{run}"
    write_article_shards(articles, target, shard_rows)
    if table is not None:
        landed = spark.read.parquet(pages_path)
        code = F.coalesce("status", F.lit(200)) if "status" in landed.columns else F.lit(200)
        tried = landed.groupBy("url").agg(F.min(code.cast("int")).alias("status"))
        tried = pending_work(tried, done, "url")
        saved = spark.read.schema("url string").json(target).distinct().withColumn("__ok", F.lit(True))
        numbers = status.select("url", F.col("attempt").alias("__n"))
        attempts = tried.join(saved, "url", "left").join(numbers, "url", "left").select(
            "url", (F.coalesce("__n", F.lit(-1)) + 1).cast("int").alias("attempt"), F.current_timestamp().alias("ts"),
            "status", classify_outcome(F.col("status"), F.coalesce("__ok", F.lit(False))).alias("outcome"),
        )
        table.append(attempts)
        drop_scratch(spark, before)


def merge_job(
    spark: SparkSession, shards: str, out: str, shard_rows: int = SHARD_ROWS,
    schema=schemas.ARTICLES_ARCHIVE,
) -> DataFrame:
    """Shards of several runs -> one deduplicated corpus; returns the report.

    ``schema`` is the record form of the shards: archive records are told apart by ``id``,
    page records (``schemas.ARTICLES_PAGE``) by ``url``. Records without a key all stay;
    malformed lines go to ``out/quarantine``.
    """
    key = "url" if "body_text" in schema.fieldNames() else "id"
    seen = Observation("input")
    bad = F.col(schemas.CORRUPT).isNotNull()
    landed = land_articles(spark, shards, schema, lambda rows: rows.observe(
        seen, F.count_if(~bad).alias("records"), F.count_if(bad).alias("broken")))
    malformed_lines(landed).write.json(f"{out}/quarantine")
    records = dedup_keep_first(drop_malformed(landed), key, "ingest_pos").drop("ingest_pos")
    return write_with_report(records, out, shard_rows, schema, seen.get["records"], seen.get["broken"])


def write_with_report(
    records: DataFrame, out: str, shard_rows: int, schema, rows_in: int, broken: int, *scratch_paths: str
) -> DataFrame:
    """Write shards of records in which a key occurs once, and the report that the write itself has counted."""
    spark = records.sparkSession
    counted = Observation("output")
    write_article_shards(records.observe(counted, *report_metrics(**_page_columns(schema))), f"{out}/articles", shard_rows)
    got = counted.get
    values = {
        "total_records": got["total_records"], "unique_ids": got["unique_ids"], "malformed": 0, "duplicates": 0,
        **{k: v for k, v in got.items() if k not in ("total_records", "unique_ids")},
        "input_records": rows_in, "input_malformed": broken, "removed": rows_in - got["total_records"],
    }
    kinds = {**{k: "long" for k in values}, "first_published": "string", "last_published": "string"}
    if "body_text" in schema.fieldNames():
        kinds |= {"min_id": "string", "max_id": "string"}
    form = ", ".join(f"{k} {kinds[k]}" for k in values)
    write_report(spark.createDataFrame([tuple(values.values())], form), f"{out}/report")
    drop_scratch(spark, *scratch_paths)
    return spark.read.schema(form).json(f"{out}/report")


def _page_columns(schema) -> dict:
    page_form = "body_text" in schema.fieldNames()
    return {"key": "url", "text": "body_text", "published": "published_date"} if page_form else {}


def report_job(spark: SparkSession, shards: str, out: str, schema) -> DataFrame:
    """Validation report over shards, stored as one JSON record."""
    rows = read_articles(spark, shards, schema)
    report = validation_report(rows, corrupt=schemas.CORRUPT, **_page_columns(schema))
    write_report(report, out)
    return spark.read.schema(report.schema).json(out)


def stream_job(
    spark: SparkSession, pages_dir: str, out: str, checkpoint: str, profile: SiteProfile,
    files_per_trigger: int = 1000, continuous: bool = False,
):
    """Pages as they arrive -> article records; a restart goes on where it stopped."""
    pages = stream_files(spark, pages_dir, schemas.PAGES, files_per_trigger=files_per_trigger)
    return ingest_stream(extract_article(pages, profile), out, checkpoint, continuous=continuous)


def stream_job_once(
    spark: SparkSession, pages_dir: str, out: str, checkpoint: str, profile: SiteProfile,
    files_per_trigger: int = 1000, continuous: bool = False,
):
    """As ``stream_job``, and a page delivered again is ignored."""
    pages = stream_files(spark, pages_dir, schemas.PAGES, files_per_trigger=files_per_trigger)
    pages = pages.withColumn("delivery", F.col("_metadata.file_path"))
    records = extract_article(pages, profile, keep=("delivery",))
    return append_first_seen(records, out, checkpoint, "url", "delivery", continuous)


def archive_stream(
    spark: SparkSession, pages_dir: str, out: str, checkpoint: str, profile: SiteProfile,
    files_per_trigger: int = 1000, continuous: bool = False,
):
    """Archive pages as they arrive -> 12-field records and a quarantine of broken pages.

    Both appear with one commit per batch; read them with ``read_archive_stream``. A record delivered again
    is ignored, and of several in one batch the first by (page, file path, place) stays. Records
    without an id all stay. A run that is not ``continuous`` reads a long backlog in larger batches (``files_per_batch``).
    """
    def outputs(files: DataFrame, batch_id: int):
        place = F.struct(F.coalesce("page", F.lit(2**62)).alias("page"), "path", "pos")
        landed, kept = scratch(spark, "records"), scratch(spark, "kept")
        parsed = map_archive_record(posts_of(files).withColumn("__place", place), profile, keep=("__place",))
        parsed.write.parquet(landed)
        rows = spark.read.schema(parsed.schema).parquet(landed)
        store = KeyStore(spark, f"{out}/_keys", rows.schema["id"].dataType)
        named = rows.select("id").where("id is not null").distinct()
        seen = store.seen(named, "id", run_of(checkpoint), batch_id)
        fresh = dedup_keep_first(rows, "id", "__place").drop("__place").join(seen, "id", "left_anti").select(
            *schemas.ARTICLES_ARCHIVE.fieldNames())
        fresh.write.parquet(kept)
        records = spark.read.schema(fresh.schema).parquet(kept)
        store.add(records.select("id").where("id is not null"), "id", run_of(checkpoint), batch_id)
        return {"records": records, "quarantine": broken_pages(files)}, [landed, kept]

    if not continuous:
        files_per_trigger = files_per_batch(spark, pages_dir, files_per_trigger)
    return write_committed(outputs, stream_archive_files(spark, pages_dir, files_per_trigger), out, checkpoint, continuous)


def read_archive_stream(spark: SparkSession, out: str) -> tuple[DataFrame, DataFrame]:
    """Records and quarantined pages of the finished batches of ``archive_stream``."""
    pages = "file string, path string, page long, value string"
    return (
        read_committed(spark, out, "records", schemas.ARTICLES_ARCHIVE),
        read_committed(spark, out, "quarantine", T._parse_datatype_string(pages)),
    )
