"""Sitemap files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_SHAPE = "url array<struct<loc:string>>, sitemap array<struct<loc:string>>"


def parse_sitemap(xml: Column) -> Column:
    """Both entry lists of a sitemap document; all null when it is malformed."""
    return F.from_xml(xml, _SHAPE, {"ignoreSurroundingSpaces": "false"})


def sitemap_entries(files: DataFrame, xml: str = "value", file: str = "file") -> DataFrame:
    """Rows (file, kind, loc). A document is one protocol file (50,000 entries at most);
    a malformed one gives no rows at all, never its readable head."""
    parsed = files.select(file, parse_sitemap(F.col(xml)).alias("doc"))
    both = F.concat(
        _tagged("sitemap", F.col("doc.sitemap")), _tagged("url", F.col("doc.url"))
    )
    return parsed.select(file, F.explode(both).alias("e")).select(
        F.col(file).alias("file"), "e.kind", "e.loc"
    ).where((F.col("loc").isNotNull()) & (F.col("loc") != ""))


def _tagged(kind: str, entries: Column) -> Column:
    return F.transform(
        F.coalesce(entries, F.array().cast("array<struct<loc:string>>")),
        lambda e: F.struct(F.lit(kind).alias("kind"), e["loc"].alias("loc")),
    )


def malformed_sitemaps(files: DataFrame, xml: str = "value", file: str = "file") -> DataFrame:
    """Files the parser could not read, for the report."""
    doc = parse_sitemap(F.col(xml))
    return files.where(
        doc.isNull() | (doc["url"].isNull() & doc["sitemap"].isNull() & ~F.col(xml).rlike(r"<(?:urlset|sitemapindex)[^>]*/>|</(?:urlset|sitemapindex)\s*>\s*$"))
    ).select(file)


def read_sitemaps(spark: SparkSession, path: str) -> DataFrame:
    """Entries of all landed sitemap files."""
    text = spark.read.text(path, wholetext=True)
    return sitemap_entries(text.select(F.col("_metadata.file_name").alias("file"), "value"))
