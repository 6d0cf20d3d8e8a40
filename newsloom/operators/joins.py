"""Work lists and their joins."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsloom.profile import SiteProfile, category_dim
from newsloom.session import scratch


def pending_work(work: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """Work whose key is not done.

    The done side is reduced to its distinct keys before the join (a URL tried a
    million times is one row); the join type is left to the planner's size estimate.
    """
    return work.join(done.select(key).distinct(), key, "left_anti")


def attach_discovered_category(articles: DataFrame, url_list: DataFrame) -> DataFrame:
    """Where the page names no category, the one its URL was found under.

    Runs on extracted articles, so that raw pages are never shuffled. A URL listed
    under several categories takes the alphabetically first name, so that an article
    stays one row.
    """
    found = (
        url_list.where(F.col("category_name").isNotNull())
        .groupBy("url").agg(F.min("category_name").alias("__found"))
    )
    named = F.coalesce("category", "__found", F.lit("unknown"))
    return articles.join(found, "url", "left").withColumn("category", named).select(*articles.columns)


def category_names(rows: DataFrame, profile: SiteProfile) -> DataFrame:
    """Display name by slug; the dimension is the profile's own short list."""
    return rows.join(
        F.broadcast(category_dim(rows.sparkSession, profile)), "category_slug", "left"
    )


def union_discovered(parts: list[DataFrame]) -> DataFrame:
    """Lists of several categories end to end, repeats kept."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def discovered_in(links: DataFrame, slugs: list[str]) -> DataFrame:
    """J4 where the lists of all categories are one table: those of the wanted ones, repeats kept, in one scan."""
    return links.where(F.col("category_slug").isin(*slugs))


def only_post_sitemaps(entries: DataFrame, mark: str = "post-sitemap") -> DataFrame:
    """Sub-sitemaps that list articles."""
    return entries.where((F.col("kind") == "sitemap") & F.col("loc").contains(mark))


def discover_urls(sitemap_urls: DataFrame, listing_urls: DataFrame) -> DataFrame:
    """The sitemap result, or the listing result when the sitemap gave nothing. The sitemap
    result is stored once, so that looking whether it is empty does not parse it again."""
    spark = sitemap_urls.sparkSession
    path = scratch(spark, "sitemap-urls")
    sitemap_urls.write.parquet(path)
    stored = spark.read.schema(sitemap_urls.schema).parquet(path)
    return listing_urls if stored.isEmpty() else stored


def page_range_from(pages: DataFrame, start_page: int) -> DataFrame:
    """Pages from ``start_page`` on; a page without a number is never left out."""
    return pages.where(F.col("page").isNull() | (F.col("page") >= start_page))
