"""Archive posts to the 12-field record."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsloom.functions.htmltext import add_html_text
from newsloom.profile import SiteProfile


def map_archive_record(posts: DataFrame, profile: SiteProfile, keep: tuple[str, ...] = ()) -> DataFrame:
    """Nested posts -> flat records. Narrow: no shuffle."""
    texts = {
        "__title": F.col("title.rendered"),
        "__text": F.col("content.rendered"),
        "__excerpt": F.col("excerpt.rendered"),
    }
    none = F.array().cast("array<bigint>")
    return add_html_text(posts, texts).select(
        "id",
        F.col("link").alias("url"),
        "slug",
        F.col("date").alias("published_at"),
        F.col("modified").alias("modified_at"),
        F.col("__title").alias("title"),
        F.col("__text").alias("text"),
        F.col("__excerpt").alias("excerpt"),
        F.coalesce("categories", none).alias("categories"),
        F.coalesce("tags", none).alias("tags"),
        F.col("author").alias("author_id"),
        F.lit(profile.source).alias("source"),
        *keep,
    )


def flag_empty_text(records: DataFrame) -> DataFrame:
    """Rows without text stay, marked."""
    return records.withColumn("is_empty_text", F.col("text") == "")
