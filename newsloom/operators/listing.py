"""Links of numbered listing pages and where a walk over them stops."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

MAX_PAGES = 5000  # Fixed value: pages walked per category at most.
BATCH_PAGES = 20  # Fixed value: pages between two looks at the stop rule.
EMPTY_STREAK = 5  # Fixed value: empty pages in a row that end a category.


def first_seen(links: DataFrame, slug: str = "category_slug") -> DataFrame:
    """links(slug, page_num, pos, url) -> the first place each URL of a slug is seen.

    Place is packed into one long, so the minimum is a hash aggregate that is combined
    before the shuffle and a URL on every page costs one record per task.
    """
    place = F.shiftleft(F.col("page_num").cast("long"), 32) + F.col("pos")
    firsts = links.groupBy(slug, "url").agg(F.min(place).alias("__place"))
    return firsts.select(
        slug,
        F.shiftright("__place", 32).cast("int").alias("page_num"),
        F.col("__place").bitwiseAND(F.lit(0xFFFFFFFF)).cast("int").alias("pos"),
        "url",
    )


def page_walk(
    new_links: DataFrame, pages: DataFrame | None = None, slug: str = "category_slug",
    max_pages: int = MAX_PAGES,
) -> DataFrame:
    """Every page 1..last of each slug with its count of new links (0 where it is missing).

    ``new_links`` has one row per new link; ``pages`` (slug, page_num) names the pages
    that were landed, so that trailing pages without links count as empty.
    """
    capped = new_links.where(F.col("page_num").between(1, max_pages))
    counts = capped.groupBy(slug, "page_num").agg(F.count("*").alias("n_new"))
    seen = counts.select(slug, "page_num")
    if pages is not None:
        seen = seen.unionByName(pages.where(F.col("page_num").between(1, max_pages)).select(slug, "page_num"))
    last = seen.groupBy(slug).agg(F.max("page_num").alias("__last"))
    walk = last.select(slug, F.explode(F.sequence(F.lit(1), F.col("__last"))).alias("page_num"))
    return walk.join(counts, [slug, "page_num"], "left").select(
        slug, "page_num", F.coalesce("n_new", F.lit(0)).alias("n_new")
    )


def listing_stop_rule(
    walk: DataFrame, slug: str = "category_slug", batch: int = BATCH_PAGES, streak: int = EMPTY_STREAK,
    max_pages: int = MAX_PAGES,
) -> DataFrame:
    """Pages up to the one after which the walk stops.

    The streak of empty pages is looked at only at the end of each batch, so a streak
    broken inside its batch stops nothing. Groups hold at most ``max_pages`` rows.
    """
    walk = walk.where(F.col("page_num") <= max_pages)
    so_far = Window.partitionBy(slug).orderBy("page_num")
    whole = Window.partitionBy(slug)
    last_full = F.max(F.when(F.col("n_new") > 0, F.col("page_num"))).over(so_far)
    runs = walk.select(
        "*",
        (F.col("page_num") - F.coalesce(last_full, F.lit(0))).alias("empty_streak"),
        F.max("page_num").over(whole).alias("__last"),
    )
    stops = (F.col("empty_streak") >= streak) & (
        (F.col("page_num") % batch == 0) | (F.col("page_num") == F.col("__last"))
    )
    ended = runs.withColumn("stop_page", F.min(F.when(stops, F.col("page_num"))).over(whole))
    return ended.where(
        F.col("stop_page").isNull() | (F.col("page_num") <= F.col("stop_page"))
    ).drop("__last")
