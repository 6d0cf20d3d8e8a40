"""URLs and links as Columns."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from newsloom.functions.columns import bind
from newsloom.functions.htmltext import add_decoded
from newsloom.profile import SiteProfile


def url_scheme(url: Column) -> Column:
    return F.regexp_extract(url, r"^([A-Za-z][A-Za-z0-9+.-]*):", 1)


def url_host(url: Column) -> Column:
    return F.regexp_extract(url, r"^[^:]+://([^/?#]*)", 1)


def url_path(url: Column) -> Column:
    """path without query, fragment and the parameters of its last segment.

    Read by regex: URL parsers of the JVM refuse paths that hold a space or a pipe.
    """
    return F.regexp_replace(F.regexp_extract(url, r"^[^:]+://[^/?#]*([^?#]*)", 1), r";[^/]*$", "")


def without_query(url: Column) -> Column:
    return F.regexp_extract(url, r"^([^?#]*)", 1)


def is_article_url(url: Column, profile: SiteProfile) -> Column:
    """On the site, no denied substring, and a short path of a few long segments."""
    if profile.base_pattern:
        on_site = url.rlike(profile.base_pattern)
    else:
        on_site = url.startswith(profile.base_url + "/")
    denied = F.lit(False)
    for part in profile.deny:
        denied = denied | url.contains(part)
    path = F.btrim(url_path(url), F.lit("/"))
    slashes = F.length(path) - F.length(F.replace(path, F.lit("/"), F.lit("")))
    return (
        on_site & ~denied
        & (slashes < profile.max_segments) & (F.length(path) >= profile.min_path_chars)
    )


def class_has(tag: Column, wanted: str, token: bool) -> Column:
    """Class test on an open tag: substring, or a whole token of the list."""
    value = F.regexp_extract(tag, r"""(?is)\sclass\s*=\s*(?:"([^"]*)"|'[^']*'|[^\s"'>]+)""", 0)
    name = re.escape(wanted)
    if token:
        return value.rlike(rf"""[\s"'=]{name}(?:[\s"']|$)""")
    return value.contains(wanted)


def attribute(tag: Column, name: str) -> Column:
    """Value of a quoted or bare attribute of an open tag, null if absent."""
    found = F.regexp_extract(tag, rf"""(?is)\s{name}\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""", 1)
    return F.when(found != "", F.regexp_replace(found, "^[\"']|[\"']$", ""))


_BREAK = "\x1e"


def _raw_links(html: Column, profile: SiteProfile) -> Column:
    """Address of the first link of every listing item, joined into one text."""
    tag = profile.listing_tag
    items = F.regexp_extract_all(html, F.lit(rf"(?is)<{tag}(?:\s[^>]*)?>.*?</{tag}\s*>"), 0)
    if profile.listing_class:
        items = F.filter(
            items, lambda i: class_has(F.regexp_extract(i, "^<[^>]*>", 0), profile.listing_class, token=True)
        )
    links = F.transform(
        items,
        lambda i: attribute(F.regexp_extract(i, r"(?is)<a\s(?:[^>]*\s)?href\s*=[^>]*>", 0), "href"),
    )
    return F.array_join(links, _BREAK)


def _links(profile: SiteProfile, absolute: bool) -> Column:
    keep = (lambda u: is_article_url(u, profile)) if absolute else (lambda u: u != "")
    return F.array_distinct(F.filter(F.split("__links", _BREAK), keep))


def _with_raw_links(pages: DataFrame, profile: SiteProfile) -> DataFrame:
    return add_decoded(pages, {"__links": _raw_links(F.col("html"), profile)})


def add_listing_links(
    pages: DataFrame, profile: SiteProfile, to: str = "links", absolute: bool = True
) -> DataFrame:
    """F7 + D3: the article links of every listing page, in order, once each.

    ``absolute=False`` keeps links of any form (site-relative ones too).
    """
    return _with_raw_links(pages, profile).withColumn(to, _links(profile, absolute)).drop("__links")


def listing_link_rows(
    pages: DataFrame, profile: SiteProfile, *keep: str | Column, absolute: bool = True
) -> DataFrame:
    """As ``add_listing_links``, one row (pos, url) per link beside the columns ``keep``."""
    links = F.posexplode(_links(profile, absolute)).alias("pos", "url")
    return _with_raw_links(pages, profile).select(*keep, links)


def listing_page_url(profile: SiteProfile, slug: Column, page_num: Column) -> Column:
    """Address of one listing page; the first has no number."""
    head = F.concat(F.lit(f"{profile.base_url}/category/"), slug, F.lit("/"))
    return F.when(page_num == 1, head).otherwise(
        F.concat(head, F.lit("page/"), page_num.cast("string"), F.lit("/"))
    )


def listing_page_num(url: Column) -> Column:
    """Page number inside a listing address, 1 when there is none."""
    return bind(
        F.regexp_extract(url, r"/page/(\d+)/", 1),
        lambda n: F.when(n == "", F.lit(1)).otherwise(n.cast("int")),
    )


def archive_request_url(page: Column, profile: SiteProfile, per_page: int = 100) -> Column:
    """encoded request address of one archive page (built, never fetched)."""
    check_per_page(per_page)
    rest = f"&per_page={per_page}&orderby=id&order=asc&status=publish&_fields="
    return F.concat(
        F.lit(profile.archive_endpoint + "?page="), page.cast("string"), F.lit(rest),
        F.url_encode(F.lit(",".join(profile.archive_fields))),
    )


def archive_request_manifest(
    spark: SparkSession, page_count: int, profile: SiteProfile, per_page: int = 100, start_page: int = 1
) -> DataFrame:
    """F14 + P8: one row per archive page still to ask for, from ``start_page`` on."""
    pages = spark.range(start_page, page_count + 1).withColumnRenamed("id", "page")
    return pages.withColumn("request_url", archive_request_url(F.col("page"), profile, per_page))


def check_per_page(per_page: int) -> None:
    if not 1 <= per_page <= 100:
        raise ValueError("per_page must be between 1 and 100")
