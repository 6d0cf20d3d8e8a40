"""Article records out of pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsloom.functions.columns import normalize_page_text, strip_unicode
from newsloom.functions.htmltext import add_decoded
from newsloom.functions.pagefields import LABEL_BREAK, Selectors, page_fields, site_table
from newsloom.functions.parser import article_pieces
from newsloom.functions.urls import url_host
from newsloom.profile import SiteProfile


def choose_category(labels: Column, sel: Selectors) -> Column:
    """F6, choice: first label that is short, not blank and not a home link; else null."""
    clean = F.transform(labels, strip_unicode)
    good = F.filter(
        clean,
        lambda c: (c != "") & (F.length(c) < F.expr(sel.max_category_chars)) & ~F.array_contains(F.expr(sel.home_labels), c),
    )
    return F.try_element_at(good, F.lit(1))


def keep_valid_article(articles: DataFrame, sel: Selectors) -> DataFrame:
    """P5: drop pages without a title or with too little text.

    Written as the expansion of a filtered array: a plain filter would be pushed below
    the columns it tests, and their regexes would run twice for every page.
    """
    return articles.select(F.inline(F.expr(
        f"filter(array(struct(*)), a -> a.title <> '' AND length(a.body_text) >= {sel.min_body_chars.replace('`__site`', 'a.`__site`')})"
    )))


def extract_article(
    pages: DataFrame, profile: SiteProfile, default_category: str | None = "unknown",
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """pages(url, html) -> the 7-field article records that pass P5.

    ``default_category`` stands where the page names none (None leaves it null, for
    ``attach_discovered_category``). ``keep`` names further page columns to carry
    along. Narrow: no shuffle.
    """
    return _extract(pages.select("url", "html", *keep), Selectors.of(profile), default_category, keep)


def extract_articles_by_site(
    pages: DataFrame, profiles: dict[str, SiteProfile], default_category: str | None = "unknown",
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """U1, P4 for many sites: the profile of each page's host, all hosts in one pass.

    ``profiles``: by host, as it stands in the URL. Pages of other hosts are left out. The records
    carry ``source`` last, the site's name.
    """
    sites = site_table(pages.sparkSession, profiles).withColumnsRenamed({"host": "__host", "site": "__site"})
    known = pages.select("url", "html", *keep).join(sites, url_host(F.col("url")) == F.col("__host")).drop("__host")
    return _extract(known, Selectors.of_columns("__site"), default_category, (*keep, "source"), "__site")


def _extract(pages: DataFrame, sel: Selectors, default_category: str | None, keep: tuple[str, ...], *site: str) -> DataFrame:
    carried = [c for c in pages.columns if c != "html"]
    read = page_fields(pages.where(F.col("html") != ""), sel)
    unread = F.expr(
        f"CASE WHEN `__odd` THEN struct(html, {sel.title_class} AS title_class, {sel.body_tag} AS body_tag, {sel.body_class} AS body_class, "
        f"{sel.time_class} AS time_class, {sel.junk_classes} AS junk, {sel.junk_exact_token} AS exact, {sel.keep_junk_tail} AS tail) END"
    )
    usual = lambda name: F.when(~F.col("__odd"), F.col(name))
    raw = add_decoded(
        read, {f"__d{name}": usual(f"__{name}") for name in ("title", "body", "labels")}, {"__parsed": article_pieces(unread)}
    )
    labels = F.coalesce(F.col("__parsed.category_labels"), F.split("__dlabels", LABEL_BREAK))
    fields = raw.select(
        *carried,
        strip_unicode(F.coalesce("__parsed.title", "__dtitle")).alias("title"),
        F.coalesce("__parsed.body", "__dbody").alias("__text"),
        F.coalesce("__parsed.published", usual("__published")).alias("published_date"),
        choose_category(labels, sel).alias("__named"),
    )
    fields = fields.select(
        *carried, "title", normalize_page_text("__text").alias("body_text"), "published_date", "__named"
    )
    valid = keep_valid_article(fields, sel)
    if site:
        valid = valid.withColumn("source", F.col("__site.source"))
    return valid.select(
        "url", "title",
        F.coalesce("__named", F.lit(default_category)).alias("category"),
        "published_date", "body_text",
        F.length("body_text").alias("char_count"),
        scraped_at(),
        *keep,
    )


def scraped_at() -> Column:
    """UTC time of the run, ISO with microseconds; one value per query."""
    stamp = F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    return F.concat(stamp, F.lit("+00:00")).alias("scraped_at")
