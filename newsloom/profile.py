"""What changes from site to site."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

# Category slug -> display name (the multimedia section is left out).
CATEGORIES = {
    "pakistan-2": "پاکستان",
    "international-2": "عالمی خبریں",
    "sports-2": "کھیل",
    "unsual": "حیرت انگیز",
    "کاروباری-خبریں": "تجارت",
    "sehat": "صحت",
    "fun-o-sakafat": "فن و ثقافت",
    "miscellaneous": "میگزین",
    "سائنس-اور-ٹیکنالوجی": "سائنس اور ٹیکنالوجی",
    "urdu-blogs": "بلاگز",
}

# Substrings that mark a URL as something other than an article.
DENY_FULL = ("/category/", "/page/", "/tag/", "/author/", "?s=", "wp-", "/wp/", "javascript:")
DENY_SHORT = ("/category/", "/page/", "/tag/", "/author/", "?s=", "wp-")

# Class substrings of page blocks that are not article text.
JUNK_CLASSES = (
    "code-block",
    "td_block_template",
    "related",
    "share",
    "wp-post-navigation",
    "td-post-source-tags",
    "td-post-sharing",
)

# Labels of the home link, never a category.
HOME_LABELS = ("صفحہ اول", "ہوم")

# Fields asked of the archive endpoint.
ARCHIVE_FIELDS = (
    "id", "date", "modified", "link", "slug", "title", "content", "excerpt",
    "categories", "tags", "author",
)


@dataclass(frozen=True)
class SiteProfile:
    """Selectors, lists and labels of one site.

    ``base_url`` is a literal prefix; ``base_pattern`` (a regex) replaces it for a
    site spread over several hosts. ``body_tag``/``body_class`` name the article
    container: with a class it is found by the parser, because ``div``s nest; with
    a tag alone (``article``) a regex is enough and the work stays in the JVM.
    """

    source: str
    base_url: str = ""
    base_pattern: str | None = None
    archive_endpoint: str = ""
    archive_fields: tuple[str, ...] = ARCHIVE_FIELDS
    deny: tuple[str, ...] = DENY_FULL
    max_segments: int = 1
    min_path_chars: int = 6
    title_class: str | None = "tdb-title-text"
    body_tag: str = "div"
    body_class: str | None = "td-post-content"
    junk_classes: tuple[str, ...] = JUNK_CLASSES
    junk_exact_token: bool = False
    keep_junk_tail: bool = True
    time_class: str = "entry-date"
    home_labels: tuple[str, ...] = HOME_LABELS
    max_category_chars: int = 30
    min_body_chars: int = 100
    listing_tag: str = "h3"
    listing_class: str | None = "entry-title"
    categories: dict[str, str] = field(default_factory=lambda: dict(CATEGORIES))


def wordpress_site(base_url: str, source: str, **overrides) -> SiteProfile:
    """The usual profile: a WordPress news site with the theme classes above."""
    base = base_url.rstrip("/")
    settings = {"archive_endpoint": f"{base}/wp-json/wp/v2/posts", **overrides}
    return SiteProfile(source=source, base_url=base, **settings)


def category_dim(spark: SparkSession, profile: SiteProfile) -> DataFrame:
    """Slug -> name rows of one site, in menu order (10 rows for the default site)."""
    return spark.createDataFrame(
        list(profile.categories.items()), "category_slug string, category_name string"
    )
