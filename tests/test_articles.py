from __future__ import annotations

from dataclasses import replace

from pyspark.sql import functions as F

from newsloom import schemas
from newsloom.functions.archive import flag_empty_text, map_archive_record
from newsloom.functions.article import choose_category, extract_article
from newsloom.functions.pagefields import Selectors
from newsloom.functions.scalars import (
    backoff_seconds, ceil_div, classify_outcome, format_elapsed, page_backoff_seconds, parse_progress_ts, to_json_line,
)
from newsloom.functions.urls import (
    add_listing_links, archive_request_manifest, is_article_url, listing_page_num, listing_page_url, url_path,
)
from newsloom.profile import DENY_SHORT, SiteProfile, category_dim, wordpress_site

SITE = wordpress_site("https://news.example.com", "Example News")
LONG = "متن " * 40


def page(body="", title='<h1 class="tdb-title-text">سرخی</h1>', extra=""):
    return f"<html><body>{title}{extra}<div class=\"x td-post-content y\">{body}</div><p>after</p></body></html>"


def articles(spark, *pages, profile=SITE, **kw):
    df = spark.createDataFrame([(f"u{i}", p) for i, p in enumerate(pages)], schemas.PAGES)
    return {r.url: r for r in extract_article(df, profile, **kw).collect()}


def one(spark, html, profile=SITE):
    return articles(spark, html, profile=profile).get("u0")


def test_seven_fields(spark):
    row = one(spark, page(f"<p>{LONG}</p>"))
    assert list(row.asDict()) == schemas.ARTICLES_PAGE.fieldNames()
    assert row.title == "سرخی" and row.category == "unknown" and row.published_date is None
    assert row.char_count == len(row.body_text) == len(LONG.strip())
    assert row.scraped_at.endswith("+00:00") and row.scraped_at[10] == "T"


def test_text_content_has_no_block_newlines(spark):
    assert one(spark, page("<p>a</p><p>b</p>"), replace(SITE, min_body_chars=1)).body_text == "ab"


def test_minimum_length(spark):
    got = articles(spark, page("x" * 99), page("x" * 100))
    assert list(got) == ["u1"]


def test_pages_without_title_or_body_are_dropped(spark):
    body = f"<p>{LONG}</p>"
    assert articles(
        spark, page(body, title=""), page(body, title='<h1 class="tdb-title-text"> </h1>'),
        f"<h1 class='tdb-title-text'>t</h1><p>{LONG}</p>", "", page(body),
    ).keys() == {"u4"}


def test_title_falls_back_to_article_heading(spark):
    row = one(spark, page(LONG, title="<h1>no</h1><article><h1><b>yes &amp; so</b></h1></article>"))
    assert row.title == "yes & so"


def test_title_is_the_first_own_text_node(spark):
    row = one(spark, page(LONG, title='<h1 class="a tdb-title-text-2"><i>x</i> own <b>y</b></h1>'))
    assert row.title == "own"


def test_junk_blocks_go_and_nested_divs_stay(spark):
    body = (
        f"<div class='tdb-block-inner'><div>{LONG}</div></div><style>s</style><script>j('</div>')</script>"
        "<div class='my-shared-links'>junk <div>deep</div> junk</div><div class='td_block_template_1'>j</div>end"
    )
    text = one(spark, page(body)).body_text
    assert text == LONG + "end"


def test_class_test_is_substring_unless_exact(spark):
    body = f"{LONG}<div class='unrelated'>kept?</div>"
    assert "kept?" not in one(spark, page(body)).body_text
    assert "kept?" in one(spark, page(body), replace(SITE, junk_exact_token=True)).body_text


def test_text_after_junk_stays_by_choice(spark):
    """Text between a removed block and the next tag: kept, or dropped as tree removal does."""
    body = f"<p>{LONG}</p><div class='share'>j</div>tail<p>more</p>"
    assert one(spark, page(body)).body_text == LONG + "tailmore"
    assert one(spark, page(body), replace(SITE, keep_junk_tail=False)).body_text == LONG + "more"


def test_dates(spark):
    first = '<time datetime="2026-01-01T00:00:00+05:00">x</time>'
    entry = '<time class="my entry-date updated" datetime="2026-09-23T11:06:01+05:00">y</time>'
    got = articles(spark, page(LONG, extra=first + entry), page(LONG, extra=first), page(LONG, extra="<time>x</time>"))
    assert got["u0"].published_date == "2026-09-23T11:06:01+05:00"
    assert got["u1"].published_date == "2026-01-01T00:00:00+05:00"
    assert got["u2"].published_date is None


def link(label, href="/category/sports-2/"):
    return f'<a href="https://news.example.com{href}">{label}</a>'


def test_category_choice(spark):
    extra = link("صفحہ اول") + link("x" * 30) + link("paged", "/category/a/page/2/") + link(" کھیل ") + link("تجارت")
    row = articles(spark, page(LONG, extra=extra), page(LONG), default_category="صحت")
    assert row["u0"].category == "کھیل" and row["u1"].category == "صحت"


def test_choose_category_without_candidates(spark):
    df = spark.createDataFrame([([" ", "ہوم"],)], "l array<string>")
    assert df.select(choose_category(F.col("l"), Selectors.of(SITE))).first()[0] is None


def test_tag_container_profile_agrees_with_parser(spark):
    plain = replace(SITE, title_class="tdb-title-text", body_tag="article", body_class=None)
    html = (
        '<h1 class="tdb-title-text">T &#8217;</h1><time class="entry-date" datetime="d1"></time>' + link("کھیل")
        + f"<article><script>no</script><p>{LONG}&copy;&notice</p></article>"
    )
    row = one(spark, html, plain)
    assert (row.title, row.published_date, row.category) == ("T ’", "d1", "کھیل")
    assert row.body_text == LONG + "©¬ice"


def test_is_article_url(spark):
    want = {
        "https://news.example.com/abcde/": False, "https://news.example.com/abcdef/": True,
        "https://news.example.com/category/abcdef/": False, "https://news.example.com/a/bcdefg/": False,
        "https://news.example.com/my-wp-notes/": False, "https://news.example.com/abcdef?s=1": False,
        "https://other.example.com/abcdef/": False, "https://news.example.com/a b|cdef/": True,
        "https://news.example.com/abcdef;x=1": True, "https://news.example.com/abc;def/gh": False,
        "https://news.example.com/abcdef?x=/y/": True, "https://news.example.com/": False,
    }
    df = spark.createDataFrame([(u,) for u in want], "u string")
    got = {r.u: r.ok for r in df.select("u", is_article_url(F.col("u"), SITE).alias("ok")).collect()}
    assert got == want


def test_short_deny_list_lets_script_links_pass(spark):
    short = replace(SITE, deny=DENY_SHORT)
    df = spark.createDataFrame([("https://news.example.com/javascript:abc",)], "u string")
    assert df.select(is_article_url(F.col("u"), SITE)).first()[0] is False
    assert df.select(is_article_url(F.col("u"), short)).first()[0] is True


def test_url_path(spark):
    urls = ["https://h/a/b;p?q#f", "https://h?x", "https://h/a%20b/", "https://h/a;p/b"]
    df = spark.createDataFrame([(u,) for u in urls], "u string")
    assert [r[0] for r in df.select(url_path(F.col("u"))).collect()] == ["/a/b", "", "/a%20b/", "/a;p/b"]


def test_listing_links(spark):
    base = "https://news.example.com"
    html = (
        f'<h3 class="entry-title td"><a class="x" href="{base}/first-post/">1</a><a href="{base}/second/">2</a></h3>'
        f'<h3 class="entry-title"><a>no</a><a href=\'{base}/third-post/?a=1&amp;b=2\'>3</a></h3>'
        f'<h3 class="my-entry-title"><a href="{base}/not-this/">n</a></h3><h3><a href="{base}/nor-this/">n</a></h3>'
        f'<h3 class="entry-title"><a href="{base}/first-post/">again</a></h3><h3 class="entry-title"><a href="{base}/tag/x/">t</a></h3>'
    )
    df = spark.createDataFrame([(html,), ("",)], "html string")
    rows = add_listing_links(df, SITE).select("links").collect()
    assert rows[0].links == [f"{base}/first-post/", f"{base}/third-post/?a=1&b=2"] and rows[1].links == []


def test_listing_pages_and_requests(spark):
    df = spark.createDataFrame([("sports-2", 1), ("sports-2", 7)], "s string, n int")
    urls = df.select(listing_page_url(SITE, F.col("s"), F.col("n")).alias("u"))
    assert [r.n for r in urls.select(listing_page_num(F.col("u")).alias("n")).collect()] == [1, 7]
    assert urls.first().u == "https://news.example.com/category/sports-2/"
    rows = archive_request_manifest(spark, 3, SITE, per_page=50, start_page=2).collect()
    assert [r.page for r in rows] == [2, 3]
    assert rows[0].request_url == (
        "https://news.example.com/wp-json/wp/v2/posts?page=2&per_page=50&orderby=id&order=asc&status=publish"
        "&_fields=id%2Cdate%2Cmodified%2Clink%2Cslug%2Ctitle%2Ccontent%2Cexcerpt%2Ccategories%2Ctags%2Cauthor"
    )


def test_archive_record(spark):
    post = (7, "2020-01-01T12:34:56", "2020-01-02T00:00:00", "https://n/x/", "x", ("T<b>1</b>",), ("<p>a</p>&amp;amp;",), None, [1], None, 3)
    empty = (8, None, None, None, None, (None,), None, None, None, None, None)
    df = spark.createDataFrame([post, empty], schemas.ARCHIVE_POST)
    rows = {r.id: r for r in flag_empty_text(map_archive_record(df, SITE)).collect()}
    assert list(rows[7].asDict())[:12] == schemas.ARTICLES_ARCHIVE.fieldNames()
    assert (rows[7].title, rows[7].text, rows[7].excerpt, rows[7].tags) == ("T1", "a\n&", "", [])
    assert rows[8].text == "" and rows[8].is_empty_text and not rows[7].is_empty_text
    assert rows[8].categories == [] and rows[8].source == "Example News"


def test_scalars(spark):
    df = spark.range(1).select(
        format_elapsed(F.lit(3725)).alias("a"), format_elapsed(F.lit(360000)).alias("b"),
        format_elapsed(F.lit(None).cast("long")).alias("n"),
        backoff_seconds(F.lit(3)).alias("c"), backoff_seconds(F.lit(9)).alias("d"),
        page_backoff_seconds(F.lit(0), F.lit(503)).alias("e"), page_backoff_seconds(F.lit(4), F.lit(500)).alias("f"),
        ceil_div(F.lit(351952), 100).alias("g"),
        parse_progress_ts(F.lit("2026-09-23T07:50:01.423214Z")).isNotNull().alias("h"),
        parse_progress_ts(F.lit("never")).alias("i"),
        to_json_line().alias("j"),
    )
    row = df.first()
    assert (row.a, row.b, row.n) == ("01:02:05", "100:00:00", None)
    assert (row.c, row.d, row.e, row.f, row.g) == (8, 60, 6, 10, 3520)
    assert row.h and row.i is None


def test_outcomes(spark):
    df = spark.createDataFrame(
        [(200, True), (200, False), (404, False), (400, False), (429, False), (503, False), (500, False)], "s int, v boolean"
    )
    page = [r[0] for r in df.select(classify_outcome(F.col("s"), F.col("v"))).collect()]
    rest = [r[0] for r in df.select(classify_outcome(F.col("s"), F.col("v"), archive=True)).collect()]
    assert page == ["ok", "rejected", "gone", "error", "throttled", "throttled", "error"]
    assert rest[3] == "gone"


def test_category_dimension(spark):
    rows = category_dim(spark, SITE).collect()
    assert len(rows) == 10 and rows[2].category_name == "کھیل"
    assert SiteProfile(source="x").categories == SITE.categories
