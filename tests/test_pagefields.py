"""Page fields read as Columns against the parser, and what each kind of page needs."""

from __future__ import annotations

import random
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from newsloom import schemas
from newsloom.functions import article
from newsloom.functions.article import extract_article, extract_articles_by_site
from newsloom.functions.pagefields import Selectors, page_fields
from newsloom.profile import wordpress_site
from tests.conftest import DATA

SITE = replace(wordpress_site("https://news.example.com", "Example News"), min_body_chars=1)
SECTIONS = replace(SITE, body_tag="section", body_class="entry", title_class=None)
PLAIN = replace(SITE, body_tag="article", body_class=None, keep_junk_tail=False, junk_exact_token=True)
LONG = "words of an article " * 8

PARTS = (
    '<div class="td-post-content x">', "</div>", '<div class="share">', "</div>", "<div>", "</div>", '<section class="my entry">', "</section>",
    "<article>", "</article>", "<main>", "</main>", '<h1 class="tdb-title-text">Head &amp; more</h1>', "<h1><b>Other</b> head</h1>", "<p>para", "</p>",
    "text ", "x &#8217; &notice; y", "<!-- <div class='td-post-content'> -->", "<script>if (a<b) '</div>'</script>", "<style>p > div {}</style>",
    '<time datetime="2026-01-01">', "</time>", '<time class="entry-date" datetime="2026-02-02"></time>', '<a href="/category/x/">Sport</a>',
    '<a href="/category/y/"><span>icon</span> Trade</a>', '<a href="/category/z/page/2/">no</a>', "<br>", "<br/>", '<img src="a" alt="1">',
    '<div class="related shared"><div>deep</div> junk</div>tail', "<ul><li>item</ul>", "<b>bold</b>",
)
RARE = ("<h1><br></h1>", '<h1 class="tdb-title-text"><i>in</i>own</h1>', "</h1>", '<a href="/category/x/"><b>unclosed</a>', "a < b", '<div title="a>b">', "</body>", "</span>", "<div/>", "<!doctype html>")


def random_page(rng):
    """Mostly well nested, with an odd part now and then."""
    open_tags, out = [], []
    for _ in range(rng.randint(3, 40)):
        part = rng.choice(RARE) if rng.random() < 0.02 else rng.choice(PARTS)
        if part.startswith("</") and part[2:-1] in ("div", "section", "article", "main"):
            if rng.random() < 0.97:
                part = f"</{open_tags.pop()}>" if open_tags else "text"
        elif part.rstrip(">").split(" ")[0].lstrip("<").rstrip(">") in ("div", "section", "article", "main") and not part.endswith(("tail", "</div>")):
            open_tags.append(part[1:].split(" ")[0].rstrip(">"))
        out.append(part)
    if rng.random() < 0.95:
        out += [f"</{t}>" for t in reversed(open_tags)]
    return "<html><body>" + "".join(out) + rng.choice(["</body></html>", ""])


@pytest.mark.parametrize("profile", [SITE, SECTIONS, PLAIN], ids=["div", "section", "article"])
def test_columns_agree_with_the_parser(spark, monkeypatch, profile):
    rng = random.Random(len(profile.body_tag))
    pages = spark.createDataFrame([(f"u{i}", random_page(rng)) for i in range(2500)], schemas.PAGES).repartition(8).persist()
    odd = page_fields(pages, Selectors.of(profile)).where("__odd").count()
    assert 0 < odd < 1900
    read = lambda: {r.url: tuple(r)[1:6] for r in extract_article(pages, profile).collect()}
    fast = read()
    monkeypatch.setattr(article, "page_fields", lambda df, s: page_fields(df, s).withColumn("__odd", F.lit(True)))
    exact = read()
    html = {r.url: r.html for r in pages.collect()}
    assert len(exact) > 100
    for url in exact.keys() | fast.keys():
        assert fast.get(url) == exact.get(url), html[url]


def one(spark, html, profile):
    rows = extract_article(spark.createDataFrame([("u", html)], schemas.PAGES), profile).collect()
    return rows[0] if rows else None


def test_nested_container_of_any_tag(spark):
    html = f"<article><h1>T</h1></article><section class='wide entry'>a<section>b</section><div class='share'>no<div>no</div></div>c{LONG}</section><section class='entry'>later</section>"
    assert one(spark, html, SECTIONS).body_text == f"abc{LONG}".strip()
    assert one(spark, html, replace(SECTIONS, keep_junk_tail=False)).body_text == "ab"


def test_commented_out_container_is_no_container(spark):
    html = f"<!-- <article><h1>old</h1>stale</article> --><article><h1>T</h1>{LONG}<!-- ad --></article>"
    row = one(spark, html, PLAIN)
    assert (row.title, row.body_text) == ("T", f"T{LONG}".strip())


def test_usual_pages_need_no_parser(spark):
    """The test pages, with a category menu, a nested container, junk and dates put in, are read in the JVM."""
    pages = spark.read.parquet(f"{DATA}/sf0.001/pages.parquet")
    html = F.concat(
        F.lit('<nav><a href="/category/a/"><span>A</span></a></nav><div class="td-post-content"><div>'), F.regexp_replace("html", "(?i)</?(?:html|body)>", ""),
        F.lit('</div><div class="share"><b>s</b></div></div><time class="entry-date" datetime="2026"></time>'),
    )
    pages = pages.select("url", html.alias("html"))
    rows = page_fields(pages, Selectors.of(SITE)).select("__odd", "__body", "__published").collect()
    cut = sum("</article>" not in r.html for r in pages.collect())
    assert sum(r["__odd"] for r in rows) == cut < len(rows) / 2
    assert all(r["__body"] and r["__published"] == "2026" for r in rows if not r["__odd"])


def test_fields_are_computed_once(spark):
    pages = spark.read.parquet(f"{DATA}/sf0.001/pages.parquet")
    plan = extract_article(pages, SITE)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("aggregate(") == 1 and plan.count("ArrowEvalPython") == 1 and "Exchange" not in plan


def test_several_sites_in_one_pass(spark):
    profiles = {
        "a.example.com": replace(SECTIONS, source="A"), "b.example.com": replace(SITE, source="B"),
        "c.example.com": replace(PLAIN, source="C", min_body_chars=1000),
    }
    html = {
        "a.example.com": f"<article><h1>Ta</h1></article><section class='entry'>a{LONG}</section>",
        "b.example.com": f'<h1 class="tdb-title-text">Tb</h1><div class="td-post-content"><div>b{LONG}</div><div class="share">s</div></div><div>',
        "c.example.com": f"<article><h1>Tc</h1>short {LONG}</article>", "d.example.com": f"<article><h1>Td</h1>{LONG}</article>",
    }
    pages = spark.createDataFrame([(f"https://{host}/p{i}/", html[host], i) for i, host in enumerate(html)], "url string, html string, n int")
    rows = extract_articles_by_site(pages, profiles, keep=("n",)).collect()
    assert sorted((r.n, r.title, r.body_text[0], r.source) for r in rows) == [(0, "Ta", "a", "A"), (1, "Tb", "b", "B")]
    for i, host in enumerate(list(html)[:2]):
        alone = extract_article(pages.where(F.col("n") == i), profiles[host]).first()
        assert (alone.title, alone.body_text) == next((r.title, r.body_text) for r in rows if r.n == i)
