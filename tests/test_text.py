from __future__ import annotations

import html
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from newsloom.functions.columns import normalize_archive_text, normalize_page_text
from newsloom.functions.htmltext import add_decoded, add_html_text, html_to_text, html_to_text_exact
from newsloom.functions.parser import _block_text
from tests.conftest import DATA

CASES = {
    "a<br>b": "a\nb",
    "a<br/>b": "a\n\nb",
    "<p>a</p><p>b</p>": "a\n\nb",
    '<script>var t="</p>";</script>x': "x",
    "a<noscript>b<p>c": "a",
    "&amp;lt;": "<",
    "a&nbsp;&nbsp;b": "a b",
    "x&amp": "x&",
    "": "",
    "a<svg><svg>x</svg>y</svg>z": "az",
    "<noscript><style>p{}</style>b</noscript>c": "c",
    "<svg><noscript>a</svg>b</noscript>c": "c",
    '<a title="x>y">k</a>': "k",
    "1 < 2 <3": "1 < 2 <3",
    "<header>a</header><head>b</head>": "a\nb",
    "a \n \n\n\n b\t\tc": "a\n\nb c",
    "<!-- <p> -->x<style>y</style>": "x",
    "it&#8217;s &hellip; &notice &copyx; &#150;": "it’s … ¬ice ©x; –",
    "&lt;p&gt;x&lt;/p&gt;": "<p>x</p>",
    "اردو<br>متن": "اردو\nمتن",
    "  x 　": "x",
}


def reference_text(markup: str | None) -> str:
    text = _block_text(markup or "").replace("\xa0", " ")
    text = re.sub(r"[ \t\f\v]+", " ", text)
    text = re.sub(r" *\n *", "\n", text)
    return re.sub(r"\n{3,}", "\n\n", text).strip()


def texts(spark, markups):
    df = spark.createDataFrame(list(enumerate(markups)), "i int, h string")
    rows = add_html_text(df, {"t": F.col("h")}).orderBy("i").collect()
    return [r.t for r in rows]


def test_html_to_text_goldens(spark):
    assert texts(spark, list(CASES)) == list(CASES.values())


def test_null_markup_is_empty_text(spark):
    assert texts(spark, [None]) == [""]


def test_usual_pages_never_leave_the_jvm(spark):
    usual = ["<p>a &amp; b</p>", "<svg><path/></svg>x", "<br />y", "<p class='a'>&#8217;</p>"]
    df = spark.createDataFrame([(u,) for u in usual], "h string")
    assert all(r.t is not None for r in df.select(html_to_text("h").alias("t")).collect())


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01", "sf0.1"])
def test_columns_and_parser_agree_on_all_pages(spark, sf):
    pages = spark.read.parquet(f"{DATA}/{sf}/pages.parquet")
    fast = add_html_text(pages, {"a": F.col("html")})
    both = html_to_text_exact(fast, "html", "b")
    assert both.where("a <> b").count() == 0


PIECES = st.sampled_from(
    ["<p>", "</p>", "<br/>", "<br>", "<b>", "</b>", "<svg>", "</svg>", "<style>", "</style>", "<noscript>",
     "</noscript>", "<!--", "-->", "<script>", "</script>", '<a href="x>y">', "</a>", "<div class=x/>", "&amp;",
     "&lt;", "&am", "&#39;", "&copy", " ", "\n", "\t", "x", "text ", "ü", "<", ">", "--", "!", "<template>", "</template>"]
)


@settings(max_examples=3, deadline=None)
@given(st.lists(st.lists(PIECES, max_size=14).map("".join), min_size=150, max_size=150))
def test_any_markup_reads_as_the_parser_reads_it(spark, markups):
    got = texts(spark, markups)
    wrong = [(m, g) for m, g in zip(markups, got) if g != reference_text(m)]
    assert not wrong, wrong[:3]


def test_decode_one_round(spark):
    given_ = ["&amp;lt;", "&#8217;&hellip;", "&notice &foo; &CounterClockwiseContourIntegral;", "AT&T", "&#x41;", "&ampx", ""]
    df = spark.createDataFrame(list(enumerate(given_)), "i int, h string")
    rows = add_decoded(df, {"t": F.col("h")}).orderBy("i").collect()
    assert [r.t for r in rows] == [html.unescape(g) for g in given_]


def test_whitespace_rules(spark):
    rough = "  a  b \n  \n\n\n c\td\x0b　\n"
    df = spark.createDataFrame([(rough,)], "t string")
    row = df.select(normalize_archive_text("t").alias("a"), normalize_page_text("t").alias("p")).first()
    assert row.a == "a b\n\nc\td".replace("\t", " ")
    page = re.sub(r"[ \t]+", " ", re.sub(r"\n\s*\n+", "\n\n", rough.strip()))
    assert row.p == page


def test_long_pages_do_not_exhaust_the_stack(spark):
    markup = "<script>" + "a<b " * 200_000 + "</script>" + '<p class="x" id="y">t</p>' * 20_000 + "<!-- - " + "- x" * 100_000 + "-->"
    assert texts(spark, [markup])[0].startswith("t\n\nt")
