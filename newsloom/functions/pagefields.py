"""F2-F6 as Columns: title, container text, date and category labels of a page.

A page is cut before every container tag (``div``, ``article``, ``section``, ``main``). One fold over the
pieces follows the nesting with a small stack and notes where the wanted container begins and
ends and which junk blocks lie in it; the text is what is left between. Comments, scripts and styles
are replaced by marks first, so nothing in them is mistaken for the page.

``odd`` is true where columns cannot read a page as a parser does: broken tags, containers that overlap or
stay open, mixed content in headings or category links. Only such pages go to the parser.

Selectors are SQL expressions, literals for one site or columns for many: pages of
several sites are read in one pass.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newsloom.functions.columns import bind_sql, quoted, replace_sql
from newsloom.functions.htmltext import _ATTRS, _raw_element
from newsloom.functions.parser import CONTAINERS
from newsloom.profile import SiteProfile

LABEL_BREAK = "\x1e"

_MARKED = (
    r"(?i)<(?:!--(?:>|->|(?!-?>)[^-]*+(?:-(?!-\s*+!?>)[^-]*+)*+--\s*+!?>)|!doctype[^<>]*+>"
    rf"|(s){_raw_element('script')[1:]}|(s){_raw_element('style')[1:]})"
)
_NO_TAG = rf"<(?!(?:[A-Za-z][^\s/<>]*+(?:[\s/]{_ATTRS})?|/[A-Za-z][^\s/<>]*+\s*+|![sS]?)>)"
# An h1 that is not closed before the next one begins, a date with a reference in it.
_BROKEN = (
    rf"{_NO_TAG}|<[hH]1(?=[\s/>])(?![^<]*+(?:<(?!/?[hH]1[\s/>])[^<]*+)*+</[hH]1\s*+>)|<[tT][iI][mM][eE]\s[^<>]*&"
)
_NAMES = "|".join(CONTAINERS)
_EDGE = rf"(?i)(?=</?(?:{_NAMES}|body|html)[\s/>])"
_CLASS = r"""(?is)\sclass\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)"""
_HEADING = r"(?is)<h1(?:\s[^>]*)?>.*?</h1\s*>"
_FIRST_TEXT = r"(?s)^(?:<[^>]*>)*([^<]+)"
_INNER_ELEMENT = r"(?is)<([a-z][a-z0-9]*)(?:\s[^>]*)?>[^<]*</\1\s*>"


@dataclass(frozen=True)
class Selectors:
    """What a site's pages are read by, as SQL expressions."""
    title_class: str
    body_tag: str
    body_class: str
    time_class: str
    junk_classes: str
    junk_exact_token: str
    keep_junk_tail: str
    home_labels: str
    max_category_chars: str
    min_body_chars: str
    source: str

    @classmethod
    def names(cls) -> list[str]:
        return list(cls.__dataclass_fields__)

    @classmethod
    def of(cls, profile: SiteProfile) -> Selectors:
        return cls(**{name: _literal(value) for name, value in selector_values(profile).items()})

    @classmethod
    def of_columns(cls, struct: str) -> Selectors:
        return cls(**{name: f"`{struct}`.`{name}`" for name in cls.names()})


def selector_values(profile: SiteProfile) -> dict:
    return {name: getattr(profile, name) for name in Selectors.names()}


def _literal(value) -> str:
    if value is None:
        return "CAST(NULL AS STRING)"
    if isinstance(value, bool):
        return str(value).lower()
    if isinstance(value, (tuple, list)):
        return f"CAST(array({', '.join(map(_literal, value))}) AS ARRAY<STRING>)"
    return quoted(value) if isinstance(value, str) else str(value)


SITES = (
    "host string, site struct<title_class string, body_tag string, body_class string, time_class string, junk_classes array<string>, "
    "junk_exact_token boolean, keep_junk_tail boolean, home_labels array<string>, max_category_chars int, min_body_chars int, "
    "source string>"
)


def site_table(spark: SparkSession, profiles: dict[str, SiteProfile]) -> DataFrame:
    """(host, site): the selectors of several sites as rows."""
    values = lambda p: tuple(list(v) if isinstance(v, tuple) else v for v in selector_values(p).values())
    return spark.createDataFrame([(host, values(p)) for host, p in profiles.items()], SITES)


def _classes(tag: str) -> str:
    return f"CASE WHEN contains(lower({tag}), 'class') THEN trim(BOTH '\"\\'' FROM regexp_extract({tag}, {quoted(_CLASS)}, 1)) ELSE '' END"


def _attribute(tag: str, name: str) -> str:
    pattern = rf"""(?is)\s{name}\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)"""
    return bind_sql(
        f"regexp_extract({tag}, {quoted(pattern)}, 1)", "v",
        f"CASE WHEN v <> '' THEN {replace_sql('v', chr(94) + '[' + chr(34) + chr(39) + ']|[' + chr(34) + chr(39) + ']$', '')} END",
    )


def _events(pieces: str, s: Selectors) -> str:
    """Per piece: way (1 opens, -1 closes, -2 closes body or page, 0 neither), name, container, junk."""
    junk = (
        f"exists({s.junk_classes}, j -> CASE WHEN {s.junk_exact_token} THEN array_contains(split(c, '\\\\s+'), j) ELSE contains(c, j) END)"
    )
    opens = bind_sql(
        _classes("t"), "c",
        f"struct(1 AS way, n AS name, n = {s.body_tag} AND ({s.body_class} IS NULL OR contains(c, {s.body_class})) AS body, n = 'div' AND {junk} AS junk)",
    )
    other = "struct(CASE WHEN NOT startswith(t, '</') THEN 0 WHEN n IN ('body', 'html') THEN -2 ELSE -1 END AS way, n AS name, false AS body, false AS junk)"
    known = ", ".join(map(quoted, CONTAINERS))
    event = f"CASE WHEN NOT startswith(t, '</') AND n IN ({known}) THEN {opens} ELSE {other} END"
    named = bind_sql("lower(regexp_extract(t, '^</?([A-Za-z]+)', 1))", "n", event)
    # only the tag is given to patterns, not the text behind it
    return f"transform({pieces}, p -> {bind_sql(tag_of('p'), 't', named)})"


def tag_of(piece: str) -> str:
    return f"concat(substring_index({piece}, '>', 1), '>')"


_START = (
    "named_struct('i', 0, 'open', '', 'depth', 0, 'sound', true, 'a', -1, 'b', -1, 'at', 0, 'junk_a', -1, 'junk_at', 0, 'articles', 0, "
    "'cuts', CAST(array() AS ARRAY<STRUCT<a: INT, b: INT>>))"
)


def _fold(events: str) -> str:
    pops = "(e.way = -1 AND startswith(s.open, concat(e.name, '/')))"
    begins = "(e.way = 1 AND s.a < 0 AND e.body)"
    ends = f"({pops} AND s.b < 0 AND s.at > 0 AND s.at = s.depth)"
    junk_begins = "(e.way = 1 AND s.at > 0 AND s.b < 0 AND s.junk_at = 0 AND e.junk)"
    junk_ends = f"({pops} AND s.junk_at > 0 AND s.junk_at = s.depth)"
    fields = {
        "i": "s.i + 1",
        "open": f"CASE WHEN e.way = 1 THEN concat(e.name, '/', s.open) WHEN {pops} THEN substr(s.open, length(e.name) + 2) ELSE s.open END",
        "depth": f"CASE WHEN e.way = 1 THEN s.depth + 1 WHEN {pops} THEN s.depth - 1 ELSE s.depth END",
        # an end tag with nothing open is ignored by parsers, one that does not fit what is open is not
        "sound": f"s.sound AND (e.way >= 0 OR s.open = '' OR {pops})",
        "a": f"CASE WHEN {begins} THEN s.i ELSE s.a END",
        "b": f"CASE WHEN {ends} THEN s.i ELSE s.b END",
        "at": f"CASE WHEN {begins} THEN s.depth + 1 ELSE s.at END",
        "junk_a": f"CASE WHEN {junk_begins} THEN s.i ELSE s.junk_a END",
        "junk_at": f"CASE WHEN {junk_begins} THEN s.depth + 1 WHEN {junk_ends} THEN 0 ELSE s.junk_at END",
        "articles": "CASE WHEN e.way = 1 AND e.name = 'article' THEN s.articles + 1 ELSE s.articles END",
        "cuts": f"CASE WHEN {junk_ends} THEN array_append(s.cuts, struct(s.junk_a AS a, s.i AS b)) ELSE s.cuts END",
    }
    made = ", ".join(f"'{name}', {value}" for name, value in fields.items())
    return f"aggregate({events}, {_START}, (s, e) -> named_struct({made}))"


def _body(s: Selectors) -> str:
    """Text of the container, from the pieces that no junk block covers."""
    piece = (
        "CASE WHEN exists(f.cuts, c -> f.a + k >= c.a AND f.a + k < c.b) THEN '' "
        f"WHEN NOT {s.keep_junk_tail} AND exists(f.cuts, c -> f.a + k = c.b) THEN regexp_replace(p, '^<[^>]*>[^<]*', '') ELSE p END"
    )
    whole = f"array_join(transform(slice(`__pieces`, f.a + 1, f.b - f.a), (p, k) -> {piece}), '')"
    bare = f"CASE WHEN {s.keep_junk_tail} THEN t ELSE regexp_replace(t, '<![sS]>[^<]*', '') END"
    text = f"regexp_replace({bind_sql(whole, 't', bare)}, '<[^>]*>', '')"
    return bind_sql("`__fold`", "f", f"CASE WHEN f.a >= 0 AND f.b > f.a THEN {text} END")


def page_fields(pages: DataFrame, s: Selectors) -> DataFrame:
    """``pages`` with __title, __body, __labels (references not yet decoded), __published and __odd."""
    e = F.expr
    marked = f"regexp_replace(html, {quoted(_MARKED)}, '<!$1$2>')"
    heads = f"regexp_extract_all(`__page`, {quoted(_HEADING)}, 0)"
    titled = f"filter({heads}, h -> contains({_classes(tag_of('h'))}, {s.title_class}))"
    article = r"(?is)<article(?:\s[^>]*)?>(.*?)</article\s*>"
    links = f"regexp_extract_all(`__page`, {quoted('(?is)<a' + chr(92) + 's[^>]*>.*?</a' + chr(92) + 's*>')}, 0)"
    href = f"coalesce({_attribute(tag_of('x'), 'href')}, '')"
    ours = f"filter({links}, x -> {bind_sql(href, 'h', 'contains(h, ' + quoted('/category/') + ') AND NOT contains(h, ' + quoted('/page/') + ')')})"
    inner = "regexp_replace(x, '(?is)^<[^>]*>|</a\\\\s*>$', '')"
    plain = replace_sql(replace_sql(inner, _INNER_ELEMENT, "<!>"), _INNER_ELEMENT, "<!>")
    times = r"regexp_extract_all(`__page`, '(?is)<time\\s[^>]*>', 0)"
    day = _attribute("t", "datetime")
    own = f"filter(d, t -> contains({_classes('t')}, {s.time_class}))"
    when = bind_sql(
        f"filter({times}, t -> {day} IS NOT NULL)", "d",
        bind_sql(f"coalesce(try_element_at({own}, 1), try_element_at(d, 1))", "t", day),
    )
    step = pages.withColumn("__page", e(marked))
    step = step.withColumns({
        "__pieces": e(f"split(`__page`, {quoted(_EDGE)}, -1)"),
        "__titled": e(f"CASE WHEN {s.title_class} IS NULL THEN CAST(array() AS ARRAY<STRING>) ELSE {titled} END"),
        "__links": e(f"CASE WHEN contains(`__page`, '/category/') THEN transform({ours}, x -> {plain}) ELSE CAST(array() AS ARRAY<STRING>) END"),
        "__published": e(when),
        "__broken": e(f"`__page` RLIKE {quoted(_BROKEN)}"),
    })
    step = step.withColumns({
        "__fold": e(_fold(_events("`__pieces`", s))),
        "__own": e("filter(transform(`__titled`, h -> regexp_extract(h, '(?s)^<[^>]*>([^<]+)', 1)), t -> t <> '')"),
    })
    inside = f"regexp_extract(`__page`, {quoted(article)}, 1)"
    step = step.withColumn(
        "__head", e(f"CASE WHEN size(`__own`) = 0 THEN regexp_extract_all({inside}, {quoted(_HEADING)}, 0) ELSE CAST(array() AS ARRAY<STRING>) END"))
    step = step.withColumns({
        "__other": e(f"regexp_extract(regexp_replace(try_element_at(`__head`, 1), '^<[^>]*>', ''), {quoted(_FIRST_TEXT)}, 1)"),
    })
    odd = " OR ".join((
        "`__broken`", "NOT `__fold`.sound", "`__fold`.open <> ''",
        "exists(`__titled`, h -> h RLIKE '(?is)^<[^>]*><(?!/h1)')",
        "size(`__own`) = 0 AND `__fold`.articles > 1",
        "size(`__own`) = 0 AND size(`__head`) > 0 AND coalesce(`__other`, '') = ''",
        "exists(`__links`, x -> x RLIKE '<[A-Za-z/]')",
    ))
    return step.withColumns({
        "__odd": F.coalesce(e(odd), F.lit(True)),
        "__title": e("coalesce(try_element_at(`__own`, 1), `__other`)"),
        "__body": e(_body(s)),
        "__labels": e(f"array_join(flatten(transform(`__links`, x -> split(x, '<[^>]*>', -1))), {quoted(LABEL_BREAK)})"),
    }).drop("__page", "__pieces", "__titled", "__links", "__broken", "__fold", "__head", "__own", "__other")
