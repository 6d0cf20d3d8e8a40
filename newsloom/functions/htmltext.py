"""F1/F8: HTML to text, as Columns wherever regexes can read the page.

``fast_block_text`` reads usual pages inside the JVM and answers null when it meets
something only a parser reads right (nested or unclosed skipped elements, broken tags,
unusual character references). ``add_html_text`` sends just those pages to the parser,
so the result is exact for all of them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsloom.functions.columns import (
    archive_text_sql, bind_sql, normalize_archive_text, quoted, replace_sql,
)
from newsloom.functions.parser import block_text, unescape
from newsloom.functions.tags import BLOCK_TAGS, SKIP_TAGS

# The character references news pages are full of. Those that stand for
# "&" are decoded last, so that nothing is decoded twice in one round.
MARKUP_REFERENCES = {
    "&lt;": "<", "&gt;": ">", "&quot;": '"', "&apos;": "'", "&nbsp;": "\u00a0",
    "&copy;": "\u00a9", "&middot;": "\u00b7",
}
TYPOGRAPHIC_REFERENCES = {
    "&hellip;": "\u2026", "&ndash;": "\u2013", "&mdash;": "\u2014",
    "&lsquo;": "\u2018", "&rsquo;": "\u2019", "&ldquo;": "\u201c", "&rdquo;": "\u201d",
}
NUMERIC_REFERENCES = {
    "&#34;": '"', "&#39;": "'", "&#039;": "'", "&#160;": "\u00a0",
    "&#8211;": "\u2013", "&#8212;": "\u2014", "&#8216;": "\u2018", "&#8217;": "\u2019",
    "&#8220;": "\u201c", "&#8221;": "\u201d", "&#8230;": "\u2026",
}
AMPERSANDS = ("&#38;", "&#038;", "&amp;")

# Every pattern starts with "<", so that the matcher leaves other characters at once,
# and loops are possessive, so that long pages cannot exhaust the stack.
_ATTRS = r"""[^<>"']*+(?:"[^"<>]*+"[^<>"']*+|'[^'<>]*+'[^<>"']*+)*+"""
_BLOCKS = "|".join(BLOCK_TAGS)
_HIDDEN = "|".join(SKIP_TAGS)


def _raw_element(tag: str) -> str:
    return rf"{tag}(?:\s[^<>]*+)?(?<!/)>[^<]*+(?:<(?!/{tag}[\s/>])[^<]*+)*+</{tag}\s*+>"


_RAW = "|".join([
    r"!--(?!-?>)[^-]*+(?:-(?!-\s*+!?>)[^-]*+)*+-->",
    *[_raw_element(tag) for tag in ("script", "style")],
])


def _hidden_element(tag: str) -> str:
    inner = rf"[^<]*+(?:<(?:{_RAW}|(?!!|/?(?:{_HIDDEN})[\s/>]))[^<]*+)*+"
    return rf"{tag}(?:\s[^<>]*+)?(?<!/)>{inner}</{tag}\s*+>"


# Comments, the doctype, elements whose content is raw text, and hidden elements that
# hold at most those. Anything odd does not match and is noticed later.
_UNSEEN = "(?i)<(?:" + "|".join([
    _RAW, r"!doctype[^<>]*+>", *[_hidden_element(tag) for tag in ("noscript", "svg", "template")],
]) + ")"
_SELF_CLOSED = rf"""(?i)<(?:{_BLOCKS})(?:\s{_ATTRS}(?<=["'\s]/)|/)>"""
_BLOCK = rf"(?i)<(?:/(?:{_BLOCKS})\s*+|(?:{_BLOCKS})(?:[\s/]{_ATTRS})?)>"
_OTHER = rf"(?i)<(?!/?(?:{_HIDDEN})[\s/>])(?:[a-z][^\s/<>]*+(?:[\s/]{_ATTRS})?|/[a-z][^\s/<>]*+\s*+)>"

_NAMES = "|".join(
    ref[1:] for group in (MARKUP_REFERENCES, TYPOGRAPHIC_REFERENCES, NUMERIC_REFERENCES) for ref in group
)
_AMPS = "|".join(ref[1:] for ref in AMPERSANDS)
# A reference the list does not have; for two rounds also one that the first round makes.
_ODD_ONCE = rf"&(?!(?:{_NAMES}|{_AMPS}))[#A-Za-z]"
_ODD_TWICE = rf"(?!(?:{_NAMES}|(?:{_AMPS})(?![#A-Za-z])))[#A-Za-z]"
_ODD_PAGE = rf"[<&](?:(?<=<)[A-Za-z/!?]|(?<=&){_ODD_TWICE})"


def _replace_all_sql(value: str, chars: dict[str, str]) -> str:
    for reference, char in chars.items():
        value = f"replace({value}, {quoted(reference)}, {quoted(char)})"
    return value


def decode_usual_sql(value: str) -> str:
    """Decode the usual references, one round. Groups a text has nothing of are passed over."""
    def when(test: str, value: str, chars: dict[str, str]) -> str:
        return bind_sql(value, "t", f"CASE WHEN {test} THEN {_replace_all_sql('t', chars)} ELSE t END")

    signs = "|".join(ref[1:] for ref in TYPOGRAPHIC_REFERENCES)
    more = when("t RLIKE '&(?!amp;)[a-z]'", "t", MARKUP_REFERENCES)
    more = when(f"t RLIKE {quoted(f'&(?:{signs})')}", more, TYPOGRAPHIC_REFERENCES)
    more = when("contains(t, '&#')", more, {**NUMERIC_REFERENCES, "&#38;": "&amp;", "&#038;": "&amp;"})
    more = _replace_all_sql(more, {"&amp;": "&"})
    return bind_sql(value, "t", f"CASE WHEN contains(t, '&') THEN {more} ELSE t END")


def add_decoded(df: DataFrame, texts: dict[str, Column], also: dict[str, Column] | None = None) -> DataFrame:
    """F8, one round, exact: add one decoded column per entry of ``texts``.

    Text with an unusual reference goes to Python, all other text stays in the JVM. Columns of ``also``
    are added in the same step, so that those which need Python share its batches.
    """
    raw = df.withColumns({f"__raw_{name}": text for name, text in texts.items()})
    out = raw.withColumns({
        name: F.coalesce(
            unescape(F.expr(f"CASE WHEN `__raw_{name}` RLIKE {quoted(_ODD_ONCE)} THEN `__raw_{name}` END")),
            F.expr(decode_usual_sql(f"`__raw_{name}`")),
        )
        for name in texts
    } | (also or {}))
    return out.drop(*[f"__raw_{name}" for name in texts])


def _block_text_sql(value: str) -> str:
    text = replace_sql(f"coalesce({value}, '')", _UNSEEN, "")
    text = replace_sql(replace_sql(text, _SELF_CLOSED, "\n\n"), _BLOCK, "\n")
    text = replace_sql(text, _OTHER, "")
    return bind_sql(text, "t", f"CASE WHEN NOT t RLIKE {quoted(_ODD_PAGE)} THEN {decode_usual_sql('t')} END")


def fast_block_text(column: str) -> Column:
    """Visible text with block edges as newlines, or null if a parser is needed."""
    return F.expr(_block_text_sql(f"`{column}`"))


def html_to_text(column: str) -> Column:
    """F1 for markup known to be plain: null where the parser would be needed."""
    return F.expr(archive_text_sql(_block_text_sql(f"`{column}`")))


def html_to_text_exact(df: DataFrame, column: str, to: str) -> DataFrame:
    """F1 by the parser for every row."""
    parsed = df.withColumn(to, block_text(F.coalesce(column, F.lit(""))))
    return parsed.withColumn(to, normalize_archive_text(to))


def add_html_text(df: DataFrame, texts: dict[str, Column]) -> DataFrame:
    """F1 with its exact fallback: add one text column per entry of ``texts``.

    The fallback input is null for pages the Column path could read, so the Python
    worker receives only the markup it is needed for.
    """
    raw = df.withColumns({f"__raw_{name}": markup for name, markup in texts.items()})
    fast = raw.withColumns({f"__fast_{name}": fast_block_text(f"__raw_{name}") for name in texts})
    shown = fast.withColumns({
        f"__shown_{name}": F.coalesce(
            F.col(f"__fast_{name}"),
            block_text(F.when(F.col(f"__fast_{name}").isNull(), F.coalesce(f"__raw_{name}", F.lit("")))),
        )
        for name in texts
    })
    out = shown.withColumns({name: normalize_archive_text(f"__shown_{name}") for name in texts})
    return out.drop(*[f"__{kind}_{name}" for kind in ("raw", "fast", "shown") for name in texts])
