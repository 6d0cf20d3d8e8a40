"""Small Column building blocks shared by the other functions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Java \s under (?U) covers the Unicode spaces; the four separators U+001C..U+001F
# are whitespace for str.strip() and re in Python 3 but not for Java.
UNICODE_SPACE = r"[\s\x1c-\x1f]"

NL, NBSP = "\n", "\u00a0"

# Every character str.strip() removes.
STRIPPED = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005"
    "\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once and use it several times inside ``body``."""
    return F.element_at(F.transform(F.array(value), body), 1)


def strip_unicode(text: Column) -> Column:
    """strip every Unicode whitespace character on both ends."""
    return F.btrim(text, F.lit(STRIPPED))


def quoted(text: str) -> str:
    """A SQL string literal."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def bind_sql(value: str, name: str, body: str) -> str:
    """``bind`` for SQL text: evaluate ``value`` once, as ``name`` inside ``body``."""
    return f"element_at(transform(array({value}), {name} -> {body}), 1)"


def replace_sql(value: str, pattern: str, by: str) -> str:
    return f"regexp_replace({value}, {quoted(pattern)}, {quoted(by)})"


def _fold_sql(value: str, signs: tuple[str, ...], pattern: str, by: str) -> str:
    """Run a regex only on text that holds something for it to do."""
    found = " OR ".join(f"contains(t, {quoted(sign)})" for sign in signs)
    return bind_sql(value, "t", f"CASE WHEN {found} THEN {replace_sql('t', pattern, by)} ELSE t END")


def archive_text_sql(value: str) -> str:
    """Whitespace rule of the archive form: F10 (NBSP included), spaces around newlines, F9, F11.

    Long rules are written as SQL text: one call builds them, where a Column chain
    takes a round trip to the JVM per function.
    """
    value = f"replace({value}, {quoted(NBSP)}, ' ')"
    value = _fold_sql(value, ("  ", "\t", "\f", "\x0b"), r"[ \t\f\x0B]++", " ")
    value = _fold_sql(value, (" \n", "\n "), " *+\n *+", "\n")
    return f"btrim({_fold_sql(value, (NL * 3,), NL + '{3,}', NL * 2)}, {quoted(STRIPPED)})"


def normalize_archive_text(column: str) -> Column:
    return F.expr(archive_text_sql(f"`{column}`"))


def page_text_sql(value: str) -> str:
    """Whitespace rule of the page form: F11, then F9, then F10."""
    value = f"btrim({value}, {quoted(STRIPPED)})"
    value = _fold_sql(value, (NL,), rf"(?U)\n{UNICODE_SPACE}*\n+", NL * 2)
    return _fold_sql(value, ("  ", "\t"), r"[ \t]++", " ")


def normalize_page_text(column: str) -> Column:
    return F.expr(page_text_sql(column))
