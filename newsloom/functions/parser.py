"""Arrow-batched HTML helpers for markup that no regex can read.

Only pages that Columns cannot read exactly come here: skipped elements inside each
other, unclosed, overlapping or broken tags. Whitespace rules, filters and choices
between candidates stay outside, as Columns.
"""

from __future__ import annotations

import html
import sys
from html.parser import HTMLParser
from itertools import accumulate

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from newsloom.functions.tags import BLOCK_TAGS, SKIP_TAGS, VOID_TAGS

# Elements that can be an article's container, or hold one; others are never cut at.
CONTAINERS = ("div", "article", "section", "main")

_BLOCK, _SKIP, _VOID = set(BLOCK_TAGS), set(SKIP_TAGS), set(VOID_TAGS)

# Executors need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


class _Tape(HTMLParser):
    """What a page consists of, in order: (1, tag) opens, (-1, tag) closes, (0, text)."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.parts: list[tuple[int, str]] = []

    def handle_starttag(self, tag, attrs):
        self.parts.append((1, tag))

    def handle_endtag(self, tag):
        self.parts.append((-1, tag))

    def handle_data(self, data):
        self.parts.append((0, data))


def _block_text(markup: str) -> str:
    """Text outside skipped elements, a newline wherever a block element begins or ends."""
    tape = _Tape()
    tape.feed(markup)
    tape.close()
    steps = (way if way and name in _SKIP else 0 for way, name in tape.parts)
    depths = accumulate(steps, lambda depth, step: max(0, depth + step))
    shown = ((way, name) for (way, name), depth in zip(tape.parts, depths) if depth == 0)
    return html.unescape("".join(
        "\n" if way and name in _BLOCK else "" if way else name for way, name in shown
    ))


@F.pandas_udf(T.StringType())
def _block_texts(markup: pd.Series) -> pd.Series:
    return markup.map(_block_text, na_action="ignore")


@F.pandas_udf(T.StringType())
def _unescaped(text: pd.Series) -> pd.Series:
    return text.map(html.unescape, na_action="ignore")


# Text of a page before whitespace rules, and one round of decoding; null stays null.
# Marked as they are so that a filter on their result is not pushed below them, where
# everything it rests on would be computed a second time.
block_text = _block_texts.asNondeterministic()
unescape = _unescaped.asNondeterministic()


class _Article(HTMLParser):
    """Raw pieces of one article page: title nodes, container text, dates, categories."""

    def __init__(self, title_class, body_tag, body_class, time_class, junk, exact, keep_tail):
        super().__init__(convert_charrefs=True)
        self.title_class, self.body_tag, self.body_class, self.time_class = title_class, body_tag, body_class, time_class
        self.junk, self.exact, self.keep_tail = junk, exact, keep_tail
        self.stack = []                     # open elements, innermost last
        self.main_title = self.any_title = self.body = None
        self.entry_date = self.any_date = None
        self.labels = []
        self.body_depth = self.junk_depth = 0
        self.after_junk = False

    def _is_junk(self, tag, classes):
        if tag in ("style", "script"):
            return True
        names = classes.split() if self.exact else classes
        return tag == "div" and any(j in names for j in self.junk)

    def handle_starttag(self, tag, attrs):
        got = dict(reversed(attrs))         # the first of repeated attributes counts
        classes = got.get("class") or ""
        self.after_junk = False
        if tag == "time" and got.get("datetime") is not None:
            if self.any_date is None:
                self.any_date = got["datetime"]
            if self.entry_date is None and self.time_class in classes:
                self.entry_date = got["datetime"]
        if tag in _VOID:
            return
        href = got.get("href") or ""
        mark = "label" if tag == "a" and "/category/" in href and "/page/" not in href else ""
        if tag == "h1" and self.title_class and self.title_class in classes:
            mark = "title"
        self.stack.append((tag, mark))
        if self.body_depth:
            if not self.junk_depth and self._is_junk(tag, classes):
                self.junk_depth = len(self.stack)
        elif self.body is None and tag == self.body_tag and (self.body_class is None or self.body_class in classes):
            self.body, self.body_depth = [], len(self.stack)

    def handle_comment(self, data):
        self.after_junk = False

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)    # "/>" closes nothing but void elements in HTML

    def handle_endtag(self, tag):
        self.after_junk = False
        for at in range(len(self.stack), 0, -1):
            name = self.stack[at - 1][0]
            if name == tag:
                del self.stack[at - 1:]
                if self.junk_depth >= at:
                    self.junk_depth, self.after_junk = 0, True
                if self.body_depth >= at:
                    self.body_depth = 0
                return
            if name in CONTAINERS and tag not in ("body", "html", "article", *(CONTAINERS if name != "div" else ())):
                return                      # an inline end tag never closes a container, only few close a div

    def handle_data(self, data):
        tag, mark = self.stack[-1] if self.stack else ("", "")
        if mark == "title" and self.main_title is None:
            self.main_title = data
        if self.any_title is None:
            names = [name for name, _ in self.stack]
            if "article" in names and "h1" in names[names.index("article"):]:
                self.any_title = data
        if mark == "label":
            self.labels.append(data)
        if self.body_depth and not self.junk_depth and (self.keep_tail or not self.after_junk):
            self.body.append(data)


ARTICLE_PIECES = (
    "title string, body string, published string, category_labels array<string>"
)


def article_pieces(page: Column) -> Column:
    """F2-F6 in one parse per page: raw title, container text, date and category labels.

    ``page``: struct of the markup and the selectors, null where nothing is to be parsed.
    """
    def read(html, *selectors):
        reader = _Article(*selectors)
        reader.feed(html)
        reader.close()
        title = reader.main_title if reader.main_title is not None else reader.any_title
        date = reader.entry_date if reader.entry_date is not None else reader.any_date
        return (title, None if reader.body is None else "".join(reader.body), date, reader.labels)

    @F.pandas_udf(ARTICLE_PIECES)
    def pieces(pages: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame(
            [(None, None, None, None) if page[0] is None else read(*page) for page in pages.itertuples(index=False, name=None)],
            columns=["title", "body", "published", "category_labels"],
        )

    return pieces.asNondeterministic()(page)
