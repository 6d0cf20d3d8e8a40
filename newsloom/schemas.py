"""Explicit schemas of every input and output; nothing is inferred."""

from __future__ import annotations

from pyspark.sql import types as T

CORRUPT = "_corrupt_record"

_rendered = T.StructType([T.StructField("rendered", T.StringType())])


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields])


URL_LIST = _struct(
    ("url", T.StringType()),
    ("category_slug", T.StringType()),
    ("category_name", T.StringType()),
)

PAGES = _struct(("url", T.StringType()), ("html", T.StringType()))

LISTING_PAGES = _struct(
    ("category_slug", T.StringType()),
    ("page_num", T.IntegerType()),
    ("html", T.StringType()),
)

ARCHIVE_POST = _struct(
    ("id", T.LongType()),
    ("date", T.StringType()),
    ("modified", T.StringType()),
    ("link", T.StringType()),
    ("slug", T.StringType()),
    ("title", _rendered),
    ("content", _rendered),
    ("excerpt", _rendered),
    ("categories", T.ArrayType(T.LongType())),
    ("tags", T.ArrayType(T.LongType())),
    ("author", T.LongType()),
)

ARTICLES_ARCHIVE = _struct(
    ("id", T.LongType()),
    ("url", T.StringType()),
    ("slug", T.StringType()),
    ("published_at", T.StringType()),
    ("modified_at", T.StringType()),
    ("title", T.StringType()),
    ("text", T.StringType()),
    ("excerpt", T.StringType()),
    ("categories", T.ArrayType(T.LongType())),
    ("tags", T.ArrayType(T.LongType())),
    ("author_id", T.LongType()),
    ("source", T.StringType()),
)

ARTICLES_PAGE = _struct(
    ("url", T.StringType()),
    ("title", T.StringType()),
    ("category", T.StringType()),
    ("published_date", T.StringType()),
    ("body_text", T.StringType()),
    ("char_count", T.IntegerType()),
    ("scraped_at", T.StringType()),
)

PROGRESS = _struct(
    ("completed_urls", T.ArrayType(T.StringType())),
    ("failed_urls", T.ArrayType(T.StringType())),
    ("total_saved", T.LongType()),
    ("current_shard_idx", T.LongType()),
    ("current_shard_count", T.LongType()),
    ("start_time", T.StringType()),
    ("last_saved_at", T.StringType()),
)

LEDGER = _struct(
    ("url", T.StringType()),
    ("attempt", T.IntegerType()),
    ("ts", T.TimestampType()),
    ("status", T.IntegerType()),
    ("outcome", T.StringType()),
)


def with_corrupt(schema: T.StructType) -> T.StructType:
    return T.StructType(schema.fields + [T.StructField(CORRUPT, T.StringType())])
