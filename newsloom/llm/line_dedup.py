"""Operator 2: lines that many documents share are dropped from all but one of them.

Lines are exploded with a normalised key (space stripped at both ends, A-Z in lower
case), keys are hashed to 128 bits, and distinct documents are counted per hash. A key
over the threshold loses its lines everywhere except in the largest ``doc_id`` holding
it. What to drop comes back as one set of hashes per document, and only documents with
such a set are taken apart and put together again by position.

Counting is on distinct (hash, document), then on the hash, both combined before the
shuffle, so a line found in every document is a few records per task. In the join back a hash
is split by a salt from the document; the shared hashes, few against the lines, are given to every salt.

Defined cases: a null or empty text is one empty line; rows that repeat a ``doc_id``
are one document (one count, each row keeps its own text); a row without ``doc_id`` is
not counted and loses nothing. The output columns of ``dedup_lines`` replace input columns of
the same names; others pass through untouched.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsloom.llm.common import SPACES, ascii_lower, replaced, stored, temporary

SALTS = 16                                  # parts of a line that many documents share


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text.cast("string"), F.lit("")), "\n", -1)


def _hash(line: Column) -> Column:
    key = ascii_lower(F.btrim(line, F.lit(SPACES)))
    return F.struct(F.xxhash64(key).alias("a"), F.xxhash64(F.lit(1), key).alias("b"), F.length(key).alias("n"))


def repeated_lines(docs: DataFrame, min_chars: int = 40, min_docs: int = 5) -> DataFrame:
    """(doc_id, drop): per document the hashes of the keys that it loses."""
    hashed = F.filter(
        F.transform(F.filter(_lines(F.col("text")), lambda x: F.length(x) >= min_chars), _hash),
        lambda h: h["n"] >= min_chars,
    )
    lines = docs.where("doc_id is not null").select(F.col("doc_id").cast("long"), F.explode(hashed).alias("h"))
    lines = stored(lines.select("doc_id", "h.a", "h.b").distinct(), "lines")
    common = (
        lines.groupBy("a", "b").agg(F.count("*").alias("n"), F.max("doc_id").alias("keeper"))
        .where(F.col("n") >= min_docs).select("a", "b", "keeper", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    )
    salted = lines.withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)).cast("int"))
    return salted.join(common, ["a", "b", "salt"]).where("doc_id <> keeper").groupBy("doc_id").agg(
        F.collect_list(F.struct("a", "b")).alias("drop")
    )


def dedup_lines(docs: DataFrame, min_chars: int = 40, min_docs: int = 5) -> DataFrame:
    """The rows with ``kept_text``, ``n_lines`` (before) and ``n_dropped``."""
    key, gone, result = temporary("id"), temporary("drop"), temporary("made")
    docs = replaced(docs, "n_lines", "n_dropped", "kept_text")
    drops = repeated_lines(docs, min_chars, min_docs).select(F.col("doc_id").alias(key), F.col("drop").alias(gone))
    pair = lambda line: F.struct(_hash(line)["a"].alias("a"), _hash(line)["b"].alias("b"))
    kept = F.filter(_lines(F.col("text")), lambda x: (F.length(x) < min_chars) | ~F.array_contains(F.col(gone), pair(x)))
    joined = docs.join(drops, F.col("doc_id").cast("long") == F.col(key), "left")
    whole = F.coalesce(F.col("text").cast("string"), F.lit(""))
    n = F.size(_lines(F.col("text"))).cast("long")
    rebuilt = F.when(F.col(gone).isNull(), F.struct(whole.alias("t"), F.lit(0).cast("long").alias("d"))).otherwise(
        F.transform(F.array(kept), lambda k: F.struct(F.array_join(k, "\n").alias("t"), (n - F.size(k)).alias("d")))[0]
    )
    return joined.withColumn(result, rebuilt).select(
        *(F.col(f"`{c}`") for c in docs.columns), n.alias("n_lines"),
        F.col(f"{result}.d").alias("n_dropped"), F.col(f"{result}.t").alias("kept_text"),
    )
