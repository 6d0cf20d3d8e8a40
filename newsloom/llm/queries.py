"""One query per operator, each over its whole table, and SQL where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newsloom.llm import (
    decontaminate, graph_index, importance, line_dedup, merkle, mixing, near_dedup, packing, quality_model, quality_rules,
    substring_dedup, toxicity, warc,
)
from newsloom.session import scratch

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(run):
    QUERIES[run.__name__] = run
    return run


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


@query
def op1_near_dedup(spark, sf):
    return near_dedup.near_duplicates(table(spark, sf, "documents"), shingle_words=3, percent=85)


@query
def op2_line_dedup(spark, sf):
    return line_dedup.dedup_lines(table(spark, sf, "documents")).select(
        "doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256")
    )


@query
def op3_mixing(spark, sf):
    return mixing.mix_sources(table(spark, sf, "documents")).taken()


@query
def op4_quality_model(spark, sf):
    rows = quality_model.classify(table(spark, sf, "documents"), table(spark, sf, "labels"))
    return rows.select("doc_id", "text_score", "meta_score", "score", "kept")


@query
def op5_toxicity(spark, sf):
    docs = table(spark, sf, "documents")
    rows = toxicity.score(docs, toxicity.fit(docs, table(spark, sf, "labels")))
    return rows.select("doc_id", "held_out", "score", "predicted", "threshold", "flagged")


@query
def op6_quality_rules(spark, sf):
    rows = quality_rules.apply_rules(table(spark, sf, "documents"), table(spark, sf, "labels"))
    return rows.select(
        "doc_id", "__s.w.n_words", "__s.word_chars", "__s.n_symbols", "__s.l.n_dup_lines", "__s.w.n_repeat_words",
        "base_failed", "kept",
    )


@query
def op7_substring_dedup(spark, sf):
    return substring_dedup.dedup_passages(table(spark, sf, "documents")).select(
        "doc_id", "n_passages", "repeated_bytes", "dropped_bytes", "shared_with", F.sha2("kept_text", 256).alias("kept_sha256")
    )


@query
def op8_decontamination(spark, sf):
    return decontaminate.contaminated(table(spark, sf, "documents"), table(spark, sf, "benchmark"))


@query
def op9_warc(spark, sf):
    arc, out = scratch(spark, "arc"), scratch(spark, "warc")
    warc.write_arc(table(spark, sf, "pages"), arc)
    records = warc.read_arc(spark, arc)
    warc.write_warc(warc.convert(records, key=warc.header("X-Key", F.col("head"))), out)
    return warc.read_warc(spark, out).select(
        F.col("key").alias("page_id"), "payload_bytes", "payload_digest", F.col("warc_type").alias("record_type"),
        F.col("refers_to_key").alias("refers_to"),
    )


@query
def op10_token_packing(spark, sf):
    return packing.pack_tokens(table(spark, sf, "documents"))


@query
def op11_nearest_vectors(spark, sf):
    return graph_index.nearest(table(spark, sf, "embeddings"), every=20, k=20)


@query
def op12_merkle_manifest(spark, sf):
    tampered = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(7)) == 0
    found = {"n_chars": F.when(tampered, F.col("n_chars") + 1).otherwise(F.col("n_chars"))}
    return merkle.proofs(table(spark, sf, "documents"), found).select(
        "doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"
    )


@query
def op13_importance_resampling(spark, sf):
    return importance.ranked(table(spark, sf, "documents"), table(spark, sf, "benchmark")).select(
        "doc_id", "n_features", "weight", "score", "rank"
    )


SQL["op2_line_dedup"] = r"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         unnest(range(len(string_split(coalesce(text, ''), chr(10))))) AS pos
  FROM documents
), keyed AS (
  SELECT *, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM lines
), common AS (
  SELECT key, max(doc_id) AS keeper FROM keyed WHERE length(key) >= 40
  GROUP BY key HAVING count(DISTINCT doc_id) >= 5
), marked AS (
  SELECT k.doc_id, k.pos, k.line, c.key IS NOT NULL AND k.doc_id <> c.keeper AS dropped
  FROM keyed k LEFT JOIN common c USING (key)
)
SELECT doc_id, count(*) AS n_lines, CAST(coalesce(sum(CAST(dropped AS INT)), 0) AS BIGINT) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT dropped), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""

SQL["op9_warc"] = """
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
f AS (SELECT h, min(page_id) AS first FROM p WHERE strlen(h) >= 100 GROUP BY h)
SELECT page_id, CAST(strlen(p.h) AS BIGINT) AS payload_bytes, sha256(p.h) AS payload_digest,
       CASE WHEN first <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN first <> page_id THEN first END AS refers_to
FROM p LEFT JOIN f ON p.h = f.h
"""

# CRC-32 of a text: its bytes, each followed by eight steps (-1), folded into the register.
def _crc32(text: str) -> str:
    return f"""xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(
        range(strlen({text})), lambda i: [CAST('0x' || substr(hex(encode({text})), 2 * i + 1, 2) AS BIGINT), -1, -1, -1, -1, -1, -1, -1, -1]))),
        lambda c, x: CASE WHEN x >= 0 THEN xor(c, x) ELSE xor(c >> 1, 3988292384 * (c & 1)) END))"""


SQL["op13_importance_resampling"] = rf"""
WITH w AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS f FROM documents
), b AS (
  SELECT unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS f FROM benchmark
), crc AS (
  SELECT f, {_crc32("f")} % 10000 AS k FROM (SELECT f FROM w UNION SELECT f FROM b)
), dw AS (
  SELECT doc_id, k, count(*) AS n FROM w JOIN crc USING (f) GROUP BY doc_id, k
), s AS (SELECT k, sum(n) AS s FROM dw GROUP BY k
), t AS (SELECT k, count(*) AS t FROM b JOIN crc USING (f) GROUP BY k
), gain AS (
  SELECT k, CAST(floor(1000 * ln(CAST((coalesce(t, 0) + 1) * ((SELECT coalesce(sum(s), 0) FROM s) + 10000) AS DOUBLE)
         / CAST((s + 1) * ((SELECT coalesce(sum(t), 0) FROM t) + 10000) AS DOUBLE))) AS BIGINT) AS g
  FROM s LEFT JOIN t USING (k)
), weight AS (
  SELECT doc_id, CAST(sum(n) AS BIGINT) AS n, CAST(sum(n * g) AS BIGINT) AS weight FROM dw JOIN gain USING (k) GROUP BY doc_id
), scored AS (
  SELECT d.doc_id, coalesce(n, 0) AS n_features, coalesce(weight, 0) AS weight, coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln(
         (CAST('0x' || substr(sha256('2024:' || d.doc_id), 1, 8) AS BIGINT) + 0.5::DOUBLE) / 4294967296::DOUBLE))) AS BIGINT) AS score
  FROM documents d LEFT JOIN weight x ON d.doc_id = x.doc_id
), placed AS (
  SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS place, count(*) OVER () AS fitting FROM scored WHERE n_features >= 20
)
SELECT s.doc_id, n_features, weight, score, CASE WHEN place <= 10 * fitting // 100 THEN place END AS rank
FROM scored s LEFT JOIN placed p ON s.doc_id = p.doc_id
"""

_FIELD = "CASE WHEN {0} IS NULL THEN '-' ELSE strlen(CAST({0} AS VARCHAR)) || ':' || {0} END"
_LEAF = "sha256(" + " || ".join(_FIELD.format(c) for c in ("doc_id", "source", "lang", "{n}", "text")) + ")"
SQL["op12_merkle_manifest"] = f"""
WITH RECURSIVE leaves AS (
  SELECT doc_id, lang, {_LEAF.format(n="n_chars")} AS leaf,
         {_LEAF.format(n=f"(n_chars + CAST({_crc32('CAST(doc_id AS VARCHAR)')} % 7 = 0 AS BIGINT))")} AS seen,
         dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS g,
         row_number() OVER (PARTITION BY lang ORDER BY doc_id) - 1 AS slot
  FROM documents
), low(g, depth, slot, h, n) AS (
  SELECT g, 0, slot, leaf, count(*) OVER (PARTITION BY g) FROM leaves
  UNION ALL
  SELECT g, any_value(depth) + 1, slot // 2, sha256(string_agg(h, '' ORDER BY slot)), (any_value(n) + 1) // 2
  FROM low WHERE n > 1 GROUP BY g, slot // 2
), sub AS (SELECT g, depth, h FROM low WHERE n = 1
), high(depth, slot, h, n) AS (
  SELECT 0, g, h, (SELECT count(*) FROM sub) FROM sub
  UNION ALL
  SELECT any_value(depth) + 1, slot // 2, sha256(string_agg(h, '' ORDER BY slot)), (any_value(n) + 1) // 2
  FROM high WHERE n > 1 GROUP BY slot // 2
), steps AS (
  SELECT l.g, l.slot AS leaf_slot, x.depth, (l.slot >> x.depth) & 1 AS is_right, s.h
  FROM leaves l JOIN low x ON x.g = l.g AND x.n > 1 AND x.slot = l.slot >> x.depth
  LEFT JOIN low s ON s.g = l.g AND s.depth = x.depth AND s.slot = xor(x.slot, 1)
  UNION ALL
  SELECT l.g, l.slot, sub.depth + x.depth, (l.g >> x.depth) & 1, s.h
  FROM leaves l JOIN sub ON sub.g = l.g JOIN high x ON x.n > 1 AND x.slot = l.g >> x.depth
  LEFT JOIN high s ON s.depth = x.depth AND s.slot = xor(x.slot, 1)
), fold(g, slot, depth, h) AS (
  SELECT g, slot, 0, coalesce(seen, leaf) FROM leaves
  UNION ALL
  SELECT f.g, f.slot, f.depth + 1,
         sha256(CASE WHEN s.h IS NULL THEN f.h WHEN is_right = 1 THEN s.h || f.h ELSE f.h || s.h END)
  FROM fold f JOIN steps s ON s.g = f.g AND s.leaf_slot = f.slot AND s.depth = f.depth
), folded AS (SELECT g, slot, arg_max(h, depth) AS h FROM fold GROUP BY g, slot
), proof AS (
  SELECT g, leaf_slot AS slot, sha256(coalesce(string_agg(h, '' ORDER BY depth), '')) AS p FROM steps GROUP BY g, leaf_slot
), top AS (SELECT h FROM high WHERE n = 1)
SELECT doc_id, leaf, sub.h AS subroot, top.h AS root, coalesce(p, sha256('')) AS proof_sha256, folded.h AS folded_root, folded.h = top.h AS verified
FROM leaves l JOIN sub USING (g) CROSS JOIN top JOIN folded ON folded.g = l.g AND folded.slot = l.slot
LEFT JOIN proof ON proof.g = l.g AND proof.slot = l.slot
"""
