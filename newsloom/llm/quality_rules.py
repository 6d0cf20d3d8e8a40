"""Operator 6: quality rules learned as a decision list, applied as Spark columns.

Statistics of a text are plain columns. A list is learned from labelled statistics by
sequential covering: a rule is a conjunction of thresholds; it grows on two thirds of
the labelled rows by the condition with the best gain, is pruned on the other third,
and the rows it covers leave the set before the next rule is grown. The list is then
an ordered CASE WHEN; texts that no rule covers are kept.

The learning set is bounded (``max_labelled``, the labels of lowest hash); statistics
and verdicts cover every row. All of it is DataFrame expressions; the rows that come to
the driver are the bounded learning set, about ten numbers each.

Repeats inside a text are found without leaving the row: every five-word window is
packed as (39 bits of its hash, 24 bits of its place), the packed numbers are sorted,
neighbours with the same full hash are repeats, and the words they cover are summed.

Defined cases: a null text has no words and fails; labels that are null, or whose
document is missing, teach nothing; without labels of both kinds the list is empty. The
output columns ``__s``, ``base_failed`` and ``kept`` replace input columns of the same names; others pass through.
"""

from __future__ import annotations

from math import log2

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsloom.llm.common import SPACE_CLASS, WORD_CLASS, stored

WINDOW = 5
PLACE_BITS = 24
SYMBOLS = "[#*$%&|<>]"
RATIOS = (
    "symbols_per_word", "repeat_share", "dup_line_share", "upper_share", "word_length",
    "marks_per_word", "distinct_share", "words_per_line", "digit_share",
)


def _let(value: Column, body) -> Column:
    """Bind ``value`` once; a column used inside a lambda would be computed per element."""
    return F.transform(F.array(value), body)[0]


def _repeat_words(words: Column) -> Column:
    """Words covered by windows of five words that occur at least twice."""
    def covered(hashes: Column) -> Column:
        mask = F.lit((1 << PLACE_BITS) - 1)
        packed = F.array_sort(F.transform(
            hashes, lambda h, i: F.shiftleft(F.shiftrightunsigned(h, PLACE_BITS + 1), PLACE_BITS).bitwiseOR(i.cast("long"))
        ))
        narrow = _let(packed, lambda order: F.transform(order, lambda p: F.struct(
            F.get(hashes, p.bitwiseAND(mask).cast("int")).alias("h"), p.bitwiseAND(mask).cast("int").alias("i")
        )))
        # a text of more words than places: the same order on (hash, place), only slower
        wide = F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def repeats(full: Column) -> Column:
            same = lambda s, e, k: F.get(s, k)["h"] == e["h"]
            return F.array_sort(F.filter(F.transform(full, lambda e, k: F.when(
                same(full, e, k + 1) | same(full, e, k - 1) | same(full, e, k + 2) | same(full, e, k - 2), e["i"]
            )), lambda i: i.isNotNull()))

        found = _let(F.when(F.size(hashes) < (1 << PLACE_BITS), narrow).otherwise(wide), repeats)
        return _let(found, lambda at: F.aggregate(
            at, F.struct(F.lit(0).cast("long").alias("sum"), F.lit(-WINDOW).alias("last")),
            lambda acc, i: F.struct(
                (acc["sum"] + F.least(F.lit(WINDOW), i - acc["last"])).cast("long").alias("sum"), i.alias("last")
            ),
            lambda acc: acc["sum"],
        ))

    def windows(ids: Column) -> Column:
        return F.transform(
            F.slice(ids, 1, F.size(ids) - (WINDOW - 1)),
            lambda a, i: F.xxhash64(a, *(F.get(ids, i + k) for k in range(1, WINDOW))),
        )

    return F.when(F.size(words) <= WINDOW, F.lit(0).cast("long")).otherwise(
        _let(_let(F.transform(words, lambda w: F.xxhash64(w)), windows), covered)
    )


def with_statistics(docs: DataFrame, text: str = "text") -> DataFrame:
    """The rows of ``docs`` with the columns of ``__s``: counts of the whole text."""
    t = F.coalesce(F.col(text).cast("string"), F.lit(""))
    count = lambda pattern: F.regexp_count(t, F.lit(pattern)).cast("long")
    words = F.regexp_extract_all(t, F.lit(f"({WORD_CLASS})"), 1)
    lines = F.filter(F.split(t, "\n", -1), lambda x: x.rlike(WORD_CLASS))
    return docs.withColumn("__s", F.struct(
        _let(words, lambda w: F.struct(
            F.size(w).cast("long").alias("n_words"),
            _repeat_words(w).alias("n_repeat_words"),
            F.size(F.array_distinct(w)).cast("long").alias("n_distinct"),
        )).alias("w"),
        _let(lines, lambda x: F.struct(
            F.size(x).cast("long").alias("n_lines"),
            (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
        )).alias("l"),
        (F.length(t) - count(SPACE_CLASS)).cast("long").alias("word_chars"),
        count(SYMBOLS).alias("n_symbols"),
        count(r"\p{Lu}").alias("n_upper"), count("[!?.,;:]").alias("n_marks"), count("[0-9]").alias("n_digits"),
    ))


def ratios() -> dict[str, Column]:
    """What rules test, from the columns of ``with_statistics``; rounded so that thresholds are exact."""
    s = lambda name: F.col(f"__s.{name}").cast("double")
    words, lines, chars = (F.greatest(s(x), F.lit(1.0)) for x in ("w.n_words", "l.n_lines", "word_chars"))
    made = (
        s("n_symbols") / words, s("w.n_repeat_words") / words, s("l.n_dup_lines") / lines, s("n_upper") / chars,
        chars / words, s("n_marks") / words, s("w.n_distinct") / words, words / lines, s("n_digits") / chars,
    )
    return dict(zip(RATIOS, (F.round(x, 4) for x in made)))


def base_failed() -> Column:
    n, repeated = F.col("__s.w.n_words"), F.col("__s.w.n_repeat_words")
    return (n < 10) | (100 * repeated > 20 * n)


Rule = tuple[tuple[int, str, float], ...]


def _covers(rule: Rule, row: tuple) -> bool:
    return all(row[i] <= cut if op == "<=" else row[i] > cut for i, op, cut in rule)


def _gain(good: int, bad: int, good0: int, bad0: int) -> float:
    """Information gained on the covered bad rows when a rule narrows from (good0, bad0)."""
    if not bad:
        return -1.0
    return bad * (log2(bad / (bad + good)) - log2(bad0 / (bad0 + good0)))


def _best_condition(rows: list[tuple], bins: int) -> tuple[float, tuple[int, str, float]] | None:
    """Scan each statistic once in order; cuts lie at up to ``bins`` quantiles."""
    bad0 = sum(r[-1] for r in rows)
    good0, best = len(rows) - bad0, None
    for i in range(len(RATIOS)):
        order = sorted((r[i], r[-1]) for r in rows)
        step, bad, good, due = max(1, len(order) // bins), 0, 0, 0
        for k in range(len(order) - 1):
            bad, good = bad + order[k][1], good + 1 - order[k][1]
            if order[k][0] == order[k + 1][0] or k < due:
                continue
            due, cut = k + step, order[k][0]
            for op, g, b in (("<=", good, bad), (">", good0 - good, bad0 - bad)):
                found = (_gain(g, b, good0, bad0), (i, op, cut))
                if best is None or found > best:
                    best = found
    return best


def learn_rules(
    rows: list[tuple], max_rules: int = 12, max_conditions: int = 4, precision: float = 0.97, bins: int = 200
) -> list[Rule]:
    """Ordered rules for rows (statistics..., 1 for bad) in a fixed, random order."""
    grow, prune, rules = [r for i, r in enumerate(rows) if i % 3], rows[::3], []
    while len(rules) < max_rules and any(r[-1] for r in grow):
        rule, inside = (), grow
        while len(rule) < max_conditions and any(not r[-1] for r in inside):
            found = _best_condition(inside, bins)
            if found is None or found[0] <= 1e-9:
                break
            rule, inside = (*rule, found[1]), [r for r in inside if _covers((found[1],), r)]

        def worth(r: Rule) -> float:
            hit = [x[-1] for x in prune if _covers(r, x)]
            return (2 * sum(hit) - len(hit)) / len(hit) if hit else -1.0

        while len(rule) > 1:                # drop final conditions that do not pay
            shorter = max((rule[:k] for k in range(1, len(rule))), key=worth)
            if worth(shorter) < worth(rule):
                break
            rule = shorter
        seen = [r[-1] for r in rows if _covers(rule, r)] if rule else []
        if len(seen) < 5 or sum(seen) < precision * len(seen):
            break
        rules.append(rule)
        grow, prune = ([r for r in part if not _covers(rule, r)] for part in (grow, prune))
        rows = [r for r in rows if not _covers(rule, r)]
    return rules


def rules_column(rules: list[Rule]) -> Column:
    """True where the text is kept: the first rule that covers it rejects it."""
    values, case = ratios(), None
    for rule in rules:
        test = None
        for i, op, cut in rule:
            one = values[RATIOS[i]] <= cut if op == "<=" else values[RATIOS[i]] > cut
            test = one if test is None else test & one
        case = F.when(test, F.lit(False)) if case is None else case.when(test, F.lit(False))
    return F.lit(True) if case is None else case.otherwise(F.lit(True))


def labelled_rows(docs: DataFrame, labels: DataFrame, max_labelled: int = 8000) -> list[tuple]:
    """The bounded learning set: (statistics..., 1 for quality 0), in order of hash."""
    chosen = (
        labels.where("doc_id is not null and quality is not null")
        .groupBy(F.col("doc_id").cast("long").alias("__id")).agg(F.max("quality").alias("__q"))
        .orderBy(F.xxhash64("__id"), "__id").limit(max_labelled)
    )
    texts = stored(docs.select("doc_id", "text").join(F.broadcast(chosen), F.col("doc_id").cast("long") == F.col("__id")).select("__id", "__q", "text"), "labelled")
    numbers = with_statistics(texts).where(~base_failed()).select(
        F.xxhash64("__id").alias("h"), "__id", *(c.alias(n) for n, c in ratios().items()),
        F.when(F.col("__q") == 0, 1).otherwise(0).alias("bad"),
    )
    return [tuple(r)[2:] for r in sorted(numbers.collect(), key=tuple)]


def apply_rules(docs: DataFrame, labels: DataFrame, max_labelled: int = 8000) -> DataFrame:
    """``docs`` with the statistics struct ``__s``, ``base_failed`` and ``kept``."""
    rules = learn_rules(labelled_rows(docs, labels, max_labelled))
    return with_statistics(docs).withColumn("base_failed", base_failed()).withColumn(
        "kept", ~F.col("base_failed") & rules_column(rules)
    )
