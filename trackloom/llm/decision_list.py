"""Operator 8: quality rules as a learned decision list.

Statistics of every whole text come from DataFrame functions. From a bounded sample of labelled documents, sequential
covering grows one rule after the other: a conjunction of thresholds that separates bad from good documents, refined
condition by condition on one part of the sample (by the gain in information) and then cut back on the other part
(as long as precision there does not fall). A rule stays only if it is precise on the part held back; what it
covers leaves both parts. The list is emitted as ordered ``when`` expressions, so that applying it is a
projection: no shuffle, no join, no Python.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trackloom.llm.names import positional

#: Words, symbols, and the base rules' limits.
WORD = r"[^\x20\x09-\x0D]+"
SYMBOLS = r"[#*$%&|<>]"
LEAST_WORDS, REPEAT_PERCENT = 50, 50
#: Most labelled rows that the rules are learned from (taken by a hash of the id), and how careful the learning is.
SAMPLE_ROWS, MAX_RULES, MAX_CONDITIONS, CUTS = 8000, 12, 4, 24
LEAST_PRECISION, LEAST_COVER = 0.95, 5

#: What rules may look at, as shares of a text's words or characters so that its length alone condemns nothing.
FEATURES = {
    "symbols_per_word": "n_symbols / greatest(n_words, 1)",
    "dup_lines_per_line": "n_dup_lines / greatest(n_lines, 1)",
    "repeat_words_per_word": "n_repeat_words / greatest(n_words, 1)",
    "chars_per_word": "word_chars / greatest(n_words, 1)",
    "words_per_line": "n_words / greatest(n_lines, 1)",
}
STATISTICS = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")


@dataclass(frozen=True)
class Condition:
    """``feature > limit`` if ``above``, else ``feature <= limit``."""

    feature: str
    above: bool
    limit: float

    def holds(self, row: dict) -> bool:
        return (row[self.feature] > self.limit) == self.above

    def column(self) -> Column:
        value = F.expr(FEATURES[self.feature])
        return value > self.limit if self.above else value <= self.limit


Rule = tuple[Condition, ...]


def _covers(rule: Rule, row: dict) -> bool:
    return all(c.holds(row) for c in rule)


def _counts(rule: Rule, rows: list[dict]) -> tuple[int, int]:
    """(bad, good) rows that the rule covers."""
    got = [row["bad"] for row in rows if _covers(rule, row)]
    return sum(got), len(got) - sum(got)


def _limits(rows: list[dict], feature: str, cuts: int) -> list[float]:
    values = sorted({row[feature] for row in rows})
    middle = [(a + b) / 2 for a, b in zip(values, values[1:])]
    return middle if len(middle) <= cuts else [middle[len(middle) * i // cuts] for i in range(cuts)]


def _grow(rows: list[dict], max_conditions: int, cuts: int) -> Rule:
    """Adds the condition with the largest gain in information until only bad rows are left."""
    rule: Rule = ()
    while len(rule) < max_conditions:
        bad = sum(row["bad"] for row in rows)
        if not bad or bad == len(rows):
            break
        before, best, gain = math.log2(bad / len(rows)), None, 0.0
        for feature in FEATURES:
            for limit in _limits(rows, feature, cuts):
                over = [row["bad"] for row in rows if row[feature] > limit]
                for above, p, n in ((True, sum(over), len(over)), (False, bad - sum(over), len(rows) - len(over))):
                    if p and (now := p * (math.log2(p / n) - before)) > gain + 1e-12:
                        best, gain = Condition(feature, above, limit), now
        if best is None:
            break
        rule += (best,)
        rows = [row for row in rows if best.holds(row)]
    return rule


def _pruned(rule: Rule, rows: list[dict]) -> Rule:
    """The shortest beginning of the rule that is at least as precise on held-back rows as any longer one."""

    def worth(r: Rule) -> float:
        p, n = _counts(r, rows)
        return (p - n) / (p + n) if p + n else -1.0

    return max((rule[:k] for k in range(1, len(rule) + 1)), key=lambda r: (worth(r), -len(r)), default=())


def learn(
    rows: list[dict],
    max_rules: int = MAX_RULES,
    max_conditions: int = MAX_CONDITIONS,
    cuts: int = CUTS,
    least_precision: float = LEAST_PRECISION,
    least_cover: int = LEAST_COVER,
) -> list[Rule]:
    """Ordered rules that condemn a document; ``rows`` have the features and ``bad`` (0 or 1).

    Rows are dealt by their order: of three, two are for growing and one is held back. A rule must cover
    ``least_cover`` bad rows in all and be at least ``least_precision`` precise on either part.
    """
    grow, held = [r for i, r in enumerate(rows) if i % 3], rows[::3]
    rules: list[Rule] = []
    while len(rules) < max_rules:
        rule = _pruned(_grow(grow, max_conditions, cuts), held)
        if not rule:
            break
        (p, n), (hp, hn) = _counts(rule, grow), _counts(rule, held)
        if p + hp < least_cover or p < least_precision * (p + n) or not hp or hp < least_precision * (hp + hn):
            break
        rules.append(rule)
        grow, held = ([r for r in part if not _covers(rule, r)] for part in (grow, held))
    return rules


def verdict(rules: list[Rule]) -> Column:
    """The number of the first rule that holds (from 1), 0 if none does."""
    out = None
    for number, rule in enumerate(rules, 1):
        test = reduce(lambda a, b: a & b, (c.column() for c in rule))
        out = F.when(test, number) if out is None else out.when(test, number)
    return F.lit(0) if out is None else out.otherwise(0)


def text_statistics(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with ``n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words`` (longs).

    Lines are the parts between line feeds that hold a word. A word is repeated if it lies in a window of three words
    that is found twice or more in the text. A null text counts as empty: all zero. Columns of ``docs`` with one of
    these names in any case are replaced; all others stay, however they are named.
    """
    renamed, name = positional(docs)
    body = F.coalesce(F.col(name[text.lower()]), F.lit(""))
    words = F.regexp_extract_all(body, F.lit(WORD), F.lit(0))
    lines = F.filter(F.split(body, "\n"), lambda line: F.regexp_like(line, F.lit(WORD)))
    # hashes of the windows, each with the number of its first word; equal ones lie side by side once sorted
    windows = F.when(
        F.size("_words") >= 3,
        F.sort_array(
            F.transform(
                F.arrays_zip(
                    F.slice("_words", F.lit(1), F.size("_words") - 2).alias("a"),
                    F.slice("_words", F.lit(2), F.size("_words") - 2).alias("b"),
                    F.slice("_words", F.lit(3), F.size("_words") - 2).alias("c"),
                ),
                lambda w, i: F.struct(F.xxhash64(w["a"], w["b"], w["c"]).alias("h"), i.alias("i")),
            )
        ),
    )
    twice = F.sort_array(
        F.transform(
            F.filter(
                F.transform(
                    "_windows",
                    lambda w, k: F.struct(
                        w["i"].alias("i"),
                        (
                            F.get("_windows", k - 1)["h"].eqNullSafe(w["h"])
                            | F.get("_windows", k + 1)["h"].eqNullSafe(w["h"])
                        ).alias("again"),
                    ),
                ),
                lambda x: x["again"],
            ),
            lambda x: x["i"],
        )
    )
    covered = F.aggregate(
        "_twice",
        F.struct(F.lit(0).cast("long").alias("n"), F.lit(-3).alias("last")),
        lambda acc, i: F.struct(
            (acc["n"] + F.least(F.lit(3), i - acc["last"])).alias("n"), i.alias("last")
        ),
        lambda acc: acc["n"],
    )
    statistics = F.struct(
        F.size("_words").cast("long").alias("n_words"),
        F.length(F.array_join("_words", "")).cast("long").alias("word_chars"),
        F.regexp_count(body, F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
        F.size("_lines").cast("long").alias("n_lines"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words"),
    )
    made = (
        renamed.withColumn("_words", words)
        .withColumn("_lines", lines)
        .withColumn("_windows", windows)
        .withColumn("_twice", twice)
    )
    rest = [F.col(name[c.lower()]).alias(c) for c in docs.columns if c.lower() not in STATISTICS]
    # as a row of its own the struct is made once, however often filters and rules refer to its fields
    return made.select(*rest, F.inline(F.array(statistics)))


def labelled_sample(docs: DataFrame, labels: DataFrame, id_column: str, text: str, label: str, rows: int) -> list[dict]:
    """Features of at most ``rows`` labelled documents, in an order that depends on ids alone.

    A label other than 0 and 1 and a null id count as unlabelled; of repeated labels the lowest counts. The sample's
    ids (at most ``rows``) are broadcast.
    """
    place = F.xxhash64(F.lit("labelled"), F.col("_id"))
    taken = (
        labels.where(F.col(label).isin(0, 1))
        .groupBy(F.col(id_column).alias("_id"))
        .agg(F.min(F.col(label)).alias("_label"))
        .where(F.col("_id").isNotNull())
        .orderBy(place, "_id")
        .limit(rows)
    )
    found = (
        docs.select(F.col(id_column).alias("_id"), F.col(text).alias("_text"))
        .join(F.broadcast(taken), "_id")
        .groupBy("_id", "_label")
        .agg(F.min("_text").alias("_text"))
    )
    sample = (
        text_statistics(found, "_text")
        .select("_id", place.alias("place"), (1 - F.col("_label")).alias("bad"), *[F.expr(c).alias(f) for f, c in FEATURES.items()])
        .orderBy("place", "_id")
    )
    return [row.asDict() for row in sample.collect()]


def quality_verdicts(
    docs: DataFrame,
    labels: DataFrame,
    id_column: str = "doc_id",
    text: str = "text",
    label: str = "quality",
    sample_rows: int = SAMPLE_ROWS,
) -> DataFrame:
    """``docs`` with the statistics, ``base_failed``, ``rule`` (number of the rule that rejects, 0: none) and ``kept``.

    Without labels no rule is learned and the base decides alone. Null and empty texts fail the base (no words).
    Repeated rows are judged each. Columns of ``docs`` with one of the new names are replaced.
    """
    rules = learn(labelled_sample(docs, labels, id_column, text, label, sample_rows))
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words"))
    return (
        text_statistics(docs, text)
        .withColumn("base_failed", failed)
        .withColumn("rule", verdict(rules))
        .withColumn("kept", ~F.col("base_failed") & (F.col("rule") == 0))
    )
