"""Quality rules as a short-circuit cascade, ordered by what a sample says about each rule.

Built from column expressions alone; nothing here leaves the JVM.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import materialise

SPACE = r"[\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"
WINDOW = 5
"""Words of the windows whose repeats are counted."""
SAMPLE = 2000
"""Rows that cost and selectivity of the rules are estimated on, about. They decide the order only."""


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once a row, however often ``use`` names it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def words(text: Column) -> Column:
    """The words of a text, a null text having none."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPACE), lambda w: w != "")


def word_chars(text: Column) -> Column:
    return F.char_length(F.regexp_replace(F.coalesce(text, F.lit("")), SPACE, "")).cast("long")


def n_symbols(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(f"[{SYMBOLS}]")).cast("long")


def n_dup_lines(text: Column) -> Column:
    """Lines with a word that are equal to a line before them."""
    lines = F.filter(F.split(F.coalesce(text, F.lit("")), "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    return let(lines, lambda x: (F.size(x) - F.size(F.array_distinct(x))).cast("long"))


def n_repeat_words(words: Column) -> Column:
    """Words that lie in a window of five words which stands in the text twice or more.

    Hashes of all windows show first whether any two are equal; most texts end
    there. Else windows are sorted by hash, words and place, equal neighbours
    give the places of repeated windows, and what those cover is summed in
    order of place. Equality is that of the words, not of the hashes, and the
    time is that of a sort.
    """

    def windows(hashes: Column) -> Column:
        starts = F.sequence(F.lit(0), F.size(hashes) - WINDOW)
        return F.transform(starts, lambda i: F.xxhash64(*[F.get(hashes, i + k) for k in range(WINDOW)]))

    def covered(words: Column, keys: Column) -> Column:
        def placed(key: Column, i: Column) -> Column:
            said = F.concat_ws(" ", *[F.get(words, i + k) for k in range(WINDOW)])
            return F.struct(key.alias("key"), said.alias("said"), i.alias("i"))

        def repeated(order: Column) -> Column:
            def like(a: Column, j: Column) -> Column:
                b = F.get(order, j)
                return F.coalesce((a["key"] == b["key"]) & (a["said"] == b["said"]), F.lit(False))

            # get() gives null before the first and after the last
            return F.filter(order, lambda a, j: like(a, j - 1) | like(a, j + 1))

        places = let(F.sort_array(F.transform(keys, placed)), lambda order: F.transform(repeated(order), lambda a: a["i"]))
        start = F.struct(F.lit(-WINDOW).alias("last"), F.lit(0).alias("sum"))
        return F.aggregate(
            F.sort_array(places), start,
            lambda at, i: F.struct(i.alias("last"), (at["sum"] + F.least(i - at["last"], F.lit(WINDOW))).alias("sum")),
            lambda at: at["sum"].cast("long"),
        )

    def of(words: Column) -> Column:
        def counted(keys: Column) -> Column:
            distinct = F.size(F.array_distinct(keys)) == F.size(keys)
            return F.when(distinct, F.lit(0).cast("long")).otherwise(covered(words, keys))

        return let(F.transform(words, lambda w: F.xxhash64(w)), lambda hashes: let(windows(hashes), counted))

    return F.when(F.size(words) <= WINDOW, F.lit(0).cast("long")).otherwise(let(words, of))


@dataclass(frozen=True)
class Rule:
    """``rejects``: whether a row fails, over the columns ``text``, ``words`` and the measures; null counts as no."""

    name: str
    rejects: Column


def measures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, text, words`` and the measures that every row gets."""
    given = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    text, split = F.col("text"), F.col("words")
    return given.withColumn("words", words(text)).select(
        "*", F.size(split).cast("long").alias("n_words"), word_chars(text).alias("word_chars"),
        n_symbols(text).alias("n_symbols"), n_dup_lines(text).alias("n_dup_lines"),
        n_repeat_words(split).alias("n_repeat_words"),
    )


def base_failed() -> Column:
    return (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))


def quality_rules() -> list[Rule]:
    """What text of any language that was written to be read does not do."""
    text, words, n = F.col("text"), F.col("words"), F.col("n_words")
    letters, capitals = F.regexp_count("text", F.lit(r"\p{L}")), F.regexp_count("text", F.lit(r"\p{Lu}"))
    stutter = F.size(F.filter(words, lambda w, i: F.coalesce(w == F.get(words, i - 1), F.lit(False))))
    wordlike = F.size(F.filter(words, lambda w: w.rlike(r"\p{L}")))
    return [
        Rule("too_few_words", n < 10),
        Rule("repeats", 100 * F.col("n_repeat_words") > 20 * n),
        Rule("symbols", 10 * F.col("n_symbols") > n),
        Rule("word_length", (F.col("word_chars") < 2 * n) | (F.col("word_chars") > 20 * n)),
        Rule("repeated_lines", 100 * F.col("n_dup_lines") > 50 * F.size(F.split(text, "\n"))),
        Rule("capitals", 2 * capitals > letters),
        Rule("stutter", 5 * stutter > n),
        Rule("no_letters", 2 * wordlike < n),
        Rule("exclamations", 5 * F.regexp_count("text", F.lit("!")) > n),
        Rule("braces", 20 * F.regexp_count("text", F.lit(r"[{}\[\]\\]")) > n),
    ]


def ordered(
    docs: DataFrame, rules: Sequence[Rule], id_col: str = "doc_id", text_col: str = "text", sample: int = SAMPLE
) -> list[Rule]:
    """The rules by rejected rows of a sample per second, the most first.

    A random share of about ``sample`` rows is measured and written once; each
    rule then runs over it by itself, and its cost is the time beyond that of
    a run without a rule. Ties and an empty sample keep the given order.
    """
    total = docs.count()
    if total == 0 or not rules:
        return list(rules)
    drawn = materialise(measures(docs.sample(min(1.0, sample / total), seed=7), id_col, text_col), "rule-sample")

    def timed(column: Column) -> tuple[int, float]:
        start = time.perf_counter()
        found = drawn.agg(F.count_if(column), F.sum(F.length("text")), F.sum(F.size("words"))).first()[0]
        return found, time.perf_counter() - start

    timed(F.lit(False))
    idle = min(timed(F.lit(False))[1] for _ in range(2))
    rate = {}
    for rule in rules:
        found, took = timed(rule.rejects)
        rate[rule.name] = found / max(took - idle, 1e-4)
    return sorted(rules, key=lambda rule: -rate[rule.name])


def rejected_by(rules: Sequence[Rule]) -> Column:
    """Name of the first rule that rejects a row; those after it aren't evaluated. Null where none does."""
    verdict = F.lit(None).cast("string")
    for rule in reversed(rules):
        verdict = F.when(rule.rejects, F.lit(rule.name)).otherwise(verdict)
    return verdict


def judge(
    docs: DataFrame, rules: Sequence[Rule] | None = None, id_col: str = "doc_id", text_col: str = "text", sample: int = SAMPLE
) -> DataFrame:
    """``id_col``, the measures, ``base_failed``, ``kept`` and ``rejected_by`` for every row of ``docs``.

    A row is kept where no rule rejects it. Rules are tried one after the
    other, and a row that is rejected is spared the rest; the order comes from
    a sample, so it changes the time and which of several reasons
    ``rejected_by`` names, never ``kept``.

    Null and empty texts have no words, measures of 0, and are rejected.
    Repeated rows are judged alike; null ids stay. Other columns aren't read,
    so their names don't matter; an empty table gives no rows. Texts are taken
    whole: a row needs memory in proportion to its text, nothing is shuffled.
    """
    chain = ordered(docs, quality_rules() if rules is None else rules, id_col, text_col, sample)
    judged = measures(docs, id_col, text_col).withColumns({"base_failed": base_failed(), "rejected_by": rejected_by(chain)})
    return judged.select(
        F.col("id").alias(id_col), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        (~F.col("base_failed") & F.col("rejected_by").isNull()).alias("kept"), "rejected_by",
    )
