"""Quality rules: measures against brute force, order from a sample, evaluation cut short."""

import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tidemark.llm import cascade
from tidemark.llm.common import prepare
from tidemark.llm.queries import QUERIES

PATH = "/root/testdata/sf0.001"
CLEAN = " ".join(f"word{chr(97 + i % 26)}{chr(97 + i // 26)} of" for i in range(40))
TEXTS = [
    CLEAN, CLEAN, None, "", " \t\n\x0b\f\r", "two words", "#tag $x 50% a|b <i>" + CLEAN, "x" * 200_000, " " * 100_000 + "é",
    "one line here\nanother line\none line here\n \n \none line here\n" + CLEAN, "a b c d e " * 300, "a a a a a a a a a a a a",
    "Ünïcode wörds " * 7, CLEAN.upper(), CLEAN + "\n" + CLEAN, "1 2 3 4 5 6 7 8 9 10 11 12 13", "!" * 30 + CLEAN,
    " not a gap here nor there " + CLEAN, "w " * 50_000 + "end",
]


def _brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    often = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if often[w] > 1 for k in range(5)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    n = len(words)
    failed = n < 10 or 100 * len(covered) > 20 * n
    return n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered), failed


@pytest.fixture(scope="module")
def docs(spark):
    prepare(spark)
    rows = [(None if i == 1 else i, t, 1, "w", 2, "t", True) for i, t in enumerate(TEXTS)]
    # columns named like those the operator makes
    return spark.createDataFrame(rows, "doc_id long, text string, id int, words string, n_words int, rejected_by string, kept boolean")


def test_measures_equal_brute_force(docs):
    got = cascade.judge(docs).collect()
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    expected = sorted((-1 if i == 1 else i, *_brute(t)) for i, t in enumerate(TEXTS))
    assert sorted((-1 if r.doc_id is None else r.doc_id, *(r[n] for n in names)) for r in got) == expected
    assert all(r.kept == (not r.base_failed and r.rejected_by is None) for r in got)


def test_verdicts(docs):
    kept = {r.doc_id: r.kept for r in cascade.judge(docs).collect()}
    assert kept[0] and kept[None]  # clean, and its copy
    assert not any(kept[i] for i in (2, 3, 4, 5, 7, 8, 10, 11, 13, 14, 15, 16, 18))


def test_given_tables_keep_good_documents(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{n}.parquet") for n in ("documents", "labels"))
    rows = cascade.judge(docs).join(labels, "doc_id").where("NOT base_failed").groupBy("quality").agg(
        F.avg(F.col("kept").cast("int")).alias("kept")).collect()
    share = {r.quality: r.kept for r in rows}
    assert share[1] == 1.0 and share[0] < 0.05


def test_rules_that_reject_much_for_little_come_first(spark, docs):
    dear = F.col("text")
    for _ in range(60):
        dear = F.sha2(dear, 512)
    rules = [
        cascade.Rule("never", F.lit(False)), cascade.Rule("dear", dear < "8"), cascade.Rule("cheap", F.col("n_words") > -1),
    ]
    assert [r.name for r in cascade.ordered(docs, rules)][0] == "cheap"
    assert cascade.ordered(docs.limit(0), rules) == rules


def test_rejected_rows_are_spared_later_rules(docs):
    broken = cascade.Rule("broken", F.when(F.col("n_words") < 10, F.raise_error(F.lit("evaluated"))).otherwise(F.lit(False)))
    chain = [cascade.Rule("short", F.col("n_words") < 10), broken]
    rows = cascade.measures(docs).select(cascade.rejected_by(chain).alias("why")).collect()
    assert {r.why for r in rows} == {"short", None}


def test_order_does_not_change_the_verdict(docs):
    rules = cascade.quality_rules()
    measured = cascade.measures(docs)
    one, other = (measured.select(cascade.rejected_by(chain).isNull().alias("ok")).collect() for chain in (rules, rules[::-1]))
    assert one == other


def test_no_rows_and_no_rules(spark, docs):
    empty = cascade.judge(docs.limit(0))
    assert empty.count() == 0 and "kept" in empty.columns
    assert all(r.kept != r.base_failed for r in cascade.judge(docs, rules=[]).collect())


def test_plan_stays_in_the_jvm(spark):
    plan = QUERIES["op11_rule_cascade"](spark, PATH)._jdf.queryExecution().toString()
    assert not re.search("Python|Arrow|Pandas", plan)
