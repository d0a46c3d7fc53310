"""Key filters before the exact join, and reads in ranges of equal depth."""

from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F
from test_layout import scanned_rows

from tidemark.operators.insert_absent import absent_rows
from tidemark.operators.key_filter import KeyFilter, absent_by_filter
from tidemark.plans.facts import DURATIONS, load_fact, load_new_facts
from tidemark.plans.staging import Warehouse, keys_of, stage_durations, stage_new_durations
from tidemark.schemas import CORE, SLEEP_DATA
from tidemark.sinks.tables import Tables
from tidemark.sources.ranges import range_predicates

BY = KeyFilter(("a", "b"), blocks=8)
ORDER = ["a", "b"]


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    """30,000 rows, 1,000 for each of 30 runs in three months; run 30 has no filter."""
    tables = Tables(spark, str(tmp_path_factory.mktemp("filters")))
    rows = spark.range(30_000).selectExpr(
        "id AS a", "CAST(id % 7 AS STRING) AS b", "CAST(202401 + id % 3 AS INT) AS month_sk", "CAST(id DIV 1000 + 1 AS INT) AS job_id"
    )
    tables.replace("t", rows, ["month_sk", "job_id"])
    tables.replace("k", BY.build(rows.where("job_id < 30")), ["month_sk", "job_id"])
    return tables, tables.read("t", rows.schema), rows


def _batch(spark, condition, count=2000):
    fresh = spark.range(100_000, 100_000 + count).selectExpr("id AS a", "'x' AS b", "CAST(202401 + id % 3 AS INT) AS month_sk")
    known = spark.range(30_000).where(condition).selectExpr("id AS a", "CAST(id % 7 AS STRING) AS b", "CAST(202401 + id % 3 AS INT) AS month_sk")
    odd = spark.createDataFrame([(None, "x", 202401), (5, None, 202402), (7, "y", None)], "a long, b string, month_sk int")
    return fresh.unionByName(known).unionByName(known).unionByName(odd)


@pytest.mark.parametrize("condition", ["false", "id BETWEEN 500 AND 700", "id % 50 = 0", "true", "id > 29500"])
def test_rows_are_those_of_the_plain_join(spark, stored, condition):
    tables, target, _ = stored
    batch = _batch(spark, condition)
    order = [F.col(c) for c in ORDER]
    ours = absent_by_filter(batch, target, tables.partitions("t", "month_sk", "job_id"), tables.read("k", BY.schema), BY, order)
    plain = absent_rows(batch, target, list(BY.key), order)
    assert ours.exceptAll(plain).isEmpty() and plain.exceptAll(ours).isEmpty() and ours.count() == 2003


def test_no_key_is_missed_and_few_are_found_wrongly(spark, stored):
    tables, _, rows = stored
    filters = tables.read("k", BY.schema)
    held = BY.runs_that_may_hold(rows.where("job_id < 30"), filters, "runs")
    assert held.where(~F.array_contains("runs", F.col("job_id"))).isEmpty()
    strangers = BY.runs_that_may_hold(_batch(spark, "false", 9000).where("b = 'x'"), filters, "runs")
    assert strangers.agg(F.sum(F.size("runs"))).first()[0] < 0.01 * 9000 * 29
    # a column of the rows may have a name of the filter's
    assert BY.runs_that_may_hold(rows.withColumn("bits", F.lit(1)).withColumn("block", F.lit(2)), filters, "runs").count() == 30_000


def test_partitions_without_keys_of_the_batch_are_not_read(spark, stored):
    tables, target, _ = stored
    parts, order = tables.partitions("t", "month_sk", "job_id"), [F.col(c) for c in ORDER]
    assert len(parts) == 90
    batch = _batch(spark, "id BETWEEN 500 AND 700", 20)
    plain = scanned_rows(spark, absent_rows(batch, target, list(BY.key), order))
    ours = scanned_rows(spark, absent_by_filter(batch, target, parts, tables.read("k", BY.schema), BY, order))
    assert plain >= 30_000 and ours < 30_000 / 5  # run 1, run 30, and the few rows of the batch itself


def test_filters_of_another_shape_are_not_trusted(spark, stored):
    tables, target, _ = stored
    order, other = [F.col(c) for c in ORDER], KeyFilter(BY.key, blocks=16)
    ours = absent_by_filter(_batch(spark, "id % 50 = 0"), target, tables.partitions("t", "month_sk", "job_id"), tables.read("k", BY.schema), other, order)
    assert ours.count() == 2003


def test_fact_loads_with_filters_equal_those_without(spark, tmp_path):
    first = [(i, datetime(2024, 1 + i % 3, 1 + i % 28, i % 24, 0, tzinfo=timezone.utc), 30, 1 + i % 5) for i in range(200)]
    # one comes in the minute of the last event, whose key is taken
    second = [(1000, max(row[1] for row in first) + timedelta(seconds=30), 8, 1)]
    second += [(i, datetime(2024, 4, 2, i % 24, i % 60, tzinfo=timezone.utc), 9, 1) for i in range(5000, 5050)]
    found = {}
    for blocks in (0, 4):
        wh = Warehouse(spark, str(tmp_path / f"wh{blocks}"), datetime(2024, 6, 1, tzinfo=timezone.utc), key_blocks=blocks)
        stage_durations(wh, "d", datetime(2024, 5, 1, tzinfo=timezone.utc), spark.createDataFrame(first, SLEEP_DATA))
        load_fact(wh, "d", datetime(2024, 5, 1, tzinfo=timezone.utc), DURATIONS)
        when = datetime(2024, 5, 2, tzinfo=timezone.utc)
        stage_new_durations(wh, "i", when, spark.createDataFrame([*first, *second], SLEEP_DATA))
        done = load_new_facts(wh, "i", when, DURATIONS)
        rows = wh.tables.read("fact_sleep")
        found[blocks] = (done.inserted, done.collided, sorted(map(tuple, rows.select(*CORE["fact_sleep"].fieldNames()).collect())))
        if blocks:
            kept = wh.tables.read(keys_of("fact_sleep"), KeyFilter(("x",), 4).schema).select("month_sk", "job_id").distinct().count()
            assert kept == rows.select("month_sk", "job_id").distinct().count()
    assert found[0] == found[4] and found[0][:2] == (50, 1)


@pytest.mark.parametrize("parts", [1, 2, 7, 16])
def test_ranges_of_a_skewed_column_hold_equally_many_rows(spark, parts):
    """A third of the rows has one value, the others grow thin exponentially."""
    rows = spark.range(60_000).select(
        F.when(F.col("id") % 3 == 0, 50).otherwise(F.floor(-10_000 * F.log((F.pmod(F.xxhash64("id"), F.lit(1_000_000)) + 1) / 1_000_001))).cast("int").alias("k"),
        F.timestamp_seconds(F.pmod(F.xxhash64("id", F.lit(1)), F.lit(1_700_000_000))).alias("t"),
    )
    odd = spark.createDataFrame([(None, None), (None, datetime(2024, 1, 1)), (50, None)], "k int, t timestamp")
    whole = rows.unionByName(odd)
    found = range_predicates(whole, "k", parts, then="t")
    sizes = whole.agg(*[F.count_if(F.expr(p)).alias(f"n{i}") for i, p in enumerate(found)]).first()
    met = sum((F.coalesce(F.expr(p), F.lit(False)).cast("int") for p in found), F.lit(0))
    assert whole.where(met != 1).isEmpty() and sizes[-1] == 2
    assert max(sizes) <= 2 * 60_000 / parts
    by_day = range_predicates(whole.withColumn("t", F.to_date("t")), "t", parts)
    sizes = whole.withColumn("t", F.to_date("t")).agg(*[F.count_if(F.expr(p)).alias(f"n{i}") for i, p in enumerate(by_day)]).first()
    assert sum(sizes) == 60_003 and max(sizes) < 2 * min(sizes[:-1])


def test_ranges_of_odd_tables(spark):
    none = spark.createDataFrame([], "k int, t timestamp")
    assert range_predicates(none, "k", 4) == ["k IS NULL"]
    same = spark.range(100).select(F.lit(3).alias("k"), F.lit(None).cast("timestamp").alias("t"))
    for found in (range_predicates(same, "k", 4), range_predicates(same, "k", 4, then="t")):
        assert sum(same.where(p).count() for p in found) == 100
    with pytest.raises(ValueError):
        range_predicates(none.withColumn("s", F.lit("x")), "s", 4)
