"""Validated change feeds and the quarantine of rejected rows."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.catalog import query, table
from tidemark.catalog.cleansing import AMOUNT_CTE, AMOUNT_COLUMNS
from tidemark.plans import mappings as m
from tidemark.plans.operational import Applied, feed_events
from tidemark.plans.staging import Warehouse, extract_spec, stage_rows
from tidemark.session import materialise, workspace
from tidemark.streaming.change_feed import KeyedTable, follow

NOW = datetime(2024, 1, 20)

# Every event is a change to the orders, read as duration events. Half of the
# updates and deletes name the right parent.
_FEED = """
feed AS (
  SELECT CASE event_type WHEN 'click' THEN 'I' WHEN 'purchase' THEN 'D' WHEN 'signup' THEN 'X' ELSE 'U' END AS op,
         e.event_id AS seq, CASE WHEN event_type = 'click' THEN e.event_id + 1000000000 ELSE e.event_id END AS id,
         CASE WHEN event_type = 'click' AND e.event_id % 4 = 0 THEN e.user_id + 1000000000
              WHEN event_type <> 'click' AND e.event_id % 2 = 0 THEN coalesce(o.o_custkey, e.user_id)
              ELSE e.user_id END AS baby_id,
         e.ts AS sleep_start, floor(e.value) - 20 AS sleep_duration, o.o_custkey AS owner
  FROM events e LEFT JOIN orders o ON o.o_orderkey = e.event_id),
judged AS (
  SELECT *, CASE WHEN op = 'X' THEN 'known_op' WHEN id <= 0 THEN 'positive_id'
                 WHEN baby_id <= 0 THEN 'positive_baby_id'
                 WHEN op <> 'D' AND sleep_start > TIMESTAMP '2024-01-20' THEN 'not_future'
                 WHEN op <> 'D' AND sleep_duration <= 0 THEN 'positive_sleep_duration'
                 WHEN op = 'I' AND baby_id NOT IN (SELECT c_custkey FROM customer) THEN 'parent_exists'
                 WHEN op <> 'I' AND owner <> baby_id THEN 'belongs_to_parent' END AS error_message
  FROM feed)"""


def _inputs(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Events before the feed, subjects and the feed."""
    orders = table(spark, path, "orders")
    durations = orders.select(
        F.col("o_orderkey").alias("id"), F.col("o_orderdate").cast("timestamp").alias("sleep_start"),
        (F.col("o_orderkey") % 600 + 1).alias("sleep_duration"), F.col("o_custkey").alias("baby_id"),
    )
    insert, even = F.col("event_type") == "click", F.col("event_id") % 2 == 0
    owners = orders.select(F.col("o_orderkey").alias("event_id"), "o_custkey")
    changes = table(spark, path, "events").join(owners, "event_id", "left").select(
        F.expr("CASE event_type WHEN 'click' THEN 'I' WHEN 'purchase' THEN 'D' WHEN 'signup' THEN 'X' ELSE 'U' END")
        .alias("op"),
        F.col("event_id").alias("seq"),
        F.when(insert, F.col("event_id") + 1_000_000_000).otherwise(F.col("event_id")).alias("id"),
        F.when(insert & (F.col("event_id") % 4 == 0), F.col("user_id") + 1_000_000_000)
        .when(~insert & even, F.coalesce("o_custkey", "user_id"))
        .otherwise(F.col("user_id")).alias("baby_id"),
        F.col("ts").cast("timestamp").alias("sleep_start"),
        (F.floor("value") - 20).alias("sleep_duration"),
    )
    subjects = table(spark, path, "customer").select(F.col("c_custkey").alias("id"))
    return durations, subjects, changes


def _feed(spark: SparkSession, path: str) -> Applied:
    return feed_events(*_inputs(spark, path), "sleep_start", "sleep_duration", NOW)


_AFTER_FEED = f"""
WITH {_FEED}, good AS (SELECT * FROM judged WHERE error_message IS NULL)
SELECT o_orderkey AS id, coalesce(g.sleep_start, o_orderdate) AS sleep_start,
       CAST(coalesce(g.sleep_duration, o_orderkey % 600 + 1) AS BIGINT) AS sleep_duration, o_custkey AS baby_id
FROM orders LEFT JOIN good g ON g.id = o_orderkey WHERE g.op IS DISTINCT FROM 'D'
UNION ALL
SELECT id, sleep_start, CAST(sleep_duration AS BIGINT), baby_id FROM good WHERE op = 'I'"""


@query(_AFTER_FEED)
def event_feed(spark: SparkSession, path: str) -> DataFrame:
    """The events after a feed whose changes passed the rules."""
    return _feed(spark, path).table.withColumn("sleep_start", F.col("sleep_start").cast("timestamp_ntz"))


@query(f"WITH {_FEED} SELECT seq, op, error_message FROM judged WHERE error_message IS NOT NULL")
def event_feed_rejected(spark: SparkSession, path: str) -> DataFrame:
    """The changes that did not, with the first rule each failed."""
    return _feed(spark, path).rejected.select("seq", "op", "error_message")


def _streamed(spark: SparkSession, path: str) -> KeyedTable:
    """The table after the feed has landed in three parts, with a new stream for each of them."""
    events, subjects, changes = _inputs(spark, path)
    root = workspace(spark, "feed")
    target = KeyedTable(Warehouse(spark, f"{root}/warehouse", NOW), "sleep_data", events.schema)
    target.create(events)
    changes = materialise(changes, "changes")
    first, second = changes.agg(F.percentile_approx("seq", [0.33, 0.66])).first()[0]
    part = F.when(F.col("seq") <= first, 0).when(F.col("seq") <= second, 1).otherwise(2)
    for n in range(3):
        changes.where(part == n).write.mode("append").parquet(f"{root}/landed")
        landed = spark.readStream.schema(changes.schema).parquet(f"{root}/landed")
        follow(
            target, landed, lambda rows, new: feed_events(rows, subjects, new, "sleep_start", "sleep_duration", NOW),
            f"{root}/checkpoint",
        )
    return target


@query(_AFTER_FEED)
def event_feed_stream(spark: SparkSession, path: str) -> DataFrame:
    """``event_feed`` as a stream that is stopped and started again."""
    return _streamed(spark, path).read().withColumn("sleep_start", F.col("sleep_start").cast("timestamp_ntz"))


@query(f"WITH {_FEED} SELECT seq, op, error_message FROM judged WHERE error_message IS NOT NULL")
def event_feed_stream_rejected(spark: SparkSession, path: str) -> DataFrame:
    """The changes that the stream turned away, from the quarantine."""
    change = F.from_json("raw", "seq BIGINT, op STRING").alias("change")
    return _streamed(spark, path).rejected().select(change, "error_message").select("change.*", "error_message")


@query(AMOUNT_CTE + """
SELECT 1 AS job_id, 'amount_file' AS rule, error_message, count(*) AS n_rows,
       count(DISTINCT event_id) AS n_raw
FROM named WHERE error_message IS NOT NULL GROUP BY error_message""")
def quarantine_sink(spark: SparkSession, path: str) -> DataFrame:
    """A batch staged with its rejected rows written as JSON lines, read back."""
    wh = Warehouse(spark, workspace(spark, "quarantine"), NOW)
    lines = table(spark, path, "events").select(
        *[F.expr(sql).alias(name) for name, sql in AMOUNT_COLUMNS.items()],
        F.col("event_id").alias("Line"),
    )
    spec = extract_spec("to_stg_formula", "csv", "events", "stg_formula", "initial")
    stage_rows(wh, spec, lines, m.AMOUNT_FILE, 1)
    schema = "ts STRING, job_id INT, rule STRING, error_message STRING, raw STRING"
    bad = spark.read.schema(schema).json(f"{wh.quarantine}/stg_formula/run=1")
    per_row = bad.groupBy("job_id", "rule", "error_message", "raw").agg(F.count(F.lit(1)).alias("n"))
    return per_row.groupBy("job_id", "rule", "error_message").agg(
        F.sum("n").alias("n_rows"), F.count(F.lit(1)).alias("n_raw")
    )
