"""Rules, orphans and ownership."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.catalog import query, table
from tidemark.catalog.cleansing import SEGMENT_ZONE
from tidemark.functions.keys import instant
from tidemark.operators import rules as r

NOW = datetime(2024, 1, 20)


@query("""
WITH j AS (
  SELECT event_id,
    CASE WHEN event_type NOT IN ('click', 'view') THEN 'valid_status' END AS a,
    CASE WHEN ts > TIMESTAMP '2024-01-20' THEN 'not_future' END AS b,
    CASE WHEN value <= 5 THEN 'positive_duration' END AS c,
    CASE WHEN user_id = 0 THEN 'positive_user_id' END AS d
  FROM events)
SELECT event_id, concat_ws(',', a, b, c, d) AS failed, coalesce(a, b, c, d) AS first_failed FROM j""")
def rule_violations(spark: SparkSession, path: str) -> DataFrame:
    """Every failed rule of every event, and the first of them."""
    events = table(spark, path, "events").select(
        "event_id", "user_id", F.col("ts").cast("timestamp").alias("ts"),
        (F.col("value") - 5).alias("duration"),
        F.expr("CASE event_type WHEN 'click' THEN ' Wet' WHEN 'view' THEN 'DIRTY ' ELSE event_type END").alias(
            "status"
        ),
    )
    rules = [
        r.valid_status("status"), r.not_future("ts", instant(NOW)), r.positive("duration"),
        r.positive("user_id"),
    ]
    return events.select(
        "event_id", F.concat_ws(",", r.failed_rules(rules)).alias("failed"),
        r.first_failure(rules).alias("first_failed"),
    )


@query(f"""
SELECT c_custkey, CASE WHEN {SEGMENT_ZONE} = 'Mars/Olympus' THEN 'known_zone'
       WHEN c_acctbal < 0 THEN 'name_length' WHEN c_acctbal > 9000 THEN 'name_length'
       WHEN c_nationkey = 3 THEN 'required_name' END AS problem
FROM customer""")
def subject_rules(spark: SparkSession, path: str) -> DataFrame:
    """Names of 3 to 50 characters, zones of the tz database, required fields."""
    name = (
        F.when(F.col("c_acctbal") < 0, F.lit(" ab "))
        .when(F.col("c_acctbal") > 9000, F.repeat(F.lit("x"), 51))
        .when(F.col("c_nationkey") != 3, F.col("c_name"))
    )
    subjects = table(spark, path, "customer").select(
        "c_custkey", name.alias("name"), F.expr(SEGMENT_ZONE).alias("timezone"),
    )
    given = [
        r.Rule("name_length", F.col("name").isNull() | r.name_length("name").passes),
        *r.required("name"),
    ]
    return subjects.select(
        "c_custkey", r.first_failure([r.known_zone("timezone"), *given]).alias("problem")
    )


@query("SELECT event_id, user_id FROM events WHERE user_id NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal >= 0)")
def fk_orphans(spark: SparkSession, path: str) -> DataFrame:
    """Events whose subject is not an active customer."""
    events = table(spark, path, "events").select("event_id", "user_id")
    active = table(spark, path, "customer").where("c_acctbal >= 0")
    return r.orphans(events, active, "user_id", "c_custkey").select("event_id", "user_id")


@query("SELECT event_id, user_id FROM events WHERE user_id IN (SELECT c_custkey FROM customer WHERE c_acctbal >= 0)")
def fk_valid(spark: SparkSession, path: str) -> DataFrame:
    events = table(spark, path, "events").select("event_id", "user_id")
    active = table(spark, path, "customer").where("c_acctbal >= 0")
    return r.with_parents(events, active, "user_id", "c_custkey").select("event_id", "user_id")


@query("""
WITH q AS (SELECT event_id AS request_id, event_id * 2 AS o_orderkey, user_id AS o_custkey FROM events
           UNION ALL SELECT o_orderkey + 1000000000, o_orderkey, o_custkey FROM orders)
SELECT q.request_id, CASE WHEN o.o_orderkey IS NULL THEN 'not_found' WHEN o.o_custkey = q.o_custkey THEN 'ok'
       ELSE 'foreign_parent' END AS ownership
FROM q LEFT JOIN orders o ON o.o_orderkey = q.o_orderkey""")
def ownership_check(spark: SparkSession, path: str) -> DataFrame:
    """Requests naming a child and its parent: ok, foreign parent or not found."""
    orders = table(spark, path, "orders").select("o_orderkey", "o_custkey")
    guesses = table(spark, path, "events").select(
        F.col("event_id").alias("request_id"), (F.col("event_id") * 2).alias("o_orderkey"),
        F.col("user_id").alias("o_custkey"),
    )
    true_ones = orders.select(
        (F.col("o_orderkey") + 1_000_000_000).alias("request_id"), "o_orderkey", "o_custkey"
    )
    judged = r.ownership(guesses.unionByName(true_ones), orders, "o_orderkey", "o_custkey", "request_id")
    return judged.select("request_id", "ownership")
