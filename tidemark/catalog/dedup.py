"""One row per key in several orders."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from tidemark.catalog import query, table
from tidemark.operators.dedup import first_per_key
from tidemark.operators.scd2 import VersionedBy, earliest_per_attribute

# Batches of events by day; the time of a version is the time of its event.
BY_TYPE = VersionedBy("user_id", "event_type", "ts", ("job_id", "ts", "event_id"))


def batches(spark: SparkSession, path: str) -> DataFrame:
    return table(spark, path, "events").select(
        "event_id", "user_id", "event_type", "ts", "value", F.dayofmonth("ts").alias("job_id")
    )


@query("""
SELECT user_id, hour, event_id, value FROM (
  SELECT user_id, date_trunc('hour', ts) AS hour, event_id, value, row_number() OVER (
    PARTITION BY user_id, date_trunc('hour', ts) ORDER BY ts DESC, event_id DESC) AS rn FROM events)
WHERE rn = 1""")
def latest_per_key(spark: SparkSession, path: str) -> DataFrame:
    """The last load of an event that was delivered several times."""
    events = table(spark, path, "events").select(
        "user_id", F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("hour"), "event_id",
        "value", "ts",
    )
    latest = first_per_key(events, ["user_id", "hour"], [F.col("ts").desc(), F.col("event_id").desc()])
    return latest.drop("ts")


@query("""
SELECT user_id, event_type, event_id FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events)
WHERE rn = 1""")
def latest_snapshot(spark: SparkSession, path: str) -> DataFrame:
    """The newest row of every subject."""
    order = [F.col("ts").desc(), F.col("event_id").desc()]
    return first_per_key(
        table(spark, path, "events").select("user_id", "event_type", "event_id", "ts"), ["user_id"], order
    ).drop("ts")


@query("""
SELECT user_id, event_type, event_id, job_id FROM (
  SELECT *, CAST(day(ts) AS INTEGER) AS job_id, row_number() OVER (
    PARTITION BY user_id, event_type ORDER BY day(ts), ts, event_id) AS rn FROM events)
WHERE rn = 1""")
def earliest_per_key_attr(spark: SparkSession, path: str) -> DataFrame:
    """First sight of every (subject, attribute value)."""
    rows = earliest_per_attribute(batches(spark, path), BY_TYPE)
    return rows.select("user_id", "event_type", "event_id", "job_id")


@query("""
SELECT event_type AS status, event_id, ts FROM (
  SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY ts DESC, event_id DESC) AS rn FROM events)
WHERE rn = 1""")
def latest_per_status(spark: SparkSession, path: str) -> DataFrame:
    events = table(spark, path, "events").select(F.col("event_type").alias("status"), "event_id", "ts")
    return first_per_key(events, ["status"], [F.col("ts").desc(), F.col("event_id").desc()])


@query("SELECT DISTINCT event_type AS status FROM events WHERE event_type IS NOT NULL")
def distinct_status(spark: SparkSession, path: str) -> DataFrame:
    events = table(spark, path, "events").select(F.col("event_type").alias("status"))
    return events.where("status IS NOT NULL").distinct()


@query("""
WITH first AS (
  SELECT user_id, event_type, CAST(day(ts) AS INTEGER) AS job_id, ts, row_number() OVER (
    PARTITION BY user_id, event_type ORDER BY day(ts), ts, event_id) AS rn FROM events)
SELECT user_id, event_type, job_id,
       row_number() OVER (PARTITION BY user_id ORDER BY job_id DESC, ts DESC) = 1 AS is_last
FROM first WHERE rn = 1""")
def last_version_flag(spark: SparkSession, path: str) -> DataFrame:
    """Marks the last version each subject has in a batch.

    The window runs over one row per attribute value, not over the events.
    """
    rows = earliest_per_attribute(batches(spark, path), BY_TYPE)
    newest = Window.partitionBy("user_id").orderBy(F.col("job_id").desc(), F.col("ts").desc())
    return rows.select(
        "user_id", "event_type", "job_id", (F.row_number().over(newest) == 1).alias("is_last")
    )
