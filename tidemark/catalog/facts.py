"""Joins of events to dimension versions, and fact loads."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.catalog import query, table
from tidemark.catalog.dimensions import HISTORY_SQL, history
from tidemark.functions.keys import month_key
from tidemark.operators.insert_absent import absent_rows
from tidemark.operators.key_filter import absent_by_filter
from tidemark.operators.lookup import interval_join, resolve_member
from tidemark.operators.scd2 import UNKNOWN_KEY
from tidemark.session import workspace
from tidemark.sinks.tables import Tables
from tidemark.plans.facts import (
    Fact,
    key_filter,
    keyed_events,
    survivors_first,
    with_current_subject,
    with_subject_at,
)

EVENTS = Fact("fact_event", "stg_event", "load_event", "event_time", "value", "date_sk", "time_sk", "value")
STATUS_EVENTS = Fact(
    "fact_status", "stg_event", "load_status", "event_time", "status", "date_sk", "time_sk", "status",
    missing="UNKNOWN",
)


def staged_events(spark: SparkSession, path: str, grain: str | None = None) -> DataFrame:
    """Events as a staging table; ``grain`` makes several loads of one event time."""
    time = F.col("ts") if grain is None else F.date_trunc(grain, "ts").cast("timestamp_ntz")
    return table(spark, path, "events").select(
        F.col("event_id").alias("source_id"), F.col("user_id").alias("baby_id"),
        time.alias("event_time"), F.col("ts").alias("loaded_at"), "value",
        F.col("event_type").alias("status"), F.dayofmonth("ts").alias("job_id"),
    )


def active_members(spark: SparkSession, path: str) -> DataFrame:
    """A version of each customer, open for those in credit; the others are unknown now."""
    return table(spark, path, "customer").select(
        F.col("c_custkey").alias("baby_nk"), F.col("c_custkey").alias("baby_sk"),
        F.coalesce(F.col("c_acctbal") >= 0, F.lit(False)).alias("is_current"),
    )


def versioned_members(spark: SparkSession, path: str) -> DataFrame:
    """Two versions of each customer; the key is twice the customer, plus one for the second.

    The first version begins on the fifth of the month, so that earlier events
    fall back to the open version. The second ends on the twentieth for
    customers in debt, which have no open version.
    """
    open_ = F.col("is_current")
    end = F.when(open_, F.lit("2099-12-31 23:59:59")).otherwise(F.lit("2024-01-20"))
    parts = [
        ("2024-01-05", F.lit("2024-01-15"), 0, F.lit(False)),
        ("2024-01-15", end, 1, open_),
    ]
    both = F.array(*[
        F.struct(
            F.lit(a).cast("timestamp_ntz").alias("valid_from"),
            b.cast("timestamp_ntz").alias("valid_to"), F.lit(n).alias("n"), c.alias("is_current"),
        )
        for a, b, n, c in parts
    ])
    members = active_members(spark, path).select("baby_nk", F.inline(both))
    return members.withColumn("baby_sk", F.col("baby_nk") * 2 + F.col("n")).drop("n")


def stored_history(spark: SparkSession, path: str) -> DataFrame:
    """The event log's versions, written as the dimension table they would be."""
    versions = history(spark, path).select(
        F.col("user_id").alias("nk"), F.col("event_type").alias("attr"), "valid_from", "valid_to",
        "is_current",
    )
    tables = Tables(spark, workspace(spark, "history"))
    tables.replace("dim_state", versions, [])
    return tables.read("dim_state", versions.schema)


_MEMBERS = "m AS (SELECT c_custkey AS nk FROM customer WHERE c_acctbal >= 0)"

_VERSIONS = f"""{_MEMBERS},
v AS (SELECT c_custkey AS nk, c_custkey * 2 AS sk, TIMESTAMP '2024-01-05' AS f, TIMESTAMP '2024-01-15' AS t,
             false AS cur FROM customer
      UNION ALL
      SELECT c_custkey, c_custkey * 2 + 1, TIMESTAMP '2024-01-15',
             CASE WHEN c_acctbal >= 0 THEN TIMESTAMP '2099-12-31 23:59:59' ELSE TIMESTAMP '2024-01-20' END,
             coalesce(c_acctbal >= 0, false) FROM customer)"""


@query(f"""
WITH {_MEMBERS} SELECT event_id, coalesce(m.nk, -1) AS subject FROM events LEFT JOIN m ON m.nk = user_id""")
def current_row_join(spark: SparkSession, path: str) -> DataFrame:
    """Events with the open version of their subject, -1 where there is none."""
    events = staged_events(spark, path).select("source_id", "baby_id", "event_time")
    joined = with_current_subject(events, active_members(spark, path), "event_time")
    return joined.select(F.col("source_id").alias("event_id"), F.col("baby_sk").alias("subject"))


@query(f"""
WITH v AS ({HISTORY_SQL})
SELECT e.event_id, v.attr, v.valid_from FROM (SELECT event_id, user_id, ts - INTERVAL 30 MINUTE AS at FROM events) e
LEFT JOIN v ON v.nk = e.user_id AND e.at >= v.valid_from AND e.at < v.valid_to""")
def pit_join(spark: SparkSession, path: str) -> DataFrame:
    """The state of a subject half an hour before each of its events.

    Subjects have a version for almost every event, so events and versions are
    merged in time order instead of being paired by subject.
    """
    versions = stored_history(spark, path).withColumn("since", F.col("valid_from"))
    events = table(spark, path, "events").select(
        "event_id", F.col("user_id").alias("nk"), (F.col("ts") - F.expr("INTERVAL 30 MINUTES")).alias("at")
    )
    found = interval_join(events, versions, "nk", "at", ["attr", "since"])
    return found.select("event_id", "attr", F.col("since").alias("valid_from"))


@query(f"""
WITH {_VERSIONS} SELECT event_id, v.sk AS version FROM events
LEFT JOIN v ON v.nk = user_id AND ts >= v.f AND ts < v.t""")
def pit_join_small(spark: SparkSession, path: str) -> DataFrame:
    """The same kind of join where every subject has two versions."""
    versions = versioned_members(spark, path).select(
        F.col("baby_nk").alias("baby_id"), F.col("baby_sk").alias("version"), "valid_from", "valid_to"
    )
    events = staged_events(spark, path).select("source_id", "baby_id", "event_time")
    joined = interval_join(events, versions, "baby_id", "event_time", ["version"])
    return joined.select(F.col("source_id").alias("event_id"), "version")


@query(f"""
WITH {_VERSIONS}
SELECT event_id, coalesce(a.sk, c.sk, -1) AS version FROM events
LEFT JOIN v a ON a.nk = user_id AND ts >= a.f AND ts < a.t
LEFT JOIN v c ON c.nk = user_id AND c.cur""")
def pit_join_fallback(spark: SparkSession, path: str) -> DataFrame:
    """Version at the event time, else the open one, else unknown."""
    events = staged_events(spark, path).select("source_id", "baby_id", "event_time")
    joined = with_subject_at(events, versioned_members(spark, path), "event_time")
    return joined.select(F.col("source_id").alias("event_id"), F.col("baby_sk").alias("version"))


@query(f"""
WITH v AS ({HISTORY_SQL})
SELECT e.event_id, coalesce(a.attr, c.attr, 'unknown') AS attr
FROM (SELECT event_id, user_id, ts - INTERVAL 2 DAY AS at FROM events) e
LEFT JOIN v a ON a.nk = e.user_id AND e.at >= a.valid_from AND e.at < a.valid_to
LEFT JOIN v c ON c.nk = e.user_id AND c.is_current""")
def pit_fallback_history(spark: SparkSession, path: str) -> DataFrame:
    """The same resolution against a long history per subject."""
    versions = stored_history(spark, path)
    events = table(spark, path, "events").select(
        "event_id", F.col("user_id").alias("nk"), (F.col("ts") - F.expr("INTERVAL 2 DAYS")).alias("at")
    )
    return resolve_member(events, versions, "nk", "at", "attr", "unknown").select("event_id", "attr")


@query(f"""
WITH {_MEMBERS}
SELECT coalesce(m.nk, -1) AS subject, count(*) AS n_events, count(DISTINCT user_id) AS n_subjects
FROM events LEFT JOIN m ON m.nk = user_id GROUP BY 1 HAVING coalesce(m.nk, -1) = -1""")
def unknown_member(spark: SparkSession, path: str) -> DataFrame:
    """Events of unknown subjects share one member."""
    events = staged_events(spark, path).select("baby_id", "event_time")
    joined = with_current_subject(events, active_members(spark, path), "event_time")
    per_subject = (
        joined.where(F.col("baby_sk") == UNKNOWN_KEY).groupBy("baby_sk", "baby_id")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return per_subject.groupBy(F.col("baby_sk").alias("subject")).agg(
        F.sum("n").alias("n_events"), F.count(F.lit(1)).alias("n_subjects")
    )


def _output(rows: DataFrame, fact: Fact) -> DataFrame:
    measure = F.col(fact.measure)
    if fact.missing is not None:
        measure = F.coalesce(measure, F.lit(fact.missing))
    return rows.select(F.col("baby_sk").alias("subject"), "date_sk", "time_sk", measure.alias(fact.target))


def _initial(events: DataFrame, members: DataFrame, fact: Fact) -> DataFrame:
    known = with_current_subject(keyed_events(events, fact), members, fact.ts)
    return _output(absent_rows(known, None, fact.key, survivors_first(known, "baby_id", fact.ts)), fact)


_FACT_SQL = """
SELECT subject, date_sk, time_sk, {measure} FROM (
  SELECT *, row_number() OVER (PARTITION BY subject, date_sk, time_sk
                               ORDER BY user_id, moment, ts DESC, day(ts) DESC, event_id DESC) AS rn FROM (
    SELECT *, CAST(strftime(moment, '%Y%m%d') AS INTEGER) AS date_sk,
           CAST(hour(moment) * 100 + minute(moment) AS INTEGER) AS time_sk FROM ({source})))
WHERE rn = 1"""

_INITIAL_SOURCE = """
SELECT e.*, {at} AS moment, coalesce(m.nk, -1) AS subject FROM events e LEFT JOIN m ON m.nk = user_id
WHERE ts IS NOT NULL AND value IS NOT NULL"""


@query(f"WITH {_MEMBERS} " + _FACT_SQL.format(measure="value", source=_INITIAL_SOURCE.format(at="ts")))
def fact_initial(spark: SparkSession, path: str) -> DataFrame:
    """Initial load of a measure: one row per subject and minute."""
    return _initial(staged_events(spark, path), active_members(spark, path), EVENTS)


@query(
    f"WITH {_MEMBERS} "
    + _FACT_SQL.format(
        measure="event_type AS status", source=_INITIAL_SOURCE.format(at="date_trunc('hour', ts)")
    )
)
def fact_status_initial(spark: SparkSession, path: str) -> DataFrame:
    """Initial load of a status from staging that holds several loads of an event."""
    return _initial(staged_events(spark, path, "hour"), active_members(spark, path), STATUS_EVENTS)


_INCREMENTAL_SOURCE = """
SELECT e.*, date_trunc('hour', ts) AS moment, coalesce(a.sk, c.sk, -1) AS subject
FROM events e
LEFT JOIN v a ON a.nk = user_id AND date_trunc('hour', ts) >= a.f AND date_trunc('hour', ts) < a.t
LEFT JOIN v c ON c.nk = user_id AND c.cur
WHERE day(ts) {days}"""


def _incremental(spark: SparkSession, path: str, fact: Fact) -> tuple[DataFrame, DataFrame]:
    """Fact rows of the batches up to the fifteenth, and what later batches add.

    Odd days come first and even days after them, so later batches are full of
    late events.
    """
    members = versioned_members(spark, path)
    events = keyed_events(staged_events(spark, path, "hour"), fact)

    def load(rows: DataFrame, present: DataFrame | None) -> DataFrame:
        known = with_subject_at(rows, members, fact.ts)
        return absent_rows(known, present, fact.key, survivors_first(known, "baby_id", fact.ts))

    first = load(events.where("job_id % 2 = 1"), None)
    return first, load(events.where("job_id % 2 = 0"), first)


def _incremental_sql(measure: str) -> str:
    day = "CAST(day(ts) AS INTEGER)"
    return f"""
WITH {_VERSIONS},
first AS ({_FACT_SQL.format(measure=measure, source=_INCREMENTAL_SOURCE.format(days="% 2 = 1"))}),
second AS ({_FACT_SQL.format(measure=measure, source=_INCREMENTAL_SOURCE.format(days="% 2 = 0"))})
SELECT * FROM first UNION ALL
SELECT * FROM second s WHERE NOT EXISTS (
  SELECT 1 FROM first f WHERE f.subject = s.subject AND f.date_sk = s.date_sk AND f.time_sk = s.time_sk)"""


@query(_incremental_sql("value"))
def fact_incremental(spark: SparkSession, path: str) -> DataFrame:
    """Two loads of a measure with keys valid at the event time."""
    first, second = _incremental(spark, path, EVENTS)
    return _output(first, EVENTS).unionByName(_output(second, EVENTS))


@query(_incremental_sql("value"))
def fact_filtered(spark: SparkSession, path: str) -> DataFrame:
    """The same two loads, the second one asking filters of the stored keys which partitions to read."""
    fact, members, tables = EVENTS, versioned_members(spark, path), Tables(spark, workspace(spark, "filtered"))
    by = key_filter(fact, blocks=64)
    events = with_subject_at(keyed_events(staged_events(spark, path, "hour"), fact), members, fact.ts)
    events = events.withColumn(by.lead, month_key(F.col(fact.date_sk)))
    order = survivors_first(events, "baby_id", fact.ts)
    first = absent_rows(events.where("job_id % 2 = 1"), None, fact.key, order)
    tables.replace("fact", first, [by.lead, by.run])
    stored = tables.read("fact", first.schema)
    tables.replace("keys", by.build(stored), [by.lead, by.run])
    second = absent_by_filter(
        events.where("job_id % 2 = 0"), stored, tables.partitions("fact", by.lead, by.run),
        tables.read("keys", by.schema), by, order,
    )
    return _output(stored, fact).unionByName(_output(second, fact))


@query(_incremental_sql("event_type AS status"))
def fact_status_incremental(spark: SparkSession, path: str) -> DataFrame:
    first, second = _incremental(spark, path, STATUS_EVENTS)
    return _output(first, STATUS_EVENTS).unionByName(_output(second, STATUS_EVENTS))


@query(f"""
WITH {_VERSIONS},
mark AS (SELECT max(ts) AS at FROM events WHERE day(ts) % 2 = 1),
late AS (SELECT event_id, user_id, ts FROM events, mark WHERE day(ts) % 2 = 0 AND ts <= mark.at)
SELECT event_id, coalesce(a.sk, c.sk, -1) AS version FROM late
LEFT JOIN v a ON a.nk = user_id AND ts >= a.f AND ts < a.t
LEFT JOIN v c ON c.nk = user_id AND c.cur""")
def late_arrivals(spark: SparkSession, path: str) -> DataFrame:
    """Events of later batches that lie before the mark of the earlier ones.

    They are chosen by batch and load like any other, under the version of
    their own time.
    """
    events = staged_events(spark, path).select("source_id", "baby_id", "event_time", "job_id")
    mark = events.where("job_id % 2 = 1").agg(F.max("event_time"))
    late = events.where((F.col("job_id") % 2 == 0) & (F.col("event_time") <= mark.scalar()))
    joined = with_subject_at(late, versioned_members(spark, path), "event_time")
    return joined.select(F.col("source_id").alias("event_id"), F.col("baby_sk").alias("version"))
