"""Generated, insert-only and versioned dimensions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.catalog import query, table
from tidemark.catalog.dedup import BY_TYPE, batches
from tidemark.functions.keys import date_key, time_key
from tidemark.operators import scd2
from tidemark.operators.insert_absent import absent_rows
from tidemark.operators.series import date_members, time_members
from tidemark.operators.surrogate import assign_keys
from tidemark.plans.dimensions import FIRST_DATE, LAST_DATE, UNKNOWN_STATUS
from tidemark.plans.facts import events_without_date
from tidemark.session import materialise

CUT = "TIMESTAMP_NTZ'2024-01-15'"
NO_END = "TIMESTAMP '2099-12-31 23:59:59'"


@query("""
SELECT d.date_sk, d.full_date, d.year, d.month, d.day, count(e.event_id) AS n_events
FROM (SELECT CAST(strftime(x, '%Y%m%d') AS INTEGER) AS date_sk, CAST(x AS DATE) AS full_date,
             CAST(year(x) AS INTEGER) AS year, CAST(month(x) AS INTEGER) AS month,
             CAST(day(x) AS INTEGER) AS day
      FROM (SELECT unnest(generate_series(DATE '2020-01-01', DATE '2030-12-31', INTERVAL 1 DAY)) AS x)) d
LEFT JOIN events e ON CAST(strftime(e.ts, '%Y%m%d') AS INTEGER) = d.date_sk
GROUP BY ALL""")
def dim_date(spark: SparkSession, path: str) -> DataFrame:
    """The calendar with the number of events on each day.

    Events are counted per day before they meet the 4018 days.
    """
    per_day = (
        table(spark, path, "events").groupBy(date_key(F.col("ts")).alias("date_sk"))
        .agg(F.count(F.lit(1)).alias("n_events"))
    )
    days = date_members(spark, FIRST_DATE, LAST_DATE)
    return days.join(per_day, "date_sk", "left").fillna(0, ["n_events"])


@query("""
SELECT t.time_sk, t.full_time, t.hour, t.minute, count(e.event_id) AS n_events
FROM (SELECT CAST(h * 100 + m AS INTEGER) AS time_sk,
             lpad(CAST(h AS VARCHAR), 2, '0') || ':' || lpad(CAST(m AS VARCHAR), 2, '0') AS full_time,
             CAST(h AS INTEGER) AS hour, CAST(m AS INTEGER) AS minute
      FROM range(24) a(h), range(60) b(m)) t
LEFT JOIN events e ON CAST(hour(e.ts) * 100 + minute(e.ts) AS INTEGER) = t.time_sk
GROUP BY ALL""")
def dim_time(spark: SparkSession, path: str) -> DataFrame:
    """The minutes of a day with the number of events in each."""
    per_minute = (
        table(spark, path, "events").groupBy(time_key(F.col("ts")).alias("time_sk"))
        .agg(F.count(F.lit(1)).alias("n_events"))
    )
    return time_members(spark).join(per_minute, "time_sk", "left").fillna(0, ["n_events"])


@query("""
SELECT o_orderkey, CAST(strftime(o_orderdate, '%Y%m%d') AS INTEGER) AS date_sk FROM orders
WHERE o_orderdate < TIMESTAMP '2020-01-01' OR o_orderdate >= TIMESTAMP '2031-01-01'""")
def date_orphans(spark: SparkSession, path: str) -> DataFrame:
    """Facts whose day the calendar does not cover."""
    orders = table(spark, path, "orders").select(
        "o_orderkey", date_key(F.col("o_orderdate")).alias("date_sk")
    )
    return events_without_date(orders, date_members(spark, FIRST_DATE, LAST_DATE), "date_sk").select(
        "o_orderkey", "date_sk"
    )


# -- insert-only ----------------------------------------------------------------


def _statuses(events: DataFrame) -> DataFrame:
    return events.where("event_type IS NOT NULL").select(
        F.col("event_type").alias("status_sk"), F.col("event_type").alias("status")
    ).distinct()


@query("""
SELECT 'UNKNOWN' AS status_sk, 'UNKNOWN STATUS' AS status
UNION ALL SELECT DISTINCT event_type, event_type FROM events WHERE event_type IS NOT NULL""")
def scd1_status(spark: SparkSession, path: str) -> DataFrame:
    """All statuses and the unknown one."""
    sk, name = UNKNOWN_STATUS
    unknown = scd2.unknown_member(spark, {"status_sk": F.lit(sk), "status": F.lit(name)})
    return unknown.unionByName(_statuses(table(spark, path, "events")))


@query("""
SELECT event_type || '-' || CAST(user_id AS VARCHAR) AS status_sk,
       min(CASE WHEN ts < TIMESTAMP '2024-01-15' THEN 1 ELSE 2 END) AS batch
FROM events GROUP BY 1""")
def insert_if_absent(spark: SparkSession, path: str) -> DataFrame:
    """Members of a second batch join those of the first; known ones stay as they are."""
    events = table(spark, path, "events")
    name = F.concat_ws("-", "event_type", F.col("user_id").cast("string")).alias("status_sk")
    first = events.where(f"ts < {CUT}").select(name, F.lit(1).alias("batch")).distinct()
    second = events.where(f"ts >= {CUT}").select(name, F.lit(2).alias("batch"))
    return first.unionByName(absent_rows(second, first, ["status_sk"], [F.col("batch")]))


# -- versioned ------------------------------------------------------------------

_LATEST = """
SELECT user_id AS nk, event_type AS attr, ts AS valid_from FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn
  FROM events {where}) WHERE rn = 1"""


def _output(versions: DataFrame) -> DataFrame:
    return versions.select(
        F.col("user_id").alias("nk"), F.col("event_type").alias("attr"), "valid_from", "valid_to", "is_current"
    )


@query(f"""
SELECT nk, attr, valid_from, {NO_END} AS valid_to, true AS is_current FROM ({_LATEST.format(where='')})
UNION ALL SELECT -1, 'unknown', TIMESTAMP '1900-01-01', TIMESTAMP '2099-12-31', true""")
def scd2_initial(spark: SparkSession, path: str) -> DataFrame:
    """One open version per subject from its newest row, and the unknown member."""
    order = [F.col("ts").desc(), F.col("event_id").desc()]
    base = scd2.initial_versions(batches(spark, path), BY_TYPE, order)
    unknown = scd2.unknown_member(
        spark,
        {
            "nk": F.lit(scd2.UNKNOWN_KEY).cast("long"), "attr": F.lit("unknown"),
            "valid_from": F.lit(str(scd2.UNKNOWN_FROM)).cast("timestamp_ntz"),
            "valid_to": F.lit(str(scd2.UNKNOWN_TO)).cast("timestamp_ntz"), "is_current": F.lit(True),
        },
    )
    return _output(base).unionByName(unknown)


@query("""
SELECT user_id AS nk, event_id, event_type AS attr, prev AS prev_attr FROM (
  SELECT *, lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS prev FROM events)
WHERE prev IS DISTINCT FROM event_type""")
def scd2_change_detect(spark: SparkSession, path: str) -> DataFrame:
    """Rows at which the attribute of a subject changes, with the value before."""
    by = scd2.VersionedBy("user_id", "event_type", "ts", ("ts", "event_id"))
    return scd2.changed_rows(batches(spark, path), by).select(
        F.col("user_id").alias("nk"), "event_id", F.col("event_type").alias("attr"), "prev_attr"
    )


HISTORY_SQL = """
  SELECT user_id AS nk, event_type AS attr, ts AS valid_from,
         coalesce(lead(ts) OVER w, TIMESTAMP '2099-12-31 23:59:59') AS valid_to,
         lead(ts) OVER w IS NULL AS is_current
  FROM (SELECT *, lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS prev FROM events)
  WHERE prev IS DISTINCT FROM event_type
  WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)"""


def history(spark: SparkSession, path: str) -> DataFrame:
    by = scd2.VersionedBy("user_id", "event_type", "ts", ("ts", "event_id"))
    return scd2.version_history(batches(spark, path), by)


@query(HISTORY_SQL)
def scd2_history(spark: SparkSession, path: str) -> DataFrame:
    """Every version of every subject in the event log."""
    return _output(history(spark, path))


_BEFORE = "WHERE ts < TIMESTAMP '2024-01-15'"
_MERGE_BASE = f"base AS ({_LATEST.format(where=_BEFORE)})"

_BATCH = """
batch AS (SELECT user_id AS nk, event_type AS attr, CAST(day(ts) AS INTEGER) AS job_id, ts, event_id
          FROM events WHERE ts >= TIMESTAMP '2024-01-15')"""

_FIRST_SEEN = """
firsts AS (SELECT nk, attr, job_id, ts FROM (SELECT *, row_number() OVER (
             PARTITION BY nk, attr ORDER BY job_id, ts, event_id) AS rn FROM batch) WHERE rn = 1),
changes AS (SELECT f.*, b.attr AS current_attr, b.nk IS NOT NULL AS known
            FROM firsts f LEFT JOIN base b ON b.nk = f.nk
            WHERE b.nk IS NULL OR b.attr IS DISTINCT FROM f.attr)"""

_MERGED = f"""
SELECT b.nk, b.attr, b.valid_from, coalesce(x.ends, {NO_END}) AS valid_to, x.ends IS NULL AS is_current
FROM base b LEFT JOIN (SELECT nk, min(ts) AS ends FROM changes WHERE known GROUP BY nk) x ON x.nk = b.nk
UNION ALL
SELECT nk, attr, ts, coalesce(lead(ts) OVER w, {NO_END}), lead(ts) OVER w IS NULL
FROM changes WINDOW w AS (PARTITION BY nk ORDER BY job_id, ts)"""


def _base_and_batch(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    rows = batches(spark, path)
    order = [F.col("ts").desc(), F.col("event_id").desc()]
    base = scd2.initial_versions(rows.where(f"ts < {CUT}"), BY_TYPE, order)
    return _output(base).withColumnRenamed("nk", "user_id"), rows.where(f"ts >= {CUT}")


def _merge(spark: SparkSession, path: str, collapse: bool) -> DataFrame:
    base, batch = _base_and_batch(spark, path)
    by = BY_TYPE if collapse else scd2.VersionedBy("user_id", "event_type", "ts", ("ts", "event_id"))
    changes = materialise(scd2.compare_with_current(batch, base, by, "attr", collapse), "changes")
    opened = _output(scd2.new_versions(changes, by))
    kept = scd2.expire_current(base, scd2.expiry(changes, by), "user_id", F.lit(None))
    return kept.withColumnRenamed("user_id", "nk").unionByName(opened)


@query(f"WITH {_MERGE_BASE}, {_BATCH}, {_FIRST_SEEN} {_MERGED}")
def scd2_merge(spark: SparkSession, path: str) -> DataFrame:
    """A batch merged into a dimension; a value counts once per subject and batch."""
    return _merge(spark, path, collapse=True)


@query(f"""
WITH {_MERGE_BASE}, {_BATCH}, {_FIRST_SEEN}
SELECT nk, min(ts) AS expires_at, count(*) AS n_changes FROM changes WHERE known GROUP BY nk""")
def scd2_expiry(spark: SparkSession, path: str) -> DataFrame:
    """When the open version of each changed subject ends."""
    base, batch = _base_and_batch(spark, path)
    changes = materialise(scd2.compare_with_current(batch, base, BY_TYPE, "attr"), "changes")
    counts = changes.where("known").groupBy("user_id").agg(F.count(F.lit(1)).alias("n_changes"))
    return scd2.expiry(changes, BY_TYPE).join(counts, "user_id").select(
        F.col("user_id").alias("nk"), "expires_at", "n_changes"
    )


@query(f"""
WITH {_MERGE_BASE}, {_BATCH},
lagged AS (SELECT t.*, b.nk IS NOT NULL AS known, coalesce(t.prev, b.attr) AS before FROM (
             SELECT *, lag(attr) OVER (PARTITION BY nk ORDER BY ts, event_id) AS prev FROM batch) t
           LEFT JOIN base b ON b.nk = t.nk),
changes AS (SELECT nk, attr, ts, event_id, known, ts AS job_id FROM lagged WHERE before IS DISTINCT FROM attr)
{_MERGED}""")
def scd2_merge_full(spark: SparkSession, path: str) -> DataFrame:
    """The same merge with every change of the batch as a version of its own."""
    return _merge(spark, path, collapse=False)


@query("SELECT count(*) AS n_versions, count(*) AS n_keys, true AS non_negative FROM (" + HISTORY_SQL + ")")
def surrogate_keys(spark: SparkSession, path: str) -> DataFrame:
    """Keys given to two batches of versions: none twice, none negative."""
    versions = history(spark, path).select("user_id", "valid_from")
    early = assign_keys(versions.where(f"valid_from < {CUT}"), ["user_id", "valid_from"], "sk")
    late = assign_keys(versions.where(f"valid_from >= {CUT}"), ["user_id", "valid_from"], "sk", early)
    keyed = early.select("sk").unionByName(late.select("sk"))
    per_key = keyed.groupBy("sk").agg(F.count(F.lit(1)).alias("n"))
    return per_key.agg(
        F.sum("n").alias("n_versions"), F.count(F.lit(1)).alias("n_keys"),
        (F.min("sk") >= 0).alias("non_negative"),
    )
