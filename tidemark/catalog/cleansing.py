"""Typing, hashing and splitting of raw text."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.catalog import query, table
from tidemark.functions import coerce as c
from tidemark.functions.hashing import derived_id, row_hash
from tidemark.functions.keys import clock_text, date_key, time_key
from tidemark.plans import mappings as m
from tidemark.plans.operational import seed_durations, seed_statuses
from tidemark.plans.staging import split_rows

# Raw text with the flaws of hand-kept files, made from every event by rule.
RAW_NUMBER = """
CASE WHEN event_id % 23 = 0 THEN '   '
     WHEN event_id % 19 = 0 THEN '-' || CAST(event_id AS STRING)
     WHEN event_id % 17 = 0 THEN 'abc'
     WHEN event_id % 13 = 0 THEN '  ' || CAST(event_id AS STRING) || ' '
     ELSE CAST(event_id AS STRING) END"""

NUMBER_VALUE = """
CASE WHEN event_id % 23 = 0 OR event_id % 19 = 0 OR event_id % 17 = 0 THEN NULL
     ELSE CAST(event_id AS INTEGER) END"""

NUMBER_ERROR = """
CASE WHEN event_id % 23 = 0 THEN NULL
     WHEN event_id % 19 = 0
     THEN 'Cannot convert ''-' || CAST(event_id AS STRING) || ''' to non-negative int'
     WHEN event_id % 17 = 0 THEN 'Cannot convert ''abc'' to int' END"""


@query(f"SELECT event_id, {NUMBER_VALUE} AS number, {NUMBER_ERROR} AS error FROM events")
def clean_int(spark: SparkSession, path: str) -> DataFrame:
    raw = table(spark, path, "events").select("event_id", F.expr(RAW_NUMBER).alias("raw"))
    typed = c.add_typed(raw, c.int_steps(F.col("raw"), "n"))
    names = c.typed_names("n")
    return typed.select("event_id", F.col(names.value).alias("number"), F.col(names.error).alias("error"))


@query("""
SELECT event_id, CASE WHEN event_id % 11 = 0 THEN NULL ELSE event_type END AS label,
       event_type AS status
FROM events""")
def clean_text(spark: SparkSession, path: str) -> DataFrame:
    padded = F.when(F.col("event_id") % 11 == 0, F.lit(" \t ")).otherwise(
        F.concat(F.lit(" \n"), "event_type", F.lit("\t "))
    )
    shouted = F.concat(F.lit("  "), F.upper("event_type"), F.lit(" "))
    return table(spark, path, "events").select(
        "event_id", c.clean_text(padded).alias("label"), c.clean_status(shouted).alias("status")
    )


# Every format in turn, then an impossible day, plain text and a blank.
_STAMPS = {
    0: "date_format(ts, \"yyyy-MM-dd'T'HH:mm:ss\") || '+00:00'",
    1: "date_format(ts, \"yyyy-MM-dd'T'HH:mm\") || '+0200'",
    2: "date_format(ts, \"yyyy-MM-dd'T'HH:mm:ss\") || 'Z'",
    3: "date_format(ts, 'yyyy-MM-dd HH:mm')",
    4: "date_format(ts, 'yyyy-MM-dd HH:mm:ss')",
    5: "date_format(ts, \"yyyy-MM-dd'T'HH:mm\")",
    6: "date_format(ts, \"yyyy-MM-dd'T'HH:mm:ss\")",
    7: "date_format(ts, 'd.M.yyyy, H:m')",
    8: "date_format(ts, 'dd.MM.yyyy HH:mm')",
    9: "date_format(ts, 'dd/MM/yyyy HH:mm')",
    10: "date_format(ts, 'MM/dd/yyyy HH:mm')",
    11: "date_format(ts, \"yyyy-MM-dd'T'HH:mm:ss\") || '-05:30'",
    12: "'31.02.2024, 08:00'",
    13: "'no date'",
    14: "'  '",
}


def _stamps() -> str:
    whens = " ".join(f"WHEN {k} THEN {v}" for k, v in _STAMPS.items())
    return f"CASE event_id % 15 {whens} END"


@query("""
WITH e AS (SELECT event_id, event_id % 15 AS k, date_trunc('minute', ts) AS mi,
                  date_trunc('second', ts) AS se FROM events)
SELECT event_id,
       CASE WHEN k IN (0, 2, 4, 6) THEN se
            WHEN k = 1 THEN mi - INTERVAL 2 HOUR
            WHEN k IN (3, 5, 7, 8, 9) THEN mi
            WHEN k = 10 AND day(mi) > 12 THEN mi
            WHEN k = 10 THEN make_timestamp(year(mi), day(mi), month(mi), hour(mi), minute(mi), 0.0)
            WHEN k = 11 THEN se + INTERVAL 330 MINUTE END AS instant,
       CASE k WHEN 12 THEN 'Cannot convert ''31.02.2024, 08:00'' to datetime'
              WHEN 13 THEN 'Cannot convert ''no date'' to datetime' END AS error
FROM e""")
def parse_ts_multi(spark: SparkSession, path: str) -> DataFrame:
    raw = table(spark, path, "events").select("event_id", F.expr(_stamps()).alias("raw"))
    typed = c.add_typed(raw, c.instant_steps(F.col("raw"), "t", fmt="%d.%m.%Y, %H:%M"))
    names = c.typed_names("t")
    return typed.select(
        "event_id",
        F.col(names.value).cast("timestamp_ntz").alias("instant"),
        F.col(names.error).alias("error"),
    )


@query("""
SELECT event_id, CASE user_id % 3 WHEN 0 THEN ts - INTERVAL 1 HOUR WHEN 1 THEN ts + INTERVAL 5 HOUR
                 ELSE ts - INTERVAL 330 MINUTE END AS utc
FROM events""")
def zone_to_utc(spark: SparkSession, path: str) -> DataFrame:
    """Wall clock in the zone of the subject; all events are in winter time."""
    zone = F.expr(
        "CASE user_id % 3 WHEN 0 THEN 'Europe/Berlin' WHEN 1 THEN 'America/New_York' "
        "ELSE 'Asia/Kolkata' END"
    )
    utc = c.wall_clock_to_utc(F.col("ts").cast("timestamp"), zone)
    return table(spark, path, "events").select("event_id", utc.cast("timestamp_ntz").alias("utc"))


@query("""
SELECT event_id, sha256(concat_ws('|', CAST(event_id AS VARCHAR),
       CASE WHEN date_trunc('second', ts) = ts THEN strftime(ts, '%Y-%m-%d %H:%M:%S')
            ELSE strftime(ts, '%Y-%m-%d %H:%M:%S.%f') END,
       CASE WHEN event_id % 11 = 0 THEN 'None' ELSE event_type END, CAST(user_id AS VARCHAR))) AS row_hash,
       substr(sha256(strftime(ts, '%Y-%m-%dT%H:%M:%S') || '|' || CAST(user_id AS VARCHAR)), 1, 16) AS made_id
FROM events""")
def row_hashes(spark: SparkSession, path: str) -> DataFrame:
    """Content hash of whole rows, and the id derived from time and parent."""
    events = table(spark, path, "events")
    exact, whole = c.wall_text(F.col("ts")), c.wall_text(F.date_trunc("second", "ts"))
    label = F.when(F.col("event_id") % 11 != 0, F.col("event_type"))
    return events.select(
        "event_id",
        row_hash([F.col("event_id"), exact, label, F.col("user_id")]).alias("row_hash"),
        derived_id(whole, F.col("user_id")).alias("made_id"),
    )


@query("""
SELECT event_id, CAST(strftime(ts, '%Y%m%d') AS INTEGER) AS date_sk,
       CAST(hour(ts) * 100 + minute(ts) AS INTEGER) AS time_sk, CAST(year(ts) AS INTEGER) AS year,
       CAST(month(ts) AS INTEGER) AS month, CAST(day(ts) AS INTEGER) AS day,
       strftime(ts, '%H:%M') AS clock
FROM events""")
def date_time_keys(spark: SparkSession, path: str) -> DataFrame:
    ts = F.col("ts")
    return table(spark, path, "events").select(
        "event_id", date_key(ts).alias("date_sk"), time_key(ts).alias("time_sk"),
        F.year(ts).alias("year"), F.month(ts).alias("month"), F.dayofmonth(ts).alias("day"),
        clock_text(F.hour(ts), F.minute(ts)).alias("clock"),
    )


@query("""
SELECT event_id, date_trunc('day', ts) AS daily, date_trunc('minute', ts) AS hourly,
       date_trunc('minute', ts) AS cron, date_trunc('day', ts) AS unscheduled
FROM events""")
def schedule_instants(spark: SparkSession, path: str) -> DataFrame:
    """Run identity under a daily, an hourly, a cron and no schedule."""
    schedules = {"daily": "@daily", "hourly": "@hourly", "cron": "0 1 * * *", "unscheduled": None}
    return table(spark, path, "events").select(
        "event_id",
        *[
            c.truncate_schedule(F.col("ts"), text).cast("timestamp_ntz").alias(name)
            for name, text in schedules.items()
        ],
    )


# -- mappings -------------------------------------------------------------------

# A hand-kept amounts file with one row per event.
AMOUNT_COLUMNS = {
    "ID": RAW_NUMBER,
    "Baby ID": "CASE WHEN event_id % 7 = 0 THEN '' ELSE CAST(user_id AS STRING) END",
    "Time": "CASE WHEN event_id % 29 = 0 THEN '31.02.2024, 08:00' WHEN event_id % 31 = 0 THEN NULL "
    "ELSE date_format(ts, 'dd.MM.yyyy, HH:mm') END",
    "Amount (ml)": "CASE WHEN event_id % 37 = 0 THEN 'much' "
    "ELSE CAST(CAST(floor(value) AS INT) AS STRING) END",
    "Note": "event_type",
}

AMOUNT_CTE = f"""
WITH a AS (
  SELECT event_id, ts, user_id, event_type,
         {RAW_NUMBER.replace('STRING', 'VARCHAR')} AS id_text,
         CASE WHEN event_id % 7 = 0 THEN '' ELSE CAST(user_id AS VARCHAR) END AS parent_text,
         CASE WHEN event_id % 29 = 0 THEN '31.02.2024, 08:00' WHEN event_id % 31 = 0 THEN NULL
              ELSE strftime(ts, '%d.%m.%Y, %H:%M') END AS time_text,
         CASE WHEN event_id % 37 = 0 THEN 'much' ELSE CAST(CAST(floor(value) AS INTEGER) AS VARCHAR) END
           AS amount_text,
         {NUMBER_VALUE} AS id_value, {NUMBER_ERROR.replace('STRING', 'VARCHAR')} AS id_error
  FROM events),
typed AS (
  SELECT *, CASE WHEN event_id % 29 = 0 OR event_id % 31 = 0 THEN NULL ELSE date_trunc('minute', ts) END
              AS feed_time,
         CASE WHEN event_id % 7 = 0 THEN 1 ELSE CAST(user_id AS INTEGER) END AS baby_id,
         CASE WHEN event_id % 37 = 0 THEN NULL ELSE CAST(amount_text AS INTEGER) END AS amount_ml,
         coalesce(id_error,
                  CASE WHEN event_id % 29 = 0 THEN 'Cannot convert ''31.02.2024, 08:00'' to datetime' END,
                  CASE WHEN event_id % 37 = 0 THEN 'Cannot convert ''much'' to int' END) AS error_message
  FROM a),
named AS (
  SELECT *, coalesce(CAST(id_value AS VARCHAR),
           substr(sha256(coalesce(strftime(feed_time, '%Y-%m-%dT%H:%M:%S'), 'None') || '|' ||
                         CAST(baby_id AS VARCHAR)), 1, 16)) AS source_id
  FROM typed)
"""


def amount_lines(events: DataFrame) -> DataFrame:
    return events.select(*[F.expr(sql).alias(name) for name, sql in AMOUNT_COLUMNS.items()])


@query(AMOUNT_CTE + """
SELECT source_id, feed_time, amount_ml, baby_id,
       sha256(concat_ws('|', source_id, coalesce(strftime(feed_time, '%Y-%m-%d %H:%M:%S'), 'None'),
              coalesce(CAST(amount_ml AS VARCHAR), 'None'), CAST(baby_id AS VARCHAR))) AS row_hash
FROM named WHERE error_message IS NULL""")
def staged_amounts(spark: SparkSession, path: str) -> DataFrame:
    """Good rows of the amounts file: default parent, derived ids, hashes."""
    rows = m.map_rows(amount_lines(table(spark, path, "events")), m.AMOUNT_FILE)
    good, _ = split_rows(rows)
    return good.withColumn("feed_time", F.col("feed_time").cast("timestamp_ntz"))


@query(AMOUNT_CTE + """
SELECT 'amount_file' AS rule, error_message,
       '{"ID":"' || id_text || '","Baby ID":"' || parent_text || '","Time":' ||
       coalesce('"' || time_text || '"', 'null') || ',"Amount (ml)":"' || amount_text ||
       '","Note":"' || event_type || '"}' AS raw
FROM named WHERE error_message IS NOT NULL""")
def quarantine_split(spark: SparkSession, path: str) -> DataFrame:
    """Bad rows of the amounts file with the reason and the row as JSON."""
    rows = m.map_rows(amount_lines(table(spark, path, "events")), m.AMOUNT_FILE)
    _, bad = split_rows(rows)
    return bad.select(F.lit(m.AMOUNT_FILE.name).alias("rule"), "error_message", "raw")


@query(AMOUNT_CTE + """
SELECT CAST(day(ts) AS INTEGER) AS job_id, count(*) AS n_rows,
       count(*) FILTER (error_message IS NULL) AS n_good,
       count(*) FILTER (error_message IS NOT NULL) AS n_bad
FROM named GROUP BY 1""")
def ingest_counts(spark: SparkSession, path: str) -> DataFrame:
    """Good and bad rows of every batch in one pass."""
    batches = table(spark, path, "events").select(
        *[F.expr(sql).alias(name) for name, sql in AMOUNT_COLUMNS.items()],
        F.dayofmonth("ts").alias("batch"),
    )
    counted = m.Mapping(
        "counted", (*m.AMOUNT_FILE.fields, m.Field("job_id", "batch", "int")), "baby_id", 1
    )
    return (
        m.map_rows(batches, counted)
        .groupBy("job_id")
        .agg(
            F.count(F.lit(1)).alias("n_rows"),
            F.count_if(F.col("error_message").isNull()).alias("n_good"),
            F.count_if(F.col("error_message").isNotNull()).alias("n_bad"),
        )
    )


# Fixed stand-in: a zone per market segment, one of them not a zone.
SEGMENT_ZONE = """
CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'Europe/Berlin' WHEN 'BUILDING' THEN 'Europe/Chisinau'
     WHEN 'FURNITURE' THEN 'America/New_York' WHEN 'HOUSEHOLD' THEN 'UTC' ELSE 'Mars/Olympus' END"""


@query(f"""
SELECT CAST(c_custkey AS INTEGER) AS source_id, c_name AS name, {SEGMENT_ZONE} AS timezone,
       sha256(concat_ws('|', CAST(c_custkey AS VARCHAR), c_name, {SEGMENT_ZONE})) AS row_hash
FROM customer""")
def staged_subjects(spark: SparkSession, path: str) -> DataFrame:
    source = table(spark, path, "customer").select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.expr(SEGMENT_ZONE).alias("timezone")
    )
    return split_rows(m.map_rows(source, m.SUBJECT))[0]


@query("""
SELECT CAST(event_id AS INTEGER) AS source_id, ts AS change_time, event_type AS status,
       CAST(user_id AS INTEGER) AS baby_id,
       sha256(concat_ws('|', CAST(event_id AS VARCHAR), CASE WHEN date_trunc('second', ts) = ts
              THEN strftime(ts, '%Y-%m-%d %H:%M:%S') ELSE strftime(ts, '%Y-%m-%d %H:%M:%S.%f') END || '+00:00',
              event_type, CAST(user_id AS VARCHAR))) AS row_hash
FROM events""")
def staged_statuses(spark: SparkSession, path: str) -> DataFrame:
    """Status events of an operational table, whose times carry the zone."""
    source = table(spark, path, "events").select(
        F.col("event_id").alias("id"), F.col("ts").cast("timestamp").alias("change_time"),
        F.col("event_type").alias("status"), F.col("user_id").alias("baby_id"),
    )
    good, _ = split_rows(m.map_rows(source, m.STATUS_TABLE))
    return good.withColumn("change_time", F.col("change_time").cast("timestamp_ntz"))


@query("""
SELECT CAST(o_orderkey AS INTEGER) AS source_id, CAST(o_orderdate AS TIMESTAMP) AS sleep_start,
       CAST(floor(o_totalprice) AS INTEGER) AS sleep_duration, CAST(o_custkey AS INTEGER) AS baby_id,
       sha256(concat_ws('|', CAST(o_orderkey AS VARCHAR),
              strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') || '+00:00',
              CAST(CAST(floor(o_totalprice) AS INTEGER) AS VARCHAR), CAST(o_custkey AS VARCHAR))) AS row_hash
FROM orders""")
def staged_durations(spark: SparkSession, path: str) -> DataFrame:
    """Duration events as documents deliver them: ISO times with a zone."""
    source = table(spark, path, "orders").select(
        F.col("o_orderkey").cast("string").alias("id"),
        F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss'+00:00'").alias("start"),
        F.floor("o_totalprice").cast("string").alias("duration"),
        F.col("o_custkey").cast("string").alias("baby_id"),
    )
    good, _ = split_rows(m.map_rows(source, m.DURATION_DOCUMENT))
    return good.withColumn("sleep_start", F.col("sleep_start").cast("timestamp_ntz"))


_SEED_TIME = """
CASE event_id % 10 WHEN 0 THEN NULL WHEN 1 THEN date_format(ts, 'yyyy-MM-dd HH:mm')
     WHEN 2 THEN '31.03.2099, 10:00' ELSE date_format(ts, 'dd.MM.yyyy, HH:mm') END"""


@query("""
WITH s AS (SELECT event_id, event_id % 10 AS k, date_trunc('minute', ts) - INTERVAL 1 HOUR AS utc,
                  CAST(floor(value) AS INTEGER) AS minutes, event_type FROM events)
SELECT 'duration' AS kind, count(*) FILTER (k > 2 AND minutes > 0) AS imported,
       count(*) FILTER (NOT (k > 2 AND minutes > 0)) AS failed,
       max(CASE WHEN k > 2 AND minutes > 0 THEN utc END) AS newest FROM s
UNION ALL
SELECT 'status', count(*) FILTER (k > 2 AND event_type IN ('click', 'view')),
       count(*) FILTER (NOT (k > 2 AND event_type IN ('click', 'view'))),
       max(CASE WHEN k > 2 AND event_type IN ('click', 'view') THEN utc END) FROM s""")
def seed_import(spark: SparkSession, path: str) -> DataFrame:
    """Historical import of two files: strict format, local zone, rules, counts."""
    lines = table(spark, path, "events").select(
        F.expr(_SEED_TIME).alias("Time"),
        F.floor("value").cast("string").alias("Duration(minutes)"),
        F.expr("CASE event_type WHEN 'click' THEN ' Wet' WHEN 'view' THEN 'DIRTY' ELSE event_type END").alias(
            "Status"
        ),
    )
    now, zone = datetime(2025, 1, 1), "Europe/Berlin"
    parts = []
    for kind, ts, imported in (
        ("duration", "sleep_start", seed_durations(lines.drop("Status"), 1, zone, now)),
        ("status", "change_time", seed_statuses(lines.drop("Duration(minutes)"), 1, zone, now)),
    ):
        rows = imported.good.select(F.col(ts).alias("ts"), F.lit(True).alias("ok")).unionByName(
            imported.bad.select(F.lit(None).cast("timestamp").alias("ts"), F.lit(False).alias("ok"))
        )
        parts.append(
            rows.agg(
                F.count_if("ok").alias("imported"),
                F.count_if(~F.col("ok")).alias("failed"),
                F.max("ts").cast("timestamp_ntz").alias("newest"),
            ).select(F.lit(kind).alias("kind"), "imported", "failed", "newest")
        )
    return parts[0].unionByName(parts[1])
