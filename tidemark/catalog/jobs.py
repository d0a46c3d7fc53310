"""Whole warehouses built from the driver tables, and the streaming ingest."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.catalog import query, table
from tidemark.catalog.cleansing import SEGMENT_ZONE
from tidemark.functions.coerce import iso_seconds
from tidemark.plans.dimensions import UNKNOWN_STATUS, UNKNOWN_SUBJECT
from tidemark.plans.facts import FACTS
from tidemark.plans.flow import Sources, incremental_load, initial_load
from tidemark.plans.mappings import STATUS_TABLE
from tidemark.plans.staging import Warehouse
from tidemark.session import workspace
from tidemark.sources import read_json
from tidemark.streaming.file_ingest import ingest_available, landed_files

# Fixed stand-ins: events and orders before these instants are loaded first.
EVENT_CUT, ORDER_CUT = "2024-01-15", "1999-01-01"
FIRST_RUN = datetime(2024, 2, 1, tzinfo=timezone.utc)
SECOND_RUN = datetime(2024, 3, 1, tzinfo=timezone.utc)

_AMOUNT = "CASE WHEN event_id % 37 = 0 THEN 'much' ELSE CAST(CAST(floor(value) AS INT) AS STRING) END"


def _utc(col: str) -> F.Column:
    return F.col(col).cast("timestamp")


def _sources(
    spark: SparkSession, path: str, files: str, load: str, events: DataFrame, orders: DataFrame, zone: F.Column
) -> Sources:
    """Operational tables and landed files with the shapes the jobs expect."""
    subjects = table(spark, path, "customer").select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), zone.alias("timezone")
    )
    durations = orders.select(
        F.col("o_orderkey").alias("id"),
        (_utc("o_orderdate") + F.make_dt_interval(mins=F.col("o_orderkey") % 1440)).alias("sleep_start"),
        (F.col("o_orderkey") % 600).alias("sleep_duration"), F.col("o_custkey").alias("baby_id"),
    )
    statuses = events.select(
        F.col("event_id").alias("id"), _utc("ts").alias("change_time"),
        F.col("event_type").alias("status"), F.col("user_id").alias("baby_id"),
    )
    amounts, documents = f"{files}/{load}-amounts", f"{files}/{load}-documents"
    events.select(
        F.col("event_id").alias("ID"), F.col("user_id").alias("Baby ID"),
        F.date_format("ts", "dd.MM.yyyy, HH:mm").alias("Time"), F.expr(_AMOUNT).alias("Amount (ml)"),
    ).write.option("header", True).option("escape", '"').csv(amounts)
    docs = None
    if load == "initial":
        statuses.select(
            "id", "status", F.concat(iso_seconds(F.col("change_time")), F.lit("+00:00")).alias("change_time"),
            F.col("baby_id").alias("parent_id"),
        ).write.json(documents)
        docs = read_json(spark, documents, ["id", "status", "change_time", "parent_id"]).withColumn(
            "parent_id", F.col("parent_id").cast("int")
        )
    return Sources(subjects, durations, amounts, statuses, docs)


def _counts(wh: Warehouse, tables: list[str]) -> DataFrame:
    counts = [
        wh.tables.read(name).agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("name"), "n_rows")
        for name in tables
    ]
    result = counts[0]
    for part in counts[1:]:
        result = result.unionByName(part)
    return result


TABLES = [
    "stg_baby", "stg_sleep", "stg_diaper", "stg_formula", "dim_date", "dim_time", "dim_diaper_status",
    "dim_baby", "fact_sleep", "fact_diaper", "fact_formula_feed",
]

_COMMON = """
SELECT 'stg_baby' AS name, count(*) AS n_rows FROM customer
UNION ALL SELECT 'stg_sleep', count(*) FROM orders
UNION ALL SELECT 'stg_diaper', count(*) FROM events WHERE user_id IN (SELECT c_custkey FROM customer)
UNION ALL SELECT 'stg_formula', count(*) FROM events WHERE event_id % 37 <> 0
UNION ALL SELECT 'dim_date', count(*) FROM generate_series(DATE '2020-01-01', DATE '2030-12-31', INTERVAL 1 DAY)
UNION ALL SELECT 'dim_time', 24 * 60
UNION ALL SELECT 'dim_diaper_status', count(DISTINCT event_type) + 1 FROM events
UNION ALL SELECT 'fact_sleep', count(*) FROM (
  SELECT DISTINCT o_custkey, o_orderdate + to_minutes(CAST(o_orderkey % 1440 AS INTEGER)) {sleep_part} FROM orders)
UNION ALL SELECT 'fact_diaper', count(*) FROM (
  SELECT DISTINCT user_id, date_trunc('minute', ts) FROM events)
UNION ALL SELECT 'fact_formula_feed', count(*) FROM (
  SELECT DISTINCT user_id, date_trunc('minute', ts) FROM events WHERE event_id % 37 <> 0)"""


@query(_COMMON.format(sleep_part="") + " UNION ALL SELECT 'dim_baby', count(*) + 1 FROM customer")
def star_initial_counts(spark: SparkSession, path: str) -> DataFrame:
    """Rows of every table after an initial load of everything."""
    root = workspace(spark, "star")
    src = _sources(
        spark, path, root, "initial", table(spark, path, "events"), table(spark, path, "orders"),
        F.expr(SEGMENT_ZONE),
    )
    wh = Warehouse(spark, f"{root}/warehouse", FIRST_RUN)
    initial_load(wh, src, FIRST_RUN)
    return _counts(wh, TABLES)


_CHANGED = f"c_acctbal < 0 AND {SEGMENT_ZONE} <> 'UTC'"


@query(
    _COMMON.format(
        sleep_part=f", o_orderdate >= TIMESTAMP '{ORDER_CUT}' AND o_custkey IN "
        f"(SELECT c_custkey FROM customer WHERE {_CHANGED})"
    )
    + f"""
UNION ALL SELECT 'dim_baby', count(*) + 1 + count(*) FILTER ({_CHANGED}) FROM customer""")
def star_incremental_counts(spark: SparkSession, path: str) -> DataFrame:
    """Rows of every table after an initial load of the past and one update."""
    return _counts(_updated(spark, path), TABLES)


def _updated(spark: SparkSession, path: str) -> Warehouse:
    """A warehouse after an initial load of the past and one update.

    The update sees all operational rows, extracts those past its marks, finds
    subjects that moved to another zone and a file of newer amounts.
    """
    root = workspace(spark, "star")
    events, orders = table(spark, path, "events"), table(spark, path, "orders")
    zone = F.expr(SEGMENT_ZONE)
    first = _sources(
        spark, path, root, "initial", events.where(f"ts < '{EVENT_CUT}'"),
        orders.where(f"o_orderdate < '{ORDER_CUT}'"), zone,
    )
    wh = Warehouse(spark, f"{root}/warehouse", FIRST_RUN)
    initial_load(wh, first, FIRST_RUN)

    moved = F.when(F.col("c_acctbal") < 0, F.lit("UTC")).otherwise(zone)
    newer = _sources(
        spark, path, root, "incremental", events.where(f"ts >= '{EVENT_CUT}'"), orders, moved
    )
    wh = Warehouse(spark, f"{root}/warehouse", SECOND_RUN)
    incremental_load(wh, newer, SECOND_RUN)
    return wh


# A fact key goes to the earliest event, then to the highest source id (text in the file's table). Events of the
# update refer to the version that it opened, as all of them lie before the first one began.
_FACT = """
SELECT '{name}' AS name, nk AS baby_nk, NOT (old AND nk IN (SELECT c_custkey FROM customer WHERE {changed})) AS is_open,
       CAST(strftime(happened, '%Y%m%d') AS INTEGER) AS date_sk, CAST(strftime(happened, '%H%M') AS INTEGER) AS time_sk, measure
FROM (SELECT *, row_number() OVER (PARTITION BY nk, date_trunc('minute', happened) ORDER BY happened, id DESC) AS place FROM ({events}))
WHERE place = 1"""
_EVENTS = f"CAST(user_id AS INTEGER) AS nk, ts < TIMESTAMP '{EVENT_CUT}' AS old"


@query(" UNION ALL ".join(_FACT.format(name=name, changed=_CHANGED, events=events) for name, events in {
    "fact_sleep": f"""
SELECT CAST(o_custkey AS INTEGER) AS nk, o_orderdate < TIMESTAMP '{ORDER_CUT}' AS old, o_orderkey AS id,
       o_orderdate + to_minutes(CAST(o_orderkey % 1440 AS INTEGER)) AS happened, CAST(o_orderkey % 600 AS VARCHAR) AS measure FROM orders""",
    "fact_diaper": f"SELECT {_EVENTS}, event_id AS id, date_trunc('second', ts) AS happened, event_type AS measure FROM events",
    "fact_formula_feed": f"""
SELECT {_EVENTS}, CAST(event_id AS VARCHAR) AS id, date_trunc('minute', ts) AS happened,
       CAST(CAST(floor(value) AS INTEGER) AS VARCHAR) AS measure FROM events WHERE event_id % 37 <> 0""",
}.items()))
def star_fact_rows(spark: SparkSession, path: str) -> DataFrame:
    """All facts after an initial load and an update, with the subject instead of its surrogate key."""
    wh = _updated(spark, path)
    versions = wh.tables.read("dim_baby").select("baby_sk", "baby_nk", F.col("is_current").alias("is_open"))
    facts = [
        wh.tables.read(f.table).select(
            F.lit(f.table).alias("name"), "baby_sk", F.col(f.date_sk).alias("date_sk"), F.col(f.time_sk).alias("time_sk"),
            F.col(f.target).cast("string").alias("measure"),
        )
        for f in FACTS
    ]
    rows = facts[0].unionByName(facts[1]).unionByName(facts[2])
    return rows.join(versions, "baby_sk", "left").drop("baby_sk")


@query(f"""
SELECT 'dim_baby' AS name, CAST(c_custkey AS VARCHAR) AS member, c_name AS label, {SEGMENT_ZONE} AS zone, NOT ({_CHANGED}) AS is_open
FROM customer
UNION ALL SELECT 'dim_baby', CAST(c_custkey AS VARCHAR), c_name, 'UTC', true FROM customer WHERE {_CHANGED}
UNION ALL SELECT 'dim_baby', '-1', '{UNKNOWN_SUBJECT[0]}', '{UNKNOWN_SUBJECT[1]}', true
UNION ALL SELECT DISTINCT 'dim_diaper_status', event_type, event_type, NULL, NULL FROM events
UNION ALL SELECT 'dim_diaper_status', '{UNKNOWN_STATUS[0]}', '{UNKNOWN_STATUS[1]}', NULL, NULL""")
def star_dim_rows(spark: SparkSession, path: str) -> DataFrame:
    """Members of both dimensions that events lead to, with all versions, after an initial load and an update."""
    wh = _updated(spark, path)
    subjects = wh.tables.read("dim_baby").select(
        F.lit("dim_baby").alias("name"), F.col("baby_nk").cast("string").alias("member"),
        F.col("baby_name").alias("label"), F.col("timezone_iana").alias("zone"), F.col("is_current").alias("is_open"),
    )
    statuses = wh.tables.read("dim_diaper_status").select(
        F.lit("dim_diaper_status").alias("name"), F.col("diaper_status_sk").alias("member"), F.col("diaper_status").alias("label")
    )
    return subjects.unionByName(statuses, allowMissingColumns=True)


@query("""
SELECT CAST(event_id AS INTEGER) AS source_id, ts AS change_time, event_type AS status,
       CAST(user_id AS INTEGER) AS baby_id FROM events""")
def stream_file_ingest(spark: SparkSession, path: str) -> DataFrame:
    """Landed event files staged by a stream; a second run finds nothing new."""
    root = workspace(spark, "stream")
    wh = Warehouse(spark, f"{root}/warehouse", FIRST_RUN)
    schema = table(spark, path, "events").schema
    for _ in range(2):
        files = landed_files(spark, path, schema, "parquet", "events.parquet").select(
            F.col("event_id").alias("id"), F.col("ts").alias("change_time"),
            F.col("event_type").alias("status"), F.col("user_id").alias("baby_id"),
        )
        ingest_available(wh, files, "stg_diaper", STATUS_TABLE, f"{root}/checkpoint")
    return wh.tables.read("stg_diaper").select(
        "source_id", F.col("change_time").cast("timestamp_ntz").alias("change_time"), "status", "baby_id"
    )
