"""Reading and writing: file formats, fan-out, marks, partitions, keyed reads."""

from __future__ import annotations

from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.catalog import query, table
from tidemark.functions.coerce import add_typed, instant_steps, iso_seconds, typed_names
from tidemark.functions.keys import date_key, month_key
from tidemark.operators.lineage import only_batches
from tidemark.sinks.tables import Tables, read_fact
from tidemark.sources import after_mark, fan_out, listing, lookup, read_csv, read_source
from tidemark.sources.ranges import range_predicates, read_in_ranges
from tidemark.session import workspace

# Fixed stand-in for the instant up to which events were loaded before.
MARK = datetime(2024, 1, 15)


@query("""
SELECT CAST(event_id AS VARCHAR) AS "ID", 'a, "' || event_type || '"' AS "Note",
       CASE WHEN event_id % 5 = 0 THEN NULL ELSE strftime(ts, '%d.%m.%Y, %H:%M') END AS "Time"
FROM events""")
def csv_roundtrip(spark: SparkSession, path: str) -> DataFrame:
    """CSV with quoted commas and quotes; empty fields read NULL."""
    target = workspace(spark, "csv")
    table(spark, path, "events").select(
        F.col("event_id").alias("ID"),
        F.concat(F.lit('a, "'), "event_type", F.lit('"')).alias("Note"),
        F.when(F.col("event_id") % 5 != 0, F.date_format("ts", "dd.MM.yyyy, HH:mm")).alias("Time"),
    ).write.option("header", True).option("escape", '"').csv(target)
    return read_csv(spark, target)


@query("""
SELECT CAST(event_id AS VARCHAR) AS id, CAST(user_id AS VARCHAR) AS baby_id, event_type AS status,
       date_trunc('second', ts) AS change_time FROM events""")
def json_documents(spark: SparkSession, path: str) -> DataFrame:
    """JSON lines with numbers, read as text and typed afterwards."""
    target = workspace(spark, "json")
    table(spark, path, "events").select(
        F.col("event_id").alias("id"), F.col("user_id").alias("baby_id"),
        F.col("event_type").alias("status"),
        F.concat(iso_seconds(F.col("ts")), F.lit("+00:00")).alias("change_time"),
        F.lit("ignored").alias("extra"),
    ).write.json(target)
    docs = read_source(
        spark, "API", path=target, columns=["id", "baby_id", "status", "change_time"]
    )
    typed = add_typed(docs, instant_steps(F.col("change_time"), "t"))
    moment = F.col(typed_names("t").value).cast("timestamp_ntz")
    return typed.select("id", "baby_id", "status", moment.alias("change_time"))


@query("""
SELECT CAST(c_nationkey AS INTEGER) AS parent_id, CAST(c_custkey AS VARCHAR) AS id, c_name AS name
FROM customer WHERE c_nationkey IN (SELECT n_nationkey FROM nation WHERE n_regionkey <> 0)""")
def parent_fanout(spark: SparkSession, path: str) -> DataFrame:
    """Documents kept per parent, read in one scan for a list of parents."""
    target = workspace(spark, "fanout")
    table(spark, path, "customer").select(
        F.col("c_nationkey").alias("parent_id"), F.col("c_custkey").alias("id"),
        F.col("c_name").alias("name"),
    ).write.partitionBy("parent_id").json(target)
    parents = table(spark, path, "nation").where("n_regionkey <> 0").select("n_nationkey")
    return fan_out(spark, target, ["id", "name"], "parent_id", parents).select(
        "parent_id", "id", "name"
    )


@query("SELECT DISTINCT user_id AS source_id FROM events")
def distinct_ids(spark: SparkSession, path: str) -> DataFrame:
    return table(spark, path, "events").select(F.col("user_id").alias("source_id")).distinct()


@query("SELECT c_custkey AS id, c_name AS name, c_mktsegment AS segment FROM customer")
def projected_scan(spark: SparkSession, path: str) -> DataFrame:
    """Subjects with the columns a load needs; the scan reads no others."""
    return table(spark, path, "customer").select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("name"),
        F.col("c_mktsegment").alias("segment"),
    )


@query("SELECT event_id, ts, user_id, value FROM events WHERE ts > TIMESTAMP '2024-01-15'")
def hwm_extract(spark: SparkSession, path: str) -> DataFrame:
    """Events past the high-water mark; the comparison reaches the scan."""
    events = table(spark, path, "events").select("event_id", "ts", "user_id", "value")
    return after_mark(events, "ts", MARK)


@query("SELECT event_id, ts, user_id, value FROM events")
def full_extract(spark: SparkSession, path: str) -> DataFrame:
    """Without a mark everything is extracted."""
    events = table(spark, path, "events").select("event_id", "ts", "user_id", "value")
    return after_mark(events, "ts", None)


@query("SELECT event_id, ts, user_id, value FROM events")
def range_extract(spark: SparkSession, path: str) -> DataFrame:
    """A full extract in sixteen ranges of the subject with about equally many rows; each row comes once."""
    events = table(spark, path, "events").select("event_id", "ts", "user_id", "value")
    parts = read_in_ranges(events, range_predicates(events, "user_id", 16, then="event_id"))
    return reduce(DataFrame.unionAll, parts)


@query("SELECT o_custkey, o_orderkey, o_totalprice FROM orders")
def children_of(spark: SparkSession, path: str) -> DataFrame:
    """Children of every parent in id order."""
    return (
        table(spark, path, "orders")
        .select("o_custkey", "o_orderkey", "o_totalprice")
        .orderBy("o_custkey", "o_orderkey")
    )


@query("""
SELECT r.c_custkey, c.c_name FROM (SELECT DISTINCT o_custkey * 2 AS c_custkey FROM orders) r
LEFT JOIN customer c USING (c_custkey)""")
def lookup_batch(spark: SparkSession, path: str) -> DataFrame:
    """Rows by id, NULL for ids that do not exist."""
    requests = (
        table(spark, path, "orders").select((F.col("o_custkey") * 2).alias("c_custkey")).distinct()
    )
    return lookup(requests, table(spark, path, "customer").select("c_custkey", "c_name"), "c_custkey")


@query("SELECT c_custkey, c_name FROM customer")
def ordered_listing(spark: SparkSession, path: str) -> DataFrame:
    return listing(table(spark, path, "customer").select("c_custkey", "c_name"), "c_custkey")


@query("""
SELECT o_orderkey, CAST(strftime(o_orderdate, '%Y%m%d') AS INTEGER) AS date_sk,
       CAST(strftime(o_orderdate, '%Y%m') AS INTEGER) AS month_sk, o_totalprice
FROM orders WHERE strftime(o_orderdate, '%Y%m%d') BETWEEN '19970115' AND '19980310'""")
def partition_pruned_scan(spark: SparkSession, path: str) -> DataFrame:
    """A fact table partitioned by month, read for a range of dates."""
    tables = Tables(spark, workspace(spark, "months"))
    keys = table(spark, path, "orders").select(
        "o_orderkey", date_key(F.col("o_orderdate")).alias("date_sk"), "o_totalprice"
    )
    rows = keys.withColumn("month_sk", month_key(F.col("date_sk")))
    tables.replace("fact_orders", rows, ["month_sk"])
    return read_fact(tables.read("fact_orders", rows.schema), "date_sk", 19970115, 19980310)


@query("""
SELECT event_id, event_type, CAST(day(ts) AS INTEGER) AS job_id FROM events""")
def staging_append(spark: SparkSession, path: str) -> DataFrame:
    """Batches appended to a table; one batch is written twice and counts once."""
    tables = Tables(spark, workspace(spark, "staging"))
    rows = table(spark, path, "events").select(
        "event_id", "event_type", F.dayofmonth("ts").alias("job_id")
    )
    tables.append("stg_event", rows.where("job_id <= 10"), ["job_id"])
    tables.append("stg_event", rows.where("job_id > 10"), ["job_id"])
    tables.append("stg_event", rows.where("job_id = 15"), ["job_id"])
    return tables.read("stg_event", rows.schema)


@query("""
SELECT event_type, count(*) AS n FROM events WHERE ts >= TIMESTAMP '2024-01-15' GROUP BY event_type""")
def versioned_replace(spark: SparkSession, path: str) -> DataFrame:
    """A table replaced by a result computed from its own previous version."""
    tables = Tables(spark, workspace(spark, "versions"))
    events = table(spark, path, "events").select("event_type", "ts")
    tables.replace("recent", events, [])
    tables.replace("recent", tables.read("recent", events.schema).where("ts >= '2024-01-15'"), [])
    return tables.read("recent", events.schema).groupBy("event_type").agg(
        F.count(F.lit(1)).alias("n")
    )


@query("""
SELECT event_id, event_type FROM events WHERE day(ts) > 15""")
def batch_semi_join(spark: SparkSession, path: str) -> DataFrame:
    """Staged rows of a list of batches; other batch partitions are not read."""
    tables = Tables(spark, workspace(spark, "batches"))
    rows = table(spark, path, "events").select(
        "event_id", "event_type", F.dayofmonth("ts").alias("job_id")
    )
    tables.replace("stg_event", rows, ["job_id"])
    batches = rows.select("job_id").distinct().where("job_id > 15")
    return only_batches(tables.read("stg_event", rows.schema), batches).select(
        "event_id", "event_type"
    )
