"""The run ledger as data, and the change feed."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.catalog import query, table
from tidemark.operators import lineage
from tidemark.operators.batches import load_everything
from tidemark.operators.changes import apply_changes
from tidemark.operators.skew import hot_keys
from tidemark.session import materialise


def order_log(spark: SparkSession, path: str) -> DataFrame:
    """Orders read as states of runs: the customer is the run, the order its state."""
    return table(spark, path, "orders").select(
        F.col("o_custkey").alias("job_id"), F.col("o_orderkey").alias("seq"),
        F.col("o_orderpriority").alias("task_id"), F.col("o_orderdate").alias("ended_at"),
        F.expr("CASE o_orderstatus WHEN 'F' THEN 'success' WHEN 'O' THEN 'running' ELSE 'failed' END").alias(
            "status"
        ),
        F.concat(F.lit("file-"), (F.col("o_orderkey") % 1000).cast("string")).alias("data_source_path"),
    )


_LOG = """
log AS (SELECT o_custkey AS job_id, o_orderkey AS seq, o_orderpriority AS task_id, o_orderdate AS ended_at,
               CASE o_orderstatus WHEN 'F' THEN 'success' WHEN 'O' THEN 'running' ELSE 'failed' END AS status,
               'file-' || CAST(o_orderkey % 1000 AS VARCHAR) AS data_source_path FROM orders)"""


@query(f"""
WITH {_LOG} SELECT job_id, seq, task_id, CAST(ended_at AS TIMESTAMP) AS ended_at, status FROM (
  SELECT *, row_number() OVER (PARTITION BY job_id ORDER BY seq DESC) AS rn FROM log) WHERE rn = 1""")
def ledger_latest(spark: SparkSession, path: str) -> DataFrame:
    """The current state of every run."""
    log = order_log(spark, path).drop("data_source_path").withColumn("order", F.col("seq"))
    return lineage.latest_state(log, order="order").drop("order")


@query(f"""
WITH {_LOG} SELECT task_id, arg_max(job_id, (ended_at, job_id)) AS job_id FROM log WHERE status = 'success'
GROUP BY task_id""")
def ledger_last_success(spark: SparkSession, path: str) -> DataFrame:
    """The last successful run of every destination."""
    return lineage.last_success_per(order_log(spark, path), ["task_id"], "job_id")


@query("""
SELECT event_type AS task_id, max(ts) AS mark FROM events
WHERE day(ts) = (SELECT max(day(ts)) FROM events) GROUP BY event_type""")
def ledger_last_mark(spark: SparkSession, path: str) -> DataFrame:
    """The mark left by the last batch of every feed."""
    runs = (
        table(spark, path, "events")
        .groupBy(F.col("event_type").alias("task_id"), F.dayofmonth("ts").alias("job_id"))
        .agg(F.max("ts").alias("mark"))
        .withColumns({"ended_at": F.col("mark"), "status": F.lit("success")})
    )
    return lineage.last_success_per(runs, ["task_id"], "mark")


@query(f"""
WITH {_LOG} SELECT DISTINCT task_id, CAST(ended_at AS TIMESTAMP) AS logical_date FROM log l
WHERE EXISTS (SELECT 1 FROM log d WHERE d.status = 'success' AND d.task_id = l.task_id AND d.ended_at = l.ended_at)""")
def ledger_dedup(spark: SparkSession, path: str) -> DataFrame:
    """Of all requested runs (task, logical date), those already done."""
    log = order_log(spark, path).withColumnRenamed("ended_at", "logical_date")
    key = ["task_id", "logical_date"]
    done = log.where("status = 'success'").select(*key)
    return log.select(*key).distinct().join(done, key, "left_semi")


@query(f"""
WITH {_LOG} SELECT task_id, CAST(ended_at AS TIMESTAMP) AS logical_date, max(job_id) AS job_id FROM log
WHERE status = 'running' GROUP BY ALL""")
def ledger_running(spark: SparkSession, path: str) -> DataFrame:
    """The newest attempt still running for each (task, logical date)."""
    running = order_log(spark, path).where("status = 'running'")
    return running.groupBy("task_id", F.col("ended_at").alias("logical_date")).agg(
        F.max("job_id").alias("job_id")
    )


@query(f"""
WITH {_LOG} SELECT data_source_path, bool_or(status = 'success') AS is_loaded FROM log GROUP BY 1""")
def ledger_file_loaded(spark: SparkSession, path: str) -> DataFrame:
    """Whether each file was loaded by some successful run."""
    return order_log(spark, path).groupBy("data_source_path").agg(
        F.bool_or(F.col("status") == "success").alias("is_loaded")
    )


@query("SELECT CAST(day(ts) AS INTEGER) AS job_id, count(*) AS n_rows, max(ts) AS mark FROM events GROUP BY 1")
def batch_max_ts(spark: SparkSession, path: str) -> DataFrame:
    """Rows and newest event time of every batch."""
    return table(spark, path, "events").groupBy(F.dayofmonth("ts").alias("job_id")).agg(
        F.count(F.lit(1)).alias("n_rows"), F.max("ts").alias("mark")
    )


@query("SELECT CAST(year(o_orderdate) AS INTEGER) AS job_id, count(*) AS n_rows FROM orders GROUP BY 1")
def rows_by_job(spark: SparkSession, path: str) -> DataFrame:
    return table(spark, path, "orders").groupBy(F.year("o_orderdate").alias("job_id")).agg(
        F.count(F.lit(1)).alias("n_rows")
    )


def event_runs(spark: SparkSession, path: str) -> DataFrame:
    """A ledger made of the event batches.

    Each day was extracted by a run. Loads into the core table followed for
    the days on which users signed up before the fifteenth.
    """
    days = table(spark, path, "events").groupBy(F.dayofmonth("ts").alias("day")).agg(
        F.max("ts").alias("ended_at"), F.count_if(F.col("event_type") == "signup").alias("signups")
    )
    shared = {"status": F.lit("success"), "ended_at": F.col("ended_at")}
    extracts = days.select(
        F.col("day").alias("job_id"), F.lit("staging").alias("destination_schema"),
        F.lit("stg_event").alias("destination_table_name"), F.lit("extract").alias("pipeline_stage"),
        F.lit(None).cast("int").alias("parent_job_id"), *[c.alias(n) for n, c in shared.items()],
    )
    loads = days.where("day < 15 AND signups > 0").select(
        (F.col("day") + 1000).alias("job_id"), F.lit("core").alias("destination_schema"),
        F.lit("fact_event").alias("destination_table_name"),
        F.lit("transform_load").alias("pipeline_stage"), F.col("day").alias("parent_job_id"),
        *[c.alias(n) for n, c in shared.items()],
    )
    return extracts.unionByName(loads)


@query("""
WITH loaded AS (SELECT max(day(ts)) AS d FROM events WHERE event_type = 'signup' AND day(ts) < 15)
SELECT CAST(day(ts) AS INTEGER) AS job_id, count(*) AS n_rows FROM events, loaded
WHERE day(ts) > coalesce(loaded.d, 0) GROUP BY 1""")
def new_batches(spark: SparkSession, path: str) -> DataFrame:
    """Batches a core table has not seen yet, with their rows."""
    found = lineage.new_batches(event_runs(spark, path), "stg_event", "fact_event")
    staged = table(spark, path, "events").select(F.dayofmonth("ts").alias("job_id"))
    return lineage.only_batches(staged, found).groupBy("job_id").agg(
        F.count(F.lit(1)).alias("n_rows")
    )


@query("SELECT CAST(day(ts) AS INTEGER) AS job_id FROM events GROUP BY 1")
def new_batches_first(spark: SparkSession, path: str) -> DataFrame:
    """Before its first load a core table has not seen any batch."""
    return lineage.new_batches(event_runs(spark, path), "stg_event", "fact_other")


LOADS = [f"{year}-01-01" for year in (1994, 1995, 1997, 1999)]
# Orders read as extracts: they end on their date, except those of status P,
# which are resumed and end 400 days later, and those of status O, which stay
# open. Their ids are in no order of time, so nearly every load has late batches.
_ENDS = "CASE o_orderstatus WHEN 'F' THEN o_orderdate WHEN 'P' THEN o_orderdate + INTERVAL 400 DAY END"


def loads_of_orders(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Batches with the load that took them, and the sets after the last load, for five core tables."""
    orders = table(spark, path, "orders")
    ends = F.when(F.col("o_orderstatus") == "F", F.col("o_orderdate")).when(
        F.col("o_orderstatus") == "P", F.col("o_orderdate") + F.expr("INTERVAL 400 DAY")
    )
    runs = orders.select(F.col("o_orderpriority").alias("table"), F.col("o_orderkey").alias("job_id"), ends.alias("ends"))
    kind = runs.schema["job_id"].dataType.simpleString()
    loaded = spark.createDataFrame([], f"table string, first {kind}, last {kind}")
    hot, taken = hot_keys(runs, "table", "job_id"), []
    for when in LOADS:
        status = F.when(F.col("ends") < F.lit(when).cast("timestamp_ntz"), "success").otherwise("running")
        now = runs.select("table", "job_id", status.alias("status"))
        fresh, after = load_everything(now, loaded, "table", hot)
        taken.append(materialise(fresh.select("table", "job_id", F.lit(when).alias("load")), "taken"))
        loaded = materialise(after, "loaded")
    return reduce(DataFrame.unionByName, taken), loaded


@query(f"""
SELECT o_orderpriority AS "table", o_orderkey AS job_id,
       (SELECT min(w) FROM (VALUES {", ".join(f"('{w}')" for w in LOADS)}) loads(w) WHERE CAST(w AS TIMESTAMP) > ends) AS load
FROM (SELECT *, {_ENDS} AS ends FROM orders) WHERE ends < TIMESTAMP '{LOADS[-1]}'""")
def late_batches(spark: SparkSession, path: str) -> DataFrame:
    """Every batch with the load that took it; batches end in any order and load once each."""
    return loads_of_orders(spark, path)[0]


@query(f"""
WITH runs AS (
  SELECT o_orderpriority AS "table", o_orderkey AS id, coalesce({_ENDS} < TIMESTAMP '{LOADS[-1]}', false) AS done FROM orders),
marked AS (
  SELECT *, row_number() OVER (PARTITION BY "table" ORDER BY id) - row_number() OVER (PARTITION BY "table", done ORDER BY id) AS island
  FROM runs)
SELECT "table", min(id) AS first, max(id) AS last FROM marked WHERE done GROUP BY "table", island""")
def loaded_sets(spark: SparkSession, path: str) -> DataFrame:
    """What each table has loaded, as ranges between runs that are still open."""
    return loads_of_orders(spark, path)[1]


@query("""
WITH feed AS (
  SELECT o_custkey * 2 AS key, o_orderkey AS seq,
         CASE o_orderstatus WHEN 'F' THEN 'I' WHEN 'O' THEN 'U' ELSE 'D' END AS op,
         'name-' || CAST(o_orderkey AS VARCHAR) AS name,
         CASE WHEN o_orderpriority = '5-LOW' THEN NULL ELSE o_totalprice END AS balance
  FROM orders),
gone AS (SELECT key, max(seq) FILTER (op = 'D') AS d FROM feed GROUP BY key),
birth AS (SELECT f.key, min(f.seq) AS b FROM feed f JOIN gone g USING (key)
          WHERE f.op = 'I' AND f.seq > coalesce(g.d, -1) GROUP BY f.key),
start AS (
  SELECT coalesce(t.c_custkey, g.key) AS key, t.c_custkey IS NOT NULL AND g.d IS NULL AS kept, b.b,
         t.c_name, t.c_acctbal
  FROM customer t FULL JOIN gone g ON g.key = t.c_custkey LEFT JOIN birth b ON b.key = g.key),
alive AS (
  SELECT s.key, CASE WHEN kept THEN -1 ELSE b END AS since,
         CASE WHEN kept THEN c_name ELSE i.name END AS name,
         CASE WHEN kept THEN c_acctbal ELSE i.balance END AS balance
  FROM start s LEFT JOIN feed i ON i.key = s.key AND i.seq = s.b AND i.op = 'I'
  WHERE kept OR b IS NOT NULL)
SELECT a.key AS id, coalesce(arg_max(u.name, u.seq), any_value(a.name)) AS name,
       coalesce(arg_max(u.balance, u.seq), any_value(a.balance)) AS balance
FROM alive a LEFT JOIN feed u ON u.key = a.key AND u.op = 'U' AND u.seq > a.since
GROUP BY a.key""")
def change_feed(spark: SparkSession, path: str) -> DataFrame:
    """Inserts, updates and deletes applied to the customers.

    Half of the keys do not exist at first; some rows are deleted and inserted
    again.
    """
    target = table(spark, path, "customer").select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_acctbal").alias("balance")
    )
    feed = table(spark, path, "orders").select(
        (F.col("o_custkey") * 2).alias("id"), F.col("o_orderkey").alias("seq"),
        F.expr("CASE o_orderstatus WHEN 'F' THEN 'I' WHEN 'O' THEN 'U' ELSE 'D' END").alias("op"),
        F.concat(F.lit("name-"), F.col("o_orderkey").cast("string")).alias("name"),
        F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_totalprice")).alias("balance"),
    )
    return apply_changes(target, feed, "id")
