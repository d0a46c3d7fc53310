"""Tables laid out by key, snapshots compared by digests, and records that span lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.catalog import query, table
from tidemark.operators.digests import Layout, changes_since, write_snapshot
from tidemark.session import workspace
from tidemark.sinks.clustered import write_clustered
from tidemark.sinks.tables import Tables
from tidemark.sources.readers import keyed_children as children_of_one, lookup_few
from tidemark.sources.records import read_quoted_csv

# Orders since this instant change between the two snapshots.
CHANGED_FROM = "1998-01-01"


@query(f"""
WITH changed AS (SELECT *, o_orderdate >= TIMESTAMP '{CHANGED_FROM}' AS late FROM orders)
SELECT 'U' AS op, o_orderkey, o_custkey, o_orderstatus, o_totalprice + 1 AS o_totalprice FROM changed WHERE late AND o_orderkey % 10 = 0
UNION ALL SELECT 'D', o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM changed WHERE late AND o_orderkey % 10 = 1
UNION ALL SELECT 'I', o_orderkey + 1000000000, o_custkey, o_orderstatus, o_totalprice FROM changed WHERE late AND o_orderkey % 10 = 2""")
def snapshot_changes(spark: SparkSession, path: str) -> DataFrame:
    """What a full reload of the orders changed; months without a change are neither opened nor joined."""
    layout = Layout(
        ("o_orderkey",), ("o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate"), F.date_format("o_orderdate", "yyyyMM")
    )
    old = table(spark, path, "orders").select(*layout.key, *layout.columns)
    store = workspace(spark, "snapshot")
    write_snapshot(old, store, layout)
    late, digit = F.col("o_orderdate") >= F.lit(CHANGED_FROM).cast("timestamp_ntz"), F.col("o_orderkey") % 10
    price = F.when(late & (digit == 0), F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice"))
    new = old.where(~late | (digit != 1)).withColumn("o_totalprice", price)
    new = new.unionByName(old.where(late & (digit == 2)).withColumn("o_orderkey", F.col("o_orderkey") + 1_000_000_000))
    return changes_since(new, store, layout).drop("o_orderdate")


@query("""
SELECT c_custkey, CASE WHEN c_custkey % 100 = 0 THEN 'moved' ELSE c_name END AS c_name FROM customer
UNION ALL SELECT c_custkey + 1000000000, 'new' FROM customer WHERE c_custkey % 100 = 1""")
def bucket_merge(spark: SparkSession, path: str) -> DataFrame:
    """One percent of the customers changed and as many came: only the buckets they lie in are read and written."""
    customers = table(spark, path, "customer").select("c_custkey", "c_name")
    tables = Tables(spark, workspace(spark, "buckets"), bucketed={"dim": ("c_custkey", 64)})
    tables.replace("dim", customers, run=1)
    moved = customers.where("c_custkey % 100 = 0").withColumn("c_name", F.lit("moved"))
    came = customers.where("c_custkey % 100 = 1").select((F.col("c_custkey") + 1_000_000_000).alias("c_custkey"), F.lit("new").alias("c_name"))
    changes = moved.unionByName(came)
    touched = [r[0] for r in changes.select(tables.bucket("dim")).distinct().collect()]
    present = tables.read("dim", customers.schema, touched).join(changes.select("c_custkey"), "c_custkey", "left_anti")
    tables.replace_buckets("dim", present.unionByName(changes), run=2)
    return tables.read("dim", customers.schema)


def orders_by_customer(spark: SparkSession, path: str) -> DataFrame:
    """The orders, written in ranges of their customer."""
    target = workspace(spark, "clustered")
    orders = table(spark, path, "orders").select("o_custkey", "o_orderkey", "o_totalprice")
    write_clustered(orders, target, "o_custkey", ["o_orderkey"], files=16, distinct=100_000)
    return spark.read.schema(orders.schema).parquet(target)


@query("""
SELECT o_custkey, o_orderkey, o_totalprice FROM orders
WHERE o_custkey = (SELECT o_custkey FROM orders GROUP BY o_custkey ORDER BY count(*) DESC, o_custkey LIMIT 1)""")
def keyed_children(spark: SparkSession, path: str) -> DataFrame:
    """All orders of the customer that has most of them, in id order; other ranges of customers are skipped."""
    orders = orders_by_customer(spark, path)
    per_customer = orders.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"))
    busiest = per_customer.agg(F.max_by("o_custkey", F.struct("n", -F.col("o_custkey")))).first()[0]
    return children_of_one(orders, "o_custkey", busiest, "o_orderkey")


@query("""
SELECT r.o_custkey, o.o_orderkey, o.o_totalprice
FROM (SELECT c_custkey + k * 1000000000 AS o_custkey
      FROM (SELECT c_custkey FROM customer ORDER BY c_acctbal DESC, c_custkey LIMIT 20), (VALUES (0), (1)) v(k)) r
LEFT JOIN orders o USING (o_custkey)""")
def keyed_lookup(spark: SparkSession, path: str) -> DataFrame:
    """Orders of the twenty customers with the highest balance, and of twenty that don't exist."""
    top = table(spark, path, "customer").orderBy(F.desc("c_acctbal"), "c_custkey").limit(20)
    requests = top.select(F.explode(F.array("c_custkey", F.col("c_custkey") + 1_000_000_000)).alias("o_custkey"))
    return lookup_few(requests, orders_by_customer(spark, path), "o_custkey")


@query("SELECT CAST(doc_id AS VARCHAR) AS doc_id, text, lang FROM documents")
def quoted_csv(spark: SparkSession, path: str) -> DataFrame:
    """Documents written as CSV, their line breaks inside quotes, and read by many tasks."""
    target = workspace(spark, "quoted")
    docs = table(spark, path, "documents").select("doc_id", "text", "lang")
    kept = {"ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false", "escape": '"'}
    docs.write.option("header", True).options(**kept).csv(target)
    return read_quoted_csv(spark, target)
