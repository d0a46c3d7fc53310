"""Clustered tables, snapshots by digests, records over several lines, zones."""

import random
import shutil

import pytest
from pyspark.sql import functions as F

from tidemark.functions.coerce import wall_clock_to_utc
from tidemark.operators.digests import Layout, bucket_digests, changed_buckets, changes_since, compare, write_snapshot
from tidemark.operators.rules import known_zone, zone_names
from tidemark.sinks.clustered import write_clustered
from tidemark.sources.readers import keyed_children, lookup, lookup_few
from tidemark.sources.records import read_quoted_csv


def scanned_rows(spark, df):
    """Rows that came out of the file scans of a query, by its metrics."""
    df.collect()
    store = spark._jsparkSession.sharedState().statusStore()
    last = store.executionsList().last().executionId()
    values = store.executionMetrics(last)
    nodes, total = store.planGraph(last).allNodes(), 0
    for i in range(nodes.size()):
        node = nodes.apply(i)
        if node.name().startswith("Scan parquet"):
            for k in range(node.metrics().size()):
                metric = node.metrics().apply(k)
                if metric.name() == "number of output rows":
                    total += int(values.apply(metric.accumulatorId()).replace(",", ""))
    return total


@pytest.fixture(scope="module")
def clustered(spark, tmp_path_factory):
    """20,000 children; parent 7 has a third of them."""
    path = str(tmp_path_factory.mktemp("clustered") / "t")
    rows = spark.range(20_000).select(
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.pmod(F.xxhash64("id"), F.lit(5000))).cast("long").alias("parent"),
        "id", F.sha2(F.col("id").cast("string"), 256).alias("payload"),
    )
    rows = rows.unionByName(spark.createDataFrame([(None, -1, "none")], rows.schema))
    write_clustered(rows, path, "parent", ["id"], files=16, distinct=5000, row_group=32_768)
    return spark.read.schema(rows.schema).parquet(path), rows


def test_reads_by_key_skip_row_groups(spark, clustered):
    stored, rows = clustered
    assert stored.exceptAll(rows).count() == 0 and stored.count() == rows.count()
    one = rows.where("parent > 4000").agg(F.min("parent")).first()[0]
    found = keyed_children(stored, "parent", one, "id")
    assert [r.id for r in found.collect()] == sorted(r.id for r in rows.where(F.col("parent") == one).collect())
    assert 0 < scanned_rows(spark, stored.where(F.col("parent") == one)) < 4000
    assert scanned_rows(spark, stored.where("parent = 5001")) == 0


def test_a_hot_parent_lies_in_several_files(clustered):
    stored, _ = clustered
    spread = stored.where("parent = 7").select(F.input_file_name().alias("f")).groupBy("f").count().collect()
    assert len(spread) > 3 and max(r["count"] for r in spread) < 20_000 / 3 / 2


def test_few_requests_read_few_rows(spark, clustered):
    stored, rows = clustered
    requests = spark.createDataFrame([(11,), (12,), (None,), (99_999,)], "parent long")
    got, plain = lookup_few(requests, stored, "parent"), lookup(requests, rows, "parent")
    assert got.exceptAll(plain).count() == 0 and got.count() == plain.count()
    assert scanned_rows(spark, got) < 6000
    many = lookup_few(rows.select("parent").distinct(), stored, "parent", most=10)
    assert many.count() == rows.where("parent IS NOT NULL").count() + 1


def _layout():
    return Layout(("k",), ("v", "w", "m"), F.col("m"), leaves=8)


def _state(spark, rows):
    return spark.createDataFrame(rows, "k long, v string, w double, m int")


def test_changes_equal_the_full_comparison(spark, tmp_path):
    draw = random.Random(2)
    old = [(k, draw.choice(["a", "b", None]), draw.random(), draw.choice([1, 2, 3, None])) for k in range(400)] + [(None, "z", 0.5, 1)]
    new = [r for r in old if r[0] != 17]
    new[3] = (3, "changed", None, new[3][3])
    new[40] = (*new[40][:3], 2 if new[40][3] != 2 else 3)  # moves to another bucket
    new[41] = (new[41][0], None if new[41][1] else "c", *new[41][2:])
    new.append((1000, "new", 1.0, None))
    layout, path = _layout(), str(tmp_path / "s")
    write_snapshot(_state(spark, old), path, layout)
    got = {tuple(r) for r in changes_since(_state(spark, new), path, layout).collect()}
    whole = {tuple(r) for r in compare(_state(spark, old), _state(spark, new), layout).collect()}
    assert got == whole and {(r[0], r[1]) for r in got} == {("D", 17), ("U", 3), ("U", 41), ("U", 42), ("I", 1000)}
    assert changes_since(_state(spark, old), path, layout).count() == 0
    none = changes_since(_state(spark, []), path, layout)
    assert none.count() == len(old) and none.where("op = 'D'").count() == len(old)


def test_equal_buckets_are_not_opened(spark, tmp_path):
    layout, path = _layout(), str(tmp_path / "s")
    old = [(k, "v", float(k), k % 4) for k in range(200)]
    write_snapshot(_state(spark, old), path, layout)
    for top in (0, 1, 3):  # whoever reads these directories fails
        shutil.rmtree(f"{path}/rows/top={top}")
        (tmp_path / "s" / "rows" / f"top={top}").mkdir()
        (tmp_path / "s" / "rows" / f"top={top}" / "part-0.parquet").write_bytes(b"no parquet file")
    changed = [(k, "w" if k == 2 else v, w, m) for k, v, w, m in old]
    assert [tuple(r) for r in changes_since(_state(spark, changed), path, layout).select("op", "k").collect()] == [("U", 2)]


def test_digests_tell_repeats_and_nulls_apart(spark):
    layout = _layout()

    def of(rows):
        return bucket_digests(layout.bucketed(_state(spark, rows)), layout)

    one, two = [(1, "a", 1.0, 1)], [(1, "a", 1.0, 1)] * 2
    assert changed_buckets(of(one), of(one[::-1])) == {}
    assert list(changed_buckets(of(one), of(two))) == ["1"]
    assert list(changed_buckets(of([]), of(two))) == ["1"]
    assert list(changed_buckets(of([(1, None, 1.0, None)]), of([(1, "null", 1.0, None)]))) == [None]


ODD = [
    ("1", "plain", "x"), ("2", 'said "yes"\nand\n\nleft', "y,z"), ("3", "a\r\nb", ""), ("4", None, "é\n" * 40), ("5", '"', '""'),
    ("6", "\\n is no break", " padded "), ("7", "\n", "end"),
]


def test_quoted_breaks_read_by_many_tasks(spark, tmp_path):
    draw = random.Random(4)
    rows = ODD + [(str(i), "\n".join("ab, " * draw.randint(0, 9) for _ in range(draw.randint(1, 6))), "t") for i in range(10, 900)]
    frame = spark.createDataFrame(rows, "id string, text string, more string")
    options = {"header": "true", "escape": '"', "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
    frame.coalesce(1).write.options(**options).csv(str(tmp_path / "one"))
    frame.where("id < '3'").coalesce(1).write.options(**options).csv(str(tmp_path / "two"))
    paths = [str(tmp_path / p) for p in ("one", "two")]
    whole = spark.read.options(**options, multiLine="true").csv(paths)
    kept = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2048")
    try:
        assert spark.read.text(paths).rdd.getNumPartitions() > 20
        got = read_quoted_csv(spark, paths)
        assert got.columns == ["id", "text", "more"]
        assert got.exceptAll(whole).count() == 0 and whole.exceptAll(got).count() == 0
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", kept)


def test_headers(spark, tmp_path):
    (tmp_path / "a.csv").write_text("\ufeffid,\"two\nlines\"\n1,x\n", encoding="utf-8")
    got = read_quoted_csv(spark, str(tmp_path / "a.csv"))
    assert got.columns == ["id", "two\nlines"] and [tuple(r) for r in got.collect()] == [("1", "x")]
    (tmp_path / "b.csv").write_text("id,other\n1,x\n")
    with pytest.raises(ValueError, match="header"):
        read_quoted_csv(spark, str(tmp_path))
    (tmp_path / "empty").mkdir()
    (tmp_path / "empty" / "c.csv").write_text("")
    assert read_quoted_csv(spark, str(tmp_path / "empty")).count() == 0


def test_zones_that_pass_the_rule_can_be_converted(spark):
    names = spark.createDataFrame([(z,) for z in [*zone_names(), "localtime", "Factory", "ROC", "Mars/Base"]], "zone string")
    passed = names.where(known_zone("zone").passes)
    assert passed.count() == len(zone_names()) > 400
    assert not passed.where("zone IN ('localtime', 'Factory', 'ROC', 'Mars/Base')").count()
    at = F.lit("2024-05-01 10:00:00").cast("timestamp_ntz")
    assert passed.select(F.to_utc_timestamp(at, F.col("zone")).alias("t")).where("t IS NULL").count() == 0
    assert spark.range(1).select(wall_clock_to_utc(at, "Asia/Tokyo").alias("t")).first().t is not None


def test_only_touched_buckets_are_written(spark, tmp_path):
    from tidemark.sinks.tables import Tables

    failed: set[int] = set()
    tables = Tables(spark, str(tmp_path / "t"), lambda: failed, {"dim": ("k", 64)})
    rows = spark.range(3000).select(F.col("id").alias("k"), F.lit("old").alias("v"))
    tables.replace("dim", rows, run=1)
    before = {p: p.stat().st_mtime_ns for p in tmp_path.rglob("*.parquet")}

    def change(run, keys):
        some = rows.where(F.col("k").isin(keys)).withColumn("v", F.lit(f"run {run}"))
        touched = [r[0] for r in some.select(tables.bucket("dim")).distinct().collect()]
        rest = tables.read("dim", rows.schema, touched).join(some.select("k"), "k", "left_anti")
        return len(touched), tables.replace_buckets("dim", rest.unionByName(some), run, {"n": F.count_if(F.col("v") == f"run {run}")})

    n, seen = change(2, [5, 6, 7])
    assert seen["n"] == 3 and seen["rows"] < 3000 / 64 * 3 * 2
    after = {p: p.stat().st_mtime_ns for p in tmp_path.rglob("*.parquet")}
    assert all(after[p] == t for p, t in before.items())  # no file was touched, n buckets have a second copy
    assert len({p.parent for p in after if p not in before}) == n <= 3
    assert tables.read("dim", rows.schema).where("v = 'run 2'").count() == 3 and tables.read("dim", rows.schema).count() == 3000

    failed.add(3)  # this run doesn't end well: its copies don't count, and are removed
    change(3, [5, 900])
    assert {r.v for r in tables.read("dim", rows.schema).collect()} == {"old", "run 2"}
    tables.discard("dim", 3)
    assert not list(tmp_path.rglob("run=3"))
    failed.clear()
    assert tables.read("dim", rows.schema).where("v = 'run 2'").count() == 3
