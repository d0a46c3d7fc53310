"""Readers, tables, ledger helpers and the streaming ingest."""

from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from tidemark.operators import rules as r
from tidemark.plans import mappings as m
from tidemark.plans.operational import feed_events, feed_subjects, import_history
from tidemark.plans.staging import Warehouse
from tidemark.sinks.tables import Tables
from tidemark.sources import after_mark, keyed_children, read_csv, read_json, read_source
from tidemark.sources.readers import jdbc_options, text_schema
from tidemark.streaming.file_ingest import ingest_available, landed_files

UTC = timezone.utc


def test_csv_with_mark_quotes_and_short_rows(spark, tmp_path):
    file = tmp_path / "a.csv"
    file.write_text('﻿ID,Time,Note\n1,"02.03.2026, 06:20","say ""hi"""\n2\n', encoding="utf-8")
    rows = [tuple(x) for x in read_csv(spark, str(file)).orderBy("ID").collect()]
    assert rows == [("1", "02.03.2026, 06:20", 'say "hi"'), ("2", None, None)]


def test_csv_with_a_header_only(spark, tmp_path):
    file = tmp_path / "a.csv"
    file.write_text("ID,Time\n")
    assert read_csv(spark, str(file)).count() == 0


def test_json_array_documents(spark, tmp_path):
    file = tmp_path / "a.json"
    file.write_text('[{"id": 7, "status": "wet", "other": [1]}, {"id": "x"}]')
    rows = read_json(spark, str(file), ["id", "status"], multiline=True).collect()
    assert {tuple(x) for x in rows} == {("7", "wet"), ("x", None)}


def test_dispatch(spark, tmp_path):
    file = tmp_path / "a.csv"
    file.write_text("a\n1\n")
    assert read_source(spark, "CSV", path=str(file)).count() == 1
    with pytest.raises(ValueError, match="Unsupported source type: xml"):
        read_source(spark, "xml")


def test_jdbc_options():
    plain = jdbc_options("jdbc:x", query="SELECT 1")
    assert plain["query"] == "SELECT 1" and plain["fetchsize"] == "10000"
    split = jdbc_options("jdbc:x", query="SELECT 1", partition_column="id", bounds=(0, 100), partitions=4)
    assert split["dbtable"] == "(SELECT 1) AS source" and split["numPartitions"] == "4"
    with pytest.raises(ValueError):
        jdbc_options("jdbc:x")
    with pytest.raises(ValueError):
        jdbc_options("jdbc:x", table="t", partition_column="id")


def test_mark_is_strict_and_looks_back(spark):
    df = spark.range(10).select((F.lit("2024-01-01").cast("timestamp_ntz") + F.make_dt_interval(hours="id")).alias("ts"))
    mark = datetime(2024, 1, 1, 5)
    assert after_mark(df, "ts", mark).count() == 4
    assert after_mark(df, "ts", None).count() == 10
    assert after_mark(df, "ts", mark, timedelta(hours=2)).count() == 6
    assert keyed_children(spark.range(5).withColumn("p", F.col("id") % 2), "p", 1).count() == 2


def test_mark_reaches_the_scan(spark):
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet").select("event_id", "ts")
    plan = after_mark(events, "ts", datetime(2024, 1, 15))._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(ts,2024-01-15" in plan and "struct<event_id:bigint,ts:timestamp_ntz>" in plan


def test_replace_is_invisible_until_published(spark, tmp_path):
    tables = Tables(spark, str(tmp_path))
    schema = "k int, job_id int"
    tables.replace("t", spark.createDataFrame([(1, 1)], schema), [])
    (tmp_path / "t" / "v=000002").mkdir()  # left by a failed write
    read = tables.read("t", spark.createDataFrame([], schema).schema)
    assert [x.k for x in read.collect()] == [1]
    tables.replace("t", read.withColumn("k", F.col("k") + 1), [])
    assert [x.k for x in tables.read("t", read.schema).collect()] == [2]
    assert tables.path("t").endswith("v=000003")
    tables.drop_old_versions("t", keep=1)
    assert not (tmp_path / "t" / "v=000001").exists()


def test_append_replaces_only_its_own_batch(spark, tmp_path):
    tables = Tables(spark, str(tmp_path))
    rows = lambda n, job: spark.createDataFrame([(i, job) for i in range(n)], "k int, job_id int")
    assert tables.append("t", rows(5, 1), ["job_id"])["rows"] == 5
    tables.append("t", rows(3, 2), ["job_id"])
    tables.append("t", rows(2, 2), ["job_id"])
    counts = tables.read("t", rows(1, 1).schema).groupBy("job_id").count().collect()
    assert {x.job_id: x["count"] for x in counts} == {1: 5, 2: 2}
    with pytest.raises(ValueError):
        tables.append("u", rows(1, 1), [])


def test_streaming_ingest_takes_each_file_once(spark, tmp_path):
    inbox, wh = tmp_path / "in", Warehouse(spark, str(tmp_path / "wh"))
    inbox.mkdir()
    schema = text_schema(["ID", "Baby ID", "Time", "Amount (ml)"])
    counts = []
    for n, body in enumerate(["1,1,2024-01-01 08:00,5\n2,1,2024-01-01 09:00,bad\n", "3,1,2024-01-01 10:00,7\n", ""]):
        if body:
            (inbox / f"{n}.csv").write_text("ID,Baby ID,Time,Amount (ml)\n" + body)
        ingest_available(wh, landed_files(spark, str(inbox), schema), "stg_formula", m.AMOUNT_FILE, str(tmp_path / "cp"))
        counts.append(wh.tables.read("stg_formula").count())
    assert counts == [1, 2, 2]
    assert spark.read.json(f"{wh.quarantine}/stg_formula/*/").count() == 1


# -- operational batches ----------------------------------------------------------


def test_subject_feed(spark):
    subjects = spark.createDataFrame([(1, "Anna", "UTC"), (2, "Bert", "UTC")], "id int, name string, timezone string")
    feed = spark.createDataFrame(
        [("U", 1, 1, " Annabel ", "Europe/Berlin"), ("D", 2, 2, None, None), ("I", 3, 3, "Cleo", "Asia/Kolkata"),
         ("I", 4, 4, "ab", "UTC"), ("I", 5, 5, "Dora", "Mars/Olympus"), ("U", 6, 0, "Emil", "UTC"),
         ("U", 7, 9, "Nobody", "UTC"), ("X", 8, 1, "Anna", "UTC"), ("I", 9, 6, None, "UTC")],
        "op string, seq int, id int, name string, timezone string")
    done = feed_subjects(subjects, feed)
    assert sorted(tuple(x) for x in done.table.collect()) == [
        (1, "Annabel", "Europe/Berlin"), (3, "Cleo", "Asia/Kolkata")]
    assert {x.seq: x.error_message for x in done.rejected.collect()} == {
        4: "name_length", 5: "known_zone", 6: "positive_id", 8: "known_op", 9: "required_name"}


def test_event_feed(spark):
    subjects = spark.createDataFrame([(1,), (2,)], "id int")
    t = datetime(2024, 1, 1, tzinfo=UTC)
    events = spark.createDataFrame([(10, t, 30, 1), (11, t, 40, 2)], "id int, sleep_start timestamp, sleep_duration int, baby_id int")
    late = datetime(2030, 1, 1, tzinfo=UTC)
    feed = spark.createDataFrame(
        [("U", 1, 10, t, 35, 1), ("D", 2, 11, None, None, 1), ("I", 3, 12, t, 5, 9), ("I", 4, 13, t, 5, 2),
         ("U", 5, 13, t, 6, 2), ("I", 6, 14, late, 5, 1), ("I", 7, 15, t, 0, 1), ("D", 8, 99, None, None, 1)],
        "op string, seq int, id int, sleep_start timestamp, sleep_duration int, baby_id int")
    done = feed_events(events, subjects, feed, "sleep_start", "sleep_duration", datetime(2025, 1, 1))
    assert sorted((x.id, x.sleep_duration) for x in done.table.collect()) == [(10, 35), (11, 40), (13, 6)]
    assert {x.seq: x.error_message for x in done.rejected.collect()} == {
        2: "belongs_to_parent", 3: "parent_exists", 6: "not_future", 7: "positive_sleep_duration"}


def test_import_rejects_an_invalid_subject(spark):
    rows = spark.createDataFrame([], "Time string, `Duration(minutes)` string, Status string")
    for name, zone in (("ab", "UTC"), ("Anna", "Nowhere/Town")):
        with pytest.raises(ValueError):
            import_history(rows.drop("Status"), rows.drop("Duration(minutes)"), name, zone, datetime(2025, 1, 1))


def test_rules_count_null_as_failure(spark):
    df = spark.createDataFrame([(1, "wet"), (0, None)], "n int, s string")
    rules = [r.positive("n"), r.valid_status("s")]
    got = df.select(r.failed_rules(rules).alias("f")).collect()
    assert sorted(len(x.f) for x in got) == [0, 2]


def test_month_with_many_rows_is_written_by_many_tasks(spark, tmp_path, monkeypatch):
    monkeypatch.setattr("tidemark.sinks.tables.WRITE_BYTES", "200KB")
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(key, None)
    rows = spark.range(300_000).selectExpr(
        "id AS baby_sk", "20240105 AS sleep_start_date_sk", "CAST(id % 1440 AS INT) AS sleep_start_time_sk",
        "CAST(hash(id) AS INT) AS duration_minutes", "TIMESTAMP '2024-01-05 00:00:00' AS loaded_at", "202401 AS month_sk", "1 AS job_id",
    )
    tables = Tables(spark, str(tmp_path))
    assert tables.replace("fact_sleep", rows)["rows"] == 300_000
    assert len(list(tmp_path.rglob("*.parquet"))) > 1
    assert tables.read("fact_sleep").agg(F.count_distinct("baby_sk")).first()[0] == 300_000
    assert spark.conf.get(key, None) == before
