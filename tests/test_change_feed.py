"""A change feed as a stream: cut anywhere, stopped, broken off and repeated, it gives the rows of the batch form."""

import random
from datetime import UTC, datetime, timedelta

import pytest

from tidemark.plans.operational import feed_events
from tidemark.plans.staging import Warehouse
from tidemark.streaming.change_feed import KeyedTable, follow

NOW = datetime(2025, 1, 1)
T0 = datetime(2024, 1, 1, tzinfo=UTC)
EVENT = "id int, sleep_start timestamp, sleep_duration int, baby_id int"
CHANGE = f"op string, seq int, {EVENT}"


def _feed(n: int) -> list[tuple]:
    """Changes in order of ``seq``; a third of them belong to one event."""
    rng = random.Random(5)
    rows = []
    for seq in range(n):
        key = 7 if rng.random() < 0.33 else rng.randrange(1, 30)
        rows.append((rng.choice("IUUDX" if seq % 50 == 0 else "IUUD"), seq, key, T0 + timedelta(minutes=seq),
                     rng.randrange(-1, 90), rng.randrange(1, 4)))
    return rows


@pytest.fixture
def given(spark, tmp_path):
    subjects = spark.createDataFrame([(1,), (2,)], "id int")
    events = spark.createDataFrame([(i, T0, 30, 1 + i % 2) for i in range(1, 12)], EVENT)
    feed = _feed(240)
    target = KeyedTable(Warehouse(spark, str(tmp_path / "wh"), NOW.replace(tzinfo=UTC)), "sleep_data", events.schema, 8)
    target.create(events)

    def apply(rows, changes):
        return feed_events(rows, subjects, changes, "sleep_start", "sleep_duration", NOW)

    def land(rows):
        spark.createDataFrame(rows, CHANGE).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))

    def run(work=apply):
        stream = spark.readStream.schema(spark.createDataFrame([], CHANGE).schema).parquet(str(tmp_path / "in"))
        follow(target, stream, work, str(tmp_path / "cp"))

    whole = apply(events, spark.createDataFrame(feed, CHANGE))
    expected = sorted(map(tuple, whole.table.collect())), sorted((r.seq, r.error_message) for r in whole.rejected.collect())
    return target, feed, apply, land, run, expected


def _state(target):
    bad = target.rejected().selectExpr("from_json(raw, 'seq INT').seq AS seq", "error_message").collect()
    return sorted(map(tuple, target.read().collect())), sorted((r.seq, r.error_message) for r in bad)


def test_stream_equals_batch_across_restarts_and_failures(given):
    target, feed, apply, land, run, expected = given
    land(feed[:50])
    run()
    first = _state(target)
    land(feed[50:170])

    def breaks_late(rows, changes):
        done = apply(rows, changes)
        return type(done)(done.table, done.rejected.selectExpr("*", "1 AS x").drop("error_message"))

    with pytest.raises(Exception, match="error_message"):
        run(breaks_late)  # after the buckets were written
    assert _state(target) == first
    run()  # the same micro-batch again
    land(feed[170:])
    run()
    run()  # nothing new
    assert _state(target) == expected
    freed = target.tables.drop_old_copies("sleep_data")
    assert freed > 0 and _state(target) == expected and target.tables.drop_old_copies("sleep_data") == 0


def test_a_bucket_that_loses_all_rows(given, spark):
    target, *_, land, run, _ = given
    land([("D", i, i, None, None, 1 + i % 2) for i in range(1, 12)])
    run()
    assert target.read().count() == 0 and target.rejected().count() == 0
    land([("I", 99, 3, T0, 5, 2)])
    run()
    assert [r.id for r in target.read().collect()] == [3]
