"""Hot keys: the sliced forms give the same rows as the plain ones."""

import random
from datetime import datetime

import pytest
from pyspark.sql import Window, functions as F

from tidemark.operators import scd2
from tidemark.operators.carry import Ordered
from tidemark.operators.changes import apply_changes
from tidemark.operators.lookup import asof_join, interval_join, lookup_join, resolve_member
from tidemark.operators.skew import SLICE, hot_keys, with_slice
from tidemark.plans.operational import feed_events
from tidemark.session import fits_broadcast

START = datetime(2024, 1, 1)


@pytest.fixture(scope="module")
def events(spark):
    """Key 7 has half of all rows, key 8 a fifth, all bunched in time; 15 others share the rest."""
    rows = spark.range(6000).select(
        F.when(F.col("id") % 10 < 5, 7).when(F.col("id") % 10 < 7, 8).otherwise(100 + F.col("id") % 50)
        .cast("long").alias("k"),
        (F.lit(START).cast("timestamp_ntz") + F.make_dt_interval(
            secs=(F.pow(F.col("id") / 100, 2) + F.col("id") % 10).cast("decimal(18,6)"))).alias("ts"),
        F.col("id"),
        F.element_at(F.array(*[F.lit(x) for x in "abc"]), (F.hash("id") % 2 + 2).cast("int")).alias("attr"),
    )
    return rows.persist()


def same(left, right):
    order = sorted(left.columns)
    a, b = left.select(*order), right.select(*order)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_hot_keys_are_found_and_split(events):
    hot = hot_keys(events, "k", "ts", 8)
    assert {r.k for r in hot.rows} == {7, 8}
    sliced = with_slice(events, hot, "ts")
    assert sliced.count() == events.count()
    biggest = sliced.groupBy("k", SLICE).count().agg(F.max("count")).first()[0]
    assert biggest < 3000 / 3
    assert not hot_keys(events.where("k > 10"), "k", "ts", 8)


def test_previous_and_next_equal_lag_and_lead(events):
    w = Window.partitionBy("k").orderBy("ts", "id")
    plain = events.select(
        "*", F.lag(F.struct("attr")).over(w).alias("before"), F.lead("ts").over(w).alias("after")
    )
    rows = Ordered(events, "k", ["ts", "id"], parts=8)
    assert rows.hot
    got = rows.with_previous("before", F.struct("attr")).with_next("after", F.col("ts")).rows()
    same(got, plain)


def test_history_equals_plain_windows(events):
    w = Window.partitionBy("k").orderBy("ts", "id")
    changed = events.withColumn("p", F.lag("attr").over(w)).where("p IS NULL OR p <> attr")
    plain = changed.select(
        "k", "attr", F.col("ts").alias("valid_from"),
        F.coalesce(F.lead("ts").over(w), F.lit("2099-12-31 23:59:59").cast("timestamp_ntz")).alias("valid_to"),
    )
    by = scd2.VersionedBy("k", "attr", "ts", ("ts", "id"))
    same(scd2.version_history(events, by).select("k", "attr", "valid_from", "valid_to"), plain)


def versions_of(events):
    by = scd2.VersionedBy("k", "attr", "ts", ("ts", "id"))
    return scd2.version_history(events, by).select("k", "attr", "valid_from", "valid_to", "is_current")


def test_asof_join_equals_the_range_join(spark, events):
    versions = versions_of(events)
    facts = events.select("id", "k", (F.col("ts") - F.expr("INTERVAL 90 SECONDS")).alias("at")).unionByName(
        spark.createDataFrame([(-1, None, START), (-2, 7, None), (-3, 999, START)], "id long, k long, at timestamp_ntz")
    )
    v = versions.withColumnRenamed("k", "vk").withColumnRenamed("attr", "state")
    plain = facts.join(v, (F.col("k") == F.col("vk")) & (F.col("at") >= F.col("valid_from")) & (F.col("at") < F.col("valid_to")), "left")
    named = versions.withColumnRenamed("attr", "state")
    same(asof_join(facts, named, "k", "at", ["state"]), plain.select("id", "k", "at", "state"))
    same(interval_join(facts, named, "k", "at", ["state"]), plain.select("id", "k", "at", "state"))


def test_lookup_join_beyond_the_broadcast_limit(spark, events):
    members = spark.range(6, 130).select(F.col("id").alias("k"), (F.col("id") * 10).alias("sk"))
    events = events.unionByName(spark.createDataFrame([(None, START, -1, "a")], events.schema)).persist()
    plain = events.join(members, "k", "left")
    same(lookup_join(events, members, "k", "ts"), plain)
    same(lookup_join(events.where("k > 10 OR k IS NULL"), members, "k", "ts"), plain.where("k > 10 OR k IS NULL"))
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        same(lookup_join(events, members, "k", "ts"), plain)
        same(lookup_join(events.where("k > 10 OR k IS NULL"), members, "k", "ts"), plain.where("k > 10 OR k IS NULL"))
        versions = versions_of(events).withColumn("sk", F.xxhash64("k", "valid_from"))
        found = resolve_member(events.select("id", "k", "ts"), versions, "k", "ts", "sk", -1)
        assert found.count() == events.count() and found.where("sk = -1").count() == 1
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


def test_changes_equal_a_step_by_step_replay(spark):
    import random

    rng = random.Random(3)
    target = [(k, f"t{k}", float(k)) for k in range(0, 40, 2)]
    feed = [
        (rng.choice([5, 5, 5, rng.randrange(40)]), seq, rng.choice("IUUD"),
         rng.choice([None, f"n{seq}"]), rng.choice([None, float(seq)]))
        for seq in range(800)
    ]
    state = {k: (n, v) for k, n, v in target}
    for key, _, op, name, value in feed:
        if op == "I" and key not in state:
            state[key] = (name, value)
        elif op == "U" and key in state:
            old = state[key]
            state[key] = (old[0] if name is None else name, old[1] if value is None else value)
        elif op == "D":
            state.pop(key, None)
    got = apply_changes(
        spark.createDataFrame(target, "id int, name string, value double"),
        spark.createDataFrame(feed, "id int, seq int, op string, name string, value double").repartition(5),
        "id",
    ).collect()
    assert {r.id: (r.name, r.value) for r in got} == state
    assert len(got) == len(state)


def test_first_per_key_limits_before_the_shuffle(events):
    from tidemark.operators.dedup import first_per_key

    rows = first_per_key(events, ["k"], [F.col("ts").desc(), F.col("id")])
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Partial") > plan.index("Exchange") > plan.index("Final")
    assert rows.count() == 17


def test_overlapping_versions_give_one_row_whatever_the_size(spark):
    versions = spark.sql(
        "SELECT * FROM VALUES (1, 0L, 100L, 'a'), (1, 10L, 20L, 'b'), (1, 10L, 30L, 'c'), (1, 10L, 30L, 'd'), "
        "(1, 50L, 40L, 'never'), (2, 0L, 10L, 'e'), (2, 5L, 50L, 'f'), (NULL, 0L, 9L, 'no key') "
        "AS t(k, valid_from, valid_to, v)"
    )
    assert fits_broadcast(versions)
    facts = spark.createDataFrame(
        [(k, t) for k in (1, 2, 3, None) for t in (-1, 0, 5, 10, 19, 25, 30, 60, 100)], "k int, t long"
    )
    small = interval_join(facts, versions, "k", "t", ["v"])
    large = asof_join(facts, versions, "k", "t", ["v"])
    same(small, large)
    assert small.count() == facts.count()
    found = {(r.k, r.t): r.v for r in small.collect()}
    assert [found[1, t] for t in (0, 10, 25, 30, 60)] == ["a", "d", "d", None, None]
    assert [found[2, t] for t in (0, 5, 25)] == ["e", "f", "f"]


def test_owner_follows_the_order_of_the_feed(spark):
    draw = random.Random(5)
    events = {i: draw.choice([1, 2, 3]) for i in range(0, 30, 2)}
    feed = [
        (seq, draw.choice("IIDDU"), draw.randrange(30), draw.choice([1, 2, 3, 4]), draw.choice([5, 5, 5, -1]))
        for seq in range(900)
    ]
    feed.append((900, "U", None, 1, 5))
    at = datetime(2024, 1, 1)
    stored = spark.createDataFrame([(i, at, 1, p) for i, p in events.items()], "id int, t timestamp, n int, baby_id int")
    changes = spark.createDataFrame(
        [(s, o, i, p, at, n) for s, o, i, p, n in feed],
        "seq int, op string, id int, baby_id int, t timestamp, n int",
    )
    subjects = spark.createDataFrame([(1,), (2,), (3,)], "id int")
    out = feed_events(stored, subjects, changes, "t", "n", datetime(2024, 2, 1))

    owner, wrong = dict(events), {}
    for seq, op, i, parent, n in feed:
        if i is None or i <= 0:
            wrong[seq] = "positive_id"
        elif op != "D" and n < 0:
            wrong[seq] = "positive_n"
        elif op == "I" and parent == 4:
            wrong[seq] = "parent_exists"
        elif owner.get(i, parent) != parent:
            wrong[seq] = "belongs_to_parent"
        elif op == "I":
            owner[i] = parent
        elif op == "D":
            owner.pop(i, None)
    assert {r.seq: r.error_message for r in out.rejected.collect()} == wrong
    assert {r.id: r.baby_id for r in out.table.collect()} == owner


def test_owner_of_an_event_with_most_of_the_feed(spark):
    """One event is taken and freed thousands of times; what moves it is found without following it row by row."""
    from tidemark.plans.operational import owner_moves

    draw = random.Random(9)
    first = {7: 2, 8: None}
    turns = [(7 if draw.random() < 0.8 else draw.randrange(8, 40), s, draw.choice("IID"), draw.randrange(1, 4)) for s in range(4000)]
    rows = spark.createDataFrame(
        [(i, s, o, p, first.get(i)) for i, s, o, p in turns], "id long, seq long, op string, baby_id int, __owner int")
    got = {(r.id, r.seq): r.owner for r in owner_moves(rows).collect()}
    owner, expected = dict(first), {}
    for i, s, op, parent in turns:
        if (owner.get(i) is None) if op == "I" else owner.get(i) == parent:
            owner[i] = parent if op == "I" else None
            expected[i, s] = owner[i]
    assert got == expected
    assert sum(i == 7 for i, _ in got) > 500
    plan = owner_moves(rows)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
