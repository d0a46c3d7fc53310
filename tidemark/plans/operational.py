"""Batches against the operational tables: seed import and change feed.

Rules apply here, before data becomes operational. Staging takes operational
rows as they are.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, functions as F

from tidemark.functions.coerce import clean_status, clean_text, strict_wall_clock, wall_clock_to_utc
from tidemark.functions.keys import instant
from tidemark.operators import rules as r
from tidemark.operators.changes import apply_changes
from tidemark.operators.carry import Ordered
from tidemark.operators.lookup import lookup_join
from tidemark.operators.surrogate import assign_keys
from tidemark.session import materialise
from tidemark.sinks.quarantine import raw_json

# Fixed values
SEED_FORMAT = "%d.%m.%Y, %H:%M"


@dataclass(frozen=True)
class Imported:
    """Rows that passed, and rows that did not with ``error_message`` and ``raw``."""

    good: DataFrame
    bad: DataFrame


def _judge(df: DataFrame, rules: Sequence[r.Rule], keep: Sequence[str]) -> Imported:
    judged = df.withColumn("error_message", r.first_failure(rules))
    return Imported(
        judged.where("error_message IS NULL").select(*keep),
        judged.where("error_message IS NOT NULL").select("error_message", "raw"),
    )


def seed_durations(rows: DataFrame, subject_id: int, zone: str, now: datetime) -> Imported:
    """Typed duration events from ``Time`` and ``Duration(minutes)``."""
    typed = rows.select(
        wall_clock_to_utc(strict_wall_clock(F.col("Time"), SEED_FORMAT), zone).alias("sleep_start"),
        F.btrim(F.col("`Duration(minutes)`")).try_cast("int").alias("sleep_duration"),
        F.lit(subject_id).alias("baby_id"),
        raw_json(rows.columns).alias("raw"),
    )
    rules = [
        *r.required("sleep_start", "sleep_duration"),
        r.positive("sleep_duration", "positive_duration"),
        r.not_future("sleep_start", instant(now)),
    ]
    return _judge(typed, rules, ["sleep_start", "sleep_duration", "baby_id"])


def seed_statuses(rows: DataFrame, subject_id: int, zone: str, now: datetime) -> Imported:
    """Typed status events from ``Time`` and ``Status``."""
    typed = rows.select(
        wall_clock_to_utc(strict_wall_clock(F.col("Time"), SEED_FORMAT), zone).alias("change_time"),
        clean_status(F.col("Status")).alias("status"),
        F.lit(subject_id).alias("baby_id"),
        raw_json(rows.columns).alias("raw"),
    )
    rules = [
        *r.required("change_time", "status"),
        r.not_future("change_time", instant(now)),
        r.valid_status("status"),
    ]
    return _judge(typed, rules, ["change_time", "status", "baby_id"])


def with_ids(rows: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    """Gives new operational rows an id (1 or more) no existing row has."""
    used = None if existing is None else existing.select((F.col("id") - 1).alias("id"))
    numbered = assign_keys(rows, rows.columns, "id", used)
    return numbered.withColumn("id", (F.col("id") + 1).cast("int")).select("id", *rows.columns)


def import_history(
    durations: DataFrame, statuses: DataFrame, name: str, zone: str, now: datetime, subject_id: int = 1
) -> tuple[DataFrame, Imported, Imported]:
    """Creates one subject and imports its two histories."""
    spark = durations.sparkSession
    subject = spark.range(1).select(
        F.lit(subject_id).alias("id"), F.btrim(F.lit(name)).alias("name"), F.lit(zone).alias("timezone")
    )
    rules = [r.name_length("name"), r.known_zone("timezone")]
    problem = subject.select(r.first_failure(rules)).first()[0]
    if problem:
        raise ValueError(f"Invalid subject: {problem}")
    slept = seed_durations(durations, subject_id, zone, now)
    changed = seed_statuses(statuses, subject_id, zone, now)
    return (
        subject,
        Imported(with_ids(slept.good), slept.bad),
        Imported(with_ids(changed.good), changed.bad),
    )


@dataclass(frozen=True)
class Applied:
    table: DataFrame
    rejected: DataFrame


def _apply(target: DataFrame, judged: DataFrame, columns: Sequence[str]) -> Applied:
    accepted = judged.where("error_message IS NULL").select("op", "seq", *columns)
    rejected = judged.where("error_message IS NOT NULL")
    return Applied(apply_changes(target, accepted, "id"), rejected)


def feed_subjects(subjects: DataFrame, feed: DataFrame) -> Applied:
    """Applies ``op, seq, id, name, timezone`` changes to the subjects."""
    change = F.col("op") != "D"
    clean = feed.withColumns(
        {"name": clean_text(F.col("name")), "timezone": clean_text(F.col("timezone"))}
    )
    rules = [
        r.Rule("known_op", F.col("op").isin("I", "U", "D")),
        r.positive("id"),
        *[r.Rule(q.name, ~change | F.coalesce(q.passes, F.lit(False))) for q in (
            *r.required("name", "timezone"), r.name_length("name"), r.known_zone("timezone")
        )],
    ]
    judged = clean.withColumn("error_message", r.first_failure(rules))
    return _apply(subjects, judged, ["id", "name", "timezone"])


def feed_events(
    events: DataFrame, subjects: DataFrame, feed: DataFrame, ts: str, measure: str, now: datetime
) -> Applied:
    """Applies ``op, seq, id, baby_id, <ts>, <measure>`` changes to events.

    Inserts need an existing subject; changes must name the subject the event
    belongs to at that point of the feed (``seq``, unique per id): the one of
    the last accepted insert, or of ``events`` where the feed has not deleted
    the event before. A change to an unknown event has no effect.
    """
    is_status = dict(feed.dtypes)[measure] == "string"
    clean = feed.withColumn(measure, clean_status(F.col(measure))) if is_status else feed
    value = r.valid_status(measure) if is_status else r.positive(measure)

    parents = subjects.select(F.col("id").alias("baby_id"), F.lit(True).alias("__parent"))
    owners = events.select("id", F.col("baby_id").alias("__owner"))
    checked = lookup_join(lookup_join(clean, parents, "baby_id", "seq"), owners, "id", "seq")

    change = F.col("op") != "D"
    rules = [
        r.Rule("known_op", F.col("op").isin("I", "U", "D")),
        r.positive("id"),
        r.positive("baby_id"),
        *[r.Rule(q.name, ~change | F.coalesce(q.passes, F.lit(False))) for q in (
            *r.required(ts, measure), r.not_future(ts, instant(now)), value
        )],
        r.Rule("parent_exists", (F.col("op") != "I") | F.col("__parent")),
    ]
    judged = checked.withColumn("error_message", r.first_failure(rules)).drop("__parent")
    owned = owner_in_feed(materialise(judged, "judged"))
    foreign = F.col("error_message").isNull() & (F.col("__owner") != F.col("baby_id"))
    reason = F.when(foreign, "belongs_to_parent").otherwise(F.col("error_message"))
    judged = owned.withColumn("error_message", reason).drop("__owner")
    return _apply(events, materialise(judged, "judged"), events.columns)


def owner_in_feed(judged: DataFrame) -> DataFrame:
    """Brings ``__owner``, the subject of the event before the feed, up to each change.

    Only inserts and deletes without an ``error_message`` can move an event,
    see ``owner_moves``; every change takes the owner after the last of them.
    """
    kinds = {f.name: f.dataType.simpleString() for f in judged.schema.fields}
    moves = owner_moves(judged.where("error_message IS NULL AND op IN ('I', 'D') AND id IS NOT NULL"))
    state = F.struct(F.col("owner").cast(kinds["__owner"]).alias("owner")).alias("__state")
    merged = (
        judged.where("id IS NOT NULL").withColumn("__side", F.lit(0))
        .unionByName(moves.select("id", "seq", state, F.lit(1).alias("__side")), allowMissingColumns=True)
    )
    latest = Ordered(merged, "id", ["seq", "__side"]).with_latest("__now", F.col("__state"))
    owner = F.when(F.col("__now").isNull(), F.col("__owner")).otherwise(F.col("__now.owner"))
    known = latest.where("__side = 0").rows().withColumn("__owner", owner).select(*judged.columns)
    return known.unionByName(judged.where("id IS NULL"))


def owner_moves(turns: DataFrame) -> DataFrame:
    """``id, seq, owner``: the changes that move an event, and its owner after each.

    An insert takes an event that nobody owns, a delete by its owner frees it;
    all others change nothing. What an insert leads to is known without those
    before it: the event is freed by the next delete of the same subject, and
    the insert after that is the next one to take it. So every insert points
    to another one, and those that count are the chain from the first. It is
    followed by pointer jumping: in each round pointers are composed with
    themselves, and what is reached so far reaches as much again. Rounds grow
    with the logarithm of the longest chain, all steps are joins by event and
    ``seq``, and an event with a third of the feed is spread like any other.
    """
    turns = turns.select("id", "seq", "op", "baby_id", "__owner", (-F.col("seq")).alias("__back"))
    insert, delete = F.col("op") == "I", F.col("op") == "D"
    # looking back from the end: the first insert at or after each row, and the first delete by the same subject
    turns = Ordered(turns, "id", ["__back"]).with_latest("__take", F.when(insert, F.struct("seq", "baby_id"))).rows()
    turns = turns.withColumn("__pair", F.concat_ws(":", "id", "baby_id"))
    freed = F.when(delete, F.struct("seq", F.col("__take.seq").alias("take")))
    turns = Ordered(turns, "__pair", ["__back"]).with_latest("__free", freed).rows()
    turns = materialise(turns.drop("__pair", "__back"), "turns")

    inserts = turns.where(insert).select("id", "seq", "baby_id", F.col("__free.seq").alias("freed"), F.col("__free.take").alias("next"))
    starts = turns.groupBy("id").agg(
        F.max("__owner").alias("__owner"), F.min(F.when(insert, F.col("seq"))).alias("first"),
        F.min(F.when(delete & (F.col("baby_id") == F.col("__owner")), F.struct("seq", "__free"))).alias("release"),
    )
    first = F.when(F.col("__owner").isNull(), F.col("first")).otherwise(F.col("release.__free.take"))
    reached = materialise(starts.select("id", first.alias("seq")).where("seq IS NOT NULL"), "reached")
    jumps = materialise(inserts.where("next IS NOT NULL").select("id", "seq", "next"), "jumps")
    while not jumps.isEmpty():
        onward = reached.join(jumps, ["id", "seq"]).select("id", F.col("next").alias("seq"))
        reached = materialise(reached.unionByName(onward), "reached")
        then = jumps.select("id", F.col("seq").alias("next"), F.col("next").alias("then"))
        jumps = materialise(jumps.join(then, ["id", "next"]).select("id", "seq", F.col("then").alias("next")), "jumps")

    taken = inserts.join(reached, ["id", "seq"])
    nobody = F.lit(None).cast(turns.schema["baby_id"].dataType)
    return (
        taken.select("id", "seq", F.col("baby_id").alias("owner"))
        .unionByName(taken.where("freed IS NOT NULL").select("id", F.col("freed").alias("seq"), nobody.alias("owner")))
        .unionByName(starts.where("release IS NOT NULL").select("id", F.col("release.seq").alias("seq"), nobody.alias("owner")))
    )
