"""Resolving the dimension version an event belongs to."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from tidemark.operators.carry import Ordered
from tidemark.operators.skew import HOT, SLICE, HotKeys, hot_keys, replicate_slices, with_slice
from tidemark.session import fits_broadcast

# Versions of one member up to which a hash join that tests each of them against
# the event time is cheaper than sorting the events.
FEW_VERSIONS = 32


def lookup_join(
    facts: DataFrame, members: DataFrame, key: str, along: str, hot: HotKeys | None = None
) -> DataFrame:
    """Left join to a dimension that has at most one row per ``key``.

    A dimension within the broadcast limit is broadcast and the facts are not
    moved. Beyond it both sides are shuffled, the facts of hot keys in slices
    with a copy of the member for each.
    """
    if fits_broadcast(members):
        return facts.join(F.broadcast(members), key, "left")
    hot = hot_keys(facts, key, along) if hot is None else hot
    keyed = facts.where(F.col(key).isNotNull())
    if hot:
        sliced, copies = with_slice(keyed, hot, along), replicate_slices(members, hot)
        joined = sliced.join(copies, [key, SLICE], "left").drop(SLICE, HOT)
    else:
        joined = keyed.join(members, key, "left")
    return joined.unionByName(_keyless(facts, key, members, [c for c in members.columns if c != key]))


def _keyless(facts: DataFrame, key: str, members: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows without a key, which match nothing. They stay out of the shuffle,
    where all of them would meet in one task."""
    nothing = [F.lit(None).cast(members.schema[c].dataType).alias(c) for c in columns]
    return facts.where(F.col(key).isNull()).select("*", *nothing)


def interval_join(
    facts: DataFrame,
    versions: DataFrame,
    key: str,
    ts: str,
    columns: Sequence[str],
    valid_from: str = "valid_from",
    valid_to: str = "valid_to",
) -> DataFrame:
    """Left join to the version with ``valid_from <= ts < valid_to``.

    Small dimensions with few versions per member take a broadcast hash join
    with the range as a residual condition. Otherwise see ``asof_join``.
    ``columns`` of the matching version are added, NULL where none matches.

    A fact stays one row, also where versions of a member overlap: the version
    that began last decides (of several that began together the one that ends
    last, then the one with the largest columns), and a later start ends the
    versions before it.
    """
    if fits_broadcast(versions) and most_versions(versions, key) <= FEW_VERSIONS:
        following = F.lead("__at").over(Window.partitionBy("__key").orderBy("__at"))
        right = _starts(versions, key, columns, valid_from, valid_to).select(
            F.col("__key").alias("__nk"),
            F.col("__at").alias("__from"),
            F.least(F.col("__version")["__to"], following).alias("__to"),
            *[F.col("__version")[c].alias(c) for c in columns],
        )
        condition = (
            (F.col(key) == F.col("__nk"))
            & (F.col(ts) >= F.col("__from"))
            & (F.col(ts) < F.col("__to"))
        )
        return facts.join(F.broadcast(right), condition, "left").drop("__nk", "__from", "__to")
    return asof_join(facts, versions, key, ts, columns, valid_from, valid_to)


def _starts(
    versions: DataFrame, key: str, columns: Sequence[str], valid_from: str, valid_to: str
) -> DataFrame:
    """``__key, __at, __version``: one version per member and start, of those that last."""
    payload = F.struct(F.col(valid_to).alias("__to"), *columns)
    lasting = versions.where(F.col(key).isNotNull() & (F.col(valid_from) < F.col(valid_to)))
    starts = lasting.groupBy(F.col(key).alias("__key"), F.col(valid_from).alias("__at"))
    return starts.agg(F.max(payload).alias("__version"))


def most_versions(versions: DataFrame, key: str) -> int:
    """Largest number of versions of one member (one number from one small job)."""
    row = versions.groupBy(key).count().agg(F.max("count")).first()
    return row[0] or 0


def asof_join(
    facts: DataFrame,
    versions: DataFrame,
    key: str,
    ts: str,
    columns: Sequence[str],
    valid_from: str = "valid_from",
    valid_to: str = "valid_to",
) -> DataFrame:
    """The same result as ``interval_join`` by merging events into the versions.

    Events and versions are sorted together per key and each event takes the
    last version that began at or before it. The work is linear in both sides,
    where a join on the key alone would pair every event with every version of
    its member.
    """
    row = F.struct(*[F.col(c) for c in facts.columns])
    keyed = facts.where(F.col(key).isNotNull())
    events = keyed.select(
        F.col(key).alias("__key"),
        F.col(ts).alias("__at"),
        F.lit(1).alias("__side"),
        row.alias("__row"),
    )
    starts = _starts(versions, key, columns, valid_from, valid_to).withColumn("__side", F.lit(0))
    merged = events.unionByName(starts, allowMissingColumns=True)
    carried = (
        Ordered(merged, "__key", ["__at", "__side"])
        .with_latest("__found", F.col("__version"))
        .where("__side = 1")
        .rows()
    )
    inside = F.col("__row")[ts] < F.col("__found")["__to"]
    matched = carried.select(
        "__row.*", *[F.when(inside, F.col("__found")[c]).alias(c) for c in columns]
    )
    return matched.unionByName(_keyless(facts, key, versions, columns))


def resolve_member(
    facts: DataFrame,
    versions: DataFrame,
    key: str,
    ts: str,
    sk: str,
    unknown: object,
    valid_from: str = "valid_from",
    valid_to: str = "valid_to",
    current: str = "is_current",
) -> DataFrame:
    """Surrogate key valid at the event time, else the current one, else unknown."""
    at_time = interval_join(
        facts,
        versions.withColumn("__sk_then", F.col(sk)),
        key,
        ts,
        ["__sk_then"],
        valid_from,
        valid_to,
    )
    now = versions.where(current).select(key, F.col(sk).alias("__sk_now"))
    return (
        lookup_join(at_time, now, key, ts)
        .withColumn(sk, F.coalesce("__sk_then", "__sk_now", F.lit(unknown)))
        .drop("__sk_then", "__sk_now")
    )
