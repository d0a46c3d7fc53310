"""Versioned (type 2) dimensions.

A version is valid in ``[valid_from, valid_to)``; the open version of a member
has ``is_current`` and a far-future end.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark.functions.keys import instant
from tidemark.operators.carry import Ordered
from tidemark.operators.dedup import first_per_key
from tidemark.operators.lookup import lookup_join
from tidemark.operators.skew import hot_keys

# Fixed values
FAR_FUTURE = datetime(2099, 12, 31, 23, 59, 59)
UNKNOWN_FROM = datetime(1900, 1, 1)
UNKNOWN_TO = datetime(2099, 12, 31)
UNKNOWN_KEY = -1

NEXT = "__next"


@dataclass(frozen=True)
class VersionedBy:
    """Roles of the columns of a batch of snapshots.

    ``nk`` identifies a member, a change of ``attr`` opens a version at
    ``effective``, and ``order`` puts the snapshots of a member in sequence.
    """

    nk: str
    attr: str
    effective: str
    order: tuple[str, ...]


def latest_snapshot(batch: DataFrame, nk: str, order: Sequence[Column]) -> DataFrame:
    """The newest snapshot of every member: the base of a new dimension."""
    return first_per_key(batch.where(F.col(nk).isNotNull()), [nk], order)


def initial_versions(batch: DataFrame, by: VersionedBy, order: Sequence[Column]) -> DataFrame:
    """One open version per member, valid from its newest snapshot."""
    return open_ended(latest_snapshot(batch, by.nk, order), by)


def open_ended(rows: DataFrame, by: VersionedBy) -> DataFrame:
    kind = rows.schema[by.effective].dataType
    return (
        rows.withColumn("valid_from", F.col(by.effective))
        .withColumn("valid_to", instant(FAR_FUTURE, kind))
        .withColumn("is_current", F.lit(True))
    )


def earliest_per_attribute(batch: DataFrame, by: VersionedBy) -> DataFrame:
    """First snapshot of each (member, attribute value) of a batch."""
    return first_per_key(batch, [by.nk, by.attr], [F.col(c) for c in by.order])


def changed_rows(batch: DataFrame, by: VersionedBy) -> DataFrame:
    """Snapshots whose attribute differs from the member's previous snapshot.

    The previous value is kept as ``prev_attr``, NULL for a member's first row.
    Hot members are processed in slices of the first order column.
    """
    return _changes(batch, by).rows()


def _changes(batch: DataFrame, by: VersionedBy) -> Ordered:
    rows = Ordered(batch, by.nk, by.order).with_previous("__prev", F.struct(F.col(by.attr)))
    first_or_changed = F.col("__prev").isNull() | ~F.col("__prev")[by.attr].eqNullSafe(
        F.col(by.attr)
    )
    rows.where(first_or_changed)
    rows.df = rows.df.withColumn("prev_attr", F.col("__prev")[by.attr]).drop("__prev")
    return rows


def version_history(batch: DataFrame, by: VersionedBy) -> DataFrame:
    """Every version of every member in a log of snapshots."""
    rows = _changes(batch, by).with_next(NEXT, F.col(by.effective))
    return new_versions(rows.rows().drop("prev_attr"), by)


def unknown_member(spark: SparkSession, columns: dict[str, Column]) -> DataFrame:
    """The single row that facts without a known member refer to."""
    return spark.range(1).select(*[col.alias(name) for name, col in columns.items()])


def compare_with_current(
    batch: DataFrame,
    dimension: DataFrame,
    by: VersionedBy,
    dim_attr: str,
    collapse_repeats: bool = True,
) -> DataFrame:
    """Batch snapshots that open a version, next to the member's current value.

    Adds ``current_attr``, ``known`` (the member exists) and the instant of the
    member's next change. With
    ``collapse_repeats`` a value counts once per member and batch, so a value
    that returns within the batch opens no second version; without it the
    batch is read as a history.
    """
    members = batch.select(by.nk).distinct()
    current = (
        dimension.where("is_current")
        .select(
            F.col(by.nk), F.col(dim_attr).alias("current_attr"), F.lit(True).alias("known")
        )
        .join(members, by.nk, "left_semi")
    )
    hot = hot_keys(batch, by.nk, by.order[0])
    rows = earliest_per_attribute(batch, by) if collapse_repeats else batch
    compared = lookup_join(rows, current, by.nk, by.order[0], hot).withColumn(
        "known", F.coalesce("known", F.lit(False))
    )
    differs = ~F.col("current_attr").eqNullSafe(F.col(by.attr))
    if collapse_repeats:
        chain = Ordered(compared.where(~F.col("known") | differs), by.nk, by.order, hot=hot)
    else:
        chain = Ordered(compared, by.nk, by.order, hot=hot)
        chain.with_previous("__prev", F.struct(F.col(by.attr)))
        first = F.col("__prev").isNull()
        repeats = F.col("__prev")[by.attr].eqNullSafe(F.col(by.attr))
        chain.where(F.when(first, ~F.col("known") | differs).otherwise(~repeats))
    return chain.with_next(NEXT, F.col(by.effective)).rows().drop("__prev")


def new_versions(rows: DataFrame, by: VersionedBy) -> DataFrame:
    """Versions from changes that know their successor: each is valid until the next begins."""
    kind = rows.schema[by.effective].dataType
    return (
        rows.withColumn("valid_from", F.col(by.effective))
        .withColumn("valid_to", F.coalesce(NEXT, instant(FAR_FUTURE, kind)))
        .withColumn("is_current", F.col(NEXT).isNull())
        .drop(NEXT)
    )


def expiry(changes: DataFrame, by: VersionedBy) -> DataFrame:
    """Instant at which the current version of a changed member ends."""
    return changes.where("known").groupBy(by.nk).agg(F.min(by.effective).alias("expires_at"))


def expire_current(dimension: DataFrame, ends: DataFrame, nk: str, run_ts: Column) -> DataFrame:
    """Closes the open version of every member in ``ends``.

    Closed versions pass through without a join, so a member with a long
    history is no heavier than any other.
    """
    hit = F.col("expires_at").isNotNull()
    updated = {
        "valid_to": F.coalesce("expires_at", "valid_to"),
        "updated_at": F.when(hit, run_ts).otherwise(F.col("updated_at")),
        "is_current": ~hit,
    }
    present = {name: col for name, col in updated.items() if name in dimension.columns}
    open_rows = dimension.where("is_current").join(ends, nk, "left")
    return (
        dimension.where("NOT is_current")
        .unionByName(open_rows.withColumns(present).select(*dimension.columns))
    )
