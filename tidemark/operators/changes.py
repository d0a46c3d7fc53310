"""Applying a feed of inserts, updates and deletes to a keyed table."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidemark.operators.carry import Ordered


def apply_changes(
    target: DataFrame, changes: DataFrame, key: str, op: str = "op", order: str = "seq"
) -> DataFrame:
    """The table after the changes.

    ``op`` is I (insert, no effect where the key exists), U (overwrites with
    the non-NULL columns, no effect where the key is missing) or D (delete,
    likewise). Changes of one key apply in ``order``, which must be unique
    per key.

    The feed is never gathered per key. A key ends up with the row of its last
    birth (or its target row where nothing was deleted), overlaid with the last
    non-NULL update of each column since. All of these are maxima, so they
    combine on the map side, and the final join has one row per key on both
    sides.
    """
    columns = [c for c in target.columns if c != key]
    feed = changes.select(key, op, order, *columns)

    # An insert takes effect if the change before it, updates aside, is a
    # delete, or if there is none and the target lacks the key.
    turns = Ordered(feed.where(F.col(op).isin("I", "D")), key, [order]).with_previous(
        "__before", F.col(op)
    )
    marked = turns.rows().unionByName(feed.where(F.col(op) == "U"), allowMissingColumns=True)

    row = F.struct(F.col(order).alias("at"), *columns)
    insert = F.col(op) == "I"
    reborn = F.when(insert & (F.col("__before") == "D"), F.col(order))
    first = F.when(insert & F.col("__before").isNull(), F.col(order))
    folded = marked.groupBy(key).agg(
        F.max(F.when(F.col(op) == "D", F.col(order))).alias("__gone"),
        F.max_by(row, reborn).alias("__reborn"),
        F.max_by(row, first).alias("__first"),
        *[_last_update(op, order, c).alias(f"__u_{c}") for c in columns],
    )

    present = F.struct(F.lit(None).cast(feed.schema[order].dataType).alias("at"), *columns)
    base = target.select(key, present.alias("__kept"))
    joined = base.join(folded, key, "full_outer")
    start = F.when(F.col("__gone").isNull(), F.coalesce("__kept", "__first")).when(
        F.col("__reborn.at") > F.col("__gone"), F.col("__reborn")
    )

    def latest(column: str):
        update = F.col(f"__u_{column}")
        newer = F.coalesce(update["at"] > F.col("__start.at"), update.isNotNull())
        return F.when(newer, update["value"]).otherwise(F.col("__start")[column]).alias(column)

    return (
        joined.withColumn("__start", start)
        .where(F.col("__start").isNotNull())
        .select(key, *[latest(c) for c in columns])
    )


def _last_update(op: str, order: str, column: str):
    applies = (F.col(op) == "U") & F.col(column).isNotNull()
    entry = F.struct(F.col(order).alias("at"), F.col(column).alias("value"))
    return F.max_by(entry, F.when(applies, F.col(order)))
