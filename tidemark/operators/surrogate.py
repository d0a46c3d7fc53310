"""Surrogate keys without a global sequence."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

LANES = 4096


def lane_of(identity: Sequence[str]) -> Column:
    return F.pmod(F.xxhash64(*identity), F.lit(LANES)).cast("long")


def assign_keys(
    rows: DataFrame, identity: Sequence[str], sk: str, existing: DataFrame | None = None
) -> DataFrame:
    """Adds a unique non-negative key ``sk`` to new rows.

    Rows are spread over lanes by a hash of their identity and numbered within
    their lane, after the highest number the lane has used so far. Keys of
    different lanes differ modulo LANES, so no task needs to see all rows and
    no two rows can share a key. The same input always gets the same keys.
    """
    ranked = rows.withColumn("__lane", lane_of(identity)).withColumn(
        "__rank", F.row_number().over(Window.partitionBy("__lane").orderBy(*identity))
    )
    start = F.lit(0).cast("long")
    if existing is not None:
        used = (
            existing.where(F.col(sk) >= 0)
            .groupBy(F.pmod(F.col(sk), F.lit(LANES)).alias("__lane"))
            .agg(F.max(F.floor(F.col(sk) / LANES)).cast("long").alias("__used"))
        )
        # one row per lane at most
        ranked = ranked.join(F.broadcast(used), "__lane", "left")
        start = F.coalesce(F.col("__used") + 1, start)
    key = (start + F.col("__rank") - 1) * LANES + F.col("__lane")
    return ranked.withColumn(sk, key.cast("long")).drop("__lane", "__rank", "__used")
