"""One row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F


def first_per_key(df: DataFrame, key: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """First row of each key in the given order.

    Spark turns the rank filter into a group limit that runs before the
    shuffle, so each map task sends at most one row per key. A key with many
    copies therefore costs no more than any other. ``order`` should be total:
    with ties the survivor is arbitrary.
    """
    rank = F.row_number().over(Window.partitionBy(*key).orderBy(*order))
    return df.withColumn("__rank", rank).where("__rank = 1").drop("__rank")


def latest_load_first(df: DataFrame) -> list[Column]:
    """Staging order: latest load first, then the lineage columns as tie-breaks."""
    ties = [c for c in ("job_id", "source_id", "row_hash") if c in df.columns]
    return [F.col("loaded_at").desc()] + [F.col(c).desc() for c in ties]
