"""Splitting hot keys.

One key may hold a third of all rows. A window or join that sends a key to a
single task then never finishes. The helpers here cut the rows of such keys
into slices along an ordering column, so that a task only gets one slice.

A key is hot when it holds more than ``1 / parts`` of the rows. There are fewer
than ``parts`` such keys whatever the data size, and fewer than
``parts * (OVERSPLIT + 1)`` slices in total. These bounds make it safe to fetch
the hot keys and to broadcast what is known per slice.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Row, functions as F, types as T

from tidemark.session import shuffle_parts

OVERSPLIT = 4  # slices per average partition of a hot key; absorbs uneven times

SLICE = "__slice"
HOT = "__hot"


@dataclass(frozen=True)
class HotKeys:
    """The hot keys of some rows: where each begins along the ordering column,
    how wide its slices are and how many there are. Empty in the usual case."""

    key: str
    dtype: T.DataType
    rows: list[Row]

    def __bool__(self) -> bool:
        return bool(self.rows)

    def frame(self, like: DataFrame) -> DataFrame:
        fields = [T.StructField(n, T.LongType()) for n in ("__lo", "__step", "__slices")]
        schema = T.StructType([T.StructField(self.key, self.dtype), *fields])
        return like.sparkSession.createDataFrame(self.rows, schema)


def position(df: DataFrame, along: str) -> Column:
    """The ordering column as a long."""
    dtype = df.schema[along].dataType
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        return F.unix_micros(F.col(along).cast("timestamp"))
    return F.col(along).cast("long")


def hot_keys(df: DataFrame, key: str, along: str, parts: int | None = None) -> HotKeys:
    """Measures the keys with one count per key, which combines on the map side.

    The scan reads the two columns only, and fewer than ``parts`` rows return.
    """
    parts = max(parts or shuffle_parts(df.sparkSession), 2)
    stats = (
        df.where(F.col(key).isNotNull())
        .groupBy(key)
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.min(position(df, along)).alias("__lo"),
            F.max(position(df, along)).alias("__hi"),
        )
    )
    total = stats.agg(F.sum("n")).scalar()
    hot = stats.where((F.col("n") * F.lit(parts) > total) & F.col("__lo").isNotNull())
    slices = F.ceil(F.col("n") * F.lit(parts * OVERSPLIT) / total).cast("long")
    span = F.col("__hi") - F.col("__lo") + 1
    step = F.greatest(F.ceil(span / slices).cast("long"), F.lit(1).cast("long"))
    rows = hot.select(
        key, "__lo", step.alias("__step"), F.ceil(span / step).cast("long").alias("__slices")
    ).collect()
    return HotKeys(key, df.schema[key].dataType, rows)


def with_slice(df: DataFrame, hot: HotKeys, along: str) -> DataFrame:
    """Adds the slice number of a row (0 for cold keys) and a hot-key flag."""
    pos = F.greatest(position(df, along), F.col("__lo"))
    number = F.least(F.floor((pos - F.col("__lo")) / F.col("__step")), F.col("__slices") - 1)
    flag = F.col("__lo").isNotNull()
    return df.join(F.broadcast(hot.frame(df)), hot.key, "left").select(
        *df.columns,
        flag.alias(HOT),
        F.when(flag, number.cast("int")).otherwise(F.lit(0)).alias(SLICE),
    )


def replicate_slices(df: DataFrame, hot: HotKeys) -> DataFrame:
    """One copy of a row per slice of its key: the other side of a sliced join."""
    last = F.coalesce(F.col("__slices").cast("int"), F.lit(1)) - 1
    return df.join(F.broadcast(hot.frame(df)), hot.key, "left").select(
        *df.columns, F.explode(F.sequence(F.lit(0), last)).alias(SLICE)
    )
