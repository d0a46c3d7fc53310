"""Comparing two states of a table by digests, so that only the parts that differ are joined.

Rows are dealt to buckets on two levels: a few top buckets (a month, a
partition) with some leaves each. The digest of a bucket is a count, an
exclusive or and a sum of row hashes, none of which depends on an order, so
digests are one aggregate with partial sums, and those of the leaves add up to
those of the tops.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tidemark.session import materialise

TOP, LEAF = "top", "leaf"


@dataclass(frozen=True)
class Layout:
    """``key`` identifies a row, ``columns`` are compared, ``top`` names its top bucket.

    ``top`` is best something that changes come close together in. There are
    ``leaves`` leaves to each of them; what the driver gets is at most the
    numbers of those that differ.
    """

    key: tuple[str, ...]
    columns: tuple[str, ...]
    top: Column
    leaves: int = 64

    def bucketed(self, df: DataFrame) -> DataFrame:
        leaf = F.pmod(F.xxhash64(*self.key), F.lit(self.leaves)).cast("int")
        return df.select(*self.key, *self.columns, self.top.cast("string").alias(TOP), leaf.alias(LEAF))


def bucket_digests(rows: DataFrame, layout: Layout) -> DataFrame:
    """``top, leaf, n, mixed, total`` of rows with their buckets; a row's hash tells null from anything else."""
    row = F.to_json(F.struct(*layout.key, *layout.columns), {"ignoreNullFields": "false"})
    return rows.groupBy(TOP, LEAF).agg(
        F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64(row)).alias("mixed"),
        F.sum(F.xxhash64(F.lit(1), row).cast("decimal(20,0)")).alias("total"),
    )


def _tops(digests: DataFrame) -> DataFrame:
    return digests.groupBy(TOP).agg(F.sum("n").alias("n"), F.bit_xor("mixed").alias("mixed"), F.sum("total").alias("total"))


def _different(old: DataFrame, new: DataFrame, by: Sequence[str]) -> DataFrame:
    """Buckets whose digests differ or that only one side has."""
    state = F.struct("n", "mixed", "total")
    a, b = (x.select(*[F.col(c).alias(f"{c}_{side}") for c in by], state.alias(side)) for x, side in ((old, "a"), (new, "b")))
    met = F.lit(True)
    for c in by:
        met = met & F.col(f"{c}_a").eqNullSafe(F.col(f"{c}_b"))
    joined = a.join(b, met, "full_outer").where(~F.col("a").eqNullSafe(F.col("b")))
    return joined.select(*[F.when(F.col("b").isNull(), F.col(f"{c}_a")).otherwise(F.col(f"{c}_b")).alias(c) for c in by])


def changed_buckets(old: DataFrame, new: DataFrame) -> dict[str | None, list[int]]:
    """Leaves that differ by top, of two tables of digests. Leaves are looked at in tops that differ only."""
    tops = [r[TOP] for r in _different(_tops(old), _tops(new), [TOP]).collect()]
    if not tops:
        return {}
    here = _in(TOP, tops)
    found: dict[str | None, list[int]] = {}
    for r in _different(old.where(here), new.where(here), [TOP, LEAF]).collect():
        found.setdefault(r[TOP], []).append(r[LEAF])
    return found


def _in(column: str, values: Sequence[object]) -> Column:
    some = F.col(column).isin([v for v in values if v is not None])
    return some | F.col(column).isNull() if None in values else some


def _inside(rows: DataFrame, buckets: dict[str | None, list[int]]) -> DataFrame:
    """Rows of the buckets; the tops are a filter on literals, which prunes directories."""
    leaf = F.lit(False)
    for top, leaves in buckets.items():
        leaf = leaf | (F.col(TOP).eqNullSafe(F.lit(top)) & F.col(LEAF).isin(leaves))
    return rows.where(_in(TOP, list(buckets)) & leaf)


def compare(old: DataFrame, new: DataFrame, layout: Layout) -> DataFrame:
    """``op, key, columns``: I for rows that came, D for those that went (as they were), U for those that differ.

    Keys are unique on either side; nulls in them are equal to each other.
    """
    a = old.select(*[F.col(c).alias(f"old_{c}") for c in (*layout.key, *layout.columns)], F.lit(True).alias("in_old"))
    b = new.select(*layout.key, *layout.columns, F.lit(True).alias("in_new"))
    met = F.lit(True)
    for c in layout.key:
        met = met & F.col(c).eqNullSafe(F.col(f"old_{c}"))
    same = F.lit(True)
    for c in layout.columns:
        same = same & F.col(c).eqNullSafe(F.col(f"old_{c}"))
    op = F.when(F.col("in_old").isNull(), "I").when(F.col("in_new").isNull(), "D").when(~same, "U")
    joined = b.join(a, met, "full_outer").withColumn("op", op).where("op IS NOT NULL")
    value = [F.when(F.col("op") == "D", F.col(f"old_{c}")).otherwise(F.col(c)).alias(c) for c in (*layout.key, *layout.columns)]
    return joined.select("op", *value)


def write_snapshot(df: DataFrame, path: str, layout: Layout) -> None:
    """Stores a state of a table by top buckets, and its digests beside it."""
    rows = layout.bucketed(df)
    rows.write.partitionBy(TOP).parquet(f"{path}/rows")
    stored = read_snapshot(df.sparkSession, path, rows.schema)
    bucket_digests(stored, layout).coalesce(1).write.parquet(f"{path}/digests")


def read_snapshot(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The stored rows; with a schema no file is opened to find one."""
    return spark.read.schema(schema).parquet(f"{path}/rows")


def changes_since(df: DataFrame, path: str, layout: Layout) -> DataFrame:
    """How ``df`` differs from the stored state, see ``compare``.

    ``df`` is read for its digests; of the stored rows only top buckets that
    differ are opened, and only leaves that differ are joined. A row whose
    bucket changed makes both buckets differ, so it is an update like others.
    """
    spark = df.sparkSession
    new = layout.bucketed(df)
    digests = materialise(bucket_digests(new, layout), "digests")
    buckets = changed_buckets(spark.read.parquet(f"{path}/digests"), digests)
    return compare(_inside(read_snapshot(spark, path, new.schema), buckets), _inside(new, buckets), layout)
