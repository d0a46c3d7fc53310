"""Looking at the neighbouring row of the same key, safely for hot keys.

``LAG``, ``LEAD`` and as-of lookups all carry a value along the rows of a key.
Without hot keys that is a plain window. With hot keys, rows are windowed per
(key, slice), and what a slice needs from those before or after it comes from
a small summary with one row per slice of a hot key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.operators.skew import HOT, SLICE, HotKeys, hot_keys, with_slice


class Ordered:
    """The rows of ``df`` per ``key`` in the order of ``order``.

    The first order column cuts hot keys into slices. The rows must be unique
    on key and order, and key and first order column must not be NULL. ``hot``
    saves measuring rows that come from others already measured; any hot keys
    give the same result.
    """

    def __init__(
        self,
        df: DataFrame,
        key: str,
        order: Sequence[str],
        parts: int | None = None,
        hot: HotKeys | None = None,
    ):
        self.key, self.order = key, list(order)
        self.hot = hot_keys(df, key, self.order[0], parts) if hot is None else hot
        self.df = with_slice(df, self.hot, self.order[0]) if self.hot else df

    def where(self, condition: Column | str) -> Ordered:
        self.df = self.df.where(condition)
        return self

    def with_previous(self, name: str, value: Column) -> Ordered:
        """``value`` (never NULL) of the row before."""
        return self._add(name, value, F.lag(value), F.max_by, earlier=True)

    def with_next(self, name: str, value: Column) -> Ordered:
        """``value`` (never NULL) of the row after."""
        return self._add(name, value, F.lead(value), F.min_by, earlier=False)

    def with_latest(self, name: str, value: Column) -> Ordered:
        """Latest ``value`` that is not NULL, up to and including each row."""
        return self._add(name, value, F.last(value, ignorenulls=True), F.max_by, earlier=True)

    def _add(self, name: str, value: Column, nearby: Column, edge, earlier: bool) -> Ordered:
        """``nearby`` within a slice, else the nearest value of the other slices.

        All windows of the same rows sort in the same direction, so they share
        one shuffle and one sort.
        """
        if not self.hot:
            window = Window.partitionBy(self.key).orderBy(*self.order)
            self.df = self.df.select("*", nearby.over(window).alias(name))
            return self

        edges = (
            self.df.where(HOT)
            .groupBy(self.key, SLICE)
            .agg(edge(value, F.when(value.isNotNull(), F.struct(*self.order))).alias("__edge"))
        )
        slices = Window.partitionBy(self.key).orderBy(
            F.col(SLICE).asc() if earlier else F.col(SLICE).desc()
        )
        passed = slices.rowsBetween(Window.unboundedPreceding, -1)
        far = edges.select(
            self.key, SLICE, F.last("__edge", ignorenulls=True).over(passed).alias("__far")
        )
        window = Window.partitionBy(self.key, SLICE).orderBy(*self.order)
        columns = self.df.columns
        # ``far`` has at most one row per slice of a hot key, see skew.py
        self.df = (
            self.df.select("*", nearby.over(window).alias("__near"))
            .join(F.broadcast(far), [self.key, SLICE], "left")
            .select(*columns, F.coalesce("__near", "__far").alias(name))
        )
        return self

    def rows(self) -> DataFrame:
        return self.df.drop(SLICE, HOT)
