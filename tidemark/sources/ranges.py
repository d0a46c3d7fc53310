"""Parallel reads in ranges of a column that hold about equally many rows."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

ACCURACY = 4096
"""Size of the quantile sketch: ranks are right to about 0.1 % of the rows."""


def _image(df: DataFrame, column: str) -> Column:
    """The column as whole numbers, in its order."""
    kind = df.schema[column].dataType
    if isinstance(kind, T.DateType):
        return F.unix_date(column).cast("long")
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(column)
    if isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return F.col(column).cast("long")
    raise ValueError(f"{column} is neither a whole number, a date nor a timestamp")


def _literal(df: DataFrame, column: str, value: int) -> str:
    kind = df.schema[column].dataType
    if isinstance(kind, T.DateType):
        return f"DATE '{date(1970, 1, 1) + timedelta(days=value)}'"
    if isinstance(kind, T.TimestampType):
        moment = datetime(1970, 1, 1, tzinfo=timezone.utc) + timedelta(microseconds=value)
        return f"TIMESTAMP '{moment:%Y-%m-%d %H:%M:%S.%f}+00:00'"
    return str(value)


def _quantiles(value: Column, parts: int) -> Column:
    sketch = F.kll_sketch_agg_bigint(value, F.lit(ACCURACY))
    return F.kll_sketch_get_quantile_bigint(sketch, F.array(*[F.lit(i / parts) for i in range(1, parts)]))


def _between(df: DataFrame, column: str, low: int | None, high: int | None, closed: bool) -> str:
    parts = [] if low is None else [f"{column} > {_literal(df, column, low)}"]
    if high is not None:
        parts.append(f"{column} {'<=' if closed else '<'} {_literal(df, column, high)}")
    return " AND ".join(parts) or f"{column} IS NOT NULL"


def range_predicates(df: DataFrame, column: str, parts: int, then: str | None = None) -> list[str]:
    """About ``parts`` SQL conditions; each row meets exactly one, and each is met by about equally many rows.

    The bounds come from one pass with a quantile sketch, not from the least
    and greatest value, so skew of the column doesn't matter. A value that
    holds more than a share of the rows is a range of its own, cut further by
    ``then`` if that is given. Nulls of ``column`` are a last range; those of
    ``then`` go with the first part of a value. An empty table has that last range
    only. For a database, take ``df`` from its last extract: if the distribution has moved since,
    ranges are less even, and still each row is read once.
    """
    nulls = f"{column} IS NULL"
    value = _image(df, column)
    rows = df.where(F.col(column).isNotNull())
    if rows.isEmpty():
        return [nulls]
    bounds = rows.agg(_quantiles(value, parts)).first()[0] if parts > 1 else []
    hot = sorted({b for b, c in zip(bounds, bounds[1:]) if b == c})
    shares = {v: bounds.count(v) for v in hot}
    out, low = [], None
    for bound in sorted(set(bounds)):
        if bound in shares:
            out.append(_between(df, column, low, bound, closed=False))
        else:
            out.append(_between(df, column, low, bound, closed=True))
        low = bound
    out.append(_between(df, column, low, None, closed=False))
    return [*out, *_inside(df, column, value, shares, then), nulls]


def _inside(df: DataFrame, column: str, value: Column, shares: dict[int, int], then: str | None) -> list[str]:
    """The ranges of values that hold more than a share each; there are fewer of them than ranges."""
    whole = {v: f"{column} = {_literal(df, column, v)}" for v in shares}
    if then is None or not shares:
        return list(whole.values())
    second, out = _image(df, then), []
    finest = max(shares.values()) * 8
    known = df.where(value.isin(list(shares)) & F.col(then).isNotNull()).groupBy(value.alias("v"))
    found = {r.v: r.q for r in known.agg(_quantiles(second, finest).alias("q")).collect()}
    for v in shares:
        cuts = sorted({found[v][round(i * finest / shares[v]) - 1] for i in range(1, shares[v])}) if v in found else []
        low = None
        for high in [*cuts, None]:
            inner = _between(df, then, low, high, closed=True)
            if low is None:
                inner = f"({inner} OR {then} IS NULL)"
            out.append(f"{whole[v]} AND {inner}")
            low = high
    return out


def read_in_ranges(df: DataFrame, predicates: Sequence[str]) -> list[DataFrame]:
    """The table by range; the conditions reach the scan."""
    return [df.where(p) for p in predicates]


def read_jdbc_in_ranges(
    spark: SparkSession, url: str, table: str, predicates: Sequence[str], **properties: str
) -> DataFrame:
    """A database table with one task and one connection for each condition."""
    return spark.read.jdbc(url, table, predicates=list(predicates), properties=properties)
