"""Sources. Text formats are read as text and typed later, so that a bad value
reaches quarantine instead of failing the read or turning into NULL."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tidemark.functions.keys import instant


def text_schema(columns: Sequence[str]) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType()) for c in columns])


def read_csv(
    spark: SparkSession, path: str | list[str], multiline: bool = False
) -> DataFrame:
    """CSV with a header row; every column is text.

    The columns are those of the header; files read together must agree on it.
    A byte-order mark is dropped and quoted fields may hold commas. Line breaks
    end a record, which keeps large files splittable; ``multiline`` allows them
    inside quotes at the price of one task per file.
    """
    return (
        spark.read.option("header", True)
        .option("inferSchema", False)
        .option("enforceSchema", False)
        .option("multiLine", multiline)
        .option("quote", '"')
        .option("escape", '"')
        .csv(path)
    )


def read_json(
    spark: SparkSession, path: str | list[str], columns: Sequence[str], multiline: bool = False
) -> DataFrame:
    """JSON documents whose elements are rows; every column is text.

    ``multiline`` reads files holding one array. Line-delimited files split
    across tasks and are the better choice for large inputs.
    """
    return spark.read.schema(text_schema(columns)).option("multiLine", multiline).json(path)


def jdbc_options(
    url: str,
    table: str | None = None,
    query: str | None = None,
    partition_column: str | None = None,
    bounds: tuple[object, object] | None = None,
    partitions: int = 1,
    fetch_size: int = 10_000,
    **extra: str,
) -> dict[str, str]:
    """Options of a JDBC scan; with a partition column it runs as parallel range reads."""
    if (table is None) == (query is None):
        raise ValueError("Give either a table or a query")
    options = {"url": url, "fetchsize": str(fetch_size), **extra}
    if partition_column is None:
        options["dbtable" if table else "query"] = table or query or ""
        return options
    if bounds is None:
        raise ValueError("A partitioned read needs bounds")
    options |= {
        "dbtable": table or f"({query}) AS source",
        "partitionColumn": partition_column,
        "lowerBound": str(bounds[0]),
        "upperBound": str(bounds[1]),
        "numPartitions": str(partitions),
    }
    return options


def read_jdbc(spark: SparkSession, **kwargs) -> DataFrame:
    return spark.read.format("jdbc").options(**jdbc_options(**kwargs)).load()


def read_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


_KINDS: dict[str, Callable[..., DataFrame]] = {
    "csv": read_csv,
    "api": read_json,
    "json": read_json,
    "db": read_jdbc,
    "table": read_table,
}


def read_source(spark: SparkSession, kind: str, **options) -> DataFrame:
    """Reader by name, in any case."""
    reader = _KINDS.get(kind.lower())
    if reader is None:
        raise ValueError(f"Unsupported source type: {kind}")
    return reader(spark, **options)


def fan_out(
    spark: SparkSession,
    path: str,
    columns: Sequence[str],
    parent: str,
    parents: DataFrame | None = None,
    multiline: bool = False,
) -> DataFrame:
    """Documents below ``<path>/<parent>=<id>/``, each row stamped with its parent.

    All parents are one scan; the id comes from the directory. Rows are kept
    for the given parents only, if a list is given.
    """
    fields = text_schema(columns).add(T.StructField(parent, T.IntegerType()))
    docs = spark.read.schema(fields).option("multiLine", multiline).json(path)
    if parents is None:
        return docs
    ids = parents.select(F.col(parents.columns[0]).cast("int").alias(parent)).distinct()
    return docs.join(ids, parent, "left_semi")


def after_mark(
    df: DataFrame, column: str, mark: datetime | None, lookback: timedelta | None = None
) -> DataFrame:
    """Rows newer than a stored high-water mark; all rows without a mark.

    The predicate is a plain comparison with a literal, so parquet and JDBC
    scans skip what lies before it. ``lookback`` re-reads a safety margin for
    rows that arrived late.
    """
    if mark is None:
        return df
    if lookback is not None:
        mark = mark - lookback
    return df.where(F.col(column) > instant(mark, df.schema[column].dataType))


def keyed_children(df: DataFrame, parent: str, value: object, order: str = "id") -> DataFrame:
    """All children of one parent in id order."""
    return df.where(F.col(parent) == F.lit(value)).orderBy(order)


def lookup(requests: DataFrame, df: DataFrame, key: str) -> DataFrame:
    """One row per requested id, with NULLs where there is none."""
    return requests.join(df, key, "left")


def lookup_few(requests: DataFrame, df: DataFrame, key: str, most: int = 1000) -> DataFrame:
    """``lookup`` that reads only what the requested ids may be in, where they are at most ``most``.

    Their ids become a list of literals, which reaches the scan: files and row
    groups whose range or bloom filter excludes all of them are skipped (see
    ``write_clustered``). More requests are a plain join.
    """
    listed = [r[0] for r in requests.select(key).where(F.col(key).isNotNull()).distinct().limit(most + 1).collect()]
    return lookup(requests, df.where(F.col(key).isin(listed)) if len(listed) <= most else df, key)


def listing(df: DataFrame, order: str = "id") -> DataFrame:
    return df.orderBy(order)
