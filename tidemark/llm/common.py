"""What the operators share: reading, batches of bounded size, groups within tasks."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import configure, materialise, shuffle_parts

BATCH_ROWS = 2000
BATCH_BYTES = 8 << 20
_ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

__all__ = ["by_group", "from_column", "longs", "materialise", "prepare", "read", "shuffle_parts", "texts"]


def prepare(spark: SparkSession) -> SparkSession:
    """Session settings: batches for Python workers are bounded in rows and in bytes.

    Workers look for this package where the driver found it; a cluster that
    has it nowhere gets it with ``--py-files``.
    """
    configure(spark)
    workers = spark.sparkContext.environment
    if _ROOT not in workers.get("PYTHONPATH", "").split(os.pathsep):
        workers["PYTHONPATH"] = os.pathsep.join(filter(None, [_ROOT, workers.get("PYTHONPATH")]))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return spark


def read(spark: SparkSession, path: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{path}/{name}.parquet")


def texts(column: pa.Array) -> list[str]:
    """The strings of a column; null counts as empty."""
    return [x or "" for x in column.to_pylist()]


def longs(column: pa.Array) -> np.ndarray:
    return column.to_numpy(zero_copy_only=False).astype(np.int64)


def from_column(name: str, kind: str) -> F.Column:
    """A column by its exact name, cast."""
    return F.col(f"`{name}`").cast(kind)


def by_group(
    df: DataFrame, key: str, work: Callable[[pa.Table, np.ndarray], Iterator[pa.RecordBatch]], schema: str
) -> DataFrame:
    """Runs ``work`` over whole groups of the long column ``key``.

    Rows are dealt and sorted by the key, so a task streams its groups: ``work``
    gets a table of complete groups and the first row of each, with one more
    entry for the end. It holds one batch and one group, hence callers bound
    the size of a group beforehand. Many small groups share one call.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: list[pa.RecordBatch] = []
        last = None
        for batch in batches:
            if batch.num_rows == 0:
                continue
            keys = batch.column(key).to_numpy(zero_copy_only=False)
            cut = int(np.searchsorted(keys, keys[-1], "left"))
            if cut == 0 and (last is None or keys[-1] == last):
                parts.append(batch)
            else:
                yield from whole([*parts, batch.slice(0, cut)])
                parts = [batch.slice(cut)]
            last = keys[-1]
        if parts:
            yield from whole(parts)

    def whole(parts: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(parts).combine_chunks()
        if table.num_rows:
            keys = table.column(key).to_numpy()
            starts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1], True])
            yield from work(table, starts)

    return df.repartition(F.col(key)).sortWithinPartitions(key).mapInArrow(run, schema)
