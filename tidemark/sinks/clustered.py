"""Tables laid out by a key, so that reads by key skip what they don't need."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

ROW_GROUP = 16 << 20
"""Bytes of a row group, the smallest part of a file that a read can skip by its ranges."""


def write_clustered(
    df: DataFrame, path: str, by: str, then: Sequence[str] = (), files: int | None = None,
    distinct: int = 1_000_000, row_group: int = ROW_GROUP,
) -> None:
    """Writes files that each hold a range of ``by``, sorted within.

    Ranges are cut on ``by`` and ``then`` together, so the rows of one key may
    lie in several files and a key with a third of all rows is no single task.
    The ranges in the footers and a Parquet bloom filter of ``by`` (for
    ``distinct`` values a row group) let a filter on the key pass over all
    other row groups. Rows without a key come first.
    """
    order = [by, *then]
    ranged = df.repartitionByRange(*([files] if files else []), *order).sortWithinPartitions(*order)
    (
        ranged.write.option(f"parquet.bloom.filter.enabled#{by}", "true")
        .option(f"parquet.bloom.filter.expected.ndv#{by}", str(distinct))
        .option("parquet.block.size", str(row_group))
        .parquet(path)
    )
