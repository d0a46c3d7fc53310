"""Insert-if-absent on a primary key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame

from tidemark.operators.dedup import first_per_key


def absent_rows(
    batch: DataFrame, target: DataFrame | None, key: Sequence[str], order: Sequence[Column]
) -> DataFrame:
    """Rows of ``batch`` to append so that ``key`` stays unique in ``target``.

    Within the batch the first row in ``order`` wins; rows whose key the target
    already holds are left out. Both steps are partitioned by the key, so the
    batch is shuffled once.
    """
    winners = first_per_key(batch, key, order)
    if target is None:
        return winners
    return winners.join(target.select(*key), list(key), "left_anti")
