"""Sets of loaded batches as ranges of run ids.

Batches succeed in any order: a run that was left open and is resumed keeps its
old id. A single "loaded up to" would pass over it, so what a table has loaded
is a set. It is kept as disjoint ranges; ids between two ranges are runs that
were still open when the table was loaded. Runs that failed can't come back,
so they split no range, and a set without open runs is one range.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.operators.carry import Ordered
from tidemark.operators.skew import HotKeys, hot_keys
from tidemark.session import materialise

ENDED = "success"
OPEN = "running"


def with_loaded(runs: DataFrame, loaded: DataFrame, key: str, hot: HotKeys | None = None) -> DataFrame:
    """``runs(key, job_id, status, ...)`` with ``loaded``: whether a range of the key holds the run.

    Range starts are merged into the runs, and every run looks at the last
    start before it: linear in both sides, no range is expanded. ``loaded``
    holds disjoint ranges ``key, first, last``.
    """
    points = runs.withColumns({"__at": F.col("job_id"), "__side": F.lit(1)}).unionByName(
        loaded.select(
            key, F.col("first").cast(runs.schema["job_id"].dataType).alias("__at"), F.lit(0).alias("__side"),
            F.struct("last").alias("__range"),
        ),
        allowMissingColumns=True,
    )
    carried = Ordered(points, key, ["__at", "__side"], hot=hot).with_latest("__in", F.col("__range")).where("__side = 1").rows()
    inside = F.coalesce(F.col("__in.last") >= F.col("job_id"), F.lit(False))
    return carried.select(*runs.columns, inside.alias("loaded"))


def is_new() -> Column:
    """Whether a run of ``with_loaded`` is a batch that is still to be loaded."""
    return (F.col("status") == ENDED) & ~F.col("loaded")


def ranges_after(runs: DataFrame, key: str, hot: HotKeys | None = None) -> DataFrame:
    """``key, first, last``: the set once every new batch of ``with_loaded`` is in it.

    A range reaches over neighbouring batches up to the next run that is open.
    Its ends are found by looking at the rows before and after; what is then
    paired is two rows a range.
    """
    inside = F.col("loaded") | (F.col("status") == ENDED)
    able = runs.where(inside | (F.col("status") == OPEN)).select(key, "job_id", F.struct(inside.alias("in")).alias("__is"))
    rows = Ordered(able, key, ["job_id"], hot=hot).with_previous("__before", F.col("__is")).with_next("__after", F.col("__is")).rows()
    first = ~F.coalesce(F.col("__before.in"), F.lit(False))
    last = ~F.coalesce(F.col("__after.in"), F.lit(False))
    ends = rows.where(F.col("__is.in") & (first | last)).select(key, "job_id", first.alias("__first"), last.alias("__last"))
    paired = Ordered(ends, key, ["job_id"], hot=hot).with_next("__end", F.struct("job_id")).rows()
    end = F.when(F.col("__last"), F.col("job_id")).otherwise(F.col("__end.job_id"))
    return paired.where("__first").select(key, F.col("job_id").alias("first"), end.alias("last"))


def load_everything(runs: DataFrame, loaded: DataFrame, key: str, hot: HotKeys | None = None) -> tuple[DataFrame, DataFrame]:
    """The new batches of every key, and its set once they are loaded.

    Hot keys are measured once for all steps; ``hot`` saves that too.
    """
    hot = hot_keys(runs, key, "job_id") if hot is None else hot
    marked = materialise(with_loaded(runs, loaded, key, hot), "marked")
    return marked.where(is_new()).drop("loaded"), ranges_after(marked, key, hot)
