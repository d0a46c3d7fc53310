"""Queries on the run ledger: which batches are new, what ran last.

The ledger is one row per run (see ``schemas.LEDGER``). These operators read it
as data; ``plans.ledger`` writes it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from tidemark.operators.batches import is_new, with_loaded
from tidemark.operators.skew import HotKeys


def latest_state(log: DataFrame, key: str = "job_id", order: str = "seq") -> DataFrame:
    """Current row of every run from the append-only log of its states."""
    state = F.struct(*[c for c in log.columns if c != key])
    return (
        log.groupBy(key)
        .agg(F.max_by(state, F.col(order)).alias("__state"))
        .select(key, "__state.*")
    )


def succeeded(runs: DataFrame, schema: str, table: str, stage: str) -> DataFrame:
    return runs.where(
        (F.col("destination_schema") == schema)
        & (F.col("destination_table_name") == table)
        & (F.col("pipeline_stage") == stage)
        & (F.col("status") == "success")
    )


def last_success(runs: DataFrame, value: str) -> DataFrame:
    """``value`` of the run that ended last; one row, NULL without any run."""
    newest = F.struct("ended_at", "job_id")
    return runs.agg(F.max_by(F.col(value), newest).alias(value))


def last_success_per(runs: DataFrame, keys: list[str], value: str) -> DataFrame:
    """The same for every group of runs, for many destinations at once."""
    newest = F.struct("ended_at", "job_id")
    return runs.where(F.col("status") == "success").groupBy(*keys).agg(
        F.max_by(F.col(value), newest).alias(value)
    )


def loaded_ranges(runs: DataFrame, core_table: str) -> DataFrame:
    """``table, first, last``: the batches a core table holds, by its last successful load.

    A load that recorded no set stands for all batches up to its parent.
    """
    done = succeeded(runs, "core", core_table, "transform_load").where("parent_job_id IS NOT NULL")
    up_to_parent = F.array(F.struct(F.lit(0).alias("first"), F.col("parent_job_id").cast("int").alias("last")))
    if "loaded_batches" in runs.columns:
        done = succeeded(runs, "core", core_table, "transform_load")
        done = done.where("parent_job_id IS NOT NULL OR loaded_batches IS NOT NULL")
        ranges = F.coalesce("loaded_batches", up_to_parent)
    else:
        ranges = up_to_parent
    newest = last_success(done.withColumn("ranges", ranges), "ranges")
    return newest.select(F.lit(core_table).alias("table"), F.inline("ranges"))


def extract_runs(runs: DataFrame, staging_table: str, core_table: str) -> DataFrame:
    """``table, job_id, status`` of the runs that staged a table, under the core table they feed."""
    staged = (
        (F.col("destination_schema") == "staging")
        & (F.col("destination_table_name") == staging_table)
        & (F.col("pipeline_stage") == "extract")
    )
    return runs.where(staged).select(F.lit(core_table).alias("table"), "job_id", "status")


def new_batches(runs: DataFrame, staging_table: str, core_table: str) -> DataFrame:
    """Ids of staging batches the core table has not loaded yet.

    These are the successful extracts outside the set of its last successful
    load, or all of them before its first load. An extract that succeeds after
    one with a higher id was loaded is found as well.
    """
    extracts = extract_runs(runs, staging_table, core_table)
    none_hot = HotKeys("table", T.StringType(), [])  # a ledger has few runs of one table
    marked = with_loaded(extracts, loaded_ranges(runs, core_table), "table", none_hot)
    return marked.where(is_new()).select("job_id")


def only_batches(staged: DataFrame, batches: DataFrame) -> DataFrame:
    """Staged rows of the given batches.

    Staging is partitioned by ``job_id``. The list comes from the ledger, some
    numbers per load, so it is read first and becomes a partition filter on
    literals: no batch is shuffled by its id.
    """
    return in_batches(staged, [r["job_id"] for r in batches.select("job_id").distinct().collect()])


def in_batches(staged: DataFrame, listed: list[int]) -> DataFrame:
    return staged.where(F.col("job_id").isin(listed))


def has_run(runs: DataFrame, condition: Column) -> bool:
    """Whether any run meets the condition; stops at the first."""
    return not runs.where(condition).limit(1).isEmpty()
