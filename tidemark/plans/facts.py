"""Jobs that load the fact tables."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions.keys import date_key, instant, month_key, time_key
from tidemark.operators.dedup import latest_load_first
from tidemark.operators.insert_absent import absent_rows
from tidemark.operators.key_filter import KeyFilter, absent_by_filter
from tidemark.operators.lineage import in_batches
from tidemark.operators.lookup import lookup_join, resolve_member
from tidemark.operators.scd2 import UNKNOWN_KEY
from tidemark.plans.dimensions import UNKNOWN_STATUS, load_spec
from tidemark.plans.ledger import Outcome
from tidemark.plans.staging import Warehouse, keys_of
from tidemark.schemas import CORE


@dataclass(frozen=True)
class Fact:
    """How staged events become rows of a fact table with one row per subject and minute."""

    table: str
    staging: str
    task: str
    ts: str
    measure: str
    date_sk: str
    time_sk: str
    target: str
    missing: str | None = None

    @property
    def key(self) -> list[str]:
        return ["baby_sk", self.date_sk, self.time_sk]


DURATIONS = Fact(
    "fact_sleep", "stg_sleep", "to_core_fact_sleep", "sleep_start", "sleep_duration",
    "sleep_start_date_sk", "sleep_start_time_sk", "duration_minutes",
)
STATUSES = Fact(
    "fact_diaper", "stg_diaper", "to_core_fact_diaper", "change_time", "status",
    "change_date_sk", "change_time_sk", "diaper_status_sk", missing=UNKNOWN_STATUS[0],
)
AMOUNTS = Fact(
    "fact_formula_feed", "stg_formula", "to_core_fact_formula", "feed_time", "amount_ml",
    "f_feeding_date_sk", "f_feeding_time_sk", "amount_ml",
)
FACTS = (DURATIONS, STATUSES, AMOUNTS)


def survivors_first(events: DataFrame, nk: str, ts: str) -> list[Column]:
    """Which event keeps a fact key that several claim.

    The smallest subject, then the earliest event, then its latest load. The
    last step also settles several loads of one event, so no separate pass is
    needed to reduce them first.
    """
    return [F.col(nk).asc_nulls_last(), F.col(ts).asc(), *latest_load_first(events)]


def keyed_events(staged: DataFrame, fact: Fact) -> DataFrame:
    """Complete events with their date and time keys; the test reaches the scan."""
    complete = F.col(fact.ts).isNotNull() & F.col(fact.measure).isNotNull()
    return staged.where(complete).withColumns(
        {fact.date_sk: date_key(F.col(fact.ts)), fact.time_sk: time_key(F.col(fact.ts))}
    )


def with_current_subject(events: DataFrame, dim: DataFrame, ts: str) -> DataFrame:
    """The subject's open version, or unknown."""
    current = dim.where("is_current").select(F.col("baby_nk").alias("baby_id"), "baby_sk")
    joined = lookup_join(events, current, "baby_id", ts)
    return joined.withColumn("baby_sk", F.coalesce("baby_sk", F.lit(UNKNOWN_KEY).cast("long")))


def with_subject_at(events: DataFrame, dim: DataFrame, ts: str) -> DataFrame:
    """The version valid at the event, else the open one, else unknown."""
    versions = dim.withColumnRenamed("baby_nk", "baby_id").select(
        "baby_id", "baby_sk", "valid_from", "valid_to", "is_current"
    )
    return resolve_member(events, versions, "baby_id", ts, "baby_sk", UNKNOWN_KEY)


def fact_rows(events: DataFrame, fact: Fact, wh: Warehouse, job_id: int) -> DataFrame:
    measure = F.col(fact.measure)
    if fact.missing is not None:
        measure = F.coalesce(measure, F.lit(fact.missing))
    return events.select(
        *fact.key,
        measure.alias(fact.target),
        instant(wh.run_ts).alias("loaded_at"),
        month_key(F.col(fact.date_sk)).alias("month_sk"),
        F.lit(job_id).alias("job_id"),
    )


def _loaded(events: DataFrame, written: int, job_id: int) -> Outcome:
    """Outcome of a load: events that were not written lost their key to one that was, or to the table.

    Every event is one row up to there, so they are counted where they are
    staged, by the two columns that make them complete.
    """
    return Outcome("success", job_id, written, written, collided=events.count() - written)


def load_fact(wh: Warehouse, dag: str, when: datetime, fact: Fact) -> Outcome:
    """Replaces the fact table from all of staging."""

    def work(job_id: int) -> Outcome:
        wh.ledger.take(job_id, fact.staging, fact.table)
        events = keyed_events(wh.tables.read(fact.staging), fact)
        known = with_current_subject(events, wh.tables.read("dim_baby"), fact.ts)
        order = survivors_first(known, "baby_id", fact.ts)
        rows = fact_rows(absent_rows(known, None, fact.key, order), fact, wh, job_id)
        written = wh.tables.replace(fact.table, rows, run=job_id)["rows"]
        keep_keys(wh, fact, job_id, afresh=True)
        return _loaded(events, written, job_id)

    spec = load_spec(fact.task, f"staging.{fact.staging}", fact.table, "initial")
    return wh.run(spec, dag, when, work)


def load_new_facts(wh: Warehouse, dag: str, when: datetime, fact: Fact) -> Outcome:
    """Appends the events of new batches whose fact key is not there yet.

    Events are chosen by batch, so late events load whatever their time. The
    table is only read in the months the batch touches.
    """

    def work(job_id: int) -> Outcome:
        staged = in_batches(wh.tables.read(fact.staging), wh.ledger.take(job_id, fact.staging, fact.table))
        events = keyed_events(staged, fact)
        known = with_subject_at(events, wh.tables.read("dim_baby"), fact.ts)
        order = survivors_first(known, "baby_id", fact.ts)
        if wh.key_blocks:
            fresh = _absent_by_filter(known, fact, wh, order)
        else:
            fresh = absent_rows(known, in_months_of(wh.tables.read(fact.table), events, fact), fact.key, order)
        written = wh.tables.append(fact.table, fact_rows(fresh, fact, wh, job_id))["rows"]
        keep_keys(wh, fact, job_id)
        return _loaded(events, written, job_id)

    spec = load_spec(fact.task, f"staging.{fact.staging}", fact.table, "incremental")
    return wh.run(spec, dag, when, work)


def key_filter(fact: Fact, blocks: int) -> KeyFilter:
    return KeyFilter(tuple(fact.key), blocks)


def keep_keys(wh: Warehouse, fact: Fact, job_id: int, afresh: bool = False) -> None:
    """Stores the key filters of what a run has just written; they count with its success, as its rows do."""
    if not wh.key_blocks:
        return
    by = key_filter(fact, wh.key_blocks)
    written = wh.spark.read.schema(CORE[fact.table]).parquet(wh.tables.path(fact.table, job_id))
    filters = by.build(written.where(F.col(by.run) == job_id))
    if afresh:
        wh.tables.replace(keys_of(fact.table), filters, [by.lead, by.run], run=job_id)
    else:
        wh.tables.append(keys_of(fact.table), filters, [by.lead, by.run])


def _absent_by_filter(known: DataFrame, fact: Fact, wh: Warehouse, order: list[Column]) -> DataFrame:
    by = key_filter(fact, wh.key_blocks)
    return absent_by_filter(
        known.withColumn(by.lead, month_key(F.col(fact.date_sk))), wh.tables.read(fact.table),
        wh.tables.partitions(fact.table, by.lead, by.run), wh.tables.read(keys_of(fact.table), by.schema), by, order,
    )


def in_months_of(table: DataFrame, events: DataFrame, fact: Fact) -> DataFrame:
    """The partitions of a fact table that can hold keys of these events.

    The months of the batch are read first, a handful of numbers, so that the
    filter is a partition filter on literals.
    """
    month = month_key(F.col(fact.date_sk)).alias("month")
    touched = [r.month for r in events.select(month).distinct().collect()]
    return table.where(F.col("month_sk").isin(touched))


def events_without_date(fact: DataFrame, dates: DataFrame, date_sk: str) -> DataFrame:
    """Fact rows whose date key the date dimension does not cover."""
    return fact.join(dates.select(F.col("date_sk").alias(date_sk)), date_sk, "left_anti")
