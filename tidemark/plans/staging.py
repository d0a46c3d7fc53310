"""Jobs that land source rows in staging tables."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark.functions.keys import instant
from tidemark.plans import mappings as m
from tidemark.plans.ledger import JobSpec, Ledger, Outcome, from_micros, run_job
from tidemark.sinks.quarantine import drop_quarantine, quarantine_rows, write_quarantine
from tidemark.sinks.tables import Tables
from tidemark.sources.readers import after_mark, read_csv


def keys_of(table: str) -> str:
    """The table that holds the key filters of a fact table."""
    return f"{table}_keys"


@dataclass
class Warehouse:
    """Where tables, ledger and quarantine live, and the instant of this run.

    With ``key_blocks`` facts keep filters of their keys, of so many blocks for a
    month's batch, which later loads ask before they read (see ``KeyFilter``).
    """

    spark: SparkSession
    root: str
    run_ts: datetime = field(default_factory=lambda: datetime.now(timezone.utc))
    key_blocks: int = 0

    def __post_init__(self) -> None:
        self.ledger = Ledger(self.spark, f"{self.root}/metadata/etl_job", lambda: self.run_ts)
        self.tables = Tables(self.spark, f"{self.root}/tables", self.ledger.unfinished)
        self.quarantine = f"{self.root}/quarantine"

    def run(
        self, spec: JobSpec, dag: str, when: datetime, work: Callable[[int], Outcome]
    ) -> Outcome:
        """``run_job`` on this warehouse: rows and quarantine of a run count with its success only."""

        def undo(job_id: int) -> None:
            self.tables.discard(spec.table, job_id)
            self.tables.discard(keys_of(spec.table), job_id)
            drop_quarantine(self.spark, f"{self.quarantine}/{spec.table}", job_id)

        return run_job(self.ledger, spec, dag, when, work, undo)


def extract_spec(task: str, source: str, path: str, table: str, load_type: str) -> JobSpec:
    return JobSpec(task, "extract", source, path, "staging", table, load_type)


STAGE_SUBJECTS = extract_spec("to_stg_baby", "db", "public.baby_info", "stg_baby", "initial")
STAGE_SUBJECTS_AGAIN = extract_spec(
    "to_stg_baby", "db", "public.baby_info", "stg_baby", "full_reload"
)
STAGE_STATUS_DOCUMENTS = extract_spec(
    "to_stg_diaper", "api", "/baby/{baby_id}/diaper", "stg_diaper", "initial"
)
STAGE_STATUSES = extract_spec(
    "to_stg_diaper", "db", "public.diaper_data", "stg_diaper", "incremental"
)
STAGE_DURATIONS = extract_spec("to_stg_sleep", "db", "public.sleep_data", "stg_sleep", "initial")
STAGE_NEW_DURATIONS = extract_spec(
    "to_stg_sleep", "db", "public.sleep_data", "stg_sleep", "incremental"
)
STAGE_AMOUNTS = extract_spec("to_stg_formula", "csv", "", "stg_formula", "initial")
STAGE_NEW_AMOUNTS = extract_spec("to_stg_formula", "csv", "", "stg_formula", "incremental")


def split_rows(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Mapped rows as (good, bad)."""
    good = rows.where("error_message IS NULL").drop("error_message", "raw")
    return good, rows.where("error_message IS NOT NULL")


def stage_rows(
    wh: Warehouse,
    spec: JobSpec,
    source: DataFrame,
    mapping: m.Mapping,
    job_id: int,
    mark_column: str | None = None,
    previous_mark: datetime | None = None,
    parent_id: Column | None = None,
) -> Outcome:
    """Types, hashes and writes a batch in one pass; bad rows go to quarantine.

    The batch's mark is its newest event time. An empty batch keeps the
    previous mark, so the next run does not start over.
    """
    rows = m.map_rows(source, mapping, parent_id).withColumns(
        {
            "loaded_at": instant(wh.run_ts),
            "job_id": F.lit(job_id),
            "rejected": F.col("error_message").isNotNull(),
        }
    )
    good = ~F.col("rejected")
    measures = {"good": F.count_if(good)}
    if mark_column:
        measures["mark"] = F.max(F.when(good, F.unix_micros(mark_column)))
    if spec.replaces:
        seen = wh.tables.replace(spec.table, rows, measures=measures, run=job_id)
    else:
        seen = wh.tables.append(spec.table, rows, measures=measures)
    if seen["rows"] > seen["good"]:
        bad = wh.tables.rejected(spec.table, job_id)
        write_quarantine(
            quarantine_rows(bad, job_id, mapping.name, wh.run_ts), f"{wh.quarantine}/{spec.table}", job_id
        )
    mark = seen.get("mark")
    return Outcome(
        "success", job_id, seen["good"], seen["good"],
        previous_mark if mark is None else from_micros(mark),
    )


def stage_table(
    wh: Warehouse,
    spec: JobSpec,
    dag: str,
    when: datetime,
    source: DataFrame,
    mapping: m.Mapping,
    mark_column: str | None = None,
) -> Outcome:
    """Stages an operational table; an incremental job reads past its last mark.

    Typing costs more than moving a row, so rows are dealt evenly first: a table
    of few row groups, or one whose new rows lie together, would be few tasks.
    """
    event_column = {f.name: f.source for f in mapping.fields}.get(mark_column or "")

    def work(job_id: int) -> Outcome:
        mark = None
        rows = source
        if spec.load_type == "incremental" and event_column:
            mark = wh.ledger.last_mark("staging", spec.table, "extract")
            rows = after_mark(source, event_column, mark)
        return stage_rows(wh, spec, rows.hint("rebalance"), mapping, job_id, mark_column, mark)

    return wh.run(spec, dag, when, work)


def stage_subjects(wh: Warehouse, dag: str, when: datetime, table: DataFrame) -> Outcome:
    source = table.select("id", "name", "timezone")
    return stage_table(wh, STAGE_SUBJECTS, dag, when, source, m.SUBJECT)


def restage_subjects(wh: Warehouse, dag: str, when: datetime, table: DataFrame) -> Outcome:
    source = table.select("id", "name", "timezone")
    return stage_table(wh, STAGE_SUBJECTS_AGAIN, dag, when, source, m.SUBJECT)


def stage_durations(wh: Warehouse, dag: str, when: datetime, table: DataFrame) -> Outcome:
    source = table.select("id", "sleep_start", "sleep_duration", "baby_id")
    return stage_table(wh, STAGE_DURATIONS, dag, when, source, m.DURATION_TABLE, "sleep_start")


def stage_new_durations(wh: Warehouse, dag: str, when: datetime, table: DataFrame) -> Outcome:
    source = table.select("id", "sleep_start", "sleep_duration", "baby_id")
    return stage_table(wh, STAGE_NEW_DURATIONS, dag, when, source, m.DURATION_TABLE, "sleep_start")


def stage_new_statuses(wh: Warehouse, dag: str, when: datetime, table: DataFrame) -> Outcome:
    source = table.select("id", "change_time", "status", "baby_id")
    return stage_table(wh, STAGE_STATUSES, dag, when, source, m.STATUS_TABLE, "change_time")


def stage_status_documents(
    wh: Warehouse, dag: str, when: datetime, documents: DataFrame
) -> Outcome:
    """Stages the documents of all staged subjects.

    ``documents`` carry the subject in ``parent_id``, as ``fan_out`` yields
    them; those of subjects that were not staged are left out.
    """

    def work(job_id: int) -> Outcome:
        subjects = wh.tables.read("stg_baby").select(F.col("source_id").alias("parent_id"))
        known = documents.join(subjects.distinct(), "parent_id", "left_semi")
        return stage_rows(
            wh, STAGE_STATUS_DOCUMENTS, known, m.STATUS_DOCUMENT, job_id, "change_time",
            parent_id=F.col("parent_id"),
        )

    return wh.run(STAGE_STATUS_DOCUMENTS, dag, when, work)


def stage_amounts(
    wh: Warehouse, dag: str, when: datetime, path: str, incremental: bool = False
) -> Outcome:
    """Stages a CSV file. An incremental run takes a file once and does not
    filter it by the mark, so old events in a new file still load."""
    spec = (STAGE_NEW_AMOUNTS if incremental else STAGE_AMOUNTS).reading(path)

    def work(job_id: int) -> Outcome:
        mark = wh.ledger.last_mark("staging", spec.table, "extract") if incremental else None
        return stage_rows(
            wh, spec, read_csv(wh.spark, path), m.AMOUNT_FILE, job_id, "feed_time", mark
        )

    return wh.run(spec, dag, when, work)
