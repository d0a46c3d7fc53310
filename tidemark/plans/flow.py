"""The order of the jobs: staging, then dimensions, then facts."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame

from tidemark.plans import dimensions as d
from tidemark.plans import staging as s
from tidemark.plans.facts import FACTS, load_fact, load_new_facts
from tidemark.plans.ledger import Outcome
from tidemark.plans.staging import Warehouse


@dataclass(frozen=True)
class Sources:
    """Operational tables and landed files.

    An initial load takes statuses from ``status_documents``, an incremental
    one from the ``statuses`` table. ``amounts`` is the path of a CSV file.
    """

    subjects: DataFrame
    durations: DataFrame
    amounts: str
    statuses: DataFrame | None = None
    status_documents: DataFrame | None = None


def initial_load(wh: Warehouse, src: Sources, when: datetime, dag: str = "initial") -> dict[str, Outcome]:
    done = {
        "stg_baby": s.stage_subjects(wh, dag, when, src.subjects),
        "stg_diaper": s.stage_status_documents(wh, dag, when, src.status_documents),
        "stg_sleep": s.stage_durations(wh, dag, when, src.durations),
        "stg_formula": s.stage_amounts(wh, dag, when, src.amounts),
        "dim_date": d.load_dates(wh, dag, when),
        "dim_time": d.load_times(wh, dag, when),
        "dim_diaper_status": d.load_statuses(wh, dag, when),
        "dim_baby": d.load_subjects(wh, dag, when),
    }
    return done | {f.table: load_fact(wh, dag, when, f) for f in FACTS}


def incremental_load(
    wh: Warehouse, src: Sources, when: datetime, dag: str = "incremental"
) -> dict[str, Outcome]:
    done = {
        "stg_baby": s.restage_subjects(wh, dag, when, src.subjects),
        "stg_diaper": s.stage_new_statuses(wh, dag, when, src.statuses),
        "stg_sleep": s.stage_new_durations(wh, dag, when, src.durations),
        "stg_formula": s.stage_amounts(wh, dag, when, src.amounts, incremental=True),
        "dim_baby": d.load_subject_versions(wh, dag, when),
        "dim_diaper_status": d.load_new_statuses(wh, dag, when),
    }
    return done | {f.table: load_new_facts(wh, dag, when, f) for f in FACTS}
