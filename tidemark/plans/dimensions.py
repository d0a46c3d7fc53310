"""Jobs that build and maintain the dimensions."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import DataFrame, functions as F

from tidemark.functions.keys import instant
from tidemark.operators import scd2
from tidemark.operators.dedup import latest_load_first, first_per_key
from tidemark.operators.insert_absent import absent_rows
from tidemark.operators.lineage import in_batches
from tidemark.operators.series import date_members, time_members
from tidemark.operators.surrogate import assign_keys
from tidemark.plans.ledger import JobSpec, Outcome
from tidemark.plans.staging import Warehouse
from tidemark.schemas import CORE
from tidemark.session import materialise

# Fixed values
FIRST_DATE, LAST_DATE = date(2020, 1, 1), date(2030, 12, 31)
UNKNOWN_STATUS = ("UNKNOWN", "UNKNOWN STATUS")
UNKNOWN_SUBJECT = ("Unknown Baby", "UTC")


def load_spec(task: str, path: str, table: str, load_type: str) -> JobSpec:
    return JobSpec(task, "transform_load", "db", path, "core", table, load_type)


SUBJECT_VERSIONS = scd2.VersionedBy(
    nk="baby_nk", attr="timezone", effective="loaded_at", order=("job_id", "loaded_at", "row_hash")
)


def load_dates(
    wh: Warehouse, dag: str, when: datetime, first: date = FIRST_DATE, last: date = LAST_DATE
) -> Outcome:
    def work(job_id: int) -> Outcome:
        rows = wh.tables.replace("dim_date", date_members(wh.spark, first, last), run=job_id)["rows"]
        return Outcome("success", job_id, rows, rows)

    return wh.run(
        load_spec("to_core_dim_date", "no path", "dim_date", "initial"), dag, when, work
    )


def load_times(wh: Warehouse, dag: str, when: datetime) -> Outcome:
    def work(job_id: int) -> Outcome:
        rows = wh.tables.replace("dim_time", time_members(wh.spark), run=job_id)["rows"]
        return Outcome("success", job_id, rows, rows)

    return wh.run(
        load_spec("to_core_dim_time", "no path", "dim_time", "initial"), dag, when, work
    )


def status_members(statuses: DataFrame, wh: Warehouse, job_id: int) -> DataFrame:
    return statuses.select(
        F.col("status").alias("diaper_status_sk"),
        F.col("status").alias("diaper_status"),
        instant(wh.run_ts).alias("loaded_at"),
        F.lit(None).cast("timestamp").alias("updated_at"),
        F.lit(job_id).alias("job_id"),
    )


def load_statuses(wh: Warehouse, dag: str, when: datetime) -> Outcome:
    """All staged statuses and the unknown one."""

    def work(job_id: int) -> Outcome:
        wh.ledger.take(job_id, "stg_diaper", "dim_diaper_status")
        staged = wh.tables.read("stg_diaper").where("status IS NOT NULL")
        latest = first_per_key(staged, ["status"], latest_load_first(staged))
        sk, name = UNKNOWN_STATUS
        unknown = wh.spark.range(1).select(
            F.lit(sk).alias("diaper_status_sk"),
            F.lit(name).alias("diaper_status"),
            instant(wh.run_ts).alias("loaded_at"),
            F.lit(None).cast("timestamp").alias("updated_at"),
            F.lit(0).alias("job_id"),
        )
        members = status_members(latest.where(F.col("status") != sk), wh, job_id)
        rows = wh.tables.replace(
            "dim_diaper_status",
            unknown.unionByName(members),
            measures={"new": F.count_if(F.col("job_id") == job_id)},
            run=job_id,
        )
        return Outcome("success", job_id, rows["rows"], rows["new"])

    spec = load_spec("to_core_dim_diaper_status", "staging.stg_diaper", "dim_diaper_status", "initial")
    return wh.run(spec, dag, when, work)


def load_new_statuses(wh: Warehouse, dag: str, when: datetime) -> Outcome:
    """Statuses of the new batches that the dimension lacks."""

    def work(job_id: int) -> Outcome:
        staged = in_batches(wh.tables.read("stg_diaper"), wh.ledger.take(job_id, "stg_diaper", "dim_diaper_status"))
        seen = status_members(staged.where("status IS NOT NULL").select("status").distinct(), wh, job_id)
        known = wh.tables.read("dim_diaper_status").where(F.col("job_id") != job_id)
        fresh = absent_rows(seen, known, ["diaper_status_sk"], [F.col("diaper_status_sk")])
        rows = wh.tables.append("dim_diaper_status", fresh)["rows"]
        return Outcome("success", job_id, rows, rows)

    spec = load_spec(
        "to_core_dim_diaper_status", "staging.stg_diaper", "dim_diaper_status", "incremental"
    )
    return wh.run(spec, dag, when, work)


def _subject_rows(versions: DataFrame, wh: Warehouse, job_id: int) -> DataFrame:
    now = instant(wh.run_ts)
    return versions.select(
        "baby_sk",
        "baby_nk",
        F.col("name").alias("baby_name"),
        F.col("timezone").alias("timezone_iana"),
        "valid_from",
        "valid_to",
        "is_current",
        F.lit(job_id).alias("job_id"),
        now.alias("loaded_at"),
        F.when(~F.col("is_current"), now).alias("updated_at"),
    )


def load_subjects(wh: Warehouse, dag: str, when: datetime) -> Outcome:
    """One open version per staged subject, and the unknown subject.

    The unknown subject's key is -1, the key facts use for it.
    """

    def work(job_id: int) -> Outcome:
        wh.ledger.take(job_id, "stg_baby", "dim_baby")
        staged = wh.tables.read("stg_baby").withColumnRenamed("source_id", "baby_nk")
        order = [F.col("loaded_at").desc(), F.col("job_id").desc(), F.col("row_hash").desc()]
        versions = scd2.initial_versions(staged, SUBJECT_VERSIONS, order)
        keyed = assign_keys(versions, ["baby_nk", "valid_from"], "baby_sk")
        name, zone = UNKNOWN_SUBJECT
        values = {
            "baby_sk": F.lit(scd2.UNKNOWN_KEY),
            "baby_nk": F.lit(-1),
            "baby_name": F.lit(name),
            "timezone_iana": F.lit(zone),
            "valid_from": instant(scd2.UNKNOWN_FROM),
            "valid_to": instant(scd2.UNKNOWN_TO),
            "is_current": F.lit(True),
            "job_id": F.lit(0),
            "loaded_at": instant(wh.run_ts),
            "updated_at": F.lit(None),
        }
        typed = {f.name: values[f.name].cast(f.dataType) for f in CORE["dim_baby"].fields}
        unknown = scd2.unknown_member(wh.spark, typed)
        rows = wh.tables.replace(
            "dim_baby",
            unknown.unionByName(_subject_rows(keyed, wh, job_id)),
            measures={"new": F.count_if(F.col("job_id") == job_id)},
            run=job_id,
        )
        return Outcome("success", job_id, rows["rows"], rows["new"])

    spec = load_spec("to_core_dim_baby", "staging.stg_baby", "dim_baby", "initial")
    return wh.run(spec, dag, when, work)


def load_subject_versions(
    wh: Warehouse, dag: str, when: datetime, collapse_repeats: bool = True
) -> Outcome:
    """Opens versions for changed and new subjects and closes the replaced ones.

    A changed time zone opens a version; a changed name alone does not.
    """
    by = SUBJECT_VERSIONS

    def work(job_id: int) -> Outcome:
        staged = in_batches(wh.tables.read("stg_baby"), wh.ledger.take(job_id, "stg_baby", "dim_baby"))
        batch = staged.withColumnRenamed("source_id", by.nk).where(
            F.col(by.nk).isNotNull() & F.col("timezone").isNotNull() & F.col("name").isNotNull()
        )
        dimension = wh.tables.read("dim_baby")
        # Read by three steps below.
        changes = materialise(
            scd2.compare_with_current(batch, dimension, by, "timezone_iana", collapse_repeats),
            "changes",
        )
        if changes.isEmpty():
            return Outcome("success", job_id)
        opened = assign_keys(
            scd2.new_versions(changes, by),
            [by.nk, "valid_from", "timezone"],
            "baby_sk",
            existing=dimension,
        )
        now = instant(wh.run_ts)
        bucket = wh.tables.bucket("dim_baby")
        touched = [r[0] for r in changes.select(bucket).distinct().collect()]  # no more than there are buckets
        affected = wh.tables.read("dim_baby", buckets=touched)
        kept = scd2.expire_current(affected, scd2.expiry(changes, by), by.nk, now)
        is_new = F.col("job_id") == job_id
        seen = wh.tables.replace_buckets(
            "dim_baby",
            kept.unionByName(_subject_rows(opened, wh, job_id)),
            job_id,
            measures={
                "new": F.count_if(is_new),
                "closed": F.count_if(~is_new & (F.col("updated_at") == now)),
            },
        )
        return Outcome("success", job_id, seen["new"] + seen["closed"], seen["new"])

    spec = load_spec("to_core_dim_baby", "staging.stg_baby", "dim_baby", "incremental")
    return wh.run(spec, dag, when, work)
