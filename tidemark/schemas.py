"""Declared schemas. Nothing is inferred from data."""

from __future__ import annotations

from pyspark.sql import types as T

_I, _L, _S, _B = T.IntegerType(), T.LongType(), T.StringType(), T.BooleanType()
_TS, _D = T.TimestampType(), T.DateType()


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(n, t) for n, t in fields.items()])


# Operational tables
BABY_INFO = _struct(id=_I, name=_S, timezone=_S)
SLEEP_DATA = _struct(id=_I, sleep_start=_TS, sleep_duration=_I, baby_id=_I)
DIAPER_DATA = _struct(id=_I, change_time=_TS, status=_S, baby_id=_I)

_LINEAGE = {"row_hash": _S, "loaded_at": _TS, "job_id": _I}

STAGING = {
    "stg_baby": _struct(source_id=_I, name=_S, timezone=_S, **_LINEAGE),
    "stg_sleep": _struct(source_id=_I, sleep_start=_TS, sleep_duration=_I, baby_id=_I, **_LINEAGE),
    "stg_diaper": _struct(source_id=_I, change_time=_TS, status=_S, baby_id=_I, **_LINEAGE),
    "stg_formula": _struct(source_id=_S, feed_time=_TS, amount_ml=_I, baby_id=_I, **_LINEAGE),
}

CORE = {
    "fact_sleep": _struct(
        baby_sk=_L, sleep_start_date_sk=_I, sleep_start_time_sk=_I, duration_minutes=_I,
        loaded_at=_TS, month_sk=_I, job_id=_I,
    ),
    "fact_diaper": _struct(
        baby_sk=_L, change_date_sk=_I, change_time_sk=_I, diaper_status_sk=_S,
        loaded_at=_TS, month_sk=_I, job_id=_I,
    ),
    "fact_formula_feed": _struct(
        baby_sk=_L, f_feeding_date_sk=_I, f_feeding_time_sk=_I, amount_ml=_I,
        loaded_at=_TS, month_sk=_I, job_id=_I,
    ),
    "dim_baby": _struct(
        baby_sk=_L, baby_nk=_I, baby_name=_S, timezone_iana=_S, valid_from=_TS, valid_to=_TS,
        is_current=_B, job_id=_I, loaded_at=_TS, updated_at=_TS,
    ),
    "dim_diaper_status": _struct(
        diaper_status_sk=_S, diaper_status=_S, loaded_at=_TS, updated_at=_TS, job_id=_I,
    ),
    "dim_date": _struct(date_sk=_I, full_date=_D, year=_I, month=_I, day=_I),
    "dim_time": _struct(time_sk=_I, full_time=_S, hour=_I, minute=_I),
}

# What a rejected row holds besides.
REJECT = _struct(error_message=_S, raw=_S)

# Directory columns, outermost first. A batch owns its partitions, so writing
# it again after a failure replaces what the failed attempt left.
# Staging keeps rejected rows apart, so that good and bad rows are written in one pass.
PARTITIONS = {
    **{name: ["job_id", "rejected"] for name in STAGING},
    **{name: ["month_sk", "job_id"] for name in CORE if name.startswith("fact_")},
    "dim_diaper_status": ["job_id"],
}

# Tables kept in buckets by the hash of a column, so that a change rewrites the buckets it touches.
BUCKETS = {"dim_baby": ("baby_nk", 64)}

# Ranges of the batches a table of the star holds, see operators/batches.py.
BATCHES = T.ArrayType(_struct(first=_I, last=_I))

LEDGER = _struct(
    job_id=_I, dag_id=_S, task_id=_S, logical_date=_TS, pipeline_stage=_S, parent_job_id=_I,
    data_source_type=_S, data_source_path=_S, destination_schema=_S, destination_table_name=_S,
    started_at=_TS, ended_at=_TS, status=_S, error_message=_S, rows_affected_count=_L,
    rows_inserted_count=_L, last_loaded_event_ts_watermark=_TS, rows_collided_count=_L,
    loaded_batches=BATCHES,
)

LEDGER_STATUSES = ("running", "success", "failed", "skipped")
