"""Rows that could not be typed or broke a rule, kept with the reason."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark.functions.keys import instant


def raw_json(columns: list[str]) -> Column:
    """The source row as one JSON text, NULL fields included."""
    return F.to_json(F.struct(*[F.col(f"`{c}`") for c in columns]), {"ignoreNullFields": "false"})


def quarantine_rows(bad: DataFrame, job_id: int | None, rule: str, at: datetime) -> DataFrame:
    """``bad`` needs the columns ``raw`` and ``error_message``."""
    return bad.select(
        instant(at).alias("ts"),
        F.lit(job_id).cast("int").alias("job_id"),
        F.lit(rule).alias("rule"),
        "error_message",
        "raw",
    )


def write_quarantine(rows: DataFrame, path: str, job_id: int) -> None:
    """JSON lines from every task; a run's directory is replaced when it is retried."""
    rows.write.mode("overwrite").json(f"{path.rstrip('/')}/run={job_id}")


def drop_quarantine(spark: SparkSession, path: str, job_id: int) -> None:
    """Removes the directory of a run that did not succeed."""
    target = spark._jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/run={job_id}")
    conf = spark._jsparkSession.sessionState().newHadoopConf()
    target.getFileSystem(conf).delete(target, True)
