"""Session settings and the scratch area shared by a cluster."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_DEFAULT_BROADCAST_BYTES = 10 * 1024 * 1024


def configure(spark: SparkSession) -> SparkSession:
    """Pin the settings the operators rely on.

    Every instant is handled in UTC, so the date and time keys of an event do
    not depend on where the driver runs. AQE coalesces small partitions and
    splits skewed ones. Typing many text fields makes generated methods that
    the JVM refuses to compile beyond 8000 bytes of bytecode; the method limit
    makes Spark generate such a stage in smaller pieces instead. A task that
    writes a few partition directories keeps their files open side by side
    rather than sorting its rows by directory first.
    """
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
    spark.conf.set("spark.sql.codegen.hugeMethodLimit", "8000")
    spark.conf.set("spark.sql.maxConcurrentOutputFileWriters", "8")
    return spark


def build_session(master: str = "local[*]", app: str = "tidemark", **conf: str) -> SparkSession:
    builder = SparkSession.builder.master(master).appName(app)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return configure(builder.getOrCreate())


def workspace(spark: SparkSession, purpose: str) -> str:
    """A fresh directory for intermediate tables.

    It lies below ``spark.checkpoint.dir``, the folder all executors share. A
    local temporary folder is used only where that setting is absent and the
    master is this machine alone; on a cluster the setting is required.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="tidemark-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/tidemark-{purpose}-{uuid.uuid4().hex[:12]}"


def materialise(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` written once to the shared folder, for results that are used several times.

    The files outlive lost executors and give later plans the true size.
    """
    path = workspace(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def shuffle_parts(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def broadcast_limit(spark: SparkSession) -> int:
    """``spark.sql.autoBroadcastJoinThreshold`` in bytes, -1 when switched off."""
    text = spark.conf.get("spark.sql.autoBroadcastJoinThreshold", str(_DEFAULT_BROADCAST_BYTES))
    text = text.strip().lower().removesuffix("b")
    units = {"k": 1 << 10, "m": 1 << 20, "g": 1 << 30}
    if text and text[-1] in units:
        return int(text[:-1]) * units[text[-1]]
    return int(text)


def fits_broadcast(df: DataFrame) -> bool:
    """Whether the optimizer's size bound for ``df`` is below the broadcast limit.

    This is the same statistic Spark uses for its own choice: file sizes from
    the scan, carried upwards through the plan. An unknown size counts as too
    large, so callers fall back to a shuffled form.
    """
    limit = broadcast_limit(df.sparkSession)
    try:
        size = int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    except AttributeError:  # Spark Connect has no plan handle
        return False
    return 0 <= size <= limit
