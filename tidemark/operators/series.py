"""Generated calendar and clock members."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.functions.keys import clock_text, date_key


def date_members(spark: SparkSession, first: date, last: date) -> DataFrame:
    """One row per day, both ends included."""
    days = spark.range(1).select(
        F.explode(F.sequence(F.lit(first), F.lit(last), F.expr("interval 1 day"))).alias("full_date")
    )
    return days.select(
        date_key(F.col("full_date")).alias("date_sk"),
        "full_date",
        F.year("full_date").alias("year"),
        F.month("full_date").alias("month"),
        F.dayofmonth("full_date").alias("day"),
    )


def time_members(spark: SparkSession) -> DataFrame:
    """One row per minute of a day (24 hours x 60 minutes = 1440 rows)."""
    hours = spark.range(24).select(F.col("id").cast("int").alias("hour"))
    minutes = spark.range(60).select(F.col("id").cast("int").alias("minute"))
    return hours.crossJoin(minutes).select(
        (F.col("hour") * 100 + F.col("minute")).cast("int").alias("time_sk"),
        clock_text(F.col("hour"), F.col("minute")).alias("full_time"),
        "hour",
        "minute",
    )
