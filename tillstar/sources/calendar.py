"""The date dimension."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The default range of the date dimension, both ends included.
FIRST_DATE = "2023-01-01"
LAST_DATE = "2030-12-31"


def days(bounds: DataFrame, first: str, last: str) -> DataFrame:
    """One row (``date``) per day from column ``first`` to ``last`` of each row."""
    return bounds.select(F.explode(F.sequence(first, last)).alias("date"))


def describe_days(dates: DataFrame) -> DataFrame:
    """Calendar columns for every ``date``.  Sunday is day 1; weeks are ISO weeks."""
    date = F.col("date")
    weekday = F.dayofweek(date)
    return dates.select(
        date,
        F.date_format(date, "yyyyMMdd").cast("int").alias("date_key"),
        F.year(date).alias("year"),
        F.quarter(date).alias("quarter"),
        F.month(date).alias("month"),
        F.date_format(date, "MMMM").alias("month_name"),
        F.weekofyear(date).alias("week"),
        F.dayofmonth(date).alias("day"),
        F.date_format(date, "EEEE").alias("day_name"),
        weekday.alias("day_of_week"),
        weekday.isin(1, 7).alias("is_weekend"),
        F.concat(F.lit("Q"), F.quarter(date)).alias("quarter_name"),
    )


def build_dim_date(
    spark: SparkSession,
    start_date: str | dt.date = FIRST_DATE,
    end_date: str | dt.date = LAST_DATE,
) -> DataFrame:
    bounds = spark.range(1).select(
        F.to_date(F.lit(start_date)).alias("first"), F.to_date(F.lit(end_date)).alias("last")
    )
    return describe_days(days(bounds, "first", "last"))
