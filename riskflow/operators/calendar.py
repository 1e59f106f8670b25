"""Calendar dimension."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# First and last day of the calendar.
FIRST_DAY, LAST_DAY = "2020-01-01", "2031-12-31"


def dim_date(spark: SparkSession, first: str = FIRST_DAY, last: str = LAST_DAY) -> DataFrame:
    days = F.sequence(F.lit(first).cast("date"), F.lit(last).cast("date"))
    date = F.col("date")
    return (
        spark.range(1)
        .select(F.explode(days).alias("date"))
        .select(
            F.date_format(date, "yyyyMMdd").cast("int").alias("date_key"),
            date,
            F.dayofmonth(date).alias("day"),
            F.month(date).alias("month"),
            F.date_format(date, "MMMM").alias("month_name"),
            F.quarter(date).alias("quarter"),
            F.year(date).alias("year"),
            F.dayofweek(date).isin(1, 7).alias("is_weekend"),
        )
    )
