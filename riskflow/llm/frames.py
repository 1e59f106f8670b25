"""Small helpers the operators share: stored intermediate tables, checked columns."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskflow.session import work_folder


def read(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{table}.parquet")


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` written once to the shared folder and read back: later uses neither recompute it nor depend on the executors
    that made it. Parquet keeps the copy compressed, which ``checkpoint()`` does not."""
    spark = df.sparkSession
    path = work_folder(spark, purpose)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def whole_text(column: str | Column) -> Column:
    """A null text counts as empty."""
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(""))


def without(df: DataFrame, taken: Iterable[str]) -> DataFrame:
    """``df`` without columns named as in ``taken``, in any case: an operator's own columns win over clashing extra ones."""
    names = {t.lower() for t in taken}
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c.lower() not in names])


def extended(df: DataFrame, more: str) -> T.StructType:
    """The schema of ``df`` with more columns, given as DDL."""
    return T.StructType([*df.schema.fields, *T.StructType.fromDDL(more).fields])
