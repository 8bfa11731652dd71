"""Date spine and the calendar dimension."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import constants as C
from ..functions.calendar import calendar_columns


def date_spine(spark: SparkSession, start: _dt.date = C.CALENDAR_START, end: _dt.date = C.CALENDAR_END,
               name: str = "date_day") -> tuple[DataFrame, int]:
    """Every day in [start, end] and the row count (bounded by the range)."""
    n = (end - start).days + 1
    df = spark.range(n).select(F.date_add(F.lit(start), F.col("id").cast("int")).alias(name))
    return df, n


def dim_date(spark: SparkSession, start: _dt.date = C.CALENDAR_START,
             end: _dt.date = C.CALENDAR_END) -> tuple[DataFrame, int]:
    """Calendar dimension (one row per day) with its row count."""
    spine, n = date_spine(spark, start, end)
    return with_calendar_attributes(spine, "date_day"), n


def with_calendar_attributes(df: DataFrame, date_col: str) -> DataFrame:
    return df.select("*", *[c.alias(k) for k, c in calendar_columns(date_col).items()])


def spine_between(df: DataFrame, start: Column, end: Column, name: str = "date_day") -> DataFrame:
    """Date spine spanning [start, end] computed from data (one row, then exploded)."""
    return df.agg(start.alias("__s"), end.alias("__e")).select(
        F.explode(F.sequence("__s", "__e")).alias(name))
