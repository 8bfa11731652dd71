"""Data-quality checks. Each returns a small DataFrame of findings, computed in
one distributed pass, so the caller decides whether to fail, warn or store it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def check_not_null(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """One row per column: (column_name, null_count, passed)."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    stack = ", ".join(f"'{c}', `{c}`" for c in cols)
    return (counts.selectExpr(f"stack({len(cols)}, {stack}) as (column_name, null_count)")
            .withColumn("passed", F.col("null_count") == 0))


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their row count (non-null keys only)."""
    cond = F.lit(True)
    for k in keys:
        cond = cond & F.col(k).isNotNull()
    return (df.where(cond).groupBy(*keys).agg(F.count(F.lit(1)).alias("row_count"))
            .where(F.col("row_count") > 1))


def check_unique(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Single row: (duplicate_keys, duplicate_rows, passed)."""
    d = duplicate_keys(df, keys)
    return (d.agg(F.count(F.lit(1)).alias("duplicate_keys"),
                  F.coalesce(F.sum("row_count"), F.lit(0)).cast("bigint").alias("duplicate_rows"))
            .withColumn("passed", F.col("duplicate_keys") == 0))


def out_of_range(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Per declared decimal column: values present but not representable in it."""
    aggs = []
    for f in schema.fields:
        if f.name in df.columns and isinstance(f.dataType, T.DecimalType):
            c = F.col(f.name)
            aggs.append(F.count_if(c.isNotNull() & c.try_cast(f.dataType).isNull()).alias(f.name))
    counts = df.agg(*aggs)
    names = [f.name for f in schema.fields if f.name in df.columns and isinstance(f.dataType, T.DecimalType)]
    stack = ", ".join(f"'{c}', `{c}`" for c in names)
    return (counts.selectExpr(f"stack({len(names)}, {stack}) as (column_name, overflow_count)")
            .withColumn("passed", F.col("overflow_count") == 0))


def check_balanced(df: DataFrame, key: str) -> DataFrame:
    """Rows per key should all be equal: (keys, min_rows, max_rows, passed)."""
    per = df.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    return (per.agg(F.count(F.lit(1)).alias("keys"), F.min("n").alias("min_rows"), F.max("n").alias("max_rows"))
            .withColumn("passed", F.coalesce(F.col("min_rows") == F.col("max_rows"), F.lit(True))))


def profile_series(df: DataFrame, key: str, time_col: str, measure: str, scale: int = 1) -> DataFrame:
    """Per key: rows, first and last time, rounded measure total (smoke profile)."""
    return df.groupBy(key).agg(
        F.count(F.lit(1)).alias("row_count"),
        F.min(time_col).alias("first_time"),
        F.max(time_col).alias("last_time"),
        F.round(F.sum(measure), scale).alias("measure_total"),
    )


def smoke_profile(df: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """Profile of the whole table (`is_total`) and of every key, in one scan: a row per column with the row count and the
    column's nulls, distinct values, smallest and largest value (as text).

    The null key is a key like any other; an empty table has no rows. Spark expands the distinct counts to (key, column,
    value) groups, combined map-side, so neither the total nor a hot key is gathered in one task.
    """
    measures = [F.count(F.lit(1)).alias("__n")]
    for i, c in enumerate(columns):
        v = F.col(c)
        measures += [F.count(v).alias(f"__c{i}"), F.count_distinct(v).alias(f"__d{i}"), F.min(v).alias(f"__lo{i}"), F.max(v).alias(f"__hi{i}")]
    flat = df.select(key, *[c for c in columns if c != key]).rollup(key).agg(F.grouping(key).alias("__total"), *measures)
    rows = F.array(*[F.struct(
        F.lit(c).alias("column_name"), (F.col("__n") - F.col(f"__c{i}")).alias("null_count"), F.col(f"__d{i}").alias("distinct_values"),
        F.col(f"__lo{i}").cast("string").alias("min_value"), F.col(f"__hi{i}").cast("string").alias("max_value")) for i, c in enumerate(columns)])
    return flat.select(key, (F.col("__total") == 1).alias("is_total"), F.col("__n").alias("row_count"), F.inline(rows))


def null_key_rows(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows that violate NOT NULL on any key column (the rejects of a keyed load)."""
    cond = F.lit(False)
    for k in keys:
        cond = cond | F.col(k).isNull()
    return df.where(cond)
