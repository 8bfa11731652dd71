"""Column-shape operators: header normalising, rename/select of present
columns, missing optional columns, wide->long unpivot, unions."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import constants as C
from ..functions.parsing import to_date_lenient, to_number


def normalise_headers(df: DataFrame) -> DataFrame:
    """Lower-case every column name."""
    return df.toDF(*[c.lower() for c in df.columns])


def rename_present(df: DataFrame, mapping: Mapping[str, str] | Iterable[tuple[str, str]]) -> DataFrame:
    """Rename by mapping, only where the raw name exists."""
    mapping = dict(mapping)
    return df.withColumnsRenamed({k: v for k, v in mapping.items() if k in df.columns})


def select_present(df: DataFrame, keep: Sequence[str]) -> DataFrame:
    """Project the kept columns that exist, in `keep` order."""
    return df.select(*[c for c in keep if c in df.columns])


def ensure_columns(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Add absent columns of `schema` as typed nulls."""
    missing = {f.name: F.lit(None).cast(f.dataType) for f in schema.fields if f.name not in df.columns}
    return df.withColumns(missing) if missing else df


def drop_incomplete(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Drop rows with a null or blank value in any of `cols`."""
    cond = F.lit(True)
    for c in cols:
        v = F.col(c)
        if isinstance(df.schema[c].dataType, T.StringType):
            cond = cond & v.isNotNull() & (F.trim(v) != F.lit(""))
        else:
            cond = cond & v.isNotNull()
    return df.where(cond)


def head_rows(df: DataFrame, n: int = 3) -> DataFrame:
    """First rows of a table for column inspection (the sample is the feature)."""
    return df.limit(n)


def ordered(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Final ORDER BY with nulls last, as the source database sorts."""
    return df.orderBy(*[F.col(c).asc_nulls_last() for c in cols])


def register_view(name: str, df: DataFrame) -> DataFrame:
    """Expose a model to SQL (view materialisation)."""
    df.createOrReplaceTempView(name)
    return df


def union_all(dfs: Sequence[DataFrame]) -> DataFrame:
    """Bag union by column name; columns absent from a part become null."""
    dfs = list(dfs)
    out = dfs[0]
    for d in dfs[1:]:
        out = out.unionByName(d, allowMissingColumns=True)
    return out


def period_columns(columns: Sequence[str], prefix: str = C.PERIOD_PREFIX,
                   max_period: int = C.MAX_PERIOD) -> list[str]:
    """Period columns present, in period order (tp1..tp50); others are ignored."""
    present = set(columns)
    return [f"{prefix}{i}" for i in range(1, max_period + 1) if f"{prefix}{i}" in present]


def unpivot_periods(df: DataFrame, ids: Sequence[str] = C.GENERATION_ID_COLUMNS,
                    prefix: str = C.PERIOD_PREFIX, max_period: int = C.MAX_PERIOD,
                    value_name: str = "output_kw", period_name: str = "trading_period",
                    value_type: str = "decimal(18,6)", date_col: str | None = "trading_date") -> DataFrame:
    """Wide per-period columns -> one row per (ids, period).

    Blank and null cells are dropped, values are parsed leniently (junk -> null,
    dropped), the date is parsed leniently, and rows missing date, period or
    value are dropped. A narrow, shuffle-free transformation: the cells of a wide
    row are one array of texts that ``posexplode`` walks, and blank ones are left
    out there, in one short loop of generated code (an Expand of 50 projections,
    or 50 structs to filter, make methods that the JVM only interprets).
    """
    missing = [c for c in ids if c not in df.columns]
    if missing:
        raise ValueError(f"missing id columns: {missing}")
    values = period_columns(df.columns, prefix, max_period)
    if not values:
        raise ValueError(f"no {prefix}N columns present")
    if date_col:  # once per wide row, not per cell
        df = df.withColumn(date_col, to_date_lenient(date_col)).where(F.col(date_col).isNotNull())
    at = F.array(*[F.lit(int(v[len(prefix):])).cast("smallint") for v in values])
    cells = df.select(*ids, F.posexplode(F.array(*[F.col(v).cast("string") for v in values])).alias("__at", "__cell"))
    present = cells.where(F.col("__cell").isNotNull() & (F.trim("__cell") != F.lit("")))
    long = present.withColumns({
        period_name: F.get(at, F.col("__at")),
        value_name: to_number("__cell", value_type),
    })
    required = [period_name, value_name] + ([date_col] if date_col else [])
    return long.na.drop(subset=required).select(*ids, period_name, value_name)


def pivot_periods(df: DataFrame, ids: Sequence[str], period_col: str, value_col: str,
                  prefix: str = C.PERIOD_PREFIX, max_period: int = C.MAX_PERIOD) -> DataFrame:
    """Long -> wide with one column per period (max per cell); inverse of unpivot_periods.

    The period list is given, so no extra job runs to discover pivot values. Cells are reduced to one per (ids, period)
    before the shuffle; a group then gathers at most one cell per period, and its columns are looked up there, so rows are
    as wide as their filled cells until they are written out (a pivot aggregate holds every column of every group).
    """
    periods = list(range(1, max_period + 1))
    kind = df.schema[period_col].dataType
    unknown = F.concat(F.lit(f"pivot_periods: period outside [1, {max_period}]: "), F.col(period_col).cast("string"))
    df = df.withColumn(period_col, F.when(F.col(period_col).isNull() | F.col(period_col).between(1, max_period), F.col(period_col))
                       .otherwise(F.raise_error(unknown).cast(kind)))
    cells = df.groupBy(*ids, period_col).agg(F.max(value_col).alias("__value"))
    filled = F.when(F.col(period_col).isNotNull() & F.col("__value").isNotNull(), F.struct(F.col(period_col), F.col("__value")))
    held = F.map_from_entries(F.collect_list(filled))  # made once per group
    return cells.groupBy(*ids).agg(*[F.try_element_at(held, F.lit(i).cast(kind)).alias(f"{prefix}{i}") for i in periods])
