"""Joins: dimension enrichment with a size-checked broadcast, share of a
group total (join or window form), and multi-key joins with differing names."""

from __future__ import annotations

import datetime as dt
import heapq
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.expressions import _col, ratio

# Size under which a dimension is broadcast by hint; above it the planner
# (and AQE's runtime statistics) decides.
BROADCAST_MAX_BYTES = 16 << 20


def maybe_broadcast(dim: DataFrame, dim_rows: int | None, max_bytes: int = BROADCAST_MAX_BYTES) -> DataFrame:
    """Broadcast hint only for a side whose size is known and small.

    `dim_rows` comes from whoever built the dimension (a seed's row count, the
    number of days in a calendar range); the size is that count times the
    schema's row width as Spark estimates it. None means unknown, so the planner
    and AQE's runtime statistics choose the strategy instead.
    """
    if dim_rows is None or dim_rows * dim._jdf.schema().defaultSize() > max_bytes:
        return dim
    return F.broadcast(dim)


def enrich(df: DataFrame, dim: DataFrame, on: str | Sequence[str] | Column, how: str = "left",
           dim_rows: int | None = None, max_bytes: int = BROADCAST_MAX_BYTES) -> DataFrame:
    """Join a dimension; broadcast when its size bound is known and small."""
    return df.join(maybe_broadcast(dim, dim_rows, max_bytes), on=on, how=how)


def disjoint_ranges(ranges: Sequence[tuple[dt.date, dt.date, str]]) -> list[tuple[dt.date, dt.date, str]]:
    """Inclusive, possibly overlapping date ranges as disjoint ones in date order; where several hold, the first listed wins."""
    day = dt.timedelta(days=1)
    listed = sorted((start, i, end) for i, (start, end, _) in enumerate(ranges) if start <= end)
    cuts = sorted({d for start, _, end in listed for d in (start, end + day)})
    out: list[tuple[dt.date, dt.date, str]] = []
    active: list[tuple[int, dt.date]] = []
    at = 0
    for start, after in zip(cuts, cuts[1:]):
        while at < len(listed) and listed[at][0] <= start:
            heapq.heappush(active, listed[at][1:])
            at += 1
        while active and active[0][1] < start:
            heapq.heappop(active)
        if active:
            out.append((start, after - day, ranges[active[0][0]][2]))
    return out


def label_by_ranges(df: DataFrame, date_col: str, ranges: Sequence[tuple[dt.date, dt.date, str]], name: str) -> DataFrame:
    """`df` with the label of the first listed range (start, end, label; both ends inclusive) that holds the date, else null.

    For lists of any length, where ``label_periods`` would chain one condition per range: overlaps are resolved first, the
    disjoint ranges are written once per month they touch (31 of them at most per month), and rows meet them by an
    equi-join on the month. Broadcast while the ranges are small; the null date has no label.
    """
    spark = df.sparkSession
    found = disjoint_ranges(ranges)
    by_month = []
    for start, end, label in found:
        for month in range(start.year * 12 + start.month, end.year * 12 + end.month + 1):
            by_month.append((month, start, end, label))
    dim = spark.createDataFrame(by_month, "__month int, __from date, __to date, __label string")
    d = F.col(date_col)
    on = (F.year(d) * 12 + F.month(d) == F.col("__month")) & d.between(F.col("__from"), F.col("__to"))
    return enrich(df, dim, on, "left", dim_rows=len(by_month)).select(*[F.col(f"`{c}`") for c in df.columns], F.col("__label").alias(name))


def left_join_on(df: DataFrame, other: DataFrame, pairs: Sequence[tuple[str, str]], how: str = "left") -> DataFrame:
    """Join on column pairs with different names; the right-hand key columns are dropped."""
    cond = None
    for left, right in pairs:
        c = df[left] == other[right]
        cond = c if cond is None else cond & c
    out = df.join(other, on=cond, how=how)
    for _, right in pairs:
        out = out.drop(other[right])
    return out


def share_of_total(df: DataFrame, within: Sequence[str], measure: str, total_name: str,
                   pct_name: str | None = None, scale: int = 2, form: str = "window",
                   extra_totals: dict[str, Column] | None = None) -> DataFrame:
    """Add the group total of `measure` (and optional % share) to every row.

    form="window": sum() over (partition by within) - no join, one exchange.
    form="join":   aggregate totals, join back on `within` (the source's shape).
    `extra_totals` are more aggregate columns computed beside the total.
    """
    within = list(within)
    aggs = {total_name: F.sum(_col(measure))}
    aggs.update(extra_totals or {})
    if form == "window":
        w = Window.partitionBy(*within)
        out = df.withColumns({k: v.over(w) for k, v in aggs.items()})
    elif form == "join":
        totals = df.groupBy(*within).agg(*[v.alias(k) for k, v in aggs.items()])
        out = df.join(totals, on=within, how="inner")
    else:
        raise ValueError(form)
    if pct_name:
        out = out.withColumn(pct_name, ratio(measure, total_name, scale=scale, times=100))
    return out
