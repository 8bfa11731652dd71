"""Row-frame windows over a time series: rolling sums/counts, leads and
days-since-last-event.

Frames count rows, not days (a gap stretches them), matching the source; the
``calendar=True`` variants use a RANGE frame over day numbers instead.

A window without a partition puts every row in one task. That is only allowed
on a day-grain series (one row per date, so bounded by the calendar), and the
caller must say so with ``day_grain=True``. ``blocked_windows`` computes the same
frames over any series, in blocks of consecutive rows.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from ..functions.expressions import _col


def _spec(partition: Sequence[str] | None, order: Sequence[str], day_grain: bool) -> WindowSpec:
    if not partition:
        if not day_grain:
            raise ValueError("an unpartitioned window gathers all rows in one task; "
                             "aggregate to one row per date first and pass day_grain=True")
        return Window.orderBy(*order)
    return Window.partitionBy(*partition).orderBy(*order)


def trailing(partition, order, n: int, day_grain: bool = False) -> WindowSpec:
    """Frame of the current row and the n-1 rows before it."""
    return _spec(partition, order, day_grain).rowsBetween(-(n - 1), Window.currentRow)


def trailing_days(partition, date_col: str, n: int, day_grain: bool = False) -> WindowSpec:
    """Calendar frame: dates within the last n days (gaps do not stretch it)."""
    spec = (Window.partitionBy(*partition) if partition else _spec(None, [date_col], day_grain))
    return spec.orderBy(F.datediff(F.col(date_col), F.lit("1970-01-01"))).rangeBetween(-(n - 1), 0)


def rolling_sum(value: str | Column, partition, order, n: int, day_grain: bool = False,
                calendar: bool = False) -> Column:
    """sum(value) over the trailing n rows (or days); partial at series start."""
    w = trailing_days(partition, order[0], n, day_grain) if calendar else trailing(partition, order, n, day_grain)
    return F.sum(_col(value)).over(w)


def rolling_count_if(cond: Column, partition, order, n: int, day_grain: bool = False,
                     calendar: bool = False) -> Column:
    """Number of true flags in the trailing n rows (sum of 0/1)."""
    return rolling_sum(F.when(cond, F.lit(1)).otherwise(F.lit(0)), partition, order, n, day_grain, calendar)


def lead_columns(value: str | Column, partition, order, offsets: Sequence[int],
                 name_fmt: str) -> dict[str, Column]:
    """lead(value, k) for each k; tails are null. One shared window spec."""
    w = _spec(partition, order, day_grain=False)
    return {name_fmt.format(k=k): F.lead(_col(value), k).over(w) for k in offsets}


def days_since_last(date_col: str, flag: Column, partition=None, day_grain: bool = False) -> Column:
    """Days from the latest flagged date up to this row; null before the first, 0 on the day."""
    w = _spec(partition, [date_col], day_grain).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    last = F.max(F.when(flag, F.col(date_col))).over(w)
    return F.datediff(F.col(date_col), last)


_INDEX_BITS = 33  # of monotonically_increasing_id: the partition above, the row's place in it below


def blocked_windows(df: DataFrame, order: Sequence[str], path: str, sums: Mapping[str, tuple[str | Column, int]] | None = None,
                    days_since: Mapping[str, tuple[str, Column]] | None = None, blocks: int | None = None) -> DataFrame:
    """Unpartitioned row windows without gathering the series in one task: `df` with one column per entry.

    sums: name -> (value, n), the sum over the trailing n rows (a count of flags is a sum of 0/1).
    days_since: name -> (date column, flag), days from the latest flagged date up to the row.

    `order` must be unique per row (nulls come first). The rows are sorted over ranges and written once to `path`, a folder
    in shared storage, with their place; that job runs at the call. Row counts per range turn places into row numbers,
    and rows are dealt to blocks of equal length with the last n-1 rows of the block before (the halo). A block also
    gets the latest flagged date of all earlier ones (the carry). The driver sees one row per range and per block, at
    most `blocks` (default: the shuffle partitions) and one.
    """
    sums, days_since = dict(sums or {}), dict(days_since or {})
    spark = df.sparkSession
    blocks = blocks or int(spark.conf.get("spark.sql.shuffle.partitions"))
    values = {f"__v{i}": _col(v) for i, (v, _) in enumerate(sums.values())}
    flagged = {f"__f{i}": F.when(flag, F.col(date)) for i, (date, flag) in enumerate(days_since.values())}
    (df.withColumns(values | flagged).repartitionByRange(blocks, *order).sortWithinPartitions(*order)
     .withColumn("__id", F.monotonically_increasing_id()).write.mode("errorifexists").parquet(path))
    rows = spark.read.parquet(path)
    part = F.shiftright("__id", _INDEX_BITS)
    counts = sorted(tuple(r) for r in rows.groupBy(part.alias("p")).agg(F.count(F.lit(1)).alias("n")).collect())
    total = sum(n for _, n in counts)
    halo = max((n - 1 for _, n in sums.values()), default=0)
    length = max(halo, -(-total // blocks), 1)
    starts = zip([p for p, _ in counts], accumulate([0, *[n for _, n in counts]]), strict=False)
    offsets = spark.createDataFrame([(p, at) for p, at in starts], "__p bigint, __start bigint")
    numbered = (rows.withColumn("__p", part).join(F.broadcast(offsets), "__p")
                .withColumn("__n", F.col("__start") + F.col("__id").bitwiseAND(F.lit((1 << _INDEX_BITS) - 1)))
                .withColumn("__own", F.floor(F.col("__n") / length).cast("bigint")).drop("__p", "__start", "__id"))
    also = F.when(F.col("__n") % length >= length - halo, F.array(F.col("__own"), F.col("__own") + 1)).otherwise(F.array("__own"))
    dealt = numbered.withColumn("__block", F.explode(also))
    if flagged:
        last = numbered.groupBy("__own").agg(*[F.max(c).alias(c) for c in flagged]).orderBy("__own").collect()
        carried, carry = [None] * len(flagged), []
        for r in last:
            carry.append((r["__own"], *carried))
            carried = [max((d for d in (old, r[c]) if d is not None), default=None) for old, c in zip(carried, flagged, strict=True)]
        kinds = [numbered.schema[c].dataType.simpleString() for c in flagged]
        names = ", ".join(f"__c{i} {t}" for i, t in enumerate(kinds))
        dealt = dealt.join(F.broadcast(spark.createDataFrame(carry, f"__block bigint, {names}")), "__block", "left")
    w = Window.partitionBy("__block").orderBy("__n")
    out = {name: F.sum(f"__v{i}").over(w.rowsBetween(-(n - 1), Window.currentRow)) for i, (name, (_, n)) in enumerate(sums.items())}
    for i, (name, (date, _)) in enumerate(days_since.items()):
        latest = F.max(f"__f{i}").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow))
        out[name] = F.datediff(F.col(date), F.greatest(latest, F.col(f"__c{i}")))
    return dealt.withColumns(out).where(F.col("__block") == F.col("__own")).select(*df.columns, *out)


def with_windows(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """Add window columns in one projection so same-spec windows share one sort."""
    return df.withColumns(columns)
