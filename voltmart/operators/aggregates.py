"""Aggregate building blocks: conditional sums/counts, distinct counts, exact
continuous percentiles, completeness and weighted totals.

All return Columns for use inside one ``groupBy().agg()`` (so they share one
partial + final hash aggregate) except ``percentiles``, which is a DataFrame
operator because an exact quantile of a hot group must not be computed in one task.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.expressions import _col


# ---------------------------------------------------------------- conditional aggregates

def sum_if(cond: Column, measure: str | Column, zero=0) -> Column:
    """sum(case when cond then measure else 0 end)."""
    return F.sum(F.when(cond, _col(measure)).otherwise(F.lit(zero)))


def count_if(cond: Column) -> Column:
    """Number of rows where cond is true (null counts as false); bigint, never null."""
    return F.count(F.when(cond, F.lit(1)))


def bitmask_of(cond: Column, value: str | Column, max_value: int = 62) -> Column:
    """Aggregate: OR of (1 << value) over rows where cond holds (null if none).

    O(1) state per group and partial-aggregable; masks of sub-groups OR
    together. Values outside [0, max_value] raise instead of miscounting.
    """
    v = _col(value).cast("bigint")
    bit = F.when(v.between(0, max_value), F.call_function("shiftleft", F.lit(1).cast("bigint"), v.cast("int"))).otherwise(
        F.raise_error(F.lit(f"bitmask_of: value outside [0, {max_value}]")).cast("bigint"))
    return F.bit_or(F.when(cond & v.isNotNull(), bit))


def bits_set(mask: str | Column) -> Column:
    """Number of distinct values recorded in a mask (0 for a null mask)."""
    return F.coalesce(F.bit_count(_col(mask)).cast("bigint"), F.lit(0).cast("bigint"))


def outside_mask(cond: Column, value: str | Column, max_value: int = 62) -> Column:
    """Aggregate: the distinct values a mask of [0, max_value] cannot hold (usually none)."""
    v = _col(value)
    return F.collect_set(F.when(cond & ~v.between(0, max_value), v))


def count_distinct_if(cond: Column, value: str | Column, max_value: int = 62) -> Column:
    """Distinct count of an integer where cond holds, in one pass (bitmask per group for
    the small values, a set for any others; skew-safe, one exchange)."""
    small = cond & _col(value).between(0, max_value)
    return bits_set(bitmask_of(small, value, max_value)) + F.size(outside_mask(cond, value, max_value))


def count_distinct_when(cond: Column, value: str | Column) -> Column:
    """Generic exact form: count(distinct case when cond then value end)."""
    return F.count_distinct(F.when(cond, _col(value)))


def completeness_pct(expected: int, scale: int = 1) -> Column:
    """round(count(*) / expected * 100, scale); exceeds 100 on long (DST) days."""
    pct = (F.count(F.lit(1)).cast("double") / F.lit(float(expected)) * F.lit(100.0)).cast("decimal(38,10)")
    return F.round(pct, scale)


def weighted_total(qty: str | Column, rate: str | Column) -> Column:
    """sum(qty * rate); rows with a null rate add nothing."""
    return F.sum(_col(qty) * _col(rate))


def unmapped_total(lookup: str | Column, measure: str | Column) -> Column:
    """Sum of `measure` over rows whose lookup value is null (coverage gap)."""
    return F.sum(F.when(_col(lookup).isNull(), _col(measure)).otherwise(F.lit(0)))


def carry(c: str | Column) -> Column:
    """Value of a column that is constant within the group (max as 'any')."""
    return F.max(_col(c))


# ---------------------------------------------------------------- exact percentiles

_IMPLICIT_ONE = 1 << 52       # IEEE 754 double: 52 fraction bits, exponent bias 1023
_EXPONENT_MAX = 2047


def _double_key(x: Column) -> Column:
    """Order-preserving 64-bit integer of a double: its IEEE magnitude bits, negated for negative values.

    Computed with exact steps (scaling by powers of two). log2 may be one off next to
    a power of two, so the exponent is corrected before use.
    """
    two = F.lit(2.0)

    def bits(a: Column) -> Column:
        guess = F.floor(F.log2(a))
        exponent = F.element_at(F.transform(F.array(guess), lambda e: (
            F.when(F.pow(two, e) > a, e - 1).when(F.pow(two, e + 1) <= a, e + 1).otherwise(e))), 1)
        normal = F.element_at(F.transform(F.array(exponent), lambda e: (
            (e + 1023) * F.lit(_IMPLICIT_ONE) + ((a / F.pow(two, e) - 1) * F.lit(float(_IMPLICIT_ONE))).cast("bigint"))), 1)
        return (F.when(F.isnan(a), F.lit(_EXPONENT_MAX * _IMPLICIT_ONE + 1))
                .when(a == F.lit(float("inf")), F.lit(_EXPONENT_MAX * _IMPLICIT_ONE))
                .when(a < F.lit(2.0 ** -1022), (a * F.lit(2.0 ** 537) * F.lit(2.0 ** 537)).cast("bigint"))
                .otherwise(normal))

    return F.when(x < 0, -bits(F.abs(x))).otherwise(bits(F.abs(x)))


def _double_of_key(k: Column) -> Column:
    """Inverse of ``_double_key``."""
    a = F.abs(k)
    exponent, fraction = F.shiftright(a, 52), a.bitwiseAND(F.lit(_IMPLICIT_ONE - 1))
    magnitude = (F.when((exponent == _EXPONENT_MAX) & (fraction != 0), F.lit(float("nan")))
                 .when(exponent == 0, a.cast("double") * F.lit(2.0 ** -1074))
                 .otherwise((fraction.cast("double") / F.lit(float(_IMPLICIT_ONE)) + 1)
                            * F.pow(F.lit(2.0), exponent.cast("double") - 1023)))
    return F.when(k < 0, -magnitude).otherwise(magnitude)


def _order_key(dtype: T.DataType, value: Column) -> tuple[Column, Callable[[Column], Column]]:
    """Order-preserving 64-bit integer encoding of a number, and the way back to a double."""
    if isinstance(dtype, T.DecimalType) and dtype.precision <= 18:
        unscaled = (value * F.lit(10 ** dtype.scale)).cast("bigint") if dtype.scale else value.cast("bigint")
        return unscaled, lambda k: k.cast("double") / F.lit(float(10 ** dtype.scale))
    if isinstance(dtype, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return value.cast("bigint"), lambda k: k.cast("double")
    return _double_key(value.cast("double")), _double_of_key


def _same_keys(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Join on keys where null equals null: the group of the null key is a group like any other."""
    named = right.withColumnsRenamed({k: f"__r_{k}" for k in keys})
    on = F.lit(True)
    for k in keys:
        on = on & F.col(k).eqNullSafe(F.col(f"__r_{k}"))
    joined = left.join(named, on, how)
    return joined if how == "left_semi" else joined.drop(*[f"__r_{k}" for k in keys])


RANGES = 256        # value ranges a large group is cut into: a power of two
WHOLE_GROUP = 4096  # distinct values up to which a group is one range
SALTS = 8           # join partitions a group's values are spread over


def _range_of(bounds: Column, k: Column) -> Column:
    """Number of the ascending bounds that are <= k: binary search in log2(RANGES) steps."""
    steps = F.array(*[F.lit(RANGES >> i) for i in range(1, RANGES.bit_length())])
    return F.aggregate(steps, F.lit(0), lambda at, step: at + F.when(F.get(bounds, at + step - 1) <= k, step).otherwise(0))


def _salted(df: DataFrame) -> DataFrame:
    return df.withColumn("__s", F.explode(F.array(*[F.lit(i) for i in range(SALTS)])))


def _ranged_select(freq: DataFrame, keys: list[str], ranks: Callable[[Column], Column]) -> DataFrame:
    """Value at the wanted 0-based ranks (an array, made from the group's total) of each group, without gathering a group.

    freq: keys + __k (bigint, order-preserving) + __c (multiplicity). Each group's values are cut into ranges at approximate
    quantiles of its distinct values; a row count per range turns every rank into a range and a place in it, and only the
    ranges that hold a rank are sorted. The quantiles decide how even the ranges are, nothing else: a range's limits and the
    count before it come from one evaluation and travel as data, so a re-run task that cuts elsewhere changes no result.
    """
    f = freq.withColumn("__s", F.pmod(F.hash("__k"), F.lit(SALTS)))
    cuts = F.percentile_approx("__k", F.array(*[F.lit(i / RANGES) for i in range(1, RANGES)]), F.lit(4 * RANGES))
    bounds = (freq.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"), cuts.alias("__q"))
              .select(*keys, F.when(F.col("__n") > WHOLE_GROUP, F.array_distinct("__q"))
                      .otherwise(F.array().cast("array<bigint>")).alias("__q")))
    placed = _same_keys(f, _salted(bounds), [*keys, "__s"]).withColumn("__at", _range_of(F.col("__q"), F.col("__k")))
    ranges = placed.groupBy(*keys, "__at").agg(
        F.sum("__c").alias("__n"),
        F.first(F.get("__q", F.col("__at") - 1)).alias("__lo"), F.first(F.get("__q", F.col("__at"))).alias("__hi"))
    group = Window.partitionBy(*keys)
    ranges = (ranges.withColumns({"__total": F.sum("__n").over(group),
                                  "__end": F.sum("__n").over(group.orderBy("__at").rowsBetween(Window.unboundedPreceding, 0))})
              .withColumn("__start", F.col("__end") - F.col("__n")))
    held = F.filter(ranks(F.col("__total")), lambda r: (r >= F.col("__start")) & (r < F.col("__end")))
    wanted = ranges.select(*keys, "__total", "__start", "__lo", "__hi", held.alias("__ranks")).where(F.size("__ranks") > 0)
    near = _same_keys(f, _salted(wanted), [*keys, "__s"]).where(
        (F.col("__lo").isNull() | (F.col("__k") >= F.col("__lo"))) & (F.col("__hi").isNull() | (F.col("__k") < F.col("__hi"))))
    w = Window.partitionBy(*keys, "__start").orderBy("__k").rowsBetween(Window.unboundedPreceding, 0)
    last = F.col("__start") + F.sum("__c").over(w)
    here = F.filter("__ranks", lambda r: (r >= F.col("__last") - F.col("__c")) & (r < F.col("__last")))
    return near.withColumn("__last", last).select(*keys, "__total", F.explode(here).alias("__rank"), "__k")


def value_counts(df: DataFrame, keys: Sequence[str], value: str, extra: dict[str, Column] | None = None) -> DataFrame:
    """Rows per (group, value) plus optional extra aggregates at that grain.

    A partial aggregate (a hot group is combined map-side). Many per-group
    measures can be finished from it - min/max, weighted sums, masks - and it is
    the input of ``percentiles``, so one pass over the facts serves them all.
    """
    aggs = [F.count(F.lit(1)).alias("__c")] + [c.alias(n) for n, c in (extra or {}).items()]
    return df.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(*aggs)


def percentiles(df: DataFrame, keys: Sequence[str], value: str, probs: Sequence[float],
                names: Sequence[str], strategy: str = "distributed") -> DataFrame:
    """Exact continuous percentiles (linear interpolation, like percentile_cont).

    Returns keys + one double column per prob; groups whose values are all
    null are absent (join back with a left join). The null key is a group like
    any other. Lazy: no job runs while the plan is built.

    Values are first counted per (group, value) - a partial aggregate, so a hot
    group is combined map-side. Then, at every size alike:
      * "distributed": rank selection by value ranges over an order-preserving
        integer of the value (any numeric type); no group is held in one task,
        only the ranges that hold a wanted rank are sorted. The counts' exchange
        is read three times and written once.
      * "builtin": ``percentile(value, probs, frequency)`` per group. Its buffer
        holds the group's distinct values: only for groups known to be small.
    """
    keys = list(keys)
    freq = value_counts(df, keys, value)
    if strategy == "builtin":
        arr = F.percentile(F.col(value).cast("double"), F.array(*[F.lit(float(p)) for p in probs]), F.col("__c"))
        return (freq.groupBy(*keys).agg(arr.alias("__p"))
                .select(*keys, *[F.col("__p")[i].alias(n) for i, n in enumerate(names)]))
    if strategy != "distributed":
        raise ValueError(f"unknown percentile strategy {strategy!r}")
    key_col, to_double = _order_key(df.schema[value].dataType, F.col(value))
    f = freq.select(*keys, key_col.alias("__k"), "__c")

    def ranks(total: Column) -> Column:
        pos = [(total - 1).cast("double") * F.lit(float(p)) for p in probs]
        return F.array_distinct(F.array(*[F.floor(x).cast("bigint") for x in pos], *[F.ceil(x).cast("bigint") for x in pos]))

    picked = _ranged_select(f, keys, ranks)
    # at most two ranks per prob in a group: a bounded map
    at = picked.groupBy(*keys).agg(
        F.first("__total").alias("__total"),
        F.map_from_entries(F.collect_list(F.struct("__rank", to_double(F.col("__k")).alias("__v")))).alias("__m"))
    cols = []
    for p, n in zip(probs, names):
        x = (F.col("__total") - 1).cast("double") * F.lit(float(p))
        lo, hi = F.floor(x).cast("bigint"), F.ceil(x).cast("bigint")
        vlo, vhi = F.element_at("__m", lo), F.element_at("__m", hi)
        cols.append(F.when(lo == hi, vlo)
                    .otherwise((hi.cast("double") - x) * vlo + (x - lo.cast("double")) * vhi).alias(n))
    return at.select(*keys, *cols)
