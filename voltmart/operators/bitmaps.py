"""Sets of integers as bitmap rows: one row per (keys, word), a word holding 64 neighbouring values as a bit mask.

Any integer is held (negative ones too), masks of the same word OR together, so sets kept per day merge to months and
years, and a set's rows are spread over tasks by word: nothing is gathered per key. Two uses: distinct counts that merge,
and the presence of stored keys (a day's 48 periods are one row).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.expressions import _col

WORD, MASK = "__word", "__mask"
WORD_BITS = 6


def word_of(value: str | Column) -> Column:
    """Number of the 64-value word: floor(value / 64)."""
    return F.shiftright(_col(value).cast("bigint"), WORD_BITS)


def bit_of(value: str | Column) -> Column:
    """Place of the value in its word, 0..63."""
    return _col(value).cast("bigint").bitwiseAND(F.lit((1 << WORD_BITS) - 1)).cast("int")


def bitmap_words(df: DataFrame, keys: Sequence[str], value: str | Column, cond: Column | None = None) -> DataFrame:
    """keys, word and mask of the non-null values where `cond` holds: one aggregation, combined map-side."""
    v = _col(value)
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), bit_of(v))
    rows = df.where(v.isNotNull() if cond is None else cond & v.isNotNull())
    return rows.groupBy(*keys, word_of(v).alias(WORD)).agg(F.bit_or(bit).alias(MASK))


def merge_words(words: DataFrame, keys: Sequence[str | Column]) -> DataFrame:
    """Bitmap rows of coarser keys: the masks of a word are OR-ed."""
    return words.groupBy(*keys, WORD).agg(F.bit_or(MASK).alias(MASK))


def count_words(words: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    """Distinct values per key of merged bitmap rows."""
    return words.groupBy(*keys).agg(F.sum(F.bit_count(MASK).cast("bigint")).alias(name))


def mark_present(rows: DataFrame, keys: Sequence[str], number: str, present: DataFrame, name: str) -> DataFrame:
    """`rows` (no null in a key) with a boolean `name`: whether `present` (merged bitmap rows of `number` per other key)
    holds the key. A join adds no rows: a word is there once."""
    others = [k for k in keys if k != number]
    found = rows.withColumn(WORD, word_of(number)).join(present, [*others, WORD], "left")
    bit = F.getbit(F.coalesce(F.col(MASK), F.lit(0).cast("bigint")), bit_of(number))
    return found.withColumn(name, bit == 1).select(*rows.columns, name)
