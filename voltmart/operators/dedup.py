"""Keyed table maintenance: first-wins insert (ON CONFLICT DO NOTHING) and
last-wins upsert (ON CONFLICT DO UPDATE), written as aggregations so a hot key
is pre-combined map-side and never gathered whole into one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .bitmaps import mark_present


def _as_cols(cols: Sequence[str | Column]) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in cols]


def _any_null(keys: Sequence[str]) -> Column:
    cond = F.lit(False)
    for k in keys:
        cond = cond | F.col(k).isNull()
    return cond


def first_wins(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column],
               keep_order_cols: bool = False, count_as: str | None = None) -> DataFrame:
    """One row per non-null key: the row with the smallest `order` value.

    `count_as` names a column for how many rows the key had, counted in the same pass.

    Rows with a null key part never conflict (unique-constraint semantics) and
    are all kept: they are grouped by their own arrival order as well, which
    must be unique per row. One aggregation pass, combined map-side, so a hot
    key is reduced to one row per task before the shuffle. The payload travels
    as one struct, so the order value is carried once per row: select the
    columns you need before. `order` columns (arrival order) are dropped unless
    asked for.
    """
    keys = list(keys)
    order_names = [c for c in order if isinstance(c, str)]
    order_key = F.struct(*_as_cols(order))
    payload_cols = [c for c in df.columns if c not in keys and (keep_order_cols or c not in order_names)]
    out_cols = [c for c in df.columns if c in keys or c in payload_cols]
    tiebreak = F.when(_any_null(keys), order_key).alias("__nullkey")
    row = F.min_by(F.struct(*payload_cols), order_key) if payload_cols else F.count(F.lit(1))
    counts = [F.count(F.lit(1)).alias(count_as)] if count_as else []
    return (df.groupBy(*keys, tiebreak).agg(row.alias("__row"), *counts)
            .select(*[c if c in keys else F.col(f"__row.`{c}`").alias(c) for c in out_cols], *([count_as] if count_as else [])))


def insert_ignore(incoming: DataFrame, keys: Sequence[str], order: Sequence[str | Column],
                  existing: DataFrame | None = None, presence: tuple[str, DataFrame] | None = None) -> DataFrame:
    """Rows of `incoming` that a first-wins insert would add to `existing`.

    Earlier `order` beats later within the batch; existing rows beat all new
    ones (left anti join on the key). Rows with a null key part can match
    nothing, and all null keys would hash to one join partition, so they
    bypass the join and are added back with a union. `presence` (an integer key
    column and its merged bitmap rows, see bitmaps.py) stands for `existing`.
    """
    new_rows = first_wins(incoming, keys, order)
    if existing is None and presence is None:
        return new_rows
    null_key = _any_null(keys)
    if presence is not None:
        keyed = mark_present(new_rows.where(~null_key), keys, *presence, "__stored").where(~F.col("__stored"))
        return keyed.select(*new_rows.columns).unionByName(new_rows.where(null_key))
    present = existing.select(*keys).where(~null_key)
    keyed = new_rows.where(~null_key).join(present, on=list(keys), how="left_anti")
    return keyed.select(*new_rows.columns).unionByName(new_rows.where(null_key))


def insert_with_conflicts(incoming: DataFrame, keys: Sequence[str], order: Sequence[str | Column],
                          existing: DataFrame | None = None, presence: tuple[str, DataFrame] | None = None) -> DataFrame:
    """One row per key of `incoming` with its winner, `__n` (rows the key had) and `__stored` (the key was in `existing`,
    so every one of those rows lost). Rows with a null key are rows of their own.

    The rows to add are those not stored; `conflict_ledger` makes the rest. One aggregation and one join for both.
    """
    rows = first_wins(incoming, keys, order, count_as="__n")
    if existing is None and presence is None:
        return rows.withColumn("__stored", F.lit(False))
    null_key = _any_null(keys)
    nulls = rows.where(null_key).withColumn("__stored", F.lit(False))
    if presence is not None:
        return mark_present(rows.where(~null_key), keys, *presence, "__stored").select(*nulls.columns).unionByName(nulls)
    # a stored key is there once, so the join adds no rows
    present = existing.select(*keys).where(~null_key).withColumn("__stored", F.lit(True))
    keyed = rows.where(~null_key).join(present, on=list(keys), how="left").withColumn("__stored", F.coalesce("__stored", F.lit(False)))
    return keyed.select(*nulls.columns).unionByName(nulls)


def conflict_ledger(resolved: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys of ``insert_with_conflicts`` with rows that were not loaded: n_lost of them, `to_stored` if a stored row won
    (else the earliest row of the same load did)."""
    lost = F.col("__n") - F.when(F.col("__stored"), 0).otherwise(1)
    return resolved.select(*keys, lost.alias("n_lost"), F.col("__stored").alias("to_stored")).where("n_lost > 0")


def table_after_insert(existing: DataFrame, incoming: DataFrame, keys: Sequence[str],
                       order: Sequence[str | Column]) -> DataFrame:
    """Full table state after insert-ignore of `incoming` into `existing`."""
    added = insert_ignore(incoming, keys, order, existing)
    return existing.unionByName(added.select(*existing.columns))


def upsert(existing: DataFrame | None, incoming: DataFrame, keys: Sequence[str],
           order: Sequence[str | Column] = (), stamp_col: str | None = "inserted_at",
           stamp: Column | None = None) -> DataFrame:
    """Last-wins merge on `keys`; touched rows get a fresh `stamp_col`.

    Within `incoming`, a later `order` wins (duplicate keys in one batch are
    resolved, not fatal). Untouched existing rows keep their stamp. Rows with a
    null key part violate NOT NULL and are excluded (see quality.null_key_rows).
    """
    keys = list(keys)
    order_names = {c for c in order if isinstance(c, str)}
    columns = [c for c in incoming.columns if c not in order_names]
    if stamp_col and stamp_col not in columns:
        columns.append(stamp_col)
    inc = incoming.withColumns({f"__o{i}": e for i, e in enumerate(_as_cols(order))})
    if stamp_col:
        inc = inc.withColumn(stamp_col, stamp if stamp is not None else F.current_timestamp())
    ver = [f"__o{i}" for i in range(len(order))]
    inc = inc.select(*columns, F.lit(1).alias("__v"), *ver)
    allrows = inc
    if existing is not None:
        ex = existing.select(*columns, F.lit(0).alias("__v"),
                             *[F.lit(None).cast(inc.schema[v].dataType).alias(v) for v in ver])
        allrows = ex.unionByName(inc)
    payload = [c for c in columns if c not in keys]
    return (allrows.where(~_any_null(keys))
            .groupBy(*keys)
            .agg(F.max_by(F.struct(*payload), F.struct("__v", *ver)).alias("__row"))
            .select(*keys, "__row.*")
            .select(*columns))
