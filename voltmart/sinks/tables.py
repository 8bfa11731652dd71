"""Table writes on plain Parquet.

Loads never overwrite the directory they read. A batch or version counts as
committed once its write job left the ``_SUCCESS`` marker, so a failed or lost
job leaves the table as it was, whatever files it left behind; the next load
takes a number above every folder present.

* Insert-ignore tables are append-only: a load writes just the rows it adds as
  a new ``<base>/batch=<n>`` directory (cost: the new rows plus an anti join on
  the keys, not a rewrite), and the table is the union of committed batches.
  With `month_of`, batches are partitioned by month and the anti join reads only
  the months that the incoming rows touch. With `presence`, an integer key column,
  each batch has bitmaps of that key beside it (``<base>/presence/batch=<n>``), and
  the anti join reads those: no stored row is read, and a day's periods are one row.
* Upsert tables loaded with `month_of` write only the months that the incoming
  rows touch: a load is ``<base>/load=<n>/load_month=<m>``, each month whole, and
  readers take every month from its newest committed load. One marker commits a
  load's months together, so a crash leaves all of them as they were.
* Other upserts and full refreshes write a whole new version ``<base>/v=<n>``
  and readers take the newest committed one.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.bitmaps import MASK, WORD, bitmap_words, merge_words
from ..operators.dedup import conflict_ledger, insert_ignore, insert_with_conflicts, upsert
from ..schemas import ddl
from ..session import scratch_path


MONTH = "load_month"


def _numbers(spark: SparkSession, base: str, kind: str, marker: str = "") -> list[int]:
    """Numbers of the `kind=<n>` folders under `base` (kind: v or batch) that hold `marker`.
    One listing of folder names; a listing that fails raises, only a missing path is empty."""
    jpath = spark._jvm.org.apache.hadoop.fs.Path(f"{base.rstrip('/')}/{kind}=*{marker}")
    found = jpath.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(jpath) or []
    folders = [f.getPath().getParent().getName() if marker else f.getPath().getName() for f in found]
    return sorted(int(n.split("=")[1]) for n in folders if n.split("=")[1].isdigit())


def _committed(spark: SparkSession, base: str, kind: str) -> list[int]:
    return _numbers(spark, base, kind, "/_SUCCESS")


def _write_next(df: DataFrame, base: str, kind: str, partition_by: Sequence[str] = ()) -> str:
    """Write `df` as ``<kind>=<n>``, one above every folder present, committed or not."""
    path = f"{base.rstrip('/')}/{kind}={max(_numbers(df.sparkSession, base, kind), default=0) + 1}"
    w = df.write.mode("errorifexists").option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "true")
    (w.partitionBy(*partition_by) if partition_by else w).parquet(path)
    return path


def latest_version(spark: SparkSession, base: str) -> str | None:
    vs = _committed(spark, base, "v")
    return f"{base.rstrip('/')}/v={vs[-1]}" if vs else None


def month_folders(spark: SparkSession, base: str) -> dict[int, str]:
    """Newest committed folder of each month of an upsert table loaded by month; one listing of folder names."""
    base = base.rstrip("/")
    done = set(_committed(spark, base, "load"))
    if not done:
        return {}
    jpath = spark._jvm.org.apache.hadoop.fs.Path(f"{base}/load=*/{MONTH}=*")
    newest: dict[int, int] = {}
    for f in jpath.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(jpath) or []:
        load, month = int(f.getPath().getParent().getName().split("=")[1]), int(f.getPath().getName().split("=")[1])
        if load in done:
            newest[month] = max(load, newest.get(month, 0))
    return {m: f"{base}/load={n}/{MONTH}={m}" for m, n in sorted(newest.items())}


def read_table(spark: SparkSession, base: str, schema: T.StructType | None = None,
               months: Sequence[int] | None = None) -> DataFrame | None:
    """Current rows: all committed batches of an append table, or the newest version. `months`
    (year * 100 + month) keeps only those partitions of a table loaded with `month_of`."""
    base = base.rstrip("/")
    by_month = month_folders(spark, base)
    if by_month:
        paths = [p for m, p in by_month.items() if months is None or m in months]
    else:
        paths = [f"{base}/batch={b}" for b in _committed(spark, base, "batch")] or [
            p for p in [latest_version(spark, base)] if p]
    if not paths:
        return spark.createDataFrame([], schema) if schema is not None else None
    reader = spark.read.option("basePath", base)   # a load without rows holds no file to tell the columns
    df = (reader.schema(schema) if schema is not None else reader).parquet(*paths)   # folder levels become columns: v, batch or load, month
    if months is not None:
        df = df.where(F.col(MONTH).isin(list(months)))
    return df.drop("v", "batch", "load", MONTH)


def register_table(spark: SparkSession, name: str, base: str, schema: T.StructType | None = None) -> DataFrame:
    """Point the SQL name `name` at the table's current rows (re-run after each load:
    readers of the name then see the new batch or version, never a partial write)."""
    df = read_table(spark, base, schema)
    if df is None:
        raise FileNotFoundError(f"no committed data under {base}")
    df.createOrReplaceTempView(name)
    return df


def append_batch(df: DataFrame, base: str, partition_by: Sequence[str] = ()) -> str:
    """Write `df` as the next batch of the append table at `base`."""
    return _write_next(df, base, "batch", partition_by)


def write_version(df: DataFrame, base: str, sort_by: Sequence[str] = (), partition_by: Sequence[str] = ()) -> str:
    """Write `df` as the next version of the table at `base` and return its path."""
    return _write_next(df.sortWithinPartitions(*sort_by) if sort_by else df, base, "v", partition_by)


def _months(incoming: DataFrame, month: Column) -> list[int]:
    """Months that occur in `incoming`: numbers bounded by the calendar."""
    return [r[0] for r in incoming.select(month).distinct().collect() if r[0] is not None]


def _write_presence(spark: SparkSession, base: str, batch: int, keys: Sequence[str], number: str,
                    schema: T.StructType, month_of: str | None) -> None:
    """Bitmap rows of one batch, from its key columns alone (a batch without rows holds no file to tell its columns)."""
    rows = spark.read.schema(T.StructType([f for f in schema.fields if f.name in keys])).parquet(f"{base}/batch={batch}")
    month = [(F.year(month_of) * 100 + F.month(month_of)).alias(MONTH)] if month_of else []
    words = bitmap_words(rows.select(*keys, *month).dropna(subset=list(keys)), [k for k in keys if k != number] + [MONTH] * len(month), number)
    w = words.write.mode("overwrite").option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "true")
    (w.partitionBy(MONTH) if month_of else w).parquet(f"{base}/presence/batch={batch}")


def read_presence(spark: SparkSession, base: str, keys: Sequence[str], number: str, schema: T.StructType,
                  month_of: str | None = None, months: Sequence[int] | None = None) -> DataFrame | None:
    """Merged bitmap rows (other keys, word, mask) of the stored keys of an append table. Batches without bitmaps, as a
    crash between a batch and its bitmaps leaves them, or as loaded before, get them now, from their key columns."""
    base = base.rstrip("/")
    batches = _committed(spark, base, "batch")
    if not batches:
        return None
    for batch in sorted(set(batches) - set(_committed(spark, f"{base}/presence", "batch"))):
        _write_presence(spark, base, batch, keys, number, schema, month_of)
    others = [f for f in schema.fields if f.name in keys and f.name != number]
    numbers = [T.StructField(n, T.LongType()) for n in (WORD, MASK)] + [T.StructField(MONTH, T.IntegerType())] * bool(month_of)
    words = (spark.read.schema(T.StructType(others + numbers)).option("basePath", f"{base}/presence")
             .parquet(*[f"{base}/presence/batch={b}" for b in batches]))
    if months is not None:
        words = words.where(F.col(MONTH).isin(list(months)))
    return merge_words(words, [k for k in keys if k != number])


def load_insert_ignore(spark: SparkSession, base: str, incoming: DataFrame, keys: Sequence[str],
                       order: Sequence[str | Column], schema: T.StructType, month_of: str | None = None,
                       conflicts: bool = False, presence: str | None = None) -> str:
    """First-wins load of `incoming` into the append table at `base`: only the
    rows whose key is new are written, as one more batch.

    `month_of` names a date column of the key: batches are then partitioned by its
    month, sorted by it, and the stored keys are read only for the months that occur
    in `incoming` (their numbers, bounded by the calendar, are all the driver sees).
    Use it for every load of a table or for none.

    With `conflicts` the keys whose rows were not all loaded are kept too (``read_conflicts``),
    so that rows in = rows loaded + sum of n_lost. Winners and losers come from one pass, which
    is written to the shared scratch folder first.

    `presence` names an integer key column (such as the period of a day): stored keys are then
    looked up in bitmaps kept beside the batches, one row per word of 64 values, and no stored
    row is read. Loads with and without it may alternate: bitmaps that are missing are made.
    """
    columns = [f.name for f in schema.fields]
    month = F.year(month_of) * 100 + F.month(month_of) if month_of else None
    months = _months(incoming, month) if month_of else None
    if presence is not None and presence not in keys:
        raise ValueError(f"presence column {presence!r} must be part of the key")
    stored = read_presence(spark, base, keys, presence, schema, month_of, months) if presence else None
    looked_up = (presence, stored) if stored is not None else None
    existing = None if presence else read_table(spark, base, schema, months)
    if conflicts:
        staged = scratch_path(spark, "load")
        insert_with_conflicts(incoming, keys, order, existing, looked_up).write.mode("errorifexists").parquet(staged)
        resolved = spark.read.parquet(staged)
        added = resolved.where(~F.col("__stored"))
        ledger = conflict_ledger(resolved, keys)
    else:
        added = insert_ignore(incoming, keys, order, existing, looked_up)
    if month_of is None:
        path = append_batch(added.select(*columns), base)
    else:
        rows = added.select(*columns, month.alias(MONTH))
        path = append_batch(rows.hint("rebalance", MONTH).sortWithinPartitions(MONTH, month_of), base, [MONTH])
    if conflicts:  # under the batch's number; a crash before this leaves the batch without its ledger, never the reverse
        ledger.write.mode("overwrite").parquet(f"{base.rstrip('/')}/conflicts/{path.rsplit('/', 1)[-1]}")
    if presence:
        _write_presence(spark, base.rstrip("/"), int(path.rsplit("=", 1)[-1]), keys, presence, schema, month_of)
    return path


def read_conflicts(spark: SparkSession, base: str, batch: int) -> DataFrame:
    """Keys, n_lost and to_stored of the rows that the given batch's load did not add."""
    return spark.read.parquet(f"{base.rstrip('/')}/conflicts/batch={batch}")


def load_upsert(spark: SparkSession, base: str, incoming: DataFrame, keys: Sequence[str],
                order: Sequence[str | Column], schema: T.StructType, stamp_col: str = "inserted_at",
                month_of: str | None = None) -> str:
    """Last-wins load of `incoming` into the table at `base`.

    `month_of` names a date column of the key: only the months that occur in `incoming` are read and
    written again, each whole, as one more committed load. Without it a new version of the whole
    table is written. Use it for every load of a table or for none.
    """
    columns = [f.name for f in schema.fields]
    if month_of is None:
        existing = read_table(spark, base, schema)
        return write_version(upsert(existing, incoming, keys, order, stamp_col).select(*columns), base)
    if month_of not in keys:
        raise ValueError("month_of must be part of the key: else a row could move between months")
    month = F.year(month_of) * 100 + F.month(month_of)
    existing = read_table(spark, base, schema, _months(incoming, month))
    merged = upsert(existing, incoming, keys, order, stamp_col).select(*columns, month.alias(MONTH))
    return _write_next(merged.hint("rebalance", MONTH).sortWithinPartitions(MONTH, month_of), base, "load", [MONTH])


def superseded(spark: SparkSession, base: str) -> list[str]:
    """Month folders that a newer committed load has replaced, for the caller to delete once no reader is left on them."""
    base = base.rstrip("/")
    now = {p.rsplit(f"{base}/", 1)[-1] for p in month_folders(spark, base).values()}
    done = set(_committed(spark, base, "load"))
    jpath = spark._jvm.org.apache.hadoop.fs.Path(f"{base}/load=*/{MONTH}=*")
    found = jpath.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(jpath) or []
    names = sorted(f"{f.getPath().getParent().getName()}/{f.getPath().getName()}" for f in found)
    return [f"{base}/{n}" for n in names if n not in now and int(n.split("/")[0].split("=")[1]) in done]


def append(df: DataFrame, path: str) -> None:
    """Plain append (a re-run duplicates rows, as in the source's retail load)."""
    df.write.mode("append").parquet(path)


def materialise(df: DataFrame, path: str, sort_by: Sequence[str] = (), partition_by: Sequence[str] = ()) -> str:
    """Full refresh: a new version under `path` (readers of ``read_table`` keep the old one until
    it is complete); rows sorted within files for min/max pruning. Returns the version's path."""
    return write_version(df, path, sort_by, partition_by)


def write_csv(df: DataFrame, path: str) -> None:
    """CSV export with a header row (one folder of part files)."""
    df.write.mode("overwrite").option("header", True).csv(path)


def create_table(spark: SparkSession, name: str, schema: T.StructType, location: str) -> None:
    """Idempotent declared table (CREATE TABLE IF NOT EXISTS ... USING parquet)."""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({ddl(schema)}) USING parquet LOCATION '{location}'")
