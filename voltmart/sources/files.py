"""File scans: wide generation CSVs, nodal price CSVs, retail CSVs, weather
JSON / CSV, with header drift handled by name, lenient typing, file lineage and
a rejects table instead of a failed job.

Header drift (H1): one ``read.csv`` over files with different headers maps
columns by position. So the first line of every file is read once (tasks open
each file and stop at the first newline), files are grouped by header, and each
group is read with its own all-string schema; groups are then unioned by name.
Only the small header -> files map reaches the driver. Files in which quoted
cells hold line feeds are cut into records first (csv_records), block by block.
"""

from __future__ import annotations

import csv
from collections.abc import Sequence
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import constants as C
from .. import schemas as S
from ..functions.parsing import to_date_lenient, to_integral, to_number
from ..operators.joins import maybe_broadcast
from ..operators.reshape import (ensure_columns, normalise_headers, rename_present, select_present,
                                 period_columns, union_all, unpivot_periods)
from .csv_records import files_with_lines, files_with_open_lines, records

ORDER = "__arrival"
MALFORMED = "__malformed"
# what every reader reports: a whole file (record null) or one record it did not load
REJECTS = T.StructType([T.StructField(n, T.StringType()) for n in ("path", "reason", "record")])
ORDER_TYPE = T.StructType([T.StructField("f", T.StringType()), T.StructField("b", T.LongType()),
                           T.StructField("r", T.LongType())])


def _with_order(schema: T.StructType) -> T.StructType:
    return T.StructType(list(schema.fields) + [T.StructField(ORDER, ORDER_TYPE)])


def list_files(spark: SparkSession, path: str, glob: str = "*", recursive: bool = False) -> DataFrame:
    """Distributed listing (path, name, size) without reading contents."""
    reader = spark.read.format("binaryFile").option("pathGlobFilter", glob)
    if recursive:
        reader = reader.option("recursiveFileLookup", True)
    return (reader.load(path)
            .select("path", F.element_at(F.split("path", "/"), -1).alias("file_name"),
                    F.col("length").alias("file_size")))


def file_year(name: Column) -> Column:
    """Leading YYYY of a file name, null when the name does not start with digits."""
    return F.substring(name, 1, 4).try_cast("int")


def select_files_by_year(files: DataFrame, start: int, end: int, name_col: str = "file_name") -> DataFrame:
    """Files whose name starts with a year in [start, end]; others are dropped."""
    return files.where(file_year(F.col(name_col)).between(start, end))


UNKNOWN = "scheme not known to Arrow"
LONGEST_HEADER = 1 << 20  # bytes


def first_line_reader():
    """mapInPandas body reading the first line of each file with bounded I/O.

    Built as a self-contained closure so it ships to executors by value: the
    tasks do not need this package installed (the error text is bound as a local). Hadoop-style URIs are mapped to
    ones Arrow's file systems open (file:/x -> file:///x, s3a:// -> s3://).
    A file that cannot be read is reported in `error` instead of failing.
    """
    UNKNOWN_SCHEME, LONGEST = UNKNOWN, LONGEST_HEADER

    def read(batches):
        import pandas as pd
        import pyarrow.fs as pafs

        def arrow_uri(path):
            if path.startswith("file:") and not path.startswith("file://"):
                return "file://" + path[len("file:"):]
            for hadoop in ("s3a://", "s3n://"):
                if path.startswith(hadoop):
                    return "s3://" + path[len(hadoop):]
            return path

        for pdf in batches:
            heads, errors = [], []
            for path in pdf["path"]:
                try:
                    fs, inner = pafs.FileSystem.from_uri(arrow_uri(path))
                except Exception:  # noqa: BLE001 - a scheme Arrow does not know: the caller asks Hadoop's client
                    heads.append(None)
                    errors.append(UNKNOWN_SCHEME)
                    continue
                try:
                    buf = b""
                    with fs.open_input_stream(inner) as f:
                        while b"\n" not in buf:
                            chunk = f.read(1 << 16)
                            if not chunk:
                                break
                            buf += chunk
                            if len(buf) > LONGEST:
                                raise ValueError(f"no line end in the first {LONGEST} bytes")
                    heads.append(buf.split(b"\n", 1)[0].decode("utf-8-sig").rstrip("\r"))
                    errors.append(None)
                except Exception as e:  # noqa: BLE001 - one bad file is reported, the rest load
                    heads.append(None)
                    errors.append(f"unreadable: {type(e).__name__}: {e}"[:300])
            yield pd.DataFrame({"path": pdf["path"], "header": heads, "error": errors})

    return read


def _first_line_by_hadoop(spark: SparkSession, path: str) -> tuple[str | None, str | None]:
    """(first line, error) of one file through Spark's own file system client: one small read."""
    jvm = spark._jvm
    try:
        jpath = jvm.org.apache.hadoop.fs.Path(path)
        stream = jpath.getFileSystem(spark._jsc.hadoopConfiguration()).open(jpath)
        try:
            return jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(stream, "UTF-8")).readLine(), None
        finally:
            stream.close()
    except Exception as e:  # noqa: BLE001 - one bad file is reported, the rest load
        return None, f"unreadable: {type(e).__name__}"


UNREADABLE: tuple[str, ...] = ()


def file_headers(spark: SparkSession, paths: Sequence[str]) -> dict[tuple[str, ...], list[str]]:
    """Header (as a tuple of names) -> files having it; unreadable files are
    listed under the empty header ``UNREADABLE``.

    Only the first line of each file is read: the path list is spread over the
    task slots and each task opens its files with Arrow's file systems and
    stops at the first newline, so the cost is one small read per file, not a
    scan of the data. Only the small header -> files map reaches the driver.
    """
    if not paths:
        return {}
    paths = list(paths)
    slots = max(1, min(len(paths), spark.sparkContext.defaultParallelism))
    listing = spark.createDataFrame([(p,) for p in paths], "path string").repartition(slots)
    rows = listing.mapInPandas(first_line_reader(), "path string, header string, error string").collect()
    groups: dict[tuple[str, ...], list[str]] = {}
    for path, line, error in rows:  # one short row per file: bounded by the listing
        if error == UNKNOWN:
            line, error = _first_line_by_hadoop(spark, path)
        if error is not None:
            groups.setdefault(UNREADABLE, []).append(path)
            continue
        groups.setdefault(header_names(line or ""), []).append(path)
    return groups


def header_names(line: str) -> tuple[str, ...]:
    """Names of a header line, quoted ones with commas in them too; UNREADABLE if a quote stays open or a name repeats."""
    try:
        names = tuple(h.strip() for h in next(csv.reader([line.lstrip("\ufeff")], strict=True), [""]))
    except csv.Error:
        return UNREADABLE
    return names if len(set(names)) == len(names) else UNREADABLE


def read_csv_by_header(spark: SparkSession, paths: Sequence[str] | dict[tuple[str, ...], list[str]],
                       lower: bool = True, na_tokens: Sequence[str] = C.NA_TOKENS, na_columns: Sequence[str] | None = None) -> DataFrame:
    """All-string read of CSV files whose headers may differ, matched by name.

    `paths` may already be grouped by header (as ``split_files_by_schema``
    returns them). Cells that equal one of `na_tokens` become null (only those of
    `na_columns`, if given; a test for each of many columns makes the scan's
    generated method too long for the JVM to compile). Adds file
    lineage (`file_name`), an arrival order column (`__arrival`: file path, split
    start, row id) for first-wins loading, and `__malformed`: the text of a
    record with more cells than its header (null for sound and for short ones,
    whose missing cells are null), or what is wrong with a file whose last quote
    stays open.
    """
    groups = paths if isinstance(paths, dict) else file_headers(spark, paths)
    # Spark reports paths URL-encoded
    open_files = {_bare(p) for f in files_with_open_lines(spark, [f for files in groups.values() for f in files]) for p in (f, unquote(f))} if groups else set()
    parts = []
    for header, files in sorted(groups.items()):
        names = [h.lower() if lower else h for h in header]
        schema = T.StructType([T.StructField(n, T.StringType()) for n in [*names, MALFORMED]])
        options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": MALFORMED, "escape": '"'}
        plain = sorted(f for f in files if _bare(f) not in open_files)
        if plain:
            df = (spark.read.schema(schema).options(header=True, enforceSchema=True, **options).csv(plain)
                  .select("*", F.col("_metadata.file_name").alias("file_name"), F.struct(
                      F.col("_metadata.file_path").alias("f"),   # path order = name order within a folder
                      F.col("_metadata.file_block_start").alias("b"), F.monotonically_increasing_id().alias("r")).alias(ORDER)))
            parts.append(_cells(df, names, na_tokens, na_columns))
        rest = sorted(f for f in files if _bare(f) in open_files)
        if rest:
            whole, unclosed = records(spark, rest)
            first = F.min(F.struct("b", "r")).over(Window.partitionBy("f", "b")) == F.struct("b", "r")  # of its block
            text = F.regexp_replace("text", "\r$", "")
            body = whole.withColumn("header", (F.col("b") == 0) & first).where(~F.col("header") & (F.trim(text) != F.lit("")))
            df = body.select(F.from_csv(text, schema.toDDL(), options).alias("row"), F.col("name").alias("file_name"), F.struct("f", "b", "r").alias(ORDER))
            parts.append(_cells(df.select("row.*", "file_name", ORDER), names, na_tokens, na_columns))
            lost = unclosed.select(*[F.lit(None).cast("string").alias(n) for n in names], F.lit("a quote is never closed: no record of the file is read").alias(MALFORMED),
                                   F.element_at(F.split("f", "/"), -1).alias("file_name"), F.struct(F.col("f"), F.lit(0).cast("long").alias("b"), F.lit(0).cast("long").alias("r")).alias(ORDER))
            parts.append(lost)
    if not parts:
        raise FileNotFoundError("no input files")
    return union_all(parts)


def _bare(path: str) -> str:
    """A path without the writing of a local scheme (file:/x, file:///x, /x)."""
    return "/" + path[len("file:"):].lstrip("/") if path.startswith("file:") else path


def _null_tokens(names: Sequence[str], na_tokens: Sequence[str]) -> dict[str, Column]:
    return {n: F.when(~F.col(f"`{n}`").isin(*na_tokens), F.col(f"`{n}`")) for n in names}


def _cells(df: DataFrame, names: Sequence[str], na_tokens: Sequence[str], na_columns: Sequence[str] | None = None) -> DataFrame:
    """Cells (of `na_columns`) that equal one of `na_tokens` as null; MALFORMED only for records with more cells than `names`."""
    bare = F.regexp_replace(MALFORMED, '"[^"]*"', "")   # quoted cells may hold commas
    cells = F.length(bare) - F.length(F.replace(bare, F.lit(","))) + 1
    tested = names if na_columns is None else [n for n in names if n in na_columns]
    return df.withColumns({**_null_tokens(tested, na_tokens), MALFORMED: F.when(cells > len(names), F.col(MALFORMED))})


def _paths(files: DataFrame | Sequence[str]) -> list[str]:
    if isinstance(files, DataFrame):
        return sorted(r["path"] for r in files.select("path").collect())
    return sorted(files)


def split_files_by_schema(spark: SparkSession, paths: Sequence[str], required: Sequence[str],
                          rename: dict[str, str] | None = None, lower: bool = False,
                          need_prefix: str | None = None) -> tuple[dict[tuple[str, ...], list[str]], DataFrame]:
    """Files whose header holds every required column -> accepted (header ->
    files); the rest, and unreadable files, -> a rejects DataFrame (path, reason, record)."""
    rename = rename or {}
    accepted: dict[tuple[str, ...], list[str]] = {}
    rejected = []
    for header, fs in file_headers(spark, paths).items():
        names = {rename.get(h, h) for h in header}
        names = {n.lower() for n in names} if lower else names
        missing = [c for c in required if c not in names]
        if need_prefix and not any(n.startswith(need_prefix) for n in names):
            missing.append(f"{need_prefix}N")
        if header == UNREADABLE:
            rejected += [(f, "unreadable file", None) for f in fs]
        elif missing:
            rejected += [(f, f"missing required columns: {missing}", None) for f in fs]
        else:
            accepted[header] = sorted(fs)
    return accepted, spark.createDataFrame(rejected, REJECTS)


def _row_rejects(df: DataFrame, reason: Column, record: Column | None = None) -> DataFrame:
    """Records of `df` (with the arrival column) that a reader does not load, where `reason` is not null."""
    cells = [c for c in df.columns if c not in (ORDER, MALFORMED, "file_name", "__layout")]
    text = record if record is not None else F.to_json(F.struct(*[F.col(f"`{c}`") for c in cells]))
    if MALFORMED in df.columns:
        text = F.coalesce(F.col(MALFORMED), text)
    return df.select(F.col(f"{ORDER}.f").alias("path"), reason.alias("reason"), text.alias("record")).where(
        F.col("reason").isNotNull())


def _malformed() -> Column:
    return F.when(F.col(MALFORMED).isNotNull(), F.lit("malformed record"))


# ---------------------------------------------------------------- date layouts

_YEAR_LAST_DATE = r"^\s*([0-9]{1,2})[-/.]([0-9]{1,2})[-/.][0-9]{4}(?:[ T].*)?$"
YEAR_LAST_ANYWHERE = "[0-9][-/.][0-9]{1,2}[-/.][0-9]{4}"  # in each text that _YEAR_LAST_DATE matches
MONTH_FIRST, DISAGREE = "month first", "date layouts disagree within the file"


def date_layouts(df: DataFrame, column: str) -> list[tuple[str, str]]:
    """Files whose year-last dates are not to be read day-first: (path, MONTH_FIRST) where some date can only be month-first
    and none only day-first, (path, DISAGREE) where both kinds occur. A file without a telling date is day-first.

    One narrow aggregation over the date column; at most one row per file reaches the driver, bounded by the listing.
    """
    one, two = (F.regexp_extract(column, _YEAR_LAST_DATE, i).try_cast("int") for i in (1, 2))
    told = df.select(F.col(f"{ORDER}.f").alias("f"), one.alias("a"), two.alias("b")).where("a IS NOT NULL AND b IS NOT NULL")
    kinds = told.groupBy("f").agg(F.count_if(F.col("a").between(13, 31) & F.col("b").between(1, 12)).alias("day"),
                                  F.count_if(F.col("b").between(13, 31) & F.col("a").between(1, 12)).alias("month"))
    return [(r["f"], DISAGREE if r["day"] else MONTH_FIRST) for r in kinds.where("month > 0").collect()]


def with_dates(df: DataFrame, column: str, files: Sequence[str] | None = None) -> tuple[DataFrame, Column, Column]:
    """`df` with what its files' date layouts need, the date column read by each file's layout, and the reason to reject a
    record whose file holds both layouts (only its year-last dates; other layouts read the same everywhere).

    `files` are those that `df` reads, if known: their cells are parsed for layouts only if some line of them holds what a
    year-last date looks like.
    """
    layouts = date_layouts(df, column) if files is None or files_with_lines(df.sparkSession, files, YEAR_LAST_ANYWHERE) else []
    if not layouts:
        return df, to_date_lenient(column), F.lit(None).cast("string")
    known = df.sparkSession.createDataFrame(layouts, "__file string, __layout string")
    held = df.join(maybe_broadcast(known, len(layouts)), F.col(f"{ORDER}.f") == F.col("__file"), "left").drop("__file")
    unclear = (F.col("__layout") == DISAGREE) & F.col(column).rlike(_YEAR_LAST_DATE)
    date = F.when(unclear, F.lit(None).cast("date")).when(F.col("__layout") == MONTH_FIRST, to_date_lenient(column, day_first=False)).otherwise(to_date_lenient(column))
    return held, date, F.when(unclear, F.lit(DISAGREE))


# ---------------------------------------------------------------- generation

def read_generation(spark: SparkSession, files: DataFrame | Sequence[str],
                    ids: Sequence[str] = C.GENERATION_ID_COLUMNS) -> tuple[DataFrame, DataFrame]:
    """Wide generation files -> (long rows with arrival order, rejects).

    A file missing an id column is rejected whole (the source raised for it);
    the remaining files load. Rejected too are wide records with too many cells or
    without a date, and cells that hold something other than a number.
    """
    ok, rejects = split_files_by_schema(spark, _paths(files), ids, lower=True, need_prefix=C.PERIOD_PREFIX)
    if not ok:
        return spark.createDataFrame([], _with_order(S.RAW_GENERATION)), rejects
    wide = normalise_headers(read_csv_by_header(spark, ok, na_columns=ids))
    periods = period_columns(wide.columns)
    wide = wide.select(*ids, ORDER, MALFORMED, *periods)
    wide, date, unclear = with_dates(wide, "trading_date", [f for fs in ok.values() for f in fs])
    no_date = F.when(date.isNull(), F.lit("no trading_date"))
    bad_row = F.coalesce(_malformed(), unclear, no_date)
    sound = wide.where(bad_row.isNull()).withColumn("trading_date", date)
    cells = sound.select(ORDER, F.inline(F.array(*[
        F.struct(F.lit(c).alias("cell"), F.col(c).alias("text")) for c in periods])))
    # a missing cell is no number either, so it gives no row; here it is told apart from junk
    bad_cell = F.when(~F.col("text").isin(*C.NA_TOKENS) & (F.trim("text") != F.lit("")) & to_number("text").isNull(), F.lit("not a number"))
    long = unpivot_periods(sound, list(ids) + [ORDER], date_col=None)  # the date is there, and parsed
    return (long.select(*[f.name for f in S.RAW_GENERATION.fields], ORDER),
            rejects.unionByName(_row_rejects(wide.withColumns(_null_tokens(periods, C.NA_TOKENS)), bad_row))
            .unionByName(_row_rejects(cells, bad_cell, F.concat_ws("=", "cell", "text"))))


# ---------------------------------------------------------------- prices

def coerce_prices(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Raw price text (with the arrival column) -> (typed rows, rejected records): a record is
    rejected if it has too many cells or lacks a valid date, whole period, node or price."""
    df = ensure_columns(df, T.StructType([T.StructField(c, T.StringType()) for c in ("load_mw", "generation_mw", MALFORMED)]))
    df, date, unclear = with_dates(df, "trading_date")
    typed = {
        "trading_date": date,
        "trading_period": to_integral("trading_period", "smallint"),
        "node": F.col("node"),
        "price": to_number("price"),
    }
    reason = F.coalesce(_malformed(), unclear, *[F.when(e.isNull(), F.lit(f"no valid {n}")) for n, e in typed.items()])
    rows = df.where(F.col(MALFORMED).isNull()).select(
        *[e.alias(n) for n, e in typed.items()],
        to_number("load_mw").alias("load_mw"),
        to_number("generation_mw").alias("generation_mw"),
        *[c for c in df.columns if c in (ORDER, "file_name")])
    return rows.na.drop(subset=list(C.PRICE_REQUIRED)), _row_rejects(df, reason)


def read_prices(spark: SparkSession, files: DataFrame | Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Nodal price files -> (typed rows with arrival order, rejects).

    Raw headers are renamed where present, extra columns dropped, absent
    optional columns filled with null; files without a required column are
    rejected whole and the rest load, less the records listed in the rejects.
    """
    ok, rejects = split_files_by_schema(spark, _paths(files), C.PRICE_REQUIRED, rename=dict(C.PRICE_COLUMN_MAP))
    if not ok:
        return spark.createDataFrame([], _with_order(S.RAW_PRICES)), rejects
    raw = read_csv_by_header(spark, ok, lower=False)
    raw = rename_present(raw, C.PRICE_COLUMN_MAP)
    raw = select_present(raw, [f.name for f in S.RAW_PRICES.fields] + [ORDER, MALFORMED])
    typed, bad = coerce_prices(raw)
    return typed.select(*[f.name for f in S.RAW_PRICES.fields], ORDER), rejects.unionByName(bad)


# ---------------------------------------------------------------- retail

def typed_by_content(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Text columns cast to bigint or double where every value of the whole column allows it
    (one aggregate over the data; only two flags per column reach the driver)."""
    whole = {c: F.every(F.col(f"`{c}`").try_cast("bigint").isNotNull() | F.col(f"`{c}`").isNull()) for c in cols}
    real = {c: F.every(F.col(f"`{c}`").try_cast("double").isNotNull() | F.col(f"`{c}`").isNull()) for c in cols}
    held = df.agg(*[F.struct(whole[c], real[c], F.max(f"`{c}`").isNotNull()).alias(f"c{i}") for i, c in enumerate(cols)]).first()
    kinds = {c: ("bigint" if w else "double") for c, (w, r, any_value) in zip(cols, held) if any_value and r}
    return df.withColumns({c: F.col(f"`{c}`").try_cast(k) for c, k in kinds.items()}) if kinds else df


def read_retail(spark: SparkSession, path: str, glob: str = C.CSV_FILE_GLOB) -> tuple[DataFrame, DataFrame]:
    """Retail summary CSVs -> (rows as found plus `raw_filename`, rejects).

    Columns are unknown in advance and may differ per file: all are read as text by
    header, unioned by name, and typed only once over all files, so a column that is
    a number in one file and text in another is text.
    """
    accepted, rejects = split_files_by_schema(spark, _paths(list_files(spark, path, glob)), [])
    if not accepted:
        raise FileNotFoundError(f"no readable retail files under {path}")
    raw = read_csv_by_header(spark, accepted, lower=False)
    cols = [c for c in raw.columns if c not in (ORDER, MALFORMED, "file_name", "__layout")]
    rows = raw.where(F.col(MALFORMED).isNull()).select(*[F.col(f"`{c}`") for c in cols], F.col("file_name").alias("raw_filename"))
    return typed_by_content(rows, cols), rejects.unionByName(_row_rejects(raw, _malformed()))


# ---------------------------------------------------------------- weather

def _typed_weather(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Weather records as text -> (typed rows, rejects): a record is rejected without a location
    or date, or with a measure that its declared type cannot hold."""
    typed = {m: to_number(m, S.RAW_WEATHER[m].dataType.simpleString()) for m in C.WEATHER_MEASURES}
    overflow = [F.when(F.col(m).isNotNull() & to_number(m, "double").isNotNull() & e.isNull(), F.lit(f"{m} out of range"))
                for m, e in typed.items()]
    reason = F.coalesce(*([_malformed()] if MALFORMED in raw.columns else []),
                        F.when(F.coalesce(F.trim("location"), F.lit("")) == F.lit(""), F.lit("no location")),
                        F.when(to_date_lenient("time").isNull(), F.lit("no valid time")), *overflow)
    rows = raw.where(reason.isNull()).select(
        "location", to_date_lenient("time").alias("time"), *[e.alias(m) for m, e in typed.items()], ORDER)
    return rows, _row_rejects(raw, reason)


def read_weather_json(spark: SparkSession, path: str, glob: str = "*.json") -> tuple[DataFrame, DataFrame]:
    """API documents (parallel arrays under `daily`) -> (one row per location and day with
    arrival order, rejects).

    The location comes from the file name `<location>_<start>_<end>.json`, or
    from a `location=<name>` folder when documents are stored partitioned. Broken
    documents and those without a location are rejected whole.
    """
    broken = "__broken"
    docs = (spark.read.schema(T.StructType([*S.WEATHER_JSON.fields, T.StructField(broken, T.StringType())])).option("multiLine", True)
            .option("columnNameOfCorruptRecord", broken).option("pathGlobFilter", glob).json(path))
    from_name = F.regexp_extract(F.col("_metadata.file_name"), r"^(.+?)_\d{4}-\d{2}-\d{2}_\d{4}-\d{2}-\d{2}\.json$", 1)
    from_dir = F.regexp_extract(F.col("_metadata.file_path"), r"/location=([^/]+)/[^/]*$", 1)
    docs = docs.select(F.when(from_dir != F.lit(""), from_dir).otherwise(from_name).alias("location"),
                       F.col("_metadata.file_path").alias("path"), "daily", broken)
    reason = F.coalesce(F.when(F.col(broken).isNotNull() | F.col("daily.time").isNull(), F.lit("not a weather document")),
                        F.when(F.col("location") == F.lit(""), F.lit("no location in the file name")))
    rejected = docs.select("path", reason.alias("reason"), F.lit(None).cast("string").alias("record"), "daily").where(
        F.col("reason").isNotNull()).drop("daily")
    # a measure that a document lacks is null on every day (zipping a null array would drop the days)
    measures = [F.coalesce(f"daily.{m}", F.array().cast("array<double>")).alias(m) for m in C.WEATHER_MEASURES]
    series = F.arrays_zip(F.col("daily.time").alias("time"), *measures)
    days = docs.where(reason.isNull()).select("location", "path", F.posexplode(series).alias("pos", "day"))
    raw = days.select("location", *[F.col(f"day.{c}").cast("string").alias(c) for c in ("time",) + C.WEATHER_MEASURES],
                      F.struct(F.col("path").alias("f"), F.lit(0).cast("bigint").alias("b"),
                               F.col("pos").cast("bigint").alias("r")).alias(ORDER))
    rows, bad = _typed_weather(raw)
    return rows, rejected.unionByName(bad)


def read_weather_csv(spark: SparkSession, path: str, glob: str = C.CSV_FILE_GLOB) -> tuple[DataFrame, DataFrame]:
    """Exported weather CSV files (location, time, six measures) -> (rows with the declared
    types and arrival order, rejects); columns matched by name, absent measures are null."""
    groups, rejects = split_files_by_schema(spark, _paths(list_files(spark, path, glob, recursive=True)),
                                            ["location", "time"])
    if not groups:
        raise FileNotFoundError(f"no weather files with location and time under {path}")
    raw = ensure_columns(read_csv_by_header(spark, groups, lower=False),
                         T.StructType([T.StructField(m, T.StringType()) for m in C.WEATHER_MEASURES]))
    rows, bad = _typed_weather(raw.select("location", "time", *C.WEATHER_MEASURES, ORDER, MALFORMED))
    return rows, rejects.unionByName(bad)
