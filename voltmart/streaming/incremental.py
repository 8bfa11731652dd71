"""Incremental ingest of newly arrived price files with Structured Streaming.

A file-source stream picks up only files not seen before (the stream's
checkpoint remembers them, which replaces "skip files already present").
``trigger(availableNow=True)`` processes everything pending and stops, so the
same code runs as a scheduled batch.

The stream carries file paths only (a binaryFile source with the content column
pruned, so nothing is read there). Each micro-batch then loads its files with
the batch reader: headers matched by name per file (a CSV stream with a fixed
schema would map columns by position), files without the required columns go
to the rejects table, and rows are merged first-wins into the append-only price
table (within a micro-batch earlier file names and rows win; rows already in
the table beat new ones, so across micro-batches arrival order decides). A restarted query resumes from its checkpoint; a micro-batch that fails
is retried whole, and its merge is idempotent.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from .. import constants as C
from .. import schemas as S
from ..sinks.tables import load_insert_ignore
from ..sources.files import ORDER, read_prices


# The binaryFile source's fixed schema (streams must declare it); only `path` is selected.
BINARY_FILE_SCHEMA = "path string, modificationTime timestamp, length bigint, content binary"


def new_price_files(spark: SparkSession, source_dir: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Stream of newly arrived price file paths (contents are not read here)."""
    reader = (spark.readStream.format("binaryFile").schema(BINARY_FILE_SCHEMA)
              .option("pathGlobFilter", C.CSV_FILE_GLOB))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.load(source_dir).select("path")


def start_price_ingest(spark: SparkSession, source_dir: str, table_base: str,
                       checkpoint: str, available_now: bool = True,
                       rejects_path: str | None = None, max_files_per_trigger: int | None = None) -> StreamingQuery:
    """Run the incremental load; returns the StreamingQuery (await or stop it).

    `checkpoint` is the stream's own folder on shared storage, the same in every
    session: it is what remembers the files already loaded.

    A micro-batch is a bounded set of new files (``max_files_per_trigger``
    bounds it further); only their paths reach the driver, and the merge is an
    ordinary distributed batch job.
    """
    def merge(batch: DataFrame, batch_id: int) -> None:
        paths = [r["path"] for r in batch.collect()]   # file names of this micro-batch only
        if not paths:
            return
        typed, rejects = read_prices(batch.sparkSession, paths)
        if rejects_path:
            # keyed by the micro-batch, so a retry replaces its own rejects
            rejects.write.mode("overwrite").parquet(f"{rejects_path.rstrip('/')}/micro_batch={batch_id}")
        load_insert_ignore(batch.sparkSession, table_base, typed, C.PRICE_KEY, [ORDER], S.RAW_PRICES, month_of="trading_date")

    writer = (new_price_files(spark, source_dir, max_files_per_trigger).writeStream
              .foreachBatch(merge).option("checkpointLocation", checkpoint))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()
