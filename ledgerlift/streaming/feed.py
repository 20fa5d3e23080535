"""Files that arrive over time, merged with the same plans as a one-off import.

The stream only discovers new files and hands each micro-batch to a plan.  Keys derive from
content, so a batch replayed after a failure converges to the same tables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ledgerlift.operators import latest
from ledgerlift.sources.records import ROW, cells, records
from ledgerlift.sources.store import TableStore, Workspace


def incremental_import(
    spark: SparkSession,
    landing: str,
    columns: list[str],
    store: TableStore,
    plan: Callable[[Workspace, DataFrame], object],
    checkpoint: str,
    glob: str | None = None,
    max_files: int | None = None,
) -> StreamingQuery:
    """Run `plan` for the CSV files of `landing` not seen before, then stop.

    Every column is read as text and found by its name in the header of its own file, so files may
    order and choose columns differently; a column that a file lacks is NULL, a file that has none
    of them fails.  Quoted cells may hold separators and line breaks, as many as they like.  `glob`
    restricts the file names.  Rows of a batch are ordered by arrival time of their file, then by
    position in it.
    """
    reader = spark.readStream.format("text").option("lineSep", "\n")
    if glob is not None:
        reader = reader.option("pathGlobFilter", glob)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    lines = reader.load(landing).select("value", F.col("_metadata.file_modification_time").alias("time"), F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"))

    def merge(batch: DataFrame, batch_id: int) -> None:
        plan(Workspace(store=store), by_header(batch, columns))

    writer = lines.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint)
    return writer.trigger(availableNow=True).start()


def latest_import(
    spark: SparkSession,
    landing: str,
    columns: list[str],
    keys: list[str],
    store: TableStore,
    table: str,
    checkpoint: str,
    **options,
) -> StreamingQuery:
    """Keep for each key the last value that any file gave each column, by the time of the files.

    Late and replayed files, and files in any batches, end in the same table: it holds registers, which
    `operators.latest.values` shows as rows.  Of one file the last row counts.
    """
    rest = [c for c in columns if c not in keys]

    def plan(_: Workspace, batch: DataFrame) -> None:
        last = latest.registers(batch, keys, rest, ROW)
        # The place inside a file decided among its own rows; between files only their times do.
        by_file = last.select(*keys, *[F.when(F.col(c).isNotNull(), F.struct(F.col(f"{c}.place.file").alias("place"), F.col(f"{c}.value").alias("value"))).alias(c) for c in rest])
        store.merge(table, by_file, keys, combine=lambda old, new: latest.combined(old, new, keys))

    return incremental_import(spark, landing, columns, store, plan, checkpoint, **options)


def by_header(batch: DataFrame, columns: list[str]) -> DataFrame:
    """The records below each file's first one, which names the cells; `batch` has its lines (value, time, file, block)."""
    # The arrival time goes into the name of the file, so that places order rows by it.
    arrived = F.concat_ws("|", F.date_format("time", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), "file")
    lines = batch.select(arrived.alias("file"), "block", F.monotonically_increasing_id().alias("at"), "value")
    placed = records(lines).select(F.col(f"{ROW}.file").alias("__file"), ROW, cells(F.col("value")).alias("__cells"))
    names = F.transform("__cells", lambda c: F.regexp_replace(F.lower(F.trim(c)), "[ /]", "_"))
    headers = placed.groupBy("__file").agg(F.min_by(names, ROW).alias("__names"), F.min(ROW).alias("__header"))
    found = F.arrays_overlap("__names", F.array(*map(F.lit, columns)))
    headers = headers.withColumn("__names", F.when(F.coalesce(found, F.lit(False)), F.col("__names")).otherwise(F.raise_error(F.concat(F.lit("no known column in "), F.col("__file")))))
    below = placed.join(headers, "__file").filter(F.col(ROW) > F.col("__header"))
    place = lambda c: F.coalesce(F.array_position("__names", c), F.lit(0)).cast("int")
    return below.select(ROW, *[F.when(place(c) > 0, F.get("__cells", place(c) - 1)).alias(c) for c in columns])
