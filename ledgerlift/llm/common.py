"""What the operators share: session settings, shared scratch tables, column picking."""

from __future__ import annotations

import functools
import re
import tempfile
import uuid
from collections.abc import Iterator
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Separators of words: space and the five ASCII controls from tab to carriage return.
WORD_PATTERN = r"[^\x20\x09-\x0D]+"
#: Bytes of a text that are split into words at once.
PIECE = 1 << 20
_GAP = re.compile(rb"[\x20\x09-\x0D]")
#: Texts that go to a Python worker at once, by rows and by bytes.
ARROW_ROWS, ARROW_BYTES = 512, 8 << 20
#: How tables of rows of several MB are written: a writer holds few of them, and a reader those of one row group.
HEAVY_ROWS = {"parquet.block.size": str(16 << 20), "parquet.page.size.row.check.min": "1"}
#: Rows that one window of running totals holds.
CELLS = 1 << 13


def prepared(spark: SparkSession, rows: int = ARROW_ROWS) -> SparkSession:
    """A session of the operators' own beside `spark`: its settings, with bounded Arrow batches.

    Long texts then don't meet in one Python worker's memory, and the caller's settings stay as they
    are.  Workers also look for this package where the driver found it, whatever folder they start in.
    """
    root, known = str(Path(__file__).resolve().parents[2]), spark.sparkContext.environment
    paths = [p for p in known.get("PYTHONPATH", "").split(":") if p]
    if root not in paths:
        known["PYTHONPATH"] = ":".join([*paths, root])
    session = spark.newSession()
    theirs, mine = dict(spark.conf.getAll), dict(session.conf.getAll)
    wanted = theirs | {
        "spark.sql.execution.arrow.maxRecordsPerBatch": str(rows),
        "spark.sql.execution.arrow.maxBytesPerBatch": str(ARROW_BYTES),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
    }
    for key, value in wanted.items():
        if mine.get(key) != value and session.conf.isModifiable(key):
            session.conf.set(key, value)
    return session


def adopted(df: DataFrame, rows: int = ARROW_ROWS) -> DataFrame:
    """`df` in a session of the operators' own, handed over as a global view that is dropped at once."""
    name = f"llm_{uuid.uuid4().hex}"
    df.createGlobalTempView(name)
    try:
        database = df.sparkSession.conf.get("spark.sql.globalTempDatabase", "global_temp")
        return prepared(df.sparkSession, rows).table(f"{database}.{name}")
    finally:
        df.sparkSession.catalog.dropGlobalTempView(name)


@functools.cache
def _own_folder(application: str) -> str:
    return tempfile.mkdtemp(prefix="llm-scratch-")


def shared_folder(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``; a temporary one only for a local session that names none."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named is None:
        if spark.sparkContext.master.split("[")[0] != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        named = _own_folder(spark.sparkContext.applicationId)
    return named.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/llm-{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str, options: dict[str, str] | None = None) -> DataFrame:
    """`df` as a Parquet table in the shared folder, read again: lineage ends there and lost executors cost nothing."""
    path = scratch_path(df.sparkSession, name)
    df.write.options(compression="zstd", **(options or {})).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def shuffles_dropped(spark: SparkSession) -> None:
    """Spark deletes the shuffle files of steps that are over when the driver collects its garbage: it does so now."""
    spark.sparkContext._jvm.System.gc()


def whole_row(df: DataFrame) -> Column:
    """All columns of `df` as one struct: whatever their names, they clash with none of an operator's own."""
    return F.struct(*[F.col(f"`{c}`") for c in df.columns])


def row_hash(df: DataFrame) -> Column:
    """A hash of all columns of `df` that can be hashed: maps can't."""
    return F.xxhash64(*[F.col(f"`{f.name}`") for f in df.schema.fields if "map<" not in f.dataType.simpleString()])


def free_name(df: DataFrame, name: str) -> str:
    """`name`, or one like it, that no column of `df` has."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def pieces(text: bytes) -> Iterator[list[bytes]]:
    """The words of a text, some at a time; bytes are split at the space and at tab to carriage return alone."""
    at = 0
    while at < len(text):
        gap = _GAP.search(text, at + PIECE)
        end = gap.start() if gap else len(text)
        yield text[at:end].split()
        at = end


def word_count(text: Column) -> Column:
    """Number of words; 0 for a null text."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD_PATTERN)), F.lit(0)).cast("long")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prepared(spark).read.parquet(f"{sf_dir}/documents.parquet")


def running_bases(cells: DataFrame, keys: list[str], cell: str, value: str) -> DataFrame:
    """Adds ``base``, the sum of `value` over the smaller cells of the same keys; no window holds over CELLS cells."""
    outer = F.floor(F.col(cell) / CELLS).alias("outer")
    cells = cells.withColumn("outer", outer)
    sums = cells.groupBy(*keys, "outer").agg(F.sum(value).alias("outer_sum"))
    before = F.sum("outer_sum").over(Window.partitionBy(*keys).orderBy("outer")) - F.col("outer_sum")
    within = F.sum(value).over(Window.partitionBy(*keys, "outer").orderBy(cell)) - F.col(value)
    based = cells.withColumn("within", within).join(sums.withColumn("before", before), [*keys, "outer"])
    return based.withColumn("base", F.col("before") + F.col("within")).drop("outer", "outer_sum", "before", "within")
