"""Session settings the library expects, and the one place that cuts lineage."""

from __future__ import annotations

import functools
import tempfile
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

#: Settings that keep wide joins safe under skew and let AQE pick partition counts.
RECOMMENDED = {
    "spark.sql.session.timeZone": "UTC",
    # Recording a call site per column expression dominates the planning of wide imports.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    # The JVM never compiles methods beyond 8000 bytes of bytecode.  Below this limit Spark
    # falls back to projections split into small methods, which wide cleaning steps need.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A split hot key is worth one extra exchange further up the plan.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


def build_session(app_name: str = "ledgerlift", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**RECOMMENDED, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def configure(spark: SparkSession) -> SparkSession:
    """Apply the recommended settings to a session somebody else built."""
    for key, value in RECOMMENDED.items():
        if spark.conf.isModifiable(key):
            spark.conf.set(key, value)
    return spark


def fixed_rows(spark: SparkSession, name: str, values: Sequence[str]) -> DataFrame:
    """A short list of texts as one column; the planner knows it is small."""
    return spark.sql(f"SELECT explode(:values) AS `{name}`", {"values": list(values)})


def empty_table(spark: SparkSession, schema: str) -> DataFrame:
    """A table without rows; the optimizer removes joins with it."""
    nulls = ", ".join(f"CAST(NULL AS {f.dataType.simpleString()}) AS `{f.name}`" for f in StructType.fromDDL(schema).fields)
    return spark.sql(f"SELECT {nulls} LIMIT 0")


@functools.cache
def _local_folder(application: str) -> str:
    return tempfile.mkdtemp(prefix="ledgerlift-")


def scratch_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder under ``spark.checkpoint.dir``; a temporary one only for a local session that names none."""
    shared = spark.sparkContext.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if shared is None:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        shared = _local_folder(spark.sparkContext.applicationId)
    return f"{shared.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """`df` as a table in a fresh folder, read again: what follows neither repeats it nor depends on its executors."""
    path = scratch_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Checkpoint `df` to the reliable folder that ``spark.checkpoint.dir`` names.

    There is no default: a folder that only one machine sees would lose the cut with it.
    """
    spark = df.sparkSession
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        configured = spark.conf.get("spark.checkpoint.dir", None)
        if configured is None:
            raise RuntimeError("set spark.checkpoint.dir to a shared folder before cutting lineage")
        context.setCheckpointDir(configured)
    return df.checkpoint(eager=True)
