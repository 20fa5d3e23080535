"""Migration of a wide legacy table into the hub and a document table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlift.functions.keys import stable_key
from ledgerlift.functions.text import clean
from ledgerlift.operators.reshape import detect_pairs


def migrate_wide(source: DataFrame, hub_columns: Sequence[str], key: str) -> tuple[DataFrame, DataFrame]:
    """(hub rows, document rows) of a wide table whose ``*filename`` columns hold attachments.

    Hub rows carry the columns both tables have.  Unlike the importers, a pair with only a
    file name or only an id is a document here.
    """
    pairs = detect_pairs(source.columns)
    attachment = {c for p in pairs for c in (p.id_col, p.file_col) if c}
    shared = [c for c in source.columns if c in set(hub_columns) and c not in attachment and c != "id"]
    rows = source.withColumn("__id", stable_key(F.lit("legacy"), F.col(key)))
    hub = rows.select(F.col("__id").alias("id"), *shared)
    if not pairs:
        return hub, rows.limit(0).select(
            F.lit("").alias("id"), F.lit("").alias("application_id"), F.lit("").alias("document_name"),
            F.lit("").alias("file_name"), F.lit(0).alias("documents_order"), F.lit(0).cast("bigint").alias("logic_doc_id"),
        )
    cells = F.array(
        *[
            F.struct(
                F.lit(p.file_col[: -len("filename")]).alias("base"),
                F.col(p.file_col).cast("string").alias("file"),
                (F.col(p.id_col).cast("string") if p.id_col else F.lit(None).cast("string")).alias("id"),
            )
            for p in pairs
        ]
    )
    cleaned = F.transform(
        cells, lambda x: F.struct(x["base"].alias("base"), clean(x["file"], "user").alias("file"), clean(x["id"], "user").alias("id"))
    )
    kept = F.filter(cleaned, lambda x: x["file"].isNotNull() | x["id"].isNotNull())
    long = rows.select("__id", F.posexplode(kept).alias("__i", "x"))
    documents = long.select(
        stable_key(F.col("__id"), F.lit("doc"), F.col("x.base")).alias("id"),
        F.col("__id").alias("application_id"),
        F.coalesce("x.file", F.lit("")).alias("document_name"),
        F.col("x.base").alias("file_name"),
        (F.col("__i") + 1).alias("documents_order"),
        F.col("x.id").try_cast("decimal(38,6)").try_cast("bigint").alias("logic_doc_id"),
    )
    return hub, documents


def preview_wide(source: DataFrame, hub_columns: Sequence[str], key: str) -> DataFrame:
    hub, documents = migrate_wide(source, hub_columns, key)
    apps = hub.agg(F.count(F.lit(1)).alias("applications"))
    docs = documents.agg(F.count(F.lit(1)).alias("documents"))
    return apps.crossJoin(F.broadcast(docs))
