"""Ownership transfer for a set of applications, with a snapshot to go back.

A transfer is a mapping table (application_id, new_user_id, new_username) joined to every
affected table, so moving one application or ten million is the same job.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlift.operators.joins import lookup
from ledgerlift.session import written

SNAPSHOT = ("table_name", "row_id", "application_id", "old_created_by", "old_username", "old_owner_id")


@dataclass(frozen=True)
class OwnedTable:
    """Which columns of a table say who owns a row."""

    application: str = "application_id"
    row_id: str = "id"
    created_by: str | None = "created_by"
    username: str | None = None
    owner_id: str | None = None
    #: child rows without an owner stay without one
    only_owned: bool = True


HUB = OwnedTable(application="id", username="username", only_owned=False)
CERTIFICATE = OwnedTable(owner_id="owner_id", only_owned=False)
CHILD = OwnedTable()


def resolve_mapping(requests: DataFrame, applications: DataFrame, users: DataFrame) -> DataFrame:
    """(application_number, new_username) requests to ids; requests that do not resolve drop out."""
    apps = applications.select(F.col("id").alias("application_id"), "application_number")
    live = users if "deleted" not in users.columns else users.filter(~F.coalesce("deleted", F.lit(False)))
    people = live.groupBy(F.lower(F.trim("username")).alias("__name")).agg(F.min(F.struct(F.col("id"), F.col("username"))).alias("__u"))
    joined = requests.join(apps, "application_number").join(people, F.lower(F.trim("new_username")) == F.col("__name"))
    return joined.groupBy("application_id").agg(F.min("__u").alias("__u")).select(
        "application_id", F.col("__u.id").alias("new_user_id"), F.col("__u.username").alias("new_username")
    )


def _affected(df: DataFrame, kind: OwnedTable, mapping: DataFrame, how: str) -> DataFrame:
    renamed = mapping.withColumnRenamed("application_id", "__aid")
    if how == "inner":
        joined = df.join(renamed, F.col(kind.application) == F.col("__aid"), how)
    else:
        # Rows without an application are spread: they match nothing.
        take = {c: c for c in renamed.columns}
        joined = lookup(df, renamed, kind.application, "__aid", take, normalise=None, unique=True)
    if kind.only_owned and kind.created_by:
        return joined.withColumn("__hit", F.col("__aid").isNotNull() & F.col(kind.created_by).isNotNull())
    return joined.withColumn("__hit", F.col("__aid").isNotNull())


def preview_transfer(tables: Mapping[str, tuple[DataFrame, OwnedTable]], mapping: DataFrame) -> DataFrame:
    """Rows that would move, by table; the mapping is resolved once, into a table."""
    mapping = written(mapping, "transfer-mapping")
    counts = [
        _affected(df, kind, mapping, "inner").agg(F.count_if("__hit").alias("rows")).select(F.lit(name).alias("table_name"), "rows")
        for name, (df, kind) in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts)


def transfer_snapshot(tables: Mapping[str, tuple[DataFrame, OwnedTable]], mapping: DataFrame) -> DataFrame:
    """One row per affected row with its previous owner; the mapping is resolved once, into a table."""
    return _snapshot(tables, written(mapping, "transfer-mapping"))


def _snapshot(tables: Mapping[str, tuple[DataFrame, OwnedTable]], mapping: DataFrame) -> DataFrame:
    parts = []
    for name, (df, kind) in tables.items():
        rows = _affected(df, kind, mapping, "inner").filter("__hit")
        old = [
            (F.col(c).cast("string") if c else F.lit(None).cast("string")) for c in (kind.created_by, kind.username, kind.owner_id)
        ]
        values = [F.lit(name), F.col(kind.row_id).cast("string"), F.col("__aid").cast("string"), *old]
        parts.append(rows.select(*[v.alias(n) for v, n in zip(values, SNAPSHOT)]))
    return reduce(DataFrame.unionByName, parts)


def transfer(tables: Mapping[str, tuple[DataFrame, OwnedTable]], mapping: DataFrame) -> tuple[dict[str, DataFrame], DataFrame]:
    """(tables after the transfer, snapshot).

    The mapping is resolved once, into a table that all others are joined with, and the snapshot is
    a table before any of them changes.
    """
    mapping = written(mapping, "transfer-mapping")
    snapshot = written(_snapshot(tables, mapping), "transfer-snapshot")
    moved = {}
    for name, (df, kind) in tables.items():
        joined = _affected(df, kind, mapping, "left")
        new = {kind.created_by: "new_user_id", kind.owner_id: "new_user_id", kind.username: "new_username"}
        moved[name] = joined.select(
            *[
                F.when(F.col("__hit"), F.col(new[c]).cast(df.schema[c].dataType)).otherwise(F.col(c)).alias(c) if c in new else F.col(c)
                for c in df.columns
            ]
        )
    return moved, snapshot


def restore(tables: Mapping[str, tuple[DataFrame, OwnedTable]], snapshot: DataFrame) -> dict[str, DataFrame]:
    """Tables with the owners recorded in the snapshot put back."""
    restored = {}
    for name, (df, kind) in tables.items():
        old = snapshot.filter(F.col("table_name") == name).select("row_id", *SNAPSHOT[3:])
        take = {c: c for c in old.columns}
        joined = lookup(df, old, F.col(kind.row_id).cast("string"), "row_id", take, normalise=None, unique=True)
        back = {kind.created_by: "old_created_by", kind.username: "old_username", kind.owner_id: "old_owner_id"}
        restored[name] = joined.select(
            *[
                F.when(F.col("row_id").isNotNull(), F.col(back[c]).cast(df.schema[c].dataType)).otherwise(F.col(c)).alias(c)
                if c in back
                else F.col(c)
                for c in df.columns
            ]
        )
    return restored


def discard_snapshot(snapshot: DataFrame, restored: DataFrame) -> DataFrame:
    """Snapshot without the applications just restored (`restored`: application_id)."""
    done = restored.select(F.col("application_id").cast("string").alias("__a")).distinct()
    return snapshot.join(done, F.col("application_id") == F.col("__a"), "left_anti")
