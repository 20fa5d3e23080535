"""Members that must exist before rows can refer to them: categories, users, roles."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlift.functions.enums import sector_of
from ledgerlift.functions.keys import stable_key
from ledgerlift.functions.predicates import search
from ledgerlift.functions.text import ColumnOrName, col, key_text
from ledgerlift.operators.joins import lacking, lookup
from ledgerlift.operators.merge import ACTION
from ledgerlift.operators.profile import count_by_parent


def distinct_names(df: DataFrame, name: ColumnOrName) -> DataFrame:
    """(key, name): non-blank names, one spelling per normalised key."""
    rows = df.select(key_text(name).alias("key"), F.trim(col(name)).alias("name")).filter(F.col("key").isNotNull())
    return rows.groupBy("key").agg(F.min("name").alias("name"))


def ensure_members(
    dim: DataFrame,
    names: DataFrame,
    defaults: Mapping[str, Column],
    prefix: str,
    name: str = "name",
    id_col: str = "id",
    extra: Sequence[str] = (),
) -> DataFrame:
    """`dim` plus a row for every name it lacks, with ``_action`` keep or insert.

    `names` has a `name` column and, optionally, the `extra` columns to copy.  Ids of new
    rows derive from the normalised name, so concurrent or repeated runs agree on them.
    """
    kind = names.select(key_text(name).alias("__key"), F.struct(F.trim(F.col(name)).alias(name), *extra).alias("__v"))
    wanted = kind.filter(F.col("__key").isNotNull()).groupBy("__key").agg(F.min("__v").alias("__v"))
    known = dim.select(key_text(name).alias("__known"))
    fresh = lacking(wanted, known, [("__key", "__known")])
    values = {id_col: stable_key(F.lit(prefix), F.col("__key")), name: F.col(f"__v.{name}")}
    values |= {c: F.col(f"__v.{c}") for c in extra} | dict(defaults)
    columns = []
    for field in dim.schema.fields:
        value = values.get(field.name, F.lit(None))
        columns.append(value.cast(field.dataType).alias(field.name))
    added = fresh.select(*columns, F.lit("insert").alias(ACTION))
    return dim.withColumn(ACTION, F.lit("keep")).unionByName(added)


def members_with_sector(names: DataFrame, sectors: DataFrame, name: str = "name", fallback: str | None = None) -> DataFrame:
    """Names with the id of the sector their wording points to (`sectors`: id, name)."""
    guessed = names.withColumn("__sector", sector_of(name, None if fallback is None else F.lit(fallback)))
    return lookup(guessed, sectors, "__sector", "name", {"sector_id": "id"}).drop("__sector")


def ensure_users(users: DataFrame, names: DataFrame, username: str = "username", defaults: Mapping[str, Column] | None = None) -> DataFrame:
    """`users` plus a row for every staged user name not yet there (case and blanks ignored)."""
    wanted = distinct_names(names, username).select(F.col("key").alias("__key"))
    fresh = lacking(wanted, users.select(key_text(username).alias("__known")), [("__key", "__known")])
    values = {"id": stable_key(F.lit("user"), F.col("__key")), username: F.col("__key"), "full_name": F.col("__key")}
    values |= dict(defaults or {})
    columns = [values.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in users.schema.fields]
    return users.withColumn(ACTION, F.lit("keep")).unionByName(fresh.select(*columns, F.lit("insert").alias(ACTION)))


def provision_counts(provisioned: DataFrame, names: DataFrame, name: ColumnOrName) -> DataFrame:
    """One row: distinct names asked for, inserted, and already there."""
    asked = names.agg(F.countDistinct(key_text(name)).alias("requested"))
    added = provisioned.agg(F.count_if(F.col(ACTION) == "insert").alias("inserted"))
    return asked.crossJoin(F.broadcast(added)).withColumn("skipped", F.col("requested") - F.col("inserted"))


def assign_role(user_roles: DataFrame, users: DataFrame, role: DataFrame, user_id: str = "id") -> DataFrame:
    """Give every user of `users` the single role in `role` (column ``role_id``) they lack."""
    # An aggregate without groups has exactly one row, so this broadcast is bounded.
    one = role.agg(F.min("role_id").alias("role_id")).filter(F.col("role_id").isNotNull())
    wanted = users.select(F.col(user_id).alias("user_id")).distinct().crossJoin(F.broadcast(one))
    fresh = lacking(wanted, user_roles, [("user_id", "user_id"), ("role_id", "role_id")])
    return user_roles.select("user_id", "role_id", F.lit("keep").alias(ACTION)).unionByName(
        fresh.select("user_id", "role_id", F.lit("insert").alias(ACTION))
    )


def holders(user_roles: DataFrame, role: DataFrame) -> DataFrame:
    """Users (column ``id``) that hold the given role."""
    return user_roles.join(role.select("role_id").distinct(), "role_id", "left_semi").select(F.col("user_id").alias("id"))


def role_named(roles: DataFrame, name: str) -> DataFrame:
    """The role of that name; never simply the first row of the table."""
    return roles.filter(key_text("name") == name.strip().lower()).agg(F.min("id").alias("role_id")).filter(
        F.col("role_id").isNotNull()
    )


def category_options(categories: DataFrame, sectors: DataFrame, text: str | None = None, sector: str | None = None, include_deleted: bool = False) -> DataFrame:
    rows = categories if include_deleted else categories.filter(F.col("deleted_at").isNull())
    rows = lookup(rows, sectors, "sector_id", "id", {"sector_name": "name"}, normalise=None)
    rows = search(rows, name=text, sector_name=sector)
    return rows.orderBy(F.col("sector_name").asc_nulls_last(), F.col("name").asc_nulls_last(), F.col("id").asc_nulls_last())


def role_options(roles: DataFrame, user_roles: DataFrame, text: str | None = None) -> DataFrame:
    counted = count_by_parent(search(roles, name=text), user_roles, "id", "role_id", "user_count")
    return counted.orderBy(F.col("name").asc_nulls_last(), F.col("id").asc_nulls_last())
