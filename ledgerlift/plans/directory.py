"""Categories by name and sector; users with roles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlift.functions import clean, joined, key_text, stable_key, upper_or
from ledgerlift.functions import fixed_values as fixed
from ledgerlift.operators.dedupe import keep_first, keep_last_upload
from ledgerlift.operators.joins import lacking, lookup
from ledgerlift.operators.merge import ACTION, KEEP, OVERWRITE
from ledgerlift.operators.provision import ensure_members
from ledgerlift.plans import tables as t
from ledgerlift.plans.common import Moment, moment, prepared, stamped, upsert
from ledgerlift.sources.grid import ROW, require
from ledgerlift.sources.store import Workspace

USER_COLUMNS = (
    "firstname",
    "lastname",
    "username",
    "password",
    "status",
    "mobilenumber",
    "emailid",
    "user_category",
    "account_type",
    "auth_mode",
    "role",
)


def import_categories(ws: Workspace, feed: DataFrame, as_of: Moment = None) -> Workspace:
    feed = require(prepared(feed), ["category_name", "sector_name"])
    named = feed.select(ROW, clean("category_name").alias("name"), clean("sector_name").alias("sector_name"))
    sectors, known = ws.table("sectors", t.SECTORS), ws.table("categories", t.CATEGORIES)
    present = named.filter(F.col("name").isNotNull())
    rows = ws.hold("categories", lambda: lookup(present, sectors(), "sector_name", "name", {"sector_id": "id"}))
    defaults = {"is_approved": F.lit(True), "category_type": F.lit("License"), "created_at": moment(as_of), "updated_at": moment(as_of)}

    def build() -> DataFrame:
        placed = keep_first(rows().filter(F.col("sector_id").isNotNull()), [key_text("name")], [F.col(ROW).asc_nulls_last()])
        return ensure_members(known(), placed, defaults, "category", extra=("sector_id",))

    ws.put("categories", build)
    return ws


def category_upload_report(ws: Workspace) -> DataFrame:
    """One row: processed, inserted, skipped because it exists, skipped without sector."""
    staged = ws.staged["categories"].agg(
        F.count(F.lit(1)).alias("processed"), F.count_if(F.col("sector_id").isNull()).alias("skipped_no_sector")
    )
    added = ws.merged["categories"].agg(F.count_if(F.col(ACTION) == "insert").alias("inserted"))
    both = staged.crossJoin(F.broadcast(added))
    return both.withColumn("skipped_existing", F.col("processed") - F.col("skipped_no_sector") - F.col("inserted"))


def import_users(ws: Workspace, feed: DataFrame, skip_existing: bool = False, keep_password: bool = False, as_of: Moment = None) -> Workspace:
    """Users, their roles and the assignment; the last upload of a user name counts.

    A user name is the same whatever its case and blanks: for the last upload, for matching a
    known user, for the id and for the roles.  Passwords are dropped unless the caller opts in.
    """
    feed = require(prepared(feed), USER_COLUMNS)
    kept = [c for c in USER_COLUMNS if keep_password or c != "password"]
    cleaned = feed.select(ROW, *[clean(c, "user").alias(c) for c in kept]).filter(F.col("username").isNotNull())
    rows = ws.hold("users", lambda: cleaned)
    known, held = ws.table("roles", t.ROLES), ws.table("user_roles", t.USER_ROLES)
    defaults = {"deleted": F.lit(False), "active": F.lit(True), "created_at": moment(as_of), "updated_at": moment(as_of)}
    roles = ws.put("roles", lambda: ensure_members(known(), rows().select(F.upper("role").alias("name")), defaults, "role"))
    policy = {c: KEEP for c in ("failed_attempts", "is_first_login", "deleted")}
    if not keep_password:
        policy["password_hash"] = KEEP
    users = upsert(
        ws,
        "users",
        t.USERS,
        lambda: stamped(user_rows(rows(), keep_password), as_of),
        keys=["username"],
        policy=policy,
        default=OVERWRITE,
        mode="insert" if skip_existing else "upsert",
        fold={"username": key_text},
    )
    ws.put("user_roles", lambda: role_assignments(held(), rows(), users(), roles()))
    return ws


def user_rows(rows: DataFrame, keep_password: bool) -> DataFrame:
    return keep_last_upload(rows, [key_text("username")], ROW).select(
        stable_key(F.lit("user"), key_text("username")).alias("id"),
        joined("firstname", "lastname").alias("full_name"),
        "username",
        (F.col("password") if keep_password else F.lit(None).cast("string")).alias("password_hash"),
        upper_or("status", fixed.USER_DEFAULTS["status"]).alias("status"),
        F.col("mobilenumber").alias("phone_number"),
        F.col("emailid").alias("email_address"),
        upper_or("user_category", fixed.USER_DEFAULTS["user_category"]).alias("user_category"),
        upper_or("account_type", fixed.USER_DEFAULTS["account_type"]).alias("account_type"),
        upper_or("auth_mode", fixed.USER_DEFAULTS["auth_mode"]).alias("auth_mode"),
        F.lit(0).alias("failed_attempts"),
        F.lit(False).alias("is_first_login"),
        F.lit(False).alias("deleted"),
    )


def role_assignments(user_roles: DataFrame, rows: DataFrame, users: DataFrame, roles: DataFrame) -> DataFrame:
    """Distinct (user, role) pairs of the feed that are not assigned yet, added."""
    asked = rows.select(key_text("username").alias("__user"), key_text("role").alias("__role")).distinct()
    known = users.select(key_text("username").alias("__known"), F.col("id").alias("user_id"))
    pairs = asked.join(known, F.col("__user") == F.col("__known"))
    pairs = lookup(pairs, roles, "__role", "name", {"role_id": "id"}).filter(F.col("role_id").isNotNull())
    fresh = lacking(pairs.select("user_id", "role_id").distinct(), user_roles, [("user_id", "user_id"), ("role_id", "role_id")])
    return user_roles.select("user_id", "role_id", F.lit("keep").alias(ACTION)).unionByName(
        fresh.select("user_id", "role_id", F.lit("insert").alias(ACTION))
    )
