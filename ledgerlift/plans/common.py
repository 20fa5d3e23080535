"""Steps every import shares."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlift.functions.text import blank_to_null, key_text
from ledgerlift.operators.joins import lookup
from ledgerlift.operators.merge import INCOMING, KEEP, OVERWRITE, Policy
from ledgerlift.operators.provision import assign_role, ensure_users, role_named
from ledgerlift.plans import tables as t
from ledgerlift.sources.grid import ROW, normalise_headers, with_position
from ledgerlift.sources.store import Deferred, Workspace

#: time written to the audit columns
Moment = Column | str | None

AUDIT_POLICY: dict[str, Policy] = {"created_at": KEEP, "updated_at": OVERWRITE}


def prepared(feed: DataFrame) -> DataFrame:
    """Feed with normalised headers and the place of each row, unless it comes with one."""
    placed = feed if ROW in feed.columns else with_position(feed)
    return normalise_headers(placed)


def moment(as_of: Moment) -> Column:
    """Time of the import: now, unless the caller fixes it."""
    if as_of is None:
        return F.current_timestamp()
    return (F.lit(as_of) if isinstance(as_of, str) else as_of).cast("timestamp")


def stamped(df: DataFrame, as_of: Moment) -> DataFrame:
    return df.withColumns({"created_at": moment(as_of), "updated_at": moment(as_of)})


def upsert(
    ws: Workspace,
    name: str,
    schema: str,
    source: Callable[[], DataFrame],
    keys: Sequence[str] = ("id",),
    policy: Mapping[str, Policy] | None = None,
    default: Policy = INCOMING,
    mode: str = "upsert",
    **options,
) -> Deferred:
    """Merge de-duplicated rows into a table of the workspace."""
    rules = {**AUDIT_POLICY, **({} if "id" in keys else {"id": KEEP}), **(policy or {})}
    options = {"unique_source": True} | options
    return ws.upsert(name, schema, source, keys, policy=rules, default=default, mode=mode, **options)


def with_application(stage: DataFrame, applications: DataFrame, number: str = "application_number") -> DataFrame:
    """Add ``application_id``; rows without a number match nothing, not each other."""
    return lookup(
        stage, applications, number, "application_number", {"application_id": "id"}, normalise=blank_to_null, unique=True
    )


def with_sector_detail(stage: DataFrame, details: DataFrame) -> DataFrame:
    """Add the first sector detail of the application."""
    take = {"application_sector_detail_id": "id"}
    return lookup(stage, details, "application_id", "application_id", take, normalise=None)


def with_installation(stage: DataFrame, installations: DataFrame, extra: Mapping[str, str] | None = None) -> DataFrame:
    take = {"application_electrical_installation_id": "id", **(extra or {})}
    return lookup(stage, installations, "application_id", "application_id", take, normalise=None)


def provision_users(ws: Workspace, stage: Callable[[], DataFrame], username: str, default_role: str | None, as_of: Moment) -> None:
    """Create staged users that do not exist and give all staged users the default role."""
    defaults = {
        "status": F.lit("ACTIVE"),
        "user_category": F.lit("EXTERNAL"),
        "account_type": F.lit("INDIVIDUAL"),
        "auth_mode": F.lit("DB"),
        "failed_attempts": F.lit(0),
        "is_first_login": F.lit(False),
        "deleted": F.lit(False),
        "created_at": moment(as_of),
        "updated_at": moment(as_of),
    }

    def staged() -> DataFrame:
        return stage().select(F.col(username).alias("username"))

    def ensured(known: DataFrame, names: DataFrame) -> DataFrame:
        return ensure_users(known, names, defaults=defaults)

    users = ws.provide("users", t.USERS, staged, ["username"], ensured, fold={"username": key_text})
    if default_role is None:
        return
    roles = ws.table("roles", t.ROLES)

    def members() -> DataFrame:
        names = staged().select(F.lower(F.trim("username")).alias("__staged")).filter("__staged <> ''").distinct()
        found = users().join(names, F.lower(F.trim("username")) == F.col("__staged"), "left_semi")
        return found.select(F.col("id").alias("user_id"))

    def assigned(held: DataFrame, found: DataFrame) -> DataFrame:
        return assign_role(held, found, role_named(roles(), default_role), "user_id")

    ws.provide("user_roles", t.USER_ROLES, members, ["user_id"], assigned)
