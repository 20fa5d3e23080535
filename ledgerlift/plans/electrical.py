"""Electrical installation licences: hub, certificates, installation and its children."""

from __future__ import annotations

import functools
from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlift.functions import (
    cast_or,
    class_code,
    clean,
    experience_type,
    first_present,
    installation_type,
    int_text,
    nationality,
    parse_date,
    stable_key,
)
from ledgerlift.functions import fixed_values as fixed
from ledgerlift.operators.backfill import ChangeSet, backfill
from ledgerlift.operators.joins import either_key, lookup, replace_ids
from ledgerlift.operators.merge import EXISTING, KEEP, OVERWRITE, constant
from ledgerlift.operators.provision import ensure_members
from ledgerlift.plans import tables as t
from ledgerlift.plans.applications import first_per_number, resolved_id
from ledgerlift.plans.common import Moment, moment, prepared, provision_users, stamped, upsert
from ledgerlift.session import fixed_rows
from ledgerlift.sources.dimensions import id_key
from ledgerlift.sources.grid import ROW, require
from ledgerlift.sources.store import Workspace

OPTIONAL = (
    "application_type",
    "district",
    "email",
    "facility_name",
    "mobile_no",
    "plot_no",
    "po_box",
    "region",
    "ward",
    "license_category_id",
    "company_name",
    "license_type",
    "licensecategoryclass",
    "completed_at",
    "effective_date",
    "expire_date",
    "approval_no",
    "approvedclass",
    "parent_application_id",
    "created_at",
    "created_by",
    "dateofbirth",
    "nationality",
    "employmentstatus",
    "gender",
    "userid",
    "iftanzanian",
    "iftanzanianfilename",
    "workpermitno",
    "cpphoto",
    "cpphotofilename",
)


def _day(c: str) -> Column:
    return parse_date(c, fixed.DATES_PLAIN, dialect=None)


def stage(feed: DataFrame, locations: Mapping[str, DataFrame] | None = None, zones: DataFrame | None = None) -> DataFrame:
    feed = require(feed, ["application_number"], OPTIONAL)
    # Two projections: each cell is cleaned once, however often its typing refers to it.
    cleaned = feed.select(ROW, *[clean(c).alias(c) for c in ("application_number", *OPTIONAL)])
    rows = cleaned.select(
        ROW,
        "application_number",
        installation_type("application_type").alias("application_type"),
        "approval_no",
        "licensecategoryclass",
        "approvedclass",
        _day("effective_date").alias("effective_date"),
        _day("expire_date").alias("expire_date"),
        _day("completed_at").alias("completed_at"),
        _day("created_at").alias("staged_created_at"),
        F.col("parent_application_id").alias("old_parent_application_id"),
        "company_name",
        F.col("userid").alias("username"),
        F.col("created_by").alias("old_created_by"),
        first_present("facility_name", "company_name").alias("certificate_owner"),
        _day("dateofbirth").alias("date_of_birth"),
        nationality("nationality").alias("nationality"),
        "gender",
        int_text("workpermitno", "truncate").alias("work_permit_no"),
        "region",
        "district",
        "ward",
        "email",
        int_text("mobile_no", "truncate").alias("mobile_no"),
        "plot_no",
        "po_box",
        int_text("iftanzanian", "truncate").alias("identification"),
        F.col("iftanzanianfilename").alias("identification_name"),
        int_text("cpphoto", "truncate").alias("passport"),
        F.col("cpphotofilename").alias("passport_name"),
        experience_type("employmentstatus").alias("experience_type"),
    )
    rows = replace_ids(rows, ("region", "district", "ward"), locations or {}, id_key)
    if zones is None:
        return rows.withColumn("zone_id", F.lit(None).cast("string"))
    return lookup(rows, zones, "region", "region", {"zone_id": "zone_id"})


def ensure_classes(ws: Workspace, as_of: Moment) -> Callable[[], DataFrame]:
    """The eight class categories exist afterwards; returns alias -> category_id."""
    categories = ws.table("categories", t.CATEGORIES)
    defaults = {"category_type": F.lit("License"), "is_approved": F.lit(True), "created_at": moment(as_of), "updated_at": moment(as_of)}

    def build() -> DataFrame:
        wanted = fixed_rows(categories().sparkSession, "code", fixed.CLASS_CODES)
        known = categories().filter(F.col("deleted_at").isNull()).select(F.col("code").alias("__code")).distinct()
        absent = wanted.join(known, F.col("code") == F.col("__code"), "left_anti")
        names = absent.select(F.concat(F.lit("CLASS "), "code").alias("name"), "code")
        return ensure_members(categories(), names, defaults, "class", extra=("code",))

    live = ws.put("categories", build)
    return lambda: class_aliases(live())


def class_aliases(categories: DataFrame) -> DataFrame:
    coded = categories.filter(F.col("code").isin(*fixed.CLASS_CODES) & F.col("deleted_at").isNull())
    return either_key(coded, ["code", class_code("name")], {"category_id": "id"})


def import_installations(
    ws: Workspace,
    feed: DataFrame,
    locations: Mapping[str, DataFrame] | None = None,
    zones: DataFrame | None = None,
    default_role: str | None = "DEFAULT ROLE",
    as_of: Moment = None,
) -> Workspace:
    checked = require(prepared(feed), ["application_number"])
    staged = ws.hold("installations", lambda: stage(checked, locations, zones))
    classes = ensure_classes(ws, as_of)
    provision_users(ws, staged, "username", default_role, as_of)
    first = ws.hold("installations_first", lambda: first_per_number(staged()))
    before = ws.table("applications", t.APPLICATIONS)
    rows = ws.hold("installations_resolved", lambda: resolved_rows(first(), before()))

    hub = upsert(
        ws,
        "applications",
        t.APPLICATIONS,
        lambda: hub_rows(first(), classes(), as_of),
        keys=["application_number"],
        policy={
            "status": constant("APPROVED"),
            "is_migrated": constant(True),
            "license_type": KEEP,
            "category_license_type": KEEP,
        },
        default=EXISTING,
    )
    users = ws.table("users", t.USERS)
    certificates = upsert(
        ws,
        "certificates",
        t.CERTIFICATES,
        lambda: certificate_rows(rows(), users(), as_of),
        keys=["application_number"],
        policy={
            "license_type": OVERWRITE,
            "category_license_type": OVERWRITE,
            "application_id": OVERWRITE,
            "owner_id": EXISTING,
        },
    )
    ws.replace("applications", lambda: certificate_ids(hub(), certificates()).apply())
    upsert(
        ws,
        "application_electrical_installation",
        t.INSTALLATIONS,
        lambda: installation_rows(rows(), classes(), as_of),
        policy={"is_migrated": constant(True)},
    )
    for name, schema, suffix, columns in (
        ("contact_details", t.CONTACT_DETAILS, "cd", ("region", "district", "ward", "email", "mobile_no", "plot_no", "po_box")),
        ("personal_details", t.PERSONAL_DETAILS, "pd", ("date_of_birth", "nationality", "gender", "work_permit_no")),
        ("attachments", t.ATTACHMENTS, "att", ("identification", "identification_name", "passport", "passport_name")),
    ):
        # One child per installation: an installation that already has one keeps it.
        source = functools.partial(lambda s, c: stamped(_child(rows(), s, *c), as_of), suffix, columns)
        upsert(ws, name, schema, source, keys=["application_electrical_installation_id"], mode="insert")
    upsert(ws, "self_employed", t.SELF_EMPLOYED, lambda: stamped(self_employed_rows(rows()), as_of))
    return ws


def resolved_rows(first: DataFrame, before: DataFrame) -> DataFrame:
    """Staged rows with what the hub has, or gets, for their application, and the installation key."""
    take = {"__old_type": "license_type", "__old_category_type": "category_license_type", "__created_by": "created_by"}
    rows = resolved_id(first, before, take)
    new = F.col("__id").isNull()
    return rows.select(
        *first.columns,
        "application_id",
        F.when(new, F.lit(fixed.INSTALLATION_LICENSE)).otherwise(F.col("__old_type")).alias("__license_type"),
        F.when(new, F.lit("OPERATIONAL")).otherwise(F.col("__old_category_type")).alias("__category_license_type"),
        "__created_by",
        stable_key("application_id", F.lit("aei")).alias("__aei"),
    )


def self_employed_rows(rows: DataFrame) -> DataFrame:
    own = rows.filter(F.col("experience_type") == "SELF_EMPLOYED")
    return _child(own, "se", F.lit("NONE").alias("voltage_level"))


def hub_rows(first: DataFrame, classes: DataFrame, as_of: Moment) -> DataFrame:
    rows = lookup(first, classes, class_code("licensecategoryclass"), "alias", {"__class": "category_id"}, normalise=None)
    raw_uuid = F.lower(cast_or("licensecategoryclass", "string", pattern=fixed.UUID_SHAPE))
    out = rows.select(
        stable_key(F.lit("application"), "application_number").alias("id"),
        "application_number",
        "application_type",
        "approval_no",
        F.col("completed_at").alias("approval_date"),
        F.lit(fixed.INSTALLATION_LICENSE).alias("license_type"),
        F.lit("OPERATIONAL").alias("category_license_type"),
        F.coalesce("__class", raw_uuid).alias("category_id"),
        "effective_date",
        "expire_date",
        "old_parent_application_id",
        "username",
        "old_created_by",
        F.lit("APPROVED").alias("status"),
        F.lit(True).alias("is_migrated"),
        "zone_id",
        "staged_created_at",
    )
    out = stamped(out, as_of)
    created = F.coalesce(F.col("staged_created_at").cast("timestamp"), F.col("created_at"))
    return out.withColumn("created_at", created).drop("staged_created_at")


def certificate_rows(resolved: DataFrame, users: DataFrame, as_of: Moment) -> DataFrame:
    rows = lookup(resolved, users, "__created_by", "id", {"owner_id": "id"}, normalise=None)
    return stamped(
        rows.select(
            stable_key(F.lit("certificate"), "application_number").alias("id"),
            "application_id",
            "application_number",
            "certificate_owner",
            "approval_no",
            F.col("completed_at").alias("approval_date"),
            F.col("__category_license_type").alias("category_license_type"),
            F.col("__license_type").alias("license_type"),
            "effective_date",
            "expire_date",
            F.coalesce("application_type", F.lit("NEW")).alias("application_certificate_type"),
            "owner_id",
        ),
        as_of,
    )


def certificate_ids(applications: DataFrame, certificates: DataFrame) -> ChangeSet:
    """Fill the certificate id of migrated applications."""
    return backfill(
        applications, certificates, "id", "application_id", {"certificate_id": "id"}, where=F.col("is_migrated")
    )


def installation_rows(rows: DataFrame, classes: DataFrame, as_of: Moment) -> DataFrame:
    found = lookup(rows, classes, class_code("approvedclass"), "alias", {"approved_class_id": "category_id"}, normalise=None)
    return stamped(
        found.select(
            F.col("__aei").alias("id"),
            "application_id",
            F.col("company_name").alias("applicant_name"),
            "experience_type",
            "approved_class_id",
            F.lit(True).alias("is_migrated"),
        ),
        as_of,
    )


def _child(rows: DataFrame, suffix: str, *columns: str | Column) -> DataFrame:
    return rows.select(
        stable_key("__aei", F.lit(suffix)).alias("id"),
        "application_id",
        F.col("__aei").alias("application_electrical_installation_id"),
        *columns,
    )
