"""Shareholders and managing directors."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlift.functions import cast_or, clean, int_text, looks_like, nationality, split_name, stable_key
from ledgerlift.functions import fixed_values as fixed
from ledgerlift.operators.dedupe import keep_first
from ledgerlift.operators.joins import lookup
from ledgerlift.operators.merge import OVERWRITE
from ledgerlift.operators.profile import REASON, skip_counts, with_reason
from ledgerlift.plans import tables as t
from ledgerlift.plans.common import Moment, prepared, stamped, upsert, with_application, with_sector_detail
from ledgerlift.sources.grid import ROW, require
from ledgerlift.sources.store import Deferred, Workspace

SHAREHOLDER_OPTIONAL = ("countryname", "amountofshare", "objectid", "nationality", "indcomp", "sconadd", "filename")
DIRECTOR_OPTIONAL = (
    "demail",
    "phoneno",
    "conadd",
    "countryname",
    "nationality1",
    "workpermit",
    "workpermitfilename",
    "cpana",
    "cpanafilename",
)
REASONS = ("missing_application", "missing_name")


def _country(rows: DataFrame, column: str, countries: DataFrame | None) -> DataFrame:
    """Country id to nationality; an unknown id is no nationality."""
    if countries is None:
        return rows.withColumn("nationality", F.lit(None).cast("string"))
    key = lambda c: int_text(c, "null")
    found = lookup(rows, countries, column, "id", {"__country": "name"}, key)
    return found.withColumn("nationality", nationality("__country")).drop("__country")


def _resolved(ws: Workspace, name: str, staged: Callable[[], DataFrame], person: str) -> Deferred:
    """Rows with parents and skip reason."""
    applications = ws.table("applications", t.APPLICATIONS)
    details = ws.table("application_sector_details", t.SECTOR_DETAILS)

    def build() -> DataFrame:
        rows = with_sector_detail(with_application(staged(), applications()), details())
        return with_reason(
            rows, {"missing_application": F.col("application_id").isNull(), "missing_name": F.col(person).isNull()}
        )

    return ws.hold(name, build, skip_counts(REASONS))


def _first_per_person(rows: DataFrame, person: str) -> DataFrame:
    keys = [F.lower("application_number"), F.lower(person)]
    return keep_first(rows.filter(F.col(REASON).isNull()), keys, [F.col(ROW).asc_nulls_last()])


def import_shareholders(ws: Workspace, feed: DataFrame, countries: DataFrame | None = None, as_of: Moment = None) -> Workspace:
    feed = require(prepared(feed), ["apprefno", "shname"], SHAREHOLDER_OPTIONAL)
    staged = feed.select(
        ROW,
        clean("apprefno").alias("application_number"),
        clean("shname").alias("shareholder_name"),
        clean("amountofshare").alias("amount"),
        clean("filename").alias("file_name"),
        clean("objectid").alias("objectid"),
        clean("nationality").alias("country_id"),
        clean("indcomp").alias("individual_company"),
        clean("sconadd").alias("street_address"),
        clean("countryname").alias("country"),
    ).withColumn("invalid_objectid", F.col("objectid").isNotNull() & ~looks_like("objectid", "decimal"))
    rows = _resolved(ws, "shareholders", lambda: _country(staged, "country_id", countries), "shareholder_name")
    policy = {"shareholder_name": OVERWRITE, "application_sector_detail_id": OVERWRITE}
    upsert(ws, "shareholders", t.SHAREHOLDERS, lambda: stamped(shareholder_rows(rows()), as_of), policy=policy)
    return ws


def shareholder_rows(rows: DataFrame) -> DataFrame:
    first, middle, last = split_name("shareholder_name")
    return _first_per_person(rows, "shareholder_name").select(
        stable_key("application_number", F.lower("shareholder_name")).alias("id"),
        "application_id",
        "application_sector_detail_id",
        "shareholder_name",
        first.alias("first_name"),
        middle.alias("middle_name"),
        last.alias("last_name"),
        cast_or("amount", "decimal(38,6)", pattern=fixed.UNSIGNED_DECIMAL).alias("amount_of_share_percent"),
        F.col("country").alias("country_of_residence"),
        F.col("country").alias("country_of_incorporation"),
        "nationality",
        "individual_company",
        "street_address",
        "file_name",
        cast_or("objectid", "bigint", pattern=fixed.UNSIGNED_DECIMAL).alias("logic_doc_id"),
    )


def import_directors(ws: Workspace, feed: DataFrame, countries: DataFrame | None = None, as_of: Moment = None) -> Workspace:
    feed = require(prepared(feed), ["apprefno", "name"], DIRECTOR_OPTIONAL)
    staged = feed.select(
        ROW,
        clean("apprefno").alias("application_number"),
        clean("name").alias("name"),
        clean("demail").alias("email"),
        int_text(clean("phoneno"), "null").alias("mobile_no"),
        clean("countryname").alias("country"),
        clean("nationality1").alias("country_id"),
        int_text(clean("workpermit"), "null").alias("work_permit"),
        clean("workpermitfilename").alias("work_permit_filename"),
        int_text(clean("cpana"), "null").alias("cpana"),
        clean("cpanafilename").alias("cpana_filename"),
    )
    for c in ("work_permit", "cpana"):
        staged = staged.withColumn(f"invalid_{c}", F.col(c).isNotNull() & ~looks_like(c, "digits"))
    rows = _resolved(ws, "managing_directors", lambda: _country(staged, "country_id", countries), "name")
    policy = {"name": OVERWRITE, "first_name": OVERWRITE}
    upsert(ws, "managing_directors", t.DIRECTORS, lambda: stamped(director_rows(rows()), as_of), policy=policy)
    return ws


def director_rows(rows: DataFrame) -> DataFrame:
    first, middle, last = split_name("name")
    return _first_per_person(rows, "name").select(
        stable_key("application_number", F.lower("name")).alias("id"),
        "application_id",
        "application_sector_detail_id",
        "name",
        first.alias("first_name"),
        middle.alias("middle_name"),
        last.alias("last_name"),
        "email",
        "mobile_no",
        "country",
        "nationality",
        cast_or("work_permit", "bigint", pattern=fixed.DIGITS).alias("work_permit"),
        "work_permit_filename",
        cast_or("cpana", "bigint", pattern=fixed.DIGITS).alias("cpana"),
        "cpana_filename",
    )
