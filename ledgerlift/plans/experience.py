"""Work experience, supervisors, self-employed projects and certificate verifications."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlift.functions import (
    bare_name,
    clean,
    email_in,
    experience_key,
    parse_date,
    phone_in,
    stable_key,
    whole_number,
)
from ledgerlift.functions import fixed_values as fixed
from ledgerlift.operators.dedupe import keep_first
from ledgerlift.operators.merge import CLEAN_NAME, EXISTING_TEXT, KEEP, constant
from ledgerlift.operators.profile import funnel
from ledgerlift.plans import tables as t
from ledgerlift.plans.common import Moment, prepared, stamped, upsert, with_application, with_installation
from ledgerlift.sources.grid import ROW, rename_aliases, require
from ledgerlift.sources.store import Workspace

# --- fixed values: header aliases of the experience feeds ------------------------------------
EXPERIENCE_ALIASES = {
    "app_ref_no": "apprefno",
    "app_refno": "apprefno",
    "app_ref": "apprefno",
    "application_no": "apprefno",
    "application_number": "apprefno",
    "applicationnumber": "apprefno",
    "appno": "apprefno",
    "app_number": "apprefno",
    "supervisor_detail": "supervisordetail",
    "supervisor_details": "supervisordetail",
    "supervisor": "supervisordetail",
    "supervisordetails": "supervisordetail",
    "name_of_supervisor": "supervisordetail",
    "role_and_responsibility": "roleandresponsibility",
    "role_responsibility": "roleandresponsibility",
    "role": "roleandresponsibility",
    "responsibility": "roleandresponsibility",
    "voltage_level": "voltagelevel",
    "voltage": "voltagelevel",
    "work_performed": "workperformed",
    "workdone": "workperformed",
    "work_done": "workperformed",
    "work": "workperformed",
    "work_description": "workperformed",
    "from_date": "wfromdate",
    "fromdate": "wfromdate",
    "work_from_date": "wfromdate",
    "w_from_date": "wfromdate",
    "to_date": "wtodate",
    "todate": "wtodate",
    "work_to_date": "wtodate",
    "w_to_date": "wtodate",
}
SELF_EMPLOYED_ALIASES = {
    "app_ref_no": "apprefno",
    "app_refno": "apprefno",
    "application_no": "apprefno",
    "application_number": "apprefno",
    "applicationnumber": "apprefno",
    "app_number": "apprefno",
    "sn": "sno",
    "s_n": "sno",
    "sfe_voltage_level": "sfevoltagelevel",
    "voltage": "sfevoltagelevel",
    "voltagelevel": "sfevoltagelevel",
    "sfe_custom_details": "sfecustomdetails",
    "custom_details": "sfecustomdetails",
    "project_performed": "projectperformed",
    "from_date": "sfefromdate",
    "sfefrom_date": "sfefromdate",
    "to_date": "sfetodate",
    "sfeto_date": "sfetodate",
}
_PARENT = "application_electrical_installation_id"


def _owner() -> Column:
    """Seed of child keys: the installation where there is one, else the application."""
    return F.coalesce(_PARENT, "application_id")


def _stamp_text(c: str) -> Column:
    """Dates enter the keys as a timestamp text, so equal days in different layouts agree."""
    return F.concat(F.col(c).cast("string"), F.lit(" 00:00:00"))


def _experience_stage(feed: DataFrame, required: list[str], optional: list[str]) -> DataFrame:
    feed = require(rename_aliases(prepared(feed), EXPERIENCE_ALIASES), required, optional)
    return _cleaned(
        feed,
        {
            "apprefno": "application_number",
            "supervisordetail": "supervisor_detail",
            "roleandresponsibility": "role",
            "voltagelevel": "voltage",
            "workperformed": "work_performed",
            "position": "position",
            "wfromdate": "from_day",
            "wtodate": "to_day",
        },
        fixed.DATES_EXPERIENCE,
    )


def _cleaned(feed: DataFrame, names: Mapping[str, str], layouts: Sequence[str]) -> DataFrame:
    """Cleaned cells under their staged names, then the two days parsed."""
    cells = feed.select(ROW, *[clean(source).alias(name) for source, name in names.items()])
    return cells.withColumns({c: parse_date(c, layouts, serial=False, dialect=None) for c in ("from_day", "to_day")})


def _located(ws: Workspace, stage: DataFrame, extra: dict[str, str] | None = None) -> Callable[[], DataFrame]:
    """Staged rows with application and installation, NULL where there is none."""
    applications = ws.table("applications", t.APPLICATIONS)
    installations = ws.table("application_electrical_installation", t.INSTALLATIONS)
    return lambda: with_installation(with_application(stage, applications()), installations(), extra)


def _with_parents(ws: Workspace, stage: DataFrame, extra: dict[str, str] | None = None) -> Callable[[], DataFrame]:
    """Application required, installation best effort."""
    located = _located(ws, stage, extra)
    return lambda: located().filter(F.col("application_id").isNotNull())


def _work_key() -> Column:
    return stable_key(
        _owner(), F.lit("we"), _stamp_text("from_day"), _stamp_text("to_day"), "voltage", "work_performed", "position", "role"
    )


def _by_row(rows: DataFrame, *keys: str) -> DataFrame:
    return keep_first(rows, keys, [F.col(ROW).asc_nulls_last()])


def import_supervisors(ws: Workspace, feed: DataFrame, as_of: Moment = None) -> Workspace:
    """Employed experience and the supervisors named in it."""
    required = ["apprefno", "supervisordetail", "voltagelevel", "workperformed", "wfromdate", "wtodate"]
    stage = _experience_stage(feed, required, ["roleandresponsibility", "position"])
    parents = _with_parents(ws, stage)
    rows = ws.hold("supervisors", lambda: parents().withColumn("__we", _work_key()))
    kept = {"application_id": KEEP, _PARENT: KEEP}
    upsert(ws, "work_experience", t.WORK_EXPERIENCE, lambda: stamped(experience_rows(rows()), as_of), policy=kept)
    policy = kept | {"name": CLEAN_NAME, "mobile_no": EXISTING_TEXT, "email": EXISTING_TEXT}
    upsert(ws, "supervisor_details", t.SUPERVISOR_DETAILS, lambda: stamped(named_supervisors(rows()), as_of), policy=policy)
    return ws


def experience_rows(rows: DataFrame) -> DataFrame:
    return _by_row(rows, "__we").select(
        F.col("__we").alias("id"),
        "application_id",
        _PARENT,
        F.col("from_day").cast("timestamp").alias("from_date"),
        F.col("to_day").cast("timestamp").alias("to_date"),
        F.col("work_performed").alias("work_description"),
        F.lit("NONE").alias("voltage_level"),
        "voltage",
        F.col("supervisor_detail").alias("name_of_employer"),
        "position",
        "role",
    )


def named_supervisors(rows: DataFrame) -> DataFrame:
    return _supervisor_rows(rows).select(
        "id",
        "application_id",
        _PARENT,
        F.col("__we").alias("work_experience_id"),
        bare_name("supervisor_detail").alias("name"),
        "position",
        email_in("supervisor_detail").alias("email"),
        phone_in("supervisor_detail").alias("mobile_no"),
    )


def _supervisor_rows(rows: DataFrame) -> DataFrame:
    """First row per (parent, supervisor text, position), which is also what the id is made of."""
    key = stable_key(_owner(), F.lit("sd"), "supervisor_detail", "position")
    return _by_row(rows.filter(F.col("supervisor_detail").isNotNull()).withColumn("id", key), "id")


def import_supervisor_details(ws: Workspace, feed: DataFrame, as_of: Moment = None) -> Workspace:
    """Supervisors as given, and a project row for self-employed applicants."""
    optional = ["roleandresponsibility", "position", "voltagelevel", "workperformed", "wfromdate", "wtodate"]
    stage = _experience_stage(feed, ["apprefno", "supervisordetail"], optional)
    rows = ws.hold("supervisor_details", _with_parents(ws, stage, {"__experience": "experience_type"}))
    kept = {"application_id": KEEP, _PARENT: KEEP}
    upsert(ws, "supervisor_details", t.SUPERVISOR_DETAILS, lambda: stamped(given_supervisors(rows()), as_of), policy=kept)
    upsert(ws, "self_employed", t.SELF_EMPLOYED, lambda: stamped(supervised_projects(rows()), as_of), policy=kept)
    return ws


def given_supervisors(rows: DataFrame) -> DataFrame:
    return _supervisor_rows(rows).select(
        "id", "application_id", _PARENT, F.col("supervisor_detail").alias("name"), "position"
    )


def supervised_projects(rows: DataFrame) -> DataFrame:
    key = stable_key(_owner(), F.lit("se"), _stamp_text("from_day"), _stamp_text("to_day"), "voltage", "work_performed")
    own = rows.filter(F.upper(F.trim("__experience")) == "SELF_EMPLOYED").withColumn("id", key)
    return _by_row(own, "id").select(
        "id",
        "application_id",
        _PARENT,
        F.col("from_day").cast("timestamp").alias("from_date"),
        F.col("to_day").cast("timestamp").alias("to_date"),
        F.col("work_performed").alias("project_performed"),
        F.lit("NONE").alias("voltage_level"),
        "voltage",
    )


def import_self_employed(ws: Workspace, feed: DataFrame, as_of: Moment = None) -> Workspace:
    """Projects of self-employed applicants, each with one custom-details row."""
    columns = ["apprefno", "sno", "sfevoltagelevel", "sfecustomdetails", "projectperformed", "sfefromdate", "sfetodate"]
    feed = require(rename_aliases(prepared(feed), SELF_EMPLOYED_ALIASES), [], columns)
    stage = _cleaned(
        feed,
        {
            "apprefno": "application_number",
            "sno": "sno",
            "sfevoltagelevel": "voltage",
            "sfecustomdetails": "custom_details",
            "projectperformed": "project_performed",
            "sfefromdate": "from_day",
            "sfetodate": "to_day",
        },
        fixed.DATES_EXPERIENCE,
    )
    rows = ws.hold("self_employed", _located(ws, stage, {"__experience": "experience_type"}))
    first = ws.hold("self_employed_first", lambda: first_projects(rows()))
    upsert(ws, "self_employed", t.SELF_EMPLOYED, lambda: stamped(project_rows(first()), as_of), policy={_PARENT: KEEP})
    details = lambda: stamped(custom_detail_rows(first()), as_of)
    upsert(ws, "custom_details", t.CUSTOM_DETAILS, details, keys=["self_employed_details_id"])
    return ws


def first_projects(rows: DataFrame) -> DataFrame:
    key = stable_key(
        _PARENT, F.lit("se_upload"), "sno", _stamp_text("from_day"), _stamp_text("to_day"), "voltage", "project_performed"
    )
    own = rows.filter(F.col(_PARENT).isNotNull() & (experience_key("__experience") == "SELF_EMPLOYED"))
    return _by_row(own.withColumn("id", key), "id")


def project_rows(first: DataFrame) -> DataFrame:
    return first.select(
        "id",
        "application_id",
        _PARENT,
        F.col("from_day").cast("timestamp").alias("from_date"),
        F.col("to_day").cast("timestamp").alias("to_date"),
        "project_performed",
        F.lit("NONE").alias("voltage_level"),
        "voltage",
    )


def custom_detail_rows(first: DataFrame) -> DataFrame:
    return first.select(
        stable_key("id", F.lit("custom_details")).alias("id"),
        "application_id",
        F.col("id").alias("self_employed_details_id"),
        F.nullif(F.trim("custom_details"), F.lit("")).alias("name"),
    )


def self_employed_funnel(ws: Workspace) -> DataFrame:
    """Staged rows that reach an application, an installation, and the self-employed filter."""
    return funnel(
        ws.staged["self_employed"],
        {
            "staged": F.lit(True),
            "with_application": F.col("application_id").isNotNull(),
            "with_installation": F.col(_PARENT).isNotNull(),
            "self_employed": experience_key("__experience") == "SELF_EMPLOYED",
        },
    )


def import_verifications(ws: Workspace, feed: DataFrame, as_of: Moment = None) -> Workspace:
    """Education certificates to verify."""
    feed = require(
        prepared(feed), ["apprefno", "institutenameaddress", "award"], ["sno", "fromdate", "todate", "objectid", "filename"]
    )
    cells = _cleaned(
        feed,
        {
            "apprefno": "application_number",
            "institutenameaddress": "institute",
            "award": "award",
            "fromdate": "from_day",
            "todate": "to_day",
            "objectid": "logic_doc_id",
            "filename": "file_name",
        },
        fixed.DATES_PLAIN,
    )
    stage = cells.withColumn("logic_doc_id", whole_number("logic_doc_id"))
    rows = ws.hold("verifications", _with_parents(ws, stage))
    none = constant("NONE")
    policy = {
        "application_id": KEEP,
        _PARENT: KEEP,
        "education_regulatory_body": none,
        "education_regulatory_body_category": none,
    }
    upsert(ws, "certificate_verifications", t.VERIFICATIONS, lambda: stamped(verification_rows(rows()), as_of), policy=policy)
    return ws


def verification_rows(rows: DataFrame) -> DataFrame:
    key = stable_key("application_id", F.lit("cv"), "institute", "award", "logic_doc_id", "file_name")
    # Rows that differ in their dates only share the id: the one with a parent and the
    # earliest row wins, so the id is unique.
    order = [F.col(_PARENT).isNull().asc(), F.col(ROW).asc_nulls_last()]
    return keep_first(rows.withColumn("id", key), ["id"], order).select(
        "id",
        "application_id",
        _PARENT,
        F.col("from_day").cast("timestamp").alias("from_date"),
        F.col("to_day").cast("timestamp").alias("to_date"),
        F.lit("NONE").alias("education_regulatory_body"),
        F.lit("NONE").alias("education_regulatory_body_category"),
        "logic_doc_id",
        "file_name",
    )
