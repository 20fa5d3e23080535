"""Water supply licences: hub, certificates, details, finance children, documents."""

from __future__ import annotations

import functools
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlift.functions import (
    any_present,
    clean,
    iso_date,
    license_type,
    stable_key,
    water_application_type,
)
from ledgerlift.functions.text import ColumnOrName, col
from ledgerlift.operators.backfill import ChangeSet, backfill, user_of_application
from ledgerlift.operators.joins import lookup, replace_ids
from ledgerlift.operators.merge import EXISTING, KEEP, OVERWRITE, constant
from ledgerlift.operators.reshape import Pair, unpivot_pairs
from ledgerlift.plans import tables as t
from ledgerlift.plans.applications import first_per_number
from ledgerlift.plans.common import Moment, prepared, provision_users, stamped, upsert
from ledgerlift.plans.electrical import certificate_ids
from ledgerlift.sources.dimensions import id_key
from ledgerlift.sources.grid import ROW, apply_aliases
from ledgerlift.sources.store import Workspace

# --- fixed values: source header -> staged column ----------------------------------------------
ALIASES = {
    "application_number": "application_number",
    "apprefno": "application_number",
    "application_type": "application_type",
    "approval_no": "approval_no",
    "approvalno": "approval_no",
    "licenceno": "approval_no",
    "effective_date": "effective_date",
    "expire_date": "expire_date",
    "expiry_date": "expire_date",
    "completed_at": "completed_at",
    "approval_date": "completed_at",
    "license_type": "license_type",
    "license_category_id": "license_category_raw",
    "parent_application_id": "old_parent_application_id",
    "created_by": "old_created_by",
    "userid": "username",
    "address_code": "address_code",
    "address_no": "address_no",
    "block_no": "block_no",
    "plot_no": "plot_no",
    "road": "road",
    "street": "street",
    "region": "region",
    "district": "district",
    "ward": "ward",
    "latitude": "latitude",
    "longitude": "longitude",
    "po_box": "po_box",
    "facility_name": "facility_name",
    "company_name": "company_name",
    "email": "email",
    "mobile_no": "mobile_no",
    "cmobile_no": "cmobile_no",
    "website": "website",
    "tin": "tin",
    "tin_name": "tin_name",
    "brela_number": "brela_number",
    "brela_registration_type": "brela_registration_type",
    "certificate_of_incorporation_no": "certificate_of_incorporation_no",
    "vrnno": "vrn",
    "gngzon": "gn_gazette_on",
    "govtnoteco": "government_notice_no",
    "govtnoteno": "government_notice_no",
    "rvalue": "rvalue",
    "nofcustomer": "no_of_customer",
    "no_of_customer": "no_of_customer",
    "amount": "amount",
    "currency": "currency",
    "fs": "fs",
    "ateleno": "ateleno",
    "aposition": "aposition",
    "aconpername": "aconpername",
    "bposition": "bposition",
    "bconpername": "bconpername",
    "bname": "bname",
    "title": "title",
    "contact_name": "contact_name",
}
# --- fixed values: attachments in document order; all but two are labelled by their column -----
ATTACHMENTS = (
    "tinc",
    "vrndoc",
    "abftcoy",
    "ccsc",
    "sesr",
    "eiarcfpui",
    "cafsftpy",
    "moudqaw",
    "moumaw",
    "cbp",
    "caat",
    "dloc",
    "blbs",
    "todis",
    "tdfwsaaoi",
    "wap",
    "llc",
    "bp",
    "ppitsotpdiq",
    "pfd",
    "miaoapstapa",
    "daabd",
    "lup",
    "sm",
    "pd",
    "ar",
    "pmp",
    "qmp",
)
ATTACHMENT_LABELS = {"tinc": "TIN_CERTIFICATE", "vrndoc": "VRN_DOCUMENT"}
REFEREE = ("cmobile_no", "title", "contact_name")
BANK = ("bname", "bposition", "bconpername", "ateleno")


def stage(feed: DataFrame, locations: Mapping[str, DataFrame] | None = None) -> DataFrame:
    feed = prepared(feed)
    have = set(feed.columns)
    cells = [c for a in ATTACHMENTS for c in (a, f"{a}filename") if c in have]
    kept = feed.select("*", *[F.col(c).alias(f"__doc_{c}") for c in cells])
    staged = apply_aliases(kept, ALIASES, keep=(ROW, *[f"__doc_{c}" for c in cells]))
    cleaned = staged.select(
        *[F.col(c) if c == ROW or c.startswith("__doc_") else clean(c).alias(c) for c in staged.columns]
    )
    return replace_ids(cleaned, ("region", "district", "ward"), locations or {}, id_key)


def number_key(number: ColumnOrName) -> Column:
    """How application numbers of this feed compare, and what the ids are made of: without regard to case."""
    return F.lower(col(number))


def _key(kind: str) -> Column:
    return stable_key(F.lit(f"WATER_{kind}"), number_key("application_number"), sep=":")


def import_water(
    ws: Workspace,
    feed: DataFrame,
    locations: Mapping[str, DataFrame] | None = None,
    default_role: str | None = "DEFAULT ROLE",
    as_of: Moment = None,
) -> Workspace:
    staged = ws.hold("water", lambda: stage(feed, locations))
    provision_users(ws, staged, "username", default_role, as_of)
    first = ws.hold("water_first", lambda: first_per_number(staged(), number_key("application_number")))
    users, known = ws.table("users", t.USERS), ws.table("applications", t.APPLICATIONS)
    rows = ws.hold("water_resolved", lambda: resolved_rows(first(), known()))
    same = {"application_number": number_key}
    merged = upsert(
        ws,
        "applications",
        t.APPLICATIONS,
        lambda: hub_rows(first(), users(), as_of),
        keys=["application_number"],
        policy={"created_by": EXISTING, "category_license_type": KEEP, "username": KEEP, "is_migrated": KEEP},
        fold=same,
    )
    hub = ws.replace("applications", lambda: creators(merged(), first(), users()).apply())
    certificates = upsert(
        ws,
        "certificates",
        t.CERTIFICATES,
        lambda: certificate_rows(rows(), as_of),
        keys=["application_number"],
        policy={"sector": constant("WATER_SUPPLY"), "certificate_type": constant("License")},
        fold=same,
    )
    ws.replace("applications", lambda: certificate_ids(hub(), certificates()).apply())

    refreshed = ("company_name", "vrn", "gn_gazette_on", "government_notice_no", "certificate_of_incorporation_no")
    frozen = {c: KEEP for c in (*t.ADDRESS, *t.BUSINESS, "application_id") if c not in refreshed}
    parents = {"application_id": OVERWRITE, "application_sector_detail_id": OVERWRITE}
    for name, schema, build, policy in (
        ("application_sector_details", t.SECTOR_DETAILS, detail_rows, frozen),
        ("referees", t.REFEREES, referee_rows, parents),
        ("bank_details_tanzania", t.BANK_DETAILS, bank_rows, parents | {"email": KEEP, "po_box": KEEP}),
        ("financial_information", t.FINANCIAL, financial_rows, parents),
        ("applicant_proposed_investment", t.INVESTMENT, investment_rows, parents),
        ("project_description", t.PROJECT, project_rows, parents),
        ("documents", t.DOCUMENTS, document_rows, {c: KEEP for c in ("document_name", "documents_order", *parents)}),
    ):
        upsert(ws, name, schema, functools.partial(lambda make: stamped(make(rows()), as_of), build), policy=policy)
    return ws


def creators(hub: DataFrame, first: DataFrame, users: DataFrame) -> ChangeSet:
    """An application whose user was created in an earlier run gets its creator now."""
    known = user_of_application(first.select(F.col("application_number").alias("id"), "username"), users)
    return backfill(
        hub,
        known,
        "application_number",
        "application_id",
        {"created_by": "user_id"},
        normalise=number_key,
        where=F.col("is_migrated"),
        unique=True,
    )


def resolved_rows(first: DataFrame, known: DataFrame) -> DataFrame:
    """Staged rows with the id their application has, or gets, in the hub.

    The hub as it was is enough for that: a known application keeps its id, a new one derives it.
    So the children need not wait for the merge of the hub, nor repeat it.
    """
    rows = lookup(first, known, "application_number", "application_number", {"__known": "id"}, normalise=number_key)
    rows = rows.withColumn("application_id", F.coalesce("__known", _key("APP"))).drop("__known")
    return rows.withColumn("application_sector_detail_id", _key("ASD"))


def detail_rows(rows: DataFrame) -> DataFrame:
    return rows.select(
        F.col("application_sector_detail_id").alias("id"),
        "application_id",
        *t.ADDRESS,
        *t.BUSINESS,
        "vrn",
        "gn_gazette_on",
        "government_notice_no",
    )


def hub_rows(first: DataFrame, users: DataFrame, as_of: Moment) -> DataFrame:
    rows = lookup(first, users, "username", "username", {"created_by": "id"})
    return stamped(
        rows.select(
            _key("APP").alias("id"),
            "application_number",
            water_application_type("application_type").alias("application_type"),
            "approval_no",
            iso_date("effective_date").alias("effective_date"),
            iso_date("expire_date").alias("expire_date"),
            iso_date("completed_at").cast("timestamp").alias("completed_at"),
            license_type("license_type").alias("license_type"),
            F.lit("OPERATIONAL").alias("category_license_type"),
            F.lower("username").alias("username"),
            "created_by",
            F.lit(True).alias("is_migrated"),
        ),
        as_of,
    )


def certificate_rows(rows: DataFrame, as_of: Moment) -> DataFrame:
    return stamped(
        rows.select(
            stable_key(F.lit("certificate"), number_key("application_number")).alias("id"),
            "application_id",
            "application_number",
            "approval_no",
            iso_date("completed_at").alias("approval_date"),
            license_type("license_type").alias("license_type"),
            F.lit("OPERATIONAL").alias("category_license_type"),
            iso_date("effective_date").alias("effective_date"),
            iso_date("expire_date").alias("expire_date"),
            F.coalesce(water_application_type("application_type"), F.lit("NEW")).alias("application_certificate_type"),
            F.lit("WATER_SUPPLY").alias("sector"),
            F.lit("License").alias("certificate_type"),
        ),
        as_of,
    )


_PARENTS = ("application_id", "application_sector_detail_id")


def referee_rows(rows: DataFrame) -> DataFrame:
    return rows.filter(any_present(*REFEREE)).select(
        _key("REFEREE").alias("id"),
        *_PARENTS,
        F.col("cmobile_no").alias("telephone_no"),
        "title",
        F.col("contact_name").alias("contact_person_name"),
    )


def bank_rows(rows: DataFrame) -> DataFrame:
    return rows.filter(any_present(*BANK)).select(
        _key("BANK_TZ").alias("id"),
        *_PARENTS,
        F.col("bname").alias("name_of_banker"),
        F.col("bposition").alias("position"),
        F.col("bconpername").alias("contact_person_name"),
        F.col("ateleno").alias("telephone_no"),
        "email",
        "po_box",
    )


def financial_rows(rows: DataFrame) -> DataFrame:
    return rows.select(
        _key("FI").alias("id"),
        *_PARENTS,
        F.when(any_present(*BANK), _key("BANK_TZ")).alias("bank_details_tz_id"),
        F.when(any_present(*REFEREE), _key("REFEREE")).alias("referee_id"),
        "fs",
        "amount",
        "currency",
    )


def investment_rows(rows: DataFrame) -> DataFrame:
    return rows.filter(any_present("amount", "currency")).select(_key("API").alias("id"), *_PARENTS, "amount", "currency")


def project_rows(rows: DataFrame) -> DataFrame:
    return rows.filter(any_present("no_of_customer")).select(
        _key("PD").alias("id"), *_PARENTS, F.col("no_of_customer").alias("number_of_customer")
    )


def document_rows(rows: DataFrame) -> DataFrame:
    """One document per attachment with a file name; the id cell is kept as the document url."""
    pairs = [Pair(f"__doc_{a}", f"__doc_{a}filename", ATTACHMENT_LABELS.get(a, a.upper())) for a in ATTACHMENTS]
    carry = ["application_number", *_PARENTS]
    long = unpivot_pairs(rows, pairs, carry, need_id=False, fixed_order=True, dialect="general")
    return long.select(
        stable_key(F.concat(F.lit("WATER_DOC:"), "document_name"), number_key("application_number"), sep=":").alias("id"),
        *_PARENTS,
        "document_name",
        "file_name",
        F.col("id_text").alias("document_url"),
        "documents_order",
    )
