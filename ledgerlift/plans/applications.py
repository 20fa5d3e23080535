"""Applications of the four sectors: hub, certificates, details, documents and children."""

from __future__ import annotations

import functools
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlift.functions import (
    any_present,
    application_type,
    blank_to_null,
    cast_or,
    clean,
    imported_license_type,
    looks_like,
    parse_date,
    stable_key,
)
from ledgerlift.functions import fixed_values as fixed
from ledgerlift.functions.text import ColumnOrName, label_key
from ledgerlift.operators.dedupe import keep_first, top_rows
from ledgerlift.operators.joins import lookup, replace_ids
from ledgerlift.operators.merge import KEEP, OVERWRITE, constant, merged_rows
from ledgerlift.operators.profile import column_presence, fill_rate, mapping_stats, max_or, rejects, suspicious_rows
from ledgerlift.operators.provision import ensure_members
from ledgerlift.operators.reshape import Pair, detect_pairs, unpivot_pairs
from ledgerlift.plans import tables as t
from ledgerlift.plans.common import Moment, moment, prepared, provision_users, stamped, upsert
from ledgerlift.session import fixed_rows
from ledgerlift.sources.dimensions import id_key
from ledgerlift.sources.grid import ROW, apply_aliases, normalise_headers
from ledgerlift.sources.store import Deferred, Workspace

# --- fixed values: source header -> staged column; the first one present wins ---------------
ALIASES = {
    "address_code": "address_code",
    "address_no": "address_no",
    "block_no": "block_no",
    "plot_no": "plot_no",
    "road": "road",
    "street": "street",
    "region": "region",
    "district": "district",
    "ward": "ward",
    "mobile_no": "mobile_no",
    "email": "email",
    "website": "website",
    "latitude": "latitude",
    "longitude": "longitude",
    "po_box": "po_box",
    "facility_name": "facility_name",
    "company_name": "company_name",
    "tin": "tin",
    "tin_name": "tin_name",
    "brela_number": "brela_number",
    "brela_registration_type": "brela_registration_type",
    "certificate_of_incorporation_no": "certificate_of_incorporation_no",
    "application_number": "application_number",
    "appno": "application_number",
    "app_number": "application_number",
    "apprefno": "application_number",
    "application_type": "application_type",
    "approval_no": "approval_no",
    "approvalno": "approval_no",
    "approval_number": "approval_no",
    "licenceno": "approval_no",
    "license_no": "approval_no",
    "effective_date": "effective_date",
    "effectivedate": "effective_date",
    "date_effective": "effective_date",
    "start_date": "effective_date",
    "startdate": "effective_date",
    "expire_date": "expire_date",
    "expiry_date": "expire_date",
    "expiredate": "expire_date",
    "expired_date": "expire_date",
    "expirydate": "expire_date",
    "expdate": "expire_date",
    "date_expire": "expire_date",
    "date_expiry": "expire_date",
    "end_date": "expire_date",
    "enddate": "expire_date",
    "completed_at": "completed_at",
    "approval_date": "completed_at",
    "license_type": "license_type",
    "license_category_id": "license_category_raw",
    "application_legal_status_id": "application_legal_status_raw",
    "userid": "username",
    "created_by": "old_created_by",
    "parent_application_id": "old_parent_application_id",
    "fcontrolno": "fire_certificate_control_number",
    "fpremisename": "fire_premise_name",
    "fregion": "fire_region",
    "fdistrict": "fire_district",
    "fadministrativearea": "fire_administrative_area",
    "fward": "fire_ward",
    "fstreet": "fire_street",
    "fvalidfrom": "fire_valid_from",
    "fvalidto": "fire_valid_to",
    "covernoterefno": "cover_note_ref_no",
    "tiracovernotenumber": "cover_note_number",
    "tiracovernotereferencenumber": "insurance_ref_no",
    "tirapolicyholdername": "policy_holder_name",
    "tirainsurercompanyname": "insurer_company_name",
    "tiracovernotestartdate": "cover_note_start_date",
    "tiracovernotenddate": "cover_note_end_date",
    "tirariskname": "risk_name",
    "tirasubjectmatterdesc": "subject_matter_desc",
    "cemail": "contact_email",
    "cmobile_no": "contact_mobile_no",
    "title": "contact_title",
    "contact_name": "contact_name",
}
DATE_COLUMNS = (
    "effective_date",
    "expire_date",
    "completed_at",
    "fire_valid_from",
    "fire_valid_to",
    "cover_note_start_date",
    "cover_note_end_date",
)
# --- fixed values: attachments that come first, in this order ---------------------------------
LEADING_PAIRS = ("tinc", "coc", "upop", "ucl", "uplr", "spdoc1", "spdoc2", "spdoc3", "downloadlicense")


def attachment_pairs(columns: Sequence[str]) -> list[Pair]:
    """Attachment pairs of a feed: the leading ones, then every other pair the headers show."""
    detected = {p.file_col: p for p in detect_pairs(columns)}
    leading = [Pair(b, f"{b}filename", b.upper()) for b in LEADING_PAIRS if f"{b}filename" in detected]
    rest = [p for name, p in detected.items() if name not in {q.file_col for q in leading}]
    return [p for p in leading + rest if p.id_col is not None]


def stage(feed: DataFrame, locations: Mapping[str, DataFrame] | None = None) -> DataFrame:
    """Cleaned rows, one per feed row that has an approval number.

    Attachment cells ride along untouched, so the documents need no second read.
    """
    feed = prepared(feed)
    if "approval_no" in feed.columns:
        feed = feed.filter(clean("approval_no", "application").isNotNull())
    cleaned = cleaned_cells(feed)
    # Two projections: each cell is cleaned once, however often its parsing refers to it.
    typed = cleaned.withColumns(
        {c: parse_date(c, fixed.DATES_APPLICATION, dialect=None) for c in DATE_COLUMNS} | {"username": F.lower("username")}
    )
    return replace_ids(typed, ("region", "district", "ward"), locations or {}, id_key)


def cleaned_cells(feed: DataFrame) -> DataFrame:
    """Canonical columns as cleaned text, and attachment cells as they are."""
    pairs = attachment_pairs(feed.columns)
    cells = sorted({c for p in pairs for c in (p.id_col, p.file_col)})
    kept = feed.select("*", *[F.col(c).alias(f"__doc_{c}") for c in cells])
    staged = apply_aliases(kept, ALIASES, keep=(ROW, *[f"__doc_{c}" for c in cells]))
    raw = [c for c in staged.columns if c == ROW or c.startswith("__doc_")]
    return staged.select(*raw, *[clean(c, "application").alias(c) for c in staged.columns if c not in raw])


def rejected_cells(feed: DataFrame, longest: int = 10_000) -> DataFrame:
    """One row per cell of a feed that the import can't use as it is: (_row, code, column_name, value).

    Dates that no layout reads, serials beyond the last date among them, and texts longer than
    `longest`, which are imported in full but may not fit a target with such a limit.
    """
    cells = cleaned_cells(prepared(feed))
    read = {c: parse_date(c, fixed.DATES_APPLICATION, dialect=None) for c in DATE_COLUMNS}
    rules = {f"unreadable_date:{c}": (c, F.col(c).isNotNull() & read[c].isNull()) for c in DATE_COLUMNS}
    texts = [c for c in cells.columns if c != ROW and not c.startswith("__doc_") and c not in DATE_COLUMNS]
    rules |= {f"too_long:{c}": (c, F.length(c) > longest) for c in texts}
    found = rejects(cells, rules, ROW)
    return found.withColumn("code", F.substring_index("code", ":", 1))


def header_report(feed: DataFrame) -> dict[str, list[str]]:
    """Which known headers a feed has, lacks, and which of its columns nothing reads."""
    names = normalise_headers(feed).columns
    pairs = {c for p in attachment_pairs(names) for c in (p.id_col, p.file_col)}
    return column_presence([c for c in names if c != ROW and c not in pairs], list(ALIASES))


def mapping_report(ws: Workspace) -> DataFrame:
    """One row: staged licence types, legal statuses, regions, districts and wards that were and weren't resolved."""
    return mapping_stats(*_mappings(ws))


def mapping_samples(ws: Workspace, n: int | None = None) -> DataFrame:
    """(mapping, value, rows): the values that were not resolved, the most frequent first, `n` of each on request."""
    rows, pairs = _mappings(ws)
    listed = F.array(*[F.struct(F.lit(name).alias("mapping"), F.col(raw).alias("value"), resolved.isNull().alias("open")) for name, (raw, resolved) in pairs.items()])
    open_ = rows.select(F.inline(listed)).where("open and value is not null")
    counts = open_.groupBy("mapping", "value").agg(F.count(F.lit(1)).alias("rows"))
    return counts if n is None else top_rows(counts, ["mapping"], [F.desc("rows"), F.col("value")], n)


def _mappings(ws: Workspace) -> tuple[DataFrame, dict[str, tuple[str, Column]]]:
    """Resolved rows, and per lookup the raw and the resolved column; a place that is still an id is not resolved."""
    rows = with_legal_status(ws.staged["applications_resolved"], ws.tables["application_legal_status"])
    rows = lookup(rows, ws.tables["categories"], "license_type", "name", {"__category": "id"})
    pairs = {"license_category": ("license_type", F.col("__category")), "legal_status": ("application_legal_status_raw", F.col("applicant_legal_status_id"))}
    return rows, pairs | {c: (c, F.when(~looks_like(c, "decimal"), F.col(c))) for c in ("region", "district", "ward")}


def unresolved_regions(ws: Workspace) -> DataFrame:
    """Staged rows whose region, district or ward is still an id."""
    return suspicious_rows(ws.staged["applications"], ["region", "district", "ward"], fixed.UNSIGNED_DECIMAL)


def staged_pairs(staged: DataFrame) -> list[Pair]:
    names = [c.removeprefix("__doc_") for c in staged.columns if c.startswith("__doc_")]
    return [Pair(f"__doc_{p.id_col}", f"__doc_{p.file_col}", p.label) for p in attachment_pairs(names)]


#: How columns of a known application are formed; all others take the value that arrives.
HUB_POLICY = {"created_by": KEEP, "is_migrated": constant(True), "category_license_type": KEEP}


def import_applications(
    ws: Workspace,
    feed: DataFrame,
    sector: str = "PETROLEUM",
    locations: Mapping[str, DataFrame] | None = None,
    zones: DataFrame | None = None,
    default_role: str | None = "DEFAULT ROLE",
    as_of: Moment = None,
) -> Workspace:
    """Merge an applications feed.

    `locations` maps region/district/ward to (id, name) tables; `zones` has region, zone_id.
    """
    staged = ws.hold("applications", lambda: stage(feed, locations))
    first = ws.hold("applications_first", lambda: first_per_number(staged()))
    provision_users(ws, staged, "username", default_role, as_of)
    categories = provision_categories(ws, staged, sector, as_of)
    sectors = ws.table("sectors", t.SECTORS)
    known = ws.table("applications", t.APPLICATIONS)
    rows = ws.hold("applications_resolved", lambda: approved_rows(first(), known()))

    def arrived() -> DataFrame:
        return hub_rows(first(), categories(), sectors(), zones, as_of)

    upsert(
        ws,
        "applications",
        t.APPLICATIONS,
        arrived,
        keys=["application_number"],
        policy=HUB_POLICY,
    )
    upsert(
        ws,
        "certificates",
        t.CERTIFICATES,
        lambda: certificate_rows(arrived(), known(), as_of),
        keys=["application_number"],
        policy={"application_id": OVERWRITE, "license_type": OVERWRITE, "category_license_type": OVERWRITE},
    )
    statuses = provision_legal_statuses(ws)
    upsert(ws, "application_sector_details", t.SECTOR_DETAILS, lambda: detail_rows(rows(), statuses(), as_of))
    facts = ("document_name", "file_name", "documents_order", "logic_doc_id", "application_sector_detail_id")
    upsert(ws, "documents", t.DOCUMENTS, lambda: document_rows(rows(), as_of), policy={c: KEEP for c in facts})
    # An application that already has such a child keeps it.
    upsert(ws, "contact_persons", t.CONTACT_PERSONS, lambda: contact_rows(rows(), as_of), ["app_sector_detail_id"], mode="insert")
    for name, schema, build in (("fire", t.FIRE, fire_rows), ("insurance_cover_details", t.INSURANCE, cover_rows)):
        source = functools.partial(lambda make: make(rows(), as_of), build)
        upsert(ws, name, schema, source, ["application_sector_detail_id"], mode="insert")
    return ws


def first_per_number(staged: DataFrame, key: ColumnOrName = "application_number") -> DataFrame:
    """The first row of each application; `key` is what makes two numbers the same."""
    numbered = staged.filter(F.col("application_number").isNotNull())
    return keep_first(numbered, [key], [F.col(ROW).asc_nulls_last()])


def resolved_id(rows: DataFrame, known: DataFrame, take: Mapping[str, str]) -> DataFrame:
    """Staged rows with ``application_id`` and columns of the hub as it was before this import.

    A known application keeps its id and a new one derives it from its number, so the children
    of an upload depend on the old hub only and never repeat its merge.
    """
    found = lookup(rows, known, "application_number", "application_number", {"__id": "id", **take}, normalise=None, unique=True)
    return found.withColumn("application_id", F.coalesce("__id", _application_key()))


def _application_key() -> Column:
    return stable_key(F.lit("application"), "application_number")


def approved_rows(first: DataFrame, known: DataFrame) -> DataFrame:
    """Staged rows of applications that have an approval number, staged or known, with their id."""
    rows = resolved_id(first, known, {"__approval": "approval_no"})
    return rows.filter(F.coalesce("approval_no", "__approval").isNotNull()).drop("__id", "__approval")


def provision_categories(ws: Workspace, staged: Deferred, sector: str, as_of: Moment) -> Deferred:
    """Fixed petroleum categories and all staged licence types exist as categories afterwards."""
    sectors, categories = ws.table("sectors", t.SECTORS), ws.table("categories", t.CATEGORIES)
    defaults = {"category_type": F.lit("License"), "is_approved": F.lit(True), "created_at": moment(as_of), "updated_at": moment(as_of)}

    def build() -> DataFrame:
        wanted = wanted_categories(staged(), sectors(), sector)
        return ensure_members(categories(), wanted, defaults, "category", extra=("sector_id",))

    return ws.put("categories", build)


def wanted_categories(staged: DataFrame, sectors: DataFrame, sector: str) -> DataFrame:
    named = staged.select(F.col("license_type").alias("name"), F.lit(sector).alias("sector_name"))
    wanted = named.filter(F.col("name").isNotNull()).distinct()
    # The fixed list belongs to the sector of this upload, petroleum when nothing was staged.
    listed = fixed_rows(staged.sparkSession, "name", fixed.PETROLEUM_CATEGORIES)
    if sector == "PETROLEUM":
        listed = listed.withColumn("sector_name", F.lit(sector))
    else:
        listed = listed.crossJoin(F.broadcast(max_or(wanted, "sector_name", "PETROLEUM", "sector_name")))
    both = lookup(listed.unionByName(wanted), sectors, "sector_name", "name", {"sector_id": "id"})
    return both.filter(F.col("sector_id").isNotNull())


def hub_rows(first: DataFrame, categories: DataFrame, sectors: DataFrame, zones: DataFrame | None, as_of: Moment) -> DataFrame:
    live = lookup(categories, sectors, "sector_id", "id", {"sector_name": "name"}, normalise=None)
    take = {"category_id": "id", "__kind": "category_type", "__sector": "sector_name"}
    rows = lookup(first, live, "license_type", "name", take)
    if zones is None:
        rows = rows.withColumn("zone_id", F.lit(None).cast("string"))
    else:
        rows = lookup(rows, zones, "region", "region", {"zone_id": "zone_id"})
    return stamped(
        rows.select(
            _application_key().alias("id"),
            "application_number",
            application_type("application_type").alias("application_type"),
            "approval_no",
            F.lit("APPROVED").alias("status"),
            "username",
            F.lit(True).alias("is_migrated"),
            "effective_date",
            "expire_date",
            F.col("completed_at").cast("timestamp").alias("completed_at"),
            "category_id",
            imported_license_type("__sector", "__kind").alias("license_type"),
            F.lit("OPERATIONAL").alias("category_license_type"),
            "zone_id",
            "old_parent_application_id",
            F.lower(cast_or("old_created_by", "string", pattern=fixed.UUID_SHAPE)).alias("created_by"),
        ),
        as_of,
    )


def certificate_rows(arrived: DataFrame, known: DataFrame, as_of: Moment) -> DataFrame:
    """Certificates of the rows that arrived for the hub, with the columns that its merge leaves them."""
    copied = (
        "approval_no",
        "approval_date",
        "effective_date",
        "expire_date",
        "intimate_date",
        "months_eligible",
        "licence_path",
        "license_type",
        "category_license_type",
        "zone_id",
        "zone_name",
    )
    rows = merged_rows(arrived, known, "application_number", ("id", "application_number", *copied), {"id": KEEP, **HUB_POLICY})
    return stamped(
        rows.select(
            stable_key(F.lit("certificate"), "application_number").alias("id"),
            F.col("id").alias("application_id"),
            "application_number",
            F.coalesce("application_type", F.lit("NEW")).alias("application_certificate_type"),
            *copied,
        ),
        as_of,
    )


def provision_legal_statuses(ws: Workspace) -> Deferred:
    """The fixed legal statuses exist afterwards."""
    known = ws.table("application_legal_status", t.LEGAL_STATUS)

    def build() -> DataFrame:
        wanted = fixed_rows(known().sparkSession, "name", fixed.LEGAL_STATUSES)
        return ensure_members(known(), wanted, {}, "legal_status")

    return ws.put("application_legal_status", build)


def with_legal_status(rows: DataFrame, statuses: DataFrame) -> DataFrame:
    """Add ``applicant_legal_status_id``: the status whose loosened label or synonym it is; an id stays."""
    live = statuses.filter(F.col("deleted_at").isNull()) if "deleted_at" in statuses.columns else statuses
    raw, synonym = label_key("application_legal_status_raw"), F.lit(None)
    for other, name in fixed.LEGAL_STATUS_SYNONYMS.items():
        synonym = F.when(raw == label_key(F.lit(other)), label_key(F.lit(name))).otherwise(synonym)
    keyed = rows.withColumn("__label", F.coalesce(synonym, raw))
    found = lookup(keyed, live.withColumn("__label", label_key("name")), "__label", "__label", {"__status": "id"}, normalise=None)
    uuid = F.lower(cast_or("application_legal_status_raw", "string", pattern=fixed.UUID_SHAPE))
    return found.withColumn("applicant_legal_status_id", F.coalesce(uuid, "__status")).drop("__label", "__status")


def detail_rows(rows: DataFrame, statuses: DataFrame, as_of: Moment) -> DataFrame:
    rows = with_legal_status(rows, statuses)
    return stamped(
        rows.select(
            F.col("application_id").alias("id"), "application_id", "applicant_legal_status_id", *t.ADDRESS, *t.BUSINESS
        ),
        as_of,
    )


def document_rows(rows: DataFrame, as_of: Moment) -> DataFrame:
    long = unpivot_pairs(rows, staged_pairs(rows), ["application_id"])
    return stamped(
        long.select(
            stable_key("application_id", F.lit("doc"), "document_name").alias("id"),
            "application_id",
            F.col("application_id").alias("application_sector_detail_id"),
            "document_name",
            "file_name",
            "documents_order",
            "logic_doc_id",
        ),
        as_of,
    )


def contact_rows(rows: DataFrame, as_of: Moment) -> DataFrame:
    fields = {"contact_name": "contact_name", "email": "contact_email", "mobile_no": "contact_mobile_no", "title": "contact_title"}
    return _child_rows(rows, fields, "app_sector_detail_id", "contact", as_of)


def fire_rows(rows: DataFrame, as_of: Moment) -> DataFrame:
    fields = {c: c if c.startswith("fire_") else f"fire_{c}" for c in t.FIRE_FIELDS}
    return _child_rows(rows, fields, "application_sector_detail_id", "fire", as_of)


def cover_rows(rows: DataFrame, as_of: Moment) -> DataFrame:
    return _child_rows(rows, {c: c for c in t.COVER_FIELDS}, "application_sector_detail_id", "insurance", as_of)


def _child_rows(rows: DataFrame, fields: Mapping[str, str], fk: str, seed: str, as_of: Moment) -> DataFrame:
    """Child rows where at least one of the fields is present."""
    present = rows.filter(any_present(*[F.col(c).cast("string") for c in fields.values()]))
    return stamped(
        present.select(
            stable_key("application_id", F.lit(seed)).alias("id"),
            "application_id",
            F.col("application_id").alias(fk),
            *[blank_to_null(F.col(source).cast("string")).alias(name) for name, source in fields.items()],
        ),
        as_of,
    )


def application_report(ws: Workspace, before: DataFrame) -> DataFrame:
    """One row: staged, already known by number or approval, duplicates inside the feed.

    Rows are flagged once and counted per key first, so the feed is read once, not once per figure.
    """
    staged = ws.staged["applications"].select("application_number", "approval_no")
    for key in ("application_number", "approval_no"):
        known = before.select(key).distinct()
        staged = lookup(staged, known, key, key, {f"__known_{key}": key}, normalise=None, unique=True)
    pairs = staged.groupBy("application_number", "approval_no").agg(
        F.count(F.lit(1)).alias("__n"),
        *[F.count(f"__known_{key}").alias(f"__known_{key}") for key in ("application_number", "approval_no")],
    )
    # Distinct values beside sums: the surplus is what is present less one for each value.
    return pairs.agg(
        F.coalesce(F.sum("__n"), F.lit(0)).alias("staged"),
        *[F.coalesce(F.sum(f"__known_{key}"), F.lit(0)).alias(f"existing_{key}") for key in ("application_number", "approval_no")],
        *[
            (F.coalesce(F.sum(F.when(F.col(key).isNotNull(), F.col("__n"))), F.lit(0)) - F.countDistinct(key)).alias(f"dup_{key}")
            for key in ("application_number", "approval_no")
        ],
    )


def staged_fill_rate(ws: Workspace, worst: int | None = None) -> DataFrame:
    staged = ws.staged["applications"]
    return fill_rate(staged, [c for c in staged.columns if c != ROW and not c.startswith("__doc_")], worst)
