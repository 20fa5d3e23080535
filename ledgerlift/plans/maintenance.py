"""Jobs that run after an import or on demand over the final tables."""

from __future__ import annotations

import logging
from collections.abc import Callable, Mapping
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlift.functions import blank_to_null, derived_license_type, looks_like, reminder_date
from ledgerlift.functions.text import key_text
from ledgerlift.operators.backfill import (
    CHANGED,
    ChangeSet,
    backfill,
    backfill_in_place,
    backfill_tables,
    drop_duplicate_approvals,
    update_where,
    user_of_application,
)
from ledgerlift.operators.joins import having, lookup, placed
from ledgerlift.operators.profile import breakdown
from ledgerlift.plans import tables as t
from ledgerlift.sources.colocated import Colocated
from ledgerlift.sources.store import Workspace

log = logging.getLogger(__name__)


def application_id_jobs(tables: Mapping[str, DataFrame], include_installations: bool = True) -> dict[str, ChangeSet]:
    """Children without an application id get it from their parent."""
    jobs = {}
    take = {"application_id": "application_id"}
    if "application_sector_details" in tables:
        jobs |= backfill_tables(tables, tables["application_sector_details"], t.DETAIL_CHILDREN, take)
    if include_installations and "application_electrical_installation" in tables:
        jobs |= backfill_tables(tables, tables["application_electrical_installation"], t.INSTALLATION_CHILDREN, take)
    return jobs


def created_by_jobs(tables: Mapping[str, DataFrame]) -> dict[str, ChangeSet]:
    """Rows without a creator get the user named on their application; one user map for all tables."""
    if "applications" not in tables or "users" not in tables:
        return {}
    known = user_of_application(tables["applications"], tables["users"])
    spec = {name: ("application_id", "application_id") for name in t.OWNED_BY_USER} | {"applications": ("id", "application_id")}
    return backfill_tables(tables, known, spec, {"created_by": "user_id"}, unique=True)


def colocated_created_by_jobs(stored: Colocated, users: DataFrame) -> dict[str, ChangeSet]:
    """`created_by_jobs` over tables stored by application id: the user map is dealt alike once, then no table is shuffled."""
    if "applications" not in stored.keys:
        return {}
    stored.put("creators", user_of_application(stored.read("applications"), users), "application_id")
    known, jobs = stored.keyed("creators"), {}
    for name, fk in stored.keys.items():
        if name not in (*t.OWNED_BY_USER, "applications") or fk != ("id" if name == "applications" else "application_id"):
            continue
        job = backfill_in_place(stored.keyed(name), known, fk, "application_id", {"created_by": "user_id"})
        # Rows without an application stay as they are.
        loose = stored.loose(name).withColumn(CHANGED, F.lit(False))
        jobs[name] = ChangeSet(job.candidates.unionByName(loose), job.columns)
    return jobs


def installation_ids_from_stage(installations: DataFrame, staged: DataFrame, applications: DataFrame) -> ChangeSet:
    """Installations that lost their application find it again by the number in the staged feed.

    `staged` holds the installation id and its application number.
    """
    numbers = lookup(staged, applications, "application_number", "application_number", {"application_id": "id"}, blank_to_null)
    return backfill(installations, numbers, "id", "id", {"application_id": "application_id"})


def certificate_by_approval(applications: DataFrame, certificates: DataFrame) -> ChangeSet:
    """Certificate id through the approval number; an existing other id is replaced."""
    return backfill(
        applications, certificates, "approval_no", "approval_no", {"certificate_id": "id"}, only_null=False, normalise=blank_to_null
    )


def reminder_dates(applications: DataFrame, categories: DataFrame) -> ChangeSet:
    """Licence categories: reminder six months before expiry where none is set."""
    licences = categories.filter(F.col("category_type") == "License").select("id").distinct()
    flagged = lookup(applications, licences, "category_id", "id", {"__licence": "id"}, normalise=None, unique=True)
    where = F.col("__licence").isNotNull() & F.col("intimate_date").isNull() & F.col("expire_date").isNotNull()
    job = update_where(flagged, {"intimate_date": reminder_date("expire_date")}, where)
    return ChangeSet(job.candidates, tuple(applications.columns))


def certificate_sector(certificates: DataFrame, applications: DataFrame, categories: DataFrame, sectors: DataFrame) -> ChangeSet:
    """Sector and type of a certificate from the category of its application."""
    kinds = lookup(categories, sectors, "sector_id", "id", {"__sector": "name"}, normalise=None)
    found = lookup(applications, kinds, "category_id", "id", {"__s": "__sector", "__k": "category_type"}, normalise=None)
    found = found.filter(F.col("__s").isNotNull())
    missing = F.col("sector").isNull() | F.col("certificate_type").isNull()
    return backfill(
        certificates, found, "application_id", "id", {"sector": "__s", "certificate_type": "__k"}, only_null=False, where=missing
    )


def fix_certificates(ws: Workspace) -> Workspace:
    categories, sectors = ws.table("categories", t.CATEGORIES), ws.table("sectors", t.SECTORS)
    applications, certificates = ws.table("applications", t.APPLICATIONS), ws.table("certificates", t.CERTIFICATES)
    reminded = ws.replace("applications", lambda: reminder_dates(applications(), categories()).apply())
    single = ws.replace("certificates", lambda: drop_duplicate_approvals(certificates()))
    linked = ws.replace("applications", lambda: certificate_by_approval(reminded(), single()).apply())
    ws.replace("certificates", lambda: certificate_sector(single(), linked(), categories(), sectors()).apply())
    return ws


def _with_derived(applications: DataFrame, categories: DataFrame, sectors: DataFrame) -> DataFrame:
    live = lookup(categories.filter(F.col("deleted_at").isNull()), sectors, "sector_id", "id", {"__sector": "name"}, normalise=None)
    live = live.filter(F.col("__sector").isNotNull())
    rows = lookup(applications, live, "category_id", "id", {"__s": "__sector", "__k": "category_type"}, normalise=None)
    return rows.withColumn("__new", derived_license_type("__s", "__k", "license_type"))


def sync_license_types(applications: DataFrame, categories: DataFrame, sectors: DataFrame) -> ChangeSet:
    """Licence type of an application follows the sector and type of its category."""
    rows = _with_derived(applications, categories, sectors)
    sets = {"license_type": F.col("__new"), "category_license_type": F.lit("OPERATIONAL")}
    differs = ~F.col("__new").eqNullSafe(F.col("license_type")) | ~F.col("category_license_type").eqNullSafe("OPERATIONAL")
    job = update_where(rows, sets, F.col("__s").isNotNull() & differs)
    return ChangeSet(job.candidates, tuple(applications.columns))


def license_type_breakdown(applications: DataFrame, categories: DataFrame, sectors: DataFrame) -> DataFrame:
    """What `sync_license_types` would set, by value."""
    rows = _with_derived(applications, categories, sectors).filter(F.col("__s").isNotNull())
    return breakdown(rows, {"new_license_type": "__new"}, "application_count")


def sync_certificate_types(certificates: DataFrame, applications: DataFrame) -> ChangeSet:
    """Certificates copy the licence type of their application, NULL included, where it differs."""
    take = {"__a": "id", "__lt": "license_type", "__clt": "category_license_type"}
    rows = lookup(certificates, applications, "application_id", "id", take, normalise=None, unique=True)
    differs = ~F.col("license_type").eqNullSafe(F.col("__lt")) | ~F.col("category_license_type").eqNullSafe(F.col("__clt"))
    sets = {"license_type": F.col("__lt"), "category_license_type": F.col("__clt")}
    job = update_where(rows, sets, F.col("__a").isNotNull() & differs)
    return ChangeSet(job.candidates, tuple(certificates.columns))


def region_names(contacts: DataFrame, regions: DataFrame) -> ChangeSet:
    """A region stored as an id becomes its name."""
    return backfill(contacts, regions, "region", "id", {"region": "name"}, only_null=False, where=looks_like("region", "uuid"))


def zones_through_details(applications: DataFrame, details: DataFrame, zones: DataFrame, only_null: bool = False) -> ChangeSet:
    """Zone of an application through the region of its sector detail."""
    return _zones(applications, details.select("application_id", "region"), zones, only_null)


def zones_through_installations(applications: DataFrame, installations: DataFrame, contacts: DataFrame, zones: DataFrame, only_null: bool = False) -> ChangeSet:
    """Zone of an application through the contact details of its installation."""
    owners = installations.select(F.col("id").alias("__aei"), F.col("application_id").alias("__app"))
    located = contacts.select("application_electrical_installation_id", "region").join(
        owners, F.col("application_electrical_installation_id") == F.col("__aei")
    )
    return _zones(applications, located.select(F.col("__app").alias("application_id"), "region"), zones, only_null)


def _zones(applications: DataFrame, regions: DataFrame, zones: DataFrame, only_null: bool) -> ChangeSet:
    found = lookup(regions, zones, "region", "region", {"__z": "zone_id", "__n": "zone_name"})
    found = found.filter(F.col("__z").isNotNull())
    return backfill(applications, found, "id", "application_id", {"zone_id": "__z", "zone_name": "__n"}, only_null=only_null)


def owners_from_creators(certificates: DataFrame, applications: DataFrame, users: DataFrame) -> ChangeSet:
    """Certificate owner from the creator of the application, if that user exists."""
    valid = having(applications.filter(F.col("created_by").isNotNull()), users, [("created_by", "id")])
    return backfill(certificates, valid, "application_id", "id", {"owner_id": "created_by"})


_LOCATION = ("region", "district", "street", "ward")


def _located(details: DataFrame) -> DataFrame:
    """Per application, the least value of each location column that any of its details has."""
    return details.groupBy("application_id").agg(*[F.min(c).alias(c) for c in _LOCATION])


def location_jobs(applications: DataFrame, details: DataFrame) -> ChangeSet:
    """Missing location columns, each from whichever detail of the application knows it."""
    return backfill(applications, _located(details), "id", "application_id", {c: c for c in _LOCATION}, unique=True)


def location_preview(applications: DataFrame, details: DataFrame) -> DataFrame:
    """Rows to fill per location column, and rows affected at all."""
    take = {f"__{c}": c for c in _LOCATION}
    rows = lookup(applications, _located(details), "id", "application_id", take, normalise=None, unique=True)
    gaps = {c: F.col(c).isNull() & F.col(f"__{c}").isNotNull() for c in _LOCATION}
    any_gap = F.lit(False)
    for gap in gaps.values():
        any_gap = any_gap | gap
    counts = [F.count_if(gap).alias(f"{c}_to_fill") for c, gap in gaps.items()]
    return rows.agg(*counts, F.count_if(any_gap).alias("total_affected"))


def categories_from_mapping(applications: DataFrame, mapping: DataFrame) -> ChangeSet:
    """Category through a mapping table (license_type, category_id)."""
    return backfill(applications, mapping, "license_type", "license_type", {"category_id": "category_id"}, only_null=False, normalise=key_text)


def enforce_migrated(applications: DataFrame, staged: DataFrame, classes: DataFrame) -> ChangeSet:
    """Uploaded applications are approved, flagged as migrated, and get a category if they have none."""
    uploaded = lookup(staged, classes, "class", "alias", {"__category": "category_id"}, normalise=None)
    take = {"__hit": F.lit(True), "__category": "__category"}
    rows = lookup(applications, uploaded, "application_number", "application_number", take, blank_to_null)
    category = F.coalesce("category_id", "__category")
    differs = (
        ~F.col("status").eqNullSafe("APPROVED")
        | ~F.col("is_migrated").eqNullSafe(True)
        | ~category.eqNullSafe(F.col("category_id"))
    )
    sets: dict[str, Column] = {"status": F.lit("APPROVED"), "is_migrated": F.lit(True), "category_id": category}
    job = update_where(rows, sets, F.col("__hit") & differs)
    return ChangeSet(job.candidates, tuple(applications.columns))


@dataclass(frozen=True)
class StepResult:
    name: str
    ok: bool
    detail: str = ""
    tables: int = 0
    rows: int = 0


def run_chain(steps: Mapping[str, Callable[[], object]]) -> list[StepResult]:
    """Run the steps in order; a failing one is recorded and the next still runs.

    A step may return the (table, number of changed rows) pairs it is responsible for.
    """
    results = []
    for name, step in steps.items():
        try:
            found = step()
            changed = found if isinstance(found, Mapping) else {}
            results.append(StepResult(name, True, tables=len(changed), rows=sum(changed.values())))
        except Exception as error:  # each step is optional by contract
            log.warning("post-import step %s failed: %s", name, error)
            results.append(StepResult(name, False, str(error)))
    return results


def post_import_jobs(tables: Mapping[str, DataFrame]) -> dict[str, dict[str, ChangeSet]]:
    """The repairs of `post_import`, by step and table; creators are set on the repaired tables.

    A row takes its place among the rows without a key along, so its id need not pass the first join.
    """
    ids = application_id_jobs(tables)
    kept = {**tables, **{name: placed(tables[name]) for name in ids}}
    creators = created_by_jobs({**kept, **{name: job.apply() for name, job in application_id_jobs(kept).items()}})
    return {"application_id": ids, "created_by": {name: replace(job, columns=tuple(tables[name].columns)) for name, job in creators.items()}}


def post_import(ws: Workspace, align: Callable[[], object] = lambda: None) -> list[StepResult]:
    """Schema alignment, application ids, creators, over all tables of the workspace and its store."""

    def apply(jobs: Callable[[], Mapping[str, ChangeSet]]) -> dict[str, int]:
        return {name: ws.change(name, lambda j=job: j.candidates, CHANGED) for name, job in jobs().items()}

    def aligned() -> None:
        align()

    return run_chain(
        {
            "align_schema": aligned,
            "application_id": lambda: apply(lambda: application_id_jobs(ws.all_tables())),
            "created_by": lambda: apply(lambda: created_by_jobs(ws.all_tables())),
        }
    )
