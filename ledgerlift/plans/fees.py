"""Licence categories with their fee slots."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlift.functions import blank_to_null, capacity_unit, cast_or, clean, key_text, parse_bool, stable_key, voltage_level
from ledgerlift.functions import fixed_values as fixed
from ledgerlift.operators.backfill import ChangeSet, backfill
from ledgerlift.operators.dedupe import keep_first
from ledgerlift.operators.joins import fan_out, having, lacking, lookup
from ledgerlift.operators.merge import ACTION, EITHER, INCOMING, KEEP, OVERWRITE, merge_into
from ledgerlift.plans import tables as t
from ledgerlift.plans.common import Moment, prepared, stamped
from ledgerlift.sources.grid import ROW, MissingColumns, require
from ledgerlift.sources.store import Workspace

REQUIRED = ("categoryorclass", "applicationtype", "appfee", "licencefee", "prefix", "licenseprefix")
OPTIONAL = (
    "licencetype",
    "nocustomerf",
    "nocustomerto",
    "annualfee",
    "has_fee_range",
    "apply_thereof",
    "thereof_factor",
    "thereof_price",
    "capacity_unit",
)
# Columns that may go by several names; the first one present is used.
ALTERNATIVES = {
    "capacity_from": ("acapacityfrom", "capacityfrom", "capacity_from"),
    "capacity_to": ("acapacityto", "capacityto", "capacity_to"),
    "months": ("licenseperiod_x", "licenseperiod"),
    "voltage_level": ("voltage_level", "voltagelevel"),
}
#: identity of a fee slot
SLOT = (
    "category_id",
    "application_type",
    "license_type",
    "no_customer_from",
    "no_customer_to",
    "capacity_from",
    "capacity_to",
    "application_prefix",
    "license_prefix",
    "months_eligible",
)
_FOLDED = ("application_type", "license_type", "application_prefix", "license_prefix")


def stage(feed: DataFrame, sector: str) -> DataFrame:
    feed = prepared(feed)
    required = list(REQUIRED) + (["licencetype"] if sector in ("ELECTRICITY", "PETROLEUM") else [])
    feed = require(feed, required, OPTIONAL)
    have = set(feed.columns)
    chosen = {name: next((c for c in options if c in have), None) for name, options in ALTERNATIVES.items()}
    if chosen["months"] is None:
        raise MissingColumns("missing required columns: ['licenseperiod_x' or 'licenseperiod']")
    named = [clean(source).alias(name) if source else F.lit(None).cast("string").alias(name) for name, source in chosen.items()]
    return feed.select(ROW, *[clean(c).alias(c) for c in (*REQUIRED, *OPTIONAL)], *named)


def category_rows(staged: DataFrame, sector: str, sector_id: Column, as_of: Moment) -> DataFrame:
    """One category per name of the feed, from its first row."""
    named = staged.filter(F.col("categoryorclass").isNotNull())
    first = keep_first(named, [key_text("categoryorclass")], [F.col(ROW).asc_nulls_last()])
    construction = F.lower(F.coalesce("licencetype", F.lit(""))).contains("construction")
    return stamped(
        first.select(
            stable_key(F.lit("category"), key_text("categoryorclass")).alias("id"),
            F.col("categoryorclass").alias("name"),
            F.coalesce("licenseprefix", "categoryorclass").alias("code"),
            sector_id.alias("sector_id"),
            F.lit("OPERATIONAL").alias("sub_sector_type"),
            F.when(construction, F.lit("Construction")).otherwise(F.lit("License")).alias("category_type"),
            F.lit(False).alias("is_approved"),
            parse_bool("has_fee_range").alias("has_fee_range"),
            parse_bool("apply_thereof").alias("apply_thereof"),
            cast_or("thereof_factor", "int", pattern=fixed.INTEGER).alias("thereof_factor"),
            cast_or("thereof_price", "decimal(11,2)", pattern=fixed.DECIMAL).alias("thereof_price"),
            capacity_unit("capacity_unit").alias("capacity_unit"),
            voltage_level("voltage_level", sector).alias("voltage_level"),
        ),
        as_of,
    )


def merge_categories(categories: DataFrame, source: DataFrame) -> DataFrame:
    """Upsert by name, ignoring case; deleted rows and further spellings of a name stay as they are."""
    live = categories.filter(F.col("deleted_at").isNull())
    heads = keep_first(live, [key_text("name")], [F.col("id").asc_nulls_last()])
    rest = lacking(categories, heads, [("id", "id")])
    policy = {c: KEEP for c in ("id", "code", "sector_id", "sub_sector_type", "category_type", "is_approved", "created_at")}
    policy |= {"has_fee_range": EITHER, "apply_thereof": EITHER, "name": OVERWRITE, "updated_at": OVERWRITE}
    merged = merge_into(heads, source, ["name"], policy, INCOMING, match_on={"name": key_text}, unique_source=True, plan="outer")
    return merged.unionByName(rest.withColumn(ACTION, F.lit("keep")))


def fee_rows(staged: DataFrame, categories: DataFrame, sector: str, as_of: Moment) -> DataFrame:
    """Typed fees, one per slot, for every spelling of the category name."""
    live = categories.filter(F.col("deleted_at").isNull())
    rows = fan_out(staged, live, "categoryorclass", "name", {"category_id": "id"})
    kind = F.lit("OPERATIONAL")
    if sector == "ELECTRICITY":
        kind = F.when(F.upper("licencetype").contains("PROVISIONAL"), F.lit("PROVISIONAL")).otherwise(kind)
    no_capacity = sector in fixed.NO_CAPACITY_SECTORS
    money = lambda c, default: cast_or(c, "decimal(38,6)", default, fixed.DECIMAL)
    typed = rows.select(
        ROW,
        "category_id",
        F.lit("NOT_ACTIVE").alias("status"),
        kind.alias("license_type"),
        kind.alias("category_license_type"),
        F.upper(F.coalesce("applicationtype", F.lit("NEW"))).alias("application_type"),
        F.col("nocustomerf").alias("no_customer_from"),
        F.col("nocustomerto").alias("no_customer_to"),
        money("capacity_from", None if no_capacity else fixed.DEFAULT_CAPACITY_FROM).alias("capacity_from"),
        (F.col("capacity_to") if no_capacity else F.coalesce("capacity_to", F.lit(fixed.DEFAULT_CAPACITY_TO))).alias("capacity_to"),
        money("appfee", fixed.DEFAULT_APPLICATION_FEE).alias("application_fee"),
        money("licencefee", fixed.DEFAULT_LICENSE_FEE).alias("license_fee"),
        money("annualfee", fixed.DEFAULT_ANNUAL_FEE).alias("annual_fee"),
        F.coalesce("prefix", F.lit(fixed.DEFAULT_APPLICATION_PREFIX)).alias("application_prefix"),
        F.coalesce("licenseprefix", F.lit(fixed.DEFAULT_LICENSE_PREFIX)).alias("license_prefix"),
        cast_or("months", "bigint", fixed.DEFAULT_MONTHS, fixed.DECIMAL).alias("months_eligible"),
        F.lit(sector).alias("sector_type"),
    )
    slot = [slot_form(c)(F.col(c)) for c in SLOT]
    first = keep_first(typed, slot, [F.col(ROW).asc_nulls_last()]).drop(ROW)
    return stamped(first.withColumn("id", stable_key(F.lit("fee"), *slot)), as_of)


def slot_form(column: str):
    """How a slot column compares: names fold case, blank text equals NULL, NULL equals NULL."""
    if column in _FOLDED:
        return key_text
    if column in ("no_customer_from", "no_customer_to", "capacity_to"):
        return blank_to_null
    return lambda c: c


def merge_fees(fees: DataFrame, source: DataFrame) -> DataFrame:
    """Upsert on the slot; a matched slot takes all values of the feed but keeps id and status."""
    live, gone = fees.filter(F.col("deleted_at").isNull()), fees.filter(F.col("deleted_at").isNotNull())
    policy = {c: OVERWRITE for c in source.columns} | {c: KEEP for c in ("id", "status", "created_at")}
    merged = merge_into(live, source, list(SLOT), policy, match_on={c: slot_form(c) for c in SLOT}, unique_source=True, plan="outer")
    return merged.unionByName(gone.withColumn(ACTION, F.lit("keep")))


def link_variants(categories: DataFrame, fees: DataFrame) -> ChangeSet:
    """Point a category without fees to a spelling of the same name that has them."""
    live = fees.filter(F.col("deleted_at").isNull())
    charged = live.select(F.col("category_id").alias("__charged")).distinct()
    flagged = lookup(categories, charged, "id", "__charged", {"__charged": "__charged"}, normalise=None, unique=True)
    priced = having(categories.filter(F.col("deleted_at").isNull()), live, [("id", "category_id")])
    empty = F.col("__charged").isNull() & F.col("deleted_at").isNull()
    job = backfill(flagged, priced, "name", "name", {"fees_category_id": "id"}, normalise=key_text, where=empty)
    return ChangeSet(job.candidates, tuple(categories.columns))


def import_categories_and_fees(ws: Workspace, feed: DataFrame, sector: str, sector_id: str | None = None, as_of: Moment = None) -> Workspace:
    """`sector` is the registry's sector name, for example ``ELECTRICITY``."""
    rows = stage(feed, sector)
    sectors = ws.table("sectors", t.SECTORS)
    if sector_id is None:
        # One value: the id of the sector this upload belongs to.
        sector_id = sectors().filter(key_text("name") == sector.lower()).agg(F.min("id").alias("id")).first()["id"]
    staged = ws.hold("license_categories", lambda: rows)
    known, charged = ws.table("categories", t.CATEGORIES), ws.table("application_category_fees", t.FEES)
    owner = F.lit(sector_id).cast("string")
    categories = ws.put("categories", lambda: merge_categories(known(), category_rows(staged(), sector, owner, as_of)))
    merged = ws.put("application_category_fees", lambda: merge_fees(charged(), fee_rows(staged(), categories(), sector, as_of)))
    ws.replace("categories", lambda: link_variants(categories(), merged()).apply())
    return ws
