"""Backfills, provisioning, ownership and schema jobs over the given tables."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlift.operators import backfill as b
from ledgerlift.operators import ownership as own
from ledgerlift.operators import provision as p
from ledgerlift.operators import schema
from ledgerlift.plans import electrical, maintenance as m
from ledgerlift.session import scratch_folder
from ledgerlift.sources import dimensions
from ledgerlift.sources.colocated import Colocated
from workload.registry import Tables, query

_UUID = "regexp_replace(md5({0}), '^(.{{8}})(.{{4}})(.{{4}})(.{{4}})(.{{12}})$', '\\1-\\2-\\3-\\4-\\5')"


def uuid_sql(text: str) -> str:
    return _UUID.format(text)


# --- ids and creators -----------------------------------------------------------------------------


def _details(t: Tables):
    return t.orders.select(F.concat(F.lit("D"), "o_orderkey").alias("id"), F.col("o_custkey").alias("application_id"))


def _documents(t: Tables):
    """Line items as documents: a third without application, some of these without a parent."""
    fk = F.when(F.col("l_linestatus") == "F", F.concat(F.lit("D"), "l_orderkey"))
    app = F.when(F.col("l_returnflag") != "R", F.col("l_partkey"))
    return t.lineitem.select("l_orderkey", "l_linenumber", "l_suppkey", "l_quantity", fk.alias("application_sector_detail_id"), app.alias("application_id"))


_DOCUMENTS_SQL = """d AS (SELECT l_orderkey, l_linenumber, l_suppkey, l_quantity, CASE WHEN l_linestatus = 'F' THEN 'D' || l_orderkey END AS application_sector_detail_id,
    CASE WHEN l_returnflag <> 'R' THEN l_partkey END AS application_id FROM lineitem)"""


@query(
    "backfill_fk",
    f"""WITH {_DOCUMENTS_SQL} SELECT d.* REPLACE (coalesce(application_id, o_custkey) AS application_id) FROM d
      LEFT JOIN orders ON application_sector_detail_id = 'D' || o_orderkey""",
)
def backfill_fk(t: Tables):
    tables = {"application_sector_details": _details(t), "documents": _documents(t)}
    return m.application_id_jobs(tables)["documents"].apply()


@query(
    "backfill_preview",
    f"""WITH {_DOCUMENTS_SQL} SELECT 'documents' AS table_name, count(*) AS rows_to_change FROM d JOIN orders ON application_sector_detail_id = 'D' || o_orderkey
        WHERE application_id IS NULL
      UNION ALL SELECT 'fire', count(*) FROM orders WHERE o_orderstatus = 'P'""",
)
def backfill_preview(t: Tables):
    """Counts per table of what apply would change."""
    fire = t.orders.select(
        F.concat(F.lit("D"), "o_orderkey").alias("application_sector_detail_id"),
        F.when(F.col("o_orderstatus") != "P", F.col("o_custkey")).alias("application_id"),
    )
    tables = {"application_sector_details": _details(t), "documents": _documents(t), "fire": fire}
    return b.preview_all(m.application_id_jobs(tables))


@query(
    "backfill_created_by",
    """SELECT l_orderkey AS application_id, l_linenumber, l_partkey, CASE WHEN l_returnflag = 'R' THEN CAST(c_custkey AS VARCHAR) ELSE 'old' END AS created_by
    FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey LEFT JOIN customer ON c_custkey = o_custkey AND o_orderstatus <> 'P'""",
)
def backfill_created_by(t: Tables):
    """User of the application by name, ignoring case and blanks."""
    return m.created_by_jobs(_created(t))["documents"].apply()


def _created(t: Tables):
    name = F.concat(F.lit(" CUSTOMER#"), F.lpad(F.col("o_custkey").cast("string"), 9, "0"))
    applications = t.orders.select(
        F.col("o_orderkey").alias("id"),
        F.when(F.col("o_orderstatus") != "P", name).alias("username"),
        F.lit("someone").alias("created_by"),
    )
    users = t.customer.select(F.col("c_custkey").cast("string").alias("id"), F.col("c_name").alias("username"))
    documents = t.lineitem.select(
        F.col("l_orderkey").alias("application_id"),
        "l_linenumber",
        "l_partkey",
        F.when(F.col("l_returnflag") != "R", F.lit("old")).alias("created_by"),
    )
    return {"applications": applications, "users": users, "documents": documents}


@query(
    "backfill_colocated",
    """SELECT 'documents' AS table_name, CAST(l_orderkey AS VARCHAR) || '.' || l_linenumber AS row_key, CASE WHEN l_returnflag = 'R' THEN CAST(c_custkey AS VARCHAR) ELSE 'old' END AS created_by
    FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey AND l_linestatus = 'F' LEFT JOIN customer ON c_custkey = o_custkey AND o_orderstatus <> 'P'
    UNION ALL SELECT 'applications', CAST(o_orderkey AS VARCHAR), 'someone' FROM orders""",
)
def backfill_colocated(t: Tables):
    """The same over tables stored in equal buckets; half of the documents have no application."""
    tables = _created(t)
    stored = Colocated(t.spark, scratch_folder(t.spark, "colocated"), f"c{uuid.uuid4().hex}", buckets=16)
    stored.put("applications", tables["applications"], "id")
    key = F.concat_ws(".", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string"))
    documents = t.lineitem.select(
        key.alias("row_key"),
        F.when(F.col("l_linestatus") == "F", F.col("l_orderkey")).alias("application_id"),
        F.when(F.col("l_returnflag") != "R", F.lit("old")).alias("created_by"),
    )
    stored.put("documents", documents, "application_id")
    jobs = m.colocated_created_by_jobs(stored, tables["users"])
    found = jobs["documents"].apply().select(F.lit("documents").alias("table_name"), "row_key", "created_by")
    return found.unionByName(jobs["applications"].apply().select(F.lit("applications").alias("table_name"), F.col("id").cast("string").alias("row_key"), "created_by"))


@query(
    "installation_ids_from_stage",
    """SELECT o_orderkey AS id, CASE WHEN o_orderstatus = 'O' THEN o_custkey WHEN o_orderstatus = 'F' THEN c_custkey END AS application_id
    FROM orders LEFT JOIN customer ON c_custkey = o_custkey AND c_nationkey > 3""",
)
def installation_ids_from_stage(t: Tables):
    """Installations that lost their application find it by the number in the staged feed; a third never had a number."""
    lost = t.orders.select(F.col("o_orderkey").alias("id"), F.when(F.col("o_orderstatus") == "O", F.col("o_custkey")).alias("application_id"))
    number = F.when(F.col("o_orderstatus") != "P", F.concat(F.lit(" EL-"), "o_custkey"))
    staged = t.orders.select(F.col("o_orderkey").alias("id"), number.alias("application_number"))
    hub = t.customer.where("c_nationkey > 3").select(F.col("c_custkey").alias("id"), F.concat(F.lit("EL-"), "c_custkey").alias("application_number"))
    return m.installation_ids_from_stage(lost, staged, hub).apply()


@query(
    "certificate_ids",
    """SELECT c_custkey AS id, c_nationkey > 5 AS is_migrated,
      CASE WHEN c_nationkey > 20 THEN 'old' WHEN c_nationkey > 5 THEN CAST(o AS VARCHAR) END AS certificate_id
    FROM customer LEFT JOIN (SELECT o_custkey, min(CAST(o_orderkey AS VARCHAR)) AS o FROM orders GROUP BY 1) ON o_custkey = c_custkey""",
)
def certificate_ids(t: Tables):
    applications = t.customer.select(
        F.col("c_custkey").alias("id"),
        (F.col("c_nationkey") > 5).alias("is_migrated"),
        F.when(F.col("c_nationkey") > 20, F.lit("old")).alias("certificate_id"),
    )
    certificates = t.orders.select(F.col("o_orderkey").cast("string").alias("id"), F.col("o_custkey").alias("application_id"))
    return electrical.certificate_ids(applications, certificates).apply()


@query(
    "certificate_by_approval",
    """SELECT c_custkey AS id, CASE WHEN c_nationkey > 3 THEN ' LIC-' || c_custkey END AS approval_no,
      CASE WHEN c_nationkey > 3 THEN coalesce(o, 'old') ELSE 'old' END AS certificate_id
    FROM customer LEFT JOIN (SELECT o_custkey, min(CAST(o_orderkey AS VARCHAR)) AS o FROM orders WHERE o_orderpriority = '1-URGENT' GROUP BY 1) ON o_custkey = c_custkey""",
)
def certificate_by_approval(t: Tables):
    applications = t.customer.select(
        F.col("c_custkey").alias("id"),
        F.when(F.col("c_nationkey") > 3, F.concat(F.lit(" LIC-"), "c_custkey")).alias("approval_no"),
        F.lit("old").alias("certificate_id"),
    )
    approval = F.when(F.col("o_orderpriority") == "1-URGENT", F.concat(F.lit("LIC-"), "o_custkey"))
    certificates = t.orders.select(F.col("o_orderkey").cast("string").alias("id"), approval.alias("approval_no"))
    return m.certificate_by_approval(applications, certificates).apply()


# --- places -----------------------------------------------------------------------------------------


def _zones(t: Tables):
    regions = t.nation.select(F.col("n_name").alias("name"), F.col("n_regionkey").cast("string").alias("zone_id"))
    zones = t.region.select(F.col("r_regionkey").cast("string").alias("id"), F.col("r_name").alias("name"))
    return dimensions.zone_map(regions, zones)


def _zoned_applications(t: Tables):
    return t.orders.select(
        F.col("o_orderkey").alias("id"),
        F.when(F.col("o_orderstatus") == "P", F.lit("9")).alias("zone_id"),
        F.when(F.col("o_orderstatus") == "P", F.lit("OLD")).alias("zone_name"),
    )


def _order_regions(t: Tables):
    customers = t.customer.select("c_custkey", F.concat(F.lit("NATION_"), "c_nationkey").alias("region"))
    return t.orders.join(customers, F.col("o_custkey") == F.col("c_custkey"))


_ZONE_JOIN = """FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON n_nationkey = c_nationkey JOIN region ON r_regionkey = n_regionkey"""


@query(
    "zone_backfill",
    f"SELECT o_orderkey AS id, CAST(r_regionkey AS VARCHAR) AS zone_id, r_name AS zone_name {_ZONE_JOIN}",
)
def zone_backfill(t: Tables):
    """Through sector details; a found zone replaces another one."""
    details = _order_regions(t).select(F.col("o_orderkey").alias("application_id"), "region")
    return m.zones_through_details(_zoned_applications(t), details, _zones(t)).apply()


@query(
    "zone_backfill_electrical",
    f"""SELECT o_orderkey AS id, CASE WHEN o_orderstatus = 'P' THEN '9' ELSE CAST(r_regionkey AS VARCHAR) END AS zone_id,
      CASE WHEN o_orderstatus = 'P' THEN 'OLD' ELSE r_name END AS zone_name {_ZONE_JOIN}""",
)
def zone_backfill_electrical(t: Tables):
    """Through installations and their contacts; only where still missing."""
    rows = _order_regions(t)
    installations = rows.select(F.concat(F.lit("I"), "o_orderkey").alias("id"), F.col("o_orderkey").alias("application_id"))
    contacts = rows.select(F.concat(F.lit("I"), "o_orderkey").alias("application_electrical_installation_id"), "region")
    return m.zones_through_installations(_zoned_applications(t), installations, contacts, _zones(t), only_null=True).apply()


@query("region_names", "SELECT c_custkey, n_name AS region FROM customer JOIN nation ON n_nationkey = c_nationkey")
def region_names(t: Tables):
    """Regions stored as ids become names."""
    uuid = F.expr("regexp_replace(md5(cast({} as string)), '^(.{{8}})(.{{4}})(.{{4}})(.{{4}})(.{{12}})$', '$1-$2-$3-$4-$5')".format("c_nationkey"))
    region = F.when(F.col("c_mktsegment") == "BUILDING", uuid).otherwise(F.concat(F.lit("NATION_"), "c_nationkey"))
    contacts = t.customer.select("c_custkey", region.alias("region"))
    from ledgerlift.functions import stable_key

    regions = t.nation.select(stable_key("n_nationkey").alias("id"), F.col("n_name").alias("name"))
    return m.region_names(contacts, regions).apply()


def _located(t: Tables):
    nation = F.col("c_nationkey")
    applications = t.customer.select(
        F.col("c_custkey").alias("id"),
        F.when(nation > 5, F.lit("r")).alias("region"),
        F.when(nation > 10, F.lit("d")).alias("district"),
        F.when(nation > 15, F.lit("s")).alias("street"),
        F.when(nation > 20, F.lit("w")).alias("ward"),
    )
    # Two details an application and more, of which some are empty.
    key, held = F.col("s_suppkey"), F.col("s_nationkey")
    details = t.supplier.select(
        (key % 40).alias("application_id"),
        F.when(key % 3 != 0, F.col("s_name")).alias("region"),
        F.when(held > 12, F.concat(F.lit("D"), key % 7)).alias("district"),
        F.when(key % 2 == 0, F.lit("S")).alias("street"),
        F.when(held < 8, F.concat(F.lit("W"), "s_nationkey")).alias("ward"),
    )
    return applications, details


_LOCATED_SQL = """a AS (SELECT c_custkey AS id, CASE WHEN c_nationkey > 5 THEN 'r' END AS region, CASE WHEN c_nationkey > 10 THEN 'd' END AS district,
      CASE WHEN c_nationkey > 15 THEN 's' END AS street, CASE WHEN c_nationkey > 20 THEN 'w' END AS ward FROM customer),
    x AS (SELECT s_suppkey % 40 AS application_id, min(CASE WHEN s_suppkey % 3 <> 0 THEN s_name END) AS region,
      min(CASE WHEN s_nationkey > 12 THEN 'D' || s_suppkey % 7 END) AS district, min(CASE WHEN s_suppkey % 2 = 0 THEN 'S' END) AS street,
      min(CASE WHEN s_nationkey < 8 THEN 'W' || s_nationkey END) AS ward FROM supplier GROUP BY 1)"""


@query(
    "location_backfill",
    f"""WITH {_LOCATED_SQL} SELECT id, coalesce(a.region, x.region) AS region, coalesce(a.district, x.district) AS district,
      coalesce(a.street, x.street) AS street, coalesce(a.ward, x.ward) AS ward FROM a LEFT JOIN x ON application_id = id""",
)
def location_backfill(t: Tables):
    return m.location_jobs(*_located(t)).apply()


@query(
    "location_preview",
    f"""WITH {_LOCATED_SQL} SELECT count(*) FILTER (a.region IS NULL AND x.region IS NOT NULL) AS region_to_fill,
      count(*) FILTER (a.district IS NULL AND x.district IS NOT NULL) AS district_to_fill,
      count(*) FILTER (a.street IS NULL AND x.street IS NOT NULL) AS street_to_fill,
      count(*) FILTER (a.ward IS NULL AND x.ward IS NOT NULL) AS ward_to_fill,
      count(*) FILTER ((a.region IS NULL AND x.region IS NOT NULL) OR (a.district IS NULL AND x.district IS NOT NULL)
        OR (a.street IS NULL AND x.street IS NOT NULL) OR (a.ward IS NULL AND x.ward IS NOT NULL)) AS total_affected
    FROM a LEFT JOIN x ON application_id = id""",
)
def location_preview(t: Tables):
    return m.location_preview(*_located(t))


# --- post-import ----------------------------------------------------------------------------------------


def _registry(t: Tables):
    """Orders as applications; sector details and documents, some without their application or creator."""
    status = F.col("o_orderstatus")
    applications = t.orders.select(
        F.concat(F.lit("A"), "o_orderkey").alias("id"),
        F.concat(F.lit(" Nation_"), F.col("o_custkey") % 30).alias("username"),
        F.when(status == "P", F.lit("boss")).alias("created_by"),
    )
    users = t.nation.select(F.col("n_nationkey").cast("string").alias("id"), F.concat(F.lit("nation_"), "n_nationkey").alias("username"))
    details = t.orders.select(F.concat(F.lit("D"), "o_orderkey").alias("id"), F.when(status != "F", F.concat(F.lit("A"), "o_orderkey")).alias("application_id"))
    documents = t.lineitem.select(
        F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate").alias("id"),
        F.when(F.col("l_quantity") > 5, F.concat(F.lit("D"), "l_orderkey")).alias("application_sector_detail_id"),
        F.when(F.col("l_returnflag") == "R", F.lit("known")).alias("application_id"),
        F.when(F.col("l_linestatus") == "O", F.lit("clerk")).alias("created_by"),
    )
    return {"applications": applications, "users": users, "application_sector_details": details, "documents": documents}


_REGISTRY_SQL = """u AS (SELECT o_orderkey, o_orderstatus, CASE WHEN o_custkey % 30 < 25 THEN CAST(o_custkey % 30 AS VARCHAR) END AS uid FROM orders),
    d AS (SELECT CASE WHEN l_returnflag = 'R' THEN 'known' WHEN l_quantity > 5 AND o_orderstatus <> 'F' THEN 'A' || l_orderkey END AS application_id,
        l_returnflag, l_linestatus, uid FROM lineitem LEFT JOIN u ON o_orderkey = l_orderkey),
    f AS (SELECT *, CASE WHEN l_linestatus = 'O' THEN 'clerk' WHEN application_id LIKE 'A%' THEN uid END AS created_by FROM d)"""


@query(
    "post_import",
    f"""WITH {_REGISTRY_SQL} SELECT 'applications' AS table_name, 'A' || o_orderkey AS application_id, CASE WHEN o_orderstatus = 'P' THEN 'boss' ELSE uid END AS created_by, count(*) AS n
      FROM u GROUP BY ALL UNION ALL SELECT 'documents', application_id, created_by, count(*) FROM f GROUP BY ALL""",
)
def post_import(t: Tables):
    """Application ids through the sector detail, then creators through the repaired ids."""
    jobs = m.post_import_jobs(_registry(t))
    applications = jobs["created_by"]["applications"].apply().select(F.lit("applications").alias("table_name"), F.col("id").alias("application_id"), "created_by")
    documents = jobs["created_by"]["documents"].apply().select(F.lit("documents").alias("table_name"), "application_id", "created_by")
    return applications.unionByName(documents).groupBy("table_name", "application_id", "created_by").agg(F.count("*").alias("n"))


@query(
    "post_import_preview",
    f"""WITH {_REGISTRY_SQL} SELECT 'application_id' AS step, 'documents' AS table_name, count(*) FILTER (application_id LIKE 'A%') AS rows_to_change FROM d
      UNION ALL SELECT 'created_by', 'applications', count(*) FILTER (o_orderstatus <> 'P' AND uid IS NOT NULL) FROM u
      UNION ALL SELECT 'created_by', 'documents', count(*) FILTER (l_linestatus <> 'O' AND created_by IS NOT NULL) FROM f""",
)
def post_import_preview(t: Tables):
    parts = [b.preview_all(jobs).withColumn("step", F.lit(step)) for step, jobs in m.post_import_jobs(_registry(t)).items()]
    return parts[0].unionByName(parts[1]).select("step", "table_name", "rows_to_change")


# --- certificates and categories ------------------------------------------------------------------------


@query(
    "owner_backfill",
    """SELECT o_orderkey AS id, o_custkey AS application_id,
      CASE WHEN o_orderstatus = 'P' THEN 'old' ELSE CAST(s_suppkey AS VARCHAR) END AS owner_id
    FROM orders LEFT JOIN supplier ON s_suppkey = o_custkey""",
)
def owner_backfill(t: Tables):
    """Only creators that exist as users (here: suppliers) become owners."""
    certificates = t.orders.select(
        F.col("o_orderkey").alias("id"),
        F.col("o_custkey").alias("application_id"),
        F.when(F.col("o_orderstatus") == "P", F.lit("old")).alias("owner_id"),
    )
    applications = t.customer.select(F.col("c_custkey").alias("id"), F.col("c_custkey").cast("string").alias("created_by"))
    users = t.supplier.select(F.col("s_suppkey").cast("string").alias("id"))
    return m.owners_from_creators(certificates, applications, users).apply()


def _categories(t: Tables):
    """Nations as categories of five sectors (the regions)."""
    names = ("PETROLEUM", "NATURAL_GAS", "ELECTRICITY", "WATER_SUPPLY", "OTHER")
    sector = F.element_at(F.array(*[F.lit(n) for n in names]), F.col("r_regionkey") + 1)
    sectors = t.region.select(F.col("r_regionkey").cast("string").alias("id"), sector.alias("name"))
    kind = F.when(F.col("n_nationkey") > 12, F.lit("Construction")).otherwise(F.lit("License"))
    categories = t.nation.select(
        F.col("n_nationkey").cast("string").alias("id"),
        F.col("n_name").alias("name"),
        F.col("n_regionkey").cast("string").alias("sector_id"),
        kind.alias("category_type"),
        F.when(F.col("n_nationkey") == 3, F.lit("2020-01-01").cast("timestamp")).alias("deleted_at"),
    )
    return categories, sectors


_CATEGORIES_SQL = """c AS (SELECT CAST(n_nationkey AS VARCHAR) AS id, n_name AS name, CASE WHEN n_nationkey > 12 THEN 'Construction' ELSE 'License' END AS kind,
      CASE n_regionkey WHEN 0 THEN 'PETROLEUM' WHEN 1 THEN 'NATURAL_GAS' WHEN 2 THEN 'ELECTRICITY' WHEN 3 THEN 'WATER_SUPPLY' ELSE 'OTHER' END AS sector,
      n_nationkey = 3 AS deleted FROM nation)"""


def _licensed(t: Tables):
    kind = F.when(F.col("c_mktsegment") == "BUILDING", F.lit("LICENSE_ELECTRICITY_INSTALLATION")).when(
        F.col("c_mktsegment") == "MACHINERY", F.lit("LICENSE_PETROLEUM")
    )
    return t.customer.select(
        F.col("c_custkey").alias("id"),
        F.col("c_nationkey").cast("string").alias("category_id"),
        kind.alias("license_type"),
        F.when(F.col("c_mktsegment") != "FURNITURE", F.lit("OPERATIONAL")).alias("category_license_type"),
    )


_LICENSED_SQL = """a AS (SELECT c_custkey AS id, CAST(c_nationkey AS VARCHAR) AS category_id,
      CASE c_mktsegment WHEN 'BUILDING' THEN 'LICENSE_ELECTRICITY_INSTALLATION' WHEN 'MACHINERY' THEN 'LICENSE_PETROLEUM' END AS license_type,
      CASE WHEN c_mktsegment <> 'FURNITURE' THEN 'OPERATIONAL' END AS category_license_type FROM customer),
    n AS (SELECT a.*, c.id AS cat, CASE WHEN sector = 'ELECTRICITY' AND license_type = 'LICENSE_ELECTRICITY_INSTALLATION' THEN license_type
      WHEN sector IN ('PETROLEUM', 'NATURAL_GAS') AND kind = 'Construction' THEN 'CONSTRUCTION_' || sector
      WHEN sector IN ('PETROLEUM', 'NATURAL_GAS') THEN 'LICENSE_' || sector
      WHEN sector = 'WATER_SUPPLY' AND kind = 'License' THEN 'LICENSE_WATER'
      WHEN sector = 'ELECTRICITY' AND kind = 'License' THEN 'LICENSE_ELECTRICITY_SUPPLY' ELSE license_type END AS derived
      FROM a LEFT JOIN c ON c.id = category_id AND NOT deleted)"""


@query(
    "sync_license_type",
    f"""WITH {_CATEGORIES_SQL}, {_LICENSED_SQL} SELECT id, category_id, derived AS license_type,
      CASE WHEN cat IS NULL THEN category_license_type ELSE 'OPERATIONAL' END AS category_license_type FROM n""",
)
def sync_license_type(t: Tables):
    return m.sync_license_types(_licensed(t), *_categories(t)).apply()


@query(
    "license_type_breakdown",
    f"""WITH {_CATEGORIES_SQL}, {_LICENSED_SQL} SELECT derived AS new_license_type, count(*) AS application_count FROM n WHERE cat IS NOT NULL
      GROUP BY 1 ORDER BY 1 NULLS LAST""",
)
def license_type_breakdown(t: Tables):
    return m.license_type_breakdown(_licensed(t), *_categories(t))


@query(
    "sync_certificate_type",
    f"""WITH {_CATEGORIES_SQL}, {_LICENSED_SQL} SELECT o_orderkey AS id, o_custkey AS application_id, license_type, category_license_type
      FROM orders JOIN a ON a.id = o_custkey""",
)
def sync_certificate_type(t: Tables):
    certificates = t.orders.select(
        F.col("o_orderkey").alias("id"),
        F.col("o_custkey").alias("application_id"),
        F.lit("LICENSE_PETROLEUM").alias("license_type"),
        F.lit(None).cast("string").alias("category_license_type"),
    )
    return m.sync_certificate_types(certificates, _licensed(t)).apply()


@query(
    "certificate_sector",
    f"""WITH {_CATEGORIES_SQL} SELECT o_orderkey AS id, o_custkey AS application_id,
      CASE WHEN o_orderstatus = 'F' THEN 'old' ELSE sector END AS sector, CASE WHEN o_orderstatus = 'F' THEN 'old' ELSE kind END AS certificate_type
    FROM orders JOIN customer ON c_custkey = o_custkey JOIN c ON c.id = CAST(c_nationkey AS VARCHAR)""",
)
def certificate_sector(t: Tables):
    certificates = t.orders.select(
        F.col("o_orderkey").alias("id"),
        F.col("o_custkey").alias("application_id"),
        F.when(F.col("o_orderstatus") != "O", F.lit("old")).alias("sector"),
        F.when(F.col("o_orderstatus") == "F", F.lit("old")).alias("certificate_type"),
    )
    return m.certificate_sector(certificates, _licensed(t), *_categories(t)).apply()


@query(
    "category_from_mapping",
    """SELECT c_custkey AS id, c_mktsegment AS license_type, CASE c_mktsegment WHEN 'BUILDING' THEN '1' WHEN 'MACHINERY' THEN '2' ELSE 'old' END AS category_id FROM customer""",
)
def category_from_mapping(t: Tables):
    applications = t.customer.select(
        F.col("c_custkey").alias("id"), F.col("c_mktsegment").alias("license_type"), F.lit("old").alias("category_id")
    )
    mapping = t.spark.sql("SELECT * FROM VALUES (' building', '1'), ('Machinery', '2') AS m(license_type, category_id)")
    return m.categories_from_mapping(applications, mapping).apply()


@query(
    "reminder_backfill",
    f"""WITH {_CATEGORIES_SQL} SELECT o_orderkey AS id, CAST(c_nationkey AS VARCHAR) AS category_id, CAST(o_orderdate AS DATE) AS expire_date,
      CASE WHEN o_orderstatus = 'P' THEN DATE '2000-01-01' WHEN kind = 'License' THEN CAST(CAST(o_orderdate AS DATE) - INTERVAL 6 MONTH AS DATE) END AS intimate_date
    FROM orders JOIN customer ON c_custkey = o_custkey JOIN c ON c.id = CAST(c_nationkey AS VARCHAR)""",
)
def reminder_backfill(t: Tables):
    rows = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
    applications = rows.select(
        F.col("o_orderkey").alias("id"),
        F.col("c_nationkey").cast("string").alias("category_id"),
        F.col("o_orderdate").cast("date").alias("expire_date"),
        F.when(F.col("o_orderstatus") == "P", F.lit("2000-01-01").cast("date")).alias("intimate_date"),
    )
    return m.reminder_dates(applications, _categories(t)[0]).apply()


@query(
    "drop_duplicate_approvals",
    """WITH c AS (SELECT o_orderkey AS id, CASE WHEN o_orderpriority <> '5-LOW' THEN 'LIC-' || o_custkey END AS approval_no,
      CASE WHEN o_orderstatus <> 'P' THEN CAST(o_orderdate AS DATE) END AS expire_date, CAST(o_orderdate AS DATE) AS created_at FROM orders)
    SELECT * FROM c QUALIFY approval_no IS NULL OR row_number() OVER (PARTITION BY approval_no
      ORDER BY expire_date DESC NULLS LAST, created_at DESC NULLS LAST, id ASC NULLS LAST) = 1""",
)
def drop_duplicate_approvals(t: Tables):
    certificates = t.orders.select(
        F.col("o_orderkey").alias("id"),
        F.when(F.col("o_orderpriority") != "5-LOW", F.concat(F.lit("LIC-"), "o_custkey")).alias("approval_no"),
        F.when(F.col("o_orderstatus") != "P", F.col("o_orderdate").cast("date")).alias("expire_date"),
        F.col("o_orderdate").cast("date").alias("created_at"),
    )
    return b.drop_duplicate_approvals(certificates)


@query(
    "orphan_repair",
    """WITH d AS (SELECT o_custkey AS application_id, max(o_orderkey) AS newest FROM (SELECT * FROM orders QUALIFY row_number()
        OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC NULLS LAST, o_orderkey) = 1) GROUP BY 1)
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey AS application_id,
      CASE WHEN l_returnflag = 'R' THEN coalesce(newest, l_orderkey + 1000000000) WHEN l_linestatus = 'F' THEN newest ELSE l_orderkey END AS detail_id
    FROM lineitem LEFT JOIN d ON application_id = l_suppkey""",
)
def orphan_repair(t: Tables):
    """Dangling or missing detail ids are re-pointed to the newest detail of the application."""
    detail = F.expr("CASE WHEN l_returnflag = 'R' THEN l_orderkey + 1000000000 WHEN l_linestatus = 'F' THEN NULL ELSE l_orderkey END")
    children = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", F.col("l_suppkey").alias("application_id"), detail.alias("detail_id"))
    parents = t.orders.select(F.col("o_orderkey").alias("detail_id"), F.col("o_custkey").alias("application_id"), "o_orderdate")
    order = [F.col("o_orderdate").desc_nulls_last(), F.col("detail_id").asc_nulls_last()]
    return b.repoint_orphans(children, parents, "application_id", "detail_id", "detail_id", order).apply()


@query(
    "sibling_recovery",
    """SELECT l_orderkey AS detail_id, l_linenumber, l_partkey, coalesce(CASE WHEN l_returnflag <> 'R' THEN l_suppkey END,
      CASE WHEN o_orderstatus = 'P' THEN o_custkey END, o_custkey + 1) AS application_id FROM lineitem JOIN orders ON o_orderkey = l_orderkey""",
)
def sibling_recovery(t: Tables):
    """Two sibling tables are asked in order for the application behind a shared key."""
    children = t.lineitem.select(
        F.col("l_orderkey").alias("detail_id"),
        "l_linenumber",
        "l_partkey",
        F.when(F.col("l_returnflag") != "R", F.col("l_suppkey")).alias("application_id"),
    )
    first = t.orders.select(
        F.col("o_orderkey").alias("detail_id"), F.when(F.col("o_orderstatus") == "P", F.col("o_custkey")).alias("application_id")
    )
    second = t.orders.select(F.col("o_orderkey").alias("detail_id"), (F.col("o_custkey") + 1).alias("application_id"))
    return b.recover_from_siblings(children, [first, second], "detail_id", "application_id")


@query(
    "enforce_migrated",
    """SELECT c_custkey AS application_number, CASE WHEN k IS NULL AND c_mktsegment = 'BUILDING' THEN 'DRAFT' ELSE 'APPROVED' END AS status,
      k IS NOT NULL AS is_migrated, CASE WHEN c_nationkey > 20 THEN 'old' WHEN k IS NOT NULL AND k_class < 25 THEN 'class ' || k_class END AS category_id
    FROM (SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_custkey AS n, c_mktsegment, c_nationkey FROM customer)
    LEFT JOIN (SELECT DISTINCT p_partkey * 2 AS k, p_size AS k_class FROM part) ON k = n""",
)
def enforce_migrated(t: Tables):
    applications = t.customer.select(
        F.col("c_custkey").cast("string").alias("application_number"),
        F.when(F.col("c_mktsegment") == "BUILDING", F.lit("DRAFT")).otherwise(F.lit("APPROVED")).alias("status"),
        F.lit(False).alias("is_migrated"),
        F.when(F.col("c_nationkey") > 20, F.lit("old")).alias("category_id"),
    )
    staged = t.part.select((F.col("p_partkey") * 2).cast("string").alias("application_number"), F.col("p_size").cast("string").alias("class"))
    classes = t.nation.select(
        F.col("n_nationkey").cast("string").alias("alias"), F.concat(F.lit("class "), "n_nationkey").alias("category_id")
    )
    return m.enforce_migrated(applications, staged, classes).apply()


_CONTACT = "CASE WHEN s_nationkey < 8 THEN concat(s_name, ' | FITTER | 0712 345 6', lpad(s_suppkey % 100, 2, '0'), ' | a', s_suppkey, '@x.org') WHEN s_nationkey < 16 THEN concat(' ', s_name, ',x') ELSE s_name END"
_CONTACT_SQL = "CASE WHEN s_nationkey < 8 THEN s_name || ' | FITTER | 0712 345 6' || lpad(CAST(s_suppkey % 100 AS VARCHAR), 2, '0') || ' | a' || s_suppkey || '@x.org' WHEN s_nationkey < 16 THEN ' ' || s_name || ',x' ELSE s_name END"


@query(
    "clean_contact_names",
    f"""WITH x AS (SELECT s_suppkey, {_CONTACT_SQL} AS name, CASE WHEN s_acctbal > 5000 THEN '0' ELSE ' ' END AS mobile_no, CAST(NULL AS VARCHAR) AS email FROM supplier)
    SELECT s_suppkey, CASE WHEN contains(name, '|') THEN trim(split_part(name, '|', 1)) ELSE trim(split_part(name, ',', 1)) END AS name,
      CASE WHEN trim(mobile_no) = '' AND contains(name, '|') THEN '07123456' || lpad(CAST(s_suppkey % 100 AS VARCHAR), 2, '0') ELSE mobile_no END AS mobile_no,
      CASE WHEN contains(name, '|') THEN 'a' || s_suppkey || '@x.org' END AS email FROM x""",
)
def clean_contact_names(t: Tables):
    people = t.supplier.select(
        "s_suppkey",
        F.expr(_CONTACT).alias("name"),
        F.when(F.col("s_acctbal") > 5000, F.lit("0")).otherwise(F.lit(" ")).alias("mobile_no"),
        F.lit(None).cast("string").alias("email"),
    )
    return b.clean_contact_names(people).apply()


# --- provisioning ------------------------------------------------------------------------------------------


@query(
    "ensure_members",
    f"""WITH w AS (SELECT lower(p_type) AS k, min(p_type) AS name FROM part GROUP BY 1)
    SELECT CAST(n_nationkey AS VARCHAR) AS id, CASE WHEN n_nationkey = 7 THEN 'Economy ' ELSE n_name END AS name, CAST(NULL AS VARCHAR) AS category_type, 'keep' AS _action FROM nation
    UNION ALL SELECT {uuid_sql("'category|' || k")}, name, 'License', 'insert' FROM w WHERE k <> 'economy'""",
)
def ensure_members(t: Tables):
    name = F.when(F.col("n_nationkey") == 7, F.lit("Economy ")).otherwise(F.col("n_name"))
    dim = t.nation.select(
        F.col("n_nationkey").cast("string").alias("id"), name.alias("name"), F.lit(None).cast("string").alias("category_type")
    )
    names = t.part.select(F.col("p_type").alias("name"))
    return p.ensure_members(dim, names, {"category_type": F.lit("License")}, "category")


@query(
    "members_with_sector",
    """SELECT DISTINCT p_type || CASE p_type WHEN 'ECONOMY' THEN ' LPG' WHEN 'SMALL' THEN ' LNG' ELSE ' bulk water' END AS name,
      CASE p_type WHEN 'ECONOMY' THEN 0 WHEN 'SMALL' THEN 1 ELSE 3 END AS sector_id FROM part""",
)
def members_with_sector(t: Tables):
    kind = F.expr("concat(p_type, CASE p_type WHEN 'ECONOMY' THEN ' LPG' WHEN 'SMALL' THEN ' LNG' ELSE ' bulk water' END)")
    names = ("petroleum", "natural_gas", "electricity", "water_supply", "other")
    sectors = t.region.select(F.col("r_regionkey").alias("id"), F.element_at(F.array(*[F.lit(n) for n in names]), F.col("r_regionkey") + 1).alias("name"))
    return p.members_with_sector(t.part.select(kind.alias("name")).distinct(), sectors)


def _users(t: Tables):
    return t.customer.select(
        F.col("c_custkey").cast("string").alias("id"),
        F.concat(F.lit("User"), "c_custkey").alias("username"),
        F.col("c_name").alias("full_name"),
    )


def _named_events(t: Tables):
    return t.events.select(F.concat(F.lit(" USER"), F.col("user_id") * 11).alias("username"))


@query(
    "ensure_users",
    f"""WITH u AS (SELECT DISTINCT user_id * 11 AS n FROM events)
    SELECT CAST(c_custkey AS VARCHAR) AS id, 'User' || c_custkey AS username, c_name AS full_name, 'keep' AS _action FROM customer
    UNION ALL SELECT {uuid_sql("'user|user' || n")}, 'user' || n, 'user' || n, 'insert' FROM u WHERE n NOT IN (SELECT c_custkey FROM customer)""",
)
def ensure_users(t: Tables):
    return p.ensure_users(_users(t), _named_events(t))


@query(
    "provision_counts",
    """WITH u AS (SELECT DISTINCT user_id * 11 AS n FROM events) SELECT count(*) AS requested, count(*) FILTER (c_custkey IS NULL) AS inserted,
      count(c_custkey) AS skipped FROM u LEFT JOIN customer ON c_custkey = n""",
)
def provision_counts(t: Tables):
    return p.provision_counts(p.ensure_users(_users(t), _named_events(t)), _named_events(t), "username")


@query(
    "assign_role",
    """SELECT DISTINCT user_id, event_type AS role_id, 'keep' AS _action FROM events UNION ALL
      SELECT c_custkey, 'view', 'insert' FROM customer WHERE c_custkey NOT IN (SELECT user_id FROM events WHERE event_type = 'view')""",
)
def assign_role(t: Tables):
    held = t.events.select("user_id", F.col("event_type").alias("role_id")).distinct()
    roles = t.events.select(F.col("event_type").alias("id"), F.concat(F.lit(" "), F.upper("event_type")).alias("name")).distinct()
    return p.assign_role(held, t.customer, p.role_named(roles, "View"), user_id="c_custkey")


@query(
    "assign_role_to_holders",
    """SELECT DISTINCT user_id, event_type || CASE WHEN value > 5 THEN '' ELSE '!' END AS role_id, 'keep' AS _action FROM events UNION ALL
      SELECT DISTINCT user_id, 'DEFAULT', 'insert' FROM events WHERE event_type = 'purchase' AND value > 5""",
)
def assign_role_to_holders(t: Tables):
    """Everyone who holds one role gets another."""
    name = F.concat("event_type", F.when(F.col("value") > 5, F.lit("")).otherwise(F.lit("!")))
    held = t.events.select("user_id", name.alias("role_id")).distinct()
    first = t.spark.sql("SELECT 'purchase' AS role_id")
    second = t.spark.sql("SELECT 'DEFAULT' AS role_id")
    return p.assign_role(held, p.holders(held, first), second)


@query(
    "category_options",
    f"WITH {_CATEGORIES_SQL} SELECT id, name, kind AS category_type, sector AS sector_name FROM c WHERE NOT deleted AND contains(lower(name), 'nation_1') ORDER BY sector, name, id",
)
def category_options(t: Tables):
    return p.category_options(*_categories(t), text="NATION_1").drop("sector_id", "deleted_at")


@query(
    "role_options",
    """SELECT n_nationkey AS id, n_name AS name, count(c_custkey) AS user_count FROM nation LEFT JOIN customer ON c_nationkey = n_nationkey
      WHERE contains(lower(n_name), 'nation') GROUP BY 1, 2 ORDER BY 2""",
)
def role_options(t: Tables):
    roles = t.nation.select(F.col("n_nationkey").alias("id"), F.col("n_name").alias("name"))
    held = t.customer.select(F.col("c_nationkey").alias("role_id"), F.col("c_custkey").alias("user_id"))
    return p.role_options(roles, held, "nation")


# --- ownership -----------------------------------------------------------------------------------------------


def _owned(t: Tables):
    hub = t.customer.select(
        F.col("c_custkey").cast("string").alias("id"),
        F.concat(F.lit("APP-"), "c_custkey").alias("application_number"),
        F.col("c_nationkey").cast("string").alias("created_by"),
        F.concat(F.lit("nation_"), "c_nationkey").alias("username"),
    )
    certificates = t.orders.select(
        F.col("o_orderkey").cast("string").alias("id"),
        F.col("o_custkey").cast("string").alias("application_id"),
        F.lit("c").alias("created_by"),
        F.col("o_orderstatus").alias("owner_id"),
    )
    documents = t.orders.select(
        F.concat(F.lit("doc"), "o_orderkey").alias("id"),
        F.col("o_custkey").cast("string").alias("application_id"),
        F.when(F.col("o_orderstatus") != "P", F.col("o_orderpriority")).alias("created_by"),
    )
    return {"applications": (hub, own.HUB), "certificates": (certificates, own.CERTIFICATE), "documents": (documents, own.CHILD)}


def _mapping(t: Tables):
    """All applications of one segment move to the user of the next nation."""
    requests = t.customer.filter(F.col("c_mktsegment") == "BUILDING").select(
        F.concat(F.lit("APP-"), "c_custkey").alias("application_number"),
        F.concat(F.lit("NATION_"), (F.col("c_nationkey") + 1)).alias("new_username"),
    )
    users = t.nation.select(F.concat(F.lit("u"), "n_nationkey").alias("id"), F.col("n_name").alias("username"))
    return own.resolve_mapping(requests, _owned(t)["applications"][0], users)


_MOVE_SQL = """m AS (SELECT CAST(c_custkey AS VARCHAR) AS aid, 'u' || n_nationkey AS uid, n_name AS uname FROM customer JOIN nation ON n_nationkey = c_nationkey + 1
    WHERE c_mktsegment = 'BUILDING')"""


@query(
    "transfer_preview",
    f"""WITH {_MOVE_SQL} SELECT 'applications' AS table_name, count(*) AS rows FROM m UNION ALL
      SELECT 'certificates', count(*) FROM orders JOIN m ON aid = CAST(o_custkey AS VARCHAR) UNION ALL
      SELECT 'documents', count(*) FROM orders JOIN m ON aid = CAST(o_custkey AS VARCHAR) WHERE o_orderstatus <> 'P'""",
)
def transfer_preview(t: Tables):
    return own.preview_transfer(_owned(t), _mapping(t))


@query(
    "transfer_snapshot",
    f"""WITH {_MOVE_SQL} SELECT 'applications' AS table_name, aid AS row_id, aid AS application_id, CAST(c_nationkey AS VARCHAR) AS old_created_by,
        'nation_' || c_nationkey AS old_username, CAST(NULL AS VARCHAR) AS old_owner_id FROM m JOIN customer ON CAST(c_custkey AS VARCHAR) = aid
      UNION ALL SELECT 'certificates', CAST(o_orderkey AS VARCHAR), aid, 'c', NULL, o_orderstatus FROM orders JOIN m ON aid = CAST(o_custkey AS VARCHAR)
      UNION ALL SELECT 'documents', 'doc' || o_orderkey, aid, o_orderpriority, NULL, NULL FROM orders JOIN m ON aid = CAST(o_custkey AS VARCHAR) WHERE o_orderstatus <> 'P'""",
)
def transfer_snapshot(t: Tables):
    return own.transfer_snapshot(_owned(t), _mapping(t))


@query(
    "transfer_apply",
    f"""WITH {_MOVE_SQL} SELECT 'applications' AS table_name, CAST(c_custkey AS VARCHAR) AS id, coalesce(uid, CAST(c_nationkey AS VARCHAR)) AS created_by,
        coalesce(uname, 'nation_' || c_nationkey) AS owner FROM customer LEFT JOIN m ON aid = CAST(c_custkey AS VARCHAR)
      UNION ALL SELECT 'certificates', CAST(o_orderkey AS VARCHAR), coalesce(uid, 'c'), coalesce(uid, o_orderstatus) FROM orders LEFT JOIN m ON aid = CAST(o_custkey AS VARCHAR)
      UNION ALL SELECT 'documents', 'doc' || o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN coalesce(uid, o_orderpriority) END, NULL
        FROM orders LEFT JOIN m ON aid = CAST(o_custkey AS VARCHAR)""",
)
def transfer_apply(t: Tables):
    return _owners(own.transfer(_owned(t), _mapping(t))[0])


def _owners(tables):
    """All owned tables in one listing."""
    parts = [
        df.select(F.lit(name).alias("table_name"), "id", "created_by", F.col(extra).alias("owner") if extra else F.lit(None).cast("string").alias("owner"))
        for (name, df), extra in zip(tables.items(), ("username", "owner_id", None))
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query(
    "transfer_restore",
    """SELECT 'applications' AS table_name, CAST(c_custkey AS VARCHAR) AS id, CAST(c_nationkey AS VARCHAR) AS created_by, 'nation_' || c_nationkey AS owner FROM customer
      UNION ALL SELECT 'certificates', CAST(o_orderkey AS VARCHAR), 'c', o_orderstatus FROM orders
      UNION ALL SELECT 'documents', 'doc' || o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN o_orderpriority END, NULL FROM orders""",
)
def transfer_restore(t: Tables):
    """Transfer, then restore from the snapshot: the tables are as they were."""
    owned = _owned(t)
    moved, snapshot = own.transfer(owned, _mapping(t))
    again = {name: (moved[name], kind) for name, (_, kind) in owned.items()}
    return _owners(own.restore(again, snapshot))


@query(
    "transfer_discard",
    f"""WITH {_MOVE_SQL} SELECT 'certificates' AS table_name, CAST(o_orderkey AS VARCHAR) AS row_id FROM orders JOIN m ON aid = CAST(o_custkey AS VARCHAR)
      JOIN customer ON c_custkey = o_custkey WHERE c_nationkey > 10""",
)
def transfer_discard(t: Tables):
    """Snapshot rows of restored applications (here: of the first nations) are dropped."""
    owned = {"certificates": _owned(t)["certificates"]}
    done = t.customer.filter(F.col("c_nationkey") <= 10).select(F.col("c_custkey").alias("application_id"))
    return own.discard_snapshot(own.transfer_snapshot(owned, _mapping(t)), done).select("table_name", "row_id")


# --- schema ------------------------------------------------------------------------------------------------------


@query(
    "align_schema",
    """SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, CAST(c_acctbal AS DECIMAL(11,2)) AS c_acctbal, TRUE AS is_migrated, CAST(NULL AS DATE) AS intimate_date,
      c_name, c_mktsegment FROM customer""",
)
def align_schema(t: Tables):
    want = T.StructType(
        [
            T.StructField("c_custkey", T.StringType()),
            T.StructField("c_acctbal", T.DecimalType(11, 2)),
            T.StructField("is_migrated", T.BooleanType()),
            T.StructField("intimate_date", T.DateType()),
        ]
    )
    return schema.align_schema(t.customer, want, {"is_migrated": F.lit(True)}, drop=["c_nationkey"])[0]
