"""The import plans over feeds that Spark derives from the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerlift.functions import fixed_values as fixed
from ledgerlift.functions import stable_key
from ledgerlift.plans import applications, checks, directory, electrical, experience, fees, people, water
from ledgerlift.sources import dimensions
from ledgerlift.sources.grid import with_position
from ledgerlift.sources.store import Workspace
from workload.registry import Tables, query
from workload.repairs import _CATEGORIES_SQL, _categories, _zones, uuid_sql
from workload.scalars import _TYPE_WORD, RENDERED_DATE_SQL, parsed_date_sql, rendered_date

NOW = "2024-05-01 00:00:00"


def text(c):
    return F.col(c).cast("string")


def lookup_tables(t: Tables):
    categories, sectors = _categories(t)
    return {"categories": categories, "sectors": sectors}


def locations(t: Tables):
    nations = t.nation.select(text("n_nationkey").alias("id"), F.col("n_name").alias("name"))
    regions = t.region.select(text("r_regionkey").alias("id"), F.col("r_name").alias("name"))
    return {"region": dimensions.dimension(nations), "district": dimensions.dimension(regions), "ward": dimensions.dimension(regions)}


# --- applications -------------------------------------------------------------------------------------


def application_feed(t: Tables):
    """One feed row per order; about ten rows share an application number."""
    rows = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
    status, priority = F.col("o_orderstatus"), F.col("o_orderpriority")
    kind = F.when(status == "P", F.concat(F.lit(" nation_"), "c_nationkey")).when(status == "F", F.concat(F.lit("Novel "), priority))
    urgent = priority == "1-URGENT"
    return rows.select(
        F.col("o_orderkey").alias("_row"),
        F.concat(F.lit(" APP-"), "o_custkey").alias("AppRefNo"),
        F.when(priority == "5-LOW", F.lit("nan")).otherwise(F.concat(F.lit("LIC-"), F.floor(F.col("o_orderkey") / 3))).alias("approval_no"),
        F.expr(_TYPE_WORD).alias("application_type"),
        rendered_date().alias("effective_date"),
        F.date_format(F.date_add(F.col("o_orderdate").cast("date"), 365), "d-M-yyyy").alias("expiry_date"),
        kind.otherwise(F.lit("none")).alias("license_type"),
        F.when(F.col("c_nationkey") == 24, F.lit("999")).otherwise(F.concat("c_nationkey", F.lit(".0"))).alias("region"),
        (F.col("o_custkey") % 7).cast("string").alias("district"),
        F.when(status == "O", F.concat(F.col("o_custkey") % 6, F.lit(".0"))).when(status == "F", F.lit("Old Town")).alias("ward"),
        F.when(priority == "2-HIGH", F.concat(F.lit("A"), F.col("o_orderkey") % 2000)).alias("parent_application_id"),
        F.concat(F.lit("Clerk."), status).alias("userid"),
        F.col("c_name").alias("facility_name"),
        F.when(status == "O", F.lit("SoleProprietor"))
        .when(status == "F", F.lit("Sole proprietor in a Column"))
        .when(F.col("c_nationkey") > 12, F.lit("Guild"))
        .otherwise(F.lit("private_LimitedLiability-Company."))
        .alias("application_legal_status_id"),
        F.concat("o_orderkey", F.lit(".0")).alias("tinc"),
        F.when(~urgent, F.concat(F.lit("tin"), "o_orderkey", F.lit(".pdf"))).alias("tincfilename"),
        F.when(status != "F", F.lit("77")).otherwise(F.lit("x")).alias("coc"),
        F.lit("coc.pdf").alias("cocfilename"),
        F.when(urgent, F.concat("o_custkey", F.lit("@x.org"))).alias("cemail"),
        F.when(urgent, F.concat(F.lit("FC"), "o_orderkey")).alias("fcontrolno"),
        F.when(priority == "2-HIGH", F.concat(F.lit("CN"), "o_orderkey")).alias("tiracovernotenumber"),
    )


def application_workspace(t: Tables, default_role: str | None = None) -> Workspace:
    hub = t.customer.select(
        F.concat(F.lit("A"), "c_custkey").alias("id"),
        F.concat(F.lit("APP-"), F.col("c_custkey") * 2).alias("application_number"),
        F.lit("OLD").alias("application_type"),
        F.lit("OLD-LIC").alias("approval_no"),
        F.lit("2001-01-01").cast("date").alias("effective_date"),
        F.lit("old").alias("category_id"),
        F.lit("LICENSE_WATER").alias("license_type"),
        F.lit("PROVISIONAL").alias("category_license_type"),
        F.lit(False).alias("is_migrated"),
        F.when(F.col("c_nationkey") > 12, F.lit("2000-06-01").cast("date")).alias("intimate_date"),
        F.col("c_nationkey").cast("bigint").alias("months_eligible"),
        F.concat(F.lit("/l/"), "c_custkey").alias("licence_path"),
    )
    statuses = t.region.select(text("r_regionkey").alias("id"), F.lit("Sole Proprietor ").alias("name"))
    certificates = t.customer.select(
        F.concat(F.lit("C"), "c_custkey").alias("id"),
        F.concat(F.lit("APP-"), F.col("c_custkey") * 3).alias("application_number"),
        F.lit("/old").alias("licence_path"),
    )
    nation = F.col("n_nationkey")
    roles = t.nation.select(F.concat(F.lit("r"), nation).alias("id"), F.when(nation == 7, F.lit("Default Role ")).otherwise(F.col("n_name")).alias("name"))
    held = t.nation.select(F.lit("u1").alias("user_id"), F.concat(F.lit("r"), nation).alias("role_id"))
    spelled = F.element_at(F.array(*map(F.lit, ("x", " CLERK.P", "y", "Clerk.f", "z"))), F.col("r_regionkey") + 1)
    users = t.region.select(F.concat(F.lit("u"), "r_regionkey").alias("id"), spelled.alias("username"))
    known = {"applications": hub, "application_legal_status": statuses, "certificates": certificates, "roles": roles, "user_roles": held, "users": users}
    ws = Workspace(known | lookup_tables(t))
    return applications.import_applications(
        ws, application_feed(t), "PETROLEUM", locations(t), _zones(t), default_role=default_role, as_of=NOW
    )


_PERSON_REJECTS_SQL = """x AS (SELECT *, CASE WHEN l_returnflag <> 'R' THEN 'APP-' || l_partkey END AS number,
      CASE WHEN l_linestatus = 'O' THEN 'Holder ' || l_suppkey WHEN l_quantity <= 40 THEN 'Ann  Marie Holder ' || l_suppkey END AS person FROM lineitem),
  d AS (SELECT number, person FROM x WHERE number IS NOT NULL AND person IS NOT NULL QUALIFY row_number() OVER (PARTITION BY number, person) > 1),
  r AS (SELECT 'missing_key' AS code, 'application_number' AS column_name, NULL AS value FROM x WHERE number IS NULL
    UNION ALL SELECT 'missing_key', 'shname', NULL FROM x WHERE person IS NULL
    UNION ALL SELECT 'duplicate_key', 'application_number', number FROM d
    UNION ALL SELECT 'missing_parent', 'application_number', number FROM x WHERE number IS NOT NULL AND (l_partkey % 2 = 1 OR l_partkey NOT IN (SELECT c_custkey FROM customer))
    UNION ALL SELECT 'unknown_value', 'nationality', '5e+12' FROM x WHERE l_linenumber = 5
    UNION ALL SELECT 'wrong_type', 'objectid', 'x1' FROM x WHERE l_quantity <= 10
    UNION ALL SELECT 'wrong_type', 'amountofshare', 'half' FROM x WHERE l_quantity > 15 AND l_quantity <= 20
    UNION ALL SELECT 'too_long', 'shname', person FROM x WHERE length(person) > 24)"""
APPLICATION_SQL = f"""WITH {_CATEGORIES_SQL},
  f AS (SELECT o_orderkey AS row_no, 'APP-' || o_custkey AS number, 'LIC-' || o_orderkey // 3 AS approval_no,
      CASE o_orderpriority WHEN '1-URGENT' THEN 'RENEW' WHEN '2-HIGH' THEN 'EXTEND' WHEN '3-MEDIUM' THEN 'CHANGE_OF_NAME' WHEN '4-NOT SPECIFIED' THEN 'UPGRADE' ELSE 'ODD' END AS type,
      {parsed_date_sql(RENDERED_DATE_SQL)} AS effective_date, CAST(CAST(o_orderdate AS DATE) + INTERVAL 365 DAY AS DATE) AS expire_date,
      CASE o_orderstatus WHEN 'P' THEN 'nation_' || c_nationkey WHEN 'F' THEN lower('Novel ' || o_orderpriority) END AS kind_key,
      'clerk.' || lower(o_orderstatus) AS username, CASE WHEN n_nationkey = 24 THEN '999' ELSE n_name END AS region,
      CASE WHEN n_nationkey <> 24 THEN CAST(n_regionkey AS VARCHAR) END AS zone_id, c_name AS facility_name,
      CASE WHEN o_orderstatus IN ('O', 'F') THEN '0' WHEN c_nationkey <= 12 THEN {uuid_sql("'legal_status|private limited liability company'")} END AS legal,
      o_orderkey, o_custkey, o_orderstatus, o_orderpriority
    FROM orders JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey WHERE o_orderpriority <> '5-LOW'),
  first AS (SELECT * FROM f QUALIFY row_number() OVER (PARTITION BY number ORDER BY row_no) = 1),
  cat AS (SELECT lower(name) AS k, id, sector, kind FROM c UNION ALL
    SELECT DISTINCT kind_key, {uuid_sql("'category|' || kind_key")}, 'PETROLEUM', 'License' FROM f WHERE o_orderstatus = 'F'),
  s AS (SELECT first.*, {uuid_sql("'application|' || number")} AS id, cat.id AS category_id,
      CASE WHEN sector = 'WATER_SUPPLY' THEN 'LICENSE_WATER' WHEN sector = 'ELECTRICITY' THEN 'LICENSE_ELECTRICITY_SUPPLY'
        WHEN sector IN ('PETROLEUM', 'NATURAL_GAS') AND kind = 'License' THEN 'LICENSE_' || sector
        WHEN sector IN ('PETROLEUM', 'NATURAL_GAS') AND kind = 'Construction' THEN 'CONSTRUCTION_' || sector END AS license_type
    FROM first LEFT JOIN cat ON k = kind_key),
  t AS (SELECT 'A' || c_custkey AS id, 'APP-' || c_custkey * 2 AS number, CASE WHEN c_nationkey > 12 THEN DATE '2000-06-01' END AS intimate_date,
      CAST(c_nationkey AS BIGINT) AS months_eligible, '/l/' || c_custkey AS licence_path FROM customer),
  hub AS (SELECT coalesce(t.id, s.id) AS id, coalesce(t.number, s.number) AS application_number, coalesce(s.type, 'OLD') AS application_type,
      coalesce(s.approval_no, 'OLD-LIC') AS approval_no, CASE WHEN s.number IS NOT NULL THEN 'APPROVED' END AS status, s.username,
      s.number IS NOT NULL AS is_migrated, coalesce(s.effective_date, CASE WHEN t.number IS NOT NULL THEN DATE '2001-01-01' END) AS effective_date,
      s.expire_date, coalesce(s.category_id, CASE WHEN t.number IS NOT NULL THEN 'old' END) AS category_id,
      coalesce(s.license_type, CASE WHEN t.number IS NOT NULL THEN 'LICENSE_WATER' END) AS license_type,
      CASE WHEN t.number IS NOT NULL THEN 'PROVISIONAL' ELSE 'OPERATIONAL' END AS category_license_type, s.zone_id,
      CASE WHEN t.number IS NULL THEN 'insert' WHEN s.number IS NULL THEN 'keep' ELSE 'update' END AS _action,
      intimate_date, months_eligible, licence_path, s.legal, s.type AS staged_type, s.region, s.facility_name, s.o_orderkey, s.o_custkey, s.o_orderstatus, s.o_orderpriority
    FROM t FULL JOIN s ON t.number = s.number)"""
HUB = (
    "id, application_number, application_type, approval_no, status, username, is_migrated, effective_date, expire_date, category_id, "
    "license_type, category_license_type, zone_id, _action"
).split(", ")


@query("import_applications", f"{APPLICATION_SQL} SELECT {', '.join(HUB)} FROM hub")
def import_applications(t: Tables):
    return application_workspace(t).merged["applications"].select(*HUB)


@query(
    "hub_import",
    f"{APPLICATION_SQL} SELECT 'applications' AS table_name, count(*) FILTER (_action = 'insert') AS inserted, count(*) FILTER (_action = 'update') AS updated, count(*) FILTER (_action = 'keep') AS kept FROM hub",
)
def hub_import(t: Tables):
    """Rows of the hub inserted, updated and kept by one import."""
    return application_workspace(t).summary(["applications"])


_CERTIFICATE = "id, application_id, application_number, approval_no, application_certificate_type, effective_date, expire_date, intimate_date, months_eligible, licence_path, license_type, category_license_type, zone_id, _action"


@query(
    "import_certificates",
    f"""{APPLICATION_SQL}, o AS (SELECT 'C' || c_custkey AS id, 'APP-' || c_custkey * 3 AS application_number FROM customer),
      n AS (SELECT * FROM hub WHERE _action <> 'keep')
    SELECT coalesce(o.id, {uuid_sql("'certificate|' || n.application_number")}) AS id, n.id AS application_id, coalesce(n.application_number, o.application_number) AS application_number,
      approval_no, staged_type AS application_certificate_type, effective_date, expire_date, intimate_date, months_eligible,
      coalesce(licence_path, CASE WHEN o.id IS NOT NULL THEN '/old' END) AS licence_path, license_type, category_license_type, zone_id,
      CASE WHEN o.id IS NULL THEN 'insert' WHEN n.id IS NULL THEN 'keep' ELSE 'update' END AS _action
    FROM n FULL JOIN o ON n.application_number = o.application_number""",
)
def import_certificates(t: Tables):
    return application_workspace(t).merged["certificates"].select(*_CERTIFICATE.split(", "))


@query(
    "import_sector_details",
    f"""{APPLICATION_SQL} SELECT id, id AS application_id, region, facility_name, legal AS applicant_legal_status_id
    FROM hub WHERE _action <> 'keep'""",
)
def import_sector_details(t: Tables):
    columns = ["id", "application_id", "region", "facility_name", "applicant_legal_status_id"]
    return application_workspace(t).merged["application_sector_details"].select(*columns)


@query(
    "import_documents",
    f"""{APPLICATION_SQL}, d AS (SELECT id AS app, 1 AS pos, 'TINC' AS document_name, 'tin' || o_orderkey || '.pdf' AS file_name, o_orderkey AS logic_doc_id FROM hub
        WHERE _action <> 'keep' AND o_orderpriority <> '1-URGENT'
      UNION ALL SELECT id, 2, 'COC', 'coc.pdf', 77 FROM hub WHERE _action <> 'keep' AND o_orderstatus <> 'F')
    SELECT {uuid_sql("app || '|doc|' || document_name")} AS id, app AS application_id, document_name, file_name, CAST(logic_doc_id AS BIGINT) AS logic_doc_id,
      row_number() OVER (PARTITION BY app ORDER BY pos) AS documents_order FROM d""",
)
def import_documents(t: Tables):
    columns = ["id", "application_id", "document_name", "file_name", "logic_doc_id", "documents_order"]
    return application_workspace(t).merged["documents"].select(*columns)


@query(
    "import_detail_children",
    f"""{APPLICATION_SQL} SELECT 'contact_persons' AS table_name, id AS application_id, o_custkey || '@x.org' AS value FROM hub WHERE o_orderpriority = '1-URGENT'
      UNION ALL SELECT 'fire', id, 'FC' || o_orderkey FROM hub WHERE o_orderpriority = '1-URGENT'
      UNION ALL SELECT 'insurance_cover_details', id, 'CN' || o_orderkey FROM hub WHERE o_orderpriority = '2-HIGH'""",
)
def import_detail_children(t: Tables):
    merged = application_workspace(t).merged
    fields = {"contact_persons": "email", "fire": "fire_certificate_control_number", "insurance_cover_details": "cover_note_number"}
    parts = [merged[n].select(F.lit(n).alias("table_name"), "application_id", F.col(c).alias("value")) for n, c in fields.items()]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query(
    "import_categories_from_feed",
    f"""{APPLICATION_SQL} SELECT id, name, 'keep' AS _action FROM c UNION ALL
      SELECT id, (SELECT min('Novel ' || o_orderpriority) FROM f WHERE kind_key = k), 'insert' FROM cat WHERE k LIKE 'novel%' UNION ALL
      SELECT {uuid_sql("'category|' || lower(name)")}, name, 'insert' FROM (SELECT unnest([{', '.join(f"'{c}'" for c in fixed.PETROLEUM_CATEGORIES)}]) AS name)""",
)
def import_categories_from_feed(t: Tables):
    return application_workspace(t).merged["categories"].select("id", "name", "_action")


@query(
    "import_user_provisioning",
    f"""{APPLICATION_SQL}, u AS (SELECT 'u' || r_regionkey AS id, ['x', ' CLERK.P', 'y', 'Clerk.f', 'z'][r_regionkey + 1] AS username FROM region)
    SELECT id, username, 'keep' AS _action FROM u
    UNION ALL SELECT {uuid_sql("'user|' || username")}, username, 'insert' FROM (SELECT DISTINCT username FROM f) WHERE username NOT IN (SELECT lower(trim(username)) FROM u)""",
)
def import_user_provisioning(t: Tables):
    return application_workspace(t).merged["users"].select("id", "username", "_action")


@query(
    "import_application_report",
    f"""{APPLICATION_SQL} SELECT count(*) AS staged, count(t.number) AS existing_application_number,
      count(*) FILTER (f.approval_no IN (SELECT 'LIC-' || c_custkey FROM customer)) AS existing_approval_no,
      count(*) - count(DISTINCT f.number) AS dup_application_number, count(*) - count(DISTINCT f.approval_no) AS dup_approval_no FROM f LEFT JOIN t ON t.number = f.number""",
)
def import_application_report(t: Tables):
    ws = application_workspace(t)
    before = t.customer.select(
        F.concat(F.lit("APP-"), F.col("c_custkey") * 2).alias("application_number"), F.concat(F.lit("LIC-"), "c_custkey").alias("approval_no")
    )
    return applications.application_report(ws, before)


@query(
    "import_mapping_report",
    f"""{APPLICATION_SQL} SELECT count(*) FILTER (kind_key IS NOT NULL AND category_id IS NOT NULL) AS license_category_mapped,
      count(*) FILTER (kind_key IS NOT NULL AND category_id IS NULL) AS license_category_unmapped, count(legal) AS legal_status_mapped,
      count(*) - count(legal) AS legal_status_unmapped, count(*) FILTER (region <> '999') AS region_mapped, count(*) FILTER (region = '999') AS region_unmapped,
      count(*) FILTER (o_custkey % 7 < 5) AS district_mapped, count(*) FILTER (o_custkey % 7 >= 5) AS district_unmapped,
      count(*) FILTER (o_orderstatus = 'F' OR (o_orderstatus = 'O' AND o_custkey % 6 < 5)) AS ward_mapped, count(*) FILTER (o_orderstatus = 'O' AND o_custkey % 6 = 5) AS ward_unmapped FROM s""",
)
def import_mapping_report(t: Tables):
    return applications.mapping_report(application_workspace(t))


@query(
    "import_mapping_samples",
    f"""{APPLICATION_SQL} SELECT 'region' AS mapping, region AS value, count(*) AS rows FROM s WHERE region = '999' GROUP BY 2
      UNION ALL SELECT 'district', CAST(o_custkey % 7 AS VARCHAR), count(*) FROM s WHERE o_custkey % 7 >= 5 GROUP BY 2
      UNION ALL SELECT 'ward', '5.0', count(*) FROM s WHERE o_orderstatus = 'O' AND o_custkey % 6 = 5 HAVING count(*) > 0
      UNION ALL SELECT 'legal_status', 'Guild', count(*) FROM s WHERE legal IS NULL HAVING count(*) > 0
      UNION ALL SELECT 'license_category', 'x', count(*) FROM s WHERE kind_key IS NOT NULL AND category_id IS NULL HAVING count(*) > 0""",
)
def import_mapping_samples(t: Tables):
    return applications.mapping_samples(application_workspace(t))


@query(
    "import_rejects",
    f"""WITH x AS (SELECT o_orderkey, o_orderstatus, o_orderpriority, c_nationkey, {RENDERED_DATE_SQL} AS raw FROM orders JOIN customer ON c_custkey = o_custkey)
    SELECT o_orderkey AS _row, 'unreadable_date' AS code, 'effective_date' AS column_name, raw AS value FROM x WHERE {parsed_date_sql('raw')} IS NULL
    UNION ALL SELECT o_orderkey, 'too_long', 'license_type', 'Novel ' || o_orderpriority FROM x WHERE o_orderstatus = 'F' AND length(o_orderpriority) > 12
    UNION ALL SELECT o_orderkey, 'too_long', 'application_legal_status_raw', CASE o_orderstatus WHEN 'F' THEN 'Sole proprietor in a Column' ELSE 'private_LimitedLiability-Company.' END
      FROM x WHERE o_orderstatus = 'F' OR (o_orderstatus = 'P' AND c_nationkey <= 12)""",
)
def import_rejects(t: Tables):
    """Cells of the feed that the import can't read or a narrow target couldn't hold."""
    return applications.rejected_cells(application_feed(t), longest=18)


@query(
    "import_rejected_rows",
    f"""WITH x AS (SELECT *, {RENDERED_DATE_SQL} AS raw, {_TYPE_WORD} AS word, 'APP-' || o_custkey AS number, 'A' || o_orderkey % 2000 AS parent FROM orders JOIN customer ON c_custkey = o_custkey)
    SELECT o_orderkey AS _row, 'missing_key' AS code, 'approval_no' AS column_name, NULL AS value FROM x WHERE o_orderpriority = '5-LOW'
    UNION ALL (SELECT o_orderkey, 'duplicate_key', 'application_number', number FROM x QUALIFY row_number() OVER (PARTITION BY number ORDER BY o_orderkey) > 1)
    UNION ALL SELECT o_orderkey, 'missing_parent', 'old_parent_application_id', parent FROM x WHERE o_orderpriority = '2-HIGH' AND parent NOT IN (SELECT 'A' || c_custkey FROM customer)
    UNION ALL SELECT o_orderkey, 'unreadable_date', 'effective_date', raw FROM x WHERE {parsed_date_sql('raw')} IS NULL
    UNION ALL SELECT o_orderkey, 'unknown_value', 'region', '999' FROM x WHERE c_nationkey = 24
    UNION ALL SELECT o_orderkey, 'unknown_value', 'district', CAST(o_custkey % 7 AS VARCHAR) FROM x WHERE o_custkey % 7 >= 5
    UNION ALL SELECT o_orderkey, 'unknown_value', 'ward', CASE o_orderstatus WHEN 'F' THEN 'Old Town' ELSE '5.0' END FROM x WHERE o_orderstatus = 'F' OR (o_orderstatus = 'O' AND o_custkey % 6 = 5)
    UNION ALL SELECT o_orderkey, 'unknown_value', 'application_type', trim(word) FROM x WHERE lower(trim(word)) NOT IN ({', '.join(repr(w) for w in sorted({w.lower() for p in fixed.APPLICATION_TYPE_SYNONYMS.items() for w in p}))})
    UNION ALL SELECT o_orderkey, 'too_long', 'application_legal_status_raw', CASE o_orderstatus WHEN 'F' THEN 'Sole proprietor in a Column' ELSE 'private_LimitedLiability-Company.' END
      FROM x WHERE o_orderstatus = 'F' OR (o_orderstatus = 'P' AND c_nationkey <= 12)""",
)
def import_rejected_rows(t: Tables):
    """Every rule that a row of the applications feed breaks."""
    hub = t.customer.select(F.concat(F.lit("A"), "c_custkey").alias("id"))
    return checks.rejected_rows(application_feed(t), checks.FEEDS["applications"], hub, locations(t), longest=26)


@query(
    "import_shareholders_rejected",
    f"""WITH {_PERSON_REJECTS_SQL} SELECT code, column_name, count(*) AS rows, min(value) AS example FROM r GROUP BY 1, 2""",
)
def import_shareholders_rejected(t: Tables):
    hub = t.customer.where("c_custkey % 2 = 0").select(F.concat(F.lit("APP-"), "c_custkey").alias("application_number"))
    extra = [
        F.when(F.col("l_linenumber") < 6, F.concat(F.col("l_linenumber"), F.lit("e+12"))).alias("nationality"),
        F.when(F.col("l_quantity") > 10, text("l_partkey")).otherwise(F.lit("x1")).alias("objectid"),
        F.when(F.col("l_quantity") > 20, F.concat("l_suppkey", F.lit(".5"))).when(F.col("l_quantity") > 15, F.lit("half")).alias("amountofshare"),
    ]
    found = checks.rejected_rows(_person_feed(t, "SHName", extra), checks.FEEDS["shareholders"], hub, {"country": _countries(t)}, longest=24)
    return checks.reject_counts(found)


@query(
    "import_water_rejected",
    """WITH x AS (SELECT *, 'W-' || o_custkey AS number FROM orders JOIN customer ON c_custkey = o_custkey), r AS (
      SELECT 'missing_key' AS code, 'approval_no' AS column_name, NULL AS value FROM x WHERE o_orderpriority = '5-LOW'
      UNION ALL (SELECT 'duplicate_key', 'application_number', CASE WHEN o_orderkey % 2 = 0 THEN 'W-' ELSE 'w-' END || o_custkey FROM x QUALIFY row_number() OVER (PARTITION BY number ORDER BY o_orderkey) > 1)
      UNION ALL SELECT 'missing_parent', 'old_parent_application_id', 'A-1' FROM x WHERE o_orderpriority = '1-URGENT'
      UNION ALL SELECT 'unreadable_date', 'effective_date', 'soon' FROM x WHERE o_orderstatus <> 'P'
      UNION ALL SELECT 'unknown_value', 'license_type', '?' FROM x WHERE o_orderstatus = 'O'
      UNION ALL SELECT 'wrong_type', 'latitude', '6S' FROM x WHERE o_orderstatus = 'F')
    SELECT code, column_name, count(*) AS rows, min(value) AS example FROM r GROUP BY 1, 2""",
)
def import_water_rejected(t: Tables):
    status, priority = F.col("o_orderstatus"), F.col("o_orderpriority")
    feed = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).select(
        F.col("o_orderkey").alias("_row"),
        F.concat(F.when(F.col("o_orderkey") % 2 == 0, F.lit("W-")).otherwise(F.lit("w-")), "o_custkey").alias("apprefno"),
        F.when(priority != "5-LOW", F.concat(F.lit("LIC-"), "o_orderkey")).alias("licenceno"),
        F.when(status == "P", F.date_format("o_orderdate", "yyyy-MM-dd")).otherwise(F.lit("soon")).alias("effective_date"),
        F.when(status == "P", F.lit("Water License")).when(status == "F", F.lit("LICENSE_PETROLEUM")).otherwise(F.lit("?")).alias("license_type"),
        F.when(status == "F", F.lit("6S")).otherwise(F.lit("-6.8")).alias("latitude"),
        F.when(priority == "1-URGENT", F.lit("A-1")).otherwise(F.concat(F.lit("A"), "o_custkey")).alias("parent_application_id"),
    )
    hub = t.customer.select(F.concat(F.lit("A"), "c_custkey").alias("id"))
    return checks.reject_counts(checks.rejected_rows(feed, checks.FEEDS["water"], hub))


@query(
    "import_unresolved_regions",
    f"""{APPLICATION_SQL} SELECT row_no AS _row, number AS application_number, region FROM f WHERE region = '999'""",
)
def import_unresolved_regions(t: Tables):
    return applications.unresolved_regions(application_workspace(t)).select("_row", "application_number", "region")


@query(
    "import_default_role",
    f"""{APPLICATION_SQL}, w AS (SELECT DISTINCT CASE o_orderstatus WHEN 'P' THEN 'u1' WHEN 'F' THEN 'u3' ELSE {uuid_sql("'user|clerk.o'")} END AS user_id FROM f),
      h AS (SELECT 'u1' AS user_id, 'r' || n_nationkey AS role_id FROM nation)
    SELECT user_id, role_id, 'keep' AS _action FROM h UNION ALL SELECT user_id, 'r7', 'insert' FROM w WHERE user_id NOT IN (SELECT user_id FROM h WHERE role_id = 'r7')""",
)
def import_default_role(t: Tables):
    """Staged users get the role that is asked for, unless they have it."""
    return application_workspace(t, "default role").merged["user_roles"]


# --- people ---------------------------------------------------------------------------------------------


def _people_tables(t: Tables):
    hub = t.customer.select(F.concat(F.lit("A"), "c_custkey").alias("id"), F.concat(F.lit("APP-"), "c_custkey").alias("application_number"))
    details = t.orders.select(F.concat(F.lit("D"), "o_orderkey").alias("id"), F.concat(F.lit("A"), "o_custkey").alias("application_id"))
    return {"applications": hub, "application_sector_details": details}


def _countries(t: Tables):
    name = F.when(F.col("r_regionkey") == 0, F.lit("Tanzanian")).otherwise(F.concat(F.lit("non tanzanian "), "r_name"))
    return t.region.select((F.col("r_regionkey") * 1000000000000).cast("string").alias("id"), name.alias("name"))


def _person_feed(t: Tables, name: str, extra):
    """One person per line item: a third without application, some without a name."""
    rows = with_position(t.lineitem.select("l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_returnflag", "l_linestatus"))
    number = F.when(F.col("l_returnflag") == "R", F.lit("nan")).otherwise(F.concat(F.lit("APP-"), "l_partkey", F.lit(" ")))
    person = F.when(F.col("l_linestatus") == "O", F.concat(F.lit("Holder "), "l_suppkey")).when(
        F.col("l_quantity") <= 40, F.concat(F.lit("Ann  Marie Holder "), "l_suppkey")
    )
    return rows.select("_row", number.alias("AppRefNo"), person.alias(name), *extra)


_PERSON_SQL = """x AS (SELECT row_number() OVER () AS row_no, l_partkey, l_suppkey, l_linenumber, l_quantity, l_returnflag, l_linestatus FROM lineitem),
  y AS (SELECT *, CASE WHEN l_returnflag <> 'R' THEN 'APP-' || l_partkey END AS number,
      CASE WHEN l_linestatus = 'O' THEN 'Holder ' || l_suppkey WHEN l_quantity <= 40 THEN 'Ann  Marie Holder ' || l_suppkey END AS person FROM x),
  z AS (SELECT y.*, 'A' || c_custkey AS application_id, detail FROM y LEFT JOIN customer ON number = 'APP-' || c_custkey
      LEFT JOIN (SELECT o_custkey, min('D' || o_orderkey) AS detail FROM orders GROUP BY 1) ON o_custkey = c_custkey),
  e AS (SELECT * FROM z WHERE application_id IS NOT NULL AND person IS NOT NULL
      QUALIFY row_number() OVER (PARTITION BY lower(number), lower(person) ORDER BY row_no) = 1),
  k AS (SELECT """ + uuid_sql("number || '|' || lower(person)") + """ AS id, *, CASE WHEN l_linestatus = 'O' THEN 'Holder' ELSE 'Ann' END AS first_name,
      CASE WHEN l_linestatus <> 'O' THEN 'Marie Holder' END AS middle_name, CAST(l_suppkey AS VARCHAR) AS last_name,
      CASE WHEN l_linenumber = 1 THEN 'TANZANIAN' WHEN l_linenumber < 6 THEN 'NON_TANZANIAN' END AS nationality FROM e)"""


def _existing_people(t: Tables, name: str, *columns):
    """Earlier people: one per supplier, some of whom are in the feed."""
    number, person = F.concat(F.lit("APP-"), "s_suppkey"), F.concat(F.lit("HOLDER "), "s_suppkey")
    return t.supplier.select(
        stable_key(number, F.lower(person)).alias("id"), person.alias(name), F.lit("gone").alias("application_sector_detail_id"), *columns
    )


_EXISTING_SQL = "t AS (SELECT " + uuid_sql("'APP-' || s_suppkey || '|holder ' || s_suppkey") + " AS id, 'HOLDER ' || s_suppkey AS person FROM supplier)"


def _shareholders(t: Tables) -> Workspace:
    nation_id = F.when(F.col("l_linenumber") < 6, F.concat(F.col("l_linenumber") - 1, F.lit("e+12")))
    extra = [
        nation_id.alias("nationality"),
        F.when(F.col("l_quantity") > 10, text("l_partkey")).otherwise(F.lit("x1")).alias("objectid"),
        F.when(F.col("l_quantity") > 20, F.concat("l_suppkey", F.lit(".5"))).alias("amountofshare"),
        F.col("l_returnflag").alias("indcomp"),
    ]
    earlier = _existing_people(t, "shareholder_name", F.lit("old street").alias("street_address"), F.lit("old").alias("individual_company"))
    ws = Workspace(_people_tables(t) | {"shareholders": earlier})
    return people.import_shareholders(ws, _person_feed(t, "SHName", extra), _countries(t), as_of=NOW)


@query(
    "import_shareholders",
    f"""WITH {_PERSON_SQL}, {_EXISTING_SQL} SELECT coalesce(t.id, k.id) AS id, k.application_id, CASE WHEN k.id IS NULL THEN 'gone' ELSE detail END AS application_sector_detail_id,
      coalesce(k.person, t.person) AS shareholder_name, first_name, middle_name, last_name, nationality,
      CASE WHEN l_quantity > 10 THEN l_partkey END AS logic_doc_id, CASE WHEN l_quantity > 20 THEN l_suppkey + 0.5 END AS amount_of_share_percent,
      coalesce(l_returnflag, 'old') AS individual_company, CASE WHEN t.id IS NOT NULL THEN 'old street' END AS street_address,
      CASE WHEN t.id IS NULL THEN 'insert' WHEN k.id IS NULL THEN 'keep' ELSE 'update' END AS _action
    FROM t FULL JOIN k ON t.id = k.id""",
)
def import_shareholders(t: Tables):
    columns = (
        "id, application_id, application_sector_detail_id, shareholder_name, first_name, middle_name, last_name, nationality, logic_doc_id, "
        "amount_of_share_percent, individual_company, street_address, _action"
    )
    return _shareholders(t).merged["shareholders"].select(*columns.split(", "))


@query(
    "import_shareholders_report",
    f"""WITH {_PERSON_SQL} SELECT count(*) AS processed, count(*) FILTER (application_id IS NOT NULL AND person IS NOT NULL) AS accepted,
      count(*) FILTER (application_id IS NULL OR person IS NULL) AS skipped_total, count(*) FILTER (application_id IS NULL) AS skipped_missing_application,
      count(*) FILTER (application_id IS NOT NULL AND person IS NULL) AS skipped_missing_name FROM z""",
)
def import_shareholders_report(t: Tables):
    return _shareholders(t).report("shareholders")


@query(
    "import_directors",
    f"""WITH {_PERSON_SQL}, {_EXISTING_SQL} SELECT coalesce(t.id, k.id) AS id, k.application_id, CASE WHEN k.id IS NULL THEN 'gone' ELSE coalesce(detail, 'gone') END AS application_sector_detail_id,
      coalesce(k.person, t.person) AS name, coalesce(first_name, CASE WHEN k.id IS NULL THEN 'OLD' END) AS first_name, middle_name, last_name, nationality,
      CAST(CASE WHEN l_quantity > 10 THEN l_partkey END AS VARCHAR) AS mobile_no, CASE WHEN l_quantity > 20 THEN l_suppkey * 1000 END AS work_permit,
      CASE WHEN t.id IS NULL THEN 'insert' WHEN k.id IS NULL THEN 'keep' ELSE 'update' END AS _action
    FROM t FULL JOIN k ON t.id = k.id""",
)
def import_directors(t: Tables):
    nation_id = F.when(F.col("l_linenumber") < 6, F.concat(F.col("l_linenumber") - 1, F.lit("e+12")))
    extra = [
        nation_id.alias("nationality1"),
        F.when(F.col("l_quantity") > 10, F.concat("l_partkey", F.lit(".0"))).otherwise(F.lit("x1")).alias("phoneno"),
        F.when(F.col("l_quantity") > 20, F.concat("l_suppkey", F.lit("e3"))).alias("workpermit"),
    ]
    earlier = _existing_people(t, "name", F.lit("OLD").alias("first_name"))
    ws = Workspace(_people_tables(t) | {"managing_directors": earlier})
    people.import_directors(ws, _person_feed(t, "Name", extra), _countries(t), as_of=NOW)
    columns = "id, application_id, application_sector_detail_id, name, first_name, middle_name, last_name, nationality, mobile_no, work_permit, _action"
    return ws.merged["managing_directors"].select(*columns.split(", "))


# --- electrical installations --------------------------------------------------------------------------------


def _installations(t: Tables) -> Workspace:
    rows = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
    status, priority = F.col("o_orderstatus"), F.col("o_orderpriority")
    codes = F.array(*[F.lit(c) for c in fixed.CLASS_CODES])
    code = F.get(codes, F.col("c_nationkey"))
    feed = rows.select(
        F.col("o_orderkey").alias("_row"),
        F.concat(F.lit("EL-"), "o_custkey").alias("Application Number"),
        F.expr(_TYPE_WORD).alias("application_type"),
        F.when(priority != "5-LOW", F.concat(F.lit("LIC-"), "o_orderkey")).alias("approval_no"),
        rendered_date().alias("effective_date"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("completed_at"),
        F.when(status == "P", F.concat(F.lit("Class  "), code)).otherwise(F.lower(code)).alias("licensecategoryclass"),
        F.when(status == "F", code).alias("approvedclass"),
        F.when(status == "O", F.col("c_name")).alias("facility_name"),
        F.concat(F.lit("Co "), "c_name").alias("company_name"),
        F.when(status == "P", F.lit("Self-Employed")).alias("employmentstatus"),
        F.when(status == "F", F.lit("Non Tanzanian")).alias("nationality"),
        F.concat("c_nationkey", F.lit(".0")).alias("region"),
        F.concat(F.lit("2557"), "o_custkey", F.lit(".0")).alias("mobile_no"),
        F.concat("o_orderkey", F.lit(".0")).alias("cpphoto"),
    )
    hub = t.customer.select(
        F.concat(F.lit("A"), "c_custkey").alias("id"),
        F.concat(F.lit("EL-"), F.col("c_custkey") * 2).alias("application_number"),
        F.lit("DRAFT").alias("status"),
        F.when(F.col("c_nationkey") > 12, F.lit("OLD")).alias("application_type"),
        F.lit("LICENSE_WATER").alias("license_type"),
        F.lit(False).alias("is_migrated"),
    )
    ws = Workspace({"applications": hub})
    return electrical.import_installations(ws, feed, locations(t), _zones(t), default_role=None, as_of=NOW)


_INSTALLATION_SQL = f"""WITH f AS (SELECT o_orderkey, 'EL-' || o_custkey AS number, o_orderstatus AS st, c_name, c_nationkey, o_custkey, n_name, CAST(n_regionkey AS VARCHAR) AS zone_id,
      CASE o_orderpriority WHEN '1-URGENT' THEN 'RENEW' WHEN '2-HIGH' THEN 'EXTENSION' WHEN '3-MEDIUM' THEN 'CHANGES' WHEN '4-NOT SPECIFIED' THEN 'UPGRADE' ELSE 'ODD' END AS type,
      CASE WHEN o_orderpriority <> '5-LOW' THEN 'LIC-' || o_orderkey END AS approval_no, {parsed_date_sql(RENDERED_DATE_SQL)} AS any_date, o_orderpriority,
      CAST(o_orderdate AS DATE) AS approval_date, [{', '.join(f"'{c}'" for c in fixed.CLASS_CODES)}][c_nationkey + 1] AS code
    FROM orders JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey),
  s AS (SELECT *, {uuid_sql("'application|' || number")} AS sid, {uuid_sql("'class|class ' || lower(code)")} AS class_id,
      CASE WHEN o_orderpriority <> '1-URGENT' THEN any_date END AS effective_date FROM f QUALIFY row_number() OVER (PARTITION BY number ORDER BY o_orderkey) = 1),
  t AS (SELECT 'A' || c_custkey AS id, 'EL-' || c_custkey * 2 AS number, CASE WHEN c_nationkey > 12 THEN 'OLD' END AS old_type FROM customer),
  hub AS (SELECT coalesce(t.id, sid) AS id, coalesce(t.number, s.number) AS application_number, coalesce(old_type, type) AS application_type, approval_no, approval_date,
      CASE WHEN s.number IS NULL THEN 'DRAFT' ELSE 'APPROVED' END AS status, s.number IS NOT NULL AS is_migrated, class_id AS category_id, effective_date,
      CASE WHEN t.number IS NULL THEN 'LICENSE_ELECTRICITY_INSTALLATION' ELSE 'LICENSE_WATER' END AS license_type, zone_id,
      CASE WHEN t.number IS NULL THEN 'insert' WHEN s.number IS NULL THEN 'keep' ELSE 'update' END AS _action,
      s.type AS staged_type, st, c_name, code, n_name, o_custkey, o_orderkey
    FROM t FULL JOIN s ON t.number = s.number),
  r AS (SELECT *, {uuid_sql("id || '|aei'")} AS aei FROM hub WHERE _action <> 'keep')"""


@query(
    "import_installations",
    f"""{_INSTALLATION_SQL} SELECT id, application_number, application_type, approval_no, approval_date, status, is_migrated, category_id, effective_date, license_type, zone_id, _action FROM hub""",
)
def import_installations(t: Tables):
    columns = "id, application_number, application_type, approval_no, approval_date, status, is_migrated, category_id, effective_date, license_type, zone_id, _action"
    return _installations(t).merged["applications"].select(*columns.split(", "))


@query(
    "import_installation_children",
    f"""{_INSTALLATION_SQL} SELECT 'application_electrical_installation' AS table_name, aei AS id, id AS application_id, 'Co ' || c_name AS a,
        CASE WHEN st = 'P' THEN 'SELF_EMPLOYED' ELSE 'EMPLOYED' END AS b, CASE WHEN st = 'F' THEN category_id END AS c FROM r
      UNION ALL SELECT 'contact_details', {uuid_sql("aei || '|cd'")}, id, n_name, '2557' || o_custkey, NULL FROM r
      UNION ALL SELECT 'personal_details', {uuid_sql("aei || '|pd'")}, id, CASE WHEN st = 'F' THEN 'NON_TANZANIAN' END, NULL, NULL FROM r
      UNION ALL SELECT 'attachments', {uuid_sql("aei || '|att'")}, id, NULL, CAST(o_orderkey AS VARCHAR), NULL FROM r
      UNION ALL SELECT 'self_employed', {uuid_sql("aei || '|se'")}, id, 'NONE', NULL, NULL FROM r WHERE st = 'P'
      UNION ALL SELECT 'certificates', {uuid_sql("'certificate|' || application_number")}, id, CASE WHEN st = 'O' THEN c_name ELSE 'Co ' || c_name END, license_type, staged_type FROM r""",
)
def import_installation_children(t: Tables):
    merged = _installations(t).merged
    nothing = F.lit(None).cast("string")
    columns = {
        "application_electrical_installation": ("applicant_name", "experience_type", "approved_class_id"),
        "contact_details": ("region", "mobile_no", None),
        "personal_details": ("nationality", "gender", None),
        "attachments": ("identification", "passport", None),
        "self_employed": ("voltage_level", "voltage", None),
        "certificates": ("certificate_owner", "license_type", "application_certificate_type"),
    }
    out = None
    for name, fields in columns.items():
        values = [(F.col(c) if c else nothing).alias(n) for c, n in zip(fields, "abc")]
        part = merged[name].select(F.lit(name).alias("table_name"), "id", "application_id", *values)
        out = part if out is None else out.unionByName(part)
    return out


@query(
    "import_installation_certificate_ids",
    f"""{_INSTALLATION_SQL} SELECT id, CASE WHEN _action <> 'keep' THEN {uuid_sql("'certificate|' || application_number")} END AS certificate_id FROM hub""",
)
def import_installation_certificate_ids(t: Tables):
    return _installations(t).tables["applications"].select("id", "certificate_id")


# --- experience ---------------------------------------------------------------------------------------------------


def _experience_tables(t: Tables):
    hub = t.customer.select(F.concat(F.lit("A"), "c_custkey").alias("id"), F.concat(F.lit("EL-"), "c_custkey").alias("application_number"))
    kind = F.when(F.col("c_nationkey") > 18, F.lit("self-employed")).when(F.col("c_nationkey") > 12, F.lit("SELF_EMPLOYED"))
    # All customers have an installation; some of these have lost their application.
    application = F.when(F.col("c_nationkey") > 5, F.concat(F.lit("A"), "c_custkey"))
    installations = t.customer.select(F.concat(F.lit("I"), "c_custkey").alias("id"), application.alias("application_id"), kind.alias("experience_type"))
    return {"applications": hub, "application_electrical_installation": installations}


_EXPERIENCE_SQL = """WITH x AS (SELECT o_orderkey, o_orderstatus AS st, o_orderpriority AS pr, CAST(o_orderdate AS DATE) AS d, c_custkey, c_nationkey,
      'A' || c_custkey AS app, CASE WHEN c_nationkey > 5 THEN 'I' || c_custkey END AS aei, coalesce(CASE WHEN c_nationkey > 5 THEN 'I' || c_custkey END, 'A' || c_custkey) AS owner,
      CASE WHEN c_nationkey > 18 THEN 'self-employed' WHEN c_nationkey > 12 THEN 'SELF_EMPLOYED' END AS kind,
      CASE WHEN o_orderstatus = 'P' THEN CAST(CAST(date_trunc('year', o_orderdate) AS DATE) AS VARCHAR) || ' 00:00:00' ELSE '' END AS from_text,
      CASE WHEN o_orderstatus = 'P' THEN date_trunc('year', o_orderdate) END AS from_date
    FROM orders JOIN customer ON c_custkey = o_custkey)"""


def _experience_feed(t: Tables):
    status = F.col("o_orderstatus")
    person = F.when(status == "P", F.concat(F.lit("Jo Doe | BOSS | 0712 345 678 | j"), "o_custkey", F.lit("@x.org"))).when(
        status == "F", F.concat(F.lit("Al Fox,FITTER,"), "o_orderpriority")
    )
    return t.orders.select(
        F.col("o_orderkey").alias("_row"),
        F.concat(F.lit("EL-"), "o_custkey").alias("App Ref No"),
        person.alias("Supervisor Details"),
        F.lit(None).cast("string").alias("role"),
        F.col("o_orderstatus").alias("voltage"),
        F.lit("wiring").alias("work_done"),
        F.when(F.col("o_orderpriority") == "1-URGENT", F.lit("lead")).alias("position"),
        F.when(status == "P", F.date_format(F.trunc("o_orderdate", "year"), "d/M/yyyy HH:mm")).otherwise(F.lit("?")).alias("from_date"),
        F.lit("").alias("to_date"),
    )


def _supervisors(t: Tables) -> Workspace:
    return experience.import_supervisors(Workspace(_experience_tables(t)), _experience_feed(t), as_of=NOW)


_WORK_KEY = uuid_sql("owner || '|we|' || from_text || '||' || st || '|wiring|' || CASE WHEN pr = '1-URGENT' THEN 'lead' ELSE '' END || '|'")
_SUPERVISOR_TEXT = (
    "CASE st WHEN 'P' THEN 'Jo Doe | BOSS | 0712 345 678 | j' || c_custkey || '@x.org' WHEN 'F' THEN 'Al Fox,FITTER,' || pr END"
)


@query(
    "import_work_experience",
    f"""{_EXPERIENCE_SQL}, k AS (SELECT {_WORK_KEY} AS id, * FROM x QUALIFY row_number() OVER (PARTITION BY id ORDER BY o_orderkey) = 1)
    SELECT id, app AS application_id, aei AS application_electrical_installation_id, from_date, CAST(NULL AS TIMESTAMP) AS to_date, 'NONE' AS voltage_level,
      st AS voltage, {_SUPERVISOR_TEXT} AS name_of_employer, CASE WHEN pr = '1-URGENT' THEN 'lead' END AS position, 'insert' AS _action FROM k""",
)
def import_work_experience(t: Tables):
    columns = "id, application_id, application_electrical_installation_id, from_date, to_date, voltage_level, voltage, name_of_employer, position, _action"
    return _supervisors(t).merged["work_experience"].select(*columns.split(", "))


_SUPERVISOR_KEY = uuid_sql("owner || '|sd|' || person || '|' || CASE WHEN pr = '1-URGENT' THEN 'lead' ELSE '' END")


@query(
    "import_supervisors",
    f"""{_EXPERIENCE_SQL}, p AS (SELECT *, {_SUPERVISOR_TEXT} AS person, {_WORK_KEY} AS we FROM x), k AS (SELECT {_SUPERVISOR_KEY} AS id, * FROM p WHERE person IS NOT NULL
      QUALIFY row_number() OVER (PARTITION BY id ORDER BY o_orderkey) = 1)
    SELECT id, app AS application_id, aei AS application_electrical_installation_id, we AS work_experience_id, CASE st WHEN 'P' THEN 'Jo Doe' ELSE 'Al Fox' END AS name,
      CASE WHEN pr = '1-URGENT' THEN 'lead' END AS position, CASE st WHEN 'P' THEN 'j' || c_custkey || '@x.org' END AS email, CASE st WHEN 'P' THEN '0712345678' END AS mobile_no FROM k""",
)
def import_supervisors(t: Tables):
    columns = "id, application_id, application_electrical_installation_id, work_experience_id, name, position, email, mobile_no"
    return _supervisors(t).merged["supervisor_details"].select(*columns.split(", "))


@query(
    "import_supervisor_details",
    f"""{_EXPERIENCE_SQL}, p AS (SELECT *, {_SUPERVISOR_TEXT} AS person FROM x), k AS (SELECT {_SUPERVISOR_KEY} AS id, * FROM p WHERE person IS NOT NULL
      QUALIFY row_number() OVER (PARTITION BY id ORDER BY o_orderkey) = 1),
      e AS (SELECT {uuid_sql("owner || '|se|' || from_text || '||' || st || '|wiring'")} AS id, * FROM x WHERE kind = 'SELF_EMPLOYED'
        QUALIFY row_number() OVER (PARTITION BY id ORDER BY o_orderkey) = 1)
    SELECT 'supervisor_details' AS table_name, id, app AS application_id, person AS name, CAST(NULL AS TIMESTAMP) AS from_date FROM k
      UNION ALL SELECT 'self_employed', id, app, 'wiring', from_date FROM e""",
)
def import_supervisor_details(t: Tables):
    ws = experience.import_supervisor_details(Workspace(_experience_tables(t)), _experience_feed(t), as_of=NOW)
    supervisors = ws.merged["supervisor_details"].select(
        F.lit("supervisor_details").alias("table_name"), "id", "application_id", "name", F.lit(None).cast("timestamp").alias("from_date")
    )
    projects = ws.merged["self_employed"].select(
        F.lit("self_employed").alias("table_name"), "id", "application_id", F.col("project_performed").alias("name"), "from_date"
    )
    return supervisors.unionByName(projects)


def _self_employed(t: Tables) -> Workspace:
    status = F.col("o_orderstatus")
    feed = t.orders.select(
        F.col("o_orderkey").alias("_row"),
        F.concat(F.lit("EL-"), "o_custkey").alias("apprefno"),
        F.col("o_orderpriority").alias("S/N"),
        status.alias("Voltage"),
        F.concat(F.lit("details "), "o_orderkey").alias("custom_details"),
        F.lit("house").alias("project_performed"),
        F.when(status == "P", F.date_format(F.trunc("o_orderdate", "year"), "yyyy/M/d")).alias("from_date"),
        F.lit("nan").alias("to_date"),
    )
    return experience.import_self_employed(Workspace(_experience_tables(t)), feed, as_of=NOW)


@query(
    "import_self_employed",
    f"""{_EXPERIENCE_SQL}, e AS (SELECT {uuid_sql("aei || '|se_upload|' || pr || '|' || from_text || '||' || st || '|house'")} AS id, * FROM x WHERE kind IS NOT NULL
        QUALIFY row_number() OVER (PARTITION BY id ORDER BY o_orderkey) = 1)
    SELECT 'self_employed' AS table_name, id, app AS application_id, aei AS parent, 'house' AS name, from_date FROM e
      UNION ALL SELECT 'custom_details', {uuid_sql("id || '|custom_details'")}, app, id, 'details ' || o_orderkey, NULL FROM e""",
)
def import_self_employed(t: Tables):
    ws = _self_employed(t)
    projects = ws.merged["self_employed"].select(
        F.lit("self_employed").alias("table_name"),
        "id",
        "application_id",
        F.col("application_electrical_installation_id").alias("parent"),
        F.col("project_performed").alias("name"),
        "from_date",
    )
    custom = ws.merged["custom_details"].select(
        F.lit("custom_details").alias("table_name"),
        "id",
        "application_id",
        F.col("self_employed_details_id").alias("parent"),
        "name",
        F.lit(None).cast("timestamp").alias("from_date"),
    )
    return projects.unionByName(custom)


@query(
    "import_self_employed_funnel",
    f"{_EXPERIENCE_SQL} SELECT count(*) AS staged, count(app) AS with_application, count(aei) AS with_installation, count(kind) AS self_employed FROM x",
)
def import_self_employed_funnel(t: Tables):
    return experience.self_employed_funnel(_self_employed(t))


@query(
    "import_verifications",
    f"""{_EXPERIENCE_SQL}, k AS (SELECT {uuid_sql("app || '|cv|' || 'Institute ' || st || '|' || pr || '|' || c_custkey || '|f.pdf'")} AS id, * FROM x
        QUALIFY row_number() OVER (PARTITION BY id ORDER BY o_orderkey) = 1)
    SELECT id, app AS application_id, aei AS application_electrical_installation_id, CAST(d AS TIMESTAMP) AS from_date, 'NONE' AS education_regulatory_body,
      c_custkey AS logic_doc_id, 'f.pdf' AS file_name, 'insert' AS _action FROM k""",
)
def import_verifications(t: Tables):
    feed = t.orders.select(
        F.col("o_orderkey").alias("_row"),
        F.concat(F.lit("EL-"), "o_custkey").alias("apprefno"),
        F.concat(F.lit("Institute "), "o_orderstatus").alias("institutenameaddress"),
        F.col("o_orderpriority").alias("award"),
        F.date_format("o_orderdate", "dd-MM-yyyy").alias("fromdate"),
        F.concat("o_custkey", F.lit(".0")).alias("objectid"),
        F.lit("f.pdf").alias("filename"),
    )
    ws = experience.import_verifications(Workspace(_experience_tables(t)), feed, as_of=NOW)
    columns = "id, application_id, application_electrical_installation_id, from_date, education_regulatory_body, logic_doc_id, file_name, _action"
    return ws.merged["certificate_verifications"].select(*columns.split(", "))


# --- water ------------------------------------------------------------------------------------------------------------


def _water(t: Tables) -> Workspace:
    rows = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
    status, priority = F.col("o_orderstatus"), F.col("o_orderpriority")
    feed = rows.select(
        F.col("o_orderkey").alias("_row"),
        F.concat(F.when(F.col("o_orderkey") % 2 == 0, F.lit("W-")).otherwise(F.lit("w-")), "o_custkey").alias("apprefno"),
        F.expr(_TYPE_WORD).alias("application_type"),
        F.concat(F.lit("LIC-"), "o_orderkey").alias("licenceno"),
        F.when(status == "P", F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss")).otherwise(F.lit("soon")).alias("effective_date"),
        F.when(status == "P", F.lit("Water License")).when(status == "F", F.lit("LICENSE_PETROLEUM")).otherwise(F.lit("?")).alias("license_type"),
        F.concat(F.lit("Clerk."), status).alias("userid"),
        F.col("c_name").alias("company_name"),
        F.when(priority == "1-URGENT", F.concat(F.lit("V"), "o_orderkey")).alias("vrnno"),
        F.when(status == "O", F.lit("Bank")).alias("bname"),
        F.when(status == "F", F.lit("0712")).alias("cmobile_no"),
        F.when(status == "P", text("o_orderkey")).alias("amount"),
        F.when(priority == "2-HIGH", F.lit("12")).alias("nofcustomer"),
        F.lit("d1").alias("tinc"),
        F.when(status == "P", F.lit("tin.pdf")).alias("tincfilename"),
        F.lit("qmp.pdf").alias("qmpfilename"),
    )
    hub = t.customer.select(
        F.concat(F.lit("A"), "c_custkey").alias("id"),
        F.concat(F.lit("W-"), F.col("c_custkey") * 2).alias("application_number"),
        F.lit("OLD").alias("application_type"),
        F.lit("LICENSE_WATER").alias("license_type"),
        F.lit(True).alias("is_migrated"),
        F.when(F.col("c_nationkey") > 12, F.lit("boss")).alias("created_by"),
    )
    users = t.spark.sql("SELECT * FROM VALUES ('u1', 'CLERK.p '), ('u2', 'clerk.f') AS u(id, username)")
    return water.import_water(Workspace({"applications": hub, "users": users}), feed, default_role=None, as_of=NOW)


_WATER_SQL = f"""WITH s AS (SELECT CASE WHEN o_orderkey % 2 = 0 THEN 'W-' ELSE 'w-' END || o_custkey AS number, o_orderkey, o_orderstatus AS st, o_orderpriority AS pr, c_name, CAST(o_orderdate AS DATE) AS d,
      CASE o_orderpriority WHEN '1-URGENT' THEN 'RENEW' WHEN '2-HIGH' THEN 'EXTEND' WHEN '4-NOT SPECIFIED' THEN 'UPGRADE' END AS type,
      CASE o_orderstatus WHEN 'P' THEN 'LICENSE_WATER' WHEN 'F' THEN 'LICENSE_PETROLEUM' END AS lt,
      CASE o_orderstatus WHEN 'P' THEN 'u1' WHEN 'F' THEN 'u2' ELSE {uuid_sql("'user|clerk.o'")} END AS uid
    FROM orders JOIN customer ON c_custkey = o_custkey QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) = 1),
  t AS (SELECT 'A' || c_custkey AS id, 'W-' || c_custkey * 2 AS number, CASE WHEN c_nationkey > 12 THEN 'boss' END AS boss FROM customer),
  hub AS (SELECT coalesce(t.id, {uuid_sql("'WATER_APP:' || lower(s.number)")}) AS id, coalesce(t.number, s.number) AS application_number,
      coalesce(type, CASE WHEN t.id IS NOT NULL THEN 'OLD' END) AS application_type, CASE WHEN s.number IS NOT NULL THEN 'LIC-' || o_orderkey END AS approval_no,
      CASE WHEN st = 'P' THEN d END AS effective_date, coalesce(lt, CASE WHEN t.id IS NOT NULL THEN 'LICENSE_WATER' END) AS license_type,
      coalesce(boss, uid) AS created_by, CASE WHEN t.number IS NULL THEN 'insert' WHEN s.number IS NULL THEN 'keep' ELSE 'update' END AS _action,
      st, pr, c_name, o_orderkey, lt, type, lower(s.number) AS k FROM t FULL JOIN s ON lower(t.number) = lower(s.number)),
  r AS (SELECT *, {uuid_sql("'WATER_ASD:' || k")} AS asd FROM hub WHERE _action <> 'keep')"""


@query(
    "import_water",
    f"{_WATER_SQL} SELECT id, application_number, application_type, approval_no, effective_date, license_type, created_by, _action FROM hub",
)
def import_water(t: Tables):
    columns = "id, application_number, application_type, approval_no, effective_date, license_type, created_by, _action"
    return _water(t).merged["applications"].select(*columns.split(", "))


def _water_child_sql(kind: str, table: str, value: str, where: str) -> str:
    seed = uuid_sql(f"'WATER_{kind}:' || k")
    return f"SELECT '{table}' AS table_name, {seed} AS id, id AS application_id, {value} AS value FROM r WHERE {where}"


@query(
    "import_water_children",
    _WATER_SQL
    + " UNION ALL ".join(
        [
            " SELECT 'application_sector_details' AS table_name, asd AS id, id AS application_id, CASE WHEN pr = '1-URGENT' THEN 'V' || o_orderkey END AS value FROM r",
            _water_child_sql("REFEREE", "referees", "'0712'", "st = 'F'"),
            _water_child_sql("BANK_TZ", "bank_details_tanzania", "'Bank'", "st = 'O'"),
            _water_child_sql("FI", "financial_information", f"CASE WHEN st = 'O' THEN {uuid_sql(chr(39) + 'WATER_BANK_TZ:' + chr(39) + ' || k')} END", "true"),
            _water_child_sql("API", "applicant_proposed_investment", "CAST(o_orderkey AS VARCHAR)", "st = 'P'"),
            _water_child_sql("PD", "project_description", "'12'", "pr = '2-HIGH'"),
            _water_child_sql("DOC:TIN_CERTIFICATE", "documents", "'1 d1 tin.pdf'", "st = 'P'"),
            _water_child_sql("DOC:QMP", "documents", "'28 qmp.pdf'", "true"),
            f"SELECT 'certificates', {uuid_sql(chr(39) + 'certificate|' + chr(39) + ' || k')}, id, coalesce(type, 'NEW') || ' WATER_SUPPLY' FROM r",
        ]
    ),
)
def import_water_children(t: Tables):
    merged = _water(t).merged
    values = {
        "application_sector_details": F.col("vrn"),
        "referees": F.col("telephone_no"),
        "bank_details_tanzania": F.col("name_of_banker"),
        "financial_information": F.col("bank_details_tz_id"),
        "applicant_proposed_investment": F.col("amount"),
        "project_description": F.col("number_of_customer"),
        "documents": F.concat_ws(" ", "documents_order", "document_url", "file_name"),
        "certificates": F.concat_ws(" ", "application_certificate_type", "sector"),
    }
    out = None
    for name, value in values.items():
        part = merged[name].select(F.lit(name).alias("table_name"), "id", "application_id", value.alias("value"))
        out = part if out is None else out.unionByName(part)
    return out


# --- categories, fees, users ----------------------------------------------------------------------------------------------


def _fees(t: Tables) -> Workspace:
    small = F.col("p_size") <= 10
    feed = t.part.select(
        F.col("p_partkey").alias("_row"),
        F.when(F.col("p_size") > 25, F.upper("p_name")).otherwise(F.col("p_name")).alias("CategoryOrClass"),
        F.when(F.col("p_type") == "SMALL", F.lit("Provisional License")).otherwise(F.lit("construction")).alias("licencetype"),
        F.when(F.col("p_type") != "LARGE", F.lower("p_type")).alias("applicationtype"),
        F.when(small, F.lit("x")).otherwise(F.concat("p_size", F.lit(".5"))).alias("capacity_from"),
        F.when(~small, F.lit("Above")).alias("capacityto"),
        F.when(small, F.lit("x")).otherwise(text("p_partkey")).alias("appfee"),
        F.concat("p_partkey", F.lit("00")).alias("licencefee"),
        F.col("p_brand").alias("prefix"),
        F.lit("").alias("licenseprefix"),
        F.when(small, F.lit("12.0")).alias("licenseperiod"),
        F.when(F.col("p_type") == "SMALL", F.lit("Yes")).alias("has_fee_range"),
    )
    categories = t.part.groupBy(F.initcap("p_name").alias("name")).agg(
        F.concat(F.lit("C"), F.min("p_partkey")).alias("id"), F.lit(True).alias("apply_thereof"), (F.min("p_size") > 1).alias("has_fee_range")
    )
    # Earlier fees: those of economy parts stand for a slot of this upload, the others for none.
    of_name = categories.select(F.lower("name").alias("k"), F.col("id").alias("category_id"))
    economy = F.col("p_type") == "ECONOMY"
    earlier = t.part.join(of_name, F.lower("p_name") == F.col("k")).select(
        F.concat(F.lit("F"), "p_partkey").alias("id"),
        F.when(economy, F.col("category_id")).otherwise(F.lit("none")).alias("category_id"),
        F.lit("ACTIVE").alias("status"),
        F.when(economy, F.lit("economy ")).alias("application_type"),
        F.when(economy, F.lit("OPERATIONAL")).alias("license_type"),
        F.when(economy, F.when(small, F.lit(1)).otherwise(F.col("p_size") + 0.5)).cast("decimal(38,6)").alias("capacity_from"),
        F.when(economy, F.when(small, F.lit("10")).otherwise(F.lit("Above"))).alias("capacity_to"),
        F.when(economy, F.upper("p_brand")).alias("application_prefix"),
        F.when(economy, F.lit("ECBL")).alias("license_prefix"),
        F.when(economy, F.when(small, F.lit(12)).otherwise(F.lit(36))).cast("bigint").alias("months_eligible"),
    )
    ws = Workspace({"categories": categories, "application_category_fees": earlier})
    return fees.import_categories_and_fees(ws, feed, "ELECTRICITY", sector_id="S1", as_of=NOW)


_FEE_SQL = f"""WITH x AS (SELECT p_partkey AS row_no, CASE WHEN p_size > 25 THEN upper(p_name) ELSE p_name END AS category, lower(p_name) AS k,
      CASE WHEN p_type = 'SMALL' THEN 'PROVISIONAL' ELSE 'OPERATIONAL' END AS license_type, CASE WHEN p_type = 'LARGE' THEN 'NEW' ELSE upper(p_type) END AS application_type,
      CASE WHEN p_size <= 10 THEN 1 ELSE p_size + 0.5 END AS capacity_from, CASE WHEN p_size <= 10 THEN '10' ELSE 'Above' END AS capacity_to,
      CASE WHEN p_size <= 10 THEN 240000 ELSE p_partkey END AS application_fee, p_partkey * 100 AS license_fee, p_brand AS application_prefix,
      CASE WHEN p_size <= 10 THEN 12 ELSE 36 END AS months_eligible, p_type = 'SMALL' AS range FROM part),
  cat AS (SELECT lower(p_name) AS k, 'C' || min(p_partkey) AS id, min(p_size) > 1 AS old_range FROM part GROUP BY 1),
  first AS (SELECT * FROM x QUALIFY row_number() OVER (PARTITION BY k ORDER BY row_no) = 1)"""


@query(
    "import_categories",
    f"""{_FEE_SQL} SELECT id, category AS name, old_range OR range AS has_fee_range, TRUE AS apply_thereof, 'HV' AS voltage_level, 'update' AS _action
      FROM cat JOIN first ON first.k = cat.k""",
)
def import_categories(t: Tables):
    return _fees(t).merged["categories"].select("id", "name", "has_fee_range", "apply_thereof", "voltage_level", "_action")


@query(
    "import_fees",
    f"""{_FEE_SQL}, slot AS (SELECT x.*, id AS category_id FROM x JOIN cat ON cat.k = x.k QUALIFY row_number() OVER
        (PARTITION BY id, application_type, license_type, capacity_from, capacity_to, application_prefix, months_eligible ORDER BY row_no) = 1),
    e AS (SELECT id AS category_id, application_type, license_type, capacity_from, capacity_to, application_prefix, months_eligible, TRUE AS known
      FROM x JOIN cat ON cat.k = x.k WHERE application_type = 'ECONOMY')
    SELECT category_id, CASE WHEN known THEN 'ACTIVE' ELSE 'NOT_ACTIVE' END AS status, license_type, application_type, CAST(capacity_from AS DECIMAL(38,6)) AS capacity_from, capacity_to,
      CAST(application_fee AS DECIMAL(38,6)) AS application_fee, CAST(license_fee AS DECIMAL(38,6)) AS license_fee, CAST(0 AS DECIMAL(38,6)) AS annual_fee,
      application_prefix, 'ECBL' AS license_prefix, CAST(months_eligible AS BIGINT) AS months_eligible, CASE WHEN known THEN 'update' ELSE 'insert' END AS _action
      FROM slot LEFT JOIN e USING (category_id, application_type, license_type, capacity_from, capacity_to, application_prefix, months_eligible)
    UNION ALL SELECT 'none', 'ACTIVE', NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, 'keep' FROM part WHERE p_type <> 'ECONOMY'""",
)
def import_fees(t: Tables):
    columns = (
        "category_id, status, license_type, application_type, capacity_from, capacity_to, application_fee, license_fee, annual_fee, "
        "application_prefix, license_prefix, months_eligible, _action"
    )
    return _fees(t).merged["application_category_fees"].select(*columns.split(", "))


def _category_upload(t: Tables) -> Workspace:
    sector = F.expr("CASE p_type WHEN 'ECONOMY' THEN ' petroleum' WHEN 'SMALL' THEN 'Electricity' ELSE 'unknown' END")
    name = F.when(F.col("p_size") > 45, F.lit("none")).otherwise(F.concat("p_name", F.lit(" "), "p_brand"))
    feed = t.part.select(F.col("p_partkey").alias("_row"), name.alias("Category Name"), sector.alias("Sector/Name"))
    earlier = t.part.groupBy(F.concat("p_name", F.lit(" "), "p_brand").alias("name")).agg(F.min("p_size").alias("least"))
    # All names, blank where the category is new.
    earlier = earlier.select(F.upper("name").alias("id"), F.when(F.col("least") == 1, F.col("name")).alias("name"))
    ws = Workspace({"categories": earlier, "sectors": _categories(t)[1]})
    return directory.import_categories(ws, feed, as_of=NOW)


_UPLOAD_SQL = """WITH f AS (SELECT p_partkey, p_name || ' ' || p_brand AS name, CASE p_type WHEN 'ECONOMY' THEN '0' WHEN 'SMALL' THEN '2' END AS sector_id FROM part WHERE p_size <= 45),
  t AS (SELECT upper(p_name || ' ' || p_brand) AS id, CASE WHEN min(p_size) = 1 THEN p_name || ' ' || p_brand END AS name FROM part GROUP BY p_name || ' ' || p_brand),
  n AS (SELECT * FROM f WHERE sector_id IS NOT NULL AND lower(name) NOT IN (SELECT lower(name) FROM t WHERE name IS NOT NULL) QUALIFY row_number() OVER (PARTITION BY lower(name) ORDER BY p_partkey) = 1)"""


@query(
    "import_category_upload",
    f"""{_UPLOAD_SQL} SELECT id, name, NULL AS sector_id, 'keep' AS _action FROM t UNION ALL
      SELECT {uuid_sql("'category|' || lower(name)")}, name, sector_id, 'insert' FROM n""",
)
def import_category_upload(t: Tables):
    return _category_upload(t).merged["categories"].select("id", "name", "sector_id", "_action")


@query(
    "import_category_report",
    f"""{_UPLOAD_SQL} SELECT count(*) AS processed, count(*) - count(sector_id) AS skipped_no_sector, (SELECT count(*) FROM n) AS inserted,
      count(sector_id) - (SELECT count(*) FROM n) AS skipped_existing FROM f""",
)
def import_category_report(t: Tables):
    return directory.category_upload_report(_category_upload(t))


def _user_feed(t: Tables):
    return t.events.select(
        F.col("event_id").alias("_row"),
        F.when(F.col("event_type") != "view", F.col("event_type")).alias("firstname"),
        F.concat(F.lit("L"), "user_id").alias("lastname"),
        F.concat(F.when(F.col("event_id") % 2 == 0, F.lit("USER")).otherwise(F.lit(" user")), "user_id").alias("username"),
        F.lit("secret").alias("password"),
        F.when(F.col("event_type") == "error", F.lit("locked")).alias("status"),
        F.concat(F.lit("07"), "event_id").alias("mobilenumber"),
        F.lit("nan").alias("emailid"),
        F.lit(None).cast("string").alias("user_category"),
        F.lit("company").alias("account_type"),
        F.lit("").alias("auth_mode"),
        F.concat("event_type", F.lit(" ")).alias("role"),
    )


def _user_tables(t: Tables):
    users = t.customer.select(
        text("c_custkey").alias("id"), F.concat(F.lit("user"), F.col("c_custkey") * 2).alias("username"), F.lit("Old Name").alias("full_name")
    )
    roles = t.spark.sql("SELECT 'r1' AS id, 'View ' AS name")
    return {"users": users, "roles": roles}


_USERS_SQL = f"""WITH s AS (SELECT CASE WHEN event_id % 2 = 0 THEN 'USER' ELSE 'user' END || user_id AS username, CASE WHEN event_type <> 'view' THEN event_type ELSE '' END || ' L' || user_id AS full_name,
      CASE WHEN event_type = 'error' THEN 'LOCKED' ELSE 'ACTIVE' END AS status, '07' || event_id AS phone_number
    FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) = 1),
  t AS (SELECT CAST(c_custkey AS VARCHAR) AS id, 'user' || c_custkey * 2 AS username FROM customer),
  u AS (SELECT coalesce(t.id, {uuid_sql("'user|' || lower(s.username)")}) AS id, coalesce(t.username, s.username) AS username, coalesce(s.full_name, 'Old Name') AS full_name,
      s.status, s.phone_number, CASE WHEN s.username IS NOT NULL THEN 'COMPANY' END AS account_type, CASE WHEN s.username IS NOT NULL THEN 'DB' END AS auth_mode,
      CASE WHEN t.id IS NULL THEN 'insert' WHEN s.username IS NULL THEN 'keep' ELSE 'update' END AS _action FROM t FULL JOIN s ON t.username = lower(s.username))"""


@query("import_users", f"{_USERS_SQL} SELECT * FROM u")
def import_users(t: Tables):
    ws = directory.import_users(Workspace(_user_tables(t)), _user_feed(t), as_of=NOW)
    return ws.merged["users"].select("id", "username", "full_name", "status", "phone_number", "account_type", "auth_mode", "_action")


@query(
    "import_users_skip_existing",
    f"""{_USERS_SQL} SELECT id, username, CASE WHEN _action = 'insert' THEN full_name ELSE 'Old Name' END AS full_name, CASE WHEN _action = 'insert' THEN status END AS status,
      replace(_action, 'update', 'keep') AS _action FROM u""",
)
def import_users_skip_existing(t: Tables):
    ws = directory.import_users(Workspace(_user_tables(t)), _user_feed(t), skip_existing=True, as_of=NOW)
    return ws.merged["users"].select("id", "username", "full_name", "status", "_action")


@query(
    "import_user_roles",
    f"""{_USERS_SQL} SELECT DISTINCT u.id AS user_id, CASE event_type WHEN 'view' THEN 'r1' ELSE {uuid_sql("'role|' || event_type")} END AS role_id, 'insert' AS _action
      FROM events JOIN u ON lower(u.username) = 'user' || user_id""",
)
def import_user_roles(t: Tables):
    ws = directory.import_users(Workspace(_user_tables(t)), _user_feed(t), as_of=NOW)
    return ws.merged["user_roles"]
