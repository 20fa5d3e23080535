"""Dedupe, joins, aggregates, reshaping, reconciliation over the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerlift.functions import key_text
from ledgerlift.operators import dedupe, joins, profile, reconcile, reshape
from ledgerlift.operators.reshape import Pair
from ledgerlift.sources import dimensions, grid, legacy
from workload.registry import Tables, query

LINE = ["l_orderkey", "l_linenumber"]
LINE_REST = [
    "l_partkey",
    "l_suppkey",
    "l_quantity",
    "l_extendedprice",
    "l_discount",
    "l_tax",
    "l_returnflag",
    "l_linestatus",
]
_REST_SQL = ", ".join(f"{c} ASC NULLS LAST" for c in LINE_REST)


# --- one row per key ---------------------------------------------------------------------------


def _dates(t: Tables):
    """Line items with an update date that is missing on returned lines."""
    updated = F.when(F.col("l_returnflag") != "R", F.col("l_shipdate"))
    created = F.when(F.col("l_linestatus") == "O", F.col("l_shipdate"))
    return t.lineitem.withColumn("updated_at", updated).withColumn("created_at", created)


_DATES_SQL = """WITH x AS (SELECT *, CASE WHEN l_returnflag <> 'R' THEN l_shipdate END AS updated_at,
  CASE WHEN l_linestatus = 'O' THEN l_shipdate END AS created_at FROM lineitem)"""


@query(
    "keep_newest",
    f"""{_DATES_SQL} SELECT * FROM x QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY
      updated_at DESC NULLS LAST, created_at DESC NULLS LAST, l_shipdate ASC NULLS LAST, {_REST_SQL}) = 1""",
)
def keep_newest(t: Tables):
    return dedupe.keep_newest(_dates(t), LINE, tiebreak=["l_shipdate", *LINE_REST])


@query(
    "keep_newest_by_creation",
    f"""{_DATES_SQL} SELECT * FROM x QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY
      coalesce(updated_at, created_at) DESC NULLS LAST, created_at DESC NULLS LAST, l_shipdate ASC NULLS LAST, {_REST_SQL}) = 1""",
)
def keep_newest_by_creation(t: Tables):
    return dedupe.keep_newest(_dates(t), LINE, tiebreak=["l_shipdate", *LINE_REST], fall_back_to_created=True)


@query(
    "keep_first",
    f"""SELECT * FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber
      ORDER BY l_shipdate ASC NULLS LAST, {_REST_SQL}) = 1""",
)
def keep_first(t: Tables):
    return dedupe.keep_first(t.lineitem, LINE, [F.col(c).asc_nulls_last() for c in ("l_shipdate", *LINE_REST)])


@query(
    "keep_first_blank_key",
    """WITH x AS (SELECT o_orderkey, o_custkey, CASE WHEN o_orderstatus <> 'P' THEN 'APP-' || o_custkey END AS number FROM orders)
    SELECT * FROM x QUALIFY number IS NULL OR row_number() OVER (PARTITION BY number ORDER BY o_orderkey) = 1""",
)
def keep_first_blank_key(t: Tables):
    number = F.when(F.col("o_orderstatus") != "P", F.concat(F.lit("APP-"), "o_custkey"))
    rows = t.orders.select("o_orderkey", "o_custkey", number.alias("number"))
    return dedupe.keep_first_upload(rows, "number", "o_orderkey")


@query(
    "keep_last",
    "SELECT * FROM events QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id DESC) = 1",
)
def keep_last(t: Tables):
    return dedupe.keep_last_upload(t.events, ["user_id", "event_type"], "event_id")


@query("distinct_values", "SELECT DISTINCT l_returnflag, l_linestatus, l_suppkey FROM lineitem")
def distinct_values(t: Tables):
    return t.lineitem.select("l_returnflag", "l_linestatus", "l_suppkey").distinct()


@query(
    "dup_surplus",
    """SELECT CAST(coalesce(sum(n - 1), 0) AS BIGINT) AS surplus FROM
      (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1)""",
)
def dup_surplus(t: Tables):
    return dedupe.duplicate_surplus(t.lineitem, LINE)


@query(
    "dup_listing",
    """WITH x AS (SELECT * REPLACE (CASE WHEN l_returnflag <> 'N' THEN l_linenumber END AS l_linenumber) FROM lineitem)
    SELECT *, count(*) OVER (PARTITION BY l_orderkey, l_linenumber) AS copies FROM x QUALIFY copies > 1""",
)
def dup_listing(t: Tables):
    """Half of the lines have no number; they repeat under their order like any other value."""
    number = F.when(F.col("l_returnflag") != "N", F.col("l_linenumber"))
    return dedupe.duplicate_listing(t.lineitem.withColumn("l_linenumber", number), LINE)


@query(
    "ordered_listing",
    "SELECT c_custkey, c_acctbal, c_mktsegment FROM customer ORDER BY c_acctbal DESC NULLS LAST, c_custkey ASC NULLS LAST",
)
def ordered_listing(t: Tables):
    order = [F.col("c_acctbal").desc_nulls_last(), F.col("c_custkey").asc_nulls_last()]
    return t.customer.select("c_custkey", "c_acctbal", "c_mktsegment").orderBy(*order)


# --- lookups ------------------------------------------------------------------------------------


def _raw_nation(t: Tables):
    """Customers with the nation id as a spreadsheet renders it; unknown ids in one segment."""
    raw = F.when(F.col("c_mktsegment") == "BUILDING", F.concat(F.lit("unknown "), "c_nationkey")).otherwise(
        F.concat("c_nationkey", F.lit(".0"))
    )
    return t.customer.select("c_custkey", raw.alias("region"))


def _nation_dim(t: Tables):
    return dimensions.dimension(t.nation.select(F.col("n_nationkey").cast("string").alias("id"), F.col("n_name").alias("name")))


@query(
    "lookup_keep_raw",
    """SELECT c_custkey, coalesce(n_name, 'unknown ' || c_nationkey) AS region FROM customer
      LEFT JOIN nation ON n_nationkey = c_nationkey AND c_mktsegment <> 'BUILDING'""",
)
def lookup_keep_raw(t: Tables):
    return joins.replace_ids(_raw_nation(t), ["region"], {"region": _nation_dim(t)}, dimensions.id_key)


@query(
    "lookup_null",
    """SELECT c_custkey, CASE WHEN c_mktsegment = 'BUILDING' THEN 'unknown ' || c_nationkey ELSE c_nationkey || '.0' END AS region,
      n_name AS name FROM customer LEFT JOIN nation ON n_nationkey = c_nationkey AND c_mktsegment <> 'BUILDING'""",
)
def lookup_null(t: Tables):
    return joins.lookup(_raw_nation(t), _nation_dim(t), "region", "id", {"name": "name"}, dimensions.id_key)


@query(
    "lookup_hot_keys",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, s_name, s_nationkey FROM
      (SELECT *, CASE WHEN l_returnflag = 'R' THEN 1 WHEN l_returnflag = 'A' THEN l_suppkey END AS supplier FROM lineitem)
      LEFT JOIN supplier ON s_suppkey = supplier""",
)
def lookup_hot_keys(t: Tables):
    """A third of the rows on one key, a third without key."""
    supplier = F.when(F.col("l_returnflag") == "R", F.lit(1).cast("bigint")).when(F.col("l_returnflag") == "A", F.col("l_suppkey"))
    rows = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", supplier.alias("supplier"))
    take = {"s_name": "s_name", "s_nationkey": "s_nationkey"}
    return joins.lookup_hot(rows, t.supplier, "supplier", "s_suppkey", take).drop("supplier")


@query(
    "or_key_lookup",
    """WITH x AS (SELECT c_custkey, CASE WHEN c_mktsegment = 'BUILDING' THEN 'CODE ' || c_nationkey ELSE 'NATION_' || c_nationkey END AS class FROM customer)
    SELECT c_custkey, class, n_nationkey AS class_id FROM x LEFT JOIN nation ON class = 'CODE ' || n_nationkey OR class = n_name""",
)
def or_key_lookup(t: Tables):
    given = F.when(F.col("c_mktsegment") == "BUILDING", F.concat(F.lit("CODE "), "c_nationkey")).otherwise(
        F.concat(F.lit("NATION_"), "c_nationkey")
    )
    dim = joins.either_key(t.nation, [F.concat(F.lit("CODE "), "n_nationkey"), "n_name"], {"class_id": "n_nationkey"})
    rows = t.customer.select("c_custkey", given.alias("class"))
    return joins.lookup(rows, dim, "class", "alias", {"class_id": "class_id"}, normalise=None)


@query(
    "top1_child",
    """SELECT c_custkey, c_name, o_orderkey AS first_order, o_totalprice AS first_price FROM customer LEFT JOIN
      (SELECT * FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) = 1) ON o_custkey = c_custkey""",
)
def top1_child(t: Tables):
    order = [F.col("o_orderdate").asc_nulls_last(), F.col("o_orderkey").asc_nulls_last()]
    take = {"first_order": "o_orderkey", "first_price": "o_totalprice"}
    return joins.first_child(t.customer.select("c_custkey", "c_name"), t.orders, "c_custkey", "o_custkey", take, order)


@query("semi", "SELECT doc_id, lang, source, n_chars FROM documents WHERE doc_id IN (SELECT doc_id FROM labels)")
def semi(t: Tables):
    return joins.having(t.documents.select("doc_id", "lang", "source", "n_chars"), t.labels, [("doc_id", "doc_id")])


@query("anti", "SELECT doc_id, lang, source, n_chars FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)")
def anti(t: Tables):
    return joins.lacking(t.documents.select("doc_id", "lang", "source", "n_chars"), t.labels, [("doc_id", "doc_id")])


@query(
    "null_safe_join",
    """WITH a AS (SELECT DISTINCT p_brand, CASE WHEN p_size > 10 THEN p_size END AS size FROM part WHERE p_type = 'ECONOMY'),
      b AS (SELECT DISTINCT p_brand, CASE WHEN p_size > 10 THEN p_size END AS size FROM part WHERE p_type <> 'ECONOMY')
    SELECT a.* FROM a WHERE EXISTS (SELECT 1 FROM b WHERE a.p_brand = b.p_brand AND a.size IS NOT DISTINCT FROM b.size)""",
)
def null_safe_join(t: Tables):
    sized = t.part.withColumn("size", F.when(F.col("p_size") > 10, F.col("p_size")))
    one = sized.filter(F.col("p_type") == "ECONOMY").select("p_brand", "size").distinct()
    other = sized.filter(F.col("p_type") != "ECONOMY")
    return joins.having(one, other, [("p_brand", "p_brand"), ("size", "size")], null_safe=True)


_ORPHAN = "CASE WHEN l_returnflag = 'R' THEN l_orderkey + 1000000000 WHEN l_linestatus = 'F' THEN NULL ELSE l_orderkey END"


@query(
    "orphans",
    f"""SELECT l_partkey, l_suppkey, order_id FROM (SELECT *, {_ORPHAN} AS order_id FROM lineitem)
      WHERE order_id IS NULL OR order_id NOT IN (SELECT o_orderkey FROM orders)""",
)
def orphans(t: Tables):
    rows = t.lineitem.select("l_partkey", "l_suppkey", F.expr(_ORPHAN).alias("order_id"))
    return joins.orphans(rows, t.orders, "order_id", "o_orderkey", null_is_orphan=True)


@query(
    "parent_chain",
    """SELECT l_orderkey, l_linenumber, l_partkey, o_custkey, c_name FROM lineitem JOIN orders ON l_orderkey = o_orderkey
      LEFT JOIN customer ON c_custkey = o_custkey AND o_orderstatus = 'F'""",
)
def parent_chain(t: Tables):
    """Parent required, grandparent best effort."""
    paid = F.when(F.col("o_orderstatus") == "F", F.col("o_custkey"))
    orders = t.orders.select("o_orderkey", "o_custkey", paid.alias("paid"))
    lines = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey")
    located = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).drop("o_orderkey")
    return joins.lookup(located, t.customer, "paid", "c_custkey", {"c_name": "c_name"}, None, unique=True).drop("paid")


@query(
    "dim_chain",
    """SELECT c_custkey, r_regionkey AS zone_id, r_name AS zone_name FROM customer
      LEFT JOIN nation ON n_nationkey = c_nationkey LEFT JOIN region ON r_regionkey = n_regionkey""",
)
def dim_chain(t: Tables):
    regions = t.nation.select(F.col("n_name").alias("name"), F.col("n_regionkey").alias("zone_id"))
    zones = t.region.select(F.col("r_regionkey").alias("id"), F.col("r_name").alias("name"))
    named = t.customer.select("c_custkey", F.concat(F.lit(" nation_"), "c_nationkey").alias("region"))
    found = dimensions.zone_map(regions, zones)
    return joins.lookup(named, found, "region", "region", {"zone_id": "zone_id", "zone_name": "zone_name"}).drop("region")


@query(
    "cross_one",
    """SELECT c_custkey, newest FROM customer CROSS JOIN (SELECT max(o_orderdate) AS newest FROM orders)""",
)
def cross_one(t: Tables):
    return joins.cross_one(t.customer.select("c_custkey"), t.orders.agg(F.max("o_orderdate").alias("newest")))


_VARIANT = "CASE WHEN p_size > 25 THEN upper(p_name) ELSE p_name END"


@query(
    "variant_fan_out",
    f"""WITH names AS (SELECT min(p_partkey) AS id, {_VARIANT} AS name FROM part GROUP BY 2),
      fees AS (SELECT p_brand, p_name, count(*) AS n FROM part GROUP BY 1, 2)
    SELECT p_brand, p_name, n, id FROM fees JOIN names ON lower(trim(name)) = lower(trim(p_name))""",
)
def variant_fan_out(t: Tables):
    names = t.part.groupBy(F.expr(_VARIANT).alias("name")).agg(F.min("p_partkey").alias("id"))
    fees = t.part.groupBy("p_brand", "p_name").agg(F.count(F.lit(1)).alias("n"))
    return joins.fan_out(fees, names, "p_name", "name", {"id": "id"})


# --- counts ---------------------------------------------------------------------------------------


@query(
    "distinct_count",
    "SELECT count(DISTINCT lower(trim(c_mktsegment || c_nationkey))) AS n FROM customer",
)
def distinct_count(t: Tables):
    return profile.distinct_count(t.customer, key_text(F.concat("c_mktsegment", "c_nationkey")))


@query(
    "count_by_parent",
    """SELECT p_partkey, p_name, count(l_partkey) AS lines FROM part
      LEFT JOIN (SELECT l_partkey * 2 AS l_partkey FROM lineitem) ON l_partkey = p_partkey GROUP BY 1, 2""",
)
def count_by_parent(t: Tables):
    """All lines, under twice their part number: odd parts have none."""
    lines = t.lineitem.select((F.col("l_partkey") * 2).alias("l_partkey"))
    return profile.count_by_parent(t.part.select("p_partkey", "p_name"), lines, "p_partkey", "l_partkey", "lines")


@query(
    "cond_counts",
    """SELECT count(*) AS total, count(*) FILTER (o_orderstatus = 'F') AS done, count(*) FILTER (o_totalprice > 200000) AS large,
      count(*) FILTER (o_orderpriority = '1-URGENT' AND o_orderstatus <> 'F') AS pending FROM orders""",
)
def cond_counts(t: Tables):
    status, price = F.col("o_orderstatus"), F.col("o_totalprice")
    return profile.conditional_counts(
        t.orders,
        {
            "total": F.lit(True),
            "done": status == "F",
            "large": price > 200000,
            "pending": (F.col("o_orderpriority") == "1-URGENT") & (status != "F"),
        },
    )


@query(
    "breakdown",
    """SELECT CASE o_orderstatus WHEN 'P' THEN 'RENEW' WHEN 'F' THEN 'NEW' END AS kind, count(*) AS n FROM orders GROUP BY 1 ORDER BY 1 NULLS LAST""",
)
def breakdown(t: Tables):
    kind = F.when(F.col("o_orderstatus") == "P", F.lit("RENEW")).when(F.col("o_orderstatus") == "F", F.lit("NEW"))
    return profile.breakdown(t.orders, {"kind": kind})


@query("max_or_default", "SELECT coalesce(max(nullif(trim(p_type), '')), 'PETROLEUM') AS sector_name FROM part")
def max_or_default(t: Tables):
    return profile.max_or(t.part, "p_type", "PETROLEUM", "sector_name")


_FILL_COLUMNS = ("doc_id", "lang", "source", "quality", "toxic")


@query(
    "fill_rate",
    "WITH x AS (SELECT d.doc_id, lang, source, quality, toxic FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id) "
    + " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) - count({c}) AS nulls, count({c}) AS non_nulls FROM x" for c in _FILL_COLUMNS
    )
    + " ORDER BY nulls DESC, non_nulls DESC, column_name DESC",
)
def fill_rate(t: Tables):
    rows = t.documents.select("doc_id", "lang", "source").join(t.labels, "doc_id", "left")
    return profile.fill_rate(rows, _FILL_COLUMNS)


def _annotated(t: Tables):
    """Orders as a feed with a reason to skip some."""
    rows = t.orders.select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority")
    return profile.with_reason(
        rows, {"missing_application": F.col("o_orderstatus") == "P", "missing_name": F.col("o_orderpriority") == "5-LOW"}
    )


_REASON_SQL = "CASE WHEN o_orderstatus = 'P' THEN 'missing_application' WHEN o_orderpriority = '5-LOW' THEN 'missing_name' END"


@query(
    "skip_report",
    f"""SELECT count(*) AS processed, count(*) FILTER (r IS NULL) AS accepted, count(r) AS skipped_total,
      count(*) FILTER (r = 'missing_application') AS skipped_missing_application, count(*) FILTER (r = 'missing_name') AS skipped_missing_name
    FROM (SELECT {_REASON_SQL} AS r FROM orders)""",
)
def skip_report(t: Tables):
    return profile.skip_report(_annotated(t), ["missing_application", "missing_name"])


@query(
    "reason_samples",
    f"""SELECT o_orderkey, o_custkey, o_orderstatus, o_orderpriority, {_REASON_SQL} AS _reason,
      row_number() OVER (PARTITION BY _reason ORDER BY o_orderkey) AS sample_no FROM orders WHERE {_REASON_SQL} IS NOT NULL QUALIFY sample_no <= 10""",
)
def reason_samples(t: Tables):
    """Ten rows per skip reason: the limit is the report."""
    return profile.reason_samples(_annotated(t), [F.col("o_orderkey").asc_nulls_last()], 10)


@query(
    "mapping_stats",
    """SELECT count(*) FILTER (n_name IS NOT NULL) AS region_mapped, count(*) FILTER (n_name IS NULL) AS region_unmapped FROM customer
      LEFT JOIN nation ON n_nationkey = c_nationkey AND c_mktsegment <> 'BUILDING'""",
)
def mapping_stats(t: Tables):
    found = joins.lookup(_raw_nation(t), _nation_dim(t), "region", "id", {"name": "name"}, dimensions.id_key)
    return profile.mapping_stats(found, {"region": ("region", "name")})


@query(
    "unmapped_values",
    "SELECT DISTINCT 'unknown ' || c_nationkey AS value FROM customer WHERE c_mktsegment = 'BUILDING' ORDER BY 1",
)
def unmapped_values(t: Tables):
    """All values that no region has."""
    found = joins.lookup(_raw_nation(t), _nation_dim(t), "region", "id", {"name": "name"}, dimensions.id_key)
    return profile.unmapped_values(found, "region", "name")


@query(
    "funnel",
    """SELECT count(*) AS staged, count(*) FILTER (l.doc_id IS NOT NULL) AS labelled, count(*) FILTER (quality = 1) AS good,
      count(*) FILTER (quality = 1 AND toxic = 0) AS usable FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id""",
)
def funnel(t: Tables):
    rows = t.documents.select("doc_id").join(t.labels, "doc_id", "left")
    stages = {
        "staged": F.lit(True),
        "labelled": F.col("quality").isNotNull(),
        "good": F.col("quality") == 1,
        "usable": F.col("toxic") == 0,
    }
    return profile.funnel(rows, stages)


@query(
    "suspicious_rows",
    """SELECT c_custkey, c_name, CASE WHEN c_nationkey > 20 THEN '15537792242' || c_nationkey ELSE 'NATION' END AS region FROM customer
      WHERE c_nationkey > 20""",
)
def suspicious_rows(t: Tables):
    region = F.when(F.col("c_nationkey") > 20, F.concat(F.lit("15537792242"), "c_nationkey")).otherwise(F.lit("NATION"))
    rows = t.customer.select("c_custkey", "c_name", region.alias("region"))
    return profile.suspicious_rows(rows, ["region", "c_name"], "^[0-9]{10,}$")


@query(
    "rejects",
    """SELECT o_orderkey, 'not_open' AS code, 'o_orderstatus' AS column_name, o_orderstatus AS value FROM orders WHERE o_orderstatus <> 'O'
      UNION ALL SELECT o_orderkey, 'too_long', 'o_orderpriority', o_orderpriority FROM orders WHERE length(o_orderpriority) > 8
      UNION ALL SELECT o_orderkey, 'unknown_customer', 'o_custkey', CAST(o_custkey AS VARCHAR) FROM orders WHERE o_custkey NOT IN
        (SELECT c_custkey FROM customer WHERE c_mktsegment <> 'BUILDING')""",
)
def rejects(t: Tables):
    # All customers, some with a blank key.
    known = t.customer.select(F.when(F.col("c_mktsegment") != "BUILDING", F.col("c_custkey")).alias("c_custkey"))
    rows = t.orders.join(known, F.col("o_custkey") == F.col("c_custkey"), "left")
    rules = {
        "not_open": ("o_orderstatus", F.col("o_orderstatus") != "O"),
        "too_long": ("o_orderpriority", F.length("o_orderpriority") > 8),
        "unknown_customer": ("o_custkey", F.col("c_custkey").isNull()),
    }
    return profile.rejects(rows, rules, "o_orderkey")


# --- reshaping and reconciliation -------------------------------------------------------------------


def _attachments(t: Tables):
    """Parts as rows with three attachment pairs, some without name or id."""
    return t.part.select(
        "p_partkey",
        F.concat("p_partkey", F.lit(".0")).alias("tinc"),
        F.when(F.col("p_size") > 5, F.col("p_name")).otherwise(F.lit("nan")).alias("tincfilename"),
        F.when(F.col("p_type") != "SMALL", F.col("p_size").cast("string")).alias("coc"),
        F.col("p_brand").alias("cocfilename"),
        F.when(F.col("p_size") < 40, F.lit("7")).otherwise(F.lit("x")).alias("upop_id"),
        F.concat(F.lit(" "), "p_type").alias("upopfilename"),
    )


_ATTACHMENTS_SQL = """WITH x AS (
    SELECT p_partkey, 1 AS pos, 'TINC' AS document_name, CASE WHEN p_size > 5 THEN p_name END AS file_name, p_partkey AS logic_doc_id FROM part
    UNION ALL SELECT p_partkey, 2, 'COC', p_brand, CASE WHEN p_type <> 'SMALL' THEN p_size END FROM part
    UNION ALL SELECT p_partkey, 3, 'UPOP', p_type, CASE WHEN p_size < 40 THEN 7 END FROM part)"""


@query(
    "unpivot_attachments",
    f"""{_ATTACHMENTS_SQL} SELECT p_partkey, document_name, file_name, CAST(logic_doc_id AS BIGINT) AS logic_doc_id,
      row_number() OVER (PARTITION BY p_partkey ORDER BY pos) AS documents_order FROM x WHERE file_name IS NOT NULL AND logic_doc_id IS NOT NULL""",
)
def unpivot_attachments(t: Tables):
    wide = _attachments(t)
    return reshape.unpivot_pairs(wide, reshape.detect_pairs(wide.columns), ["p_partkey"]).drop("id_text")


@query(
    "unpivot_fixed_order",
    f"""{_ATTACHMENTS_SQL} SELECT p_partkey, document_name, file_name, CAST(logic_doc_id AS BIGINT) AS logic_doc_id, pos AS documents_order
      FROM x WHERE file_name IS NOT NULL""",
)
def unpivot_fixed_order(t: Tables):
    wide = _attachments(t)
    pairs = [Pair("tinc", "tincfilename", "TINC"), Pair("coc", "cocfilename", "COC"), Pair("upop_id", "upopfilename", "UPOP")]
    return reshape.unpivot_pairs(wide, pairs, ["p_partkey"], need_id=False, fixed_order=True).drop("id_text")


@query(
    "legacy_documents",
    """WITH x AS (
      SELECT p_partkey, 1 AS pos, 'tinc' AS file_name, CASE WHEN p_size > 5 THEN p_name END AS document_name, p_partkey AS logic_doc_id FROM part
      UNION ALL SELECT p_partkey, 2, 'coc', p_brand, CASE WHEN p_type <> 'SMALL' THEN p_size END FROM part
      UNION ALL SELECT p_partkey, 3, 'upop', p_type, CASE WHEN p_size < 40 THEN 7 END FROM part)
    SELECT regexp_replace(md5('legacy|' || p_partkey), '^(.{8})(.{4})(.{4})(.{4})(.{12})$', '\\1-\\2-\\3-\\4-\\5') AS application_id,
      coalesce(document_name, '') AS document_name, file_name, CAST(logic_doc_id AS BIGINT) AS logic_doc_id,
      row_number() OVER (PARTITION BY p_partkey ORDER BY pos) AS documents_order
    FROM x WHERE document_name IS NOT NULL OR logic_doc_id IS NOT NULL""",
)
def legacy_documents(t: Tables):
    _, documents = legacy.migrate_wide(_attachments(t), ["p_partkey"], "p_partkey")
    return documents.drop("id")


@query(
    "legacy_preview",
    "SELECT count(*) AS applications, CAST(count(*) * 3 AS BIGINT) AS documents FROM part",
)
def legacy_preview(t: Tables):
    return legacy.preview_wide(_attachments(t), ["p_partkey"], "p_partkey")


_CHANGED_KEY = "CASE WHEN o_orderpriority = '5-LOW' THEN o_custkey + 1000000 ELSE o_custkey END"


@query(
    "reconcile",
    f"""WITH s AS (SELECT DISTINCT o_custkey AS customer, lower(o_orderpriority) AS priority, CASE WHEN o_orderstatus <> 'P' THEN o_orderstatus END AS status FROM orders),
      t AS (SELECT DISTINCT {_CHANGED_KEY} AS customer, lower(o_orderpriority) AS priority, CASE WHEN o_orderstatus <> 'P' THEN o_orderstatus END AS status FROM orders)
    SELECT *, 'missing' AS side FROM (SELECT * FROM s EXCEPT SELECT * FROM t) UNION ALL SELECT *, 'extra' AS side FROM (SELECT * FROM t EXCEPT SELECT * FROM s)""",
)
def reconcile_both(t: Tables):
    status = F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus"))
    keys = {"customer": F.col("o_custkey"), "priority": F.lower("o_orderpriority"), "status": status}
    return reconcile.reconcile(t.orders, t.orders, keys, keys | {"customer": F.expr(_CHANGED_KEY)})


@query(
    "reconcile_tolerance",
    """WITH s AS (SELECT o_orderkey, o_custkey, o_totalprice, CASE WHEN o_orderstatus = 'P' THEN o_totalprice + 0.004
        WHEN o_orderstatus = 'F' THEN o_totalprice + 0.5 ELSE o_totalprice END AS price FROM orders)
    SELECT o_orderkey, o_custkey, price FROM s WHERE NOT EXISTS
      (SELECT 1 FROM orders o WHERE o.o_custkey = s.o_custkey AND abs(o.o_totalprice - s.price) < 0.01)""",
)
def reconcile_tolerance(t: Tables):
    price = F.expr("CASE o_orderstatus WHEN 'P' THEN o_totalprice + 0.004D WHEN 'F' THEN o_totalprice + 0.5D ELSE o_totalprice END")
    source = t.orders.select("o_orderkey", "o_custkey", price.alias("price"))
    target = t.orders.select(F.col("o_custkey").alias("customer"), "o_totalprice")
    keys = {"customer": (F.col("o_custkey"), F.col("customer"))}
    return reconcile.missing_within(source, target, keys, (F.col("price"), F.col("o_totalprice")), 0.01)


# --- sources ------------------------------------------------------------------------------------------


@query("source_row_number", "SELECT row_number() OVER () AS row_no, l_orderkey, l_linenumber, l_partkey FROM lineitem")
def source_row_number(t: Tables):
    return grid.number_rows(t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey"), name="row_no")


def raw_grid(t: Tables):
    """Customers as a spreadsheet: title, blank row, header in row 3, data below."""
    head = t.spark.createDataFrame(
        [(0, "Customer export", None, None), (1, None, None, None), (2, " AppRefNo", "Full Name", "Region/Zone")],
        "_row bigint, c0 string, c1 string, c2 string",
    )
    data = t.customer.select(
        (F.col("c_custkey") + 10).alias("_row"),
        F.concat(F.lit("APP-"), "c_custkey").alias("c0"),
        F.col("c_name").alias("c1"),
        F.col("c_nationkey").cast("string").alias("c2"),
    )
    return head.unionByName(data)


@query(
    "header_discovery",
    "SELECT c_custkey + 10 AS _row, 'APP-' || c_custkey AS apprefno, c_name AS full_name, CAST(c_nationkey AS VARCHAR) AS region_zone FROM customer",
)
def header_discovery(t: Tables):
    return grid.promote_header(raw_grid(t))


@query(
    "alias_projection",
    "SELECT c_custkey AS _row, 'APP-' || c_custkey AS application_number, CAST(NULL AS VARCHAR) AS approval_no, c_name AS company_name FROM customer",
)
def alias_projection(t: Tables):
    """First alias present wins; a canonical column without a source is NULL."""
    wide = t.customer.select(
        F.col("c_custkey").alias("_row"),
        F.concat(F.lit("APP-"), "c_custkey").alias(" AppNo"),
        F.lit("later alias").alias("apprefno"),
        F.col("c_name").alias("Company Name"),
    )
    aliases = {
        "application_number": "application_number",
        "appno": "application_number",
        "apprefno": "application_number",
        "approval_no": "approval_no",
        "company_name": "company_name",
    }
    return grid.apply_aliases(wide, aliases)


@query(
    "dimension_load",
    "SELECT CAST(n_nationkey * 1000 AS VARCHAR) AS id, n_name AS name FROM nation",
)
def dimension_load(t: Tables):
    """Ids in three renderings, each name three times."""
    ids = F.explode(F.array(F.concat(F.col("n_nationkey") * 1000, F.lit(".0")), F.concat("n_nationkey", F.lit("e+3")), F.lit(" ")))
    return dimensions.dimension(t.nation.select(ids.alias("id"), F.concat(F.lit(" "), "n_name").alias("name")))


@query(
    "category_feed",
    "SELECT DISTINCT p_type AS name FROM part",
)
def category_feed(t: Tables):
    return t.part.select(F.trim(F.concat(F.lit(" "), "p_type")).alias("name")).filter(F.col("name") != "").distinct()
