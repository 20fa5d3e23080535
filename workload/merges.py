"""Merge policies over customers: the target by customer key, the feed by every second key."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerlift.functions import stable_key
from ledgerlift.operators import merge
from ledgerlift.plans import fees
from workload.registry import Tables, query

_TARGET_SQL = """t AS (SELECT c_custkey AS number, CASE WHEN c_nationkey >= 8 THEN c_mktsegment END AS segment,
    CASE WHEN c_nationkey < 5 THEN c_name || ', clerk' WHEN c_nationkey < 20 THEN c_name END AS name, c_nationkey > 12 AS flag FROM customer)"""
_SOURCE_SQL = """s AS (SELECT c_custkey * 2 AS number, CASE WHEN c_nationkey < 16 THEN lower(c_mktsegment) END AS segment,
    CASE WHEN c_nationkey > 2 THEN 'new ' || c_name END AS name, c_nationkey > 20 AS flag FROM customer)"""
_ACTION_SQL = "CASE WHEN t.number IS NULL THEN 'insert' WHEN s.number IS NULL THEN 'keep' ELSE '{matched}' END AS _action"


def target(t: Tables):
    nation = F.col("c_nationkey")
    name = F.when(nation < 5, F.concat("c_name", F.lit(", clerk"))).when(nation < 20, F.col("c_name"))
    return t.customer.select(
        F.col("c_custkey").alias("number"),
        F.when(nation >= 8, F.col("c_mktsegment")).alias("segment"),
        name.alias("name"),
        (nation > 12).alias("flag"),
    )


def source(t: Tables):
    nation = F.col("c_nationkey")
    return t.customer.select(
        (F.col("c_custkey") * 2).alias("number"),
        F.when(nation < 16, F.lower("c_mktsegment")).alias("segment"),
        F.when(nation > 2, F.concat(F.lit("new "), "c_name")).alias("name"),
        (nation > 20).alias("flag"),
    )


def merged_sql(rules: dict[str, str], matched: str = "update", join: str = "FULL JOIN") -> str:
    columns = ", ".join(
        f"CASE WHEN t.number IS NULL THEN s.{c} WHEN s.number IS NULL THEN t.{c} ELSE {rule} END AS {c}" for c, rule in rules.items()
    )
    return f"""WITH {_TARGET_SQL}, {_SOURCE_SQL} SELECT coalesce(t.number, s.number) AS number, {columns}, {_ACTION_SQL.format(matched=matched)}
      FROM t {join} s ON t.number = s.number"""


_NEW_FIRST = {c: f"coalesce(s.{c}, t.{c})" for c in ("segment", "name", "flag")}
_OLD_FIRST = {c: f"coalesce(t.{c}, s.{c})" for c in ("segment", "name", "flag")}
_NEW = {c: f"s.{c}" for c in ("segment", "name", "flag")}
_OLD = {c: f"t.{c}" for c in ("segment", "name", "flag")}


@query("merge_incoming_first", merged_sql(_NEW_FIRST))
def merge_incoming_first(t: Tables):
    return merge.merge_into(target(t), source(t), ["number"], default=merge.INCOMING)


@query("merge_existing_first", merged_sql(_OLD_FIRST))
def merge_existing_first(t: Tables):
    return merge.merge_into(target(t), source(t), ["number"], default=merge.EXISTING)


@query("merge_overwrite", merged_sql(_NEW))
def merge_overwrite(t: Tables):
    return merge.merge_into(target(t), source(t), ["number"], default=merge.OVERWRITE)


@query("insert_if_absent", merged_sql(_OLD, matched="keep"))
def insert_if_absent(t: Tables):
    return merge.insert_absent(target(t), source(t), ["number"])


@query("merge_update_only", merged_sql(_NEW_FIRST, join="LEFT JOIN"))
def merge_update_only(t: Tables):
    return merge.merge_into(target(t), source(t), ["number"], mode="update")


@query("merge_constant", merged_sql({**_NEW_FIRST, "segment": "'APPROVED'"}))
def merge_constant(t: Tables):
    return merge.merge_into(target(t), source(t), ["number"], {"segment": merge.constant("APPROVED")})


@query("sticky_or", merged_sql({**_NEW_FIRST, "flag": "t.flag OR s.flag"}))
def sticky_or(t: Tables):
    return merge.merge_into(target(t), source(t), ["number"], {"flag": merge.EITHER})


@query(
    "conditional_replace",
    merged_sql({**_NEW_FIRST, "name": "CASE WHEN t.name LIKE '%|%' OR t.name LIKE '%,%' THEN s.name ELSE coalesce(t.name, s.name) END"}),
)
def conditional_replace(t: Tables):
    return merge.merge_into(target(t), source(t), ["number"], {"name": merge.CLEAN_NAME})


@query(
    "merge_stats",
    f"""WITH {_TARGET_SQL}, {_SOURCE_SQL} SELECT count(*) AS rows, count(*) FILTER (t.number IS NULL) AS inserted,
      count(*) FILTER (t.number = s.number) AS updated, count(*) FILTER (s.number IS NULL) AS kept FROM t FULL JOIN s ON t.number = s.number""",
)
def merge_stats(t: Tables):
    return merge.merge_stats(merge.merge_into(target(t), source(t), ["number"]))


@query(
    "merge_large",
    """WITH t AS (SELECT o_orderkey AS number, CASE WHEN o_orderstatus <> 'P' THEN o_orderpriority END AS priority, o_totalprice AS price FROM orders),
      s AS (SELECT l_orderkey * 2 AS number, max(CASE WHEN l_returnflag <> 'R' THEN l_linestatus END) AS priority, max(l_extendedprice) AS price
        FROM lineitem GROUP BY 1)
    SELECT coalesce(t.number, s.number) AS number, coalesce(s.priority, t.priority) AS priority, coalesce(s.price, t.price) AS price,
      CASE WHEN t.number IS NULL THEN 'insert' WHEN s.number IS NULL THEN 'keep' ELSE 'update' END AS _action
    FROM t FULL JOIN s ON t.number = s.number""",
)
def merge_large(t: Tables):
    """A feed of many rows per key, reduced to one, into a large hub."""
    hub = t.orders.select(
        F.col("o_orderkey").alias("number"),
        F.when(F.col("o_orderstatus") != "P", F.col("o_orderpriority")).alias("priority"),
        F.col("o_totalprice").alias("price"),
    )
    status = F.when(F.col("l_returnflag") != "R", F.col("l_linestatus"))
    feed = t.lineitem.groupBy((F.col("l_orderkey") * 2).alias("number")).agg(
        F.max(status).alias("priority"), F.max("l_extendedprice").alias("price")
    )
    return merge.merge_into(hub, feed, ["number"], unique_source=True)


_SLOT_SQL = """slot AS (SELECT p_partkey, p_brand AS brand, p_type AS type, CASE WHEN p_size > 10 THEN p_size END AS size,
    p_retailprice AS price, p_name FROM part)"""


@query(
    "fee_slot_merge",
    f"""WITH {_SLOT_SQL},
      t AS (SELECT * EXCLUDE p_name FROM slot QUALIFY row_number() OVER (PARTITION BY brand, type, size ORDER BY p_partkey) = 1),
      s AS (SELECT p_partkey, CASE WHEN p_name LIKE 'red%' THEN 'Brand#99' ELSE ' ' || upper(brand) END AS brand, type, size, price + 1 AS price FROM slot
        QUALIFY row_number() OVER (PARTITION BY CASE WHEN p_name LIKE 'red%' THEN 'Brand#99' ELSE brand END, type, size ORDER BY p_partkey DESC) = 1)
    SELECT coalesce(t.p_partkey, s.p_partkey) AS p_partkey, coalesce(s.brand, t.brand) AS brand, coalesce(s.type, t.type) AS type,
      coalesce(s.size, t.size) AS size, coalesce(s.price, t.price) AS price,
      CASE WHEN t.p_partkey IS NULL THEN 'insert' WHEN s.p_partkey IS NULL THEN 'keep' ELSE 'update' END AS _action
    FROM t FULL JOIN s ON lower(trim(t.brand)) = lower(trim(s.brand)) AND t.type = s.type AND coalesce(t.size, -1) = coalesce(s.size, -1)""",
)
def fee_slot_merge(t: Tables):
    """Update-then-insert on a key with folded case and NULLs that match."""
    from ledgerlift.functions import key_text
    from ledgerlift.operators.dedupe import keep_first

    red = F.col("p_name").startswith("red")
    slot = t.part.select(
        "p_partkey",
        F.col("p_brand").alias("brand"),
        F.col("p_type").alias("type"),
        F.when(F.col("p_size") > 10, F.col("p_size")).alias("size"),
        F.col("p_retailprice").alias("price"),
        red.alias("red"),
    )
    old = keep_first(slot, ["brand", "type", "size"], [F.col("p_partkey").asc()]).drop("red")
    other = F.when(F.col("red"), F.lit("Brand#99")).otherwise(F.concat(F.lit(" "), F.upper("brand")))
    feed = slot.withColumn("brand", other).withColumn("price", F.col("price") + 1)
    new = keep_first(feed, [key_text("brand"), "type", "size"], [F.col("p_partkey").desc()]).drop("red")
    policy = {c: merge.OVERWRITE for c in ("brand", "type", "size", "price")} | {"p_partkey": merge.KEEP}
    return merge.merge_into(
        old, new, ["brand", "type", "size"], policy, match_on={"brand": key_text, "type": lambda c: c, "size": lambda c: c}, unique_source=True
    )


@query(
    "copy_config",
    """WITH c AS (SELECT DISTINCT p_brand AS category, p_type AS rule, p_size AS attachment FROM part)
    SELECT *, 'keep' AS _action FROM c UNION ALL
    SELECT 'Brand#2', rule, attachment, 'insert' FROM c WHERE category = 'Brand#1' AND NOT EXISTS
      (SELECT 1 FROM c x WHERE x.category = 'Brand#2' AND x.rule = c.rule AND x.attachment = c.attachment)""",
)
def copy_config(t: Tables):
    config = t.part.select(F.col("p_brand").alias("category"), F.col("p_type").alias("rule"), F.col("p_size").alias("attachment"))
    return merge.copy_rows(config.distinct(), "category", "Brand#1", "Brand#2", ["rule", "attachment"])


@query(
    "variant_siblings",
    """WITH c AS (SELECT min(p_partkey) AS id, CASE WHEN p_size > 25 THEN upper(p_name) ELSE p_name END AS name FROM part GROUP BY 2),
      f AS (SELECT min(id) AS id, lower(name) AS k FROM c WHERE name = lower(name) GROUP BY 2)
    SELECT CAST(c.id AS VARCHAR) AS id, name, CASE WHEN name <> lower(name) THEN CAST(f.id AS VARCHAR) END AS fees_category_id FROM c LEFT JOIN f ON k = lower(name)""",
)
def variant_siblings(t: Tables):
    """A spelling without fees points to the spelling that has them."""
    name = F.when(F.col("p_size") > 25, F.upper("p_name")).otherwise(F.col("p_name"))
    categories = t.part.groupBy(name.alias("name")).agg(F.min("p_partkey").cast("string").alias("id"))
    categories = categories.withColumn("fees_category_id", F.lit(None).cast("string")).withColumn(
        "deleted_at", F.lit(None).cast("timestamp")
    )
    charged = categories.filter(F.col("name") == F.lower("name")).select(
        stable_key("id").alias("id"), F.col("id").alias("category_id"), "deleted_at"
    )
    return fees.link_variants(categories, charged).apply().drop("deleted_at")
