"""Stored tables, uploads that come as files, and lookups by way of an index or a digest."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlift.operators import latest, postings, reconcile
from ledgerlift.operators.merge import KEEP, OVERWRITE
from ledgerlift.session import fixed_rows, scratch_folder
from ledgerlift.sources import grid
from ledgerlift.sources.store import TableStore
from ledgerlift.streaming.feed import incremental_import, latest_import
from workload.registry import Tables, query
from workload.relations import _CHANGED_KEY


def _store(t: Tables) -> TableStore:
    return TableStore(t.spark, scratch_folder(t.spark, "store"))


# --- versions ------------------------------------------------------------------------------------------

#: Four versions of the customers: all of them, then an upload of orders' customers, of suppliers, of new ones.
_UPLOADS_SQL = """v1 AS (SELECT c_custkey AS id, c_name AS name, c_mktsegment AS segment, c_acctbal AS balance FROM customer WHERE c_nationkey <> 3),
  u2 AS (SELECT o_custkey AS id, 'buyer ' || o_custkey AS name, CASE WHEN min(o_orderstatus) <> 'P' THEN min(o_orderstatus) END AS segment, max(o_totalprice) AS balance FROM orders GROUP BY 1),
  v2 AS (SELECT coalesce(u2.id, v1.id) AS id, coalesce(u2.name, v1.name) AS name, coalesce(u2.segment, v1.segment) AS segment, coalesce(u2.balance, v1.balance) AS balance FROM v1 FULL JOIN u2 ON u2.id = v1.id),
  u3 AS (SELECT s_suppkey * 3 AS id, s_name AS name FROM supplier),
  v3 AS (SELECT coalesce(u3.id, v2.id) AS id, coalesce(u3.name, v2.name) AS name, segment, balance FROM v2 FULL JOIN u3 ON u3.id = v2.id),
  v4 AS (SELECT * FROM v3 UNION ALL SELECT 10000000 + n_nationkey, n_name, NULL, NULL FROM nation)"""


def _uploads(t: Tables) -> TableStore:
    store = _store(t)
    first = t.customer.where("c_nationkey <> 3").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment"), F.col("c_acctbal").alias("balance"))
    least = F.min("o_orderstatus")
    buyers = t.orders.groupBy(F.col("o_custkey").alias("id")).agg(F.when(least != "P", least).alias("segment"), F.max("o_totalprice").alias("balance"))
    store.merge("members", first, ["id"], unique_source=True)
    store.merge("members", buyers.withColumn("name", F.concat(F.lit("buyer "), "id")), ["id"], unique_source=True)
    store.merge("members", t.supplier.select((F.col("s_suppkey") * 3).alias("id"), F.col("s_name").alias("name")), ["id"], unique_source=True)
    store.merge("members", t.nation.select((F.col("n_nationkey") + 10_000_000).alias("id"), F.col("n_name").alias("name")), ["id"], unique_source=True)
    return store


_MEMBER = ["id", "name", "segment", "balance"]


@query("stored_merges", f"WITH {_UPLOADS_SQL} SELECT *, CASE WHEN id > 10000000 - 1 THEN 'insert' ELSE 'keep' END AS _action FROM v4")
def stored_merges(t: Tables) -> DataFrame:
    """Four uploads into a bucketed table; the last one rewrites the buckets of its own rows."""
    return _uploads(t).read("members").select(*_MEMBER, "_action")


@query(
    "stored_as_of",
    f"""WITH {_UPLOADS_SQL} SELECT 1 AS version, * FROM v1 UNION ALL SELECT 2, * FROM v2 UNION ALL SELECT 3, * FROM v3 UNION ALL SELECT 4, * FROM v4""",
)
def stored_as_of(t: Tables) -> DataFrame:
    store = _uploads(t)
    versions = [store.read("members", v).select(F.lit(v).alias("version"), *_MEMBER) for v in store.versions("members")]
    return versions[0].unionAll(versions[1]).unionAll(versions[2]).unionAll(versions[3])


@query(
    "stored_changes",
    f"""WITH {_UPLOADS_SQL} SELECT CASE WHEN v1.id IS NULL THEN 'insert' ELSE 'update' END AS change, v2.id, v1.name AS old_name, v2.name AS new_name, v1.segment AS old_segment, v2.segment AS new_segment
    FROM v2 LEFT JOIN v1 ON v1.id = v2.id WHERE v1.id IS NULL OR v1.name IS DISTINCT FROM v2.name OR v1.segment IS DISTINCT FROM v2.segment OR v1.balance IS DISTINCT FROM v2.balance""",
)
def stored_changes(t: Tables) -> DataFrame:
    """The row images of the second upload."""
    images = _uploads(t).changes("members", 2)
    pairs = [F.col(f"{side}.{c}").alias(f"{as_}_{c}") for c in ("name", "segment") for side, as_ in (("before", "old"), ("after", "new"))]
    return images.select(F.col("_change").alias("change"), "id", *pairs)


@query(
    "stored_undo",
    f"""WITH {_UPLOADS_SQL}, kept AS (SELECT v4.*, u2.id AS u, v1.id AS b, v1.name AS bn, v1.segment AS bs, v1.balance AS bb, v2.name AS n2, v2.segment AS s2, v2.balance AS b2
      FROM v4 LEFT JOIN u2 ON u2.id = v4.id LEFT JOIN v1 ON v1.id = v4.id LEFT JOIN v2 ON v2.id = v4.id)
    SELECT id, CASE WHEN u IS NOT NULL AND b IS NOT NULL AND name = n2 THEN bn ELSE name END AS name,
      CASE WHEN u IS NOT NULL AND b IS NOT NULL AND segment IS NOT DISTINCT FROM s2 THEN bs ELSE segment END AS segment,
      CASE WHEN u IS NOT NULL AND b IS NOT NULL AND balance IS NOT DISTINCT FROM b2 THEN bb ELSE balance END AS balance
    FROM kept WHERE NOT (u IS NOT NULL AND b IS NULL AND name = n2)""",
)
def stored_undo(t: Tables) -> DataFrame:
    """The second of four uploads is taken back; what the later ones wrote stays."""
    return _uploads(t).undo("members", 2).select(*_MEMBER)


@query(
    "stored_alignment",
    f"""WITH {_UPLOADS_SQL} SELECT id, CAST(balance AS VARCHAR) IS NULL AS no_balance, name, 'active' AS state FROM v4""",
)
def stored_alignment(t: Tables) -> DataFrame:
    """A column widened, one added with a default and one dropped, all in the log."""
    store = _uploads(t)
    store.align("members", T.StructType.fromDDL("id bigint, balance string, state string"), {"state": "active"}, drop=["segment"])
    return store.read("members").select("id", F.col("balance").isNull().alias("no_balance"), "name", "state")


@query(
    "stored_policies",
    """WITH a AS (SELECT o_custkey AS k, max(o_orderkey) AS v, min(o_orderstatus) AS s FROM orders WHERE o_orderkey % 2 = 0 GROUP BY 1),
      b AS (SELECT o_custkey AS k, max(o_orderkey) AS v, min(o_orderstatus) AS s FROM orders WHERE o_orderkey % 2 = 1 GROUP BY 1)
    SELECT coalesce(b.k, a.k) AS k, coalesce(b.v, a.v) AS v, coalesce(a.s, b.s) AS s,
      CASE WHEN a.k IS NULL THEN 'insert' WHEN b.k IS NULL THEN 'keep' ELSE 'update' END AS _action FROM a FULL JOIN b ON b.k = a.k""",
)
def stored_policies(t: Tables) -> DataFrame:
    store = _store(t)
    half = lambda i: t.orders.where(F.col("o_orderkey") % 2 == i).groupBy(F.col("o_custkey").alias("k")).agg(F.max("o_orderkey").alias("v"), F.min("o_orderstatus").alias("s"))
    store.merge("t", half(0), ["k"], unique_source=True)
    return store.merge("t", half(1), ["k"], unique_source=True, policy={"v": OVERWRITE, "s": KEEP}).select("k", "v", "s", "_action")


# --- files ---------------------------------------------------------------------------------------------


def _as_csv(df: DataFrame, path: str, header: bool = True) -> str:
    df.write.option("header", header).option("quoteAll", True).option("escape", '"').option("emptyValue", "").csv(path)
    return path


@query("csv_records", "SELECT doc_id, text, source FROM documents")
def csv_records(t: Tables) -> DataFrame:
    """All texts through files: quotes, separators and line breaks inside cells, read in parallel."""
    rows = t.documents.select("doc_id", F.coalesce("text", F.lit("<none>")).alias("text"), F.coalesce("source", F.lit("<none>")).alias("source"))
    read = grid.read_csv(t.spark, _as_csv(rows, scratch_folder(t.spark, "csv")))
    value = lambda c: F.when(F.col(c) == "<none>", None).otherwise(F.coalesce(c, F.lit(""))).alias(c)
    return read.select(F.col("doc_id").cast("bigint").alias("doc_id"), value("text"), value("source"))


@query("csv_grid", "SELECT page_id, url, length(html) AS n FROM pages")
def csv_grid(t: Tables) -> DataFrame:
    """Raw pages as a grid whose header has to be found; its file comes first, the rows are written in parallel."""
    folder = scratch_folder(t.spark, "grid")
    head = fixed_rows(t.spark, "c0", ["AppRefNo"]).select("c0", F.lit("url").alias("c1"), F.lit("html").alias("c2"))
    files = [_as_csv(head, f"{folder}/0", header=False), _as_csv(t.pages.select("page_id", "url", "html"), f"{folder}/1", header=False)]
    table = grid.promote_header(grid.read_grid(t.spark, files))
    return table.select(F.col("apprefno").cast("bigint").alias("page_id"), "url", F.length("html").cast("bigint").alias("n"))


@query("stream_import", "SELECT c_custkey AS id, c_name AS name, c_mktsegment AS segment FROM customer")
def stream_import(t: Tables) -> DataFrame:
    """Customers arrive as files in two waves; every wave is merged."""
    landing, store = scratch_folder(t.spark, "landing"), _store(t)
    for wave in range(2):
        rows = t.customer.where(F.col("c_custkey") % 2 == wave).select(F.col("c_custkey").alias("id"), F.col("c_name").alias("Name"), F.col("c_mktsegment").alias("Segment"))
        _as_csv(rows, f"{landing}/wave={wave}")
        plan = lambda ws, batch: ws.upsert("members", "id string, name string, segment string", lambda: batch.drop(grid.ROW), ["id"], unique_source=True)
        incremental_import(t.spark, f"{landing}/wave=*", ["id", "name", "segment"], store, plan, f"{landing}-state").awaitTermination()
    return store.read("members").select(F.col("id").cast("bigint").alias("id"), "name", "segment")


@query(
    "stream_latest",
    """SELECT c_custkey AS id, CASE WHEN c_nationkey < 12 THEN 'second ' ELSE 'first ' END || c_name AS name FROM customer""",
)
def stream_latest(t: Tables) -> DataFrame:
    """The second file's names win over the first's, and a replay of both changes nothing."""
    landing, store = scratch_folder(t.spark, "landing"), _store(t)
    rows = t.customer.select(F.col("c_custkey").alias("id"), "c_name", "c_nationkey")
    _as_csv(rows.select("id", F.concat(F.lit("first "), "c_name").alias("name")).coalesce(1), f"{landing}/a")
    _as_csv(rows.where("c_nationkey < 12").select("id", F.concat(F.lit("second "), "c_name").alias("name")).coalesce(1), f"{landing}/b")
    for state in ("state", "lost"):
        latest_import(t.spark, f"{landing}/*", ["id", "name"], ["id"], store, "members", f"{landing}-{state}").awaitTermination()
    return latest.values(store.read("members"), ["id"]).select(F.col("id").cast("bigint").alias("id"), "name")


@query(
    "late_uploads",
    """SELECT o_custkey, arg_max(o_orderstatus, struct_pack(a := o_orderdate, b := o_orderkey)) FILTER (o_orderstatus <> 'P') AS status, arg_max(o_totalprice, struct_pack(a := o_orderdate, b := o_orderkey)) AS price
    FROM orders GROUP BY 1""",
)
def late_uploads(t: Tables) -> DataFrame:
    """Orders in three uploads, the middle one first and one of them twice: each customer's last values by date."""
    status = F.col("o_orderstatus")
    rows = t.orders.select("o_custkey", F.when(status != "P", status).alias("status"), F.col("o_totalprice").alias("price"), F.struct("o_orderdate", "o_orderkey").alias("place"), (F.col("o_orderkey") % 3).alias("upload"))
    table = None
    for upload in (1, 0, 2, 0):
        new = latest.registers(rows.where(F.col("upload") == upload), ["o_custkey"], ["status", "price"], "place")
        table = new if table is None else latest.combined(table, new, ["o_custkey"])
    return latest.values(table, ["o_custkey"])


# --- indexes and digests -------------------------------------------------------------------------------


@query("search_postings", "SELECT * FROM part WHERE contains(lower(p_name), 'widget') AND contains(lower(p_brand), 'brand#1')")
def search_postings(t: Tables) -> DataFrame:
    index = postings.stored(postings.postings(t.part, "p_partkey", ["p_name", "p_brand"]), scratch_folder(t.spark, "postings"))
    return postings.search_indexed(t.part, index, "p_partkey", p_name=" Widget", p_brand="BRAND#1", p_type=None)


@query("search_short", "SELECT s_suppkey, s_name FROM supplier WHERE contains(lower(s_name), '9')")
def search_short(t: Tables) -> DataFrame:
    """A pattern of one character."""
    index = postings.postings(t.supplier, "s_suppkey", ["s_name"])
    return postings.search_indexed(t.supplier, index, "s_suppkey", s_name="9").select("s_suppkey", "s_name")


@query(
    "reconcile_digest",
    f"""WITH s AS (SELECT DISTINCT o_custkey AS customer, lower(o_orderpriority) AS priority, CASE WHEN o_orderstatus <> 'P' THEN o_orderstatus END AS status FROM orders),
      t AS (SELECT DISTINCT {_CHANGED_KEY} AS customer, lower(o_orderpriority) AS priority, CASE WHEN o_orderstatus <> 'P' THEN o_orderstatus END AS status FROM orders)
    SELECT *, 'missing' AS side FROM (SELECT * FROM s EXCEPT SELECT * FROM t) UNION ALL SELECT *, 'extra' AS side FROM (SELECT * FROM t EXCEPT SELECT * FROM s)""",
)
def reconcile_digest(t: Tables) -> DataFrame:
    status = F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus"))
    keys = {"customer": F.col("o_custkey"), "priority": F.lower("o_orderpriority"), "status": status}
    return reconcile.reconcile_by_digest(t.orders, t.orders, keys, keys | {"customer": F.expr(_CHANGED_KEY)})
