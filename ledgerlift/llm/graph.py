"""Connected components of an edge table, by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlift.llm.common import written

MAX_ROUNDS = 60


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("x"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s")).collect()[0]
    return row["n"], row["x"], row["s"]


def _large_star(edges: DataFrame) -> DataFrame:
    """Each node links its larger neighbours to the smallest one it sees."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Each node links its smaller neighbours, and itself, to the smallest one."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).where("u > v").distinct()


def components(edges: DataFrame, a: str, b: str, node: str = "node", root: str = "root") -> DataFrame:
    """(node, root) for every node of an edge but the roots: root is the smallest node reachable.

    Edges may repeat, point either way or be loops.  Each round is a few grouped joins whose result is
    written to the shared folder; no component is ever gathered, a hub's edges may be split by Spark.
    An edge table without rows gives no row.
    """
    u, v = F.greatest(a, b).alias("u"), F.least(a, b).alias("v")
    now = written(edges.select(u, v).where("u > v").distinct(), "edges")
    state = _state(now)
    for _ in range(MAX_ROUNDS):
        if not state[0]:
            break
        now = written(_small_star(_large_star(now)), "edges")
        state, before = _state(now), state
        if state == before:
            break
    else:
        raise RuntimeError("components did not converge")
    return now.select(F.col("u").alias(node), F.col("v").alias(root))
