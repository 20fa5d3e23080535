"""Two-way comparison of a source with a target."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _keys(df: DataFrame, keys: Mapping[str, Column]) -> DataFrame:
    return df.select(*[c.alias(n) for n, c in keys.items()]).distinct()


def reconcile(source: DataFrame, target: DataFrame, source_keys: Mapping[str, Column], target_keys: Mapping[str, Column]) -> DataFrame:
    """Distinct normalised keys only one side has, with ``side``: missing (from target) or extra.

    One aggregation over both sides instead of two anti-joins; NULL equals NULL.
    """
    names = list(source_keys)
    both = _keys(source, source_keys).withColumn("__s", F.lit(1)).withColumn("__t", F.lit(0)).unionByName(
        _keys(target, target_keys).withColumn("__s", F.lit(0)).withColumn("__t", F.lit(1))
    )
    seen = both.groupBy(*names).agg(F.max("__s").alias("__s"), F.max("__t").alias("__t"))
    lone = seen.filter(F.col("__s") != F.col("__t"))
    return lone.select(*names, F.when(F.col("__s") == 1, F.lit("missing")).otherwise(F.lit("extra")).alias("side"))


def missing_within(
    source: DataFrame,
    target: DataFrame,
    keys: Mapping[str, tuple[Column, Column]],
    number: tuple[Column, Column],
    tolerance: float,
) -> DataFrame:
    """Source rows without a target row of equal keys and a number strictly closer than `tolerance`.

    Numbers are cut into cells as wide as the tolerance; a partner can only lie in the same or
    a neighbouring cell, so the join stays an equi-join.
    """
    source_number, target_number = number
    cell = lambda c: F.floor(c / F.lit(tolerance))
    partners = target.select(*[t.alias(f"__k{i}") for i, (_, t) in enumerate(keys.values())], target_number.alias("__x")).distinct()
    partners = partners.withColumn("__cell", F.explode(F.array(*[cell(F.col("__x")) + d for d in (-1, 0, 1)])))
    rows = source.withColumn("__y", source_number).withColumn("__at", cell(F.col("__y")))
    conditions = [s.eqNullSafe(F.col(f"__k{i}")) for i, (s, _) in enumerate(keys.values())]
    conditions += [F.col("__at") == F.col("__cell"), F.abs(F.col("__y") - F.col("__x")) < tolerance]
    return rows.join(partners, reduce(lambda a, b: a & b, conditions), "left_anti").drop("__y", "__at")


#: Leaves of a digest tree; each node of the upper level has as many leaves as there are nodes.
LEAVES = 1 << 16


def digests(df: DataFrame, keys: Mapping[str, Column], leaves: int = LEAVES) -> DataFrame:
    """(node, leaf, n, a, b): for each leaf that the normalised keys hash to, a digest of the rows in it.

    The digest is the number of rows and two sums over their hashes, so it depends neither on the order of
    the rows nor on how they are partitioned, parts add up, and a table of at most `leaves` short rows
    stands for a side of any size.  It may be stored and compared later.
    """
    nodes = max(1, round(leaves**0.5))
    h = F.xxhash64(*_null_safe(keys))
    hashed = df.select(h.alias("h"), F.xxhash64(F.lit(1), *_null_safe(keys)).alias("g"))
    leaf = F.pmod("g", F.lit(leaves)).cast("int").alias("leaf")
    # Halves of a hash: their sums stay within 64 bits for two billion rows a leaf.
    sums = [F.count(F.lit(1)).alias("n"), F.sum(F.shiftright("h", 32)).alias("a"), F.sum(F.col("h").bitwiseAND(F.lit((1 << 32) - 1))).alias("b")]
    return hashed.groupBy(leaf).agg(*sums).select(F.pmod("leaf", F.lit(nodes)).alias("node"), "leaf", "n", "a", "b")


def _null_safe(keys: Mapping[str, Column]) -> list[Column]:
    """Hashes skip NULL; a flag beside each key tells it from a missing neighbour."""
    return [x for c in keys.values() for x in (c.isNull(), c)]


def differing(source: DataFrame, target: DataFrame) -> DataFrame:
    """(leaf) of two digest tables that hold different rows: nodes first, then the leaves of those that differ."""

    def unlike(a: DataFrame, b: DataFrame, by: str) -> DataFrame:
        both = a.withColumn("side", F.lit(1)).unionByName(b.withColumn("side", F.lit(-1)))
        sums = both.groupBy(by).agg(*[F.sum(F.col(c) * F.col("side")).alias(c) for c in ("n", "a", "b")])
        return sums.where("n <> 0 or a <> 0 or b <> 0").select(by)

    tops = [d.groupBy("node").agg(*[F.sum(c).alias(c) for c in ("n", "a", "b")]) for d in (source, target)]
    nodes = unlike(*tops, "node")
    return unlike(source.join(nodes, "node", "left_semi").drop("node"), target.join(nodes, "node", "left_semi").drop("node"), "leaf")


def suspects(df: DataFrame, keys: Mapping[str, Column], leaves: DataFrame, count: int = LEAVES) -> DataFrame:
    """Rows of `df` whose keys fall into one of `leaves`."""
    marked = df.withColumn("__leaf", F.pmod(F.xxhash64(F.lit(1), *_null_safe(keys)), F.lit(count)).cast("int"))
    return marked.join(leaves.select(F.col("leaf").alias("__leaf")), "__leaf", "left_semi").drop("__leaf")


def reconcile_by_digest(source: DataFrame, target: DataFrame, source_keys: Mapping[str, Column], target_keys: Mapping[str, Column], leaves: int = LEAVES) -> DataFrame:
    """`reconcile` for two large sides that agree in nearly all rows: only rows of leaves that differ are shuffled.

    Sides that hold the same keys in different numbers differ here, too, and are then compared key by
    key; the result is that of `reconcile`.
    """
    found = differing(digests(source, source_keys, leaves), digests(target, target_keys, leaves))
    return reconcile(suspects(source, source_keys, found, leaves), suspects(target, target_keys, found, leaves), source_keys, target_keys)
