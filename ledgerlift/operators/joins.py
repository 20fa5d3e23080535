"""Lookups and existence tests, all as equi-joins.

No operator here hints a broadcast of data that grows.  Small sides are broadcast by
Catalyst (size estimate) or AQE (measured size); large skewed sides are split by AQE's
skew join, or by ``lookup_hot``, which finds the keys that dominate and salts only those.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlift.functions.text import ColumnOrName, col, key_text
from ledgerlift.operators.dedupe import keep_first

_KEY, _KEY_OF_DIM = "__lookup_key", "__dim_key"


#: Columns that tell rows apart, as a rule: the spread needs no other where one is there.
_IDENTITY = ("_row", "id")
#: Places over which rows without a key are spread where the place is a column: two bytes of its eight vary.
SPREAD = 1 << 16
#: That column, where a chain of narrow lookups makes it once: later ones need no identity any more.
PLACE = "__place"


def spread_nulls(key: Column, columns: Sequence[str]) -> Column:
    """Second join key that spreads rows without a key over all partitions.

    Such rows match nothing, but an outer join would still send them all to one task.  The
    spread comes from the row's content, so a retried task puts a row where it was before.
    A row number or id is enough and keeps the scan narrow; without one, all columns count.
    """
    known = [c for c in columns if c in _IDENTITY]
    content = F.xxhash64(*[F.col(f"`{c}`") for c in known or columns])
    return F.when(key.isNull(), content).otherwise(F.lit(0).cast("bigint"))


def placed(df: DataFrame) -> DataFrame:
    """`df` with the place of each row, should it have no key."""
    return df.withColumn(PLACE, F.pmod(spread_nulls(F.lit(None), df.columns), F.lit(SPREAD)))


def no_spread(*keys: ColumnOrName) -> Column:
    """The other side's second join key: always zero, but not a constant.

    The optimizer would fold a literal into the join condition, and the key would be lost.
    """
    return F.pmod(F.xxhash64(*keys), F.lit(1).cast("bigint"))


def _one_per_key(dim: DataFrame, key: Column, take: Mapping[str, ColumnOrName], order: Sequence[Column]) -> DataFrame:
    """(key, taken columns) with one row per key: the least under `order`, by default of the values, missing ones last."""
    values = [col(source).alias(name) for name, source in take.items()]
    if not order:
        # A missing value ranks behind any other, so an empty row never hides a filled one.
        ranked = [x for name, source in take.items() for x in (col(source).isNull().alias(f"__no_{name}"), col(source).alias(name))]
        if len(values) == 1:
            # Of one column that is its minimum: a bare value is sorted and sent, not a struct.
            return dim.select(key.alias(_KEY), *values).filter(F.col(_KEY).isNotNull()).groupBy(_KEY).agg(F.min(*take).alias(*take))
        keyed = dim.select(key.alias(_KEY), F.struct(*ranked).alias("__v")).filter(F.col(_KEY).isNotNull())
        least = keyed.groupBy(_KEY).agg(F.min("__v").alias("__v"))
        return least.select(_KEY, *[F.col(f"__v.{name}").alias(name) for name in take])
    ranked = dim.withColumn(_KEY, key).filter(F.col(_KEY).isNotNull())
    return keep_first(ranked, [_KEY], order).select(_KEY, *values)


def lookup(
    df: DataFrame,
    dim: DataFrame,
    on: ColumnOrName,
    key: ColumnOrName,
    take: Mapping[str, ColumnOrName],
    normalise=key_text,
    order: Sequence[Column] = (),
    miss: str = "null",
    unique: bool = False,
    narrow: bool = False,
) -> DataFrame:
    """Left join `df` to `dim` on a normalised key and add the `take` columns.

    `dim` is reduced to one row per key first, so the row count never changes; `unique`
    skips that where the key is known to be one.  With ``miss="raw"`` the single taken
    column falls back to the value that was looked up.  With `narrow` the join key is made before
    the join: columns that only the key needs, such as a long id that spreads rows, stay out of its shuffle.
    """
    same = col if normalise is None else normalise
    if unique:
        one = dim.select(same(key).alias(_KEY), *[col(s).alias(n) for n, s in take.items()])
    else:
        one = _one_per_key(dim, same(key), take, order)
    dim_side = one.withColumnRenamed(_KEY, "__dim_key").withColumn("__dim_spread", no_spread(_KEY_OF_DIM))
    probe = same(on)
    spread = spread_nulls(probe, df.columns)
    if narrow:
        place = F.col(PLACE) if PLACE in df.columns else F.pmod(spread, F.lit(SPREAD))
        df = df.withColumns({"__probe": probe, "__spread": F.when(probe.isNull(), place).otherwise(F.lit(0).cast("bigint"))})
        probe, spread = F.col("__probe"), F.col("__spread")
    matches = (probe == F.col("__dim_key")) & (spread == F.col("__dim_spread"))
    joined = df.join(dim_side, matches, "left").drop("__dim_key", "__dim_spread", "__probe", "__spread")
    if miss == "raw":
        (name,) = take
        return joined.withColumn(name, F.coalesce(F.col(name), col(on)))
    return joined


def replace_ids(df: DataFrame, columns: Sequence[str], dims: Mapping[str, DataFrame], normalise) -> DataFrame:
    """Replace ids by names in place, one (id, name) table per column; unknown ids stay."""
    have = set(df.columns)
    for name in columns:
        if name not in dims or name not in have:
            continue
        looked_up = lookup(df, dims[name], name, "id", {"__name": "name"}, normalise)
        df = looked_up.withColumn(name, F.coalesce("__name", name)).drop("__name")
    return df


def either_key(dim: DataFrame, keys: Sequence[ColumnOrName], take: Mapping[str, ColumnOrName]) -> DataFrame:
    """Alias table for "matches on code OR label": one row per spelling, so one equi-join does."""
    spellings = F.array_distinct(F.array(*[col(k) for k in keys]))
    rows = dim.select(F.explode(spellings).alias("alias"), *[col(s).alias(n) for n, s in take.items()])
    return rows.filter(F.col("alias").isNotNull())


def first_child(
    parent: DataFrame,
    child: DataFrame,
    parent_key: str,
    child_key: str,
    take: Mapping[str, ColumnOrName],
    order: Sequence[Column],
) -> DataFrame:
    """Parent with columns of its first child under `order` (left join)."""
    return lookup(parent, child, parent_key, child_key, take, normalise=None, order=order)


def having(df: DataFrame, other: DataFrame, pairs: Sequence[tuple[str, str]], null_safe: bool = False) -> DataFrame:
    """Rows of `df` that have a partner in `other`."""
    return _exists(df, other, pairs, null_safe, "left_semi")


def lacking(df: DataFrame, other: DataFrame, pairs: Sequence[tuple[str, str]], null_safe: bool = False) -> DataFrame:
    """Rows of `df` without a partner in `other`."""
    return _exists(df, other, pairs, null_safe, "left_anti")


def _exists(df, other, pairs, null_safe, how):
    # Distinct partners: a key repeated on the other side crosses the network once per task.
    renamed = other.select(*[col(b).alias(f"__o{i}") for i, (_, b) in enumerate(pairs)]).distinct()
    condition = F.lit(True)
    for i, (a, _) in enumerate(pairs):
        right = F.col(f"__o{i}")
        condition = condition & (col(a).eqNullSafe(right) if null_safe else col(a) == right)
    return df.join(renamed, condition, how)


def orphans(child: DataFrame, parent: DataFrame, fk: str, pk: str = "id", null_is_orphan: bool = False) -> DataFrame:
    """Children whose foreign key points nowhere."""
    missing = lacking(child.filter(F.col(fk).isNotNull()), parent, [(fk, pk)])
    return missing.unionByName(child.filter(F.col(fk).isNull())) if null_is_orphan else missing


def fan_out(df: DataFrame, dim: DataFrame, on: ColumnOrName, key: ColumnOrName, take: Mapping[str, ColumnOrName]) -> DataFrame:
    """Inner join to every dimension row that shares the normalised key."""
    rows = dim.select(key_text(key).alias(_KEY), *[col(s).alias(n) for n, s in take.items()])
    return df.join(rows, key_text(on) == F.col(_KEY), "inner").drop(_KEY)


def cross_one(df: DataFrame, single: DataFrame) -> DataFrame:
    """Attach the columns of a relation of at most one row; more than one row fails the job."""
    row = single.agg(F.count(F.lit(1)).alias("__n"), *[F.min(c).alias(c) for c in single.columns])
    checked = row.filter(
        F.when(F.col("__n") <= 1, F.col("__n") == 1).otherwise(F.raise_error(F.lit("expected at most one row")))
    )
    return df.crossJoin(F.broadcast(checked.drop("__n")))


#: A key with this share of the rows or more is hot: at most 256 of them.
HOT_SHARE = 1 / 256


def hot_keys(df: DataFrame, on: ColumnOrName, share: float = HOT_SHARE) -> DataFrame:
    """One row with the array ``hot`` of the keys that `share` of the rows or more have, NULL left out.

    A mergeable summary of the most frequent keys, in one pass: it tracks 32 times as many keys as can
    be hot, which bounds its error to about a tenth of `share`, and keys that near the bound may be
    listed as well.
    """
    most = max(1, round(1 / share))
    top = F.call_function("approx_top_k", col(on), F.lit(most), F.lit(32 * most))
    found = df.agg(top.alias("top"), F.count(F.lit(1)).alias("n"))
    frequent = F.filter("top", lambda x: x["item"].isNotNull() & (x["count"] >= F.col("n") * share))
    return found.select(F.transform(frequent, lambda x: x["item"]).alias("hot"))


def replicated(dim: DataFrame, key: ColumnOrName, hot: DataFrame, parts: int, name: str) -> DataFrame:
    """`dim` with the part `name`: rows of hot keys once for each of `parts`, the others in part 0 only."""
    copies = F.when(F.array_contains("hot", col(key)), F.sequence(F.lit(0), F.lit(parts - 1))).otherwise(F.array(F.lit(0)))
    return dim.crossJoin(F.broadcast(hot)).withColumn(name, F.explode(copies)).drop("hot")


def lookup_hot(
    df: DataFrame,
    dim: DataFrame,
    on: str,
    key: str,
    take: Mapping[str, ColumnOrName],
    parts: int = 16,
    share: float = HOT_SHARE,
) -> DataFrame:
    """`lookup` for a large dimension when a few keys of `df` may dominate, whichever they are.

    Keys that `share` of the rows have are found in one pass over the key column.  A row of such a key
    draws one of `parts` numbers from its content, and only the hot keys' dimension rows are there
    once for each of them; all others meet as in a plain join.  The hot keys, 256 at most, are
    broadcast as one row.
    """
    hot = hot_keys(df, F.col(on), share)
    one = _one_per_key(dim, col(key), take, ()).withColumnRenamed(_KEY, _KEY_OF_DIM)
    side = replicated(one, _KEY_OF_DIM, hot, parts, "__part")
    content = F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])
    salted = F.when(F.array_contains("__hot", F.col(on)), F.pmod(content, F.lit(parts))).otherwise(F.lit(0))
    mine = F.when(F.col(on).isNull(), content).otherwise(salted)
    rows = df.crossJoin(F.broadcast(hot.withColumnRenamed("hot", "__hot"))).withColumn("__mine", mine).drop("__hot")
    matches = (F.col(on) == F.col(_KEY_OF_DIM)) & (F.col("__mine") == F.col("__part"))
    return rows.join(side, matches, "left").drop(_KEY_OF_DIM, "__part", "__mine")
