"""One row per key, top rows per key, duplicate reports.

Keeping one row per key is ``row_number() = 1``: Spark turns the filter into a group
limit that runs before the exchange, so a hot key sends at most one row per input
partition across the network.
"""

from __future__ import annotations

import functools
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlift.functions.text import ColumnOrName, col

_RANK = "__rank"


def top_rows(
    df: DataFrame,
    keys: Sequence[ColumnOrName],
    order: Sequence[Column],
    n: int = 1,
    rank_as: str | None = None,
) -> DataFrame:
    """The first `n` rows of every key under `order`; make `order` total for a stable answer."""
    name = rank_as or _RANK
    window = Window.partitionBy(*[col(k) for k in keys]).orderBy(*order)
    kept = df.withColumn(name, F.row_number().over(window)).filter(F.col(name) <= n)
    return kept if rank_as else kept.drop(name)


def keep_first(df: DataFrame, keys: Sequence[ColumnOrName], order: Sequence[Column]) -> DataFrame:
    return top_rows(df, keys, order, 1)


def keep_newest(
    df: DataFrame,
    keys: Sequence[ColumnOrName],
    updated: str = "updated_at",
    created: str = "created_at",
    tiebreak: Sequence[ColumnOrName] = ("id",),
    fall_back_to_created: bool = False,
) -> DataFrame:
    """Newest row per key.

    With `fall_back_to_created` a row never updated competes with its creation time;
    otherwise it loses against every updated row.
    """
    newest = F.coalesce(F.col(updated), F.col(created)) if fall_back_to_created else F.col(updated)
    order = [newest.desc_nulls_last(), F.col(created).desc_nulls_last()]
    order += [col(t).asc_nulls_last() for t in tiebreak]
    return keep_first(df, keys, order)


def keep_first_upload(
    df: DataFrame, key: ColumnOrName, row_no: str, row_id: ColumnOrName | None = None
) -> DataFrame:
    """First uploaded row per key; rows without a key are all kept (each is its own group)."""
    order = [F.col(row_no).asc_nulls_last()] + ([] if row_id is None else [col(row_id).asc_nulls_last()])
    with_key = keep_first(df.filter(col(key).isNotNull()), [key], order)
    return with_key.unionByName(df.filter(col(key).isNull()))


def keep_last_upload(df: DataFrame, keys: Sequence[ColumnOrName], row_no: str) -> DataFrame:
    return keep_first(df, keys, [F.col(row_no).desc_nulls_last()])


def key_counts(df: DataFrame, keys: Sequence[str], count_as: str = "n") -> DataFrame:
    """Rows per key; aggregated on the map side, so skew in the key costs nothing."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(count_as))


def duplicate_surplus(df: DataFrame, keys: Sequence[str], surplus_as: str = "surplus") -> DataFrame:
    """Number of rows beyond the first of each key; 0 when there are none.  NULL keys are ignored."""
    present = df.dropna(subset=list(keys))
    counts = key_counts(present, keys).filter(F.col("n") > 1)
    return counts.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).cast("bigint").alias(surplus_as))


def duplicate_listing(df: DataFrame, keys: Sequence[str], count_as: str = "copies") -> DataFrame:
    """Every row whose key occurs more than once, with the number of copies; NULL equals NULL."""
    repeated = key_counts(df, keys, count_as).filter(F.col(count_as) > 1).withColumnsRenamed({k: f"__k_{k}" for k in keys})
    same = functools.reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"__k_{k}")) for k in keys])
    return df.join(repeated, same, "inner").drop(*[f"__k_{k}" for k in keys])
