"""Last-writer registers: uploads that arrive late, twice or out of order end in the same table.

Each column of a row keeps, beside its value, the place that wrote it: when the file was written and
where the row stood in it.  Of two values the one written later stays, and a missing value writes
nothing.  Taking the later of two is commutative, associative and idempotent, so any number of uploads in
any order and grouping converge.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def registers(df: DataFrame, keys: Sequence[str], columns: Sequence[str], place: str) -> DataFrame:
    """One row per key: the keys, and for each column a struct (place, value) of its last writer.

    Rows without a key are left out.  One aggregation with partial maxima, however hot a key is.
    """
    at = F.col(f"`{place}`")
    present = [F.col(f"`{k}`").isNotNull() for k in keys]
    rows = df.where(present[0] if len(present) == 1 else F.forall(F.array(*present), lambda p: p))
    last = [F.max(F.when(F.col(f"`{c}`").isNotNull(), F.struct(at.alias("place"), F.col(f"`{c}`").alias("value")))).alias(c) for c in columns]
    return rows.groupBy(*keys).agg(*last)


def combined(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The registers of both sides; columns that only one side has are kept."""
    both = target.unionByName(source, allowMissingColumns=True)
    return both.groupBy(*keys).agg(*[F.max(f"`{c}`").alias(c) for c in both.columns if c not in keys])


def values(table: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The table that the registers stand for."""
    return table.select(*keys, *[F.col(f"`{c}`.value").alias(c) for c in table.columns if c not in keys])
