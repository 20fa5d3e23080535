"""Counts, fill rates, skip reasons, funnels, rejects."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlift.functions.text import ColumnOrName, col
from ledgerlift.operators.dedupe import top_rows

REASON = "_reason"


def distinct_count(df: DataFrame, key: ColumnOrName, count_as: str = "n") -> DataFrame:
    return df.agg(F.countDistinct(col(key)).alias(count_as))


def count_by_parent(parent: DataFrame, child: DataFrame, parent_key: str, child_key: str, count_as: str) -> DataFrame:
    """Parents with their number of children, zero included.

    Children are counted before the join, so the join sees one row per key.
    """
    counts = child.groupBy(F.col(child_key).alias("__k")).agg(F.count(F.lit(1)).alias("__n"))
    joined = parent.join(counts, F.col(parent_key) == F.col("__k"), "left").drop("__k")
    return joined.withColumn(count_as, F.coalesce("__n", F.lit(0))).drop("__n")


def conditional_counts(df: DataFrame, conditions: Mapping[str, Column]) -> DataFrame:
    return df.agg(*[F.count_if(F.coalesce(c, F.lit(False))).alias(n) for n, c in conditions.items()])


def breakdown(df: DataFrame, by: Mapping[str, ColumnOrName], count_as: str = "n") -> DataFrame:
    groups = [col(c).alias(n) for n, c in by.items()]
    return df.groupBy(*groups).agg(F.count(F.lit(1)).alias(count_as)).orderBy(*[F.col(n).asc_nulls_last() for n in by])


def max_or(df: DataFrame, c: ColumnOrName, default: str, name: str) -> DataFrame:
    """Largest non-blank value, or the default on an empty input; always one row."""
    return df.agg(F.coalesce(F.max(F.nullif(F.trim(col(c)), F.lit(""))), F.lit(default)).alias(name))


def fill_rate(df: DataFrame, columns: Sequence[str] | None = None, worst: int | None = None) -> DataFrame:
    """NULL and non-NULL counts per column, emptiest first; a single pass over the data."""
    names = list(columns or df.columns)
    counts = df.agg(F.count(F.lit(1)).alias("__all"), *[F.count(F.col(c)).alias(c) for c in names])
    rows = F.array(
        *[F.struct(F.lit(c).alias("column_name"), (F.col("__all") - F.col(c)).alias("nulls"), F.col(c).alias("non_nulls")) for c in names]
    )
    report = counts.select(F.inline(rows)).orderBy(F.desc("nulls"), F.desc("non_nulls"), F.desc("column_name"))
    return report if worst is None else report.limit(worst)


def with_reason(df: DataFrame, reasons: Mapping[str, Column]) -> DataFrame:
    """Add the first reason that applies, NULL when the row is accepted."""
    chain = F.coalesce(*[F.when(F.coalesce(c, F.lit(False)), F.lit(n)) for n, c in reasons.items()])
    return df.withColumn(REASON, chain)


def skip_report(df: DataFrame, reasons: Sequence[str], prefix: str = "skipped_") -> DataFrame:
    """One row: processed, accepted, skipped in total and by reason."""
    return df.agg(*[c.alias(n) for n, c in skip_counts(reasons, prefix).items()])


def skip_counts(reasons: Sequence[str], prefix: str = "skipped_") -> dict[str, Column]:
    """The counts of `skip_report`, for a job that counts rows while it writes them."""
    totals = {"processed": F.count(F.lit(1)), "accepted": F.count_if(F.col(REASON).isNull()), f"{prefix}total": F.count_if(F.col(REASON).isNotNull())}
    return totals | {f"{prefix}{r}": F.count_if(F.col(REASON) == r) for r in reasons}


def reason_samples(df: DataFrame, order: Sequence[Column], n: int) -> DataFrame:
    """First `n` rows of each skip reason (a report feature)."""
    return top_rows(df.filter(F.col(REASON).isNotNull()), [REASON], order, n, rank_as="sample_no")


def mapping_stats(df: DataFrame, pairs: Mapping[str, tuple[ColumnOrName, ColumnOrName]]) -> DataFrame:
    """Per lookup: rows with a raw value that did and did not resolve; pairs are (raw, resolved)."""
    counts = []
    for name, (raw, resolved) in pairs.items():
        has = col(raw).isNotNull()
        counts.append(F.count_if(has & col(resolved).isNotNull()).alias(f"{name}_mapped"))
        counts.append(F.count_if(has & col(resolved).isNull()).alias(f"{name}_unmapped"))
    return df.agg(*counts)


def unmapped_values(df: DataFrame, raw: ColumnOrName, resolved: ColumnOrName, n: int | None = None) -> DataFrame:
    """Distinct raw values that did not resolve; the least `n` of them on request."""
    values = df.filter(col(raw).isNotNull() & col(resolved).isNull()).select(col(raw).alias("value")).distinct().orderBy("value")
    return values if n is None else values.limit(n)


def funnel(df: DataFrame, stages: Mapping[str, Column]) -> DataFrame:
    """Rows that pass each stage and all stages before it."""
    passed, counts = F.lit(True), []
    for name, condition in stages.items():
        passed = passed & F.coalesce(condition, F.lit(False))
        counts.append(F.count_if(passed).alias(name))
    return df.agg(*counts)


def suspicious_rows(df: DataFrame, columns: Sequence[str], shape: str) -> DataFrame:
    """Rows in which one of the columns still has the given shape (an id where a name belongs)."""
    hit = F.lit(False)
    for c in columns:
        hit = hit | F.coalesce(F.col(c).rlike(shape), F.lit(False))
    return df.filter(hit)


def rejects(df: DataFrame, rules: Mapping[str, tuple[str, Column]], row_id: str) -> DataFrame:
    """One row per broken rule: row id, rule code, column and offending value.

    `rules` maps a code to (column, condition that is true when the rule is broken).
    """
    found = F.array(
        *[
            F.struct(
                F.lit(code).alias("code"),
                F.lit(column).alias("column_name"),
                F.col(column).cast("string").alias("value"),
                F.coalesce(broken, F.lit(False)).alias("broken"),
            )
            for code, (column, broken) in rules.items()
        ]
    )
    rows = df.select(F.col(row_id), F.inline(F.filter(found, lambda x: x["broken"])))
    return rows.drop("broken")


def column_presence(columns: Sequence[str], expected: Sequence[str]) -> dict[str, list[str]]:
    """Expected columns found and missing, and columns nobody asked for (metadata only)."""
    have = {c.strip().lower() for c in columns}
    return {
        "found": sorted(have & set(expected)),
        "missing": sorted(set(expected) - have),
        "unused": sorted(have - set(expected)),
        "renamed": sorted(c for c in columns if c != c.strip().lower()),
    }
