"""Backfill and repair jobs with one contract: preview counts exactly what apply changes.

A job is one left join of its table with what it looks up.  Rows that may not change (for
example: no foreign key, target column set) have no key in it and are spread over all tasks,
so a chain of jobs reads its table once and a column full of NULL keys lands in no one task.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlift.functions.people import bare_name, email_in, has_separator, phone_in
from ledgerlift.functions.text import ColumnOrName, blank_to_null, col
from ledgerlift.operators.dedupe import keep_first
from ledgerlift.operators.joins import lookup

CHANGED = "_changed"


@dataclass(frozen=True)
class ChangeSet:
    """The whole table in its new form; ``_changed`` marks the rows that differ."""

    candidates: DataFrame
    columns: tuple[str, ...]
    #: The candidates without rows that may not change, which need no lookup where changes are only counted.
    possible: Callable[[], DataFrame] | None = None

    def changed(self) -> DataFrame:
        """The rows that change, in their new form."""
        return self.candidates.filter(F.col(CHANGED)).select(*self.columns)

    def preview(self, count_as: str = "rows_to_change") -> DataFrame:
        rows = self.candidates if self.possible is None else self.possible()
        return rows.agg(F.count_if(F.col(CHANGED)).alias(count_as))

    def apply(self) -> DataFrame:
        """The whole table after the job."""
        return self.candidates.select(*self.columns)


def update_where(df: DataFrame, sets: Mapping[str, Column], where: Column) -> ChangeSet:
    """Row-local update: no join, so no shuffle."""
    flag = F.coalesce(where, F.lit(False))
    marked = df.withColumn(CHANGED, flag)
    out = [
        (F.when(F.col(CHANGED), sets[c]).otherwise(F.col(c)).cast(df.schema[c].dataType).alias(c) if c in sets else F.col(c))
        for c in df.columns
    ]
    return ChangeSet(marked.select(*out, CHANGED), tuple(df.columns))


def backfill(
    child: DataFrame,
    parent: DataFrame,
    fk: ColumnOrName,
    pk: ColumnOrName,
    set_cols: Mapping[str, ColumnOrName],
    only_null: bool = True,
    normalise: Callable[[ColumnOrName], Column] | None = None,
    order: Sequence[Column] = (),
    unique: bool = False,
    where: Column | None = None,
) -> ChangeSet:
    """Set child columns from the parent row found through `fk`.

    `only_null` fills NULLs; otherwise a found, non-NULL parent value replaces the old one
    when it differs.  A parent that is ambiguous on `pk` is settled by `order`.
    """
    key = (normalise or col)(fk)
    eligible = key.isNotNull()
    if only_null:
        eligible = eligible & reduce(lambda a, b: a | b, [F.col(c).isNull() for c in set_cols])
    if where is not None:
        eligible = eligible & F.coalesce(where, F.lit(False))
    take = {f"__new_{c}": source for c, source in set_cols.items()}
    # A row that may not change looks up nothing: one join over the whole table, which is read once.
    probe = F.when(eligible, col(fk))
    filled = lambda rows: _filled(child, lookup(rows, parent, probe, pk, take, normalise, order, unique=unique, narrow=True), set_cols, only_null)
    return replace(filled(child), possible=lambda: filled(child.filter(eligible)).candidates)


def backfill_in_place(child: DataFrame, parent: DataFrame, fk: str, pk: str, set_cols: Mapping[str, str], only_null: bool = True) -> ChangeSet:
    """`backfill` from a parent with one row per key by the bare columns, which is no shuffle if both are bucketed by them."""
    found = parent.select(F.col(pk).alias("__pk"), *[F.col(source).alias(f"__new_{c}") for c, source in set_cols.items()])
    return _filled(child, child.join(found, F.col(fk) == F.col("__pk"), "left").drop("__pk"), set_cols, only_null)


def _filled(child: DataFrame, candidates: DataFrame, set_cols: Mapping[str, ColumnOrName], only_null: bool) -> ChangeSet:
    differs, out = F.lit(False), []
    for c in child.columns:
        if c not in set_cols:
            out.append(F.col(c))
            continue
        new = F.col(f"__new_{c}").cast(child.schema[c].dataType)
        value = F.coalesce(F.col(c), new) if only_null else F.coalesce(new, F.col(c))
        differs = differs | ~value.eqNullSafe(F.col(c))
        out.append(value.alias(c))
    return ChangeSet(candidates.select(*out, differs.alias(CHANGED)), tuple(child.columns))


def chained(child: DataFrame, *steps: Callable[[DataFrame], ChangeSet]) -> DataFrame:
    """Apply backfills one after the other; a later fill-null step sees what is still missing."""
    for step in steps:
        child = step(child).apply()
    return child


def backfill_tables(
    tables: Mapping[str, DataFrame],
    parent: DataFrame,
    spec: Mapping[str, tuple[str, str]],
    set_cols: Mapping[str, ColumnOrName],
    **options,
) -> dict[str, ChangeSet]:
    """The same backfill over many tables: `spec` maps table -> (foreign key, parent key).

    Tables that do not exist are skipped, as are target columns a table lacks.
    """
    jobs = {}
    for name, (fk, pk) in spec.items():
        if name not in tables or fk not in tables[name].columns:
            continue
        have = set(tables[name].columns)
        wanted = {c: s for c, s in set_cols.items() if c in have}
        if wanted:
            jobs[name] = backfill(tables[name], parent, fk, pk, wanted, **options)
    return jobs


def preview_all(jobs: Mapping[str, ChangeSet], steps: Mapping[str, str] | None = None) -> DataFrame:
    """One row per table with the number of rows the job would change."""
    parts = [job.preview().select(F.lit(name).alias("table_name"), "rows_to_change") for name, job in jobs.items()]
    return reduce(DataFrame.unionByName, parts)


def user_of_application(applications: DataFrame, users: DataFrame) -> DataFrame:
    """(application_id, user_id) through the normalised user name; shared by all tables."""
    named = applications.select(F.col("id").alias("application_id"), "username")
    found = lookup(named, users, "username", "username", {"user_id": "id"})
    return found.filter(F.col("user_id").isNotNull()).select("application_id", "user_id")


def repoint_orphans(child: DataFrame, parent: DataFrame, owner: str, fk: str, pk: str, order: Sequence[Column]) -> ChangeSet:
    """Re-point a missing or dangling `fk` to the first parent row of the same owner."""
    alive = parent.select(pk).distinct()
    flagged = lookup(child, alive, fk, pk, {"__alive": pk}, normalise=None, unique=True)
    job = backfill(flagged, parent, owner, owner, {fk: pk}, only_null=False, order=order, where=F.col("__alive").isNull())
    return ChangeSet(job.candidates, tuple(child.columns))


def recover_from_siblings(child: DataFrame, siblings: Sequence[DataFrame], shared: str, column: str) -> DataFrame:
    """Fill `column` from sibling tables that share an orphaned key and still know it, in order."""
    for sibling in siblings:
        known = sibling.filter(F.col(column).isNotNull())
        child = backfill(child, known, shared, shared, {column: column}).apply()
    return child


def clean_contact_names(df: DataFrame, name: str = "name", phone: str | None = "mobile_no", email: str | None = "email", trim_name: bool = True) -> ChangeSet:
    """Move phone and e-mail out of a free-text name into blank columns, then shorten the name."""
    text, sets, hit = F.col(name), {}, F.lit(False)
    for column, found in ((phone, phone_in(text)), (email, email_in(text))):
        if column is None:
            continue
        blank = blank_to_null(column).isNull()
        sets[column] = F.when(blank & found.isNotNull(), found).otherwise(F.col(column))
        hit = hit | (blank & found.isNotNull())
    if trim_name:
        sets[name] = F.when(has_separator(text), bare_name(text)).otherwise(F.trim(text))
        hit = hit | has_separator(text)
    return update_where(df, sets, hit)


def drop_duplicate_approvals(certificates: DataFrame, tiebreak: Sequence[ColumnOrName] = ("id",)) -> DataFrame:
    """Keep the certificate that expires last per approval number; rows without one all stay."""
    key = blank_to_null("approval_no")
    order = [F.col("expire_date").desc_nulls_last(), F.col("created_at").desc_nulls_last()]
    order += [col(t).asc_nulls_last() for t in tiebreak]
    kept = keep_first(certificates.filter(key.isNotNull()), ["approval_no"], order)
    return kept.unionByName(certificates.filter(key.isNull()))
