"""Merge (upsert) of a source into a target under a policy per column.

Two plans give the same rows, and the caller says which.  ``outer``: both sides meet in one
full outer join on the key.  ``in_place``, for a small stored source and a large target: the
target is left-joined, so that it need not be shuffled, and rows to insert come from an
anti-join of the source against the keys it matched; the source is read three times.
"""

from __future__ import annotations

import functools
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlift.functions.people import has_separator
from ledgerlift.functions.text import blank_to_null, col
from ledgerlift.operators.joins import lookup, no_spread, spread_nulls

ACTION = "_action"
Rule = Callable[[Column, Column], Column]


@dataclass(frozen=True)
class Policy:
    """How a column of a matched row is formed from its (old, new) values.

    A `neutral` rule yields the one value there is when the other is NULL, so it also serves
    rows that only one side has.
    """

    name: str
    on_match: Rule
    neutral: bool = False


INCOMING = Policy("incoming first", lambda old, new: F.coalesce(new, old), neutral=True)
EXISTING = Policy("existing first", lambda old, new: F.coalesce(old, new), neutral=True)
EXISTING_TEXT = Policy("existing first, blank counts as missing", lambda old, new: F.coalesce(blank_to_null(old), new))
OVERWRITE = Policy("overwrite", lambda old, new: new)
KEEP = Policy("keep", lambda old, new: old)
EITHER = Policy("true stays true", lambda old, new: F.coalesce(old, F.lit(False)) | F.coalesce(new, F.lit(False)))
CLEAN_NAME = Policy(
    "replace only text that still holds a separator",
    lambda old, new: F.when(has_separator(old), new).otherwise(F.coalesce(old, new)),
)


def constant(value: Any) -> Policy:
    return Policy(f"constant {value!r}", lambda old, new: F.lit(value))


class DuplicateKeys(ValueError):
    pass


def check_unique(
    source: DataFrame,
    keys: Sequence[str],
    match_on: Mapping[str, Callable[[Column], Column]] | None = None,
    fold: Mapping[str, Callable[[Column], Column]] | None = None,
) -> None:
    """Raise unless every key of `source` occurs once, in the form that is matched, and none is NULL.

    NULL is allowed where `match_on` makes it a value like any other.  One map-side combined
    aggregation; only two numbers reach the driver.
    """
    match_on = match_on or {}
    compared = {**match_on, **(fold or {})}
    forms = [(compared[k](F.col(k)) if k in compared else F.col(k)).alias(f"__u{i}") for i, k in enumerate(keys)]
    counts = source.groupBy(*forms).agg(F.count(F.lit(1)).alias("__n"))
    missing = F.lit(False)
    for i, key in enumerate(keys):
        if key not in match_on:
            missing = missing | F.col(f"__u{i}").isNull()
    row = counts.agg(
        F.coalesce(F.sum(F.when(F.col("__n") > 1, F.col("__n") - 1)), F.lit(0)).alias("surplus"),
        F.coalesce(F.sum(F.when(missing, F.col("__n"))), F.lit(0)).alias("missing"),
    ).first()
    if row["surplus"] or row["missing"]:
        raise DuplicateKeys(f"{row['surplus']} surplus rows and {row['missing']} rows without key on {list(keys)}")


def merge_into(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    policy: Mapping[str, Policy] | None = None,
    default: Policy = INCOMING,
    mode: str = "upsert",
    match_on: Mapping[str, Callable[[Column], Column]] | None = None,
    unique_source: bool = False,
    plan: str = "outer",
    fold: Mapping[str, Callable[[Column], Column]] | None = None,
) -> DataFrame:
    """Target rows after the merge, plus ``_action``: insert, update or keep.

    * ``mode``: ``upsert``, ``insert`` (matched rows stay as they are) or ``update``.
    * ``match_on``: key column -> expression compared instead of the raw value; such keys
      match NULL to NULL.
    * ``fold``: the same for keys whose NULL matches nothing, for example a number that
      counts without regard to case.
    * ``unique_source``: the caller guarantees one source row per key (it has just been
      de-duplicated); otherwise that is checked with one aggregation job.
    * ``plan``: ``outer`` or ``in_place``.

    Columns only one side has are kept; the other side contributes NULL.
    """
    if mode not in ("upsert", "insert", "update"):
        raise ValueError(f"unknown mode: {mode}")
    if plan not in ("outer", "in_place"):
        raise ValueError(f"unknown plan: {plan}")
    if not unique_source:
        check_unique(source, keys, match_on, fold)
    policy, match_on = dict(policy or {}), dict(match_on or {})
    forms = match_on | dict(fold or {})
    old_types = {f.name: f.dataType for f in target.schema.fields}
    new_types = {f.name: f.dataType for f in source.schema.fields}
    types = new_types | old_types
    columns = list(old_types) + [c for c in new_types if c not in old_types]
    probes = {mark: [f"__{mark}k{i}" for i in range(len(keys))] for mark in "ts"}

    def side(df: DataFrame, have: Mapping[str, Any], mark: str) -> DataFrame:
        """Probe columns, a presence flag, and the side's own columns under a prefix."""
        probe = [forms[k](F.col(k)) if k in forms else F.col(k) for k in keys]
        values = [c if have[c] == types[c] else F.col(c).cast(types[c]).alias(c) for c in have]
        names = [*probes[mark], f"__{mark}x", f"__{mark}", *[f"__{mark}_{c}" for c in have]]
        plain = [p for k, p in zip(keys, probe) if k not in match_on]
        spread = no_spread(*probe)
        if plain and mark == "t":
            # Target rows without a key match nothing; keep them out of one common task.
            spread = spread_nulls(functools.reduce(lambda a, b: F.when(b.isNotNull(), a), plain), list(have))
        return df.select(*[p.alias(n) for p, n in zip(probe, probes[mark])], spread.alias(f"__{mark}x"), F.lit(True).alias(f"__{mark}"), *values).toDF(*names)

    old, new = side(target, old_types, "t"), side(source, new_types, "s")
    condition = F.lit(True)
    for key, a, b in zip(keys, probes["t"], probes["s"]):
        equal = F.col(a).eqNullSafe(F.col(b)) if key in match_on else F.col(a) == F.col(b)
        condition = equal if key == keys[0] else condition & equal
    spread = F.col("__tx") == F.col("__sx")

    inserted, kept = F.col("__t").isNull(), F.col("__s").isNull()

    def combined(c: str) -> Column:
        if c not in new_types:
            before = F.col(f"__t_{c}")
            if c not in policy:
                return before.alias(c)
            return F.when(F.col("__t") & F.col("__s"), policy[c].on_match(before, F.lit(None))).otherwise(before).cast(types[c]).alias(c)
        if c not in old_types:
            before, after = F.lit(None).cast(types[c]), F.col(f"__s_{c}")
        else:
            before, after = F.col(f"__t_{c}"), F.col(f"__s_{c}")
        rule = KEEP if mode == "insert" or (c in keys and c not in policy) else policy.get(c, default)
        if rule.neutral:
            return rule.on_match(before, after).alias(c)
        if rule is KEEP:
            return F.when(inserted, after).otherwise(before).alias(c)
        on_match = rule.on_match(before, after).cast(types[c])
        return F.when(inserted, after).when(kept, before).otherwise(on_match).alias(c)

    matched = "keep" if mode == "insert" else "update"
    action = F.when(inserted, F.lit("insert")).when(kept, F.lit("keep")).otherwise(F.lit(matched)).alias(ACTION)
    output = [*[combined(c) for c in columns], action]
    if mode == "update":
        return old.join(new, condition & spread, "left").select(*output)
    if plan == "outer":
        return old.join(new, condition & spread, "full_outer").select(*output)

    here = old.join(new, condition, "left").select(*output)
    known = old.select(*probes["t"]).join(new.select(*probes["s"]), condition, "left_semi").distinct()
    fresh = new.join(known, condition, "left_anti")
    values = [F.col(f"__s_{c}").alias(c) if c in new_types else F.lit(None).cast(types[c]).alias(c) for c in columns]
    return here.unionByName(fresh.select(*values, F.lit("insert").alias(ACTION)))


def merged_rows(
    source: DataFrame, target: DataFrame, key: str, columns: Sequence[str], policy: Mapping[str, Policy] | None = None, default: Policy = INCOMING
) -> DataFrame:
    """The rows of `source` with `columns` as `merge_into` would leave them in `target`, which is not merged for it.

    A step that needs only the uploaded rows of a merged table reads them here, off the table as it was
    before.  Other columns of `source` stay.
    """
    policy, new, old = policy or {}, set(source.columns), set(target.columns)
    take = {f"__old_{c}": c for c in columns if c in old} | {"__known": F.lit(True)}
    rows = lookup(source, target, key, key, take, normalise=None, unique=True)

    def value(c: str) -> Column:
        before = F.col(f"__old_{c}") if c in old else F.lit(None)
        if c not in new:
            return before.alias(c)
        rule = KEEP if c == key else policy.get(c, default)
        after = F.when(F.col("__known"), rule.on_match(before, F.col(c))).otherwise(F.col(c))
        return (after.cast(target.schema[c].dataType) if c in old else after).alias(c)

    return rows.select(*[value(c) for c in columns], *[c for c in source.columns if c not in columns])


def insert_absent(target: DataFrame, source: DataFrame, keys: Sequence[str], **options: Any) -> DataFrame:
    return merge_into(target, source, keys, mode="insert", **options)


def copy_rows(df: DataFrame, key: str, source_value: Any, target_value: Any, identity: Sequence[str], new_id: Callable[[], Column] | None = None, id_col: str = "id") -> DataFrame:
    """`df` plus copies of the rows of one key under another key, skipping those already there."""
    if source_value == target_value:
        raise ValueError("source and target must differ")
    present = df.filter(F.col(key) == target_value).select(*[F.col(c).alias(f"__p_{c}") for c in identity]).distinct()
    copies = df.filter(F.col(key) == source_value).withColumn(key, F.lit(target_value).cast(df.schema[key].dataType))
    condition = F.lit(True)
    for c in identity:
        condition = condition & F.col(c).eqNullSafe(F.col(f"__p_{c}"))
    copies = copies.join(present, condition, "left_anti")
    if new_id is not None:
        copies = copies.withColumn(id_col, new_id())
    return df.withColumn(ACTION, F.lit("keep")).unionByName(copies.withColumn(ACTION, F.lit("insert")))


def merge_stats(merged: DataFrame) -> DataFrame:
    """Row counts by action, one row, zero where an action did not occur."""
    return merged.agg(
        F.count(F.lit(1)).alias("rows"),
        *[F.count_if(col(ACTION) == a).alias(n) for a, n in (("insert", "inserted"), ("update", "updated"), ("keep", "kept"))],
    )
