"""Bring a table to a target schema: add, widen, drop, and report the difference."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclass(frozen=True)
class SchemaChange:
    column: str
    action: str  # add, cast, drop
    before: str | None
    after: str | None


def schema_changes(have: T.StructType, want: T.StructType, drop: Sequence[str] = ()) -> list[SchemaChange]:
    """What `align_schema` would do; metadata only, so it doubles as the dry run."""
    types = {f.name: f.dataType.simpleString() for f in have.fields}
    changes = []
    for field in want.fields:
        target = field.dataType.simpleString()
        if field.name not in types:
            changes.append(SchemaChange(field.name, "add", None, target))
        elif types[field.name] != target:
            changes.append(SchemaChange(field.name, "cast", types[field.name], target))
    changes += [SchemaChange(c, "drop", types[c], None) for c in drop if c in types]
    return changes


def align_schema(
    df: DataFrame,
    want: T.StructType,
    defaults: Mapping[str, Column] | None = None,
    drop: Sequence[str] = (),
) -> tuple[DataFrame, list[SchemaChange]]:
    """Wanted columns first and in order, then the columns the schema does not know.

    A cast that fails for a value gives NULL; check with ``profile.rejects`` beforehand.
    """
    defaults = dict(defaults or {})
    changes = schema_changes(df.schema, want, drop)
    columns, have = [], df.columns
    for field in want.fields:
        if field.name not in have:
            value = defaults.get(field.name, F.lit(None)).cast(field.dataType)
        elif df.schema[field.name].dataType == field.dataType:
            value = F.col(field.name)
        else:
            value = F.col(field.name).try_cast(field.dataType)
        columns.append(value.alias(field.name))
    known = {f.name for f in want.fields} | set(drop)
    columns += [F.col(c) for c in have if c not in known]
    return df.select(*columns), changes
