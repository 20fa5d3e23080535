"""Row predicates shared by the plans."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlift.functions import fixed_values as fixed
from ledgerlift.functions.text import ColumnOrName, blank_to_null, col


def any_present(*columns: ColumnOrName) -> Column:
    """At least one column holds more than blanks."""
    return F.coalesce(*[blank_to_null(c) for c in columns]).isNotNull()


def all_present(*columns: ColumnOrName) -> Column:
    return reduce(lambda a, b: a & b, [blank_to_null(c).isNotNull() for c in columns])


def changed(pairs: list[tuple[ColumnOrName, ColumnOrName]]) -> Column:
    """At least one pair differs, NULL counting as a value."""
    return reduce(lambda a, b: a | b, [~col(a).eqNullSafe(col(b)) for a, b in pairs])


def is_live(deleted_at: ColumnOrName, as_of: ColumnOrName | None = None) -> Column:
    """Not soft-deleted; with `as_of`, a deletion date still in the future counts as live."""
    deleted = col(deleted_at)
    return deleted.isNull() if as_of is None else deleted.isNull() | (deleted > col(as_of))


def search(df: DataFrame, **contains: str | None) -> DataFrame:
    """Case-insensitive `contains` filters; a parameter that is None or blank filters nothing."""
    for name, needle in contains.items():
        if needle and needle.strip():
            df = df.filter(F.lower(F.col(name)).contains(needle.strip().lower()))
    return df


def looks_like(c: ColumnOrName, shape: str) -> Column:
    """Shape test by name: uuid, digits, decimal, phone, email, long_id."""
    pattern = {
        "uuid": fixed.UUID_SHAPE,
        "digits": fixed.DIGITS,
        "decimal": fixed.UNSIGNED_DECIMAL,
        "phone": fixed.PHONE,
        "email": fixed.EMAIL,
        "long_id": fixed.LONG_NUMERIC_ID,
    }[shape]
    return F.coalesce(col(c).rlike(pattern), F.lit(False))
