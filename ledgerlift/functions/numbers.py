"""Numbers that arrive as text: `462.0`, `1.55e+12`, `12 MW`."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlift.functions.text import ColumnOrName, col, strip

#: Wide enough for 13-digit ids and money, and exact, unlike a double.
EXACT = T.DecimalType(38, 6)


def exact(c: ColumnOrName) -> Column:
    return strip(c).try_cast(EXACT)


def whole_number(c: ColumnOrName) -> Column:
    """BIGINT with the fraction dropped; NULL when the text is no number."""
    return exact(c).try_cast("bigint")


def int_text(c: ColumnOrName, on_fail: str = "keep") -> Column:
    """Integer text without exponent or `.0`.

    ``keep``: anything that is not a whole number stays as it is.
    ``null``: text that is no number becomes NULL, a fraction is dropped.
    ``truncate``: a fraction is dropped, text that is no number stays.
    """
    number, text = exact(c), strip(c)
    whole = number.try_cast("bigint")
    if on_fail == "keep":
        return F.coalesce(F.when(number == whole, whole.cast("string")), text)
    if on_fail == "null":
        return whole.cast("string")
    if on_fail == "truncate":
        return F.coalesce(whole.cast("string"), text)
    raise ValueError(f"unknown on_fail: {on_fail}")


def cast_or(c: ColumnOrName, to: T.DataType | str, default: str | None = None, pattern: str | None = None) -> Column:
    """Guarded cast: where `pattern` does not match or the cast fails, the default."""
    text = F.trim(col(c))
    guarded = text if pattern is None else F.when(text.rlike(pattern), text)
    target = to if isinstance(to, T.DataType) else T._parse_datatype_string(to)
    if isinstance(target, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        value = guarded.try_cast(EXACT).try_cast(target)
    else:
        value = guarded.try_cast(target)
    return value if default is None else F.coalesce(value, F.lit(default).cast(target))
