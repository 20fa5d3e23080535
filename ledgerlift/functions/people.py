"""Names and contact data buried in free text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerlift.functions import fixed_values as fixed
from ledgerlift.functions.text import ColumnOrName, col, strip


def split_name(c: ColumnOrName) -> tuple[Column, Column, Column]:
    """(first, middle, last): one word has neither middle nor last name, two have no middle."""
    tokens = F.split(F.nullif(strip(c), F.lit("")), r"\s+")
    size = F.size(tokens)
    first = F.get(tokens, F.lit(0))
    middle = F.when(size > 2, F.array_join(F.slice(tokens, F.lit(2), F.greatest(size - 2, F.lit(0))), " "))
    last = F.when(size > 1, F.get(tokens, size - 1))
    return first, middle, last


def phone_in(c: ColumnOrName) -> Column:
    """First phone number in the text, blanks removed."""
    text = col(c)
    # Every match holds one of these, and looking for them is far cheaper than the pattern.
    possible = text.contains("255") | text.contains("06") | text.contains("07")
    found = F.when(possible, F.regexp_extract(text, fixed.PHONE, 1))
    return F.nullif(F.regexp_replace(found, r"\s", ""), F.lit(""))


def email_in(c: ColumnOrName) -> Column:
    text = col(c)
    return F.nullif(F.when(text.contains("@"), F.regexp_extract(text, fixed.EMAIL, 1)), F.lit(""))


def bare_name(c: ColumnOrName) -> Column:
    """Text before the first `|`; without one, before the first `,`."""
    text = col(c)
    head = F.when(text.contains("|"), F.split_part(text, F.lit("|"), F.lit(1))).otherwise(
        F.split_part(text, F.lit(","), F.lit(1))
    )
    return F.nullif(F.trim(head), F.lit(""))


def has_separator(c: ColumnOrName) -> Column:
    return F.coalesce(col(c).rlike("[|,]"), F.lit(False))
