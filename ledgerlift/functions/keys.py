"""Keys derived from content, so that a rerun or a retried task yields the same row."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerlift.functions.text import ColumnOrName, col


def as_uuid(digest: Column) -> Column:
    return F.regexp_replace(digest, "^(.{8})(.{4})(.{4})(.{4})(.{12})$", "$1-$2-$3-$4-$5")


def stable_key(*parts: ColumnOrName, sep: str = "|") -> Column:
    """`md5` of the parts joined by `sep`, in 8-4-4-4-12 form; a missing part counts as empty.

    Pass constant parts as ``F.lit(...)``.
    """
    return as_uuid(F.md5(F.concat_ws(sep, *[F.coalesce(col(p).cast("string"), F.lit("")) for p in parts])))
