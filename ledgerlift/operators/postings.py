"""Search for a piece of text through a table of three-character pieces, without a scan of the texts.

Every text is taken in lower case with two end marks behind it and filed under each run of three
characters that it holds.  Rows that hold a pattern hold all of its runs; a pattern of one or two
characters is the start of some run.  Rows found that way are verified on the text itself.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlift.functions.predicates import search

END = "\u0000\u0000"
#: Ids up to which found rows are named one by one, so that the scan skips what can't hold them.
FEW = 1000


def _runs(text: Column) -> Column:
    padded = F.concat(F.lower(text), F.lit(END))
    return F.when(F.length(text) > 0, F.array_distinct(F.transform(F.sequence(F.lit(1), F.length(padded) - 2), lambda i: F.substring(padded, i, F.lit(3)))))


def postings(df: DataFrame, id_col: str, columns: Sequence[str]) -> DataFrame:
    """(field, run, id): one row for each run of each text; to be stored sorted by field and run.

    Null texts and rows without an id are not filed.
    """
    texts = F.array(*[F.struct(F.lit(c).alias("field"), F.col(f"`{c}`").cast("string").alias("text")) for c in columns])
    rows = df.where(F.col(f"`{id_col}`").isNotNull()).select(F.col(f"`{id_col}`").alias("id"), F.explode(texts).alias("t")).where("t.text is not null")
    return rows.select("t.field", F.explode(_runs(F.col("t.text"))).alias("run"), "id")


def stored(index: DataFrame, path: str) -> DataFrame:
    """`index` as Parquet in order of field and run, so that a search reads only the pages of its runs."""
    index.repartitionByRange("field", "run", "id").sortWithinPartitions("field", "run", "id").write.parquet(path)
    return index.sparkSession.read.schema(index.schema).parquet(path)


def candidates(index: DataFrame, **contains: str | None) -> DataFrame | None:
    """(id) of the rows that may hold all patterns; None if no pattern restricts anything."""
    found = None
    for field, needle in contains.items():
        pattern = (needle or "").strip().lower()
        if not pattern:
            continue
        mine = index.where(F.col("field") == field)
        if len(pattern) < 3:
            ids = mine.where(F.col("run").startswith(pattern)).select("id").distinct()
        else:
            runs = sorted({pattern[i : i + 3] for i in range(len(pattern) - 2)})
            ids = mine.where(F.col("run").isin(runs)).groupBy("id").agg(F.countDistinct("run").alias("n")).where(F.col("n") == len(runs)).select("id")
        found = ids if found is None else found.join(ids, "id", "left_semi")
    return found


def search_indexed(df: DataFrame, index: DataFrame, id_col: str, **contains: str | None) -> DataFrame:
    """`predicates.search` by way of the index: the same rows, of which only candidates are verified.

    Rows without an id can't be found through an index and are scanned for.
    """
    found = candidates(index, **contains)
    if found is None:
        return df
    key = F.col(f"`{id_col}`")
    few = [r["id"] for r in found.limit(FEW + 1).collect()]
    if len(few) <= FEW:
        rows = df.where(key.isin(few) | key.isNull())
    else:
        rows = df.join(found.withColumnRenamed("id", "__id"), key == F.col("__id"), "left_semi").unionByName(df.where(key.isNull()))
    return search(rows, **contains)
