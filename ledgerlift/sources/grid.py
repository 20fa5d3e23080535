"""Raw spreadsheet grids: find the header, promote it, map aliases, number the rows."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F

from ledgerlift.functions import fixed_values as fixed
from ledgerlift.functions.text import strip
from ledgerlift.sources.records import ROW, cells, filled, read_lines, records, survey


class GridTooNarrow(ValueError):
    pass


class HeadersDiffer(ValueError):
    pass


def read_csv(spark: SparkSession, path: str | Sequence[str], sep: str = ",") -> DataFrame:
    """CSV whose first record is the header: every column a string, headers normalised.

    Quoted cells may hold line breaks; files are read in parallel all the same.  All files have the
    same header.
    """
    rows = records(read_lines(spark, path), sep)
    heads = rows.groupBy(F.col(f"{ROW}.file").alias("__file")).agg(F.min(ROW).alias("__head"), F.min_by("value", ROW).alias("__value"))
    headers = heads.select("__value").distinct().select(cells(F.col("__value"), sep).alias("names")).limit(2).collect()
    if not headers:
        return spark.sql("SELECT 1").select().limit(0)
    if len(headers) > 1:
        raise HeadersDiffer(f"{path}: {headers[0]['names']} and {headers[1]['names']}")
    names = [n if n is not None and n.strip() else f"unnamed:_{i}" for i, n in enumerate(headers[0]["names"])]
    below = rows.join(F.broadcast(heads.select("__file", "__head")), F.col(f"{ROW}.file") == F.col("__file")).where(F.col(ROW) > F.col("__head"))
    parsed = below.select(cells(F.col("value"), sep).alias("__cells"))
    return parsed.select(*[F.get("__cells", F.lit(i)).alias(n) for i, n in enumerate(_distinct([header_name(n) for n in names]))])


def read_grid(spark: SparkSession, path: str | Sequence[str], width: int | None = None, sep: str = ",") -> DataFrame:
    """CSV without a known header as ``_row`` plus string cells ``c0..cN``.

    The width is that of the longest row with a value at its end; if the caller gives one, a row
    with values beyond it is an error.  One pass finds the width; a second one is needed only where
    a quoted cell goes on in the next line.
    """
    lines = read_lines(spark, path)
    opens, needed = survey(lines, sep)
    rows = records(lines, sep, opens).select(ROW, cells(F.col("value"), sep).alias("__cells"))
    if opens:
        needed = rows.agg(F.max(filled(F.col("__cells")))).first()[0] or 0
    if width is not None and needed > width:
        raise GridTooNarrow(f"a row has values in {needed} cells, beyond the width of {width}")
    return rows.select(ROW, *[F.get("__cells", F.lit(i)).alias(f"c{i}") for i in range(max(1, needed) if width is None else width)])


def with_position(df: DataFrame, name: str = ROW) -> DataFrame:
    """Add the place of each row in its source: file, position in it; it orders rows as they stand.

    Unlike a running number it needs neither a count of the earlier files nor a shuffle, and a
    retried task finds the same places again.
    """
    columns = [c for c in df.columns if c != "_metadata"]
    at = {"file": F.col("_metadata.file_path"), "block": F.col("_metadata.row_index"), "at": F.lit(0).cast("bigint")}
    running = F.monotonically_increasing_id()
    for place in (at, at | {"block": F.col("_metadata.file_block_start"), "at": running}, {"file": F.lit(""), "block": F.lit(0).cast("bigint"), "at": running}):
        try:
            return df.select(F.struct(*[v.alias(k) for k, v in place.items()]).alias(name), *columns)
        except AnalysisException:
            continue
    raise AssertionError


def number_rows(df: DataFrame, start: int = 1, name: str = ROW) -> DataFrame:
    """Add the position of each row in its source, counted across files in path order.

    `df` must come straight from a file source.  Where the reader knows the position inside
    the file (Parquet) it is used.  Otherwise rows are counted per file block: the running id
    a task hands out is dense within a block, and block offsets come from one small
    aggregation.  Both survive a retried task, unlike a bare running id.

    Imports order rows by `with_position` and don't need a dense number; this is for a caller who
    does.  The offsets, one short row per file or block, come from two levels of prefix sums: inside a
    group of files that follow one another, and over the groups, so that no task sees all of them.
    """
    try:
        positioned = df.select("*", F.col("_metadata.file_path").alias("__file"), F.lit(0).cast("bigint").alias("__block"), F.col("_metadata.row_index").alias("__id"))
        per_block = positioned.groupBy("__file", "__block").agg(F.count(F.lit(1)).alias("__n"), F.lit(0).cast("bigint").alias("__first"))
    except AnalysisException:
        block = [F.col("_metadata.file_path").alias("__file"), F.col("_metadata.file_block_start").alias("__block")]
        positioned = df.select("*", *block, F.monotonically_increasing_id().alias("__id"))
        per_block = positioned.groupBy("__file", "__block").agg(F.count(F.lit(1)).alias("__n"), F.min("__id").alias("__first"))
    offsets = _offsets(per_block, df.inputFiles()).select("__file", "__block", "__first", "__offset")
    # One short row a file or block goes to the rows: dealt by file, all rows of a large file would meet in one task.
    joined = positioned.join(F.broadcast(offsets), ["__file", "__block"], "left")
    return joined.select((F.col("__offset") + F.col("__id") - F.col("__first") + start).cast("bigint").alias(name), *df.columns)


#: Groups of files, in path order, whose rows are summed first.
_GROUPS = 64


def _offsets(per_block: DataFrame, files: Sequence[str]) -> DataFrame:
    """Adds ``__offset``, the rows in all earlier files and blocks."""
    ordered = sorted(files)
    starts = ordered[:: max(1, -(-len(ordered) // _GROUPS))][1:]
    # The number of groups that start at or before a file; any starts will do, as long as they ascend.
    group = F.size(F.filter(F.array(*map(F.lit, starts)).cast("array<string>"), lambda s: s <= F.col("__file")))
    grouped = per_block.withColumn("__group", group)
    totals = grouped.groupBy("__group").agg(F.sum("__n").alias("__total"))
    later = F.explode(F.sequence(F.col("__group") + 1, F.lit(len(starts) + 1)))
    bases = totals.select(later.alias("__group"), "__total").groupBy("__group").agg(F.sum("__total").alias("__base"))
    within = Window.partitionBy("__group").orderBy("__file", "__block").rowsBetween(Window.unboundedPreceding, -1)
    placed = grouped.withColumn("__within", F.coalesce(F.sum("__n").over(within), F.lit(0))).join(bases, "__group", "left")
    return placed.withColumn("__offset", F.col("__within") + F.coalesce("__base", F.lit(0)))


def header_name(text: str) -> str:
    return str(text).strip().lower().replace(" ", "_").replace("/", "_")


def normalise_headers(df: DataFrame) -> DataFrame:
    return df.toDF(*_distinct([header_name(c) for c in df.columns]))


def _distinct(names: Sequence[str]) -> list[str]:
    seen: dict[str, int] = {}
    out = []
    for name in names:
        seen[name] = seen.get(name, 0) + 1
        out.append(name if seen[name] == 1 else f"{name}.{seen[name] - 1}")
    return out


def find_header(grid: DataFrame, anchors: Sequence[str] = fixed.HEADER_ANCHORS) -> int | Row | None:
    """Place of the header row: the first with an anchor cell, else the first with any value.

    Two minima in one pass; a single row reaches the driver.
    """
    cells = [strip(c) for c in grid.columns if c != ROW]
    values = F.array(*[F.lower(c) for c in cells])
    anchored = F.coalesce(F.arrays_overlap(values, F.array(*[F.lit(a) for a in anchors])), F.lit(False))
    filled = F.coalesce(*[F.nullif(c, F.lit("")) for c in cells]).isNotNull()
    found = grid.agg(F.min(F.when(anchored, F.col(ROW))).alias("anchor"), F.min(F.when(filled, F.col(ROW))).alias("any")).first()
    return found["anchor"] if found["anchor"] is not None else found["any"]


def promote_header(grid: DataFrame, anchors: Sequence[str] = fixed.HEADER_ANCHORS) -> DataFrame:
    """The rows below the header under its normalised names; ``_row`` is kept.

    Columns without a header text are named by position, as a spreadsheet reader does.
    """
    row = find_header(grid, anchors)
    if row is None:
        return grid.limit(0)
    row = F.struct(*[F.lit(v).alias(k) for k, v in row.asDict().items()]) if isinstance(row, Row) else F.lit(row)
    cells = [c for c in grid.columns if c != ROW]
    texts = grid.filter(F.col(ROW) == row).select(*cells).first()
    names = _distinct([header_name(t) if t is not None and t.strip() else f"unnamed:_{i}" for i, t in enumerate(texts)])
    below = grid.filter(F.col(ROW) > row)
    return below.select(ROW, *[F.col(c).alias(n) for c, n in zip(cells, names)])


class MissingColumns(ValueError):
    pass


def require(df: DataFrame, required: Sequence[str], optional: Sequence[str] = ()) -> DataFrame:
    """Fail with the sorted missing columns; add absent optional ones as NULL."""
    missing = sorted(set(required) - set(df.columns))
    if missing:
        raise MissingColumns(f"missing required columns: {missing}")
    have = set(df.columns)
    absent = [c for c in optional if c not in have]
    return df.select("*", *[F.lit(None).cast("string").alias(c) for c in absent])


def apply_aliases(df: DataFrame, aliases: Mapping[str, str], keep: Sequence[str] = (ROW,)) -> DataFrame:
    """Project source columns to canonical ones; the first alias present wins, absent ones give NULL."""
    names = df.columns
    have = {header_name(c): c for c in names}
    chosen: dict[str, str | None] = {}
    for source, target in aliases.items():
        if chosen.get(target) is None:
            chosen[target] = have.get(source)
    columns = [F.col(c) for c in keep if c in names]
    for target, source in chosen.items():
        value = F.lit(None) if source is None else F.col(f"`{source}`")
        columns.append(value.cast("string").alias(target))
    return df.select(*columns)


def rename_aliases(df: DataFrame, aliases: Mapping[str, str]) -> DataFrame:
    """Rename alias headers in place, leaving other columns alone; an existing canonical column wins."""
    taken = set(df.columns)
    columns = []
    for name in df.columns:
        target = aliases.get(name, name)
        if target != name and target in taken:
            continue
        taken.add(target)
        columns.append(F.col(f"`{name}`").alias(re.sub(r"`", "", target)))
    return df.select(*columns)
