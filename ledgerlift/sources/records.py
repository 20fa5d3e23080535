"""Records of delimited text, cut in parallel although a quoted cell may hold line breaks.

Whether a line break ends a record depends on the quotes of everything before it.  A line either starts
at the start of a cell or inside a quoted one, so all that a line does to its successors is one of four
maps of these two states: it may keep the state, swap it, or set it to one or the other.  Maps compose,
so a first pass finds the map of each block, and a scan over the blocks of a file the state before each.
A second pass cuts the blocks into records where they are read.  Only a map a block is shuffled, and the
parts of the records that lie in several blocks.

Quotes are read as Python's csv module reads them: a quote opens a cell only at its start, two of them
inside stand for one, and what follows a closing quote belongs to the cell as it is.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerlift.session import written

#: Place of a record in its source.
ROW = "_row"
#: Blocks up to which their states are broadcast (some 200 bytes each).
FEW = 50_000


def read_lines(spark: SparkSession, path: str | Sequence[str], **options: str) -> DataFrame:
    """(file, block, at, value): the lines of text files; `at` grows within a block."""
    return placed_lines(spark.read.options(**options | {"lineSep": "\n"}).text([path] if isinstance(path, str) else list(path)))


def placed_lines(lines: DataFrame) -> DataFrame:
    """`lines` straight from a text source, with their place."""
    at = {"file": "_metadata.file_path", "block": "_metadata.file_block_start"}
    return lines.select(*[F.col(c).alias(n) for n, c in at.items()], F.monotonically_increasing_id().alias("at"), "value")


def _cell(sep: str) -> tuple[str, str]:
    """Patterns of a cell that ends in its line, and of one that need not end at all.  Both match without backtracking."""
    s = re.escape(sep)
    quoted, plain = r'"[^"]*+(?:""[^"]*+)*+', rf'[^"{s}][^{s}]*+|'
    return rf'(?:{quoted}"[^{s}]*+|{plain})', rf'(?:{quoted}(?:"[^{s}]*+|\z)|{plain})'


def _ends_inside(value: Column, inside: bool, sep: str) -> Column:
    """Whether a cell is open at the end of a line, if the line starts inside a cell or not."""
    s, (cell, _) = re.escape(sep), _cell(sep)
    first = rf'[^"]*+(?:""[^"]*+)*+"[^{s}]*+' if inside else cell
    return ~F.rlike(value, F.lit(rf"\A{first}(?:{s}{cell})*+\z"))


def survey(lines: DataFrame, sep: str = ",") -> tuple[bool, int]:
    """Whether a line leaves a cell open, and the most cells up to a filled one: one pass.

    If no line does, lines are records and the width is theirs.
    """
    opens = F.when(F.instr("value", '"') > 0, _ends_inside(F.col("value"), False, sep)).otherwise(F.lit(False))
    found = lines.select(opens.alias("opens"), filled(cells(_trimmed(F.col("value")), sep)).alias("width"))
    row = found.agg(F.coalesce(F.max("opens"), F.lit(False)).alias("opens"), F.coalesce(F.max("width"), F.lit(0)).alias("width")).first()
    return row["opens"], row["width"]


def filled(found: Column) -> Column:
    """The number of the last cell with a value."""
    at = F.transform(found, lambda c, i: F.when(c.isNotNull(), i + 1).otherwise(F.lit(0)))
    return F.coalesce(F.array_max(at), F.lit(0))


def _after(f: np.ndarray, q: np.ndarray, entry: bool) -> np.ndarray:
    """The state after each line that leaves f from outside and q from inside, if the first starts in `entry`."""
    swaps = np.cumsum(f & ~q)
    last = np.maximum.accumulate(np.where(f == q, np.arange(len(f)), -1))
    # From the last line that set the state on, only the later swaps count.
    since, start = np.where(last < 0, 0, swaps[last]), np.where(last < 0, entry, f[last])
    return start ^ ((swaps - since) % 2 == 1)


def _runs(batch: pa.RecordBatch) -> Iterator[tuple[tuple[str, int], pa.RecordBatch]]:
    """The stretches of a batch that lie in one block, by (file, block)."""
    blocks = batch.column("block").to_numpy()
    cuts = np.flatnonzero((blocks[1:] != blocks[:-1]) | np.asarray(pc.not_equal(batch.column("file")[1:], batch.column("file")[:-1]))) + 1
    for low, high in zip([0, *cuts], [*cuts, len(blocks)]):
        if high > low:
            yield (batch.column("file")[low].as_py(), int(blocks[low])), batch.slice(low, high - low)


def _flags(lines: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    return tuple(lines.column(c).to_numpy(zero_copy_only=False) for c in "fq")


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(file, block, f, q): what each block does to the state; a task has all lines of its blocks, in order."""
    found: dict[tuple[str, int], tuple[bool, bool]] = {}
    for batch in batches:
        for key, lines in _runs(batch):
            f, q = found.get(key, (False, True))
            flags = _flags(lines)
            found[key] = (bool(_after(*flags, f)[-1]), bool(_after(*flags, q)[-1]))
    rows = [[*key, *maps] for key, maps in found.items()]
    if rows:
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], names=["file", "block", "f", "q"])


_PART = pa.schema([("file", pa.string()), ("block", pa.int64()), ("at", pa.int64()), ("value", pa.string()), ("part", pa.bool_()), ("starts", pa.bool_())])


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The records of each block, and as parts what its first and last one share with other blocks."""
    # The record that is open where a batch or a block ends: its first place, whether it started in the block, its lines.
    key, at, starts, open_ = None, 0, True, []
    inside = False

    def part() -> Iterator[pa.RecordBatch]:
        if open_:
            yield pa.RecordBatch.from_pylist([{"file": key[0], "block": key[1], "at": at, "value": "\n".join(open_), "part": True, "starts": starts}], _PART)

    for batch in batches:
        for now, lines in _runs(batch):
            if now != key:
                yield from part()
                key, open_, inside = now, [], lines.column("entry")[0].as_py()
            after = _after(*_flags(lines), inside)
            before = np.concatenate([[inside], after[:-1]])
            inside = bool(after[-1])
            places, values = lines.column("at").to_numpy(), lines.column("value")
            alone = np.flatnonzero(~before & ~after)
            whole = [(places[alone], values.take(pa.array(alone)))]
            several, texts = [], []
            # Stretches of lines with an open cell at their start or end.
            for low, high in _stretches(before, after):
                if not open_:
                    at, starts = int(places[low]), not before[low]
                open_ += values[low:high].to_pylist()
                if not after[high - 1]:
                    if starts:
                        several.append(at)
                        texts.append("\n".join(open_))
                    else:
                        yield from part()
                    open_ = []
            whole.append((np.array(several, "int64"), pa.array(texts, pa.string())))
            for ats, found in whole:
                if len(ats):
                    n = len(ats)
                    yield pa.RecordBatch.from_arrays([pa.repeat(key[0], n), pa.repeat(pa.scalar(key[1], pa.int64()), n), pa.array(ats), found.cast(pa.string()), pa.repeat(False, n), pa.repeat(True, n)], schema=_PART)
    yield from part()


def _stretches(before: np.ndarray, after: np.ndarray) -> list[tuple[int, int]]:
    """(first, end) of the lines that share a record with others."""
    shared = before | after
    firsts = np.flatnonzero(shared & (~before | np.concatenate([[True], ~shared[:-1]])))
    ends = np.flatnonzero(shared & (~after | np.concatenate([~shared[1:], [True]]))) + 1
    return list(zip(firsts.tolist(), ends.tolist()))


def _joined(lines: DataFrame, sep: str) -> DataFrame:
    """(_row, value): the records of lines of which some leave a cell open."""
    value = F.col("value")
    turns = F.instr(value, '"') > 0
    # f, q: the state after the line, from outside and from inside; a line without quotes keeps either.
    f = F.when(turns, _ends_inside(value, False, sep)).otherwise(F.lit(False)).alias("f")
    q = F.when(turns, _ends_inside(value, True, sep)).otherwise(F.lit(True)).alias("q")
    blocks = written(lines.select("file", "block", f, q).mapInArrow(_blocks, "file string, block bigint, f boolean, q boolean"), "blocks")
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    odd = lambda n: n % 2 == 1
    swaps = F.coalesce(F.sum((F.col("f") & ~F.col("q")).cast("int")).over(earlier), F.lit(0))
    counted = blocks.withColumn("n", swaps).withColumn("set", F.last(F.when(F.col("f") == F.col("q"), F.struct(F.col("f").alias("to"), "n")), ignorenulls=True).over(earlier))
    entry = F.when(F.col("set").isNull(), odd(F.col("n"))).otherwise(F.col("set.to") != odd(F.col("n") - F.col("set.n")))
    entries = counted.select("file", "block", entry.alias("entry"))
    flagged = lines.select("file", "block", "at", "value", f, q)
    if blocks.limit(FEW + 1).count() <= FEW:
        # One short row a block goes to the lines, which stay where they are read.
        told = flagged.join(F.broadcast(entries), ["file", "block"])
    else:
        told = flagged.join(entries, ["file", "block"]).repartition("file", "block").sortWithinPartitions("file", "block", "at")
    cut = written(told.mapInArrow(_cut, "file string, block bigint, at bigint, value string, part boolean, starts boolean"), "records")
    place = F.struct("file", "block", "at")
    # A block has two parts at most; those of one record follow one another.
    in_file = Window.partitionBy("file").orderBy("block", "at")
    parts = cut.where("part").withColumn("record", F.count_if("starts").over(in_file))
    whole = parts.groupBy("file", "record").agg(F.sort_array(F.collect_list(F.struct(place.alias(ROW), "value"))).alias("parts"))
    joined = whole.select(F.col("parts")[0][ROW].alias(ROW), F.array_join(F.transform("parts", lambda p: p["value"]), "\n").alias("value"))
    return cut.where("not part").select(place.alias(ROW), "value").unionByName(joined)


def _trimmed(value: Column) -> Column:
    """Without the carriage return at a record's end."""
    return F.regexp_replace(value, r"\r\z", "")


def records(lines: DataFrame, sep: str = ",", opens: bool | None = None) -> DataFrame:
    """(_row, value): the records of `lines` (file, block, at, value), without blank ones.

    Line breaks inside quotes are kept, a carriage return at a record's end is not.  A quote that stays
    open ends with its file.  `_row` is the place of the first line and orders records as they stand.
    `opens` says whether any line leaves a cell open; if the caller does not know, one pass finds out.
    """
    if opens is None:
        opens = survey(lines, sep)[0]
    whole = _joined(lines, sep) if opens else lines.select(F.struct("file", "block", "at").alias(ROW), "value")
    return whole.select(ROW, _trimmed(F.col("value")).alias("value")).where(F.length(F.trim("value")) > 0)


def cells(value: Column, sep: str = ",") -> Column:
    """The cells of a record; an empty one is NULL, an empty quoted one is empty."""
    s, (_, cell) = re.escape(sep), _cell(sep)
    # A separator in front lets every match take one, the first included.
    found = F.regexp_extract_all(F.concat(F.lit(sep), value), F.lit(rf"\G{s}({cell})"), F.lit(1))
    pair = r'(?s)\A"([^"]*+(?:""[^"]*+)*+)"?(.*)\z'
    text = lambda c: F.concat(F.replace(F.regexp_extract(c, pair, 1), F.lit('""'), F.lit('"')), F.regexp_extract(c, pair, 2))
    return F.transform(found, lambda c: F.when(c == "", F.lit(None)).when(c.startswith('"'), text(c)).otherwise(c))
