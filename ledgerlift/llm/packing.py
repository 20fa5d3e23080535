"""Best-fit packing of documents into sequences of fixed length, under conflicts.

Documents longer than a sequence are cut; whole sequences stand alone, the rest competes for space.
Rows are dealt to shards of bounded size; a shard packs its pieces in descending order of length.
Its open bins are kept ordered by what is left in them, and carry bitmaps of the sources and of the
duplicate clusters they hold.  With `per_source` above 1 a source conflicts once it is in that many.  The search starts at the first bin with enough room and goes on to
its successors until one has no conflict: that is the tightest compatible bin.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections import Counter
from collections.abc import Iterable

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from ledgerlift.llm import simhash
from ledgerlift.llm.common import WORD_PATTERN, row_hash, word_count, written
from ledgerlift.llm.graph import components

CAPACITY = 2048
#: Pieces of one source that a bin may hold.  With one, a source of a third of all documents leaves
#: almost half of the space empty.
PER_SOURCE = 4
#: Near-duplicates, as in the pipeline's dedup: words of a shingle, bits that fingerprints may differ in.
SHINGLE, MAX_BITS = 3, 3
#: Rows that are packed together; the loss against packing all at once is a few open bins a shard.
SHARD_ROWS = 8192


def best_fit(items: Iterable[tuple], capacity: int, per_source: int = 1) -> list[tuple[int, int]]:
    """(bin, offset) of each item (size, source, cluster...), in the order given; sizes are in 1..capacity.

    An item may have several clusters, each of a kind of its own.  No two items of a bin share a
    cluster of a kind, and no more than `per_source` a source; None is in conflict with nothing.  A bin has a bitmap of sources for each further item of a source that it may take.
    """
    items = list(items)
    bit = lambda values: {v: 1 << i for i, v in enumerate(v for v, n in Counter(values).items() if n > 1)}
    source_bits = bit(x[1] for x in items if x[1] is not None)
    cluster_bits = bit(x for item in items for x in enumerate(item[2:]) if x[1] is not None)
    open_: list[tuple[int, int]] = []  # (room left, bin), ascending
    sources: list[list[int]] = []
    clusters: list[int] = []
    placed = []
    for size, source, *kinds in items:
        s, c = source_bits.get(source, 0), 0
        for x in enumerate(kinds):
            c |= cluster_bits.get(x, 0)
        for at in range(bisect_left(open_, (size, -1)), len(open_)):
            room, number = open_[at]
            if not (sources[number][-1] & s or clusters[number] & c):
                del open_[at]
                break
        else:
            room, number = capacity, len(sources)
            sources.append([0] * per_source)
            clusters.append(0)
        placed.append((number, capacity - room))
        held = sources[number]
        held[next((i for i, bits in enumerate(held) if not bits & s), -1)] |= s
        clusters[number] |= c
        if room > size:
            insort(open_, (room - size, number))
    return placed


def _shard(capacity: int, per_source: int):
    def run(rows: pa.Table) -> pa.Table:
        sizes, sources, clusters, documents, h, copies = (rows.column(c).to_pylist() for c in ("size_", "source", "cluster", "document", "h", "copy"))
        at, piece, length, number, offset = [], [], [], [], []

        def put(row: int, k: int, n: int, bin_: int, start: int) -> None:
            for column, value in ((at, row), (piece, k), (length, n), (number, bin_), (offset, start)):
                column.append(value)

        bins = 0
        for row, size in enumerate(sizes):
            for k in range(size // capacity):
                put(row, k, capacity, bins, 0)
                bins += 1
        rests = sorted((i for i, n in enumerate(sizes) if n % capacity), key=lambda i: (-(sizes[i] % capacity), h[i], copies[i]))
        found = best_fit([(sizes[i] % capacity, sources[i], clusters[i], documents[i]) for i in rests], capacity, per_source)
        for row, (bin_, start) in zip(rests, found):
            put(row, sizes[row] // capacity, sizes[row] % capacity, bins + bin_, start)
        base = (rows.column("shard")[0].as_py() << 32) if len(sizes) else 0
        made = [pa.array(x, pa.int64()) for x in (piece, [k * capacity for k in piece], length, [base + x for x in number], offset)]
        picked = rows.select(["id", "h", "copy"]).take(pa.array(at, pa.int64()))
        return pa.table([*picked.columns, *made], names=["id", "h", "copy", "piece", "first", "n", "bin", "offset"])

    return run


def packed(
    df: DataFrame, size: Column, code: Column, id_col: str = "doc_id", source_col: str = "source", capacity: int = CAPACITY, per_source: int = PER_SOURCE, apart: bool = False
) -> DataFrame:
    """A row for each piece of each row of `df`: (id, h, copy, piece, first, n, bin_id, offset).

    ``first`` and ``n`` say which part of the document the piece is, ``offset`` where it stands in its
    bin.  h identifies the row by all its columns; equal rows differ by ``copy``.  A row of size 0 or
    null takes no space: one piece of length 0 without a bin.  Rows whose fingerprints (`code`) are in one
    near-duplicate component share no bin; with `apart`, neither do rows of one id.  Null sources and ids
    conflict with nothing.  An empty table gives an empty result.
    """
    kind = df.schema[id_col].dataType.simpleString()
    rows = df.select(
        F.col(f"`{id_col}`").alias("id"),
        row_hash(df).alias("h"),
        F.col(f"`{source_col}`").cast("string").alias("source"),
        code.cast("long").alias("fp"),
        F.coalesce(size, F.lit(0)).cast("long").alias("size_"),
    )
    rows = written(rows.groupBy("id", "h").agg(*[F.first(c).alias(c) for c in ("source", "fp", "size_")], F.count("*").alias("copies")), "pack-sizes")
    rows = clustered(rows).withColumn("document", F.when(F.lit(apart) & F.col("id").isNotNull(), F.xxhash64("id")))
    copies = rows.withColumn("copy", F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1)))
    total = rows.agg(F.sum("copies")).collect()[0][0] or 0
    shards = max(1, -(-total // SHARD_ROWS))
    dealt = copies.withColumn("shard", F.pmod(F.xxhash64("id", "h", "copy"), F.lit(shards)))
    full = dealt.where("size_ > 0").select("id", "h", "copy", "shard", "size_", "source", "cluster", "document")
    made = full.groupBy("shard").applyInArrow(_shard(capacity, per_source), f"id {kind}, h long, copy long, piece long, first long, n long, bin long, offset long")
    empty = copies.where("size_ <= 0").select("id", "h", "copy", *[F.lit(0).cast("long").alias(c) for c in ("piece", "first", "n")], F.lit(None).cast("long").alias("bin"), F.lit(0).cast("long").alias("offset"))
    return made.unionByName(empty).select(F.col("id").alias(id_col), "h", "copy", "piece", "first", "n", F.col("bin").alias("bin_id"), "offset")


def clustered(rows: DataFrame) -> DataFrame:
    """`rows` with ``cluster``, the near-duplicate component of their fingerprint ``fp``."""
    codes = written(rows.where("size_ > 0").select("fp").distinct(), "pack-codes")
    found = components(simhash.links(codes, MAX_BITS), "a", "b", "code", "root")
    return rows.join(found, F.col("fp") == F.col("code"), "left").withColumn("cluster", F.coalesce("root", "fp")).drop("fp", "code", "root")


@F.pandas_udf(LongType())
def _fingerprint(texts: pd.Series) -> pd.Series:
    return pd.Series(np.fromiter((simhash.fingerprint(t, SHINGLE) for t in texts), np.uint64, len(texts)).view(np.int64))


def pack_words(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", capacity: int = CAPACITY, per_source: int = PER_SOURCE, apart: bool = False) -> DataFrame:
    """`packed` with documents measured in words; case and spacing don't matter to near-duplicates."""
    text = F.col(f"`{text_col}`").cast("string")
    return packed(df, word_count(text), _fingerprint(F.lower(text)), id_col, source_col, capacity, per_source, apart)


def sequences(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", capacity: int = CAPACITY, per_source: int = PER_SOURCE) -> DataFrame:
    """The packed sequences: (bin_id, n_words, doc_ids, lengths, sources, text), pieces by their offset.

    A document taken in one piece keeps its text as it is; parts of one, as of a text longer than a
    sequence, are its words, joined by spaces; pieces are joined by a line break.  Documents without words,
    and null texts, are in no sequence.  Rows of one id may be stretches of one document, so they share no
    sequence either; each copy of a repeated row is placed by itself.  Of equally tight bins the first is
    taken.  Columns beside the three don't matter; an empty table gives no sequence.
    """
    placed = written(pack_words(df, id_col, text_col, source_col, capacity, per_source, apart=True), "packed").where("n > 0")
    # One array for each copy: it is bounded by the text's length, however often the row occurs.
    pieces = placed.groupBy(F.col(f"`{id_col}`").alias("id2"), F.col("h").alias("h2"), "copy").agg(F.collect_list(F.struct("bin_id", "offset", "first", "n")).alias("pieces"))
    text = F.col(f"`{text_col}`").cast("string")
    rows = df.select(row_hash(df).alias("h"), F.col(f"`{id_col}`").alias("id"), F.col(f"`{source_col}`").cast("string").alias("source"), text.alias("t"))
    once = rows.groupBy("id", "h").agg(F.first("source").alias("source"), F.min("t").alias("t"))
    cut = once.join(pieces, F.col("id").eqNullSafe(F.col("id2")) & (F.col("h") == F.col("h2"))).withColumn("p", F.explode("pieces"))
    words = F.regexp_extract_all(F.col("t"), F.lit(f"({WORD_PATTERN})"))
    part = F.when(F.size("pieces") == 1, F.col("t"))
    part = part.otherwise(F.array_join(F.slice(words, (F.col("p.first") + 1).cast("int"), F.col("p.n").cast("int")), " "))
    filled = cut.select("p.bin_id", F.struct("p.offset", "p.n", "id", "source", part.alias("t")).alias("x")).groupBy("bin_id").agg(F.array_sort(F.collect_list("x")).alias("x"))
    return filled.select(
        "bin_id",
        F.aggregate("x.n", F.lit(0).cast("long"), lambda a, n: a + n).alias("n_words"),
        F.col("x.id").alias("doc_ids"),
        F.col("x.n").alias("lengths"),
        F.col("x.source").alias("sources"),
        F.array_join("x.t", "\n").alias("text"),
    )
