"""Exact top-k search of binary codes by incremental multi-index hashing.

A code is cut into m segments, and every distinct code is indexed under each of them.  In round r a
query looks up all segment values at r differing bits.  When the first a segments are searched at
radius r and all of them at smaller ones, every code within m * r + a - 1 bits has been met, so a query
ends as soon as its k-th verified distance is no larger.  Queries and codes are worked on once each,
however many rows share them.

The index lies in tiles: codes with the same upper bits of a segment, ordered by its lower ones.  Queries
go to the tiles in blocks, and a tile's task makes the values to look up, so that their number, which
grows steeply with the radius, is in no plan, shuffle or broadcast.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlift.llm.common import HEAVY_ROWS, adopted, written

BITS, SEED = 64, 11
#: Queries and codes that one task compares where looking up would cost more than comparing.
QUERY_TILE, CODE_TILE = 1024, 1 << 15
#: Codes of a tile of the index, queries of a block, and values or codes that a task has in hand at once.
INDEX_TILE, QUERY_BLOCK, IN_HAND = 1 << 19, 1 << 13, 1 << 19


def binary_codes(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(id, code long): the signs of 64 seeded random projections.

    Missing coordinates count as 0, and so do null and NaN ones.  Rows with a null id or a null vector
    have no code and are left out.
    """
    rows = df.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{vector_col}`").cast("array<double>").alias("v")).where("id is not null and v is not null")
    width = rows.agg(F.max(F.size("v"))).collect()[0][0] or 0
    planes = np.random.default_rng(SEED).standard_normal((BITS, max(1, width))).T  # a coordinate's weights don't depend on the width

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dense = np.zeros((batch.num_rows, planes.shape[0]))
            for at, vector in enumerate(batch.column(1).to_pylist()):
                dense[at, : len(vector)] = [x or 0.0 for x in vector]
            bits = np.packbits(np.nan_to_num(dense) @ planes > 0, axis=1, bitorder="little")
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(bits.view("<i8").ravel())], ["id", "code"])

    return rows.mapInArrow(run, f"id {df.schema[id_col].dataType.simpleString()}, code long")


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _segments(m: int) -> list[tuple[int, int]]:
    """First bit and width of the m segments."""
    edges = [BITS * i // m for i in range(m + 1)]
    return [(a, b - a) for a, b in zip(edges, edges[1:])]


def _value(code: str, first: int, width: int) -> Column:
    """The bits of a segment as a number."""
    return F.shiftrightunsigned(F.col(code), first).bitwiseAND(F.lit(_signed((1 << width) - 1)))


def _index(distinct: DataFrame, segments: list[tuple[int, int]], upper: int, kind: str) -> DataFrame:
    """(tile, segment, bucket, codes, first, n): every code under each segment, one row a tile.

    A bucket holds the values that share their `upper` first bits; one with many codes lies in several tiles.
    """
    buckets = F.array(*[F.shiftrightunsigned(_value("code", first, width), width - upper) for first, width in segments])
    held = distinct.select("code", F.col("ids")[0].alias("first"), "n", F.posexplode(buckets).alias("segment", "bucket"))
    parts = held.groupBy("segment", "bucket").agg(F.ceil(F.count("*") / INDEX_TILE).alias("parts"))
    held = held.join(F.broadcast(parts), ["segment", "bucket"])  # a row or a few for every INDEX_TILE codes of the index
    part = F.pmod(F.xxhash64("code"), "parts")
    held = held.select((F.shiftleft(F.shiftleft(F.col("segment").cast("long"), 32) + F.col("bucket"), 24) + part).alias("tile"), "segment", "bucket", "code", "first", "n")
    return held.groupBy("tile").applyInArrow(_tiled(segments, upper), f"tile long, segment int, bucket long, codes array<long>, first array<{kind}>, n array<int>")


def _low(codes: np.ndarray, first: int, width: int) -> np.ndarray:
    """Some bits of a code as a number."""
    return (codes.view(np.uint64) >> np.uint64(first)) & np.uint64((1 << width) - 1)


def _listed(values: pa.Array) -> pa.Array:
    """One list of all the values."""
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)


def _tiled(segments: list[tuple[int, int]], upper: int):
    def run(table: pa.Table) -> pa.Table:
        segment = table.column("segment")[0].as_py()
        first, width = segments[segment]
        order = pa.array(np.argsort(_low(table.column("code").to_numpy(), first, width - upper), kind="stable"))
        listed = [_listed(table.column(c).combine_chunks().take(order)) for c in ("code", "first", "n")]
        return pa.table([table.column("tile").slice(0, 1), table.column("segment").slice(0, 1), table.column("bucket").slice(0, 1), *listed], names=["tile", "segment", "bucket", "codes", "first", "n"])

    return run


class _Tile:
    """A tile of the index: its codes by the lower bits of the segment, and where each value of these begins."""

    def __init__(self, row: pa.RecordBatch, segments: list[tuple[int, int]], upper: int):
        self.segment, self.bucket = row.column("segment")[0].as_py(), row.column("bucket")[0].as_py()
        self.segments, (self.first, self.width) = segments, segments[self.segment]
        self.lower = self.width - upper
        self.codes, self.ids, self.n = (row.column(c)[0].values for c in ("codes", "first", "n"))
        self.codes = self.codes.to_numpy()
        #: Among equally near codes the one with the least id comes first.
        self.place = pc.rank(self.ids, sort_keys="ascending", tiebreaker="first").to_numpy().astype(np.int64)
        self.starts = np.searchsorted(_low(self.codes, self.first, self.lower), np.arange((1 << self.lower) + 1, dtype=np.uint64))
        self.values = np.arange(1 << self.lower)
        self.flips: dict[int, np.ndarray] = {}

    def looked_up(self, q: np.ndarray, kth: np.ndarray, r: int, wanted: int) -> Iterator[pa.RecordBatch]:
        """What the queries meet at r differing bits of the segment and not earlier, within their k-th distance: each one's nearest."""
        own = _low(q, self.first, self.width)
        apart = np.bitwise_count((own >> np.uint64(self.lower)) ^ np.uint64(self.bucket)).astype(np.int64)
        own = (own & np.uint64((1 << self.lower) - 1)).astype(np.int64)
        for bits in range(max(0, r - (self.width - self.lower)), min(r, self.lower) + 1):
            some = np.flatnonzero(apart == r - bits)
            if some.size and bits not in self.flips:
                self.flips[bits] = self.values[np.bitwise_count(self.values) == bits]
            flips = self.flips.get(bits, self.values[:0])
            step = max(1, IN_HAND // max(1, flips.size))
            for at in range(0, some.size, step):
                rows = some[at : at + step]
                yield from self._met(q[rows], kth[rows], own[rows], flips, r, wanted)

    def _met(self, q: np.ndarray, kth: np.ndarray, own: np.ndarray, flips: np.ndarray, r: int, wanted: int) -> Iterator[pa.RecordBatch]:
        probes = (own[:, None] ^ flips[None, :]).ravel()
        begin = self.starts[probes]
        sizes = self.starts[probes + 1] - begin
        hit = np.flatnonzero(sizes)
        begin, sizes, of = begin[hit], sizes[hit], hit // flips.size
        ends = np.cumsum(sizes)
        best, first, before = [], 0, 0
        while first < hit.size:
            # As many values as have IN_HAND codes between them, one at least.
            last = max(first + 1, int(np.searchsorted(ends, before + IN_HAND, side="right")))
            size, rows = sizes[first:last], of[first:last]
            at = np.repeat(begin[first:last] - (ends[first:last] - size - before), size) + np.arange(ends[last - 1] - before)
            distance = np.bitwise_count((self.codes[at] ^ np.repeat(q[rows], size)).view(np.uint64))
            near = np.flatnonzero(distance <= np.repeat(kth[rows], size))
            row = rows[np.searchsorted(ends[first:last] - before, near, side="right")]
            at, distance = at[near], distance[near]
            fresh = ~self._earlier(self.codes[at] ^ q[row], r)
            best.append(self._cut(row[fresh], distance[fresh], at[fresh], wanted))
            first, before = last, ends[last - 1]
            if sum(x[0].size for x in best) > IN_HAND:
                best = [self._cut(*map(np.concatenate, zip(*best)), wanted)]
        if best:
            row, distance, at = self._cut(*map(np.concatenate, zip(*best)), wanted)
            for i in range(0, row.size, QUERY_BLOCK * 8):
                x, some = slice(i, i + QUERY_BLOCK * 8), pa.array(at[i : i + QUERY_BLOCK * 8])
                yield pa.RecordBatch.from_arrays([pa.array(q[row[x]]), pa.array(self.codes[at[x]]), pa.array(distance[x].astype(np.int32)), self.ids.take(some), self.n.take(some)], ["q", "code", "distance", "first", "n"])

    def _earlier(self, differing: np.ndarray, r: int) -> np.ndarray:
        """A pair counts where it is met first: at the smallest radius, then the first segment."""
        out = np.zeros(differing.size, bool)
        for j, (first, width) in enumerate(self.segments):
            d = np.bitwise_count(_low(differing, first, width))
            out |= (d <= r) if j < self.segment else (d < r)
        return out

    def _cut(self, row: np.ndarray, distance: np.ndarray, at: np.ndarray, wanted: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Each row's nearest `wanted`."""
        order = np.lexsort((self.place[at], distance, row))
        row = row[order]
        start = np.flatnonzero(np.concatenate((np.ones(min(1, row.size), bool), row[1:] != row[:-1])))
        among = np.arange(row.size) - np.repeat(start, np.diff(start, append=row.size))
        kept = among < wanted
        return row[kept], distance[order][kept], at[order][kept]


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(q, kth, parts) -> a row for each block of queries."""
    for batch in batches:
        for at in range(0, batch.num_rows, QUERY_BLOCK):
            some = batch.slice(at, QUERY_BLOCK)
            yield pa.RecordBatch.from_arrays([_listed(pa.concat_arrays([some.column(i)])) for i in range(3)], ["q", "kth", "parts"])


def _probed(segments: list[tuple[int, int]], upper: int, r: int, wanted: int):
    """Tiles, each followed by blocks of queries -> (q, code, distance, first, n)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tile = None
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1)
                if row.column("codes")[0].is_valid:
                    tile = _Tile(row, segments, upper)
                    continue
                q, kth, parts = (row.column(c)[0].values.to_numpy() for c in ("q", "kth", "parts"))
                asks = parts > tile.segment
                yield from tile.looked_up(q[asks], kth[asks], r, wanted)

    return run


def _met(index: DataFrame, open_: DataFrame, segments: list[tuple[int, int]], upper: int, r: int, wanted: int, kind: str) -> DataFrame:
    """(q, code, distance, first, n): what a round looks up, in the tiles of the segments that a query still asks."""
    asked = open_.select("q", F.coalesce("kth", F.lit(BITS)).alias("kth"), F.col("parts").cast("int").alias("parts"))
    blocks = written(adopted(asked, rows=QUERY_BLOCK).mapInArrow(_blocks, "q array<long>, kth array<int>, parts array<int>"), f"blocks-{r}")
    blocks = blocks.crossJoin(F.broadcast(index.select("tile")))  # one number for every INDEX_TILE codes of the index
    both = index.unionByName(blocks, allowMissingColumns=True).repartition("tile").sortWithinPartitions("tile", F.col("codes").isNull())
    return both.mapInArrow(_probed(segments, upper, r, wanted), f"q long, code long, distance int, first {kind}, n int")


def _nearest(found: DataFrame, wanted: int) -> DataFrame:
    """Of each query's codes those that can hold one of its nearest `wanted` ids."""
    order = Window.partitionBy("q").orderBy("distance", "first")
    return found.withColumn("place", F.row_number().over(order)).where(F.col("place") <= wanted).drop("place")


def _compared(wanted: int):
    """A tile of queries against a tile of codes -> each query's nearest `wanted` codes of the tile."""

    def run(queries: pa.Table, codes: pa.Table) -> pa.Table:
        held = codes.column("code").to_numpy()
        first = pc.rank(codes.column("first"), sort_keys="ascending", tiebreaker="first").to_numpy()
        rows_q, rows_at, rows_d = [], [], []
        for q in queries.column("q").to_numpy():
            distances = np.bitwise_count((held ^ q).view(np.uint64))
            near = np.lexsort((first, distances))[:wanted]
            rows_q.append(np.full(near.size, q))
            rows_at.append(near)
            rows_d.append(distances[near])
        joined = lambda x, kind: np.concatenate([*x, np.empty(0, kind)]).astype(kind)
        at = pa.array(joined(rows_at, np.int64))
        return pa.table([pa.array(joined(rows_q, np.int64)), codes.column("code").take(at), pa.array(joined(rows_d, np.int32)), codes.column("first").take(at), codes.column("n").take(at)], names=["q", "code", "distance", "first", "n"])

    return run


def nearest(codes: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """(query_id, rank, neighbor_id, distance): each query's k nearest rows by Hamming distance, then id.

    Both tables are (id, code); repeated (id, code) pairs count once, an id may have several codes.  A
    query doesn't find its own pair.  Where fewer than k other rows exist, all are returned; empty
    tables give an empty result.
    """
    wanted = k + 1  # the query's own row may be among them
    kind = codes.schema["id"].dataType.simpleString()
    entry = codes.select("id", "code").distinct()
    first = F.row_number().over(Window.partitionBy("code").orderBy("id"))
    distinct = entry.withColumn("place", first).where(F.col("place") <= wanted).groupBy("code").agg(F.sort_array(F.collect_list("id")).alias("ids"))
    distinct = written(distinct.withColumn("n", F.size("ids")), "codes")
    asked = written(queries.select("id", F.col("code").alias("q")).distinct(), "queries")
    total = distinct.count()
    m = max(1, min(16, math.ceil(BITS / max(1.0, math.log2(max(2, total))))))
    segments = _segments(m)
    upper = min(min(width for _, width in segments), max(0, math.ceil(math.log2(max(1, total) / INDEX_TILE))))
    # Tiles are few and heavy rows: they go to Python one at a time.
    index = written(_index(adopted(distinct, rows=1 << 16), segments, upper, kind), "code-index", HEAVY_ROWS)
    index = adopted(index, rows=1)
    open_ = asked.select("q").distinct().withColumn("kth", F.lit(None).cast("int"))
    closed, best = [], None
    for r in range(max(width for _, width in segments) + 1):
        # A query searches as many segments as its k-th distance still asks for.
        open_ = open_.withColumn("parts", F.least(F.lit(m), F.coalesce(F.col("kth") - m * r + 1, F.lit(m))))
        if sum(math.comb(width, r) for _, width in segments) > total:
            held = _by_comparison(open_.select("q"), distinct, wanted, kind, total)
            closed.append(held)
            open_ = None
            break
        found = _met(index, open_, segments, upper, r, wanted, kind)
        best = found if best is None else best.join(open_.select("q"), "q", "left_semi").unionByName(found)
        best = written(_nearest(best, wanted), f"nearest-{r}")
        counted = best.withColumn("so_far", F.sum("n").over(Window.partitionBy("q").orderBy("distance", "first")))
        kth = counted.where(F.col("so_far") >= wanted).groupBy("q").agg(F.min("distance").alias("kth"))
        state = open_.select("q", "parts").join(kth, "q", "left").withColumn("done", F.coalesce(F.col("kth") <= m * r + F.col("parts") - 1, F.lit(False)))
        state = written(state, f"open-{r}")
        closed.append(best.join(state.where("done"), "q", "left_semi"))
        open_ = state.where("not done").select("q", "kth")
        if not open_.limit(1).count():
            open_ = None
            break
    if open_ is not None:  # all segments were searched in full: every code was met
        closed.append(best.join(open_, "q", "left_semi"))
    result = closed[0]
    for part in closed[1:]:
        result = result.unionByName(part)
    result = result.select("q", "code", "distance").join(distinct.select("code", "ids"), "code")
    pairs = asked.join(result, "q").select(F.col("id").alias("query_id"), "q", "code", "distance", F.explode("ids").alias("neighbor_id"))
    others = pairs.where((F.col("neighbor_id") != F.col("query_id")) | (F.col("code") != F.col("q")))
    rank = F.row_number().over(Window.partitionBy("query_id", "q").orderBy("distance", "neighbor_id"))
    return others.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "neighbor_id", F.col("distance").cast("int").alias("distance"))


def _by_comparison(open_: DataFrame, distinct: DataFrame, wanted: int, kind: str, total: int) -> DataFrame:
    """The queries left against all codes, tile by tile: where a round has more values to look up than there are codes."""
    tiles = max(1, -(-total // CODE_TILE))
    queries = max(1, -(-open_.count() // QUERY_TILE))
    left = open_.withColumn("qt", F.pmod(F.xxhash64("q"), F.lit(queries))).withColumn("ct", F.explode(F.sequence(F.lit(0), F.lit(tiles - 1))))
    right = distinct.select("code", F.col("ids")[0].alias("first"), "n").withColumn("ct", F.pmod(F.xxhash64("code"), F.lit(tiles)).cast("int")).withColumn("qt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(queries - 1).cast("long"))))
    schema = f"q long, code long, distance int, first {kind}, n int"
    found = left.groupBy("qt", "ct").cogroup(right.groupBy("qt", "ct")).applyInArrow(_compared(wanted), schema)
    return written(_nearest(found, wanted), "nearest-compared")
