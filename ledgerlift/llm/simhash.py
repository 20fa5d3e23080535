"""SimHash near-duplicates: fingerprints, links within a bit distance, and their components.

Close fingerprints are found by pigeonhole: with `max_bits + 3` blocks of bits, two fingerprints
within `max_bits` agree on three blocks at least.  Each choice of three blocks is a key; keys are
joined, the Hamming distance is verified, and only then linked.  The unit of work is the distinct
fingerprint, so copies, however many, cost one row.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlift.llm.common import pieces, row_hash, whole_row, written
from ledgerlift.llm.graph import components

BITS, SEED, AGREEING = 64, 42, 3
#: Fingerprints of one key that a task compares with one another or with as many others.
TILE = 2048
_HASHES_AT_ONCE = 1 << 16


def fingerprint(text: str | None, shingle: int) -> int:
    """The text's SimHash over word shingles, repeats included; 0 without words."""
    lowered = (text or "").encode("utf-8", "replace").lower()  # bytes: A-Z and ASCII white space only
    joined = b" ".join(b" ".join(words) for words in pieces(lowered) if words)
    if not joined:
        return 0
    gaps = np.flatnonzero(np.frombuffer(joined, np.uint8) == 32)
    width = min(shingle, gaps.size + 1)
    starts = np.concatenate(([0], gaps + 1))[: gaps.size + 2 - width]
    ends = np.concatenate((gaps, [len(joined)]))[width - 1 :]
    ones, digest = np.zeros(BITS, np.int64), xxhash.xxh64_intdigest
    for at in range(0, len(starts), _HASHES_AT_ONCE):
        pairs = zip(starts[at : at + _HASHES_AT_ONCE].tolist(), ends[at : at + _HASHES_AT_ONCE].tolist())
        hashes = np.array([digest(joined[s:e], SEED) for s, e in pairs], np.uint64)
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    set_bits = np.packbits(ones * 2 > len(starts), bitorder="little")
    return int(set_bits.view("<u8")[0])


def fingerprints(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3) -> DataFrame:
    """(id, fp long) for every row; a null or empty text has fingerprint 0."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.fromiter((fingerprint(t, shingle) for t in batch.column(1).to_pylist()), np.uint64, batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found.view(np.int64))], ["id", "fp"])

    kind = df.schema[id_col].dataType.simpleString()
    return df.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("string").alias("t")).mapInArrow(run, f"id {kind}, fp long")


def _masks(max_bits: int) -> list[int]:
    """For each choice of AGREEING blocks, the mask of their bits, as a signed long."""
    parts = max_bits + AGREEING
    edges = [BITS * i // parts for i in range(parts + 1)]
    blocks = [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in zip(edges, edges[1:])]
    return [int(np.uint64(sum(c)).view(np.int64)) for c in combinations(blocks, AGREEING)]


def _trees(max_bits: int):
    """Lists of fingerprints -> links that span each component which close pairs make within the list."""

    def trees(codes: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        left = np.unique(codes)
        while left.size > 1:
            border, left = [left[0]], left[1:]
            while border and left.size:
                here = border.pop()
                close = np.bitwise_count(left ^ here) <= max_bits
                if close.any():
                    yield here, left[close]
                    border.extend(left[close])
                    left = left[~close]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = [np.empty(0, np.uint64)], [np.empty(0, np.uint64)]
            for codes in batch.column(0):
                for here, found in trees(codes.values.to_numpy(zero_copy_only=False).view(np.uint64)):
                    a.append(np.full(found.size, here, np.uint64))
                    b.append(found)
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x).view(np.int64)) for x in (a, b)], ["a", "b"])

    return run


def links(codes: DataFrame, max_bits: int = 3) -> DataFrame:
    """(a, b) links among the distinct fingerprints `fp` of `codes`; their components are those of all close pairs.

    Pairs that share a key alone are compared in SQL.  A key of more fingerprints is cut into tiles of
    bounded size; every two tiles meet in some task, which returns a spanning tree of close pairs for
    each component it finds instead of all pairs.
    """
    keyed = codes.select("fp", F.posexplode(F.array(*[F.col("fp").bitwiseAND(F.lit(m)) for m in _masks(max_bits)])).alias("c", "key"))
    sizes = keyed.groupBy("c", "key").agg(F.count("*").alias("n"), F.min("fp").alias("a"), F.max("fp").alias("b")).where("n > 1")
    sizes = written(sizes, "simhash-keys")
    pairs = sizes.where((F.col("n") == 2) & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_bits)).select("a", "b")
    larger = sizes.where("n > 2").select("c", "key", F.ceil(F.col("n") / TILE).cast("int").alias("parts"))
    part = F.pmod(F.xxhash64("fp"), F.col("parts")).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("parts") - 1))
    tiled = keyed.join(larger, ["c", "key"]).withColumn("i", part).withColumn("j", other)
    tiles = tiled.groupBy("c", "key", F.least("i", "j").alias("x"), F.greatest("i", "j").alias("y")).agg(F.collect_list("fp").alias("fps"))
    return pairs.unionByName(tiles.select("fps").mapInArrow(_trees(max_bits), "a long, b long"))


def hexadecimal(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def near_groups(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, max_bits: int = 3) -> DataFrame:
    """A row for each row of `df`: its id, fingerprint (16 hex digits) and component_id.

    Fingerprints link at `max_bits` or fewer differing bits; component_id is the smallest non-null id
    reachable, null where a component has only null ids.  Repeated rows come out as often as they go
    in; texts without words share fingerprint 0.  An empty table gives an empty result; other columns
    of `df` are not looked at.
    """
    rows = written(fingerprints(df, id_col, text_col, shingle), "simhash")
    codes = written(rows.groupBy("fp").agg(F.min("id").alias("least")), "simhash-codes")
    found = components(links(codes.select("fp"), max_bits), "a", "b", "fp", "root")
    rooted = codes.join(found, "fp", "left").select("fp", F.coalesce("root", "fp").alias("root"), "least")
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    named = rooted.join(least, "root").select("fp", "component_id")
    return rows.join(named, "fp").select(F.col("id").alias(id_col), hexadecimal(F.col("fp")).alias("fingerprint"), "component_id")


def near_dedup(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, max_bits: int = 3) -> DataFrame:
    """`df` with one row of each component: that of the smallest id (null first), then of the smallest row hash.

    A row's identity is its id with a hash of all its columns, so repeated ids with other texts are
    documents of their own and repeated rows are one.  Null texts are texts without words, which are
    near one another.  Columns keep their values whatever their names; an empty table gives an empty result.
    """
    key = F.struct(F.col(f"`{id_col}`").alias("id"), row_hash(df).alias("h")).alias("key")
    groups = near_groups(df.select(key, F.col(f"`{text_col}`").alias("t")), "key", "t", shingle, max_bits)
    kept = groups.where("key = component_id").select("key")
    # Partial aggregation first: a repeated row is sent once by each task.
    return df.select(key, whole_row(df).alias("row")).dropDuplicates(["key"]).join(kept, "key", "left_semi").select("row.*")
