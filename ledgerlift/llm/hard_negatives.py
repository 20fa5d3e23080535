"""Hard negatives: for each anchor and each of its positives, the other-label rows that score almost as high.

Vectors are integers, so a score is an exact inner product.  Anchors and candidates are dealt into tiles;
a task multiplies one tile of each by Strassen's recursion (seven half-size products in place of eight,
odd sides padded with zeros, down to small blocks) and keeps heaps: first, per anchor, the best
positives of the tile, then, per anchor and positive, the best negatives of its window of scores.  A heap
is a few rows; heaps of all tiles are merged by rank, and Spark keeps only the first ranks of each task
before it shuffles them.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import gcd

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlift.llm.common import written

#: Anchors and candidates of one task, and the side at which the recursion multiplies plainly.
ANCHOR_TILE, CANDIDATE_TILE, LEAF = 512, 4096, 16
#: A component x counts as floor(SCALE * x).
SCALE = 256
#: Rows whose vector has a squared length beyond this take no part: their scores might not fit 64 bits.
MAX_SQUARES = 2.0**55


def product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """a @ b for int64 matrices by Strassen's recursion.

    Sums wrap modulo 2^64 and so does the result, which is exact wherever the true entry fits 64 bits.
    """
    rows, inner, columns = a.shape[0], a.shape[1], b.shape[1]
    if min(rows, inner, columns) <= LEAF:
        return a @ b
    a11, a12, a21, a22 = _quarters(a)
    b11, b12, b21, b22 = _quarters(b)
    p1 = product(a11 + a22, b11 + b22)
    p2 = product(a21 + a22, b11)
    p3 = product(a11, b12 - b22)
    p4 = product(a22, b21 - b11)
    p5 = product(a11 + a12, b22)
    p6 = product(a21 - a11, b11 + b12)
    p7 = product(a12 - a22, b21 + b22)
    whole = np.empty((2 * a11.shape[0], 2 * b11.shape[1]), np.int64)
    top, left = a11.shape[0], b11.shape[1]
    whole[:top, :left] = p1 + p4 - p5 + p7
    whole[:top, left:] = p3 + p5
    whole[top:, :left] = p2 + p4
    whole[top:, left:] = p1 - p2 + p3 + p6
    return whole[:rows, :columns]


def _quarters(x: np.ndarray) -> tuple[np.ndarray, ...]:
    """The four blocks of a matrix, odd sides padded with zeros."""
    x = np.pad(x, ((0, x.shape[0] % 2), (0, x.shape[1] % 2)))
    r, c = x.shape[0] // 2, x.shape[1] // 2
    return x[:r, :c], x[:r, c:], x[r:, :c], x[r:, c:]


def heap(scores: np.ndarray, places: np.ndarray, keep: int) -> np.ndarray:
    """The `keep` of `places` with the highest scores, higher first, ties by place; `places` ascend."""
    held = scores[places]
    if held.size > keep:
        least = np.partition(held, held.size - keep)[held.size - keep]
        over = places[held > least]
        places = np.concatenate((over, places[held == least][: keep - over.size]))
        held = scores[places]
    return places[np.lexsort((places, -held))]


def _dense(vectors: pa.ChunkedArray, width: int) -> np.ndarray:
    """Lists of integers as rows of a matrix, shorter ones padded with zeros."""
    lists = vectors.combine_chunks()
    sizes = np.diff(lists.offsets.to_numpy())
    made = np.zeros((len(lists), width), np.int64)
    made[np.arange(width) < sizes[:, None]] = lists.flatten().to_numpy()
    return made


def _scores(anchors: pa.Table, rows: pa.Table) -> np.ndarray:
    sizes = [np.diff(t.column("v").combine_chunks().offsets.to_numpy()).max(initial=0) for t in (anchors, rows)]
    return product(_dense(anchors.column("v"), max(sizes)), _dense(rows.column("v"), max(sizes)).T.copy())


def _columns(table: pa.Table, *names: str) -> list[np.ndarray]:
    return [table.column(n).to_numpy() for n in names]


def _positives(keep: int):
    """A tile of anchors and one of rows -> each anchor's best rows of its own label."""

    def run(anchors: pa.Table, rows: pa.Table) -> pa.Table:
        rows = rows.sort_by([("id", "ascending"), ("h", "ascending")])
        scores = _scores(anchors, rows)
        ids, hashes, labels = _columns(rows, "id", "h", "label")
        made = []
        for i, (a, ah, label) in enumerate(zip(*_columns(anchors, "id", "h", "label"))):
            best = heap(scores[i], np.flatnonzero((labels == label) & ~((ids == a) & (hashes == ah))), keep)
            made.append((np.full(best.size, a), np.full(best.size, ah), ids[best], hashes[best], scores[i][best]))
        return _table(made, ("a", "ah", "p", "ph", "score"))

    return run


def _negatives(keep: int, low: int, high: int, whole: int):
    """A tile of anchors, with their positives, and one of rows -> each window's best rows of other labels."""

    def run(anchors: pa.Table, rows: pa.Table) -> pa.Table:
        rows = rows.sort_by([("id", "ascending"), ("h", "ascending")])
        scores = _scores(anchors, rows)
        ids, hashes, labels = _columns(rows, "id", "h", "label")
        made = []
        for i, (a, ah, label, windows) in enumerate(zip(*_columns(anchors, "id", "h", "label"), anchors.column("windows").to_pylist())):
            other = np.flatnonzero(labels != label)
            level = scores[i][other]
            for w in windows:
                inside = (low * w["score"] <= whole * level) & (whole * level <= high * w["score"])
                best = heap(scores[i], other[inside], keep)
                same = [np.full(best.size, x) for x in (a, ah, w["p"], w["ph"], w["score"])]
                made.append((*same, ids[best], hashes[best], scores[i][best]))
        return _table(made, ("a", "ah", "p", "ph", "score", "n", "nh", "n_score"))

    return run


def _table(made: list[tuple[np.ndarray, ...]], names: tuple[str, ...]) -> pa.Table:
    empty = np.empty(0, np.int64)
    return pa.table([pa.array(np.concatenate([*(m[j] for m in made), empty]).astype(np.int64)) for j in range(len(names))], names=list(names))


def _tiled(anchors: DataFrame, rows: DataFrame, tiles: tuple[int, int], run, schema: str) -> DataFrame:
    """Every tile of anchors against every tile of rows."""
    mine, other = F.pmod("h", F.lit(tiles[0])).alias("x"), F.explode(F.sequence(F.lit(0), F.lit(tiles[1] - 1))).alias("y")
    left = anchors.select("*", mine, other)
    mine, other = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(tiles[0] - 1).cast("long"))).alias("x"), F.pmod("h", F.lit(tiles[1])).cast("int").alias("y")
    right = rows.select("*", mine, other)
    return left.groupBy("x", "y").cogroup(right.groupBy("x", "y")).applyInArrow(run, schema)


def _ranked(df: DataFrame, keys: list[str], order: list[Column], keep: int) -> DataFrame:
    """The first `keep` of each key; each task keeps no more before the shuffle."""
    return df.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col("rank") <= keep)


def quantised(df: DataFrame, anchor: Column, id_col: str, vector_col: str, label_col: str) -> DataFrame:
    """(id, label, v, anchor, h) of the rows that take part, each once; h tells rows of one id apart."""
    rows = df.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{label_col}`").cast("long").alias("label"), F.col(f"`{vector_col}`").cast("array<double>").alias("x"), F.coalesce(anchor, F.lit(False)).alias("anchor"))
    finite = F.forall("x", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    rows = rows.where(F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("x").isNotNull()).where(finite)
    scaled = rows.withColumn("x", F.transform("x", lambda c: c * F.lit(float(SCALE))))
    short = scaled.where(F.aggregate("x", F.lit(0.0), lambda s, c: s + c * c) <= MAX_SQUARES)
    whole = short.select("id", "label", F.transform("x", lambda c: F.floor(c)).alias("v"), "anchor")
    return whole.distinct().withColumn("h", F.xxhash64("id", "label", "v", "anchor"))


def mined(
    df: DataFrame,
    anchor: Column,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    positives: int = 5,
    negatives: int = 5,
    window: tuple[int, int] = (80, 100),
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    A row's score is its integer inner product with the anchor; higher scores come first, ties by
    smaller id.  An anchor's positives are its first other rows of the same label.  For each of them
    the first rows of other labels are returned whose score lies in the window, in hundredths of the
    positive's score.  An anchor or positive without such rows has none in the result.

    Rows with a null id, label or vector, a null or non-finite component, or a squared length beyond
    MAX_SQUARES (after scaling) take no part; shorter vectors count as ending in zeros.  Rows that agree in
    id, label and vector count once; other rows of one id are rows of their own, ties among them by a
    hash of the row.  A null `anchor` is none.  An empty table gives an empty result; further columns
    of `df`, whatever their names, don't matter.
    """
    rows = written(quantised(df, anchor, id_col, vector_col, label_col), "negatives-rows")
    total, asked = rows.agg(F.count(F.lit(1)), F.count_if("anchor")).first()
    tiles = max(1, -(-asked // ANCHOR_TILE)), max(1, -(-total // CANDIDATE_TILE))
    candidates, anchors = rows.select("id", "h", "label", "v"), rows.where("anchor").select("id", "h", "label", "v")
    met = _tiled(anchors, candidates, tiles, _positives(positives), "a long, ah long, p long, ph long, score long")
    best = _ranked(met, ["a", "ah"], [F.desc("score"), F.col("p"), F.col("ph")], positives)
    windows = best.groupBy("a", "ah").agg(F.collect_list(F.struct("p", "ph", "score")).alias("windows"))
    armed = anchors.join(windows, (F.col("id") == F.col("a")) & (F.col("h") == F.col("ah"))).drop("a", "ah")
    armed = written(armed, "negatives-anchors")
    whole, (low, high) = 100, window
    part = gcd(whole, low, high)
    run = _negatives(negatives, low // part, high // part, whole // part)
    found = _tiled(armed, candidates, tiles, run, "a long, ah long, p long, ph long, score long, n long, nh long, n_score long")
    first = _ranked(found, ["a", "ah", "p", "ph"], [F.desc("n_score"), F.col("n"), F.col("nh")], negatives)
    return first.select(F.col("a").alias("anchor_id"), F.col("p").alias("positive_id"), "rank", F.col("n").alias("negative_id"), F.col("score").alias("positive_score"), F.col("n_score").alias("negative_score"))
