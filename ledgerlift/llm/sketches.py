"""Document fingerprints: bottom-k sketches of word shingles, with DataFrame functions only.

A sketch is the k smallest distinct hashes of a text's shingles, ascending.  Sketches of parts merge
into the sketch of the whole; two sketches estimate resemblance and containment, one estimates the
number of distinct shingles.  A text with up to k distinct shingles has an exact sketch.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlift.llm.common import written

SHINGLE, SIZE = 5, 128
#: Ids that one task puts in order.
IDS = 100_000


def sketch(text: Column, shingle: int = SHINGLE, size: int = SIZE) -> Column:
    """The sketch of a text's lower-cased words; a text of fewer words than a shingle is one shingle.

    Null texts and texts without words have an empty sketch.
    """
    words = F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[\x20\x09-\x0D]+"), "")
    hashes = F.transform(words, lambda w: F.xxhash64(w))

    def of(h: Column) -> Column:
        last = F.size(h) - shingle
        long = F.transform(F.sequence(F.lit(0), F.greatest(last, F.lit(0))), lambda i: F.xxhash64(*[F.get(h, i + k) for k in range(shingle)]))
        # get() is null past the end, and xxhash64 skips nulls: a short text is hashed whole.
        return F.when(F.size(h) > 0, F.slice(F.sort_array(F.array_distinct(long)), 1, size)).otherwise(F.expr("cast(array() as array<bigint>)"))

    # The word hashes are bound once, by a one-element array, so that they are not computed per shingle.
    return F.element_at(F.transform(F.array(hashes), of), 1)


def merged(a: Column, b: Column, size: int = SIZE) -> Column:
    """The sketch of the union of both texts' shingles."""
    return F.slice(F.sort_array(F.array_union(a, b)), 1, size)


def resemblance(a: Column, b: Column, size: int = SIZE) -> Column:
    """Share of common shingles among all, 0 to 1; two empty sketches are alike."""
    union = merged(a, b, size)
    common = F.size(F.array_intersect(F.array_intersect(union, a), b))
    return F.when(F.size(union) == 0, F.lit(1.0)).otherwise(common / F.size(union))


def distinct_shingles(a: Column, size: int = SIZE) -> Column:
    """Estimated number of distinct shingles; exact below `size`."""
    place = (F.element_at(a, -1).cast("double") + F.lit(2.0**63)) / F.lit(2.0**64)
    return F.when(F.size(a) < size, F.size(a).cast("double")).otherwise((size - 1) / place)


def containment(a: Column, b: Column, size: int = SIZE) -> Column:
    """Estimated share of a's shingles that b has; 1 for an empty a."""
    r, n, m = resemblance(a, b, size), distinct_shingles(a, size), distinct_shingles(b, size)
    return F.when(F.size(a) == 0, F.lit(1.0)).otherwise(F.least(F.lit(1.0), r / (1 + r) * (n + m) / n))


def printed(a: Column) -> Column:
    """A sketch as text: 16 hex digits a hash."""
    return F.array_join(F.transform(a, lambda h: F.lower(F.lpad(F.hex(h), 16, "0"))), "")


def followers(ids: DataFrame, id_col: str) -> DataFrame:
    """(id, next): the next larger distinct non-null id; the largest is followed by the smallest.

    Ids are dealt to ranges, put in order within each, and the ranges' ends are joined by a window over
    one row for each range.
    """
    distinct = written(ids.select(F.col(f"`{id_col}`").alias("id")).where("id is not null").groupBy("id").agg(F.count("*").alias("n")), "ids")
    total, least = distinct.agg(F.count("*"), F.min("id")).collect()[0]
    ranges = max(1, -(-total // IDS))
    ranged = written(distinct.select("id").repartitionByRange(ranges, "id").withColumn("r", F.spark_partition_id()), "id-ranges")
    heads = ranged.groupBy("r").agg(F.min("id").alias("head"))
    heads = heads.select("r", F.lead("head").over(Window.orderBy("r")).alias("after"))
    within = ranged.withColumn("next", F.lead("id").over(Window.partitionBy("r").orderBy("id")))
    return within.join(heads, "r").select("id", F.coalesce("next", "after", F.lit(least)).alias("next"))


def edited_pairs(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of each row's text and of its edited text, and their likeness.

    The edited text has the last half of the code points replaced by as many of the next document's
    first ones, by ascending id.  A null text counts as empty.  An id that occurs more than once has
    all its rows followed by the next id, whose text of the smallest hash is taken.  Rows with a null
    id follow nothing: their edited text is the first half, near_next is null.  A lone document is its
    own next one.  An empty table gives an empty result; other columns don't matter.
    """
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    rows = df.select(F.col(f"`{id_col}`").alias("id"), text.alias("t"))
    known = rows.where("id is not null")
    lengths = known.groupBy("id").agg(F.max(F.length("t")).alias("n"))
    pairs = followers(df, id_col).withColumnRenamed("id", "prev").join(lengths.withColumnRenamed("id", "prev"), "prev")
    pairs = written(pairs.select("prev", "next", F.floor(F.col("n") / 2).cast("int").alias("need")), "followers")
    # Both joins deal the texts by id, so that they are shuffled once.
    given = known.join(pairs, F.col("id") == F.col("next")).select("prev", F.struct(F.xxhash64("t").alias("h"), F.expr("left(t, need)").alias("head"), sketch(F.col("t")).alias("sketch")).alias("x"))
    given = given.groupBy("prev").agg(F.min("x").alias("x"))
    joined = known.join(given, F.col("id") == F.col("prev")).select("id", "t", "x.head", F.col("x.sketch").alias("next_sketch"))
    lone = rows.where("id is null").select("id", "t", F.lit("").alias("head"), F.lit(None).cast("array<bigint>").alias("next_sketch"))
    n = F.length("t")
    all_rows = joined.unionByName(lone).withColumn("n_chars", n.cast("long"))
    all_rows = all_rows.withColumn("edited", F.concat(F.expr("left(t, cast(n_chars - n_chars div 2 as int))"), F.expr("left(head, cast(n_chars div 2 as int))")))
    both = all_rows.withColumn("a", sketch(F.col("t"))).withColumn("b", sketch(F.col("edited")))
    return both.select(
        F.col("id").alias(id_col),
        "n_chars",
        F.sha2("edited", 256).alias("edited_sha256"),
        printed(F.col("a")).alias("fingerprint"),
        printed(F.col("b")).alias("edited_fingerprint"),
        resemblance(F.col("a"), F.col("b")).alias("near_edited"),
        resemblance(F.col("a"), F.col("next_sketch")).alias("near_next"),
        distinct_shingles(F.col("a")).alias("distinct_shingles"),
        containment(F.col("a"), F.col("b")).alias("contained_in_edited"),
    )
