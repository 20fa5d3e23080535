"""Mixing sources to target weights, with DataFrame operations only.

The words of a source are laid out on a line and cut into blocks of fixed length.  The mix is a
sequence of slots in output shards; a seeded draw gives every slot a source, so that a shard's
source counts are multinomial.  Slots that a source draws beyond its quota pass to sources that
drew too few.  The k-th slot of a source takes block p(k), where p is a pseudorandom permutation of
the source's blocks, another one for each time through them.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlift.llm.common import WORD_PATTERN, row_hash, running_bases, whole_row, word_count, written
from ledgerlift.sources.grid import number_rows

SHARE, MOST, WEIGHTS, SEED = 1.5, 2.0, (3.0, 1.0, 2.0), 17
#: Words of a block, slots of an output shard, rows of all sources that share a group.
BLOCK, SHARD, GROUP = 64, 1 << 13, 1 << 9
#: Up to so many sources their table is broadcast (some 100 bytes a source); a longer one is joined as Spark plans it.
FEW_SOURCES = 10_000
_CELLS = 4096
#: Half rounds of the permutation, and how often a place beyond the last block is sent through it again.
ROUNDS, WALKS = 4, 64


@dataclass
class Plan:
    """The sources in order, with what the mix takes from each: (s, name, size, target, blocks, quota, lo).

    ``quota`` is the target in blocks of the source's mean length, ``lo`` the quotas of all sources before it.
    """

    sources: DataFrame
    block: int
    rows: int
    count: int
    slots: int

    @property
    def cells(self) -> int:
        return max(_CELLS, self.count)

    def joined(self, table: DataFrame) -> DataFrame:
        """A table with a row or a few for each source, ready for a join."""
        return F.broadcast(table) if self.count <= FEW_SOURCES else table


def _with_targets(sources: DataFrame, share: float, most: float) -> DataFrame:
    """Adds ``target``: `share` of all sizes by ``weight``, none above `most` times its size, the excess reshared.

    A source that a round would give too much is at its limit in all later ones, as the others only get
    more; so a round is one aggregate over the sources, and what is left is a sum and a weight.
    """
    limit = F.col("size") * F.lit(most)
    whole, weight = sources.agg(F.sum("size") * F.lit(share), F.sum("weight")).first()
    rest, at_limit = float(whole or 0), 0
    while True:
        want = F.lit(rest) * F.col("weight") / F.lit(weight or 1.0)
        over = want > limit
        found = sources.agg(F.count_if(over), F.sum(F.when(over, limit)), F.sum(F.when(~over, F.col("weight")))).first()
        if found[0] == at_limit or not found[2]:
            return sources.withColumn("target", F.when(over, limit).otherwise(want))
        rest, weight, at_limit = float(whole) - found[1], found[2], found[0]


def plan_mix(sized: DataFrame, block: int = BLOCK, share: float = SHARE, most: float = MOST, weights: Sequence[float] = WEIGHTS) -> Plan:
    """From (source, size) rows: sources by code point, null last; weights repeat in that order."""
    rows = sized.groupBy(F.col("source").alias("name")).agg(F.sum("size").alias("size"), F.count("*").alias("n"))
    ordered = written(rows.orderBy(F.col("name").asc_nulls_last()), "mix-names")
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("s") % len(weights) + 1).cast("int"))
    numbered = written(number_rows(ordered, 0, "s").withColumn("weight", weight), "mix-order")
    aimed = _with_targets(numbered, share, most).withColumn("blocks", F.ceil(F.col("size") / block))
    quota = F.when(F.col("size") > 0, F.rint(F.col("target") * F.col("blocks") / F.col("size"))).otherwise(0).cast("long")
    aimed = aimed.withColumn("quota", quota).withColumn("all", F.lit(0))
    based = running_bases(aimed, ["all"], "s", "quota").withColumnRenamed("base", "lo")
    sources = written(based.select("s", "name", "size", "target", "blocks", "quota", "lo", "n"), "mix-sources")
    count, slots, n = sources.agg(F.count("*"), F.sum("quota"), F.sum("n")).first()
    return Plan(sources.drop("n"), block, n or 0, count, slots or 0)


def permuted(index: Column, blocks: Column, *key: Column) -> Column:
    """The place of `index` in a pseudorandom permutation of [0, blocks), another one for each key.

    A Feistel network over pairs (left, right) of a grid that just holds all blocks.  The few places of the
    grid beyond the last block are sent through it again, which ends inside after less than the grid's
    width of rounds, and in practice at once.  No number exceeds the grid.
    """
    div = lambda a, b: F.call_function("div", a, b)
    wide = F.greatest(F.ceil(F.sqrt(blocks)), F.lit(1)).cast("long")
    high = div(blocks + wide - 1, wide)

    def once(x: Column) -> Column:
        left, right = F.pmod(x, wide), div(x, wide)
        for i in range(0, ROUNDS, 2):
            left = F.pmod(left + F.pmod(F.xxhash64(right, F.lit(SEED + i), *key), wide), wide)
            right = F.pmod(right + F.pmod(F.xxhash64(left, F.lit(SEED + i + 1), *key), high), high)
        return right * wide + left

    first = once(index)
    again = F.aggregate(F.sequence(F.lit(1), F.lit(WALKS)), first, lambda x, _: F.when(x < blocks, x).otherwise(once(x)))
    return F.when(first < blocks, first).otherwise(again)


def slots(plan: Plan) -> DataFrame:
    """(slot, shard, s, k): the source of every slot of the mix, and the slot's number within the source.

    Draws are hashes of the slot's number and the seed, so reruns agree.
    """
    spark = plan.sources.sparkSession
    unit = F.shiftrightunsigned(F.xxhash64("slot", F.lit(SEED)), 11) / F.lit(float(1 << 53)) * plan.slots
    width = max(plan.slots, 1) / plan.cells
    drawn = spark.range(plan.slots).select(F.col("id").alias("slot"), F.floor(F.col("id") / SHARD).alias("shard"), unit.alias("u"))
    drawn = drawn.withColumn("cell", F.floor(F.col("u") / width))
    shares = plan.sources.where("quota > 0").select("s", F.col("lo").cast("double").alias("lo"), (F.col("lo") + F.col("quota")).cast("double").alias("hi"))
    shares = shares.withColumn("cell2", F.explode(F.sequence(F.floor(F.col("lo") / width), F.floor(F.col("hi") / width))))
    picked = drawn.join(plan.joined(shares), (F.col("cell") == F.col("cell2")) & (F.col("u") >= F.col("lo")) & (F.col("u") < F.col("hi")))
    picked = picked.select("slot", "shard", "s")
    counts = picked.groupBy("shard", "s").agg(F.count("*").alias("n"))
    bases = written(running_bases(counts, ["s"], "shard", "n"), "mix-shards")
    place = F.row_number().over(Window.partitionBy("shard", "s").orderBy("slot")) - 1
    numbered = picked.withColumn("place", place).join(bases.select("shard", "s", "base"), ["shard", "s"])
    numbered = numbered.select("slot", "shard", "s", (F.col("base") + F.col("place")).alias("k"))
    # What a source drew beyond its quota, numbered across sources, fills the other sources' gaps.
    drew = plan.sources.select("s", "quota").join(bases.groupBy("s").agg(F.sum("n").alias("drawn")), "s", "left").withColumn("drawn", F.coalesce("drawn", F.lit(0)))
    drew = drew.withColumn("all", F.lit(0)).withColumn("over", F.greatest(F.col("drawn") - F.col("quota"), F.lit(0))).withColumn("under", F.greatest(F.col("quota") - F.col("drawn"), F.lit(0)))
    drew = running_bases(drew, ["all"], "s", "over").withColumnRenamed("base", "at")
    drew = written(running_bases(drew, ["all"], "s", "under").withColumnRenamed("base", "fill"), "mix-drawn")
    gap_width = max(1, -(-(drew.agg(F.sum("under")).first()[0] or 0) // plan.cells))
    surplus = drew.select("s", "quota", (F.col("at") - F.col("quota")).alias("shift"))
    gap = drew.where("under > 0").select(F.col("s").alias("s2"), F.col("fill").alias("lo"), (F.col("fill") + F.col("under")).alias("hi"), F.col("drawn").alias("first"))
    gap = gap.withColumn("cell2", F.explode(F.expr(f"sequence(lo div {gap_width}, (hi - 1) div {gap_width})")))
    ranked = numbered.join(plan.joined(surplus), "s")
    over = F.when(F.col("k") >= F.col("quota"), F.col("k") + F.col("shift"))
    ranked = ranked.withColumn("r", over).withColumn("cell", F.expr(f"r div {gap_width}"))
    moved = ranked.join(plan.joined(gap), (F.col("cell") == F.col("cell2")) & (F.col("r") >= F.col("lo")) & (F.col("r") < F.col("hi")), "left")
    return moved.select("slot", "shard", F.coalesce("s2", "s").alias("s"), F.when(F.col("s2").isNull(), F.col("k")).otherwise(F.col("first") + F.col("r") - F.col("lo")).alias("k"))


def taken_blocks(plan: Plan) -> DataFrame:
    """(s, block, turn, slot): the block that each slot takes, and how often the source was gone through before."""
    table = plan.joined(plan.sources.where("blocks > 0").select("s", "blocks"))
    found = slots(plan).join(table, "s").withColumn("turn", F.expr("k div blocks"))
    return found.select("s", permuted(F.expr("k % blocks"), F.col("blocks"), F.col("s"), F.col("turn")).alias("block"), "turn", "slot")


def lines(sized: DataFrame, plan: Plan, keys: list[str]) -> DataFrame:
    """Rows of `sized` with ``s`` and ``start``, the row's first word on its source's line.

    Rows are dealt to groups by the hash of `keys`; a window numbers one group.  Rows that agree in all
    keys are one row with their number first and become several again afterwards, so that a repeated
    row, however frequent, is never sorted as such.
    """
    rows = sized.groupBy("source", "size", *keys).agg(F.count("*").alias("copies"))
    groups = max(1, plan.rows // GROUP)
    rows = rows.join(plan.joined(plan.sources.select("s", "name")), F.col("source").eqNullSafe(F.col("name"))).drop("name")
    rows = written(rows.withColumn("bucket", F.pmod(F.xxhash64(*keys), F.lit(groups))), "mix-lines")
    words = F.col("size") * F.col("copies")
    totals = running_bases(rows.groupBy("s", "bucket").agg(F.sum(words).alias("n")), ["s"], "bucket", "n")
    within = F.sum(words).over(Window.partitionBy("s", "bucket").orderBy(*keys, "size")) - words
    placed = rows.withColumn("within", within).join(totals.select("s", "bucket", "base"), ["s", "bucket"])
    copy = F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1))
    return placed.withColumn("copy", copy).withColumn("start", F.col("base") + F.col("within") + F.col("copy") * F.col("size")).select(*keys, "source", "size", "s", "start", "copy")


def _sized(df: DataFrame, id_col: str, text_col: str, source_col: str) -> DataFrame:
    text = F.col(f"`{text_col}`").cast("string")
    return df.select(F.col(f"`{id_col}`").alias("id"), row_hash(df).alias("key"), F.col(f"`{source_col}`").cast("string").alias("source"), word_count(text).alias("size"))


def _cover(placed: DataFrame, plan: Plan) -> DataFrame:
    """Non-empty rows with each block that they touch, and the words of it that are theirs."""
    block = F.explode(F.expr(f"sequence(start div {plan.block}, (start + size - 1) div {plan.block})")).alias("block")
    cut = placed.where("size > 0").select("s", "start", "size", block)
    first = F.greatest(F.col("start"), F.col("block") * plan.block)
    last = F.least(F.col("start") + F.col("size"), (F.col("block") + 1) * plan.block)
    return cut.select("s", "start", "block", (first - F.col("start")).alias("first"), (last - F.col("start")).alias("last"))


def mixed(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", block: int = BLOCK) -> DataFrame:
    """A row for each row of `df`: id, size in words, its source's size and target, and the words the mix takes.

    A null text has size 0 and gives nothing; a null source is a source of its own, the last.  A source
    gives its quota of blocks, so its taken words are within a block of the target, and no document is
    taken beyond twice its size.  Repeated rows take turns on the line, each with its own taken words.
    An empty table gives an empty result; other columns don't matter.
    """
    sized = written(_sized(df, id_col, text_col, source_col), "mix-sizes")
    plan = plan_mix(sized, block)
    placed = written(lines(sized, plan, ["id", "key"]), "mix-placed")
    times = taken_blocks(plan).groupBy("s", "block").agg(F.count("*").alias("times"))
    taken = _cover(placed, plan).join(times, ["s", "block"]).groupBy("s", "start").agg(F.sum((F.col("last") - F.col("first")) * F.col("times")).alias("taken"))
    by_source = plan.joined(plan.sources.select("s", F.col("size").alias("source_size"), "target"))
    found = placed.join(taken.withColumnsRenamed({"s": "s2", "start": "start2"}), (F.col("s") == F.col("s2")) & (F.col("start") == F.col("start2")) & (F.col("size") > 0), "left")
    found = found.join(by_source, "s")
    return found.select(F.col("id").alias(id_col), "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"))


def mixture(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", block: int = BLOCK) -> DataFrame:
    """The mix itself, in the columns of `df`: a row for each stretch of a document that is taken in one turn.

    A document taken whole keeps its text as it is; a stretch is its words, joined by spaces.  ``n_chars``,
    if there, is counted anew for stretches.  Documents without words, and null texts, are not taken.  A
    row is told by its id and a hash of all its columns: rows that differ in any column are documents of
    their own, repeated rows take turns on the line.  Columns keep their values whatever their names.
    """
    sized = written(_sized(df, id_col, text_col, source_col), "mix-sizes")
    plan = plan_mix(sized, block)
    placed = written(lines(sized, plan, ["id", "key"]), "mix-placed")
    pieces = _cover(placed, plan).join(taken_blocks(plan).select("s", "block", "turn"), ["s", "block"])
    # Neighbouring blocks of one turn join into a stretch: a block belongs to its distance from its number among them.
    order = Window.partitionBy("s", "start", "turn").orderBy("block")
    run = pieces.withColumn("run", F.col("block") - F.row_number().over(order))
    stretches = run.groupBy("s", "start", "turn", "run").agg(F.min("first").alias("first"), F.max("last").alias("last"))
    per_row = stretches.groupBy("s", "start").agg(F.collect_list(F.struct("first", "last")).alias("stretches"))
    # A copy of a repeated row has a row of its own here, so no array holds what all of them take.
    keyed = placed.where("size > 0").join(per_row, ["s", "start"]).select("id", "key", "stretches")
    text = F.col(f"`{text_col}`").cast("string")
    rows = df.select(F.col(f"`{id_col}`").alias("i"), row_hash(df).alias("k"), text.alias("t"), whole_row(df).alias("row"))
    rows = rows.dropDuplicates(["i", "k"]) if _repeated(placed) else rows
    words = F.regexp_extract_all(F.col("t"), F.lit(f"({WORD_PATTERN})"))
    cut = rows.join(keyed, F.col("i").eqNullSafe(F.col("id")) & (F.col("k") == F.col("key"))).withColumn("words", words).withColumn("x", F.explode("stretches"))
    whole = (F.col("x.first") == 0) & (F.col("x.last") == F.size("words"))
    piece = F.when(whole, F.col("t")).otherwise(F.array_join(F.slice("words", F.col("x.first").cast("int") + 1, (F.col("x.last") - F.col("x.first")).cast("int")), " "))
    made = cut.select("row", piece.alias("piece"))
    row = F.col("row").withField(f"`{text_col}`", F.col("piece"))
    if "n_chars" in df.columns:
        row = row.withField("n_chars", F.length("piece").cast(df.schema["n_chars"].dataType))
    return made.select(row.alias("row")).select("row.*")


def _repeated(placed: DataFrame) -> bool:
    return placed.where("copy > 0").limit(1).count() > 0
