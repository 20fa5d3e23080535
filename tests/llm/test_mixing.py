import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from ledgerlift.llm import mixing
from ledgerlift.llm.common import prepared
from tests.llm.conftest import words


def targets(sizes, weights, share=1.5, most=2.0):
    """The plain version: round by round, those above their limit get it and the others share the rest."""
    given, left = {}, list(range(len(sizes)))
    while left:
        rest, weight = share * sum(sizes) - sum(given.values()), sum(weights[i] for i in left)
        over = [i for i in left if rest * weights[i] / weight > most * sizes[i]]
        given |= {i: most * sizes[i] for i in over} if over else {i: rest * weights[i] / weight for i in left}
        left = [i for i in left if i not in given]
    return [given[i] for i in range(len(sizes))]


def planned(spark, sizes, **options):
    frame = prepared(spark).createDataFrame([(f"s{i:03d}", n) for i, n in enumerate(sizes)], "source string, size long")
    return mixing.plan_mix(frame, **options)


@pytest.mark.parametrize("seed", range(4))
def test_targets_equal_the_plain_version(spark, seed):
    picker = random.Random(seed)
    sizes = [[100, 10, 1000, 0], [0, 0], [5], [int(10 ** picker.uniform(0, 6)) for _ in range(60)]][seed]
    rows = planned(spark, sizes).sources.orderBy("s").collect()
    want = targets(sizes, [(3, 1, 2)[i % 3] for i in range(len(sizes))])
    assert [r["target"] for r in rows] == pytest.approx(want) and [r["size"] for r in rows] == sizes
    assert [r["s"] for r in rows] == list(range(len(sizes)))
    assert [r["lo"] for r in rows] == [sum(q["quota"] for q in rows[:i]) for i in range(len(rows))]


def test_sources_without_end(spark, monkeypatch):
    """Far more sources than are broadcast: nothing about them is listed on the driver."""
    monkeypatch.setattr(mixing, "FEW_SOURCES", 100)
    frame = prepared(spark).range(30_000).select(F.col("id").alias("doc_id"), F.concat(F.lit("w "), "id").alias("text"), F.concat(F.lit("s"), F.col("id") % 20_000).alias("source"))
    got = mixing.mixed(frame)
    totals = got.agg(F.count("*"), F.sum("size"), F.sum("taken"), F.max(F.col("taken") - 2 * F.col("size")), F.sum(F.col("target") / F.when(F.col("source_size") == 4, 2).otherwise(1))).first()
    assert totals[0] == 30_000 and totals[1] == 60_000 and totals[3] <= 0
    # A block of each source is taken once or twice; its share of the target is rounded to blocks.
    assert abs(totals[4] - 90_000) < 1 and 60_000 <= totals[2] <= 120_000


def test_few_and_many_sources_take_alike(corpus, monkeypatch):
    frame, _ = corpus
    few = sorted(mixing.mixed(frame).collect())
    monkeypatch.setattr(mixing, "FEW_SOURCES", 0)
    assert sorted(mixing.mixed(frame).collect()) == few


@pytest.fixture
def corpus(spark):
    rows = [(i, words(i, 20 + 37 * i % 300), ["b", "a", None, "ä"][i % 4] if i % 3 else "b", "x") for i in range(240)]
    return prepared(spark).createDataFrame(rows, "doc_id long, text string, source string, taken string"), rows


def test_mix_follows_the_targets_and_reruns_agree(corpus):
    frame, rows = corpus
    got = sorted(mixing.mixed(frame).collect())
    assert got == sorted(mixing.mixed(frame.repartition(7)).collect())
    assert [r["size"] for r in got] == [len(r[1].split()) for r in rows]
    by_source = defaultdict(list)
    for r, row in zip(got, rows):
        assert 0 <= r["taken"] <= 2 * r["size"]
        by_source[row[2]].append(r)
    order = sorted(by_source, key=lambda s: (s is None, (s or "").encode()))
    sizes = [sum(r["size"] for r in by_source[s]) for s in order]
    for source, size, target in zip(order, sizes, targets(sizes, [3, 1, 2, 3])):
        taken = sum(r["taken"] for r in by_source[source])
        assert {(r["source_size"], r["target"]) for r in by_source[source]} == {(size, target)}
        assert abs(taken - target) <= 2 * mixing.BLOCK


def test_mixture_holds_what_is_taken(corpus):
    frame, rows = corpus
    out = mixing.mixture(frame).collect()
    found = defaultdict(int)
    texts = {r[0]: r[1] for r in rows}
    for r in out:
        assert f" {r['text']} " in f" {texts[r['doc_id']]} "
        found[r["doc_id"]] += len(r["text"].split())
    assert dict(found) == {r["doc_id"]: r["taken"] for r in mixing.mixed(frame).collect() if r["taken"]}


def test_odd_rows(odd, odd_rows, nothing):
    got = mixing.mixed(odd).collect()
    assert len(got) == len(odd_rows) and all(0 <= r["taken"] <= 2 * r["size"] for r in got)
    total = sum(r["taken"] for r in got)
    assert total == sum(len(r["text"].split()) for r in mixing.mixture(odd).collect())
    assert mixing.mixed(nothing).collect() == mixing.mixture(nothing).collect() == []


def permutation(spark, blocks, ids, turn):
    rows = spark.range(*ids).select("id", mixing.permuted(F.col("id"), F.lit(blocks).cast("long"), F.lit(3), F.lit(turn)).alias("p"))
    return [r["p"] for r in rows.orderBy("id").collect()]


@pytest.mark.parametrize("blocks", [1, 2, 3, 7, 64, 97, 1000, 9991])
def test_permutations(spark, blocks):
    first, second = (permutation(spark, blocks, (blocks,), turn) for turn in (0, 1))
    assert sorted(first) == sorted(second) == list(range(blocks))
    assert blocks < 64 or (first != second and first != sorted(first))
    # No stride: the steps between neighbours are many.
    assert blocks < 64 or len({b - a for a, b in zip(first, first[1:])}) > blocks // 4


@pytest.mark.parametrize("blocks", [10**10, 10**12 + 39, 2**50])
def test_permutations_of_many_blocks(spark, blocks):
    """Numbers stay within 64 bits: 10^12 blocks of 64 words are some 400 TB of text."""
    got = permutation(spark, blocks, (blocks - 3000, blocks), 0)
    assert len(set(got)) == 3000 and min(got) >= 0 and max(got) < blocks
    assert sum(x < blocks // 2 for x in got) in range(1300, 1700)


def test_rows_that_differ_in_any_column_all_come_out(spark):
    rows = [(1, words(1, 300), "a", lang) for lang in ("aa", "bb", "aa", "aa")] + [(2, words(2, 300), "b", "cc")]
    frame = prepared(spark).createDataFrame(rows, "doc_id long, text string, source string, lang string")
    out = mixing.mixture(frame).collect()
    count = lambda lang: sum(len(r["text"].split()) for r in out if r["lang"] == lang)
    assert {r["lang"] for r in out} == {"aa", "bb", "cc"} and count("aa") >= 2 * count("bb") - 128
    assert sum(map(count, ("aa", "bb", "cc"))) == sum(r["taken"] for r in mixing.mixed(frame).collect())
