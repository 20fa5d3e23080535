import itertools
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from ledgerlift.functions import key_text, predicates
from ledgerlift.operators import dedupe, joins, latest, merge, postings, profile, reconcile, reshape
from ledgerlift.operators.reshape import Pair


def test_keep_newest_orderings(frame, values):
    df = frame("k string, id int, updated_at int, created_at int", ("a", 1, None, 5), ("a", 2, 3, 1))
    by_creation = dedupe.keep_newest(df, ["k"], fall_back_to_created=True)
    by_update = dedupe.keep_newest(df, ["k"])
    assert values(by_creation, "id") == [(1,)]
    assert values(by_update, "id") == [(2,)]


def test_keep_first_and_last_upload(frame, values):
    df = frame("k string, row int", ("a", 9), ("a", 4), ("a", 7), (None, 1), (None, 2))
    assert values(dedupe.keep_first_upload(df, "k", "row", "row"), "row") == [(1,), (2,), (4,)]
    assert values(dedupe.keep_first_upload(df, "k", "row"), "row") == [(1,), (2,), (4,)]
    assert values(dedupe.keep_last_upload(df.filter("k is not null"), ["k"], "row"), "row") == [(9,)]


def test_group_limit_runs_before_the_exchange(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), "id")
    plan = dedupe.keep_first(df, ["k"], [F.col("id").asc()])._jdf.queryExecution().executedPlan().toString()
    assert plan.index("WindowGroupLimit") < plan.rindex("WindowGroupLimit")


def test_duplicate_surplus(frame, values):
    keys = frame("k string", *[(k,) for k in "aaabbc"])
    assert values(dedupe.duplicate_surplus(keys, ["k"])) == [(3,)]
    assert values(dedupe.duplicate_surplus(keys.filter("k = 'c'"), ["k"])) == [(0,)]
    assert len(values(dedupe.duplicate_listing(keys, ["k"]))) == 5


def test_lookup_never_multiplies_rows(frame, values):
    df = frame("k string", (" A",), ("b",), ("z",), (None,))
    dim = frame("k string, name string", ("a", "two"), ("A ", "one"), ("b", "bee"))
    assert values(joins.lookup(df, dim, "k", "k", {"name": "name"}), "k", "name") == [
        (" A", "one"),
        ("b", "bee"),
        ("z", None),
        (None, None),
    ]
    assert ("z", "z") in values(joins.lookup(df, dim, "k", "k", {"name": "name"}, miss="raw"), "k", "name")


def test_blank_numbers_do_not_match_each_other(frame, values):
    left, right = frame("k string", ("",), (None,)), frame("k string, id int", ("", 1), (None, 2))
    assert values(joins.lookup(left, right, "k", "k", {"id": "id"}), "id") == [(None,), (None,)]


def test_lookup_hot_equals_lookup(spark, values):
    df = spark.range(5000).select(
        F.when(F.col("id") % 3 == 0, F.lit(7)).when(F.col("id") % 11 != 0, F.col("id") % 40).alias("k"), "id"
    )
    dim = spark.range(30).select(F.col("id").alias("d"), (F.col("id") * 10).alias("v"))
    hot = joins.lookup_hot(df, dim, "k", "d", {"v": "v"}, parts=8)
    plain = joins.lookup(df, dim, "k", "d", {"v": "v"}, normalise=None)
    assert values(hot, "k", "id", "v") == values(plain, "k", "id", "v")


def test_only_hot_keys_are_replicated(spark, values):
    df = spark.range(20_000).select(F.when(F.col("id") % 3 == 0, F.lit(7)).when(F.col("id") % 3 == 1, F.col("id")).otherwise(F.lit(None)).alias("k"), "id")
    hot = joins.hot_keys(df, "k")
    assert hot.collect() == [([7],)]
    dim = spark.range(5000).select(F.col("id").alias("d"))
    side = joins.replicated(dim, "d", hot, 16, "part")
    assert side.count() == 5000 + 15 and side.where("d = 7").count() == 16
    assert joins.hot_keys(df.where("false"), "k").collect() == [([],)]


def test_hot_keys_of_skewed_texts_are_all_found(spark):
    """Every key above the share is listed, in whatever partitions its rows are."""
    df = spark.range(50_000).select(F.concat(F.lit("k"), F.floor(F.sqrt(F.col("id") % 5000)).cast("string")).alias("k")).repartition(13)
    counts = {r["k"]: r["n"] for r in df.groupBy("k").agg(F.count(F.lit(1)).alias("n")).collect()}
    found = set(joins.hot_keys(df, "k", 1 / 64).first()["hot"])
    assert {k for k, n in counts.items() if n >= 50_000 / 64} <= found <= {k for k, n in counts.items() if n >= 0.9 * 50_000 / 64}


def test_digests_find_the_leaves_that_differ(spark, values):
    source = spark.range(150_000).select((F.col("id") % 149_000).alias("k"), F.when(F.col("id") % 5 > 0, F.col("id") % 7).alias("w"))
    target = source.where("k not in (5, 77)").unionByName(spark.sql("SELECT * FROM VALUES (200000L, 1L), (200001L, NULL), (200002L, 3L) AS t(k, w)")).repartition(5)
    keys = {"k": F.col("k"), "w": F.col("w")}
    plain = values(reconcile.reconcile(source, target, keys, keys))
    assert len(plain) >= 5 and values(reconcile.reconcile_by_digest(source, target, keys, keys)) == plain
    leaves = reconcile.differing(reconcile.digests(source, keys), reconcile.digests(target, keys))
    assert reconcile.suspects(source, keys, leaves).count() + reconcile.suspects(target, keys, leaves).count() < 100
    assert values(reconcile.reconcile_by_digest(source, source.repartition(3), keys, keys)) == []
    # Repeated pairs differ from other repeated pairs, and from a NULL in the other column.
    odd = spark.sql("SELECT * FROM VALUES (1L, NULL), (1L, NULL), (NULL, 2L) AS t(k, w)")
    even = spark.sql("SELECT * FROM VALUES (NULL, 1L), (NULL, 1L), (2L, NULL) AS t(k, w)")
    assert values(reconcile.reconcile_by_digest(odd, even, keys, keys)) == values(reconcile.reconcile(odd, even, keys, keys))


def test_registers_converge_in_any_order(spark, frame, values):
    uploads = [
        frame("k int, a string, b string, at int", (1, "a1", None, 1), (2, "x", "y", 1), (1, "a1b", None, 2)),
        frame("k int, a string, b string, at int", (1, None, "b2", 5), (3, "n", None, 5), (None, "z", "z", 5)),
        frame("k int, a string, b string, at int", (1, "a3", "b3", 4), (2, None, "late", 0)),
    ]
    tables = set()
    for order in itertools.permutations([0, 1, 2, 0]):
        table = None
        for i in order:
            new = latest.registers(uploads[i], ["k"], ["a", "b"], "at")
            table = new if table is None else latest.combined(table, new, ["k"])
        tables.add(tuple(values(latest.values(table, ["k"]))))
    assert tables == {((1, "a3", "b2"), (2, "x", "y"), (3, "n", None))}


def test_search_by_postings_equals_the_scan(spark, tmp_path, values):
    picker = random.Random(4)
    text = lambda: "".join(picker.choice("abAB c%é") for _ in range(picker.randrange(9)))
    rows = [(i, text(), text() if i % 5 else None) for i in range(400)] + [(None, "abc", "abc"), (401, "", "")]
    df = spark.createDataFrame(rows, "id int, name string, brand string")
    index = postings.stored(postings.postings(df, "id", ["name", "brand"]), str(tmp_path / "index"))
    for needle in ["a", "B ", "ab", "abc", "a%", "é", "bab", "aba b", "zzz", "", None, "  "]:
        for other in [None, "a", "b c"]:
            want = predicates.search(df, name=needle, brand=other)
            assert values(postings.search_indexed(df, index, "id", name=needle, brand=other)) == values(want)
    held = postings.candidates(index, name="bab").count()
    assert held < 60 and postings.candidates(index, name=" ", brand=None) is None


def test_search_names_a_few_candidates_and_joins_many(spark, tmp_path, monkeypatch, values):
    df = spark.range(500).select("id", F.concat(F.lit("item "), "id").alias("name"))
    index = postings.stored(postings.postings(df, "id", ["name"]), str(tmp_path / "index"))
    plan = lambda d: d._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan(postings.search_indexed(df, index, "id", name="m 499"))
    monkeypatch.setattr(postings, "FEW", 3)
    many = postings.search_indexed(df, index, "id", name="m 4")
    assert "Join" in plan(many) and many.count() == 111


def test_existence_with_null_keys(frame, values):
    a, b = frame("x string", ("p",), (None,)), frame("y string", (None,), (None,))
    assert values(joins.having(a, b, [("x", "y")], null_safe=True)) == [(None,)]
    assert values(joins.having(a, b, [("x", "y")])) == []
    assert len(values(joins.lacking(a, b, [("x", "y")]))) == 2


def test_either_key_and_cross_one(frame, values):
    dim = frame("id int, code string, label string", (1, "A", "CLASS A"), (2, "B", "B"))
    assert values(joins.either_key(dim, ["code", "label"], {"id": "id"})) == [("A", 1), ("B", 2), ("CLASS A", 1)]
    assert len(values(joins.cross_one(dim, frame("v int", (5,))))) == 2
    assert values(joins.cross_one(dim, frame("v int"))) == []
    with pytest.raises(Exception, match="at most one row"):
        joins.cross_one(dim, frame("v int", (5,), (6,))).collect()


POLICIES = {
    "incoming": (merge.INCOMING, lambda o, n: n if n is not None else o),
    "existing": (merge.EXISTING, lambda o, n: o if o is not None else n),
    "overwrite": (merge.OVERWRITE, lambda o, n: n),
    "keep": (merge.KEEP, lambda o, n: o),
    "constant": (merge.constant("C"), lambda o, n: "C"),
    "clean": (merge.CLEAN_NAME, lambda o, n: n if o and ("," in o or "|" in o) else (o if o is not None else n)),
}


@pytest.mark.parametrize("plan", ["outer", "in_place"])
@pytest.mark.parametrize("policy", POLICIES)
def test_policy_matrix(frame, values, policy, plan):
    """Every combination of old and new, matched and not, under both plans."""
    rule, expected = POLICIES[policy]
    options = (None, "a", "x, y")
    pairs = list(itertools.product(options, options))
    old = [(i, o) for i, (o, _) in enumerate(pairs)] + [(100, "only old"), (101, None)]
    new = [(i, n) for i, (_, n) in enumerate(pairs)] + [(200, "only new"), (201, None)]
    target, source = frame("k int, v string", *old), frame("k int, v string", *new)
    merged = merge.merge_into(target, source, ["k"], {"v": rule}, plan=plan)
    want = [(i, expected(o, n), "update") for i, (o, n) in enumerate(pairs)]
    want += [(100, "only old", "keep"), (101, None, "keep"), (200, "only new", "insert"), (201, None, "insert")]
    assert Counter(values(merged, "k", "v", "_action")) == Counter(want)


@pytest.mark.parametrize("plan", ["outer", "in_place"])
def test_merge_modes_flags_and_one_sided_columns(frame, values, plan):
    target = frame("k int, f boolean, old string", (1, True, "o"), (2, None, "o"))
    source = frame("k int, f boolean, new string", (1, False, "n"), (3, None, "n"))
    merged = merge.merge_into(target, source, ["k"], {"f": merge.EITHER}, plan=plan)
    assert values(merged, "k", "f", "old", "new", "_action") == [
        (1, True, "o", "n", "update"),
        (2, None, "o", None, "keep"),
        (3, None, None, "n", "insert"),
    ]
    inserted = merge.merge_into(target, source, ["k"], mode="insert", plan=plan)
    assert values(inserted, "k", "f", "new", "_action") == [(1, True, None, "keep"), (2, None, None, "keep"), (3, None, "n", "insert")]
    updated = merge.merge_into(target, source, ["k"], mode="update", plan=plan)
    assert values(updated, "k", "new", "_action") == [(1, "n", "update"), (2, None, "keep")]


@pytest.mark.parametrize("plan", ["outer", "in_place"])
def test_null_tolerant_slot_key_is_stable(frame, values, plan):
    target = frame("slot string, cap int, fee int", ("A ", None, 1))
    source = frame("slot string, cap int, fee int", ("a", None, 2))
    match = {"slot": key_text, "cap": lambda c: c}
    once = merge.merge_into(target, source, ["slot", "cap"], match_on=match, unique_source=True, plan=plan)
    assert values(once, "slot", "cap", "fee", "_action") == [("A ", None, 2, "update")]
    twice = merge.merge_into(once.drop("_action"), source, ["slot", "cap"], match_on=match, unique_source=True, plan=plan)
    assert values(twice, "slot", "cap", "fee", "_action") == [("A ", None, 2, "update")]


def test_duplicate_source_keys_are_refused(frame):
    target = frame("k int, v int", (1, 1))
    with pytest.raises(merge.DuplicateKeys, match="1 surplus"):
        merge.merge_into(target, frame("k int, v int", (1, 2), (1, 3)), ["k"])
    with pytest.raises(merge.DuplicateKeys, match="1 rows without key"):
        merge.merge_into(target, frame("k int, v int", (None, 2)), ["k"])


def test_copy_rows_is_idempotent(frame, values):
    config = frame("cat string, rule string", ("a", "r1"), ("a", "r2"), ("b", "r1"))
    once = merge.copy_rows(config, "cat", "a", "b", ["rule"])
    assert Counter(r[2] for r in values(once)) == {"keep": 3, "insert": 1}
    twice = merge.copy_rows(once.drop("_action"), "cat", "a", "b", ["rule"])
    assert Counter(r[2] for r in values(twice)) == {"keep": 4}


def test_unpivot_counts_surviving_pairs(frame, values):
    wide = frame(
        "id int, a string, afilename string, b string, bfilename string, c string, cfilename string",
        (1, "5", "f1", "", "f2", "7.0", " f3 "),
        (2, None, None, "x", "f", None, "nan"),
    )
    long = reshape.unpivot_pairs(wide, reshape.detect_pairs(wide.columns), ["id"])
    assert values(long, "id", "document_name", "file_name", "documents_order", "logic_doc_id") == [
        (1, "A", "f1", 1, 5),
        (1, "C", "f3", 2, 7),
    ]
    fixed = reshape.unpivot_pairs(wide, reshape.detect_pairs(wide.columns), ["id"], need_id=False, fixed_order=True)
    assert values(fixed, "id", "documents_order") == [(1, 1), (1, 2), (1, 3), (2, 2)]
    assert reshape.unpivot_pairs(wide, [Pair("nope", "nopefilename", "N")], ["id"]).count() == 0


def test_detect_pairs():
    columns = ["tin", "tinfilename", "cocfilename", "coc_id", "x", "x_filename", "lonefilename"]
    assert reshape.detect_pairs(columns) == [
        Pair("tin", "tinfilename", "TIN"),
        Pair("coc_id", "cocfilename", "COC"),
        Pair("x", "x_filename", "X_"),
        Pair(None, "lonefilename", "LONE"),
    ]


def test_many_pairs_in_one_row(spark):
    """Several hundred pairs stay one projection."""
    columns = {f"a{i}": F.lit(str(i)) for i in range(300)} | {f"a{i}filename": F.lit("f") for i in range(300)}
    wide = spark.range(3).withColumns(columns)
    long = reshape.unpivot_pairs(wide, reshape.detect_pairs(wide.columns), ["id"])
    assert long.agg(F.count(F.lit(1)), F.max("documents_order"), F.sum("logic_doc_id")).first()[:] == (900, 300, 3 * sum(range(300)))


def test_profile_reports_account_for_every_row(frame, values):
    df = frame("id int, a string, b string", (1, None, "x"), (2, "y", None), (3, None, None), (4, "y", "x"))
    marked = profile.with_reason(df, {"no_a": F.col("a").isNull(), "no_b": F.col("b").isNull()})
    assert values(profile.skip_report(marked, ["no_a", "no_b"])) == [(4, 1, 3, 2, 1)]
    assert values(profile.fill_rate(df), "column_name", "nulls", "non_nulls") == [("a", 2, 2), ("b", 2, 2), ("id", 0, 4)]
    assert values(profile.funnel(df, {"all": F.lit(True), "a": F.col("a") == "y", "b": F.col("b") == "x"})) == [(4, 2, 1)]
    broken = profile.rejects(df, {"null_a": ("a", F.col("a").isNull()), "x_b": ("b", F.col("b") == "x")}, "id")
    assert values(broken) == [(1, "null_a", "a", None), (1, "x_b", "b", "x"), (3, "null_a", "a", None), (4, "x_b", "b", "x")]
    assert profile.column_presence([" A ", "c"], ["a", "b"]) == {"found": ["a"], "missing": ["b"], "unused": ["c"], "renamed": [" A "]}


def test_reconcile(frame, values):
    a, b = frame("k int, n string", (1, None), (2, "x"), (3, "x")), frame("k int, n string", (2, "x"), (3, "y"), (1, None))
    keys = {"k": F.col("k"), "n": F.col("n")}
    assert values(reconcile.reconcile(a, b, keys, keys)) == [(3, "x", "missing"), (3, "y", "extra")]


def test_missing_within_tolerance_matches_brute_force(spark):
    source = [(i % 3, i * 0.0037) for i in range(200)]
    target = [(i % 3, i * 0.0181) for i in range(40)]
    want = sorted((k, x) for k, x in source if not any(k == j and abs(x - y) < 0.01 for j, y in target))
    s, t = spark.createDataFrame(source, "k int, x double"), spark.createDataFrame(target, "tk int, y double")
    found = reconcile.missing_within(s, t, {"k": (F.col("k"), F.col("tk"))}, (F.col("x"), F.col("y")), 0.01)
    assert sorted(tuple(r) for r in found.collect()) == want


@pytest.mark.parametrize("plan", ["outer", "in_place"])
def test_target_rows_without_key_are_kept(frame, values, plan):
    target = frame("k int, j int, v string", (None, 1, "a"), (None, 1, "a"), (1, None, "b"), (1, 1, "c"))
    source = frame("k int, j int, v string", (1, 1, "new"))
    merged = merge.merge_into(target, source, ["k", "j"], plan=plan)
    assert Counter(values(merged, "v", "_action")) == Counter([("a", "keep"), ("a", "keep"), ("b", "keep"), ("new", "update")])


def test_rows_without_key_do_not_share_a_task(spark):
    """Half of the rows have no key; after a shuffled lookup no partition holds them all."""
    df = spark.range(4000).select("id", F.when(F.col("id") % 2 == 0, F.col("id")).alias("k"))
    dim = spark.range(4000).select(F.col("id").alias("d"), F.lit("x").alias("v"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    try:
        joined = joins.lookup(df, dim, "k", "d", {"v": "v"}, normalise=None)
        # Using `v` keeps the optimizer from dropping the join.
        placed = joined.select("k", "v", F.spark_partition_id().alias("p"))
        sizes = placed.filter("k is null").groupBy("p").agg(F.count(F.lit(1)).alias("n"), F.max("v")).collect()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.shuffle.partitions", "2")
    assert len(sizes) == 8 and sum(r["n"] for r in sizes) == 2000


def test_duplicate_listing_lists_null_keys(frame, values):
    df = frame("a string, b int, v int", ("x", None, 1), ("x", None, 2), ("y", 1, 3), (None, None, 4), (None, None, 5))
    assert values(dedupe.duplicate_listing(df, ["a", "b"]), "v", "copies") == [(1, 2), (2, 2), (4, 2), (5, 2)]


def test_lookup_prefers_a_row_with_a_value(frame, values):
    df, dim = frame("k string", ("a",)), frame("k string, v string", ("a", None), ("A", "filled"))
    assert values(joins.lookup(df, dim, "k", "k", {"v": "v"}), "v") == [("filled",)]


def test_duplicate_slots_are_refused_in_their_matched_form(frame):
    target = frame("slot string, cap int, fee int")
    source = frame("slot string, cap int, fee int", ("a", None, 1), ("A ", None, 2))
    with pytest.raises(merge.DuplicateKeys):
        merge.merge_into(target, source, ["slot", "cap"], match_on={"slot": key_text, "cap": lambda c: c})
    with pytest.raises(merge.DuplicateKeys):
        merge.merge_into(target, source, ["slot"], fold={"slot": key_text})
    with pytest.raises(ValueError, match="unknown plan"):
        merge.merge_into(target, source, ["fee"], plan="auto")


@pytest.mark.parametrize("plan", ["outer", "in_place"])
def test_folded_keys_match_and_null_matches_nothing(frame, values, plan):
    target = frame("k string, v int", ("W-1", 1), (None, 2))
    source = frame("k string, v int", ("w-1", 10), ("w-2", 20))
    merged = merge.merge_into(target, source, ["k"], fold={"k": F.lower}, plan=plan)
    assert values(merged, "k", "v", "_action") == [("W-1", 10, "update"), ("w-2", 20, "insert"), (None, 2, "keep")]


def test_rows_without_key_are_spread_whatever_their_first_columns(spark):
    df = spark.range(1000).select(F.lit(1).alias("a"), F.lit(None).cast("int").alias("k"), F.col("id").alias("n"))
    assert df.select(joins.spread_nulls(F.col("k"), df.columns)).distinct().count() == 1000
