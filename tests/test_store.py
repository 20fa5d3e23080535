import functools
import glob
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlift.functions.text import key_text
from ledgerlift.operators.merge import ACTION, merge_into
from ledgerlift.plans import people
from ledgerlift.sources.store import ConcurrentWrite, NoVersion, TableStore, Workspace


@pytest.fixture
def store(spark, tmp_path):
    return TableStore(spark, str(tmp_path / "store"), buckets=8)


def files(store, name):
    return {f for f in glob.glob(f"{store.root}/{name}/data/**/*.parquet", recursive=True)}


def test_a_merge_writes_the_buckets_it_touches(store, frame, values):
    store.buckets = 64
    rows = [(i, f"v{i}") for i in range(500)]
    store.merge("t", frame("k int, v string", *rows), ["k"])
    before, first = files(store, "t"), store.manifest("t")
    assert len({p.bucket for p in first.parts}) == 64
    store.merge("t", frame("k int, v string", (7, "new"), (7_000_000, None)), ["k"])
    second = store.manifest("t")
    fresh = [p for p in second.parts if p.version == 2]
    assert 1 <= len(fresh) <= 2 and set(second.parts) - set(fresh) < set(first.parts)
    assert {f.split("/data/")[1].split("/part-")[0] for f in files(store, "t") - before} == {p.path.removeprefix("data/") for p in fresh}
    want = {k: (k, v, "keep") for k, v in rows} | {7: (7, "new", "update"), 7_000_000: (7_000_000, None, "insert")}
    assert sorted(map(tuple, store.read("t").collect())) == sorted(want.values())
    assert (second.rows, dict(second.counts)["insert"], dict(second.counts)["update"]) == (501, 1, 1)


@pytest.mark.parametrize("mode", ["upsert", "insert", "update"])
@pytest.mark.parametrize("form", ["plain", "fold", "match_on"])
def test_merges_equal_the_outer_merge(store, frame, spark, mode, form):
    picker = random.Random(f"{mode}{form}")
    options = {"plain": {}, "fold": {"fold": {"k": key_text}}, "match_on": {"match_on": {"k": key_text}}}[form]
    kept = frame("k string, v int, w string")
    for upload in range(5):
        names = {picker.choice(["a", "B", " c", "D ", "e", "f", "g"]) for _ in range(4)}
        once = list({n.strip().lower(): n for n in names}.values()) + ([None] if form == "match_on" else [])
        source = frame("k string, v int, x string", *[(n, picker.choice([None, picker.randrange(9)]), f"u{upload}") for n in once])
        want = merge_into(kept, source, ["k"], mode=mode, **options)
        store.merge("t", source, ["k"], "k string, v int, w string", mode=mode, **options)
        order = lambda df: sorted(map(str, df.select("k", "v", "w", "x", ACTION).collect()))
        assert order(store.read("t")) == order(want)
        kept = spark.createDataFrame(want.drop(ACTION).collect(), want.drop(ACTION).schema)


def test_keys_of_another_type_find_their_bucket(store, frame, values):
    store.merge("t", frame("k bigint, v int", *[(i, 0) for i in range(20)]), ["k"])
    store.merge("t", frame("k int, v int", (3, 1)), ["k"])
    store.merge("t", frame("k string, v int", ("4", 1)), ["k"])
    assert values(store.read("t").where("v = 1"), "k") == [(3,), (4,)] and store.read("t").count() == 20


def test_other_keys_deal_the_table_anew(store, frame, values):
    store.merge("t", frame("k int, n string", (1, "a"), (2, "b")), ["k"])
    store.merge("t", frame("k int, n string", (9, "a")), ["n"])
    assert values(store.read("t"), "k", "n") == [(2, "b"), (9, "a")]
    assert store.manifest("t").keys == ("n",)


def test_one_of_two_writers_fails(store, spark, frame, values, monkeypatch):
    """The second writer commits between the first one's last look and its commit."""
    store.merge("t", frame("k int", (1,)), ["k"])
    other, before = TableStore(spark, store.root, buckets=8), files(store, "t")
    create = type(store._files).create

    def slow(path, text):
        other.merge("t", frame("k int", (2,)), ["k"])
        return create(store._files, path, text)

    monkeypatch.setattr(store._files, "create", slow)
    for attempt in (lambda: store.merge("t", frame("k int", (3,)), ["k"]), lambda: store.replace("t", frame("k int", (4,)))):
        with pytest.raises(ConcurrentWrite):
            attempt()
    monkeypatch.undo()
    assert values(store.read("t"), "k") == [(1,), (2,)] and store.versions("t") == [1, 2, 3]
    # What the loser wrote is gone, as are the names it tried.
    assert {p.path for v in (1, 2, 3) for p in store.manifest("t", v).parts} >= {f.removeprefix(f"{store.root}/t/").split("/part-")[0] for f in files(store, "t")}
    assert len(glob.glob(f"{store.root}/t/log/*")) == 3 and files(store, "t") > before


def test_two_first_writers(store, spark, frame):
    assert store._files.create(f"{store.root}/x/log/1.json", "a") and not store._files.create(f"{store.root}/x/log/1.json", "b")
    assert store._files.text(f"{store.root}/x/log/1.json") == "a"


def test_versions_stay_readable_until_they_expire(store, frame, values):
    for k in range(4):
        store.replace("t", frame("k int", (k,)))
    assert store.names() == ["t"] and values(store.read("t", 2)) == [(1,)]
    assert store.expire("t", keep=1) == [1, 2, 3] and values(store.read("t")) == [(3,)]
    assert len({f.rsplit("/", 1)[0] for f in files(store, "t")}) == 1
    with pytest.raises(NoVersion):
        store.read("t", 2)
    with pytest.raises(NoVersion):
        store.changes("t", keys=["k"])
    store.merge("t", frame("k int", *[(i,) for i in range(30)]), ["k"])
    store.merge("t", frame("k int", (40,)), ["k"])
    store.expire("t", keep=1)
    assert store.read("t").count() == 31  # carried parts of an expired version are still there


def test_columns_change_without_a_data_file(store, frame, values):
    store.merge("t", frame("k int, v int, gone string", *[(i, i, "x") for i in range(20)]), ["k"])
    before = files(store, "t")
    want = T.StructType.fromDDL("v bigint, k int, note string")
    changes = store.align("t", want, {"note": "none"}, drop=["gone"])
    assert [(c.column, c.action) for c in changes] == [("v", "cast"), ("note", "add"), ("gone", "drop")]
    assert files(store, "t") == before and store.align("t", want, {"note": "none"}) == []
    table = store.read("t")
    assert table.schema["v"].dataType == T.LongType() and table.columns == ["v", "k", "note", ACTION]
    store.merge("t", frame("k int, v bigint, note string", (3, 2**40, "seen"), (99, 1, None)), ["k"])
    got = {r["k"]: (r["v"], r["note"]) for r in store.read("t").collect()}
    assert got == {i: (i, "none") for i in range(20)} | {3: (2**40, "seen"), 99: (1, None)}
    # A column of an old name is a new one: what was dropped does not come back.
    store.align("t", T.StructType.fromDDL("k int, gone string"))
    assert {r["gone"] for r in store.read("t").collect()} == {None}
    assert values(store.read("t", 1), "gone")[0] == ("x",)


def test_changes_of_a_commit(store, frame):
    store.merge("t", frame("k int, v string", (1, "a"), (2, "b"), (3, "c")), ["k"])
    store.merge("t", frame("k int, v string", (2, "B"), (3, "c"), (4, "d")), ["k"])
    store.replace("t", store.read("t").where("k <> 1").drop(ACTION))
    seen = lambda v: sorted((r["_change"], r["k"], r["before"] and r["before"]["v"], r["after"] and r["after"]["v"]) for r in store.changes("t", v).collect())
    assert seen(1) == [("insert", 1, None, "a"), ("insert", 2, None, "b"), ("insert", 3, None, "c")]
    assert seen(2) == [("insert", 4, None, "d"), ("update", 2, "b", "B")]
    assert seen(3) == [("delete", 1, "a", None)]
    store.align("t", T.StructType.fromDDL("k int, v string, w int"))
    assert store.changes("t", keys=["k"]).count() == 0


def test_an_upload_is_undone_after_two_later_ones(store, frame, values):
    schema = "k int, v string, w string"
    store.merge("t", frame(schema, (1, "a", "x"), (2, "b", "x"), (3, "c", "x")), ["k"])
    store.merge("t", frame(schema, (1, "A", "y"), (2, "B", "y"), (4, "d", "y"), (5, "e", "y")), ["k"])  # to be undone
    store.merge("t", frame(schema, (2, "BB", None), (5, "E", None)), ["k"])
    store.merge("t", frame(schema, (6, "f", "z")), ["k"])
    store.undo("t", 2)
    # 1 as before; 2 keeps the later v; 4 was inserted and goes; 5 was inserted but changed since and stays.
    assert values(store.read("t")) == [(1, "a", "x"), (2, "BB", "x"), (3, "c", "x"), (5, "E", "y"), (6, "f", "z")]
    assert store.manifest("t").undoes == 2
    store.undo("t", 5)
    assert values(store.read("t")) == values(store.read("t", 4), "k", "v", "w")
    store.replace("t", store.read("t").where("k > 2"))
    store.undo("t", 7, ["k"])
    assert values(store.read("t")) == values(store.read("t", 6))


def test_counts_come_with_the_write(store, frame, spark):
    ws = Workspace(store=store)
    ws.upsert("t", "k int, v int", lambda: frame("k int, v int", (1, 1), (2, 2)), ["k"])
    assert [tuple(r) for r in ws.summary().collect()] == [("t", 2, 0, 0)]
    ws = Workspace(store=store)
    ws.upsert("t", "k int, v int", lambda: frame("k int, v int", (2, 3), (3, 3)), ["k"])
    ws.upsert("empty", "k int, v int", lambda: frame("k int, v int"), ["k"])
    report = ws.summary()
    assert sorted(tuple(r) for r in report.collect()) == [("empty", 0, 0, 0), ("t", 1, 1, 1)]
    assert "Scan parquet" not in report._jdf.queryExecution().executedPlan().toString()
    assert ws.tables["t"].columns == ["k", "v"] and ws.tables["empty"].count() == 0


def test_a_workspace_given_frames_merges_them(store, frame, values):
    store.replace("t", frame("k int", (9,)))
    ws = Workspace({"t": frame("k int", (1,))}, store)
    ws.upsert("t", "k int", lambda: frame("k int", (2,)), ["k"])
    assert values(ws.tables["t"]) == [(1,), (2,)]


def test_a_table_without_rows(store, frame, spark):
    empty = spark.sql("SELECT 1 AS k, 'x' AS v LIMIT 0")
    store.replace("t", empty)
    assert store.read("t").columns == ["k", "v"] and store.read("t").count() == 0 and store.manifest("t").rows == 0
    store.merge("t", empty, ["k"])
    store.merge("t", frame("k int, v string", (1, "a")), ["k"])
    store.reset("t")
    assert store.read("t").count() == 0
    parts = functools.reduce(lambda n, v: n + len(store.manifest("t", v).parts), store.versions("t"), 0)
    assert parts >= 1
    store.merge("t", frame("k int, v string", (1, "b")), ["k"])
    assert store.read("t").where(F.col("v") == "b").count() == 1


def test_an_import_counts_what_it_skips_while_it_writes(store, frame, spark, monkeypatch):
    """The report of a stored import starts no job and reads no table."""
    store.replace("applications", frame("id string, application_number string", ("a1", "N1")))
    feed = frame("_row int, apprefno string, shname string", (1, "N1", "Ann"), (2, "N9", "Bob"), (3, "N1", None), (4, "N1", "ann"))
    ws, plain = Workspace(store=store), Workspace({"applications": frame("id string, application_number string", ("a1", "N1"))})
    for each in (ws, plain):
        people.import_shareholders(each, feed, as_of="2024-05-01")
    report = ws.report("shareholders")
    assert "Scan parquet" not in report._jdf.queryExecution().executedPlan().toString()
    want = {"processed": 4, "accepted": 2, "skipped_total": 2, "skipped_missing_application": 1, "skipped_missing_name": 1}
    assert report.first().asDict() == plain.report("shareholders").first().asDict() == want


def test_a_repair_is_counted_and_written_in_one_job(store, frame, values):
    store.merge("t", frame("k int, v string", (1, None), (2, "b")), ["k"])
    marked = lambda: store.read("t").drop(ACTION).withColumn("hit", F.col("v").isNull()).withColumn("v", F.coalesce("v", F.lit("new")))
    assert store.change("t", marked(), "hit") == 1 and values(store.read("t")) == [(1, "new"), (2, "b")]
    before, there = files(store, "t"), store.versions("t")
    assert store.change("t", marked(), "hit") == 0
    assert (files(store, "t"), store.versions("t")) == (before, there)
    # A repaired table keeps its buckets, so the next upload rewrites only its own.
    store.merge("t", frame("k int, v string", (2, "c")), ["k"])
    assert sum(p.version == store.versions("t")[-1] for p in store.manifest("t").parts) == 1
