import itertools
import os

import pytest
from pyspark.errors import StreamingQueryException

from ledgerlift.operators import latest
from ledgerlift.plans import people
from ledgerlift.sources.store import TableStore
from ledgerlift.streaming.feed import incremental_import, latest_import


def test_files_are_merged_once_and_replays_converge(spark, tmp_path, frame, values):
    landing = tmp_path / "landing"
    landing.mkdir()
    store = TableStore(spark, str(tmp_path / "store"))
    store.replace("applications", frame("id string, application_number string", ("a1", "N1")))

    def run(checkpoint):
        def plan(ws, batch):
            people.import_shareholders(ws, batch, as_of="2024-05-01")

        incremental_import(spark, str(landing), ["apprefno", "shname"], store, plan, str(tmp_path / checkpoint)).awaitTermination()

    (landing / "one.csv").write_text("apprefno,shname\nN1,Ann\nN1,ann\nN9,Nobody\n")
    run("c1")
    assert values(store.read("shareholders"), "shareholder_name", "_action") == [("Ann", "insert")]
    (landing / "two.csv").write_text("apprefno,shname\nN1,Bob\n")
    run("c1")
    assert values(store.read("shareholders"), "shareholder_name", "_action") == [("Ann", "keep"), ("Bob", "insert")]
    run("c2")  # everything again, as after a lost checkpoint
    assert values(store.read("shareholders"), "shareholder_name", "_action") == [("Ann", "update"), ("Bob", "update")]


def test_late_and_replayed_files_end_in_one_table(spark, tmp_path, values):
    """Every order of three files, one of them in two batches, gives the table of their times."""
    texts = {"a.csv": "k,v,w\n1,old,x\n2,a2,\n2,a2b,\n", "b.csv": "w,k\nlate,1\n,3\n", "c.csv": "k,v\n1,new\n2,\n"}
    tables = set()
    for number, order in enumerate(itertools.permutations(texts)):
        landing, store = tmp_path / f"landing{number}", TableStore(spark, str(tmp_path / f"store{number}"), buckets=4)
        landing.mkdir()
        steps = [order[:1], order[1:]] if number % 2 else [order[:2], order[2:]]
        for step, names in enumerate(steps):
            for name in names:
                (landing / name).write_text(texts[name])
                os.utime(landing / name, (1_700_000_000, 1_700_000_000 + 100 * list(texts).index(name)))
            # A lost checkpoint replays what was there before.
            checkpoint = str(tmp_path / f"c{number}{step if number > 3 else ''}")
            latest_import(spark, str(landing), ["k", "v", "w"], ["k"], store, "t", checkpoint).awaitTermination()
        tables.add(tuple(values(latest.values(store.read("t"), ["k"]))))
    assert tables == {(("1", "new", "late"), ("2", "a2b", None), ("3", None, None))}


def test_columns_are_found_by_the_header_of_each_file(spark, tmp_path, frame, values):
    landing = tmp_path / "landing"
    landing.mkdir()
    (landing / "a.csv").write_text('shname,AppRefNo\n"Ann\nMarie",N1\n')
    (landing / "b.csv").write_text("apprefno,other,shname\nN2,x,Bob\n")
    (landing / "c.csv").write_text("apprefno\nN3\n")
    (landing / "e.csv").write_text(f'note,apprefno,shname\n"{"x," * 600}",N4,2" pipe\n')
    seen = []

    def plan(ws, batch):
        seen.extend(values(batch, "apprefno", "shname"))

    store = TableStore(spark, str(tmp_path / "store"))
    incremental_import(spark, str(landing), ["apprefno", "shname"], store, plan, str(tmp_path / "c")).awaitTermination()
    assert sorted(seen, key=str) == [("N1", "Ann\nMarie"), ("N2", "Bob"), ("N3", None), ("N4", '2" pipe')]
    (landing / "d.csv").write_text("foo,bar\n1,2\n")
    with pytest.raises(StreamingQueryException):
        incremental_import(spark, str(landing), ["apprefno", "shname"], store, plan, str(tmp_path / "c")).awaitTermination()
