"""Records cut in parallel equal those of Python's csv module, however small the blocks."""

import csv
import io
import random

import pytest
from pyspark.sql import functions as F

from ledgerlift.sources import grid, records


def expected(text, sep=","):
    return tidy(csv.reader(io.StringIO(text, newline=""), delimiter=sep))


def tidy(rows):
    """Without rows of one blank cell: a blank line is no record, a quoted blank is one."""
    return [[c or None for c in r] for r in rows if len(r) > 1 or (r and (r[0] or "").strip())]


def got(spark, folder, sep=","):
    rows = records.records(records.read_lines(spark, str(folder)), sep)
    found = rows.orderBy(records.ROW).select(records.cells(F.col("value"), sep).alias("cells")).collect()
    return tidy(r["cells"] for r in found)


def random_text(seed, sep=","):
    """Records of plain, quoted and odd cells, with line breaks of both kinds; quotes may stay open till the end."""
    picker = random.Random(seed)
    inner = ["a", "bc", " ", '""', sep, "\n", "\r\n", "é", "1", "\n\n"]

    def cell():
        kind = picker.randrange(7)
        if kind == 0:
            return ""
        if kind == 1:
            return picker.choice(['2" pipe', 'x"', ' "y"', 'z""'])
        if kind == 2:
            return '"' + "".join(picker.choice(inner) for _ in range(picker.randrange(12))) + '"' + picker.choice(["", "", "tail", 't"'])
        return "".join(picker.choice("abc 12") for _ in range(picker.randrange(1, 9)))

    lines = [sep.join(cell() for _ in range(picker.randrange(1, 6))) + picker.choice(["\n", "\r\n"]) for _ in range(picker.randrange(30, 120))]
    return "".join(lines) + ("x" if seed % 3 else '"open ' + "y" * 30)


@pytest.fixture
def tiny_blocks(spark):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "160")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    yield
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


@pytest.mark.parametrize("seed,sep", [(0, ","), (1, ","), (2, ";"), (3, "\t"), (4, "|")])
def test_records_equal_the_csv_module(spark, tmp_path, tiny_blocks, seed, sep):
    texts = [random_text(10 * seed + i, sep) for i in range(3)]
    for i, text in enumerate(texts):
        (tmp_path / f"{i}.csv").write_text(text, newline="")
    assert records.read_lines(spark, str(tmp_path)).rdd.getNumPartitions() > 10
    assert got(spark, tmp_path, sep) == [r for t in texts for r in expected(t, sep)]


@pytest.mark.parametrize("few", [0, 10**6])
def test_a_cell_over_many_blocks(spark, tmp_path, tiny_blocks, monkeypatch, few):
    monkeypatch.setattr(records, "FEW", few)
    text = 'k,v\n1,"' + "line\n" * 200 + '"\n2,"a ""q"" b"\n3,"' + '""\n' * 100 + '",z\n4,2" x\n'
    (tmp_path / "a.csv").write_text(text)
    (tmp_path / "b.csv").write_text('k,v\n5,"open\nto the end')
    (tmp_path / "c.csv").write_text("k,v\n6,closed\n")
    rows = got(spark, tmp_path)
    assert rows == [r for f in "abc" for r in expected((tmp_path / f"{f}.csv").read_text())]
    assert grid.read_csv(spark, str(tmp_path)).count() == 6


def test_lines_without_open_cells_are_taken_as_they_are(spark, tmp_path):
    (tmp_path / "a.csv").write_text('k,v\n1,"x, y"\n2,2" pipe\n3,"say ""so"""\n')
    lines = records.read_lines(spark, str(tmp_path))
    assert records.survey(lines) == (False, 2)
    plan = records.records(lines, opens=False)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Join" not in plan
    assert got(spark, tmp_path) == [["k", "v"], ["1", "x, y"], ["2", '2" pipe'], ["3", 'say "so"']]


def test_long_cells_and_wide_records(spark, tmp_path):
    """Patterns take no stack: tens of thousands of doubled quotes, separators and cells."""
    many = 20_000
    text = '"' + '""' * many + "," * many + '",' + ",".join("x" * 1 for _ in range(many)) + "\n" + '"' + '""' * many + "\n" + '",y\n'
    (tmp_path / "a.csv").write_text(text)
    rows = got(spark, tmp_path)
    assert rows == expected(text) and len(rows[0]) == many + 1


def test_empty_files(spark, tmp_path):
    (tmp_path / "a.csv").write_text("")
    assert got(spark, tmp_path) == [] and records.survey(records.read_lines(spark, str(tmp_path))) == (False, 0)
    assert grid.read_csv(spark, str(tmp_path)).collect() == []
    assert grid.read_grid(spark, str(tmp_path)).columns == ["_row", "c0"]
    (tmp_path / "b.csv").write_text("﻿a,b\r\n\r\n , \r\n1,2\r\n", encoding="utf-8")
    assert grid.read_csv(spark, str(tmp_path / "b.csv")).collect()[-1] == ("1", "2")


def test_lines_stay_where_they_are_read(spark, tmp_path, tiny_blocks):
    """Only a map a block and the parts of records in several blocks are shuffled, whatever the number of open lines."""
    (tmp_path / "a.csv").write_text("k,v\n" + "".join(f'{i},"one\n\ntwo ""{i}"", x"\n' for i in range(100)))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows = records.records(records.read_lines(spark, str(tmp_path)))
        plan = rows._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" not in plan and "ShuffledHashJoin" not in plan
        assert got(spark, tmp_path) == [["k", "v"], *[[str(i), f'one\n\ntwo "{i}", x'] for i in range(100)]]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
