import pytest
from pyspark.sql import functions as F

from ledgerlift.session import cut_lineage
from ledgerlift.sources import dimensions, grid, legacy
from ledgerlift.sources.store import TableStore, Workspace


def test_header_found_by_anchor(frame, values):
    raw = frame(
        "_row int, c0 string, c1 string, c2 string",
        (0, "Report", None, None),
        (1, None, " ", None),
        (2, "Sno", "AppRefNo", "Full Name/Title"),
        (3, "1", "A-1", "x"),
        (4, "2", "apprefno", "y"),
    )
    table = grid.promote_header(raw)
    assert table.columns == ["_row", "sno", "apprefno", "full_name_title"]
    assert values(table) == [(3, "1", "A-1", "x"), (4, "2", "apprefno", "y")]


def test_header_falls_back_to_first_filled_row(frame, values):
    raw = frame("_row int, c0 string, c1 string", (0, None, " "), (1, "a", None), (2, "1", "2"))
    table = grid.promote_header(raw)
    assert table.columns == ["_row", "a", "unnamed:_1"]
    assert values(table) == [(2, "1", "2")]
    assert grid.find_header(frame("_row int, c0 string", (0, None))) is None


def test_header_names():
    assert grid.header_name(" App Ref/No ") == "app_ref_no"


def test_required_and_optional(frame):
    with pytest.raises(grid.MissingColumns, match=r"\['b', 'c'\]"):
        grid.require(frame("a int", (1,)), ["c", "a", "b"])
    assert grid.require(frame("a int", (1,)), ["a"], ["z"]).first()["z"] is None


def test_first_alias_wins(frame):
    df = frame("_row int, b string, a string", (1, "from b", "from a"))
    mapped = grid.apply_aliases(df, {"a": "x", "b": "x", "c": "y"})
    assert mapped.first().asDict() == {"_row": 1, "x": "from a", "y": None}
    assert grid.rename_aliases(df, {"a": "x"}).columns == ["_row", "b", "x"]
    assert grid.rename_aliases(df, {"b": "a"}).columns == ["_row", "a"]


def test_csv_rows_numbered_across_files_and_blocks(spark, tmp_path):
    """Many small blocks per file, several files: places and numbers follow path and position."""
    expected = []
    for part in range(3):
        lines = [f"{part}-{i},{'x' * (i % 50)}" for i in range(400)]
        (tmp_path / f"part{part}.csv").write_text("\n".join(lines) + "\n")
        expected += [line.split(",")[0] for line in lines]
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        rows = grid.read_grid(spark, str(tmp_path), 2)
        assert rows.rdd.getNumPartitions() > 5
        got = [r["c0"] for r in rows.orderBy("_row").collect()]
        raw = spark.read.schema("c0 string, c1 string").csv(str(tmp_path))
        numbered = grid.number_rows(raw).orderBy("_row").collect()
        numbers = [r["_row"] for r in numbered]
        assert [r["c0"] for r in numbered] == expected
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert got == expected
    assert numbers == list(range(1, 1201))


def test_parquet_rows_numbered(spark, tmp_path):
    path = str(tmp_path / "p")
    spark.range(1000).coalesce(1).write.parquet(path)
    rows = grid.number_rows(spark.read.parquet(path))
    assert rows.filter(F.col("_row") != F.col("id") + 1).count() == 0


def test_csv_with_header_and_quotes(spark, tmp_path, values):
    (tmp_path / "f.csv").write_text('App Ref No,Name\nA-1,"Doe, ""Jo"""\n')
    df = grid.read_csv(spark, str(tmp_path / "f.csv"))
    assert df.columns == ["app_ref_no", "name"]
    assert values(df) == [("A-1", 'Doe, "Jo"')]


def test_dimension_file(spark, tmp_path, frame, values):
    (tmp_path / "d.csv").write_text('"id","name"\n"1553779224291","MARA"\n"1553779224293.0","X"\n,\n"1553779224291","MARA"\n')
    dim = dimensions.read_dimension(spark, str(tmp_path / "d.csv"))
    assert values(dim) == [("1553779224291", "MARA"), ("1553779224293", "X")]
    from ledgerlift.operators.joins import replace_ids

    rows = frame("region string", ("1553779224291.0",), ("1.553779224293e12",), ("unknown",))
    assert values(replace_ids(rows, ["region"], {"region": dim}, dimensions.id_key)) == [("MARA",), ("X",), ("unknown",)]


def test_legacy_table(frame, values):
    wide = frame("id int, number string, tin string, tinfilename string, other int", (1, "n1", "5", "nan", 1), (2, "n2", "", None, 1))
    hub, documents = legacy.migrate_wide(wide, ["id", "number", "status"], "number")
    assert hub.columns == ["id", "number"]
    assert values(documents, "document_name", "file_name", "documents_order", "logic_doc_id") == [("", "tin", 1, 5)]
    assert values(legacy.preview_wide(wide, ["number"], "number")) == [(2, 1)]


def test_store_replaces_a_table_by_a_plan_that_reads_it(spark, tmp_path, frame, values):
    store = TableStore(spark, str(tmp_path / "store"))
    assert not store.exists("t")
    with pytest.raises(KeyError):
        store.read("t")
    store.replace("t", frame("k int", (1,)))
    before = store.read("t")
    store.replace("t", store.read("t").unionByName(frame("k int", (2,))))
    assert values(store.read("t")) == [(1,), (2,)]
    assert values(before) == [(1,)]
    store.reset("t")
    assert store.read("t").count() == 0


def test_workspace_defers_until_asked(frame):
    built = []
    ws = Workspace()
    ws.hold("a", lambda: built.append("a") or frame("k int", (1,)))
    ws.hold("b", lambda: built.append("b") or frame("k int", (1,)))
    assert ws.staged["b"].count() == 1
    assert built == ["b"]


def test_cut_lineage_uses_the_checkpoint_folder(spark, tmp_path):
    spark.sparkContext.setCheckpointDir(str(tmp_path))
    cut = cut_lineage(spark.range(10).withColumn("x", F.col("id") * 2))
    assert cut.count() == 10
    assert "ExistingRDD" in cut._jdf.queryExecution().logical().toString() or any(tmp_path.iterdir())


def test_grid_takes_its_width_from_the_data(spark, tmp_path, values):
    (tmp_path / "g.csv").write_text('Report\nSno,AppRefNo,Name,\n1,A-1,"x, y",\n2,A-2,z,,,last\n')
    rows = grid.read_grid(spark, str(tmp_path / "g.csv"))
    assert rows.columns == ["_row", *[f"c{i}" for i in range(6)]]
    table = grid.promote_header(rows)
    assert values(table, "apprefno", "name", "`unnamed:_5`") == [("A-1", "x, y", None), ("A-2", "z", "last")]
    with pytest.raises(grid.GridTooNarrow):
        grid.read_grid(spark, str(tmp_path / "g.csv"), width=4)
    assert grid.read_grid(spark, str(tmp_path / "g.csv"), width=8).columns[-1] == "c7"


def test_quoted_line_breaks(spark, tmp_path, values):
    path = str(tmp_path / "m.csv")
    (tmp_path / "m.csv").write_text('apprefno,name\nA-1,"two\nlines, one cell"\nA-2,x\n')
    want = [("A-1", "two\nlines, one cell"), ("A-2", "x")]
    assert values(grid.read_csv(spark, path)) == want
    assert values(grid.promote_header(grid.read_grid(spark, path)), "apprefno", "name") == want


def test_files_of_one_header(spark, tmp_path, values):
    for i in range(3):
        (tmp_path / f"{i}.csv").write_text(f"\n a,b \n{i},x\n")
    assert values(grid.read_csv(spark, str(tmp_path))) == [("0", "x"), ("1", "x"), ("2", "x")]
    (tmp_path / "9.csv").write_text("a,c\n1,2\n")
    with pytest.raises(grid.HeadersDiffer):
        grid.read_csv(spark, str(tmp_path))


@pytest.mark.parametrize("count", [1, 5, 70, 200])
def test_numbers_over_many_files_take_no_single_task(spark, tmp_path, count):
    for i in range(count):
        (tmp_path / f"f{i:04d}.csv").write_text("".join(f"{i},{j}\n" for j in range(i % 4 + 1)))
    raw = spark.read.schema("i int, j int").csv(str(tmp_path))
    numbered = grid.number_rows(raw)
    assert "SinglePartition" not in numbered._jdf.queryExecution().executedPlan().toString()
    rows = sorted((r["_row"], r["i"], r["j"]) for r in numbered.collect())
    assert [r[0] for r in rows] == list(range(1, len(rows) + 1))
    assert [r[1:] for r in rows] == [(i, j) for i in range(count) for j in range(i % 4 + 1)]


def test_rows_of_one_file_are_numbered_where_they_are_read(spark, tmp_path):
    path = str(tmp_path / "p")
    spark.range(1000).coalesce(1).write.parquet(path)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows = grid.number_rows(spark.read.parquet(path))
        plan = rows._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin [__file" in plan
        assert sorted((r["_row"], r["id"]) for r in rows.collect()) == [(i + 1, i) for i in range(1000)]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_pages_become_a_grid_in_parallel(spark, tmp_path, monkeypatch, frame, values):
    from workload import stores
    from workload.registry import Tables

    rows = [(i, f"http://h/{i}", f'<a href="x, {i}">\n</a>') for i in range(40)]
    frame("page_id bigint, url string, html string", *rows).repartition(4).write.parquet(str(tmp_path / "pages.parquet"))
    monkeypatch.setattr(stores, "scratch_folder", lambda spark, name: str(tmp_path / name))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2048")
    try:
        found = values(stores.csv_grid(Tables(spark, str(tmp_path))))
        assert len(list((tmp_path / "grid").rglob("part-*.csv"))) > 2
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert found == sorted(((i, u, len(h)) for i, u, h in rows), key=lambda r: str(r[0]))
