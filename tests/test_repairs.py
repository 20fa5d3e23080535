import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlift.operators import backfill as b
from ledgerlift.operators import merge
from ledgerlift.operators import ownership as own
from ledgerlift.operators import provision as p
from ledgerlift.operators import schema
from ledgerlift.plans import maintenance as m
from ledgerlift.plans import tables as t
from ledgerlift.sources.colocated import Colocated


def changed_rows(before, after):
    return after.exceptAll(before).count()


def test_preview_counts_what_apply_changes(frame, values):
    child = frame("id int, fk int, v string", (1, 1, None), (2, 1, "x"), (3, 9, None), (4, None, None), (5, 2, None))
    parent = frame("id int, v string", (1, "p"), (2, None))
    job = b.backfill(child, parent, "fk", "id", {"v": "v"})
    assert job.preview().first()[0] == changed_rows(child, job.apply()) == job.changed().count() == 1
    assert values(job.apply()) == values(frame("id int, fk int, v string", (1, 1, "p"), (2, 1, "x"), (3, 9, None), (4, None, None), (5, 2, None)))
    again = b.backfill(job.apply(), parent, "fk", "id", {"v": "v"})
    assert again.preview().first()[0] == 0


def test_overwriting_backfill_settles_ambiguous_parents(frame, values):
    child = frame("fk int, v string", (1, "old"), (2, "old"))
    parent = frame("id int, v string, at int", (1, "late", 2), (1, "early", 1))
    job = b.backfill(child, parent, "fk", "id", {"v": "v"}, only_null=False, order=[F.col("at").asc()])
    assert values(job.apply()) == [(1, "early"), (2, "old")]
    assert job.preview().first()[0] == 1


def test_chain_of_siblings(frame, values):
    child = frame("k int, app int", (1, None), (2, None), (3, 30))
    first, second = frame("k int, app int", (1, 11), (2, None)), frame("k int, app int", (1, 99), (2, 22))
    assert values(b.recover_from_siblings(child, [first, second], "k", "app")) == [(1, 11), (2, 22), (3, 30)]


def test_orphans_point_to_the_current_detail(frame, values):
    child = frame("id int, app int, fk string", (1, 1, "gone"), (2, 1, "d2"), (3, 2, None), (4, 9, "gone"))
    details = frame("fk string, app int, at int", ("d1", 1, 5), ("d2", 1, 1), ("d3", 2, 1))
    job = b.repoint_orphans(child, details, "app", "fk", "fk", [F.col("at").desc()])
    assert values(job.apply()) == [(1, 1, "d1"), (2, 1, "d2"), (3, 2, "d3"), (4, 9, "gone")]
    assert job.preview().first()[0] == 2


def test_contact_cleaning(frame, values):
    people = frame("name string, mobile_no string, email string", ("JO | BOSS | 0712 345 678 | j@x.org", " ", None), ("plain", None, "e"))
    job = b.clean_contact_names(people)
    assert values(job.apply()) == [("JO", "0712345678", "j@x.org"), ("plain", None, "e")]
    assert job.preview().first()[0] == 1


def test_duplicate_approvals_keep_rows_without_number(frame, values):
    rows = frame("id int, approval_no string, expire_date int, created_at int", (1, "a", 1, 1), (2, "a", 2, 1), (3, None, 1, 1), (4, None, 1, 1))
    assert values(b.drop_duplicate_approvals(rows), "id") == [(2,), (3,), (4,)]


def test_installation_ids_recovered_from_stage(frame, values):
    lost = frame("id string, application_id string", ("i1", None), ("i2", "A2"))
    staged = frame("id string, application_number string", ("i1", " N1"), ("i2", "N1"))
    apps = frame("id string, application_number string", ("A1", "N1"))
    assert values(m.installation_ids_from_stage(lost, staged, apps).apply()) == [("i1", "A1"), ("i2", "A2")]


def test_provisioning_twice_adds_nothing(frame, values):
    dim = frame("id string, name string, kind string", ("1", "Alpha ", "k"))
    names = frame("name string", ("alpha",), ("Beta",), (" beta",), ("",), (None,))
    once = p.ensure_members(dim, names, {"kind": F.lit("new")}, "c")
    assert [r[1:] for r in values(once, "id", "name", "kind", "_action")] == [("Alpha ", "k", "keep"), ("Beta", "new", "insert")]
    twice = p.ensure_members(once.drop("_action"), names, {"kind": F.lit("new")}, "c")
    assert values(twice.select("_action").distinct()) == [("keep",)]


def test_roles(frame, values):
    roles = frame("id string, name string", ("r0", "ADMIN"), ("r1", " Default Role"))
    held = frame("user_id string, role_id string", ("u1", "r0"), ("u2", "r1"))
    users = frame("id string", ("u1",), ("u2",), ("u3",))
    role = p.role_named(roles, "DEFAULT ROLE")
    assert [r for r in values(p.assign_role(held, users, role)) if r[2] == "insert"] == [("u1", "r1", "insert"), ("u3", "r1", "insert")]
    assert values(p.assign_role(held, users, p.role_named(roles, "none")), "_action") == [("keep",), ("keep",)]


@pytest.fixture
def owned(frame):
    hub = frame("id string, application_number string, created_by string, username string", ("a1", "n1", "u1", "one"), ("a2", "n2", "u1", "one"))
    certificates = frame("id string, application_id string, created_by string, owner_id string", ("c1", "a1", None, "u1"), ("c2", "a2", "u1", None))
    children = frame("id string, application_id string, created_by string", ("x1", "a1", "u1"), ("x2", "a1", None), ("x3", "a2", "u1"))
    return {"applications": (hub, own.HUB), "certificates": (certificates, own.CERTIFICATE), "documents": (children, own.CHILD)}


def test_transfer_then_restore_is_identity(frame, values, owned):
    users = frame("id string, username string, deleted boolean", ("u2", "Two", False), ("u3", "three", True))
    requests = frame("application_number string, new_username string", ("n1", " two"), ("n2", "three"), ("zz", "two"))
    mapping = own.resolve_mapping(requests, owned["applications"][0], users)
    moved, snapshot = own.transfer(owned, mapping)
    assert values(moved["applications"]) == [("a1", "n1", "u2", "Two"), ("a2", "n2", "u1", "one")]
    assert values(moved["certificates"]) == [("c1", "a1", "u2", "u2"), ("c2", "a2", "u1", None)]
    assert values(moved["documents"]) == [("x1", "a1", "u2"), ("x2", "a1", None), ("x3", "a2", "u1")]
    assert values(own.preview_transfer(owned, mapping)) == [("applications", 1), ("certificates", 1), ("documents", 1)]
    assert snapshot.count() == 3
    back = own.restore({n: (moved[n], kind) for n, (_, kind) in owned.items()}, snapshot)
    for name, (before, _) in owned.items():
        assert values(back[name]) == values(before)
    assert own.discard_snapshot(snapshot, frame("application_id string", ("a1",))).count() == 0


def test_schema_alignment_reports_and_applies(frame, values):
    df = frame("a string, b int, gone int", ("1", 2, 3), ("x", 4, 5))
    want = T.StructType([T.StructField("b", T.LongType()), T.StructField("a", T.IntegerType()), T.StructField("c", T.BooleanType())])
    plan = [(c.column, c.action) for c in schema.schema_changes(df.schema, want, ["gone"])]
    aligned, changes = schema.align_schema(df, want, {"c": F.lit(True)}, ["gone"])
    assert plan == [(c.column, c.action) for c in changes] == [("b", "cast"), ("a", "cast"), ("c", "add"), ("gone", "drop")]
    assert aligned.columns == ["b", "a", "c"]
    assert values(aligned) == [(2, 1, True), (4, None, True)]


def test_chain_goes_on_after_a_failure():
    def fail():
        raise RuntimeError("no table")

    done = []
    results = m.run_chain({"one": fail, "two": lambda: done.append(2)})
    assert [(r.name, r.ok) for r in results] == [("one", False), ("two", True)]
    assert done == [2]


def test_a_chain_of_backfills_reads_its_table_once(spark, tmp_path, frame):
    from ledgerlift.operators.backfill import recover_from_siblings

    frame("k int, v string", (1, None), (None, None)).write.parquet(str(tmp_path / "child"))
    frame("k int, v string", (1, "x")).write.parquet(str(tmp_path / "sibling"))
    child, sibling = spark.read.parquet(str(tmp_path / "child")), spark.read.parquet(str(tmp_path / "sibling"))
    for n in (1, 3, 5):
        plan = recover_from_siblings(child, [sibling] * n, "k", "v")._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("Relation") == n + 1


def test_location_takes_each_column_from_a_detail_that_knows_it(frame, values):
    applications = frame("id string, region string, district string, street string, ward string", ("a1", None, "D", None, None), ("a2", None, None, None, None))
    details = frame(
        "application_id string, region string, district string, street string, ward string",
        ("a1", None, None, None, None), ("a1", "R", "X", None, None), ("a1", None, None, "S", None),
    )
    assert values(m.location_jobs(applications, details).apply()) == [("a1", "R", "D", "S", None), ("a2", None, None, None, None)]
    assert m.location_preview(applications, details).first().asDict() == {"region_to_fill": 1, "district_to_fill": 0, "street_to_fill": 1, "ward_to_fill": 0, "total_affected": 1}


@pytest.fixture
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_colocated_repairs_shuffle_nothing(spark, tmp_path, frame, values, no_broadcast):
    """25 children of one hub get their creators without an exchange; the rows are those of the plain jobs."""
    hub = frame("id string, username string, created_by string", *[(f"a{i}", f" User{i % 5} " if i % 4 else None, "x" if i % 7 == 0 else None) for i in range(40)])
    users = frame("id string, username string", *[(f"u{i}", f"user{i}") for i in range(4)])
    child = frame("id int, application_id string, created_by string", *[(i, f"a{i % 50}" if i % 3 else None, "c" if i % 5 == 0 else None) for i in range(120)])
    names = t.OWNED_BY_USER
    stored = Colocated(spark, str(tmp_path / "tables"), "repairs", buckets=4)
    stored.put("applications", hub, "id")
    for name in names:
        stored.put(name, child, "application_id")
    try:
        jobs = m.colocated_created_by_jobs(stored, users)
        plain = m.created_by_jobs({"applications": hub, "users": users, names[0]: child})
        assert set(jobs) == {*names, "applications"} and len(names) >= 24
        for name, job in jobs.items():
            plan = job.apply()._jdf.queryExecution().executedPlan().toString()
            assert "Exchange" not in plan and ("Join" in plan)
        for name in ("applications", names[0]):
            assert values(jobs[name].apply()) == values(plain[name].apply())
            assert jobs[name].preview().first() == plain[name].preview().first()
        assert values(stored.read(names[0])) == values(child)
    finally:
        stored.drop()
    assert not spark.catalog.tableExists("repairs_applications")


def test_merged_rows_are_those_of_the_merge(frame, values):
    target = frame("k string, a string, b string, only string", ("x", "a0", None, "o"), ("y", None, "b0", "p"), ("z", "z", "z", "z"))
    source = frame("k string, a string, b string, extra int", ("x", None, "b1", 1), ("y", "a1", "b1", 2), ("new", "a2", None, 3))
    policy = {"b": merge.KEEP}
    want = merge.merge_into(target, source, ["k"], policy).where("k <> 'z'").select("k", "a", "b", "only", "extra")
    assert values(merge.merged_rows(source, target, "k", ["k", "a", "b", "only"], policy)) == values(want)
