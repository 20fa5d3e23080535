"""Every import plan on a small feed, twice through a store: the second run inserts nothing."""

import functools

import pytest
from pyspark.sql import functions as F

from ledgerlift.operators.profile import skip_report
from ledgerlift.operators import backfill as b
from ledgerlift.operators.backfill import CHANGED
from ledgerlift.plans import applications, common, directory, electrical, experience, fees, maintenance, people, water
from ledgerlift.sources.store import TableStore, Workspace

NOW = "2024-05-01 00:00:00"


@pytest.fixture
def store(spark, tmp_path):
    return TableStore(spark, str(tmp_path / "store"), buckets=4)


def feed(frame, header, *rows):
    names = ["_row", *header.split()]
    schema = "_row int, " + ", ".join(f"`{n}` string" for n in names[1:])
    return frame(schema, *[(i, *r) for i, r in enumerate(rows, start=1)])


def run_twice(store, plan):
    """Summary of the first run, then assert that the second one only updates or keeps."""
    first = Workspace(store=store)
    plan(first)
    counts = {r["table_name"]: (r["inserted"], r["updated"], r["kept"]) for r in first.summary().collect()}
    before = fingerprints(first)
    second = Workspace(store=store)
    plan(second)
    again = {r["table_name"]: r["inserted"] for r in second.summary().collect()}
    assert set(again.values()) == {0}
    assert fingerprints(second) == before
    return counts, second


def fingerprints(ws):
    """Row count and content hash of every merged table."""
    parts = []
    for name in ws.merged:
        columns = sorted(c for c in ws.tables[name].columns if c != "updated_at")
        content = F.sum(F.xxhash64(*columns).cast("decimal(38,0)"))
        parts.append(ws.tables[name].agg(F.count(F.lit(1)).alias("n"), content.alias("h")).withColumn("t", F.lit(name)))
    return sorted(tuple(r) for r in functools.reduce(lambda a, b: a.unionByName(b), parts).collect())


def hub(frame, *numbers):
    return frame("id string, application_number string, is_migrated boolean", *[(f"id-{n}", n, True) for n in numbers])


def test_applications(frame, store, values):
    store.replace("sectors", frame("id string, name string", ("s1", "PETROLEUM"), ("s2", "ELECTRICITY")))
    store.replace("roles", frame("id string, name string", ("r1", "DEFAULT ROLE")))
    store.replace("application_legal_status", frame("id string, name string", ("l1", "Partnership")))
    regions = frame("id string, name string", ("1553779224291", "MARA"))
    zones = frame("region string, zone_id string", ("mara", "z1"))
    rows = feed(
        frame,
        "AppRefNo approval_no application_type effective_date license_type region userid application_legal_status_id"
        " tinc tincfilename coc cocfilename cemail fcontrolno tiracovernotenumber",
        ("N1", "L1", "renewal", "43979.0", "LPG Depot", "1553779224291.0", "Ann", "partnership", "5", "a.pdf", "", "b.pdf", "x@y.zz", None, "C1"),
        ("N1", "L1", "new", "2020-01-01", None, "X", "Bob", None, "6", "z.pdf", "7", "z.pdf", None, "F9", None),
        ("N2", "nan", "new", None, None, None, "Carl", None, None, None, None, None, None, None, None),
        ("N3", "L3", "odd", "junk", "Petroleum Retail", "elsewhere", "ANN ", None, "x", "q.pdf", "8.0", " c.pdf", None, "F1", None),
        (None, "L4", "new", None, None, None, None, None, None, None, None, None, None, None, None),
    )
    plan = lambda ws: applications.import_applications(
        ws, rows, "PETROLEUM", {"region": regions}, zones, as_of=NOW
    )
    counts, ws = run_twice(store, plan)
    assert counts["applications"] == (2, 0, 0)
    assert counts["users"] == (2, 0, 0) and counts["user_roles"] == (2, 0, 0)
    assert counts["categories"][0] == 23  # the fixed list and one new licence type
    assert counts["documents"] == (2, 0, 0)
    assert (counts["contact_persons"][0], counts["fire"][0], counts["insurance_cover_details"][0]) == (1, 1, 1)
    picked = values(ws.tables["applications"], "application_number", "application_type", "effective_date", "license_type", "zone_id")
    assert [(r[0], r[1], str(r[2]), r[3], r[4]) for r in picked] == [
        ("N1", "RENEW", "2020-05-28", "LICENSE_PETROLEUM", "z1"),
        ("N3", "ODD", "None", "LICENSE_PETROLEUM", None),
    ]
    assert values(ws.tables["application_sector_details"], "region", "applicant_legal_status_id") == [("MARA", "l1"), ("elsewhere", None)]
    assert values(ws.tables["documents"], "document_name", "documents_order", "logic_doc_id") == [("COC", 1, 8), ("TINC", 1, 5)]
    report = applications.application_report(ws, ws.tables["applications"]).first().asDict()
    assert report == {"staged": 4, "existing_application_number": 3, "existing_approval_no": 3, "dup_application_number": 1, "dup_approval_no": 1}
    assert applications.staged_fill_rate(ws).first()["nulls"] == 4


def test_reupload_completes_a_known_application(frame, values):
    """An application already in the hub keeps its id and still gets details and documents."""
    ws = Workspace({"applications": hub(frame, "N1"), "sectors": frame("id string, name string", ("s1", "PETROLEUM"))})
    rows = feed(frame, "apprefno approval_no tinc tincfilename", ("N1", "L1", "5", "a.pdf"))
    applications.import_applications(ws, rows, default_role=None, as_of=NOW)
    assert values(ws.merged["applications"], "id", "approval_no", "_action") == [("id-N1", "L1", "update")]
    assert values(ws.merged["application_sector_details"], "id", "application_id") == [("id-N1", "id-N1")]
    assert values(ws.merged["documents"], "application_id", "file_name") == [("id-N1", "a.pdf")]


def test_shareholders_and_directors(frame, store, values):
    store.replace("applications", hub(frame, "N1"))
    store.replace("application_sector_details", frame("id string, application_id string", ("d2", "id-N1"), ("d1", "id-N1")))
    countries = frame("id string, name string", ("1540000000000", "Tanzanian"))
    shares = feed(
        frame,
        "apprefno shname amountofshare objectid nationality",
        ("N1", "Ann Mary Jo Doe", "12.5", "121858", "1.54E+12"),
        ("N1", "ANN MARY JO DOE", "99", "7", None),
        ("N1", "nan", "1", "1", None),
        ("N9", "Al", "1", "bad", None),
    )
    counts, ws = run_twice(store, lambda w: people.import_shareholders(w, shares, countries, as_of=NOW))
    assert counts["shareholders"] == (1, 0, 0)
    row = ws.tables["shareholders"].first()
    assert (row.first_name, row.middle_name, row.last_name) == ("Ann", "Mary Jo", "Doe")
    assert (row.nationality, row.logic_doc_id, float(row.amount_of_share_percent)) == ("TANZANIAN", 121858, 12.5)
    assert row.application_sector_detail_id == "d1"
    report = skip_report(ws.staged["shareholders"], people.REASONS).first().asDict()
    assert report == {"processed": 4, "accepted": 2, "skipped_total": 2, "skipped_missing_application": 1, "skipped_missing_name": 1}
    assert ws.staged["shareholders"].filter("invalid_objectid").count() == 1

    directors = feed(frame, "apprefno name phoneno workpermit", ("N1", "Al", "2.55E+11", "x"), ("N1", "Al Fox", "1.0", "77.0"))
    counts, ws = run_twice(store, lambda w: people.import_directors(w, directors, as_of=NOW))
    assert counts["managing_directors"] == (2, 0, 0)
    assert values(ws.tables["managing_directors"], "name", "last_name", "mobile_no", "work_permit") == [
        ("Al", None, "255000000000", None),
        ("Al Fox", "Fox", "1", 77),
    ]


def test_installations(frame, store, values):
    store.replace("applications", frame("id string, application_number string, application_type string, status string, license_type string", ("old", "E1", None, "DRAFT", "OTHER")))
    store.replace("roles", frame("id string, name string", ("r1", "DEFAULT ROLE")))
    rows = feed(
        frame,
        "application_number application_type licensecategoryclass approvedclass company_name employmentstatus completed_at userid mobile_no",
        ("E1", "renewal", "class a", "S1", "Co", "self employed", "01/02/2020", "u1", "2557.0"),
        ("E2", "nan", "Z", None, "Co2", None, "bad", "u1", None),
        ("E2", "later", "B", None, "Co3", None, None, "u2", None),
    )
    counts, ws = run_twice(store, lambda w: electrical.import_installations(w, rows, as_of=NOW))
    assert counts["applications"] == (1, 1, 0)
    assert counts["categories"][0] == 8
    assert [counts[n][0] for n in ("certificates", "application_electrical_installation", "contact_details", "self_employed")] == [2, 2, 2, 1]
    apps = values(ws.tables["applications"], "application_number", "id", "application_type", "status", "license_type")
    assert apps[0] == ("E1", "old", "RENEW", "APPROVED", "OTHER")
    assert apps[1][2:] == ("NEW", "APPROVED", "LICENSE_ELECTRICITY_INSTALLATION")
    linked = ws.tables["applications"].join(ws.tables["certificates"].select(F.col("id").alias("c")), F.col("certificate_id") == F.col("c"))
    assert linked.count() == 2
    assert values(ws.tables["application_electrical_installation"], "approved_class_id")[1] == (None,)


@pytest.fixture
def located(frame, store):
    store.replace("applications", hub(frame, "E1", "E2"))
    store.replace(
        "application_electrical_installation",
        frame("id string, application_id string, experience_type string", ("i1", "id-E1", "SELF_EMPLOYED")),
    )
    return store


def test_supervisors(frame, located, values):
    rows = feed(
        frame,
        "app_ref_no supervisor_details role voltage work_done position from_date to_date",
        ("E1", "Jo | BOSS | 0712345678", "r", "HV", "w", "p", "1/2/2020", "2020-03-04"),
        ("E1", "Jo | BOSS | 0712345678", "r", "HV", "w", "p", "2020-02-01 00:00:00", "4/3/2020"),
        ("E2", "Al,x@y.org", None, "LV", "w", None, "?", None),
        ("E9", "No one", None, None, None, None, None, None),
    )
    counts, ws = run_twice(located, lambda w: experience.import_supervisors(w, rows, as_of=NOW))
    assert counts == {"work_experience": (2, 0, 0), "supervisor_details": (2, 0, 0)}
    assert values(ws.tables["supervisor_details"], "name", "mobile_no", "email") == [("Al", None, "x@y.org"), ("Jo", "0712345678", None)]
    counts, _ = run_twice(located, lambda w: experience.import_supervisor_details(w, rows, as_of=NOW))
    assert counts == {"supervisor_details": (0, 2, 0), "self_employed": (1, 0, 0)}


def test_self_employed_and_verifications(frame, located, values):
    rows = feed(
        frame,
        "application_no sn voltage custom_details project_performed from_date to_date",
        ("E1", "1", "HV", "d1", "p", "2020/1/2", None),
        ("E1", "1", "HV", "d2", "p", "02-01-2020", None),
        ("E2", "1", "HV", "d3", "p", None, None),
        ("E9", "1", "HV", "d4", "p", None, None),
    )
    counts, ws = run_twice(located, lambda w: experience.import_self_employed(w, rows, as_of=NOW))
    assert counts == {"self_employed": (1, 0, 0), "custom_details": (1, 0, 0)}
    assert values(ws.tables["custom_details"], "name") == [("d1",)]
    assert experience.self_employed_funnel(ws).first()[:] == (4, 3, 2, 2)
    rows = feed(
        frame,
        "apprefno institutenameaddress award fromdate objectid filename",
        ("E1", "Inst", "BSc", "01/02/2020", "5.0", "f"),
        ("E1", "Inst", "BSc", "02/02/2020", "5", "f"),
        ("E2", "Inst", "BSc", None, "x", "f"),
    )
    counts, ws = run_twice(located, lambda w: experience.import_verifications(w, rows, as_of=NOW))
    assert counts == {"certificate_verifications": (2, 0, 0)}
    assert values(ws.tables["certificate_verifications"], "application_electrical_installation_id", "logic_doc_id") == [("i1", 5), (None, None)]


def test_water(frame, store, values):
    rows = feed(
        frame,
        "apprefno application_type license_type effective_date userid vrnno bname cmobile_no amount nofcustomer tinc tincfilename qmpfilename",
        ("W1", "renewal", "Water License", "2020-01-02 10:00:00", "U1", "v", "bank", None, "5", "12", "d", "t.pdf", None),
        ("W2", "odd", "odd", "01/02/2020", None, None, None, "0712", None, None, None, None, "q.pdf"),
        ("W2", "new", None, None, None, None, None, None, None, None, None, None, None),
    )
    counts, ws = run_twice(store, lambda w: water.import_water(w, rows, default_role=None, as_of=NOW))
    names = ("applications", "certificates", "application_sector_details", "referees", "bank_details_tanzania", "financial_information")
    assert [counts[n][0] for n in names] == [2, 2, 2, 1, 1, 2]
    assert [counts[n][0] for n in ("applicant_proposed_investment", "project_description", "documents")] == [1, 1, 2]
    assert values(ws.tables["applications"], "application_number", "application_type", "license_type") == [("W1", "RENEW", "LICENSE_WATER"), ("W2", None, None)]
    assert values(ws.tables["documents"], "document_name", "documents_order", "document_url") == [("QMP", 28, None), ("TIN_CERTIFICATE", 1, "d")]
    owners = values(ws.tables["applications"].filter("application_number = 'W1'"), "created_by")
    assert owners == values(ws.tables["users"], "id")


def test_categories_and_fees(frame, store, values):
    store.replace("sectors", frame("id string, name string", ("s1", "ELECTRICITY")))
    store.replace("categories", frame("id string, name string, has_fee_range boolean", ("c1", "generation", True), ("c2", "Generation", False)))
    rows = feed(
        frame,
        "categoryorclass licencetype applicationtype appfee licencefee prefix licenseprefix licenseperiod capacityfrom capacityto has_fee_range",
        ("GENERATION", "Provisional", "new", "x", "5", "P", "L", "36.0", "1", "Above", "no"),
        ("generation ", "provisional", "NEW", "7", "5", "p", "l", "36", "1.0", "Above", "no"),
        ("Supply", "Construction", None, "10", None, None, None, None, None, None, "yes"),
    )
    counts, ws = run_twice(store, lambda w: fees.import_categories_and_fees(w, rows, "ELECTRICITY", as_of=NOW))
    assert counts["categories"] == (1, 1, 1)
    assert counts["application_category_fees"] == (3, 0, 0)  # both spellings of generation, and supply
    first = ws.tables["application_category_fees"].filter("category_id = 'c1'").first()
    assert (float(first.application_fee), first.months_eligible, first.license_type) == (240000.0, 36, "PROVISIONAL")
    supply = ws.tables["application_category_fees"].filter("capacity_to = '10'").first()
    assert (supply.application_prefix, float(supply.license_fee), supply.months_eligible) == ("AECBL", 120500000.0, 36)
    assert values(ws.tables["categories"].filter("id = 'c1'"), "name", "has_fee_range") == [("GENERATION", True)]
    with pytest.raises(Exception, match="licencetype"):
        fees.import_categories_and_fees(Workspace(), rows.drop("licencetype"), "PETROLEUM", sector_id="s")


def test_category_upload(frame, store):
    store.replace("sectors", frame("id string, name string", ("s1", "Water")))
    rows = feed(frame, "category_name sector_name", ("A", "water"), ("a ", "WATER"), ("B", "none"), ("nan", "water"))
    counts, ws = run_twice(store, lambda w: directory.import_categories(w, rows, as_of=NOW))
    assert counts["categories"] == (1, 0, 0)
    report = directory.category_upload_report(ws).first().asDict()
    assert report == {"processed": 3, "skipped_no_sector": 1, "inserted": 0, "skipped_existing": 2}


def test_users(frame, store, values):
    header = "firstname lastname username password status mobilenumber emailid user_category account_type auth_mode role"
    rows = feed(
        frame,
        header,
        ("Al", "Fox", "al", "pw1", "locked", "1", None, None, None, None, "admin"),
        (None, "Fox", "al ", "pw2", None, "2", None, None, None, None, "clerk"),
    )
    counts, ws = run_twice(store, lambda w: directory.import_users(w, rows, as_of=NOW))
    assert counts == {"users": (1, 0, 0), "roles": (2, 0, 0), "user_roles": (2, 0, 0)}
    user = ws.tables["users"].first()
    assert (user.full_name, user.status, user.phone_number, user.auth_mode, user.password_hash) == (" Fox", "ACTIVE", "2", "DB", None)
    kept = Workspace()
    directory.import_users(kept, rows, keep_password=True, as_of=NOW)
    assert kept.merged["users"].first().password_hash == "pw2"
    assert "password" not in ws.staged["users"].columns


def test_post_import_chain(frame, values):
    tables = {
        "applications": frame("id string, username string, created_by string", ("a1", "Al ", None)),
        "users": frame("id string, username string", ("u1", "al")),
        "application_sector_details": frame("id string, application_id string", ("d1", "a1")),
        "documents": frame("id string, application_sector_detail_id string, application_id string, created_by string", ("x", "d1", None, None)),
    }
    ws = Workspace(tables)
    results = maintenance.post_import(ws)
    assert [r.ok for r in results] == [True, True, True]
    assert values(ws.tables["documents"]) == [("x", "d1", "a1", "u1")]
    assert values(ws.tables["applications"], "created_by") == [("u1",)]


def test_fix_certificates(frame, store, values):
    store.replace("applications", frame("id string, approval_no string, category_id string, expire_date date, intimate_date date"))
    ws = Workspace(
        {
            "applications": frame("id string, approval_no string, category_id string", ("a1", "L1 ", "c1")).withColumn("expire_date", F.lit("2024-08-31").cast("date")),
            "categories": frame("id string, category_type string, sector_id string", ("c1", "License", "s1")),
            "sectors": frame("id string, name string", ("s1", "WATER")),
            "certificates": frame("id string, application_id string, approval_no string", ("k1", "a1", "L1"), ("k2", "a1", "L1")),
        }
    )
    maintenance.fix_certificates(ws)
    assert values(ws.tables["certificates"], "id", "sector", "certificate_type") == [("k1", "WATER", "License")]
    row = ws.tables["applications"].first()
    assert (str(row.intimate_date), row.certificate_id) == ("2024-02-29", "k1")


def test_post_import_repairs_a_stored_registry(spark, store, frame, values):
    store.replace("applications", frame("id string, username string, created_by string", ("a1", "Al ", None)))
    store.replace("users", frame("id string, username string", ("u1", "al")))
    store.replace("application_sector_details", frame("id string, application_id string", ("d1", "a1")))
    store.replace("documents", frame("id string, application_sector_detail_id string, application_id string, created_by string", ("x", "d1", None, None)))
    results = maintenance.post_import(Workspace(store=store))
    assert [(r.name, r.ok, r.rows) for r in results] == [("align_schema", True, 0), ("application_id", True, 1), ("created_by", True, 2)]
    assert values(store.read("documents")) == [("x", "d1", "a1", "u1")]
    again = maintenance.post_import(Workspace(store=store))
    assert [r.rows for r in again] == [0, 0, 0]


def test_user_names_are_the_same_whatever_their_case(store, frame, values):
    columns = "_row int, firstname string, lastname string, username string, password string, status string, mobilenumber string, emailid string, user_category string, account_type string, auth_mode string, role string"
    row = lambda n, name, phone: (n, "F", "L", name, "pw", "", phone, "", "", "", "", "Clerk")
    feed = frame(columns, row(1, "Bob", "1"), row(2, "bob", "2"), row(3, " BOB", "3"), row(4, "Eve", "4"))
    store.replace("users", frame("id string, username string, phone_number string", ("u9", "EVE", "0")))
    ws = Workspace(store=store)
    directory.import_users(ws, feed, as_of=NOW)
    assert values(store.read("users"), "username", "phone_number", "_action") == [("BOB", "3", "insert"), ("EVE", "4", "update")]
    assert store.read("users").select("id").distinct().count() == 2
    assert store.read("user_roles").filter("user_id is not null").count() == 2


def test_water_numbers_are_the_same_whatever_their_case(store, frame, values):
    feed = frame("_row int, apprefno string, company_name string, amount string", (1, "W-1", "first", "5"), (2, "w-1", "second", "6"), (3, "w-2", "x", "7"))
    store.replace("applications", frame("id string, application_number string", ("old", "W-2")))
    ws = Workspace(store=store)
    water.import_water(ws, feed, as_of=NOW)
    assert values(store.read("applications"), "application_number") == [("W-1",), ("W-2",)]
    for name in ("applications", "application_sector_details", "financial_information", "certificates"):
        table = store.read(name)
        assert table.count() == table.select("id").distinct().count() == 2
    assert values(store.read("application_sector_details").filter("application_id = 'old'"), "company_name") == [("x",)]


def test_provisioning_rewrites_the_buckets_of_new_users(frame, store):
    """Users and their roles are added where they belong; the parts of all others are carried over."""
    store.buckets = 64
    store.replace("roles", frame("id string, name string", ("r1", "DEFAULT ROLE")))
    names = frame("u string", *[(f"user{i}",) for i in range(200)])
    common.provision_users(Workspace(store=store), lambda: names, "u", "DEFAULT ROLE", NOW)
    before = {n: set(store.manifest(n).parts) for n in ("users", "user_roles")}
    ws = Workspace(store=store)
    common.provision_users(ws, lambda: frame("u string", (" USER7",), ("new one",)), "u", "default role", NOW)
    for name in ("users", "user_roles"):
        assert len(before[name] - set(store.manifest(name).parts)) <= 2 < len(before[name])
        assert store.read(name).count() == 201
    assert {r["table_name"]: (r["inserted"], r["kept"]) for r in ws.summary().collect()} == {"users": (1, 200), "user_roles": (1, 200)}


def _registry(frame):
    return {
        "applications": frame("id string, username string, created_by string", ("A1", " Ann", None), ("A2", "ann", "boss"), ("A3", "x", None)),
        "users": frame("id string, username string", ("7", "ann")),
        "application_sector_details": frame("id string, application_id string", ("D1", "A1"), ("D2", None), ("D3", "A3")),
        "documents": frame(
            "id string, application_sector_detail_id string, application_id string, created_by string",
            ("x1", "D1", None, None), ("x2", "D1", None, "clerk"), ("x3", "D2", None, None), ("x4", None, "A1", None), ("x4", None, None, None), ("x5", "D3", None, None),
        ),
    }


def test_post_import_preview_looks_up_only_rows_that_may_change(spark, frame, values):
    tables = _registry(frame)
    # A second row of an application doubles the creators to set, not the application ids.
    tables["applications"] = tables["applications"].unionByName(tables["applications"].filter("id = 'A1'"))
    jobs = maintenance.post_import_jobs(tables)
    found = {step: values(b.preview_all(of), "table_name", "rows_to_change") for step, of in jobs.items()}
    assert found == {"application_id": [("documents", 3)], "created_by": [("applications", 4), ("documents", 4)]}
    assert jobs["application_id"]["documents"].possible().count() == 4
    assert {n: job.candidates.where(CHANGED).count() for n, job in jobs["created_by"].items()} == {"applications": 4, "documents": 4}


def test_post_import_shuffles_no_ids_that_only_spread_rows(spark, frame, values):
    jobs = maintenance.post_import_jobs(_registry(frame))["created_by"]["documents"]
    assert jobs.columns == ("id", "application_sector_detail_id", "application_id", "created_by")
    assert values(jobs.apply()) == [
        ("x1", "D1", "A1", "7"), ("x2", "D1", "A1", "clerk"), ("x3", "D2", None, None), ("x4", None, "A1", "7"), ("x4", None, None, None), ("x5", "D3", "A3", None),
    ]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = jobs.apply().select("application_id", "created_by")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert not [line for line in plan.splitlines() if "Exchange hashpartitioning" in line and "xxhash64(id" in line]
