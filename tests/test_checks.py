"""Every kind of reject, in every feed that can have it."""

import pytest

from ledgerlift.plans import checks


def feed(frame, header, *rows):
    names = ["_row", *header]
    return frame("_row int, " + ", ".join(f"`{n}` string" for n in names[1:]), *[(i, *r) for i, r in enumerate(rows, start=1)])


def found(df):
    return sorted((r["_row"], r["code"], r["column_name"], r["value"]) for r in df.collect())


def test_six_kinds_of_rejects(frame):
    rows = feed(
        frame,
        ["App Ref No", "AppNo", "approval no", "application_type", "expiry date", "latitude", "region", "parent_application_id", "road"],
        (None, "A-1", "L1", "renewal", "2020-01-31", "-6.1", "1", "p1", "short"),
        (None, " a-1 ", "L2", "sideways", "31st of May", "6S", "9", "p9", "a road that is too long"),
        (None, "nan", None, None, None, None, None, None, None),
    )
    hub, regions = frame("id string", ("p1",)), frame("id string, name string", ("1", "MARA"))
    got = found(checks.rejected_rows(rows, checks.FEEDS["applications"], hub, {"region": regions}, longest=20))
    assert got == [
        (2, "duplicate_key", "application_number", "a-1"),
        (2, "missing_parent", "old_parent_application_id", "p9"),
        (2, "too_long", "road", "a road that is too long"),
        (2, "unknown_value", "application_type", "sideways"),
        (2, "unknown_value", "region", "9"),
        (2, "unreadable_date", "expire_date", "31st of May"),
        (2, "wrong_type", "latitude", "6S"),
        (3, "missing_key", "application_number", None),
        (3, "missing_key", "approval_no", None),
    ]
    # Without the tables there is nothing to look up.
    plain = found(checks.rejected_rows(rows, checks.FEEDS["applications"]))
    assert {c for _, c, _, _ in plain} == {"duplicate_key", "unknown_value", "unreadable_date", "wrong_type", "missing_key"}
    counts = checks.reject_counts(checks.rejected_rows(rows, checks.FEEDS["applications"])).first()
    assert (counts["code"], counts["rows"]) == ("duplicate_key", 1)


@pytest.mark.parametrize("name", sorted(checks.FEEDS))
def test_every_feed_reports_missing_and_repeated_keys(frame, name):
    rules = checks.FEEDS[name]
    header = sorted({a for a, c in rules.aliases.items() if c in (*rules.keys, *rules.required)})
    canonical = {}
    for alias in header:
        canonical.setdefault(rules.aliases[alias], alias)
    columns = list(canonical.values())
    rows = feed(frame, columns, ["x"] * len(columns), [" X"] * len(columns), [None] * len(columns))
    got = found(checks.rejected_rows(rows, rules))
    assert [(3, "missing_key", c, None) for c in sorted((*rules.keys, *rules.required))] == [g for g in got if g[1] == "missing_key"]
    assert [g[:2] for g in got if g[1] == "duplicate_key"] == ([(2, "duplicate_key")] if rules.keys else [])
    assert {*rules.keys, *rules.required, *rules.dates, *rules.numbers, *rules.words, *rules.ids} <= set(rules.aliases.values())


def test_headers_and_unresolved_ids_of_a_feed(frame):
    rows = feed(frame, ["AppRefNo", "Ward ", "colour"], ("W-1", "12.0", "red"), ("W-2", "Town", None))
    report = checks.feed_headers(rows, checks.FEEDS["water"])
    assert report["found"] == ["apprefno", "ward"] and report["unused"] == ["colour"] and "approval_no" in report["missing"]
    staged = frame("application_number string, ward string", ("W-1", "12.0"), ("W-2", "Town"), ("W-3", None))
    assert [r[0] for r in checks.unresolved_ids(staged, checks.FEEDS["water"]).collect()] == ["W-1"]
