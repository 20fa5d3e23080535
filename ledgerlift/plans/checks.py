"""What the rows of each feed must satisfy, and the reports on rows and headers that don't.

A reject names the row, the rule, the column and the value.  None of them stops an import, which
does what the plans say; the report tells an operator why a row has gaps or is missing.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlift.functions import fixed_values as fixed
from ledgerlift.functions import clean, license_type, parse_date, water_application_type
from ledgerlift.functions.text import blank_to_null, key_text
from ledgerlift.operators.joins import lookup
from ledgerlift.operators.profile import column_presence, rejects, suspicious_rows
from ledgerlift.plans import applications, electrical, experience, people, water
from ledgerlift.plans.common import prepared
from ledgerlift.plans.directory import USER_COLUMNS
from ledgerlift.sources.dimensions import id_key
from ledgerlift.sources.grid import ROW, apply_aliases, header_name

Test = Callable[[Column], Column]


@dataclass(frozen=True)
class FeedChecks:
    """The rules of one feed, by the names that `aliases` give its headers.

    * ``keys``: columns that a row must have, and that together occur once.
    * ``required``: further columns that a row must have.
    * ``parent``: column of the row and column of the table it must point into.
    * ``dates``, ``numbers``: layouts and shape of a value; ``words``: how a word is mapped, NULL if unknown.
    * ``ids``: columns that hold ids of a reference table of that name.
    """

    aliases: Mapping[str, str]
    keys: tuple[str, ...] = ()
    required: tuple[str, ...] = ()
    parent: tuple[str, str] | None = None
    dates: Mapping[str, Sequence[str]] = field(default_factory=dict)
    numbers: Mapping[str, str] = field(default_factory=dict)
    words: Mapping[str, Test] = field(default_factory=dict)
    ids: Mapping[str, str] = field(default_factory=dict)
    dialect: str = "general"


CODES = ("missing_key", "duplicate_key", "missing_parent", "unreadable_date", "wrong_type", "unknown_value", "too_long")


def _named(*columns: str, **aliases: str) -> dict[str, str]:
    return {c: c for c in columns} | aliases


def _listed(synonyms: Mapping[str, str]) -> Test:
    """The word where it is a synonym or a value of the list."""
    words = sorted({w.lower() for pair in synonyms.items() for w in pair})
    return lambda c: F.when(F.lower(c).isin(*words), c)


_OF_NUMBER = ("application_number", "application_number")
_PLACES = {"region": "region", "district": "district", "ward": "ward"}
_EXPERIENCE = _named("supervisordetail", "roleandresponsibility", "voltagelevel", "workperformed", "position", "wfromdate", "wtodate", apprefno="application_number")
_PEOPLE = {"apprefno": "application_number"}


def _canonical(aliases: Mapping[str, str], names: Mapping[str, str]) -> dict[str, str]:
    """Aliases of headers, and the canonical headers themselves first, under the names of the rules."""
    return dict(names) | {a: names[c] for a, c in aliases.items() if c in names}


FEEDS: dict[str, FeedChecks] = {
    "applications": FeedChecks(
        applications.ALIASES,
        keys=("application_number",),
        required=("approval_no",),
        parent=("old_parent_application_id", "id"),
        dates={c: fixed.DATES_APPLICATION for c in applications.DATE_COLUMNS},
        numbers={"latitude": fixed.DECIMAL, "longitude": fixed.DECIMAL},
        words={"application_type": _listed(fixed.APPLICATION_TYPE_SYNONYMS)},
        ids=_PLACES,
        dialect="application",
    ),
    "shareholders": FeedChecks(
        _named("shname", *people.SHAREHOLDER_OPTIONAL) | _PEOPLE,
        keys=("application_number", "shname"),
        parent=_OF_NUMBER,
        numbers={"amountofshare": fixed.UNSIGNED_DECIMAL, "objectid": fixed.UNSIGNED_DECIMAL},
        ids={"nationality": "country"},
    ),
    "directors": FeedChecks(
        _named("name", *people.DIRECTOR_OPTIONAL) | _PEOPLE,
        keys=("application_number", "name"),
        parent=_OF_NUMBER,
        numbers={"workpermit": fixed.UNSIGNED_DECIMAL, "cpana": fixed.UNSIGNED_DECIMAL},
        ids={"nationality1": "country"},
    ),
    "installations": FeedChecks(
        _named("application_number", *electrical.OPTIONAL),
        keys=("application_number",),
        dates={c: fixed.DATES_PLAIN for c in ("effective_date", "expire_date", "completed_at", "created_at", "dateofbirth")},
        numbers={"workpermitno": fixed.DECIMAL, "iftanzanian": fixed.DECIMAL, "cpphoto": fixed.DECIMAL},
        words={"application_type": _listed(fixed.INSTALLATION_TYPE_SYNONYMS), "employmentstatus": _listed(fixed.EXPERIENCE_SYNONYMS)},
        ids=_PLACES,
    ),
    "work_experience": FeedChecks(
        _canonical(experience.EXPERIENCE_ALIASES, _EXPERIENCE),
        required=("application_number", "supervisordetail"),
        parent=_OF_NUMBER,
        dates={c: fixed.DATES_EXPERIENCE for c in ("wfromdate", "wtodate")},
    ),
    "supervisor_details": FeedChecks(
        _canonical(experience.EXPERIENCE_ALIASES, _EXPERIENCE),
        keys=("application_number", "supervisordetail", "wfromdate", "wtodate"),
        parent=_OF_NUMBER,
        dates={c: fixed.DATES_EXPERIENCE for c in ("wfromdate", "wtodate")},
    ),
    "self_employed": FeedChecks(
        _canonical(experience.SELF_EMPLOYED_ALIASES, _named("sno", "sfevoltagelevel", "sfecustomdetails", "projectperformed", "sfefromdate", "sfetodate", apprefno="application_number")),
        required=("application_number",),
        parent=_OF_NUMBER,
        dates={c: fixed.DATES_EXPERIENCE for c in ("sfefromdate", "sfetodate")},
        numbers={"sno": fixed.UNSIGNED_DECIMAL},
    ),
    "verifications": FeedChecks(
        _named("institutenameaddress", "award", "sno", "fromdate", "todate", "objectid", "filename", apprefno="application_number"),
        keys=("application_number", "institutenameaddress", "award"),
        parent=_OF_NUMBER,
        dates={c: fixed.DATES_PLAIN for c in ("fromdate", "todate")},
        numbers={"objectid": fixed.UNSIGNED_DECIMAL},
    ),
    "water": FeedChecks(
        water.ALIASES,
        keys=("application_number",),
        required=("approval_no",),
        parent=("old_parent_application_id", "id"),
        dates={c: fixed.DATES_PLAIN for c in ("effective_date", "expire_date", "completed_at")},
        numbers={"latitude": fixed.DECIMAL, "longitude": fixed.DECIMAL},
        words={"application_type": water_application_type, "license_type": license_type},
        ids=_PLACES,
    ),
    "categories": FeedChecks(_named("category_name", "sector_name"), keys=("category_name",), required=("sector_name",), parent=("sector_name", "name")),
    "users": FeedChecks(_named(*(c for c in USER_COLUMNS if c != "password")), keys=("username",), required=("role",), dialect="user"),
    "fees": FeedChecks(
        _named("license_type", "fees_type", "thereof_factor", "thereof_price", "months"),
        required=("license_type",),
        numbers={"thereof_factor": fixed.INTEGER, "thereof_price": fixed.DECIMAL, "months": fixed.DECIMAL},
    ),
}


def _cells(feed: DataFrame, checks: FeedChecks) -> DataFrame:
    """The feed's known columns under the names of the rules, cleaned, with the place of each row."""
    staged = apply_aliases(prepared(feed), checks.aliases)
    return staged.select(ROW, *[clean(c, checks.dialect).alias(c) for c in staged.columns if c != ROW])


def rejected_rows(
    feed: DataFrame,
    checks: FeedChecks,
    parents: DataFrame | None = None,
    references: Mapping[str, DataFrame] | None = None,
    longest: int = 10_000,
) -> DataFrame:
    """(_row, code, column_name, value), one row for each rule that a row of the feed breaks.

    A key is missing, or the row repeats an earlier one's; its parent is not among `parents`; a date is in
    no layout, a number no number, a word in no list, an id in no table of `references` (id, name); a
    text is longer than `longest`.  Rules whose table is not given are left out.  Rows are joined
    with the first row of each key, the parents and the references, one equi-join each.
    """
    rows = _cells(feed, checks)
    rules: dict[str, tuple[str, Column]] = {f"missing_key:{c}": (c, F.col(c).isNull()) for c in (*checks.keys, *checks.required)}
    if checks.keys:
        whole = F.forall(F.array(*map(F.col, checks.keys)), lambda c: c.isNotNull())
        key = F.when(whole, F.concat_ws("\u0001", *[key_text(c) for c in checks.keys]))
        keyed = rows.withColumn("__key", key)
        firsts = keyed.where(F.col("__key").isNotNull()).groupBy(F.col("__key").alias("__k")).agg(F.min(ROW).alias("__first"))
        rows = lookup(keyed, firsts, "__key", "__k", {"__first": "__first"}, normalise=None, unique=True)
        rules["duplicate_key:"] = (checks.keys[0], F.col(ROW) > F.col("__first"))
    if checks.parent and parents is not None:
        column, target = checks.parent
        rows = lookup(rows, parents, column, target, {"__parent": F.lit(True)}, blank_to_null)
        rules["missing_parent:"] = (column, F.col(column).isNotNull() & F.col("__parent").isNull())
    for column, name in checks.ids.items():
        if name in (references or {}):
            rows = lookup(rows, references[name], column, "id", {f"__known_{column}": F.lit(True)}, id_key)
            rules[f"unknown_value:{column}"] = (column, F.col(column).isNotNull() & F.col(f"__known_{column}").isNull())
    rules |= {f"unreadable_date:{c}": (c, F.col(c).isNotNull() & parse_date(c, layouts, dialect=None).isNull()) for c, layouts in checks.dates.items()}
    rules |= {f"wrong_type:{c}": (c, ~F.col(c).rlike(shape)) for c, shape in checks.numbers.items()}
    rules |= {f"unknown_value:{c}:word": (c, F.col(c).isNotNull() & test(F.col(c)).isNull()) for c, test in checks.words.items()}
    texts = [c for c in rows.columns if c != ROW and not c.startswith("__") and c not in checks.dates]
    rules |= {f"too_long:{c}": (c, F.length(c) > longest) for c in texts}
    found = rejects(rows, rules, ROW)
    return found.withColumn("code", F.substring_index("code", ":", 1))


def reject_counts(found: DataFrame) -> DataFrame:
    """Rejects by code and column, the most frequent first, each with its least value as an example."""
    counts = found.groupBy("code", "column_name").agg(F.count(F.lit(1)).alias("rows"), F.min("value").alias("example"))
    return counts.orderBy(F.desc("rows"), "code", "column_name")


def feed_headers(feed: DataFrame, checks: FeedChecks) -> dict[str, list[str]]:
    """Which known headers a feed has, lacks, and which of its columns nothing reads; no row is read."""
    return column_presence([header_name(c) for c in feed.columns if c != ROW], sorted(checks.aliases))


def unresolved_ids(staged: DataFrame, checks: FeedChecks) -> DataFrame:
    """Staged rows in which a place is still an id."""
    return suspicious_rows(staged, [c for c in checks.ids if c in staged.columns], fixed.UNSIGNED_DECIMAL)
