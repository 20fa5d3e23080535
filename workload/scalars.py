"""Cleaning expressions and predicates over the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerlift import functions as L
from ledgerlift.functions import fixed_values as fixed
from workload.registry import Tables, query

# Text as it arrives from spreadsheets, derived from clean columns in Spark and in SQL alike.
_MARKED = (
    "CASE c_mktsegment WHEN 'BUILDING' THEN ' NaN ' WHEN 'MACHINERY' THEN 'None' WHEN 'AUTOMOBILE' THEN 'papprefno' "
    "WHEN 'FURNITURE' THEN '   ' ELSE concat('  ', c_name, ' ') END"
)


@query(
    "clean_markers",
    f"""WITH x AS (SELECT c_custkey, {_MARKED} AS raw FROM customer)
    SELECT c_custkey,
      CASE WHEN lower(trim(raw)) NOT IN ('','nan','nat','none','null','papprefno') THEN trim(raw) END AS application,
      CASE WHEN lower(trim(raw)) NOT IN ('','nan','none','null','nat') THEN trim(raw) END AS general,
      CASE WHEN lower(trim(raw)) NOT IN ('','nan') THEN trim(raw) END AS user_text
    FROM x""",
)
def clean_markers(t: Tables):
    raw = t.customer.select("c_custkey", F.expr(_MARKED).alias("raw"))
    return raw.select(
        "c_custkey",
        L.clean("raw", "application").alias("application"),
        L.clean("raw", "general").alias("general"),
        L.clean("raw", "user").alias("user_text"),
    )


_BLANKED = "CASE o_orderpriority WHEN '1-URGENT' THEN '\\\\N' WHEN '2-HIGH' THEN '  ' ELSE concat(' ', o_orderpriority) END"


@query(
    "blank_to_null",
    """SELECT o_orderkey, CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN NULL ELSE o_orderpriority END AS priority
    FROM orders""",
)
def blank_to_null(t: Tables):
    return t.orders.select("o_orderkey", L.blank_to_null(F.expr(_BLANKED)).alias("priority"))


# Numbers as text: float rendering, exponent, fraction, and words.
_NUMBER = (
    "CASE p_type WHEN 'ECONOMY' THEN concat(p_partkey, '.0') WHEN 'SMALL' THEN concat(p_partkey, '.5e+3') "
    "WHEN 'LARGE' THEN concat(' ', p_partkey, '.25') WHEN 'MEDIUM' THEN p_name ELSE concat(p_partkey, '') END"
)


@query(
    "numeric_normalise",
    f"""WITH x AS (SELECT p_partkey, trim({_NUMBER}) AS raw FROM part),
    y AS (SELECT *, try_cast(raw AS DECIMAL(38,6)) AS d FROM x)
    SELECT p_partkey,
      CASE WHEN d = trunc(d) THEN CAST(CAST(trunc(d) AS BIGINT) AS VARCHAR) ELSE raw END AS kept,
      CAST(CAST(trunc(d) AS BIGINT) AS VARCHAR) AS whole,
      coalesce(CAST(CAST(trunc(d) AS BIGINT) AS VARCHAR), raw) AS truncated
    FROM y""",
)
def numeric_normalise(t: Tables):
    raw = t.part.select("p_partkey", F.expr(_NUMBER).alias("raw"))
    return raw.select(
        "p_partkey",
        L.int_text("raw", "keep").alias("kept"),
        L.int_text("raw", "null").alias("whole"),
        L.int_text("raw", "truncate").alias("truncated"),
    )


@query(
    "guarded_cast",
    f"""WITH x AS (SELECT p_partkey, {_NUMBER} AS raw FROM part)
    SELECT p_partkey,
      coalesce(CASE WHEN regexp_matches(trim(raw), '{fixed.DECIMAL}') THEN try_cast(trim(raw) AS DECIMAL(38,6)) END, 240000) AS application_fee,
      coalesce(CASE WHEN regexp_matches(trim(raw), '{fixed.DECIMAL}') THEN CAST(trunc(try_cast(trim(raw) AS DECIMAL(38,6))) AS BIGINT) END, 36) AS months,
      CASE WHEN regexp_matches(trim(raw), '{fixed.DIGITS}') THEN try_cast(trim(raw) AS BIGINT) END AS document_id
    FROM x""",
)
def guarded_cast(t: Tables):
    raw = t.part.select("p_partkey", F.expr(_NUMBER).alias("raw"))
    return raw.select(
        "p_partkey",
        L.cast_or("raw", "decimal(38,6)", fixed.DEFAULT_APPLICATION_FEE, fixed.DECIMAL).alias("application_fee"),
        L.cast_or("raw", "bigint", fixed.DEFAULT_MONTHS, fixed.DECIMAL).alias("months"),
        L.cast_or("raw", "bigint", pattern=fixed.DIGITS).alias("document_id"),
    )


def rendered_date():
    """Order dates in the layouts uploads use, one layout per priority."""
    day = F.col("o_orderdate").cast("date")
    serial = F.datediff(day, F.lit("1899-12-30").cast("date")).cast("string")
    return (
        F.when(F.col("o_orderpriority") == "1-URGENT", F.date_format(day, "yyyy-MM-dd 00:00:00"))
        .when(F.col("o_orderpriority") == "2-HIGH", F.date_format(day, "d/M/yyyy"))
        .when(F.col("o_orderpriority") == "3-MEDIUM", F.date_format(day, "M/d/yyyy"))
        .when(F.col("o_orderpriority") == "4-NOT SPECIFIED", F.concat(serial, F.lit(".0")))
        .otherwise(F.concat(F.lit("due "), F.date_format(day, "yyyy")))
    )


RENDERED_DATE_SQL = """CASE o_orderpriority
    WHEN '1-URGENT' THEN strftime(o_orderdate, '%Y-%m-%d 00:00:00')
    WHEN '2-HIGH' THEN strftime(o_orderdate, '%-d/%-m/%Y')
    WHEN '3-MEDIUM' THEN strftime(o_orderdate, '%-m/%-d/%Y')
    WHEN '4-NOT SPECIFIED' THEN CAST(date_diff('day', DATE '1899-12-30', CAST(o_orderdate AS DATE)) AS VARCHAR) || '.0'
    ELSE 'due ' || strftime(o_orderdate, '%Y') END"""


def parsed_date_sql(raw: str) -> str:
    """SQL for the application date rule on text `raw`."""
    formats = ", ".join(f"'{f}'" for f in fixed.DATES_APPLICATION)
    return f"""coalesce(CAST(try_strptime({raw}, [{formats}]) AS DATE),
      CASE WHEN try_cast({raw} AS DOUBLE) > 1000 THEN DATE '1899-12-30' + CAST(floor(try_cast({raw} AS DOUBLE)) AS INTEGER) END)"""


@query(
    "parse_dates",
    f"""WITH x AS (SELECT o_orderkey, {RENDERED_DATE_SQL} AS raw FROM orders)
    SELECT o_orderkey, {parsed_date_sql('raw')} AS any_layout,
      CAST(try_strptime(raw, ['%Y-%m-%d', '%d/%m/%Y', '%d-%m-%Y', '%m/%d/%Y', '%Y/%m/%d']) AS DATE) AS plain_layout
    FROM x""",
)
def parse_dates(t: Tables):
    raw = t.orders.select("o_orderkey", rendered_date().alias("raw"))
    return raw.select(
        "o_orderkey",
        L.parse_date("raw").alias("any_layout"),
        L.parse_date("raw", fixed.DATES_PLAIN, serial=False).alias("plain_layout"),
    )


_TYPE_WORD = (
    "CASE o_orderpriority WHEN '1-URGENT' THEN 'Renewal' WHEN '2-HIGH' THEN ' extension ' WHEN '3-MEDIUM' THEN 'changes' "
    "WHEN '4-NOT SPECIFIED' THEN 'Upgrade' ELSE 'Odd' END"
)


@query(
    "enum_map",
    """SELECT o_orderkey,
      CASE o_orderpriority WHEN '1-URGENT' THEN 'RENEW' WHEN '2-HIGH' THEN 'EXTEND' WHEN '3-MEDIUM' THEN 'CHANGE_OF_NAME'
        WHEN '4-NOT SPECIFIED' THEN 'UPGRADE' ELSE 'ODD' END AS application_type,
      CASE o_orderpriority WHEN '1-URGENT' THEN 'RENEW' WHEN '2-HIGH' THEN 'EXTEND' WHEN '4-NOT SPECIFIED' THEN 'UPGRADE' END AS water_type,
      CASE o_orderstatus WHEN 'P' THEN 'SELF_EMPLOYED' WHEN 'F' THEN 'FRESH_FROM_COLLEGE' ELSE 'EMPLOYED' END AS experience,
      CASE o_orderstatus WHEN 'P' THEN 'LICENSE_WATER' WHEN 'F' THEN 'LICENSE_PETROLEUM' END AS license_type
    FROM orders""",
)
def enum_map(t: Tables):
    status = F.col("o_orderstatus")
    job = F.when(status == "P", F.lit(" Self employed")).when(status == "F", F.lit("fresh from college")).otherwise(F.lit("?"))
    kind = F.when(status == "P", F.lit("Water & Sanitation Licenses")).when(status == "F", F.lit("license_petroleum"))
    return t.orders.select(
        "o_orderkey",
        L.application_type(F.expr(_TYPE_WORD)).alias("application_type"),
        L.water_application_type(F.expr(_TYPE_WORD)).alias("water_type"),
        L.experience_type(job).alias("experience"),
        L.license_type(kind.otherwise(F.lit("other"))).alias("license_type"),
    )


@query(
    "nationality_enum",
    """SELECT c_custkey, CASE c_mktsegment WHEN 'BUILDING' THEN 'TANZANIAN' WHEN 'MACHINERY' THEN 'NON_TANZANIAN'
      WHEN 'AUTOMOBILE' THEN 'NON_TANZANIAN' END AS nationality FROM customer""",
)
def nationality_enum(t: Tables):
    word = F.expr(
        "CASE c_mktsegment WHEN 'BUILDING' THEN ' Tanzanian' WHEN 'MACHINERY' THEN 'Non Tanzanian' "
        "WHEN 'AUTOMOBILE' THEN 'non-tanzanian' ELSE c_name END"
    )
    return t.customer.select("c_custkey", L.nationality(word).alias("nationality"))


@query(
    "bool_and_units",
    """SELECT p_partkey, p_type IN ('ECONOMY', 'SMALL') AS flag,
      CASE p_type WHEN 'ECONOMY' THEN 'kV' WHEN 'SMALL' THEN 'MW' END AS unit,
      CASE p_type WHEN 'LARGE' THEN 'LV_1' ELSE 'HV' END AS voltage
    FROM part""",
)
def bool_and_units(t: Tables):
    flag = F.expr("CASE p_type WHEN 'ECONOMY' THEN 'yes ' WHEN 'SMALL' THEN '1' WHEN 'LARGE' THEN 'no' END")
    unit = F.expr("CASE p_type WHEN 'ECONOMY' THEN 'KV' WHEN 'SMALL' THEN ' mw' ELSE 'kg' END")
    level = F.expr("CASE p_type WHEN 'LARGE' THEN 'lv_1' ELSE 'none' END")
    return t.part.select(
        "p_partkey",
        L.parse_bool(flag).alias("flag"),
        L.capacity_unit(unit).alias("unit"),
        L.voltage_level(level, "ELECTRICITY").alias("voltage"),
    )


@query(
    "derived_license_type",
    """SELECT p_partkey,
      CASE WHEN p_type = 'ECONOMY' THEN CASE WHEN p_size > 25 THEN 'CONSTRUCTION_PETROLEUM' ELSE 'LICENSE_PETROLEUM' END
        WHEN p_type = 'SMALL' THEN CASE WHEN p_size > 25 THEN 'CONSTRUCTION_NATURAL_GAS' ELSE 'LICENSE_NATURAL_GAS' END
        WHEN p_type = 'LARGE' THEN 'LICENSE_ELECTRICITY_INSTALLATION'
        ELSE CASE WHEN p_size > 25 THEN p_brand ELSE 'LICENSE_WATER' END END AS license_type
    FROM part""",
)
def derived_license_type(t: Tables):
    sector = F.expr(
        "CASE p_type WHEN 'ECONOMY' THEN 'PETROLEUM' WHEN 'SMALL' THEN 'NATURAL_GAS' WHEN 'LARGE' THEN 'ELECTRICITY' ELSE 'WATER_SUPPLY' END"
    )
    kind = F.when(F.col("p_size") > 25, F.lit("Construction")).otherwise(F.lit("License"))
    current = F.when(F.col("p_type") == "LARGE", F.lit(fixed.INSTALLATION_LICENSE)).otherwise(F.col("p_brand"))
    return t.part.select("p_partkey", L.derived_license_type(sector, kind, current).alias("license_type"))


@query(
    "stable_key",
    """SELECT s_suppkey, regexp_replace(md5(s_name || '|sd|' || CASE WHEN s_nationkey > 12 THEN CAST(s_nationkey AS VARCHAR) ELSE '' END),
      '^(.{8})(.{4})(.{4})(.{4})(.{12})$', '\\1-\\2-\\3-\\4-\\5') AS id FROM supplier""",
)
def stable_key(t: Tables):
    optional = F.when(F.col("s_nationkey") > 12, F.col("s_nationkey"))
    return t.supplier.select("s_suppkey", L.stable_key("s_name", F.lit("sd"), optional).alias("id"))


_PERSON = (
    "CASE WHEN p_size < 10 THEN split_part(p_name, ' ', 1) WHEN p_size < 30 THEN concat(' ', p_name) "
    "ELSE concat(p_name, '  of  ', p_type) END"
)


@query(
    "name_split",
    f"""WITH x AS (SELECT p_partkey, regexp_split_to_array(trim({_PERSON}), '\\s+') AS w FROM part)
    SELECT p_partkey, w[1] AS first_name,
      CASE WHEN len(w) > 2 THEN array_to_string(w[2:len(w) - 1], ' ') END AS middle_name,
      CASE WHEN len(w) > 1 THEN w[len(w)] END AS last_name FROM x""",
)
def name_split(t: Tables):
    first, middle, last = L.split_name(F.expr(_PERSON))
    return t.part.select("p_partkey", first.alias("first_name"), middle.alias("middle_name"), last.alias("last_name"))


@query(
    "extract_contacts",
    f"""SELECT doc_id,
      nullif(regexp_replace(regexp_extract(text, '{fixed.PHONE}', 1), '\\s', '', 'g'), '') AS phone,
      nullif(regexp_extract(text, '{fixed.EMAIL}', 1), '') AS email,
      nullif(trim(CASE WHEN contains(text, '|') THEN split_part(text, '|', 1) ELSE split_part(text, ',', 1) END), '') AS name
    FROM documents""",
)
def extract_contacts(t: Tables):
    return t.documents.select(
        "doc_id",
        L.phone_in("text").alias("phone"),
        L.email_in("text").alias("email"),
        L.bare_name("text").alias("name"),
    )


@query(
    "label_keys",
    """SELECT p_partkey, lower(p_type || ' ' || p_name) AS label_key,
      CASE WHEN p_size > 25 THEN upper(p_brand) ELSE 'A' END AS class_code FROM part""",
)
def label_keys(t: Tables):
    label = F.concat(F.initcap("p_type"), F.initcap(F.replace("p_name", F.lit(" "), F.lit("_"))), F.lit("."))
    code = F.when(F.col("p_size") > 25, F.concat(F.lit("class  "), F.col("p_brand"))).otherwise(F.lit(" a"))
    return t.part.select("p_partkey", L.label_key(label).alias("label_key"), L.class_code(code).alias("class_code"))


@query(
    "sector_words",
    """SELECT p_partkey, CASE p_type WHEN 'ECONOMY' THEN 'petroleum' WHEN 'SMALL' THEN 'natural_gas' WHEN 'LARGE' THEN 'electricity'
      WHEN 'MEDIUM' THEN 'water_supply' ELSE 'other' END AS sector FROM part""",
)
def sector_words(t: Tables):
    text = F.expr(
        "concat(p_name, CASE p_type WHEN 'ECONOMY' THEN ' LPG supply' WHEN 'SMALL' THEN ' Natural Gas' "
        "WHEN 'LARGE' THEN ' Generation' WHEN 'MEDIUM' THEN ' Bulk Water' ELSE '' END)"
    )
    return t.part.select("p_partkey", L.sector_of(text, F.lit("other")).alias("sector"))


@query("reminder_date", "SELECT o_orderkey, CAST(CAST(o_orderdate AS DATE) - INTERVAL 6 MONTH AS DATE) AS remind_on FROM orders")
def reminder_date(t: Tables):
    return t.orders.select("o_orderkey", L.reminder_date(F.col("o_orderdate").cast("date")).alias("remind_on"))


@query(
    "text_rules",
    """SELECT s_suppkey, substr(trim(repeat(s_name, 700)), 1, 10000) AS capped,
      CASE WHEN s_nationkey > 12 THEN s_name ELSE 'nation ' || s_nationkey END AS owner,
      s_name || ' ' || CASE WHEN s_nationkey > 12 THEN CAST(s_nationkey AS VARCHAR) ELSE '' END AS full_name,
      CASE WHEN s_nationkey > 12 THEN 'LOCKED' ELSE 'ACTIVE' END AS status
    FROM supplier""",
)
def text_rules(t: Tables):
    big = F.col("s_nationkey") > 12
    owner = F.when(big, F.col("s_name")).otherwise(F.lit("nan"))
    return t.supplier.select(
        "s_suppkey",
        L.capped(F.repeat("s_name", F.lit(700)), 10_000).alias("capped"),
        L.first_present(owner, F.concat(F.lit("nation "), F.col("s_nationkey"))).alias("owner"),
        L.joined("s_name", F.when(big, F.col("s_nationkey").cast("string"))).alias("full_name"),
        L.upper_or(F.when(big, F.lit(" locked ")), "ACTIVE").alias("status"),
    )


@query("approved_only", "SELECT o_orderkey, o_custkey FROM orders WHERE o_orderpriority NOT IN ('5-LOW', '2-HIGH')")
def approved_only(t: Tables):
    approval = F.expr("CASE o_orderpriority WHEN '5-LOW' THEN 'nan' WHEN '2-HIGH' THEN ' ' ELSE o_orderpriority END")
    return t.orders.filter(L.clean(approval, "application").isNotNull()).select("o_orderkey", "o_custkey")


@query(
    "presence_guards",
    """SELECT p_partkey, p_size > 10 OR p_type = 'SMALL' AS any_of, p_size > 10 AND p_type = 'SMALL' AS both FROM part""",
)
def presence_guards(t: Tables):
    a = F.when(F.col("p_size") > 10, F.col("p_brand")).otherwise(F.lit("  "))
    b = F.when(F.col("p_type") == "SMALL", F.col("p_name"))
    return t.part.select("p_partkey", L.any_present(a, b).alias("any_of"), L.all_present(a, b).alias("both"))


@query(
    "change_only",
    """WITH x AS (SELECT c_custkey, CASE WHEN c_nationkey < 8 THEN c_mktsegment END AS old,
      CASE WHEN c_nationkey < 16 THEN c_mktsegment END AS new FROM customer)
    SELECT * FROM x WHERE old IS DISTINCT FROM new""",
)
def change_only(t: Tables):
    x = t.customer.select(
        "c_custkey",
        F.when(F.col("c_nationkey") < 8, F.col("c_mktsegment")).alias("old"),
        F.when(F.col("c_nationkey") < 16, F.col("c_mktsegment")).alias("new"),
    )
    return x.filter(L.changed([("old", "new")]))


@query(
    "live_rows",
    """WITH x AS (SELECT o_orderkey, CASE WHEN o_orderstatus <> 'O' THEN CAST(o_orderdate AS DATE) END AS deleted_at FROM orders)
    SELECT o_orderkey, deleted_at IS NULL AS live, deleted_at IS NULL OR deleted_at > DATE '1999-01-01' AS valid FROM x""",
)
def live_rows(t: Tables):
    deleted = F.when(F.col("o_orderstatus") != "O", F.col("o_orderdate").cast("date"))
    return t.orders.select(
        "o_orderkey",
        L.is_live(deleted).alias("live"),
        L.is_live(deleted, F.lit("1999-01-01").cast("date")).alias("valid"),
    )


@query("search", "SELECT * FROM part WHERE contains(lower(p_name), 'widget') AND contains(lower(p_brand), 'brand#1')")
def search(t: Tables):
    return L.search(t.part, p_name=" Widget", p_brand="BRAND#1", p_type=None)


@query(
    "shape_tests",
    r"""WITH x AS (SELECT doc_id, text || CASE doc_id % 4 WHEN 0 THEN ' 0712 345 678' WHEN 1 THEN ' +255 712345678' WHEN 2 THEN ' 0812345678' ELSE '' END AS text FROM documents)
    SELECT doc_id, regexp_matches(text, '\+?255[ \t\n\f\r]?[0-9]([ \t\n\f\r]?[0-9]){8}|0[67][0-9]([ \t\n\f\r]?[0-9]){7}') AS has_phone,
      regexp_matches(text, '[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z][a-zA-Z]') AS has_email,
      doc_id % 3 <> 0 AS digits, doc_id >= 10 AS long_id, doc_id % 2 = 0 AS uuid FROM x""",
)
def shape_tests(t: Tables):
    """The texts as they are, with phone numbers of two accepted shapes and one other added to three in four."""
    number, part = F.col("doc_id"), F.col("doc_id") % 4
    phone = F.when(part == 0, F.lit(" 0712 345 678")).when(part == 1, F.lit(" +255 712345678")).when(part == 2, F.lit(" 0812345678")).otherwise(F.lit(""))
    rows = t.documents.select("doc_id", F.concat("text", phone).alias("text"))
    uuid = L.as_uuid(F.md5("text"))
    return rows.select(
        "doc_id",
        L.looks_like("text", "phone").alias("has_phone"),
        L.looks_like("text", "email").alias("has_email"),
        L.looks_like(F.when(number % 3 != 0, number.cast("string")).otherwise(F.concat(F.lit("n"), "doc_id")), "digits").alias("digits"),
        L.looks_like(F.concat(F.lit("15537792"), "doc_id"), "long_id").alias("long_id"),
        L.looks_like(F.when(number % 2 == 0, uuid).otherwise(F.concat(F.lit("x"), uuid)), "uuid").alias("uuid"),
    )
