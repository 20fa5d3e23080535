"""Fixed values of the registry: enums, synonyms, markers, patterns and defaults.

These must equal what the registry stores, so they are spelled out as data and kept
free of logic.  Tables that belong to a deployment (regions, districts, wards, countries) are
read from files the caller names; see ``ledgerlift.sources.dimensions``.
"""

# --- fixed values: text that stands for "no value", per cleaning dialect -------------
NULL_MARKERS = {
    "application": ("", "nan", "nat", "none", "null", "papprefno"),
    "general": ("", "nan", "none", "null", "nat"),
    "user": ("", "nan"),
}

# --- fixed values: white space removed at both ends of a cell -------------------------
WHITE_SPACE = " \t\n\r\f\v\u00a0"

# --- fixed values: cells that identify the header row ---------------------------------
HEADER_ANCHORS = ("apprefno", "shname", "application_number", "applicationnumber")

# --- fixed values: accepted date layouts, in order of trial ---------------------------
DATES_APPLICATION = (
    "%Y-%m-%d %H:%M:%S",
    "%Y-%m-%d %H:%M:%S.%f",
    "%Y-%m-%dT%H:%M:%S",
    "%Y-%m-%dT%H:%M:%SZ",
    "%Y-%m-%d",
    "%d/%m/%Y",
    "%d-%m-%Y",
    "%m/%d/%Y",
    "%Y/%m/%d",
)
DATES_PLAIN = ("%Y-%m-%d", "%d/%m/%Y", "%d-%m-%Y", "%m/%d/%Y", "%Y/%m/%d")
DATES_EXPERIENCE = (
    "%Y-%m-%d",
    "%Y-%m-%d %H:%M:%S",
    "%Y-%m-%d %H:%M",
    "%Y/%m/%d",
    "%Y/%m/%d %H:%M:%S",
    "%Y/%m/%d %H:%M",
    "%d/%m/%Y",
    "%d/%m/%Y %H:%M:%S",
    "%d/%m/%Y %H:%M",
    "%d-%m-%Y",
    "%d-%m-%Y %H:%M:%S",
    "%d-%m-%Y %H:%M",
    "%m/%d/%Y",
    "%m/%d/%Y %H:%M:%S",
    "%m/%d/%Y %H:%M",
)

# --- fixed values: spreadsheet day serials -------------------------------------------
SERIAL_EPOCH = "1899-12-30"
SERIAL_MAX = 2958465  # 9999-12-31

# --- fixed values: shapes --------------------------------------------------------------
UUID_SHAPE = "^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}$"
DIGITS = "^[0-9]+$"
INTEGER = "^-?[0-9]+$"
DECIMAL = "^-?[0-9]+([.][0-9]+)?$"
UNSIGNED_DECIMAL = "^[0-9]+([.][0-9]+)?$"
LONG_NUMERIC_ID = "^[0-9]{10,}$"
ISO_DATE_PREFIX = "^[0-9]{4}-[0-9]{2}-[0-9]{2}"
PHONE = r"(\+?255[\s]?[0-9]([\s]?[0-9]){8}|0[67][0-9]([\s]?[0-9]){7})"
EMAIL = r"([a-zA-Z0-9._%+\-]+@[a-zA-Z0-9.\-]+\.[a-zA-Z]{2,})"

# --- fixed values: application type -----------------------------------------------------
APPLICATION_TYPE_SYNONYMS = {
    "extension": "EXTEND",
    "renewal": "RENEW",
    "change_name": "CHANGE_OF_NAME",
    "changes": "CHANGE_OF_NAME",
}
INSTALLATION_TYPE_SYNONYMS = {
    "new": "NEW",
    "renew": "RENEW",
    "renewal": "RENEW",
    "upgrade": "UPGRADE",
    "appeal": "APPEAL",
}
WATER_TYPE_VALID = (
    "NEW",
    "RENEW",
    "EXTEND",
    "CHANGE_OF_NAME",
    "RELOCATION",
    "ALTERATION",
    "COMPLIANCE",
    "APPEAL",
    "UPGRADE",
    "TRANSFER",
    "MODIFICATION",
)
WATER_TYPE_SYNONYMS = {
    "renewal": "RENEW",
    "new license": "NEW",
    "new licence": "NEW",
    "extension": "EXTEND",
    "change of name": "CHANGE_OF_NAME",
}

# --- fixed values: licence type ---------------------------------------------------------
LICENSE_TYPE_VALID = (
    "CONSTRUCTION_NATURAL_GAS",
    "CONSTRUCTION_PETROLEUM",
    "LICENSE_NATURAL_GAS",
    "LICENSE_PETROLEUM",
    "LICENSE_WATER",
    "LICENSE_ELECTRICITY_SUPPLY",
    "LICENSE_ELECTRICITY_INSTALLATION",
)
LICENSE_TYPE_SYNONYMS = {
    "water & sanitation licenses": "LICENSE_WATER",
    "water and sanitation licenses": "LICENSE_WATER",
    "water & sanitation licence": "LICENSE_WATER",
    "water and sanitation licence": "LICENSE_WATER",
    "water supply license": "LICENSE_WATER",
    "water supply licence": "LICENSE_WATER",
    "water license": "LICENSE_WATER",
    "electricity supply license": "LICENSE_ELECTRICITY_SUPPLY",
    "electricity supply licence": "LICENSE_ELECTRICITY_SUPPLY",
    "electricity installation": "LICENSE_ELECTRICITY_INSTALLATION",
    "natural gas license": "LICENSE_NATURAL_GAS",
    "natural gas construction": "CONSTRUCTION_NATURAL_GAS",
    "petroleum license": "LICENSE_PETROLEUM",
    "petroleum construction": "CONSTRUCTION_PETROLEUM",
}
# (sector, category type) -> licence type
LICENSE_TYPE_BY_SECTOR = {
    ("PETROLEUM", "Construction"): "CONSTRUCTION_PETROLEUM",
    ("PETROLEUM", "License"): "LICENSE_PETROLEUM",
    ("NATURAL_GAS", "Construction"): "CONSTRUCTION_NATURAL_GAS",
    ("NATURAL_GAS", "License"): "LICENSE_NATURAL_GAS",
    ("WATER_SUPPLY", "License"): "LICENSE_WATER",
    ("ELECTRICITY", "License"): "LICENSE_ELECTRICITY_SUPPLY",
}
INSTALLATION_LICENSE = "LICENSE_ELECTRICITY_INSTALLATION"

# --- fixed values: people -----------------------------------------------------------------
EXPERIENCE_SYNONYMS = {
    "employed": "EMPLOYED",
    "fresh from college": "FRESH_FROM_COLLEGE",
    "self-employed": "SELF_EMPLOYED",
    "self employed": "SELF_EMPLOYED",
}
NATIONAL, FOREIGN = "TANZANIAN", "NON_TANZANIAN"

# --- fixed values: categories and fees ------------------------------------------------------
TRUE_WORDS = ("TRUE", "1", "YES", "Y")
CAPACITY_UNITS = {"mw": "MW", "kv": "kV"}
VOLTAGE_LEVELS = ("HV", "MV", "LV_1", "LV_3")
ELECTRICITY_VOLTAGE = "HV"
DEFAULT_APPLICATION_FEE = "240000"
DEFAULT_LICENSE_FEE = "120500000"
DEFAULT_ANNUAL_FEE = "0"
DEFAULT_MONTHS = "36"
DEFAULT_CAPACITY_FROM = "1"
DEFAULT_CAPACITY_TO = "10"
DEFAULT_APPLICATION_PREFIX = "AECBL"
DEFAULT_LICENSE_PREFIX = "ECBL"
NO_CAPACITY_SECTORS = ("NATURAL_GAS", "WATER_SUPPLY")

CLASS_CODES = ("A", "B", "C", "D", "W", "S1", "S2", "S3")

LEGAL_STATUSES = (
    "Co-operative Society",
    "Government Agency",
    "Joint Venture",
    "Others",
    "Parastatal Organization",
    "Partnership",
    "Private Limited Liability Company",
    "Public Limited Liability Company",
    "Sole Proprietor",
)
LEGAL_STATUS_SYNONYMS = {"sole proprietor in a column": "sole proprietor"}

PETROLEUM_CATEGORIES = (
    "Petroleum Retail",
    "Township and Village Petroleum Retail",
    "Petroleum Wholesales",
    "Petroleum Station",
    "Village Petroleum Station",
    "Petroleum Storage Deport",
    "Petroleum Storage Business",
    "Petroleum Consumer Installation",
    "Consumer Installation (Agriculture)",
    "Consumer Installation (Mining)",
    "Consumer Installation (Transporter)",
    "Pipeline Transportation (up to 100 km)",
    "Pipeline Transportation (above 100 km)",
    "Petroleum Marine Loading and Offloading facility Construction Approval",
    "Petroleum Waste Oil Recycling Plant Construction Approval",
    "Condensate Storage Construction Approval",
    "LPG Storage and Filling Plant",
    "LPG Wholesalers Business",
    "Petroleum LPG Wholesalers Business",
    "Lubricant Distribution Business",
    "Lubricant Blending Plant",
    "Lubricant Wholesales Business",
)

# Ordered: the first sector with a matching word wins.
SECTOR_WORDS = (
    (
        "petroleum",
        ("petroleum", "lpg", "bunkering", "bitumen", "petcoke", "lubricant", "condensate", "pipeline transportation"),
    ),
    (
        "natural_gas",
        ("natural gas", "lng", "compressed natural gas", "re-gasification", "re – gasification", "aggregation"),
    ),
    (
        "electricity",
        (
            "electricity",
            "generation",
            "transmission",
            "distribution",
            "cross border trade",
            "independent system operator",
            "supply",
        ),
    ),
    ("water_supply", ("water", "sanitation", "operatorship", "leasing assets", "bulk water")),
)

# --- fixed values: user defaults ---------------------------------------------------------------
USER_DEFAULTS = {
    "status": "ACTIVE",
    "user_category": "EXTERNAL",
    "account_type": "INDIVIDUAL",
    "auth_mode": "DB",
}
