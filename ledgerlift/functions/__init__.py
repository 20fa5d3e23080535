"""Column functions: every one returns a Column and stays inside whole-stage codegen."""

from ledgerlift.functions.dates import iso_date, parse_date, reminder_date, serial_date
from ledgerlift.functions.enums import (
    application_type,
    capacity_unit,
    derived_license_type,
    experience_key,
    experience_type,
    imported_license_type,
    installation_type,
    license_type,
    map_enum,
    nationality,
    parse_bool,
    sector_of,
    voltage_level,
    water_application_type,
)
from ledgerlift.functions.keys import as_uuid, stable_key
from ledgerlift.functions.numbers import cast_or, exact, int_text, whole_number
from ledgerlift.functions.people import bare_name, email_in, has_separator, phone_in, split_name
from ledgerlift.functions.predicates import all_present, any_present, changed, is_live, looks_like, search
from ledgerlift.functions.text import (
    blank_to_null,
    capped,
    class_code,
    clean,
    first_present,
    joined,
    key_text,
    label_key,
    strip,
    upper_or,
)

__all__ = [name for name in dir() if not name.startswith("_")]
