"""Scalar column functions (all built-in Spark expressions, no UDFs)."""

from cadence.functions.timefn import (  # noqa: F401
    Span, YEAR, QUARTER, add_offset, between_ts, calendar_attributes, date_key,
    hours_offset, mysql_week, shift_back, shift_forward, to_ntz, to_utc,
    utc_date, ymd_month_name,
)
from cadence.functions.text import (  # noqa: F401
    blank_if_null, concat_strict, left_chars, regex_contains, literal_contains,
)
