"""Column functions: every one maps columns to a column and stays in the JVM."""

from fleetmatch.functions.convert import (
    format_bytes,
    is_date,
    is_iso_date,
    parse_iso_date,
    percentage_text,
    seconds_to_duration,
)
from fleetmatch.functions.normalize import (
    full_hostname,
    normalize_hostname,
    normalize_platform,
    normalize_status,
)
from fleetmatch.functions.text import (
    capitalise,
    is_blank,
    normalize_email,
    normalize_phone,
    normalize_string,
    present,
    trim,
    trim_or_null,
)

__all__ = [
    "capitalise", "format_bytes", "full_hostname", "is_blank", "is_date", "is_iso_date", "normalize_email",
    "normalize_hostname", "normalize_phone", "normalize_platform", "normalize_status",
    "normalize_string", "parse_iso_date", "percentage_text", "present", "seconds_to_duration",
    "trim", "trim_or_null",
]
