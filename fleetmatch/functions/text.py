"""String rules shared by every column function."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters that count as white space when trimming.
WHITESPACE = (
    "\t\n\u000b\f\r \u00a0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000\ufeff"
)


def trim(text: Column) -> Column:
    """Remove leading and trailing white space, Unicode spaces included."""
    return F.btrim(text, F.lit(WHITESPACE))


def is_blank(text: Column) -> Column:
    return trim(text) == ""


def present(text: Column) -> Column:
    """The text itself, or NULL when it is empty (empty counts as missing)."""
    return F.nullif(text, F.lit(""))


def capitalise(text: Column) -> Column:
    """First letter upper, the rest as it is (``initcap`` would touch every word)."""
    return F.concat(F.upper(F.substring(text, 1, 1)), F.substr(text, F.lit(2)))


def normalize_string(text: Column) -> Column:
    return F.coalesce(trim(text), F.lit(""))


def normalize_email(text: Column) -> Column:
    return F.lower(normalize_string(text))


def normalize_phone(text: Column) -> Column:
    return F.coalesce(F.regexp_replace(text, "[^0-9]", ""), F.lit(""))


def trim_or_null(text: Column) -> Column:
    """Missing stays NULL; anything else is trimmed (OS version, agent version, IP)."""
    return trim(present(text))
