"""Dates, durations, sizes and percentages."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

# Date, optionally followed by a time and an offset from UTC.
ISO_DATE = (
    r"\A\d{4}(-\d{2}(-\d{2}([T ]\d{2}:\d{2}(:\d{2}(\.\d+)?)?(Z|[+-]\d{2}:[0-5]\d)?)?)?)?\z"
)
_MILLISECOND_LENGTH = len("2024-01-31T00:00:00.000")
SIZE_UNITS = ("B", "KB", "MB", "GB")


def parse_iso_date(text: Column) -> Column:
    """Moment in UTC as TIMESTAMP_NTZ, NULL when the text is no ISO-8601 date.

    The result does not depend on the session time zone: a date or time without
    an offset is taken as UTC. Fractions are kept to the millisecond. The shape
    is checked first because a plain cast accepts a bare time as "today".
    """
    size = F.length(text)
    sign = F.when(size > len("2024-01-31T00:00"), F.substring(text, -6, 1))
    shifted = F.coalesce(sign.isin("+", "-"), F.lit(False))

    def local(body: Column) -> Column:
        return F.substring(body, 1, _MILLISECOND_LENGTH).try_cast("timestamp_ntz")

    factor = F.when(sign == "-", -1).otherwise(1)
    shift = F.make_dt_interval(
        F.lit(0),
        factor * F.substring(text, -5, 2).try_cast("int"),
        factor * F.substring(text, -2, 2).try_cast("int"),
    )
    moment = (
        F.when(shifted, local(F.substr(text, F.lit(1), size - 6)) - shift)
        .otherwise(local(F.rtrim(text, F.lit("Z"))))
    )
    return F.when(F.rlike(text, F.lit(ISO_DATE)), moment)


def is_iso_date(text: Column) -> Column:
    return parse_iso_date(text).isNotNull()


# The other forms of a date that are accepted: six-digit years and
# hour 24 of the ISO form; slashes; day and month name in either order, with weekday, time and zone.
_MONTH = "(jan|feb|mar|apr|may|jun|jul|aug|sep|oct|nov|dec)[a-z]*[.]?"
_DAY = r"(0?[1-9]|[12]\d|3[01])"
_MONTH_NUMBER = "(0?[1-9]|1[0-2])"
_TIME = r"(\s+([01]?\d|2[0-3]):[0-5]\d(:[0-5]\d([.]\d+)?)?(\s*[ap]m)?(\s*(gmt|utc|ut|z)?([+-]\d{1,2}:?\d{2})?)?)?"
_ISO_DAY = r"-(0[1-9]|1[0-2])-(0[1-9]|[12]\d|3[01])"
DATE_FORMS = (
    rf"\A(?!-000000)[+-]\d{{6}}({_ISO_DAY}(T([01]\d|2[0-3]):[0-5]\d(:[0-5]\d([.]\d+)?)?(Z|[+-]\d{{2}}:[0-5]\d)?)?)?\z",
    rf"\A\d{{4}}{_ISO_DAY}T24:00(:00([.]0+)?)?(Z|[+-]\d{{2}}:[0-5]\d)?\z",
    rf"(?i)\A\d{{4}}/{_MONTH_NUMBER}/{_DAY}{_TIME}\z",
    rf"(?i)\A{_MONTH_NUMBER}/{_DAY}/\d{{4}}{_TIME}\z",
    rf"(?i)\A([a-z]+,?\s+)?{_DAY}[\s-]+{_MONTH}[\s-]+\d{{4}}{_TIME}\z",
    rf"(?i)\A([a-z]+,?\s+)?{_MONTH}\s+{_DAY},?\s+\d{{4}}{_TIME}\z",
)


def is_date(text: Column) -> Column:
    """Whether a record's text counts as a date: ISO-8601 or one of ``DATE_FORMS``."""
    known = is_iso_date(text)
    for form in DATE_FORMS:
        known = known | F.rlike(text, F.lit(form))
    return known


def _is_whole(number: Column) -> Column:
    return F.typeof(number).isin("tinyint", "smallint", "int", "bigint")


def _div(number: Column, by: int) -> Column:
    return F.call_function("div", number, F.lit(by).cast("bigint"))


def seconds_to_duration(seconds: Column) -> Column:
    """``1h 1m 1s``; N/A for 0, NULL and NaN, 0s for negatives.

    Seconds may have a fraction, which is printed as a double is; a whole number
    of seconds is printed as one, whatever its type.
    """
    def parts(hours: Column, minutes: Column, rest: Column, shown: Column) -> Column:
        return F.concat_ws(
            " ",
            F.when(hours > 0, F.concat(hours.cast("string"), F.lit("h"))),
            F.when(minutes > 0, F.concat(minutes.cast("string"), F.lit("m"))),
            F.when(rest > 0, F.concat(shown, F.lit("s"))),
        )

    # The type is known when the plan is made, so only one of the two ways is in it.
    number = seconds.cast("bigint")
    rest = number % 60
    whole = parts(_div(number, 3600), _div(number, 60) % 60, rest, rest.cast("string"))
    rest = F.pmod(seconds, F.lit(60))
    minutes = F.floor(F.pmod(seconds, F.lit(3600)) / 60)
    hours = F.floor((seconds - F.pmod(seconds, F.lit(3600))) / 3600)
    shown = F.when(rest == F.floor(rest), F.floor(rest).cast("string")).otherwise(rest.cast("string"))
    parts = F.when(_is_whole(seconds), whole).otherwise(parts(hours, minutes, rest, shown))
    return (
        F.when(F.coalesce(seconds, F.lit(0)) == 0, "N/A")
        .when(F.isnan(seconds.cast("double")), "N/A")
        .when(seconds < 0, "0s")
        .otherwise(parts)
    )


def format_bytes(size: Column) -> Column:
    """Bytes of any number type as B, KB, MB or GB with two decimals, halves rounded up.

    Units are powers of two, so the quotient is exact in whole numbers and in
    doubles alike. It is rounded in whole numbers, where a float format would
    round ties by its own rule.
    """
    def by_unit(b, kb, mb, gb) -> Column:
        return F.when(size < 1 << 10, b).when(size < 1 << 20, kb).when(size < 1 << 30, mb).otherwise(gb)

    # The code stays short: longer methods are not compiled when a query has several such columns.
    number = size.cast("bigint")

    def near(bits: int) -> Column:
        return F.shiftright(number * 100 + F.lit(1 << bits - 1).cast("bigint"), bits)

    # A hundred times a number beyond 2 ** 56 is no BIGINT; such a negative one is whole bytes.
    far = F.call_function("div", number.cast("decimal(20,0)") * 100 + (1 << 29), F.lit(Decimal(1 << 30)))
    hundredths = by_unit(number * 100, near(10), near(20), F.when(number < 1 << 56, near(30)).otherwise(far))
    whole = F.when(number > -(1 << 56), (hundredths.cast("decimal(20,0)") * F.lit(Decimal("0.01"))).cast("string")).otherwise(
        F.concat(number.cast("string"), F.lit(".00")))

    quotient = F.abs(size.cast("double")) / by_unit(*[float(1 << 10 * power) for power in range(4)])
    rest = ((quotient - F.floor(quotient)) * float(1 << 53)).cast("bigint")  # no product below reaches 2 ** 63
    cents = F.shiftright(rest * 200 + F.lit(1 << 53), 54).cast("decimal(3,0)") * F.lit(Decimal("0.01"))
    binary = F.concat(F.when(size < 0, "-").otherwise(""),
                      (F.floor(quotient).cast("decimal(20,0)") + cents).cast("string"))

    # The type is known when the plan is made, so only one of the two ways is in it.
    shown = F.when(_is_whole(size), whole).otherwise(binary)
    return F.when(size.isNotNull(), F.concat(shown, by_unit(*[" " + unit for unit in SIZE_UNITS])))


def percentage_text(part: Column, total: Column) -> Column:
    """``part / total * 100`` with one decimal and a percent sign; 0/0 is ``NaN%``.

    The quotient is a double and its exact binary value is rounded, halves up.
    Scaling by a power of two turns the double into a whole number without loss,
    so the rounding itself is integer arithmetic.
    """
    percent = F.try_divide(part.cast("double"), total.cast("double")) * 100

    def tenths(bits: int) -> Column:
        scaled = (percent * float(1 << bits)).cast("bigint")
        rest = scaled.bitwiseAND(F.lit((1 << bits) - 1))
        return F.shiftright(scaled, bits) * 10 + F.shiftright(rest * 20 + F.lit(1 << bits), bits + 1)

    rounded = F.when(percent < 32, tenths(57)).otherwise(tenths(50))
    text = F.concat(F.floor(rounded / 10).cast("string"), F.lit("."),
                    (rounded % 10).cast("string"), F.lit("%"))
    return F.when(total == 0, "NaN%").otherwise(text)
