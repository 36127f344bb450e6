"""Record validation: every row gets ``valid`` and the list of ``errors``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetmatch.functions import is_date
from fleetmatch.operators.projection import select_once
from fleetmatch.operators.records import with_record

# Accepted shapes, and below the messages of each check. The space
# class is the white space of trim().
_SPACE = r"\t\n\x0B\f\r \u00A0\u1680\u2000-\u200A\u2028\u2029\u202F\u205F\u3000\uFEFF"
EMAIL = rf"\A[^{_SPACE}@]+@[^{_SPACE}@]+\.[^{_SPACE}@]+\z"
PHONE = rf"\A\+?[0-9{_SPACE}\-().]{{10,}}\z"


def is_valid_email(email: Column) -> Column:
    return F.rlike(email, F.lit(EMAIL))


def is_valid_phone(phone: Column) -> Column:
    return F.rlike(phone, F.lit(PHONE))


def _given(df: DataFrame, name: str) -> Column:
    """Whether a field holds something: not NULL, empty, zero or false."""
    if name not in df.columns:
        return F.lit(False)
    kind, value = df.schema[name].dataType, F.col(name)
    if isinstance(kind, T.StringType):
        given = value != ""
    elif isinstance(kind, (T.FloatType, T.DoubleType)):
        given = (value != 0) & ~F.isnan(value)
    elif isinstance(kind, T.NumericType):
        given = value != 0
    elif isinstance(kind, T.BooleanType):
        given = value
    else:
        given = value.isNotNull()
    return F.coalesce(given, F.lit(False))


def _text(df: DataFrame, name: str) -> Column:
    return F.col(name).cast("string") if name in df.columns else F.lit(None).cast("string")


def _with_errors(df: DataFrame, checks: dict[str, Column]) -> DataFrame:
    """``checks`` maps a message to the condition under which it applies."""
    found = F.array(*[F.when(broken, F.lit(message)) for message, broken in checks.items()])
    return df.withColumn("errors", F.array_compact(found)).withColumn("valid", F.size("errors") == 0)


def validate_contacts(df: DataFrame) -> DataFrame:
    """Columns id or contactId, email, phone; any of them may be absent."""
    return _with_errors(df, {
        "Contact must have an id or contactId": ~_given(df, "id") & ~_given(df, "contactId"),
        "Contact email is invalid": _given(df, "email") & ~is_valid_email(_text(df, "email")),
        "Contact phone format is invalid": _given(df, "phone") & ~is_valid_phone(_text(df, "phone")),
    })


def validate_sessions(df: DataFrame) -> DataFrame:
    """Columns id or sessionId, startTime (required), endTime."""
    return _with_errors(df, {
        "Session must have an id or sessionId": ~_given(df, "id") & ~_given(df, "sessionId"),
        "Session must have a valid startTime":
            ~_given(df, "startTime") | ~is_date(_text(df, "startTime")),
        "Session endTime must be a valid date":
            _given(df, "endTime") & ~is_date(_text(df, "endTime")),
    })


def validate_devices(df: DataFrame, record: str) -> DataFrame:
    """Validate raw JSON records, where the JSON type of a field matters.

    A NULL field and an absent field differ: only the present NULL breaks the
    rule that isOnline is a boolean. A key that a record repeats has its last value.
    """
    fields = ("id", "deviceId", "name", "isOnline", "lastActivity")
    names = df.columns
    parsed = with_record(df, record, "parsed")
    values = {name: F.variant_get("parsed", f"$.{name}", "variant") for name in fields}
    typed = select_once(parsed, {
        **{name: F.col(name) for name in names},
        "parsed_kind": F.schema_of_variant("parsed"),
        **{f"kind_{name}": F.schema_of_variant(value) for name, value in values.items()},
        **{f"text_{name}": F.try_variant_get("parsed", f"$.{name}", "string") for name in fields},
    })

    def kind(name: str) -> Column:
        return F.col(f"kind_{name}")

    def text(name: str) -> Column:
        return F.col(f"text_{name}")

    def given(name: str) -> Column:
        kept = (
            F.when(kind(name) == "VOID", False)
            .when(kind(name) == "STRING", text(name) != "")
            .when(kind(name) == "BOOLEAN", text(name) == "true")
            .when(F.rlike(kind(name), F.lit(r"\A(BIGINT|DECIMAL|DOUBLE|FLOAT)")), text(name).try_cast("double") != 0)
            .otherwise(kind(name).isNotNull())
        )
        return F.coalesce(kept, F.lit(False))

    is_record = F.coalesce(F.startswith("parsed_kind", F.lit("OBJECT")), F.lit(False))
    checked = _with_errors(typed, {
        "Record is not a JSON object": ~is_record,
        "Device must have an id or deviceId": is_record & ~given("id") & ~given("deviceId"),
        "Device name must be a string": is_record & given("name") & (kind("name") != "STRING"),
        "Device isOnline must be a boolean": is_record & (kind("isOnline") != "BOOLEAN"),
        "Device lastActivity must be a valid date":
            is_record & given("lastActivity") & ~is_date(text("lastActivity")),
    })
    return checked.select(*names, "errors", "valid")


def constraint_audit(df: DataFrame, table: str, key: str = "hostname",
                     flags: tuple[str, ...] = (), rows_per_key: str | None = None) -> DataFrame:
    """One row: rows, NULL keys, surplus rows of repeated keys, flags other than 0 and 1.

    The distinct count is planned as a partial aggregation by key, so a repeated
    key is reduced before the shuffle. A row stands for as many rows as the column
    ``rows_per_key`` says, if it is given.
    """
    number = F.lit(1) if rows_per_key is None else F.col(rows_per_key)
    keyed = F.col(key).isNotNull()

    def rows(condition: Column) -> Column:
        return F.coalesce(F.sum(F.when(condition, number).cast("bigint")), F.lit(0).cast("bigint"))

    bad = F.lit(False)
    for flag in flags:
        bad = bad | F.coalesce(~F.col(flag).isin(0, 1), F.lit(False))
    return df.agg(
        rows(F.lit(True)).alias("total_rows"),
        rows(~keyed).alias("null_keys"),
        (rows(keyed) - F.count_distinct(key)).alias("duplicate_keys"),
        rows(bad).alias("bad_flags"),
    ).select(F.lit(table).alias("table_name"), "total_rows", "null_keys", "duplicate_keys", "bad_flags")
