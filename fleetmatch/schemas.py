"""Stored tables and the description of the two inventory exports."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetmatch.functions import (
    normalize_platform,
    normalize_status,
    parse_iso_date,
    trim_or_null,
)
from fleetmatch.functions.normalize import DOMAIN_SUFFIXES, HOSTNAME_LENGTH
from fleetmatch.session import iso_text

INVENTORY_A_SCHEMA = T.StructType([
    T.StructField("hostname", T.StringType(), False),
    T.StructField("description", T.StringType()),
    T.StructField("platform", T.StringType()),
    T.StructField("ip_address", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("last_seen", T.StringType()),
    T.StructField("last_seen_ts", T.TimestampNTZType()),
    T.StructField("source_rows", T.LongType()),
])

INVENTORY_B_SCHEMA = T.StructType([
    T.StructField("hostname", T.StringType(), False),
    T.StructField("os_version", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("agent_version", T.StringType()),
    T.StructField("source_rows", T.LongType()),
])

COVERAGE_SCHEMA = T.StructType([
    T.StructField("hostname", T.StringType(), False),
    T.StructField("description", T.StringType()),
    T.StructField("in_a", T.IntegerType()),
    T.StructField("in_b", T.IntegerType()),
    T.StructField("status_a", T.StringType()),
    T.StructField("status_b", T.StringType()),
    T.StructField("last_seen_a", T.StringType()),
    T.StructField("last_seen_b", T.StringType()),
    T.StructField("coverage_status", T.StringType()),
])

# When a run stored a row; stored tables have these columns after their own.
RUN_TIMES = T.StructType([
    T.StructField("imported_at", T.TimestampNTZType()),
    T.StructField("updated_at", T.TimestampNTZType()),
])
STORED_COVERAGE_SCHEMA = T.StructType([*COVERAGE_SCHEMA.fields, T.StructField("last_updated", T.TimestampNTZType())])

# The runs of the inventories that a coverage run was made from.
INPUTS_SCHEMA = T.StructType([
    T.StructField("run_id", T.StringType()),
    T.StructField("run_a", T.StringType()),
    T.StructField("run_b", T.StringType()),
])

REJECT_SCHEMA = T.StructType([
    T.StructField("table_name", T.StringType()),
    T.StructField("run_id", T.StringType()),
    T.StructField("reason", T.StringType()),
    T.StructField("line", T.StringType()),
    T.StructField("rejected_at", T.TimestampNTZType()),
])

EVENT_SCHEMA = T.StructType([
    T.StructField("event_ts", T.TimestampNTZType()),
    T.StructField("system", T.StringType()),
    T.StructField("action", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("message", T.StringType()),
    T.StructField("records_processed", T.LongType()),
    T.StructField("run_id", T.StringType()),
])


@dataclass(frozen=True)
class InventorySpec:
    """How one system's export is recognised and turned into a record.

    ``aliases`` lists, per field, the header names to look for in priority
    order. ``record`` maps the raw fields other than the hostname (NULL where the
    export has no such field) to stored columns; ``mapped`` tells for each field
    whether the line's file has it. ``suffixes`` are the domains cut off hostnames, in
    this order, and ``hostname_length`` is the length they are cut to.
    """

    table: str
    label: str
    noun: str
    aliases: Mapping[str, tuple[str, ...]]
    record: Callable[[Mapping[str, Column], Mapping[str, Column], datetime], dict[str, Column]]
    schema: T.StructType
    required: str = "hostname"
    suffixes: tuple[str, ...] = DOMAIN_SUFFIXES
    hostname_length: int = HOSTNAME_LENGTH

    @property
    def stored_schema(self) -> T.StructType:
        return T.StructType([*self.schema.fields, *RUN_TIMES.fields])

    @property
    def only_status(self) -> str:
        return f"{self.label.upper()}_ONLY"


def _record_a(raw: Mapping[str, Column], mapped: Mapping[str, Column], run_ts: datetime) -> dict[str, Column]:
    last_seen = F.when(mapped["last_seen"], raw["last_seen"]).otherwise(iso_text(run_ts))
    return {
        "description": raw["description"],
        "platform": normalize_platform(raw["platform"]),
        "ip_address": trim_or_null(raw["ip_address"]),
        "status": F.lit("Online"),
        "last_seen": last_seen,
        "last_seen_ts": parse_iso_date(last_seen),
    }


def _record_b(raw: Mapping[str, Column], mapped: Mapping[str, Column], run_ts: datetime) -> dict[str, Column]:
    return {
        "os_version": trim_or_null(raw["os_version"]),
        "status": normalize_status(raw["status"]),
        "agent_version": trim_or_null(raw["agent_version"]),
    }


# Header aliases in priority order.
ALIASES_A = {
    "hostname": ("host name", "hostname", "id", "computer"),
    "platform": ("os type", "platform", "os"),
    "ip_address": ("ip address", "ipaddress", "ip"),
    "description": ("computer description", "description", "name"),
    "last_seen": ("last boot date", "lastseen", "last seen"),
}
ALIASES_B = {
    "hostname": ("id", "hostname", "host name", "computer"),
    "os_version": ("osversion", "os version", "os"),
    "status": ("status",),
    "agent_version": ("agentversion", "agent version", "version"),
}


def remote_inventory(label: str = "Remote", suffixes: tuple[str, ...] = DOMAIN_SUFFIXES,
                     hostname_length: int = HOSTNAME_LENGTH) -> InventorySpec:
    """System A: remote-access devices. ``label`` names it in reports."""
    return InventorySpec("inventory_a", label, "devices", ALIASES_A, _record_a, INVENTORY_A_SCHEMA,
                         suffixes=suffixes, hostname_length=hostname_length)


def endpoint_inventory(label: str = "Endpoint", suffixes: tuple[str, ...] = DOMAIN_SUFFIXES,
                       hostname_length: int = HOSTNAME_LENGTH) -> InventorySpec:
    """System B: endpoint-security hosts. ``label`` names it in reports."""
    return InventorySpec("inventory_b", label, "hosts", ALIASES_B, _record_b, INVENTORY_B_SCHEMA,
                         suffixes=suffixes, hostname_length=hostname_length)
