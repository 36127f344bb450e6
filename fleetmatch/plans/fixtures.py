"""Inventory exports and records derived from the sample tables.

Every fixture reads a whole table. The expressions are SQL that Spark and DuckDB
read alike, so that both sides of a check start from the same input.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetmatch.functions import is_blank
from fleetmatch.operators.projection import select_once
from fleetmatch.schemas import endpoint_inventory, remote_inventory
from fleetmatch.session import scratch_path
from fleetmatch.sources.delimited import Export, split_header

RUN_TS = datetime(2024, 1, 31)
SPEC_A = remote_inventory()
SPEC_B = endpoint_inventory()


def pick(words: str, selector: str) -> str:
    """One of the words separated by ``|``, by the selector's remainder."""
    count = len(words.split("|"))
    return f"split_part('{words}', '|', CAST(({selector}) % {count} + 1 AS INT))"


def host_variants(selector: str, number: str) -> str:
    """Spellings of one host that exercise every normalisation rule; every seventh is empty."""
    prefix = pick("wks-| WKS-|Wks-|wks-|wks-engineering-|wks-|", selector)
    suffix = pick("|.corporate.gha.com |.gha.com|.local.corp||.corp.local|", selector)
    return (f"{prefix} || CASE WHEN ({selector}) % 7 = 6 THEN '' ELSE CAST({number} AS STRING) END "
            f"|| {suffix}")


def platform_variants(selector: str) -> str:
    return pick("Microsoft Windows Server 2019|windows 11|Mac OS X|ubuntu 22.04|ChromeOS| |", selector)


def status_variants(selector: str) -> str:
    return pick("online|0|NORMAL| Yes |reduced functionality|INACTIVE| |", selector)


# Current export of system A: one line per row of lineitem, hosts 0 .. parts.
HEADER_A = "Host Name,OS Type,IP Address,Computer Description,Last Boot Date"
ORDER_A = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity")
RAW_A = {
    "host_raw": host_variants("(l_orderkey + l_linenumber)", "l_partkey"),
    "platform_raw": platform_variants("(l_partkey + l_linenumber)"),
    "ip_raw": "CASE WHEN l_linenumber = 3 THEN '' ELSE '10.0.' || CAST(l_suppkey AS STRING) || '.' "
              "|| CAST(l_linenumber AS STRING) || ' ' END",
    "description_raw": "'Part ' || CAST(l_partkey AS STRING) || ' order ' || CAST(l_orderkey AS STRING)",
    "last_seen_raw": "CAST(CAST(l_shipdate AS DATE) AS STRING)",
}
# Among the lines are blank ones, single fields and short rows.
LINE_A = f"""CASE
    WHEN l_linenumber = 7 AND l_quantity = 50 THEN '   '
    ELSE concat_ws(',', {RAW_A['host_raw']},
        CASE WHEN l_linenumber = 7 AND l_quantity = 49 THEN NULL ELSE {RAW_A['platform_raw']} END,
        CASE WHEN l_linenumber = 7 AND l_quantity IN (48, 49) THEN NULL ELSE concat_ws(',', {RAW_A['ip_raw']},
            {RAW_A['description_raw']}, {RAW_A['last_seen_raw']}) END) END"""

# Current export of system B: one line per row of orders, even hosts 0 .. 2 * customers.
HEADER_B = "Hostname;OS Version;Status;Agent Version"
RAW_B = {
    "host_raw": host_variants("o_orderkey", "(2 * o_custkey)"),
    "os_version_raw": "CASE WHEN o_orderstatus = 'P' THEN '' ELSE ' ' || o_orderpriority END",
    "status_raw": status_variants("o_orderkey"),
    "agent_version_raw": "'7.' || CAST(o_custkey % 30 AS STRING) || ' '",
}
LINE_B = f"""CASE
    WHEN o_orderpriority = '5-LOW' AND o_orderstatus = 'P' THEN ' '
    ELSE concat_ws(';', {', '.join(RAW_B.values())}) END"""

# Previous exports: A from events (every 20th host), B from customer (every third host).
LINE_PREVIOUS_A = f"""concat_ws(',', {host_variants('event_id', '(20 * user_id)')}, {platform_variants('event_id')},
    '10.1.1.' || CAST(user_id AS STRING), 'User ' || CAST(user_id AS STRING), CAST(CAST(ts AS DATE) AS STRING))"""
LINE_PREVIOUS_B = f"""concat_ws(';', {host_variants('c_custkey', '(3 * c_custkey)')}, c_mktsegment,
    {status_variants('c_custkey')}, '6.' || CAST(c_nationkey AS STRING))"""

# Header lines with different delimiters, alias spellings and column orders.
HEADER_VARIANTS = """CASE event_id % 8
    WHEN 0 THEN 'Host Name,OS Type,IP Address,Computer Description,Last Boot Date'
    WHEN 1 THEN 'id;HOSTNAME;OS;Status;Version'
    WHEN 2 THEN concat_ws(chr(9), 'Name', ' Computer ', 'ip', 'last seen', 'os version')
    WHEN 3 THEN 'a;b,c'
    WHEN 4 THEN 'agent version,id,hostname,status,status'
    WHEN 5 THEN concat_ws(chr(9), 'platform;os', 'osversion', 'hostname;x')
    WHEN 6 THEN event_type || ',description,lastseen,' || event_type
    ELSE '' END"""

CONTACTS = {
    "c_custkey": "c_custkey",
    "id": "CASE WHEN c_custkey % 10 = 0 THEN NULL ELSE c_custkey END",
    "contactId": "CASE WHEN c_custkey % 20 = 0 THEN '' WHEN c_custkey % 10 = 0 THEN c_name END",
    "email": """CASE c_custkey % 6
        WHEN 0 THEN '  ' || c_name || '@Example.com '
        WHEN 1 THEN 'user' || CAST(c_custkey AS STRING) || '@example.co.uk'
        WHEN 2 THEN 'user@host'
        WHEN 3 THEN 'a@b@c.de'
        WHEN 4 THEN ''
        ELSE NULL END""",
    "phone": """CASE c_custkey % 7
        WHEN 0 THEN '+1 (555) 010-' || CAST(c_custkey AS STRING)
        WHEN 1 THEN '555.0100'
        WHEN 2 THEN '0049 30 1234567'
        WHEN 3 THEN 'call 555-0100-22'
        WHEN 4 THEN ''
        WHEN 5 THEN '++1 555 0100 00'
        ELSE NULL END""",
}

DATE_TEXT = "CAST(CAST(o_orderdate AS DATE) AS STRING)"
DATE_VARIANTS = f"""CASE o_orderkey % 12
    WHEN 0 THEN {DATE_TEXT}
    WHEN 1 THEN {DATE_TEXT} || 'T08:30:00Z'
    WHEN 2 THEN {DATE_TEXT} || ' 08:30:15'
    WHEN 3 THEN {DATE_TEXT} || 'T08:30:15.123456Z'
    WHEN 4 THEN {DATE_TEXT} || 'T23:45:00+05:30'
    WHEN 5 THEN {DATE_TEXT} || 'T00:15-11:00'
    WHEN 6 THEN substring({DATE_TEXT}, 1, 7)
    WHEN 7 THEN 'on ' || {DATE_TEXT}
    WHEN 8 THEN substring({DATE_TEXT}, 1, 8) || '31'
    WHEN 9 THEN '12:30'
    WHEN 10 THEN ''
    ELSE NULL END"""

SESSIONS = {
    "o_orderkey": "o_orderkey",
    "id": "o_orderkey",
    "sessionId": "CASE WHEN o_orderkey = 0 THEN NULL ELSE o_orderstatus END",
    "startTime": DATE_VARIANTS,
    "endTime": DATE_VARIANTS.replace("o_orderkey % 12", "(o_orderkey + o_custkey) % 12"),
}

# Texts of dates in many forms, and whether a record with one is valid.
DATE_FORMS = (
    ("Fri, 05 Jan 2024 10:00:00 GMT", True), ("5 January 2024", True), ("05-Jan-2024 10:00", True),
    ("Jan 5, 2024", True), ("Monday, Sept. 9, 2024 9:15 pm", True), ("Jan 5 2024 10:00:00 +0130", True),
    ("2024/01/05", True), ("2024/1/5 23:59:59.5", True), ("12/31/2024", True), ("2024-01-05T24:00:00Z", True),
    ("+012024-01-01T00:00:00Z", True), ("-000044-03-15", True), ("-000000-01-01", False), ("2024-01-05T24:01:00Z", False),
    ("2024/13/01", False), ("31/12/2024", False), ("Foo 5, 2024", False), ("Jan 32, 2024", False), ("5 Jan", False),
    ("2024/01/05 25:00", False), ("tomorrow", False), ("+12024-01-01", False), ("Jan 5, 2024 10:61", False),
)
ANY_DATE = "CASE o_orderkey % {} {} END".format(
    len(DATE_FORMS), " ".join(f"WHEN {i} THEN '{text}'" for i, (text, _) in enumerate(DATE_FORMS)))

DEVICE_JSON = """CASE event_id % 12
    WHEN 0 THEN '{"id": "' || CAST(event_id AS STRING) || '", "name": "dev", "isOnline": true, '
        || '"lastActivity": "' || CAST(CAST(ts AS DATE) AS STRING) || 'T10:00:00Z"}'
    WHEN 1 THEN '{"deviceId": ' || CAST(user_id AS STRING) || ', "name": 5, "isOnline": "yes"}'
    WHEN 2 THEN '{"id": "", "name": "", "isOnline": null, "lastActivity": "soon"}'
    WHEN 3 THEN 'not json ' || CAST(event_id AS STRING)
    WHEN 4 THEN '[' || CAST(event_id AS STRING) || ', 2]'
    WHEN 5 THEN '{"id": 0, "deviceId": "x", "lastActivity": "2024-13-01"}'
    WHEN 6 THEN '{"name": {"first": "a"}, "isOnline": false, "lastActivity": 2024}'
    WHEN 7 THEN '{"id": 1.5, "name": "' || event_type || '", "isOnline": 1, "lastActivity": null}'
    WHEN 9 THEN '{"id": "", "name": 7, "isOnline": true, "name": "' || event_type || '", "id": ' || CAST(event_id AS STRING) || '}'
    WHEN 10 THEN '{"id": 1, "isOnline": 0, "lastActivity": "2024-01-01", "id": "", "lastActivity": "soon", "isOnline": false}'
    ELSE props END"""
# The same with the last value of each key that is repeated.
DEVICE_JSON_LAST = DEVICE_JSON.replace('"id": "", "name": 7, "isOnline": true,', '"isOnline": true,').replace(
    '"id": 1, "isOnline": 0, "lastActivity": "2024-01-01", ', "")

# Records whose keys differ by row; user_id is reached on two ways, in either order.
OPEN_JSON = """CASE event_id % 8
    WHEN 0 THEN '{"k": 1, "user": {"id": ' || CAST(user_id AS STRING) || ', "tags": ["a", ' || CAST(event_id AS STRING) || ']}}'
    WHEN 1 THEN '{"user": {"id": "u' || CAST(user_id AS STRING) || '", "home": {"city": "' || event_type || '", "zip": null}}, "empty": {}}'
    WHEN 2 THEN '{"user_id": ' || CAST(event_id AS STRING) || ', "user": {"name": "x", "id": ' || CAST(user_id AS STRING) || '}}'
    WHEN 3 THEN '{"user": {"id": ' || CAST(user_id AS STRING) || '}, "user_id": null, "none": null}'
    WHEN 4 THEN '{"user": "' || event_type || '", "k": true, "k": ' || CAST(event_id AS STRING) || '}'
    WHEN 5 THEN '{"user": {"home": {}, "id": ' || CAST(event_id AS STRING) || '}, "user_home": {"city": "b"}, "it''s": 5}'
    WHEN 6 THEN '[1, {"k": 2}]'
    ELSE 'not json ' || event_type END"""


SECONDS = "(l_orderkey * l_linenumber - 100)"
BYTES = "(l_orderkey * l_partkey * l_linenumber * l_suppkey)"


# The current export of system A as files of three forms, dealt by order: own delimiters, names and orders of columns.
FORM = "l_orderkey % 3"
FORM_HEADERS = (HEADER_A, "id;Name;OS;IP", "platform\tComputer\tLast Seen\tDescription\tid2")
FORM_LINES = (
    LINE_A,
    f"concat_ws(';', {RAW_A['host_raw']}, {RAW_A['description_raw']}, {RAW_A['platform_raw']}, {RAW_A['ip_raw']})",
    f"""CASE WHEN l_linenumber = 7 THEN l_returnflag || l_linestatus ELSE concat_ws(chr(9), {RAW_A['platform_raw']}, {RAW_A['host_raw']},
        {RAW_A['last_seen_raw']}, {RAW_A['description_raw']}) END""",
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def dealt(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The table's rows, dealt evenly to the tasks.

    A row group is read by one task, however many rows it has; lines made from them
    cost far more than reading. Adaptive execution chooses the number of tasks.
    """
    return table(spark, sf_dir, name).hint("rebalance")


def derived(spark: SparkSession, sf_dir: str, name: str, columns: dict[str, str], source=table) -> DataFrame:
    return select_once(source(spark, sf_dir, name),
                       {column: F.expr(expression) for column, expression in columns.items()})


def export_a(spark: SparkSession, sf_dir: str, source=table) -> Export:
    lines = select_once(source(spark, sf_dir, "lineitem"),
                        {"value": F.expr(LINE_A), "row_order": F.struct(*ORDER_A)})
    return Export(HEADER_A, lines.where(~is_blank(F.col("value"))))


def lines_b(spark: SparkSession, sf_dir: str, source=table) -> DataFrame:
    """Raw lines with the header in front, as a file would hold them."""
    header = spark.range(1).select(F.lit(-1).cast("bigint").alias("line_no"), F.lit(HEADER_B).alias("value"))
    return header.union(derived(spark, sf_dir, "orders", {"line_no": "o_orderkey", "value": LINE_B}, source))


def export_b(spark: SparkSession, sf_dir: str, source=table) -> Export:
    return split_header(lines_b(spark, sf_dir, source), "line_no")


def previous_a(spark: SparkSession, sf_dir: str, source=table) -> Export:
    return Export(HEADER_A, derived(spark, sf_dir, "events",
                                    {"row_order": "event_id", "value": LINE_PREVIOUS_A}, source))


def previous_b(spark: SparkSession, sf_dir: str, source=table) -> Export:
    return Export(HEADER_B, derived(spark, sf_dir, "customer",
                                    {"row_order": "c_custkey", "value": LINE_PREVIOUS_B}, source))


def write_forms(spark: SparkSession, sf_dir: str) -> str:
    """Write the export in three forms, each with its own header; returns a path for all of their files."""
    path = scratch_path(spark, "forms")
    for number, (header, line) in enumerate(zip(FORM_HEADERS, FORM_LINES)):
        lines = select_once(table(spark, sf_dir, "lineitem").where(f"{FORM} = {number}"),
                            {"value": F.expr(line), "row_order": F.struct(*ORDER_A)})
        write_export(Export(header, lines), f"{path}/form-{number}")
    return f"{path}/*"


def write_export(export: Export, path: str | None = None) -> str:
    """Write an export as part files with a header each, in row order; returns the folder."""
    path = path or scratch_path(export.lines.sparkSession, "export")
    (
        export.lines.orderBy("row_order").select("value").toDF(export.header)
        .write.option("header", True).option("sep", "\u0001").option("quote", "").option("escapeQuotes", False)
        .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )
    return path
