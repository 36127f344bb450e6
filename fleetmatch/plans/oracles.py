"""The same queries in DuckDB SQL, written against the same tables."""

from __future__ import annotations

from fleetmatch.functions.text import WHITESPACE
from fleetmatch.plans import fixtures as fx

WS = f"'{WHITESPACE}'"


def trim(x: str) -> str:
    return f"trim({x}, {WS})"


def hostname(x: str, length: bool = True) -> str:
    name = f"upper({trim(f'nullif({x}, {chr(39)}{chr(39)})')})"
    for suffix in (r"\.CORPORATE\.GHA\.COM$", r"\.GHA\.COM$", r"\.CORP$", r"\.LOCAL$"):
        name = f"regexp_replace({name}, '{suffix}', '')"
    return f"substring({name}, 1, 15)" if length else name


def platform(x: str) -> str:
    p = f"lower({trim(x)})"
    return f"""CASE WHEN {x} IS NULL OR {x} = '' THEN 'UNKNOWN'
        WHEN {p} LIKE '%windows%' THEN CASE WHEN {p} LIKE '%server%' THEN 'Windows Server' ELSE 'Windows' END
        WHEN {p} LIKE '%macos%' OR {p} LIKE '%mac os%' OR {p} LIKE '%darwin%' THEN 'macOS'
        WHEN regexp_matches({p}, 'linux|ubuntu|centos|rhel|debian|suse') THEN 'Linux'
        ELSE upper(substring({p}, 1, 1)) || substring({p}, 2) END"""


def status(x: str) -> str:
    s = f"lower({trim(x)})"
    return f"""CASE WHEN {x} IS NULL OR {x} = '' THEN 'Unknown'
        WHEN {s} IN ('1', 'true', 'yes', 'online', 'active') THEN 'Online'
        WHEN {s} IN ('0', 'false', 'no', 'offline', 'inactive') THEN 'Offline'
        ELSE upper(substring({s}, 1, 1)) || substring({s}, 2) END"""


def missing_or_trimmed(x: str) -> str:
    return trim(f"nullif({x}, '')")


def percentage(part: str, total: str) -> str:
    """Exact binary rounding of the double, halves up, with wide integers."""
    x = f"(CAST({part} AS DOUBLE) / CAST({total} AS DOUBLE) * 100)"
    scaled = f"CAST({x} * 1125899906842624 * 128 AS HUGEINT)"
    unit = "CAST(144115188075855872 AS HUGEINT)"
    tenths = f"(({scaled} * 20 + {unit}) // ({unit} * 2))"
    return (f"CASE WHEN {total} = 0 THEN 'NaN%' ELSE CAST({tenths} // 10 AS VARCHAR) || '.' || "
            f"CAST({tenths} % 10 AS VARCHAR) || '%' END")


ISO = r"^\d{4}(-\d{2}(-\d{2}([T ]\d{2}:\d{2}(:\d{2}(\.\d+)?)?(Z|[+-]\d{2}:\d{2})?)?)?)?$"


def moment(x: str) -> str:
    base = (f"regexp_replace(regexp_replace({x}, '([T ].*?)(Z|[+-]\\d{{2}}:\\d{{2}})$', '\\1'), "
            f"'(\\.\\d{{3}})\\d+', '\\1')")
    full = f"CASE length({x}) WHEN 4 THEN {x} || '-01-01' WHEN 7 THEN {x} || '-01' ELSE {base} END"
    offset = f"regexp_extract({x}, '[T ].*([+-]\\d{{2}}:\\d{{2}})$', 1)"
    minutes = (f"CASE WHEN {offset} = '' THEN 0 ELSE (CASE WHEN {offset}[1] = '-' THEN -1 ELSE 1 END) * "
               f"(60 * CAST(substring({offset}, 2, 2) AS INTEGER) + CAST(substring({offset}, 5, 2) AS INTEGER)) END")
    return (f"CASE WHEN regexp_matches({x}, '{ISO}') THEN "
            f"try_cast({full} AS TIMESTAMP) - to_minutes({minutes}) END")


def select(table: str, columns: dict[str, str]) -> str:
    return f"SELECT {', '.join(f'{expr} AS {quote(name)}' for name, expr in columns.items())} FROM {table}"


def quote(name: str) -> str:
    return f'"{name}"'


def _records_a(lines: str, order: str) -> str:
    """Fields of ``lines`` (value, order columns) as usable records of system A."""
    f = [trim(f"fields[{i}]") for i in range(1, 6)]
    return f"""SELECT * FROM (
        SELECT {order}, {hostname(f[0])} AS hostname, {f[3]} AS description, {platform(f[1])} AS platform,
               {missing_or_trimmed(f[2])} AS ip_address, 'Online' AS status, {f[4]} AS last_seen
        FROM (SELECT *, string_split(value, ',') AS fields FROM ({lines}) WHERE value LIKE '%,%')
    ) WHERE hostname <> ''"""


def _records_b(lines: str, order: str) -> str:
    f = [trim(f"fields[{i}]") for i in range(1, 5)]
    return f"""SELECT * FROM (
        SELECT {order}, {hostname(f[0])} AS hostname, {missing_or_trimmed(f[1])} AS os_version,
               {status(f[2])} AS status, {missing_or_trimmed(f[3])} AS agent_version
        FROM (SELECT *, string_split(value, ';') AS fields FROM ({lines}) WHERE value LIKE '%;%')
    ) WHERE hostname <> ''"""


def _first(records: str, order: str) -> str:
    return f"""SELECT * EXCLUDE ({order}, rn) FROM (
        SELECT *, row_number() OVER (PARTITION BY hostname ORDER BY {order}) AS rn,
               count(*) OVER (PARTITION BY hostname) AS source_rows
        FROM ({records})) WHERE rn = 1"""


ORDER_A = ", ".join(fx.ORDER_A)
RECORDS_A = _records_a(f"SELECT *, {fx.LINE_A} AS value FROM lineitem", ORDER_A)
RECORDS_B = _records_b(f"SELECT o_orderkey, {fx.LINE_B} AS value FROM orders", "o_orderkey")
STORED_A = _records_a(f"SELECT event_id, {fx.LINE_PREVIOUS_A} AS value FROM events", "event_id")
STORED_B = _records_b(f"SELECT c_custkey, {fx.LINE_PREVIOUS_B} AS value FROM customer", "c_custkey")

A = f"a AS ({_first(RECORDS_A, ORDER_A)})"
B = f"b AS ({_first(RECORDS_B, 'o_orderkey')})"
PREV_A = f"prev_a AS ({_first(STORED_A, 'event_id')})"
PREV_B = f"prev_b AS ({_first(STORED_B, 'c_custkey')})"
COVERAGE = """coverage AS (
    SELECT coalesce(a.hostname, b.hostname) AS hostname, a.description,
           CASE WHEN a.hostname IS NULL THEN 0 ELSE 1 END AS in_a,
           CASE WHEN b.hostname IS NULL THEN 0 ELSE 1 END AS in_b,
           a.status AS status_a, b.status AS status_b, a.last_seen AS last_seen_a,
           CASE WHEN b.hostname IS NOT NULL THEN '2024-01-31T00:00:00.000Z' END AS last_seen_b,
           CASE WHEN a.hostname IS NULL THEN 'ENDPOINT_ONLY' WHEN b.hostname IS NULL THEN 'REMOTE_ONLY'
                ELSE 'FULL_COVERAGE' END AS coverage_status
    FROM a FULL OUTER JOIN b ON a.hostname = b.hostname)"""
MATCH = f"WITH {A}, {B}, {COVERAGE}"
REPORT = """SELECT hostname, description, CASE WHEN in_a = 1 THEN 'Yes' ELSE 'No' END AS in_a,
    CASE WHEN in_b = 1 THEN 'Yes' ELSE 'No' END AS in_b, coverage_status FROM coverage"""
SUMMARY = """summary AS (
    SELECT count(*) AS total, count(*) FILTER (WHERE in_a = 1 AND in_b = 1) AS full_coverage,
           count(*) FILTER (WHERE in_b = 0) AS a_only, count(*) FILTER (WHERE in_a = 0) AS b_only
    FROM coverage)"""
METRICS = f"""metrics AS (
    SELECT 1 AS position, 'Total Devices' AS "Metric", CAST(total AS VARCHAR) AS "Count" FROM summary
    UNION ALL SELECT 2, 'Full Coverage', CAST(full_coverage AS VARCHAR) FROM summary
    UNION ALL SELECT 3, 'Remote Only', CAST(a_only AS VARCHAR) FROM summary
    UNION ALL SELECT 4, 'Endpoint Only', CAST(b_only AS VARCHAR) FROM summary
    UNION ALL SELECT 5, 'Coverage Percentage', {percentage('full_coverage', 'total')} FROM summary)"""


def csv(x: str) -> str:
    return f"""CASE WHEN {x} IS NULL THEN '' ELSE '"' || replace(CAST({x} AS VARCHAR), '"', '""') || '"' END"""


REPORT_LINES = f"""SELECT '"hostname","computerDescription","In Remote","In Endpoint","Coverage Status"' AS line
    UNION ALL SELECT {" || ',' || ".join(csv(c) for c in ('hostname', 'description', 'in_a', 'in_b', 'coverage_status'))}
    FROM ({REPORT})"""
SUMMARY_LINES = f"""SELECT '"Metric","Count"' AS line
    UNION ALL SELECT {csv('"Metric"')} || ',' || {csv('"Count"')} FROM metrics"""


def _event(system: str, action: str, message: str, count: str, day: str = "2024-01-31",
           run: str = "20240131T000000000000") -> str:
    return f"""SELECT '{day} 00:00:00' AS event_ts, '{system}' AS system, '{action}' AS action,
        'SUCCESS' AS status, replace('{message}', '#', CAST(n AS VARCHAR)) AS message,
        n AS records_processed, '{run}' AS run_id FROM (SELECT count(*) AS n FROM ({count}))
        WHERE n > 0 OR '{action}' <> 'delete_stale'"""


def _stale(prev: str, cur: str) -> str:
    return f"SELECT hostname FROM {prev} WHERE hostname NOT IN (SELECT hostname FROM {cur})"


_DAY_BEFORE = {"day": "2024-01-30", "run": "20240130T000000000000"}


def _delimiter(x: str) -> str:
    def count(char: str) -> str:
        return f"length({x}) - length(replace({x}, {char}, ''))"
    tabs, commas, semis = count("chr(9)"), count("','"), count("';'")
    return f"""CASE WHEN {x} IS NULL THEN NULL WHEN {tabs} > {commas} AND {tabs} > {semis} THEN chr(9)
        WHEN {semis} > {commas} THEN ';' ELSE ',' END"""


def _position(*aliases: str) -> str:
    found = ", ".join(f"nullif(list_position(names, '{alias}'), 0)" for alias in aliases)
    return f"CAST(coalesce({found}, 0) - 1 AS INTEGER)"


def _audit(name: str, source: str, flags: str = "0") -> str:
    return f"""SELECT '{name}' AS table_name, count(*) AS total_rows,
        count(*) FILTER (WHERE hostname IS NULL) AS null_keys,
        count(hostname) - count(DISTINCT hostname) AS duplicate_keys,
        CAST(coalesce(sum({flags}), 0) AS BIGINT) AS bad_flags FROM ({source})"""


def _stats(label: str, value: str, source: str) -> str:
    return f"""WITH s AS (
        SELECT {label} AS label, {value} AS v, row_number() OVER (PARTITION BY {label} ORDER BY {value}) - 1 AS i,
               count(*) OVER (PARTITION BY {label}) AS n FROM {source} WHERE {value} IS NOT NULL)
    SELECT label, count(*) AS count, min(v) AS min, max(v) AS max, round(avg(v), 6) AS avg,
        max(CASE WHEN i = CAST(floor(n * CAST('0.5' AS DOUBLE)) AS BIGINT) THEN v END) AS median,
        max(CASE WHEN i = CAST(floor(n * CAST('0.95' AS DOUBLE)) AS BIGINT) THEN v END) AS p95,
        max(CASE WHEN i = CAST(floor(n * CAST('0.99' AS DOUBLE)) AS BIGINT) THEN v END) AS p99,
        round(sum(v), 4) AS total
    FROM s GROUP BY label"""


_email_ok = r"regexp_matches(email, '^[^\s\x0b\x{00a0}\x{feff}@]+@[^\s\x0b\x{00a0}\x{feff}@]+\.[^\s\x0b\x{00a0}\x{feff}@]+$')"
_phone_ok = r"regexp_matches(phone, '^\+?[\d\s\-().]{10,}$')"


def _errors(key: str, source: str, *checks: tuple[str, str]) -> str:
    joined = ", ".join(f"CASE WHEN {broken} THEN '{message}' END" for message, broken in checks)
    return f"""SELECT {key}, errors = '' AS valid, errors FROM (
        SELECT {key}, concat_ws('; ', {joined}) AS errors FROM ({source}))"""


def _json_given(name: str) -> str:
    kind, text = f"json_type(r, '$.{name}')", f"json_extract_string(r, '$.{name}')"
    return f"""coalesce(CASE {kind} WHEN 'NULL' THEN false WHEN 'VARCHAR' THEN {text} <> ''
        WHEN 'BOOLEAN' THEN {text} = 'true' WHEN 'OBJECT' THEN true WHEN 'ARRAY' THEN true
        ELSE try_cast({text} AS DOUBLE) <> 0 END, false)"""


_activity = moment("json_extract_string(r, '$.lastActivity')")

_log = """SELECT event_id, '{"timestamp":"' || strftime(ts, '%Y-%m-%dT%H:%M:%S.%g') || 'Z","level":"' ||
    CASE event_type WHEN 'error' THEN 'ERROR' WHEN 'view' THEN 'DEBUG' ELSE 'INFO' END ||
    '","message":"User \\"' || CAST(user_id AS VARCHAR) || '\\" ' || event_type || '","user":' ||
    CAST(user_id AS VARCHAR) || ',"value":' || CAST(value AS VARCHAR) || ',"props":' || to_json(props) ||
    ',"parent":null}' AS line FROM events"""

_seconds = "seconds"
_hours, _minutes, _rest = f"({_seconds} // 3600)", f"({_seconds} % 3600 // 60)", f"({_seconds} % 60)"


def _duration(seconds: str) -> str:
    return f"""CASE WHEN {seconds} IS NULL OR {seconds} = 0 THEN 'N/A' WHEN {seconds} < 0 THEN '0s' ELSE concat_ws(' ',
        CASE WHEN {_hours} > 0 THEN CAST({_hours} AS VARCHAR) || 'h' END,
        CASE WHEN {_minutes} > 0 THEN CAST({_minutes} AS VARCHAR) || 'm' END,
        CASE WHEN {_rest} > 0 THEN CAST({_rest} AS VARCHAR) || 's' END) END"""


def _size(amount: str, width: int, unit: str) -> str:
    cents = f"((CAST({amount} AS HUGEINT) * 200 + {width}) // {2 * width})"
    return f"CAST({cents} // 100 AS VARCHAR) || '.' || lpad(CAST({cents} % 100 AS VARCHAR), 2, '0') || ' {unit}'"


def _text_of_bytes(amount: str, parts: int = 1) -> str:
    """``amount`` counts ``parts`` to the byte."""
    cases = " ".join(f"WHEN {amount} < {parts * 1024 ** (power + 1)} THEN {_size(amount, parts * 1024 ** power, unit)}"
                     for power, unit in enumerate(("B", "KB", "MB")))
    return f"CASE {cases} ELSE {_size(amount, parts * 1024 ** 3, 'GB')} END"


def _text_of_quarters(amount: str) -> str:
    return _text_of_bytes(f"({amount})", 4)


ORACLES: dict[str, str] = {
    "ingest_lines": f"""SELECT * FROM (SELECT o_orderkey AS line_no, {fx.LINE_B} AS value FROM orders)
        WHERE {trim('value')} <> ''""",
    "detect_delimiter": f"""
        SELECT 'documents' AS origin, doc_id AS id, {_delimiter('text')} AS delimiter FROM documents
        UNION ALL SELECT 'pages', page_id, {_delimiter('html')} FROM pages
        UNION ALL SELECT 'benchmark', item_id, {_delimiter('text')} FROM benchmark""",
    "resolve_columns": f"""
        WITH h AS (SELECT event_id, {fx.HEADER_VARIANTS} AS header FROM events),
        d AS (SELECT event_id, header, {_delimiter('header')} AS delimiter FROM h),
        n AS (SELECT event_id, delimiter, list_transform(string_split(header, delimiter),
              lambda x: lower({trim('x')})) AS names FROM d)
        SELECT event_id, delimiter,
            {_position('host name', 'hostname', 'id', 'computer')} AS a_hostname,
            {_position('os type', 'platform', 'os')} AS a_platform,
            {_position('ip address', 'ipaddress', 'ip')} AS a_ip_address,
            {_position('computer description', 'description', 'name')} AS a_description,
            {_position('last boot date', 'lastseen', 'last seen')} AS a_last_seen,
            {_position('id', 'hostname', 'host name', 'computer')} AS b_hostname,
            {_position('osversion', 'os version', 'os')} AS b_os_version,
            {_position('status')} AS b_status,
            {_position('agentversion', 'agent version', 'version')} AS b_agent_version
        FROM n""",
    "parse_inventory": f"""WITH {A} SELECT *, strftime({moment('last_seen')}, '%Y-%m-%d %H:%M:%S') AS last_seen_ts
        FROM a""",
    "parse_inventory_b": f"WITH {B} SELECT * FROM b",
    "stale_devices": f"WITH {A}, {PREV_A} {_stale('prev_a', 'a')}",
    "stale_hosts": f"WITH {B}, {PREV_B} {_stale('prev_b', 'b')}",
    "delete_stale": f"WITH {B}, {PREV_B} SELECT * FROM prev_b WHERE hostname IN (SELECT hostname FROM b)",
    "snapshot_upsert": f"""WITH {A}, {PREV_A}
        SELECT * FROM a UNION ALL SELECT * FROM prev_a WHERE hostname NOT IN (SELECT hostname FROM a)""",
    "snapshot_sync": f"""WITH {B}, {PREV_B}
        SELECT * FROM b UNION ALL SELECT * FROM prev_b WHERE hostname NOT IN ({_stale('prev_b', 'b')})
            AND hostname NOT IN (SELECT hostname FROM b)""",
    "dedupe_first_wins": """SELECT customer, o_orderkey, o_totalprice, o_orderpriority FROM (
        SELECT *, nullif(o_custkey, 0) AS customer,
               row_number() OVER (PARTITION BY nullif(o_custkey, 0) ORDER BY o_orderkey) AS rn FROM orders)
        WHERE rn = 1""",
    "dedupe_null_order": """SELECT user_id, event_type,
        min(event_id) FILTER (WHERE user_id % 3 <> 0) AS place,
        CASE WHEN user_id % 3 <> 0 THEN min(event_id) ELSE user_id END AS kept_value
        FROM events GROUP BY user_id, event_type""",
    "dedupe_counts": f"""SELECT count(*) AS total_rows, count(DISTINCT hostname) AS unique_rows,
        count(*) - count(DISTINCT hostname) AS duplicate_rows FROM ({RECORDS_A})""",
    "hostname_collisions": f"""SELECT substring(full_name, 1, 15) AS hostname,
        count(DISTINCT full_name) AS distinct_names, count(*) AS total_rows
        FROM (SELECT {hostname(fx.RAW_A['host_raw'], length=False)} AS full_name FROM lineitem)
        WHERE full_name <> '' GROUP BY 1 HAVING count(DISTINCT full_name) > 1""",
    "coverage_match": f"{MATCH} SELECT * FROM coverage",
    "coverage_hostnames": f"WITH {A}, {B} SELECT hostname FROM a UNION SELECT hostname FROM b ORDER BY hostname",
    "coverage_report": f"{MATCH} {REPORT} ORDER BY coverage_status DESC, hostname",
    "coverage_summary_by_status": f"""{MATCH} SELECT coverage_status, count(*) AS devices FROM coverage
        GROUP BY coverage_status ORDER BY devices DESC, coverage_status""",
    "coverage_summary": f"{MATCH}, {SUMMARY} SELECT * FROM summary",
    "coverage_summary_metrics": f"{MATCH}, {SUMMARY}, {METRICS} SELECT * FROM metrics",
    "report_csv_lines": f"{MATCH} {REPORT_LINES}",
    "summary_csv_lines": f"{MATCH}, {SUMMARY}, {METRICS} {SUMMARY_LINES}",
    "csv_lines_any_text": f"""SELECT '"Conversation","Turn","Note","Text"' AS line UNION ALL
        SELECT {csv('conv_id')} || ',' || {csv('turn')} || ',' || {csv('note')} || ',' || {csv('text')} FROM (
            SELECT conv_id, turn, text, CASE turn % 3 WHEN 0 THEN NULL WHEN 1 THEN ''
                ELSE 'say "' || role || '", then stop' END AS note FROM conversations)""",
    "coverage_percentages": f"""SELECT part, total, count(*) AS n, {percentage('part', 'total')} AS percentage
        FROM (SELECT l_partkey % (l_orderkey % 2000 + 1) AS part, l_orderkey % 2000 AS total FROM lineitem)
        GROUP BY part, total""",
    "import_both_report": f"{MATCH} {REPORT}",
    "etl_event_log": f"""{MATCH}, {PREV_A}, {PREV_B}
        {_event('Remote', 'delete_stale', 'Deleted # stale devices', _stale('prev_a', 'a'))}
        UNION ALL {_event('Remote', 'import', 'Imported # devices', 'SELECT * FROM a')}
        UNION ALL {_event('Endpoint', 'delete_stale', 'Deleted # stale hosts', _stale('prev_b', 'b'))}
        UNION ALL {_event('Endpoint', 'import', 'Imported # hosts', 'SELECT * FROM b')}
        UNION ALL {_event('Coverage', 'calculate', 'Calculated coverage for # devices', 'SELECT * FROM coverage')}""",
    "etl_event_log_stored": f"""WITH {B}, {PREV_B}
        {_event('Endpoint', 'import', 'Imported # hosts', 'SELECT * FROM prev_b', **_DAY_BEFORE)}
        UNION ALL {_event('Coverage', 'calculate', 'Calculated coverage for # devices', 'SELECT * FROM prev_b',
                          **_DAY_BEFORE)}
        UNION ALL {_event('Endpoint', 'delete_stale', 'Deleted # stale hosts', _stale('prev_b', 'b'))}
        UNION ALL {_event('Endpoint', 'import', 'Imported # hosts', 'SELECT * FROM b')}
        UNION ALL {_event('Coverage', 'calculate', 'Calculated coverage for # devices', 'SELECT * FROM b')}""",
    "export_report_files": f"""{MATCH}, {SUMMARY}, {METRICS}
        SELECT 'report' AS file, line FROM ({REPORT_LINES})
        UNION ALL SELECT 'summary', line FROM ({SUMMARY_LINES})""",
    "constraint_audit": f"""{MATCH}
        {_audit('inventory_a', 'SELECT * FROM a')}
        UNION ALL {_audit('inventory_b', 'SELECT * FROM b')}
        UNION ALL {_audit('device_coverage', 'SELECT * FROM coverage',
                          'CASE WHEN in_a NOT IN (0, 1) OR in_b NOT IN (0, 1) THEN 1 ELSE 0 END')}
        UNION ALL {_audit('records_a', RECORDS_A)}
        UNION ALL {_audit('customer_segments', "SELECT CASE WHEN c_nationkey = 3 THEN NULL ELSE c_mktsegment END "
                          "AS hostname, c_nationkey % 4 AS flag FROM customer",
                          'CASE WHEN flag NOT IN (0, 1) THEN 1 ELSE 0 END')}""",
    "normalize_hostname": f"""SELECT host_raw, {hostname('host_raw')} AS hostname
        FROM (SELECT {fx.RAW_A['host_raw']} AS host_raw FROM lineitem)""",
    "normalize_platform": f"""SELECT p_partkey, platform_raw, {platform('platform_raw')} AS platform FROM (
        SELECT p_partkey, CASE WHEN p_size < 25 THEN {fx.platform_variants('p_partkey')}
            WHEN p_size < 49 THEN p_type || ' ' || p_name END AS platform_raw FROM part)""",
    "normalize_status": f"""SELECT o_orderkey, status_raw, {status('status_raw')} AS status FROM (
        SELECT o_orderkey, CASE WHEN o_orderpriority = '1-URGENT' THEN NULL WHEN o_orderpriority = '2-HIGH'
            THEN o_orderstatus ELSE {fx.RAW_B['status_raw']} END AS status_raw FROM orders)""",
    "trim_fields": f"""SELECT o_orderkey, {missing_or_trimmed('os_version_raw')} AS os_version,
        {missing_or_trimmed('agent_version_raw')} AS agent_version, {missing_or_trimmed('ip_raw')} AS ip
        FROM (SELECT o_orderkey, {fx.RAW_B['os_version_raw']} AS os_version_raw,
            {fx.RAW_B['agent_version_raw']} AS agent_version_raw,
            CASE WHEN o_orderkey % 3 = 0 THEN ' ' || chr(9) || '10.0.0.' || CAST(o_custkey AS VARCHAR) || ' '
                 WHEN o_orderkey % 3 = 1 THEN '  ' END AS ip_raw FROM orders)""",
    "clean_contacts": f"""SELECT c_custkey, coalesce({trim('"contactId"')}, '') AS contact,
        lower(coalesce({trim('email')}, '')) AS email,
        coalesce(regexp_replace(phone, '[^0-9]', '', 'g'), '') AS phone FROM ({select('customer', fx.CONTACTS)})""",
    "clean_texts": f"""SELECT doc_id, CAST(length({trim('text')}) AS BIGINT) AS trimmed_length,
        md5(lower({trim('source')})) AS source_hash, regexp_replace(text, '[^0-9]', '', 'g') AS digits
        FROM documents""",
    "parse_iso_date": f"""SELECT o_orderkey, text, strftime({moment('text')}, '%Y-%m-%d %H:%M:%S.%g') AS moment
        FROM (SELECT o_orderkey, {fx.DATE_VARIANTS} AS text FROM orders)""",
    "seconds_to_duration": f"""SELECT seconds, {_duration('seconds')} AS duration,
        {_duration('seconds')} AS duration_int, {_duration('seconds')} AS duration_double,
        CASE WHEN seconds < 0 THEN '0s' ELSE concat_ws(' ',
            CASE WHEN {_hours} > 0 THEN CAST({_hours} AS VARCHAR) || 'h' END,
            CASE WHEN {_minutes} > 0 THEN CAST({_minutes} AS VARCHAR) || 'm' END,
            CAST({_rest} AS VARCHAR) || '.5s') END AS duration_half
        FROM (SELECT {fx.SECONDS} AS seconds FROM lineitem)""",
    "format_bytes": f"""SELECT bytes, {_text_of_bytes('bytes')} AS text, {_text_of_bytes('(bytes % 2147483648)')} AS text_int,
        {_text_of_bytes('bytes')} AS text_double, {_text_of_quarters('(bytes % 1099511627776) * 4 + 1')} AS text_quarter
        FROM (SELECT {fx.BYTES} AS bytes FROM lineitem)""",
    "validate_devices": _errors(
        "event_id",
        f"""SELECT event_id, CASE WHEN json_valid(record) THEN record END AS r,
            coalesce(CASE WHEN json_valid(record) THEN json_type(record) END = 'OBJECT', false) AS is_record
            FROM (SELECT event_id, {fx.DEVICE_JSON_LAST} AS record FROM events)""",
        ("Record is not a JSON object", "NOT is_record"),
        ("Device must have an id or deviceId",
         f"is_record AND NOT ({_json_given('id')}) AND NOT ({_json_given('deviceId')})"),
        ("Device name must be a string",
         f"is_record AND ({_json_given('name')}) AND json_type(r, '$.name') <> 'VARCHAR'"),
        ("Device isOnline must be a boolean", "is_record AND json_type(r, '$.isOnline') <> 'BOOLEAN'"),
        ("Device lastActivity must be a valid date",
         f"is_record AND ({_json_given('lastActivity')}) AND ({_activity}) IS NULL"),
    ),
    "validate_contacts": _errors(
        "c_custkey", select("customer", fx.CONTACTS),
        ("Contact must have an id or contactId",
         "coalesce(id, 0) = 0 AND coalesce(\"contactId\", '') = ''"),
        ("Contact email is invalid", f"email <> '' AND NOT {_email_ok}"),
        ("Contact phone format is invalid", f"phone <> '' AND NOT {_phone_ok}"),
    ),
    "validate_sessions": _errors(
        "o_orderkey", select("orders", fx.SESSIONS),
        ("Session must have an id or sessionId",
         "coalesce(id, 0) = 0 AND coalesce(\"sessionId\", '') = ''"),
        ("Session must have a valid startTime", f"({moment(chr(34) + 'startTime' + chr(34))}) IS NULL"),
        ("Session endTime must be a valid date",
         f"\"endTime\" <> '' AND ({moment(chr(34) + 'endTime' + chr(34))}) IS NULL"),
    ),
    "validate_date_forms": f"""SELECT o_orderkey,
        o_orderkey % {len(fx.DATE_FORMS)} IN ({', '.join(str(i) for i, (_, ok) in enumerate(fx.DATE_FORMS) if ok)}) AS valid,
        CASE WHEN o_orderkey % {len(fx.DATE_FORMS)} IN ({', '.join(str(i) for i, (_, ok) in enumerate(fx.DATE_FORMS) if ok)})
            THEN '' ELSE 'Session must have a valid startTime' END AS errors FROM orders""",
    "flatten_props": """SELECT event_id, user_id AS actor_user_id, event_type AS actor_type_name,
        CAST(json_extract_string(props, '$.k') AS INTEGER) AS props_k, 'first' AS actor_user,
        'second' AS pair_user, CAST(user_id AS VARCHAR) || ',' || CAST(event_id AS VARCHAR) AS pair_ids
        FROM events""",
    "import_mixed_forms": _first(f"""SELECT * FROM (
        SELECT l_orderkey % 3 AS form, {ORDER_A}, {hostname('host')} AS hostname, description,
            {platform('platform')} AS platform, {missing_or_trimmed('ip')} AS ip_address, 'Online' AS status, last_seen
        FROM (SELECT *, {trim("CASE l_orderkey % 3 WHEN 2 THEN f[2] ELSE f[1] END")} AS host,
                {trim("CASE l_orderkey % 3 WHEN 0 THEN f[4] WHEN 1 THEN f[2] ELSE f[4] END")} AS description,
                {trim("CASE l_orderkey % 3 WHEN 0 THEN f[2] WHEN 1 THEN f[3] ELSE f[1] END")} AS platform,
                {trim("CASE l_orderkey % 3 WHEN 0 THEN f[3] WHEN 1 THEN f[4] END")} AS ip,
                {trim("CASE l_orderkey % 3 WHEN 0 THEN f[5] WHEN 1 THEN '2024-01-31T00:00:00.000Z' ELSE f[3] END")}
                    AS last_seen
            FROM (SELECT *, string_split(value, CASE l_orderkey % 3 WHEN 0 THEN ',' WHEN 1 THEN ';' ELSE chr(9) END) AS f
                FROM (SELECT *, CASE l_orderkey % 3 WHEN 0 THEN {fx.FORM_LINES[0]} WHEN 1 THEN {fx.FORM_LINES[1]}
                    ELSE {fx.FORM_LINES[2]} END AS value FROM lineitem)) WHERE len(f) > 1))
        WHERE hostname <> ''""", f"form, {ORDER_A}"),
    "merged_coverage": f"{MATCH} SELECT * FROM coverage",
    "stored_changes": f"""WITH {PREV_B}, {B} SELECT coalesce(b.hostname, p.hostname) AS hostname,
        CASE WHEN p.hostname IS NULL THEN 'inserted' WHEN b.hostname IS NULL THEN 'stale' ELSE 'changed' END AS change
        FROM prev_b p FULL OUTER JOIN b ON b.hostname = p.hostname
        WHERE (p.os_version, p.status, p.agent_version, p.source_rows)
            IS DISTINCT FROM (b.os_version, b.status, b.agent_version, b.source_rows)
            OR p.hostname IS NULL OR b.hostname IS NULL""",
    "stored_run_times": f"""WITH {PREV_A}, {B}, times AS (
        SELECT 'inventory_a' AS table_name, hostname, TIMESTAMP '2024-01-30 00:00:00' AS moment FROM prev_a
        UNION ALL SELECT 'inventory_b', hostname, TIMESTAMP '2024-01-31 00:00:00' FROM b)
        SELECT table_name, hostname, strftime(moment, '%Y-%m-%d %H:%M:%S') AS imported_at,
            strftime(moment, '%Y-%m-%d %H:%M:%S') AS updated_at FROM times
        UNION ALL SELECT DISTINCT 'device_coverage', hostname, NULL, '2024-01-31 00:00:00' FROM times""",
    "rejected_lines": f"""SELECT 'inventory_a' AS table_name, CASE WHEN value LIKE '%,%' THEN 'unusable hostname'
        ELSE 'too few fields' END AS reason, value AS line, count(*) AS n
        FROM (SELECT {fx.LINE_A} AS value FROM lineitem)
        WHERE {trim('value')} <> '' AND (value NOT LIKE '%,%' OR coalesce({hostname("split_part(value, ',', 1)")}, '') = '')
        GROUP BY ALL""",
    "import_counts": f"""WITH lines AS (
        SELECT 'inventory_a' AS table_name, value, CASE WHEN value LIKE '%,%' THEN
            coalesce({hostname("split_part(value, ',', 1)")}, '') END AS host FROM (SELECT {fx.LINE_A} AS value FROM lineitem)
        UNION ALL SELECT 'inventory_b', value, CASE WHEN value LIKE '%;%' THEN
            coalesce({hostname("split_part(value, ';', 1)")}, '') END FROM (SELECT {fx.LINE_B} AS value FROM orders))
        SELECT table_name, count(DISTINCT nullif(host, '')) AS stored,
            count(nullif(host, '')) - count(DISTINCT nullif(host, '')) AS duplicates,
            count(*) FILTER (WHERE host IS NULL) AS too_few_fields, count(*) FILTER (WHERE host = '') AS unusable,
            count(*) AS lines FROM lines WHERE {trim('value')} <> '' GROUP BY table_name""",
    "flatten_open_props": """SELECT event_id, 'kept' AS record_k2, CASE event_id % 8
        WHEN 0 THEN '1' WHEN 4 THEN CAST(event_id AS VARCHAR) END AS record_k, CASE event_id % 8
        WHEN 4 THEN event_type END AS record_user, CASE event_id % 8
        WHEN 0 THEN CAST(user_id AS VARCHAR) WHEN 1 THEN 'u' || CAST(user_id AS VARCHAR)
        WHEN 2 THEN CAST(user_id AS VARCHAR) WHEN 5 THEN CAST(event_id AS VARCHAR) END AS record_user_id, CASE event_id % 8
        WHEN 0 THEN '["a",' || CAST(event_id AS VARCHAR) || ']' END AS record_user_tags, CASE event_id % 8
        WHEN 1 THEN event_type WHEN 5 THEN 'b' END AS record_user_home_city, CAST(NULL AS VARCHAR) AS record_user_home_zip,
        CASE event_id % 8 WHEN 2 THEN 'x' END AS record_user_name, CAST(NULL AS VARCHAR) AS record_none,
        CASE event_id % 8 WHEN 5 THEN '5' END AS "record_it's" FROM events""",
    "group_collect": """SELECT conv_id, (i - 1) // 1000 AS chunk, count(*) AS n,
        string_agg(role || ': ' || text, chr(10) ORDER BY i) AS talk
        FROM (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS i FROM conversations)
        GROUP BY conv_id, (i - 1) // 1000""",
    "group_collect_large": """SELECT kind, (i - 1) // 1000 AS chunk, count(*) AS n,
        string_agg(CAST(event_id AS VARCHAR), ',' ORDER BY i) AS ids
        FROM (SELECT event_id, nullif(event_type, 'error') AS kind,
              row_number() OVER (PARTITION BY nullif(event_type, 'error') ORDER BY event_id) AS i FROM events)
        GROUP BY kind, (i - 1) // 1000""",
    "duration_stats": _stats("event_type", "value", "events"),
    "duration_stats_lineitem": _stats("nullif(l_returnflag, 'N')", "l_extendedprice", "lineitem"),
    "batch_assign": """SELECT o_orderkey, i AS row_index, i // 100 AS batch_id FROM (
        SELECT o_orderkey, row_number() OVER (ORDER BY o_orderdate, o_orderkey) - 1 AS i FROM orders)""",
    "batch_map": """SELECT i // 100 AS batch_id, count(*) AS n_events, min(event_id) AS first_event,
        max(event_id) AS last_event, count(DISTINCT user_id) AS users FROM (
        SELECT event_id, user_id, row_number() OVER (ORDER BY event_id) - 1 AS i FROM events) GROUP BY i // 100""",
    "log_json_lines": _log,
    "recent_logs_stored": f"""SELECT line FROM ({_log}) WHERE event_id % 2 = 1 ORDER BY event_id DESC LIMIT 50""",
    "recent_logs": f"SELECT * FROM ({_log}) ORDER BY event_id DESC LIMIT 50",
    "log_dataset": """SELECT CASE event_type WHEN 'error' THEN 'ERROR' WHEN 'view' THEN 'DEBUG' ELSE 'INFO' END AS level,
        count(*) AS n, min(strftime(ts, '%Y-%m-%dT%H:%M:%S.%g') || 'Z') AS first_seen,
        max('User "' || CAST(user_id AS VARCHAR) || '" ' || event_type) AS last_message,
        count(DISTINCT user_id) AS users, CAST(4 AS BIGINT) AS extra_fields FROM events GROUP BY 1""",
}
