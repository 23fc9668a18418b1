"""The same queries as plain SQL for DuckDB, written apart from the Spark code."""

from __future__ import annotations

from checks import fixtures

KEYS = {
    "stage": "stage", "pet_dataset_id": "petdatasetid", "load_type": "loadtype", "is_enabled": "isenabled",
    "database_name": "databasename", "incremental_timestamp_method": "incrementaltimestampmethod",
    "incremental_timestamp_field": "incrementaltimestampfield",
    "incremental_header_to_tables_link_field": "incrementalheadertotableslinkfield", "schedule": "schedule",
    "week_days": "weekdays", "dates_of_month": "datesofmonth", "start_process_from_date": "startprocessfromdate",
    "dataset_owner": "datasetowner",
}


def _value_of(norm: str) -> str:
    return f"max(CASE WHEN lower(replace(trim(key), ' ', '')) = '{norm}' THEN nullif(trim(value), '') END)"


# Common table expressions by name; each may use the ones before it.
CTES = {
    **{name: fixtures.sql(name) for name in fixtures._FIXTURES},
    # parameters, one row per dataset, with normalised enums
    "p": "SELECT dataset_id, " + ", ".join(f"{_value_of(n)} AS {c}" for c, n in KEYS.items())
    + " FROM fx_p WHERE trim(key) <> '' GROUP BY dataset_id",
    "n": """SELECT *, upper(coalesce(stage, '')) AS stage_key, upper(coalesce(load_type, '')) AS load_key,
 replace(upper(coalesce(incremental_timestamp_method, '')), '-', '_') AS method_key FROM p""",
    # cleaned fields with the fixed default database, and with the database of their own parameters
    "f": """SELECT dataset_id, row_no, coalesce(nullif(trim(database_name), ''), 'src') AS database_name,
 trim(table_name) AS table_name, trim(column_name) AS column_name FROM fx_i
 WHERE trim(database_name) <> '' OR trim(table_name) <> '' OR trim(column_name) <> ''""",
    "own": """SELECT i.dataset_id, row_no, coalesce(nullif(trim(i.database_name), ''), p.database_name, '') AS database_name,
 trim(table_name) AS table_name, trim(column_name) AS column_name FROM fx_i i LEFT JOIN p ON i.dataset_id = p.dataset_id
 WHERE trim(i.database_name) <> '' OR trim(table_name) <> '' OR trim(column_name) <> ''""",
    "cand": "SELECT dataset_id, trim(table_name) AS table_name, min(row_no) AS first_row FROM fx_i WHERE trim(table_name) <> '' GROUP BY ALL",
    "start": """SELECT dataset_id, stage, CASE WHEN stage_key <> 'DATA-PROVISIONING' THEN
 coalesce(try_strptime(start_process_from_date, '%Y-%m-%d %H:%M:%S'), try_strptime(start_process_from_date, '%Y-%m-%d')) END AS start_ts,
 stage_key <> 'DATA-PROVISIONING' AND load_key = 'INCREMENTAL' AS needs_start FROM n""",
    "marks": """SELECT s.dataset_id, s.stage, w.table_name, w.last_ts FROM start s JOIN fx_w w ON s.dataset_id = w.dataset_id AND s.stage = w.stage
 UNION ALL SELECT s.dataset_id, s.stage, c.table_name, s.start_ts FROM start s JOIN cand c ON s.dataset_id = c.dataset_id
 WHERE s.start_ts IS NOT NULL AND NOT EXISTS (SELECT 1 FROM fx_w w WHERE w.dataset_id = s.dataset_id AND w.stage = s.stage AND w.table_name = c.table_name)""",
    # J3
    "look": """SELECT dataset_id, CASE WHEN method_key = 'TIMESTAMP_HEADER_TABLE' THEN 'link' ELSE 'timestamp' END AS kind,
 coalesce(database_name, '') AS db, coalesce(CASE WHEN method_key = 'TIMESTAMP_HEADER_TABLE' THEN incremental_header_to_tables_link_field
 ELSE incremental_timestamp_field END, '') AS spec FROM n WHERE stage_key <> 'DATA-PROVISIONING' AND
 (method_key = 'TIMESTAMP_HEADER_TABLE' OR (method_key = 'TIMESTAMP_DATA_TABLE' AND load_key = 'INCREMENTAL'))""",
    "look2": """SELECT l.*, contains(spec, '.') AND EXISTS (SELECT 1 FROM fx_c c WHERE lower(c.db) = lower(l.db)
 AND lower(c.table_name) = lower(split_part(l.spec, '.', 1))) AS qualified FROM look l WHERE spec <> ''""",
    # J4
    "spec": """SELECT dataset_id, coalesce(database_name, '') AS db, coalesce(incremental_timestamp_field, '') AS spec,
 CASE WHEN contains(incremental_timestamp_field, '.') THEN split_part(incremental_timestamp_field, '.', 1) END AS head,
 CASE WHEN contains(incremental_timestamp_field, '.') THEN substr(incremental_timestamp_field, strpos(incremental_timestamp_field, '.') + 1) END AS rest
 FROM n WHERE stage_key <> 'DATA-PROVISIONING' AND load_key = 'INCREMENTAL'""",
    "searched": """SELECT dataset_id, table_name, first_row FROM cand UNION ALL
 SELECT DISTINCT s.dataset_id, c.table_name, 0 FROM spec s JOIN fx_c c ON lower(c.db) = lower(s.db)
 WHERE NOT EXISTS (SELECT 1 FROM cand k WHERE k.dataset_id = s.dataset_id)""",
    "named": """SELECT s.*, m.table_name, CASE WHEN m.table_name IS NULL THEN s.spec ELSE s.rest END AS target FROM spec s
 LEFT JOIN (SELECT x.dataset_id, arg_min(x.table_name, x.first_row) AS table_name FROM searched x JOIN spec s2
  ON x.dataset_id = s2.dataset_id AND lower(x.table_name) = lower(s2.head) GROUP BY x.dataset_id) m ON s.dataset_id = m.dataset_id""",
    "hit": """SELECT q.dataset_id,
 bool_or(lower(c.path) = lower(q.target) AND c.depth = CASE WHEN contains(q.target, '.') THEN 2 ELSE 1 END) AS direct,
 list_sort(list_distinct(list(CASE WHEN c.depth = 2 AND NOT contains(q.target, '.') AND lower(c.leaf) = lower(q.target) THEN c.top || '.' || q.target END))) AS nested
 FROM named q JOIN searched x ON q.dataset_id = x.dataset_id JOIN fx_c c ON lower(c.db) = lower(q.db) AND lower(c.table_name) = lower(x.table_name)
 WHERE q.table_name IS NULL OR lower(x.table_name) = lower(q.table_name) GROUP BY q.dataset_id""",
    "j4": """SELECT q.*, CASE WHEN q.spec = '' THEN NULL WHEN h.direct THEN q.target WHEN len(h.nested) = 1 THEN h.nested[1] END AS resolved,
 CASE WHEN q.spec = '' THEN 'blank' WHEN h.direct OR len(h.nested) = 1 THEN 'resolved' WHEN len(h.nested) > 1 THEN 'ambiguous' ELSE 'not_found' END AS outcome,
 h.nested FROM named q LEFT JOIN hit h ON q.dataset_id = h.dataset_id""",
}

RULE = "SELECT dataset_id, {no} AS rule_no, CAST({row} AS BIGINT) AS row_no, '{rule}' AS rule, {text} AS message FROM {source}"


def _rule(no: int, rule: str, text: str, source: str, row: str = "0") -> str:
    return RULE.format(no=no, rule=rule, text=text, source=source, row=row)


def _q(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


ACTIVE = "stage_key <> 'DATA-PROVISIONING'"
LISTED = "'[' || coalesce({0}, '') || ']'"

R30 = _rule(30, "enabled", "'Dataset ' || dataset_id || ' is disabled (Is Enabled = FALSE). Skipping load.'", "p WHERE upper(coalesce(is_enabled, 'TRUE')) = 'FALSE'")
R31 = _rule(31, "database", "'Database Name missing'", "p WHERE database_name IS NULL")
R32 = _rule(32, "database", "'Database ''' || database_name || ''' not found'", "p WHERE database_name IS NOT NULL AND lower(database_name) NOT IN (SELECT lower(db) FROM fx_c)")


def _r41(fields: str) -> str:
    text = """CASE WHEN database_name = '' THEN '[Input Schema] Row ' || row_no || ': ''Database Name'' is empty and no default provided.'
 WHEN table_name = '' THEN '[Input Schema] Row ' || row_no || ': ''Table Name'' is empty.'
 WHEN column_name = '' THEN '[Input Schema] Row ' || row_no || ': ''Column Name'' is empty.'
 WHEN lower(database_name) NOT IN (SELECT lower(db) FROM fx_c) THEN '[Input Schema] Row ' || row_no || ': Database ''' || database_name || ''' not found.'
 WHEN NOT EXISTS (SELECT 1 FROM fx_c c WHERE lower(c.db) = lower(database_name) AND c.table_name = x.table_name AND lower(c.path) = lower(column_name))
 THEN '[Input Schema] Row ' || row_no || ': Not found → ' || database_name || '.' || table_name || '.' || column_name END"""
    return f"SELECT * FROM ({_rule(41, 'input_field', text, fields + ' x', 'row_no')}) WHERE message IS NOT NULL"


R50 = _rule(50, "stage", "'Stage is missing in DPS-CDP Params.'", "n WHERE stage_key = ''")
R51 = _rule(51, "pet_dataset_id", "'Pet Dataset ID is required'", "n WHERE pet_dataset_id IS NULL")
R52 = _rule(52, "load_type", _q("Load Type must be 'INCREMENTAL' or 'FULL'"), f"n WHERE {ACTIVE} AND load_key NOT IN ('INCREMENTAL', 'FULL')")
R53 = _rule(53, "timestamp_field", "'Incremental Timestamp Field must not be empty for INCREMENTAL load'", f"n WHERE {ACTIVE} AND load_key = 'INCREMENTAL' AND incremental_timestamp_field IS NULL")
R54 = "SELECT * FROM (" + _rule(54, "schedule", """CASE
 WHEN schedule IS NULL OR schedule NOT IN ('DAILY', 'WEEKLY', 'MONTHLY') THEN 'Invalid schedule ''' || coalesce(schedule, 'None') || '''. Must be DAILY, WEEKLY, or MONTHLY.'
 WHEN schedule = 'DAILY' AND (week_days IS NOT NULL OR dates_of_month IS NOT NULL) THEN 'For DAILY schedule, ''Week Days'' and ''Dates Of Month'' must be empty.'
 WHEN schedule = 'WEEKLY' AND week_days IS NULL THEN 'For WEEKLY schedule, ''Week Days'' must not be empty.'
 WHEN schedule = 'WEEKLY' AND dates_of_month IS NOT NULL THEN 'For WEEKLY schedule, ''Dates Of Month'' must be empty.'
 WHEN schedule = 'MONTHLY' AND dates_of_month IS NULL THEN 'For MONTHLY schedule, ''Dates Of Month'' must not be empty.'
 WHEN schedule = 'MONTHLY' AND week_days IS NOT NULL THEN 'For MONTHLY schedule, ''Week Days'' must be empty.' END""",
    f"n WHERE {ACTIVE} AND load_key = 'INCREMENTAL'") + ") WHERE message IS NOT NULL"
R55 = _rule(55, "full_load", "'For FULL load, incremental and schedule fields must be empty'", f"n WHERE {ACTIVE} AND load_key = 'FULL' AND coalesce(incremental_timestamp_field, schedule, week_days, dates_of_month) IS NOT NULL")
R56 = _rule(56, "method", _q("Incremental Timestamp Method must be 'TIMESTAMP_HEADER_TABLE' or 'TIMESTAMP_DATA_TABLE'"), f"n WHERE {ACTIVE} AND method_key NOT IN ('TIMESTAMP_HEADER_TABLE', 'TIMESTAMP_DATA_TABLE')")
R57 = _rule(57, "link_field", "'Incremental Header To Tables Link Field is required for TIMESTAMP_HEADER_TABLE'", f"n WHERE {ACTIVE} AND method_key = 'TIMESTAMP_HEADER_TABLE' AND incremental_header_to_tables_link_field IS NULL")


def _j3(fields: str) -> str:
    """Lookups with their outcome; the declared tables are those of ``fields``."""
    return f"""SELECT l.*, CASE WHEN qualified THEN EXISTS (SELECT 1 FROM fx_c c WHERE lower(c.db) = lower(l.db)
  AND c.table_name = split_part(l.spec, '.', 1) AND lower(c.path) = lower(substr(l.spec, strpos(l.spec, '.') + 1)))
 ELSE EXISTS (SELECT 1 FROM {fields} x JOIN fx_c c ON lower(c.db) = lower(x.database_name) AND c.table_name = x.table_name
  WHERE x.dataset_id = l.dataset_id AND lower(c.path) = lower(l.spec)) END AS found FROM look2 l"""


def _r5758(fields: str) -> str:
    names = f"(SELECT string_agg(DISTINCT '''' || database_name || '.' || table_name || '''', ', ' ORDER BY '''' || database_name || '.' || table_name || '''') FROM {fields} x WHERE x.dataset_id = l.dataset_id)"
    tables = f"CASE WHEN qualified THEN '[''' || db || '.' || split_part(spec, '.', 1) || ''']' ELSE {LISTED.format(names)} END"
    return f"""SELECT dataset_id, CASE kind WHEN 'link' THEN 57 ELSE 58 END AS rule_no, CAST(0 AS BIGINT) AS row_no,
 CASE kind WHEN 'link' THEN 'link_field' ELSE 'timestamp_field' END AS rule,
 CASE kind WHEN 'link' THEN 'TIMESTAMP_HEADER_TABLE field ''' ELSE 'Incremental Timestamp Field ''' END || spec || ''' not found. Searched tables: ' || {tables} AS message
 FROM ({_j3(fields)}) l WHERE NOT found"""


_PATHS = "(SELECT string_agg('''' || u.x || '''', ', ' ORDER BY u.x) FROM (SELECT unnest(j.nested) AS x) u)"
_SCANNED = "(SELECT string_agg('''' || j.db || '.' || x.table_name || '''', ', ' ORDER BY x.first_row, x.table_name) FROM searched x WHERE x.dataset_id = j.dataset_id)"
R70 = _rule(70, "timestamp_field", f"""CASE WHEN outcome = 'blank' THEN 'Incremental Timestamp Field is missing - 1'
 WHEN outcome = 'ambiguous' AND table_name IS NOT NULL THEN 'Ambiguous leaf ''' || rest || ''' in ' || db || '.' || table_name || '; candidates: ' || {LISTED.format(_PATHS)} || '. Please specify one in the sheet.'
 WHEN outcome = 'ambiguous' THEN 'Ambiguous leaf ''' || spec || ''' across tables in ' || db || '; candidates: ' || {LISTED.format(_PATHS)} || '. Please specify one in the sheet.'
 WHEN table_name IS NOT NULL THEN 'Not found → ' || db || '.' || table_name || '.' || rest
 ELSE 'Not found → ' || db || '.' || spec || '. Scanned tables: ' || {LISTED.format(_SCANNED)} END""", "j4 j WHERE outcome <> 'resolved'")
R71 = _rule(71, "start_date", _q("time data '") + " || start_process_from_date || " + _q("' does not match format '%Y-%m-%d'"),
            f"n WHERE {ACTIVE} AND load_key = 'INCREMENTAL' AND start_process_from_date IS NOT NULL AND coalesce(try_strptime(start_process_from_date, '%Y-%m-%d %H:%M:%S'), try_strptime(start_process_from_date, '%Y-%m-%d')) IS NULL")
R72 = _rule(72, "first_run", "'''Start Process From Date'' is required for first-time run of dataset ' || dataset_id",
            "start s WHERE needs_start AND start_ts IS NULL AND NOT EXISTS (SELECT 1 FROM fx_w w WHERE w.dataset_id = s.dataset_id AND w.stage = s.stage)")

R80 = " UNION ALL ".join(
    _rule(80, "not_null", f"'Column ''{c}'' must not be null'", f"n WHERE {p} IS NULL")
    for c, p in (("source_database_name", "database_name"), ("pet_dataset_id", "pet_dataset_id"), ("dataset_owner", "dataset_owner"), ("stage", "stage")))

ALL_RULES = " UNION ALL ".join([R30, R31, R32, _r41("own"), R50, R51, R52, R53, R54, R55, R56, R57, _r5758("own"), R70, R71, R72, R80])

_FETCH_EVENTS = "SELECT e.* FROM events e JOIN fx_marks w ON e.event_type = w.table_name WHERE e.ts > w.last_ts"
_FETCH_LINES = """SELECT * FROM lineitem WHERE l_orderkey IN
 (SELECT o_orderkey FROM orders WHERE o_orderdate > (SELECT last_ts FROM fx_line_mark WHERE table_name = 'lineitem'))"""
_ADVANCED = f"""SELECT w.table_name, greatest(coalesce(max(e.ts), w.last_ts), w.last_ts) AS last_ts FROM fx_marks w
 LEFT JOIN ({_FETCH_EVENTS}) e ON e.event_type = w.table_name GROUP BY w.table_name, w.last_ts"""
_ADVANCED_LINE = f"""SELECT w.table_name, coalesce((SELECT max(o_orderdate) FROM orders WHERE o_orderkey IN
 (SELECT l_orderkey FROM ({_FETCH_LINES}))), w.last_ts) AS last_ts FROM fx_line_mark w"""

SQL = {
    "s1_scan_workbooks": """SELECT dataset_id || '.xlsx' AS path, 'DPS-CDP Params' AS sheet, row_no, col_no, value FROM (
 SELECT dataset_id, row_no, 1 AS col_no, key AS value FROM fx_p UNION ALL SELECT dataset_id, row_no, 2, value FROM fx_p
 UNION ALL SELECT DISTINCT dataset_id, 1, 1, 'Key' FROM fx_p UNION ALL SELECT DISTINCT dataset_id, 1, 2, 'Value' FROM fx_p) WHERE value <> ''""",
    "s2_param_map": "SELECT dataset_id, row_number() OVER (PARTITION BY dataset_id ORDER BY row_no) - 1 AS pos, trim(key) AS key, nullif(trim(value), '') AS value FROM fx_p",
    "s3_param_get": f"SELECT dataset_id, {_value_of('incrementalheadertotableslinkfield')} AS link_field FROM fx_p GROUP BY dataset_id",
    "s3_param_columns": "SELECT * FROM p",
    "s4_catalog_columns": """SELECT c.table_name, CAST(c.ordinal_position AS INTEGER) AS ordinal, c.column_name AS path, count(d.k) AS n_declared
 FROM information_schema.columns c LEFT JOIN (SELECT o_orderkey % 5 AS k, CASE o_orderkey % 5 WHEN 0 THEN 'orders' WHEN 1 THEN 'lineitem' WHEN 2 THEN 'customer' ELSE 'events' END AS t,
  CASE o_orderkey % 5 WHEN 0 THEN 'o_custkey' WHEN 1 THEN 'l_shipdate' WHEN 2 THEN 'c_name' WHEN 3 THEN 'ts' ELSE 'nope' END AS col FROM orders) d
 ON c.table_name = d.t AND lower(c.column_name) = d.col
 WHERE c.table_name IN ('region', 'nation', 'customer', 'supplier', 'part', 'orders', 'lineitem', 'events', 'documents', 'embeddings', 'pages', 'benchmark', 'labels', 'conversations')
 GROUP BY ALL""",
    "s5_clean_input_fields": "SELECT * FROM f",
    "s6_declared_tables": "SELECT dataset_id, database_name, table_name, min(row_no) AS first_row FROM f GROUP BY ALL",
    "s6_candidate_tables": "SELECT * FROM cand",
    "p1_to_bool": "SELECT dataset_id, coalesce(lower(is_enabled) IN ('true', '1', 'yes', 'y'), false) AS is_enabled FROM p",
    "p2_enabled_only": "SELECT dataset_id, is_enabled FROM p WHERE upper(coalesce(is_enabled, 'TRUE')) <> 'FALSE'",
    "p3_parse_start_date": "SELECT dataset_id, coalesce(try_strptime(start_process_from_date, '%Y-%m-%d %H:%M:%S'), try_strptime(start_process_from_date, '%Y-%m-%d')) AS start_ts FROM p",
    "p4_normalise_enums": "SELECT dataset_id, stage, stage_key, load_key AS load_type, method_key AS incremental_timestamp_method FROM n",
    "p5_check_sheets": """SELECT dataset_id, 20 AS rule_no, CAST(0 AS BIGINT) AS row_no, 'required_sheets' AS rule,
 'Missing required sheets: {' || string_agg('''' || r || '''', ', ' ORDER BY r) || '}' AS message
 FROM (SELECT concat('DS_', c_custkey) AS dataset_id, unnest(['DPS-CDP Params', 'Input Schema', 'Specification']) AS r FROM customer) d
 WHERE NOT EXISTS (SELECT 1 FROM fx_t t WHERE t.dataset_id = d.dataset_id AND t.sheet = d.r) GROUP BY dataset_id""",
    "p6_check_spec_layout": "SELECT * FROM (" + _rule(25, "spec_layout", """CASE WHEN label <> x.want THEN 'Row ' || row_no || ' mismatch: expected ''' || x.want || ''', found ''' || label || ''''
 WHEN trim(value) = '' THEN 'Missing value for ''' || x.want || ''' at row ' || row_no END""",
        "fx_s JOIN (VALUES " + ", ".join(f"({i}, {_q(n)})" for i, n in enumerate(fixtures.SPEC_LIST, 1)) + ") AS x(pos, want) ON row_no = pos", "row_no") + ") WHERE message IS NOT NULL",
    "p7_check_identity": _rule(25, "external_id", "'Dataset ID mismatch between param and file'", "fx_s WHERE label = 'ExternalID' AND upper(trim(value)) <> upper(dataset_id)")
    + " UNION ALL " + _rule(25, "dataset_name", "'Dataset Name mismatch between param and file'", "fx_s WHERE label = 'Dataset Name' AND upper(trim(value)) <> upper(dataset_id)"),
    "p8_check_schedule": R54,
    "p9_check_calendar": "SELECT * FROM (" + _rule(62, "calendar", """coalesce(CASE WHEN week_days IS NOT NULL THEN
 (SELECT 'Invalid Week Days: {' || string_agg(DISTINCT '''' || dd || '''', ', ' ORDER BY '''' || dd || '''') || '}' FROM (SELECT upper(substr(trim(w), 1, 1)) || lower(substr(trim(w), 2)) AS dd
  FROM (SELECT unnest(string_split(week_days, ',')) AS w)) WHERE dd NOT IN ('Sunday', 'Monday', 'Tuesday', 'Wednesday', 'Thursday', 'Friday', 'Saturday')) END,
 CASE WHEN dates_of_month IS NOT NULL THEN (SELECT 'Dates Of Month must be between 1 and 28. Invalid: ' || first(trim(v) ORDER BY i) FROM
  (SELECT unnest(string_split(dates_of_month, ',')) AS v, generate_subscripts(string_split(dates_of_month, ','), 1) AS i)
  WHERE NOT regexp_full_match(trim(v), '[0-9]+') OR try_cast(trim(v) AS INTEGER) NOT BETWEEN 1 AND 28) END)""", f"n WHERE {ACTIVE}") + ") WHERE message IS NOT NULL",
    "p10_check_params": " UNION ALL ".join([R50, R51, R52, R53, R55, R56, R57]),
    "p11_first_error": f"""SELECT p.dataset_id, CASE WHEN v.message IS NULL THEN 'SUCCESS' ELSE 'FAILED' END AS status, coalesce(v.message, '') AS errors
 FROM p LEFT JOIN (SELECT dataset_id, first(message ORDER BY rule_no, row_no, message) AS message FROM ({ALL_RULES}) GROUP BY dataset_id) v ON p.dataset_id = v.dataset_id""",
    "j1_missing_databases": "SELECT * FROM f WHERE lower(database_name) NOT IN (SELECT lower(db) FROM fx_c)",
    "j1_check_databases": f"{R31} UNION ALL {R32}",
    "j2_missing_fields": """SELECT * FROM f WHERE NOT EXISTS (SELECT 1 FROM fx_c c WHERE lower(c.db) = lower(f.database_name)
 AND c.table_name = f.table_name AND lower(c.path) = lower(f.column_name))""",
    "j2_check_fields": _r41("f"),
    "j3_locate_param_field": _j3("f"),
    "j3_check_param_fields": _r5758("f"),
    "j4_resolve_timestamp_field": "SELECT dataset_id, db, spec, table_name, resolved, outcome, coalesce(array_to_string(nested, ','), '') AS candidates FROM j4",
    "j4_check_timestamp_field": R70,
    "j5_dataset_conflicts": """SELECT dataset_id, 'SKIPPED' AS status, 'Overwrite disabled' AS message FROM fx_j_incoming WHERE dataset_id IN (SELECT dataset_id FROM fx_j_config)
 UNION SELECT dataset_id, 'FAILED', 'Dataset Name ''' || dataset_name || ''' is already used by another dataset' FROM fx_j_incoming i
 WHERE EXISTS (SELECT 1 FROM (SELECT * FROM fx_j_config UNION ALL SELECT * FROM fx_j_incoming) o WHERE o.dataset_name = i.dataset_name AND o.dataset_id <> i.dataset_id)""",
    "j6_incremental_by_header": f"SELECT l_orderkey, l_linenumber FROM ({_FETCH_LINES})",
    "j7_dataset_overview": """SELECT c.dataset_id, coalesce(n_fields, 0) AS n_fields, coalesce(n_runs, 0) AS n_runs, coalesce(n_failed_runs, 0) AS n_failed_runs, coalesce(n_events, 0) AS n_events
 FROM (SELECT DISTINCT dataset_id FROM fx_p) c LEFT JOIN (SELECT dataset_id, count(*) AS n_fields FROM f GROUP BY 1) a ON a.dataset_id = c.dataset_id
 LEFT JOIN (SELECT dataset_id, count(DISTINCT process_load_id) AS n_runs, count(DISTINCT CASE WHEN event_status = 'FAILED' THEN process_load_id END) AS n_failed_runs,
  count(*) AS n_events FROM fx_l GROUP BY 1) b ON b.dataset_id = c.dataset_id""",
    "a1_build_watermarks": "SELECT * FROM marks",
    "a1_check_first_run": R72,
    "a2_merge_watermarks": """WITH new AS (SELECT dataset_id, stage, table_name, last_ts + INTERVAL 1 DAY AS last_ts FROM fx_w_all WHERE table_name = 't2'
  UNION ALL SELECT dataset_id, stage, 't3', last_ts FROM fx_w_all WHERE table_name = 't1')
 SELECT * FROM new UNION ALL SELECT * FROM fx_w_all w WHERE NOT EXISTS (SELECT 1 FROM new n WHERE n.dataset_id = w.dataset_id AND n.table_name = w.table_name)""",
    "a3_incremental_by_table": f"SELECT event_id, event_type, ts FROM ({_FETCH_EVENTS})",
    "a4_full_fetch": "SELECT * FROM orders",
    "a5_project_declared": "SELECT event_id, ts AS meta_event_received_ts, event_type AS meta_src FROM events",
    "a6_advance_watermarks": _ADVANCED,
    "a6_advance_by_header": _ADVANCED_LINE,
    "a7_process_rollup": """SELECT r.*, p.database_name AS source_database_name, p.load_key AS load_type, w.last_ts AS last_process_timestamp FROM (
 SELECT process_load_id, min(dataset_id) AS dataset_id, CASE WHEN bool_or(event_status = 'FAILED') THEN 'FAILED' ELSE 'SUCCESS' END AS status,
 min(event_start_datetime) AS start_timestamp, max(event_end_datetime) AS end_timestamp,
 CAST((epoch_us(max(event_end_datetime)) - epoch_us(min(event_start_datetime))) // 1000000 AS VARCHAR) AS job_run_duration,
 first(event_message ORDER BY event_start_datetime, event_load_id) FILTER (WHERE event_status = 'FAILED') AS error_message,
 CAST(sum(record_count) AS BIGINT) AS record_count FROM fx_l GROUP BY process_load_id) r
 LEFT JOIN n p ON p.dataset_id = r.dataset_id
 LEFT JOIN (SELECT w.dataset_id, max(w.last_ts) AS last_ts FROM fx_w w JOIN n q ON q.dataset_id = w.dataset_id AND q.stage = w.stage GROUP BY 1) w ON w.dataset_id = r.dataset_id""",
    "record_run": """WITH cal AS (SELECT CAST(TIMESTAMP '2025-01-01' + to_days(CAST(i AS INTEGER)) AS DATE) AS day FROM range(0, 200) r(i)),
 j AS (SELECT e.*, c.is_enabled, c.schedule, c.week_days, c.dates_of_month, c.last_run_time, c.next_run_due_time,
   s.run_id AS s_run, s.state AS s_state, s.started AS s_started, s.finished AS s_finished,
   CASE action WHEN 'FINISH' THEN 'DONE' WHEN 'FAIL' THEN 'FAILED' END AS goal
  FROM fx_r_events e LEFT JOIN fx_r_config c USING (dataset_id, stage) LEFT JOIN fx_r_states s USING (dataset_id, stage)),
 o AS (SELECT *, CASE WHEN action = 'START' THEN CASE WHEN s_run = run_id THEN 'REPEATED'
    WHEN is_enabled AND (s_state IS NULL OR s_state <> 'RUNNING') THEN 'ACCEPTED' ELSE 'REJECTED' END
   WHEN s_run = run_id AND s_state = 'RUNNING' THEN 'ACCEPTED' WHEN s_run = run_id AND s_state = goal THEN 'REPEATED' ELSE 'REJECTED' END AS outcome FROM j)
 SELECT dataset_id, stage, run_id AS event_run_id, action, outcome,
  CASE WHEN outcome = 'ACCEPTED' THEN run_id ELSE s_run END AS run_id,
  CASE WHEN outcome = 'ACCEPTED' THEN coalesce(goal, 'RUNNING') ELSE s_state END AS state,
  CASE WHEN outcome = 'ACCEPTED' AND action = 'START' THEN "at" ELSE s_started END AS started,
  CASE WHEN outcome = 'ACCEPTED' THEN CASE WHEN action <> 'START' THEN "at" END ELSE s_finished END AS finished,
  CASE WHEN outcome = 'ACCEPTED' AND goal = 'DONE' THEN s_started ELSE last_run_time END AS last_run_time,
  CASE WHEN outcome = 'ACCEPTED' AND goal = 'DONE' THEN CASE WHEN is_enabled THEN (SELECT min(day + CAST(s_started AS TIME)) FROM cal
    WHERE day > CAST(s_started AS DATE) AND CASE schedule WHEN 'DAILY' THEN true
     WHEN 'WEEKLY' THEN list_contains(list_transform(string_split(week_days, ','), lambda x: lower(trim(x))), lower(dayname(day)))
     ELSE list_contains(list_transform(string_split(dates_of_month, ','), lambda x: trim(x)), CAST(day(day) AS VARCHAR)) END) END
   ELSE next_run_due_time END AS next_run_due_time FROM o""",
    "a8_schedule_days": """SELECT DISTINCT dataset_id, schedule, slot FROM (
 SELECT dataset_id, schedule, '' AS slot FROM p WHERE schedule = 'DAILY' UNION ALL
 SELECT dataset_id, schedule, upper(substr(trim(w), 1, 1)) || lower(substr(trim(w), 2)) FROM (SELECT dataset_id, schedule, unnest(string_split(week_days, ',')) AS w FROM p WHERE schedule = 'WEEKLY') UNION ALL
 SELECT dataset_id, schedule, trim(w) FROM (SELECT dataset_id, schedule, unnest(string_split(dates_of_month, ',')) AS w FROM p WHERE schedule = 'MONTHLY')) WHERE slot <> '' OR schedule = 'DAILY'""",
    # A calendar of the days after 2025-01-30 stands for the date arithmetic.
    "a9_next_due": """WITH cal AS (SELECT TIMESTAMP '2025-01-30 02:00:00' + to_days(CAST(i AS INTEGER)) AS t FROM range(1, 95) r(i))
 SELECT dataset_id, schedule, last_run_time IS NULL OR coalesce(next_run_due_time <= TIMESTAMP '2025-01-30 02:00:00', false) AS is_due,
 (SELECT min(t) FROM cal WHERE CASE schedule WHEN 'DAILY' THEN true
  WHEN 'WEEKLY' THEN list_contains(list_transform(string_split(a.week_days, ','), lambda x: lower(trim(x))), lower(dayname(t)))
  ELSE list_contains(list_transform(string_split(a.dates_of_month, ','), lambda x: trim(x)), CAST(day(t) AS VARCHAR)) END) AS next_run_due_time
 FROM fx_a a WHERE is_enabled""",
    "b1_config_rows": """SELECT n.dataset_id, coalesce(s.name, n.dataset_id) AS dataset_name, n.database_name AS source_database_name,
 CASE WHEN stage_key <> 'DATA-PROVISIONING' THEN load_key END AS load_type,
 coalesce(lower(n.is_enabled) IN ('true', '1', 'yes', 'y'), true) AS is_enabled, n.pet_dataset_id,
 CASE WHEN stage_key <> 'DATA-PROVISIONING' THEN method_key END AS incremental_timestamp_method,
 CASE WHEN stage_key <> 'DATA-PROVISIONING' THEN coalesce(j.resolved, n.incremental_timestamp_field) END AS incremental_timestamp_field,
 CASE WHEN stage_key <> 'DATA-PROVISIONING' THEN n.incremental_header_to_tables_link_field END AS incremental_header_to_tables_link_field,
 CASE WHEN stage_key <> 'DATA-PROVISIONING' THEN n.schedule END AS schedule, CASE WHEN stage_key <> 'DATA-PROVISIONING' THEN n.week_days END AS week_days,
 CASE WHEN stage_key <> 'DATA-PROVISIONING' THEN n.dates_of_month END AS dates_of_month, n.dataset_owner, n.stage,
 coalesce(m.watermarks, '') AS watermarks FROM n
 LEFT JOIN (SELECT dataset_id, max(nullif(trim(value), '')) AS name FROM fx_s WHERE label = 'Dataset Name' GROUP BY 1) s ON s.dataset_id = n.dataset_id
 LEFT JOIN j4 j ON j.dataset_id = n.dataset_id
 LEFT JOIN (SELECT dataset_id, stage, string_agg(table_name || '=' || strftime(last_ts, '%Y-%m-%d %H:%M:%S'), ',' ORDER BY table_name) AS watermarks FROM marks GROUP BY 1, 2) m
  ON m.dataset_id = n.dataset_id AND m.stage = n.stage""",
    "b2_input_field_rows": "SELECT f.dataset_id, f.database_name, f.table_name, column_name AS field_name, stage, row_no FROM f JOIN p ON p.dataset_id = f.dataset_id",
    "k1_replace_scope": "SELECT * FROM fx_k_target t WHERE NOT EXISTS (SELECT 1 FROM fx_k_incoming i WHERE i.dataset_id = t.dataset_id AND i.stage = t.stage) UNION ALL SELECT * FROM fx_k_incoming",
    "k2_upsert": """SELECT c_custkey, i.dataset_id, i.stage, i.c_acctbal, i.c_mktsegment, CASE WHEN t.c_custkey IS NOT NULL THEN t.last_run_time ELSE i.last_run_time END AS last_run_time
 FROM fx_k_incoming i LEFT JOIN fx_k_target t USING (c_custkey) UNION ALL SELECT * FROM fx_k_target WHERE c_custkey NOT IN (SELECT c_custkey FROM fx_k_incoming)""",
    "k3_append": "SELECT * FROM fx_k_target UNION ALL SELECT * FROM fx_k_incoming",
    "k4_remove_datasets": """SELECT 'config' AS part, dataset_id, c_custkey AS key FROM fx_k_target WHERE dataset_id NOT IN (SELECT dataset_id FROM fx_k_incoming)
 UNION ALL SELECT 'fields', dataset_id, row_no FROM f WHERE dataset_id NOT IN (SELECT dataset_id FROM fx_k_incoming)
 UNION ALL SELECT DISTINCT 'removed', dataset_id, CAST(0 AS BIGINT) FROM fx_k_target WHERE dataset_id IN (SELECT dataset_id FROM fx_k_incoming)""",
    "k5_assign_field_ids": "SELECT 1000 + row_number() OVER (ORDER BY substr(md5(dataset_id), 1, 3), dataset_id, row_no) AS field_id, dataset_id, row_no, column_name FROM f",
    "k6_conform": "SELECT event_load_id, process_load_id, dataset_id, event_name, event_start_datetime, CAST(NULL AS VARCHAR) AS event_status, record_count FROM fx_l",
    "k6_null_violations": " UNION ALL ".join(
        _rule(80, "not_null", f"'Column ''{c}'' must not be null'", f"p WHERE {c} IS NULL") for c in ("stage", "pet_dataset_id", "database_name", "dataset_owner")),
    "k7_overwrite": "SELECT * FROM fx_k_incoming",
    "fetch_datasets": """SELECT 'events' AS table_name, count(*) AS rows_fetched, CAST(sum(event_id) AS BIGINT) AS key_sum, max(ts) AS last_ts, CAST(NULL AS VARCHAR) AS message
 FROM events WHERE ts > TIMESTAMP '2024-01-25 12:00:00'
 UNION ALL SELECT 'orders', count(*), CAST(sum(o_orderkey) AS BIGINT), coalesce(max(CAST(o_orderdate AS TIMESTAMP)), TIMESTAMP '1998-06-01 00:00:00'), NULL
 FROM orders WHERE o_orderdate > TIMESTAMP '1998-06-01 00:00:00'
 UNION ALL SELECT 'lineitem', count(*), CAST(sum(l_orderkey) AS BIGINT), coalesce(max(CAST(o_orderdate AS TIMESTAMP)), TIMESTAMP '1998-01-01 00:00:00'), NULL
 FROM lineitem JOIN orders ON o_orderkey = l_orderkey WHERE o_orderdate > TIMESTAMP '1998-01-01 00:00:00'
 UNION ALL SELECT 'customer', count(*), CAST(sum(c_custkey) AS BIGINT), NULL, NULL FROM customer
 UNION ALL SELECT 'customer', NULL, NULL, NULL, 'Table ''customer'' has no declared column ''c_gone'' any more'
 UNION ALL SELECT 'part', NULL, NULL, NULL, 'Table ''part'' has no watermark; give a start date or upload the sheet again'""",
    "with_watermarks": """SELECT a.dataset_id, a.stage, a.table_name, CASE WHEN w.table_name IS NULL THEN a.last_ts ELSE w.last_ts + INTERVAL 2 DAY END AS last_ts
 FROM fx_w_all a LEFT JOIN fx_w w ON w.dataset_id = a.dataset_id AND w.stage = a.stage AND w.table_name = a.table_name
 WHERE EXISTS (SELECT 1 FROM fx_w x WHERE x.dataset_id = a.dataset_id AND x.stage = a.stage)""",
    "incremental_fetch": f"""SELECT r.table_name, count(*) AS rows_fetched, CAST(sum(row_key) AS BIGINT) AS key_sum, any_value(m.last_ts) AS last_ts FROM (
  SELECT event_type AS table_name, event_id AS row_key FROM ({_FETCH_EVENTS}) UNION ALL SELECT 'lineitem', l_orderkey FROM ({_FETCH_LINES})
  UNION ALL SELECT 'orders', o_orderkey FROM orders) r
 LEFT JOIN (SELECT * FROM ({_ADVANCED}) UNION ALL SELECT * FROM ({_ADVANCED_LINE})) m ON m.table_name = r.table_name GROUP BY r.table_name""",
}


def _with(body: str) -> str:
    """The query with the common table expressions it needs, in order."""
    def uses(text: str, name: str) -> bool:
        padded = "".join(ch if ch.isalnum() or ch == "_" else " " for ch in text)
        return name in padded.split()

    needed: list[str] = []
    text = body
    for name in reversed(list(CTES)):
        if uses(text, name):
            needed.insert(0, name)
            text += " " + CTES[name]
    if not needed:
        return body
    head = ",\n".join(f"{n} AS ({CTES[n]})" for n in needed)
    return f"WITH {head}\nSELECT * FROM (\n{body}\n)"


def oracle_sql() -> dict[str, str]:
    return {name: _with(body) for name, body in SQL.items()}
