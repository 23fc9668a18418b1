"""Sheets, watermarks, logs and control rows derived from the given tables.

Each fixture is one SELECT that Spark and DuckDB both run. Only the way a row is repeated once per
list entry differs: Spark explodes an array, DuckDB joins a VALUES list.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Sheet keys, sheet labels and sheet names as users write them.
PARAM_LIST = (
    "Stage", "Pet Dataset ID", "Load Type", "Is Enabled", "Database Name",
    "Incremental Timestamp Method", "Incremental Timestamp Field",
    "Incremental Header To Tables Link Field", "Schedule", "Week Days", "Dates Of Month",
    "Start Process From Date", "Dataset Owner",
)
SPEC_LIST = (
    "Source Tenant", "Dataset Name", "Data Sharing Agreement (DSA)", "Purpose",
    "Privacy Domain - Encryption Key", "Destination Tenant", "ExternalID",
    "Allow Missing Table", "Priority", "Policy",
)
SHEET_LIST = ("Specification", "Input Schema", "DPS-CDP Params", "Notes")


def _each(engine: str, table: str, names: tuple[str, ...], column: str, first: int = 1) -> str:
    """FROM clause giving every row of ``table`` once per name, with (pos, column)."""
    if engine == "duckdb":
        values = ", ".join(f"({i},'{n}')" for i, n in enumerate(names, start=first))
        return f"{table} CROSS JOIN (VALUES {values}) AS k(pos, {column})"
    structs = ", ".join(f"struct({i}, '{n}')" for i, n in enumerate(names, start=first))
    return f"{table} LATERAL VIEW inline(array({structs})) k AS pos, {column}"


def _fx_c(engine: str) -> str:
    return """
SELECT db, table_name, path, top, leaf, depth FROM (VALUES
 ('src','t1','id','id','id',1), ('src','t1','event_ts','event_ts','event_ts',1), ('src','t1','meta','meta','meta',1),
 ('src','t1','meta.ts','meta','ts',2), ('src','t1','meta.src','meta','src',2),
 ('src','t2','id','id','id',1), ('src','t2','header','header','header',1), ('src','t2','header.ts','header','ts',2),
 ('src','t3','id','id','id',1), ('src','t3','received','received','received',1), ('src','t3','received.rcv_ts','received','rcv_ts',2),
 ('src','t_hdr','hdr_id','hdr_id','hdr_id',1), ('src','t_hdr','header_link_ts','header_link_ts','header_link_ts',1)
) AS c(db, table_name, path, top, leaf, depth)"""


def _fx_p(engine: str) -> str:
    return f"""
SELECT concat('DS_', CAST(c_custkey AS STRING)) AS dataset_id, pos + 1 AS row_no,
 CASE WHEN c_custkey % 7 = 0 THEN lower(key) WHEN c_custkey % 11 = 0 THEN replace(key, ' ', '  ') ELSE key END AS key,
 CASE WHEN c_custkey % 5 = 0 THEN concat(' ', v, ' ') ELSE v END AS value
FROM (SELECT c_custkey, pos, key, CASE key
  WHEN 'Stage' THEN CASE WHEN c_custkey % 31 = 0 THEN '' WHEN c_custkey % 10 = 0 THEN 'Data-Provisioning' ELSE 'Domain-0-Transformation' END
  WHEN 'Pet Dataset ID' THEN CASE WHEN c_custkey % 37 = 0 THEN '' ELSE concat('P', CAST(c_custkey AS STRING)) END
  WHEN 'Load Type' THEN CASE WHEN c_custkey % 29 = 0 THEN 'DELTA' WHEN c_custkey % 6 = 0 THEN 'full' ELSE 'Incremental' END
  WHEN 'Is Enabled' THEN CASE WHEN c_custkey % 13 = 0 THEN 'False' WHEN c_custkey % 17 = 0 THEN 'No' WHEN c_custkey % 19 = 0 THEN '' ELSE 'TRUE' END
  WHEN 'Database Name' THEN CASE WHEN c_custkey % 61 = 0 THEN '' WHEN c_custkey % 59 = 0 THEN 'no_such_db' WHEN c_custkey % 2 = 0 THEN 'SRC' ELSE 'src' END
  WHEN 'Incremental Timestamp Method' THEN CASE WHEN c_custkey % 23 = 0 THEN 'OTHER' WHEN c_custkey % 3 = 0 THEN 'timestamp-header-table' ELSE 'TIMESTAMP_DATA_TABLE' END
  WHEN 'Incremental Timestamp Field' THEN CASE WHEN c_custkey % 67 = 0 THEN '' WHEN c_custkey % 6 = 0 AND c_custkey % 12 <> 0 THEN '' WHEN c_custkey % 8 = 0 THEN 'ts' WHEN c_custkey % 8 = 1 THEN 't1.event_ts' WHEN c_custkey % 8 = 2 THEN 'T1.META.TS' WHEN c_custkey % 8 = 3 THEN 'rcv_ts' WHEN c_custkey % 8 = 4 THEN 'meta.ts' WHEN c_custkey % 8 = 5 THEN 'missing_col' WHEN c_custkey % 8 = 6 THEN 'event_ts' ELSE 'nope.col' END
  WHEN 'Incremental Header To Tables Link Field' THEN CASE WHEN c_custkey % 3 <> 0 THEN '' WHEN c_custkey % 9 = 0 THEN 'header_link_ts' WHEN c_custkey % 15 = 0 THEN 't_hdr.nope' WHEN c_custkey % 21 = 0 THEN '' ELSE 't_hdr.header_link_ts' END
  WHEN 'Schedule' THEN CASE WHEN c_custkey % 6 = 0 THEN '' WHEN c_custkey % 4 = 0 THEN 'DAILY' WHEN c_custkey % 4 = 1 THEN 'WEEKLY' WHEN c_custkey % 4 = 2 THEN 'MONTHLY' WHEN c_custkey % 41 = 0 THEN 'HOURLY' ELSE 'DAILY' END
  WHEN 'Week Days' THEN CASE WHEN c_custkey % 6 = 0 THEN '' WHEN c_custkey % 4 = 1 AND c_custkey % 43 <> 0 THEN 'Monday, wednesday' WHEN c_custkey % 47 = 0 THEN 'Funday' ELSE '' END
  WHEN 'Dates Of Month' THEN CASE WHEN c_custkey % 6 = 0 THEN '' WHEN c_custkey % 4 = 2 AND c_custkey % 53 <> 0 THEN '1, 15, 31' ELSE '' END
  WHEN 'Start Process From Date' THEN CASE WHEN c_custkey % 9 = 0 THEN '' WHEN c_custkey % 9 = 1 THEN '05/02/2025' WHEN c_custkey % 2 = 0 THEN '2025-01-01 12:34:56' ELSE '2025-02-05' END
  ELSE CASE WHEN c_custkey % 79 = 0 THEN '' ELSE concat('owner', CAST(c_custkey % 20 AS STRING)) END END AS v
 FROM {_each(engine, 'customer', PARAM_LIST, 'key')}) q"""


def _fx_i(engine: str) -> str:
    return """
SELECT concat('DS_', CAST(o_custkey AS STRING)) AS dataset_id,
 o_orderkey + 2 AS row_no,
 CASE WHEN o_orderkey % 5 = 0 THEN '' WHEN o_orderkey % 97 = 0 THEN 'no_such_db' ELSE ' Src' END AS database_name,
 CASE WHEN o_orderkey % 15 = 0 THEN ' ' WHEN o_orderkey % 101 = 0 THEN '' WHEN o_orderkey % 4 = 0 THEN 't1' WHEN o_orderkey % 4 = 1 THEN 't2 ' WHEN o_orderkey % 4 = 2 THEN 't3' WHEN o_orderkey % 11 = 0 THEN 'T1' ELSE 't1' END AS table_name,
 CASE WHEN o_orderkey % 15 = 0 THEN '' WHEN o_orderkey % 103 = 0 THEN ' ' WHEN o_orderkey % 13 = 0 THEN 'nope' WHEN o_orderkey % 4 = 0 THEN 'META.ts' WHEN o_orderkey % 4 = 1 THEN 'header.ts' WHEN o_orderkey % 4 = 2 THEN 'ID' ELSE 'event_ts' END AS column_name
FROM orders"""


def _fx_t(engine: str) -> str:
    return f"""
SELECT concat('DS_', CAST(c_custkey AS STRING)) AS dataset_id, CASE WHEN c_custkey % 73 = 0 THEN lower(sheet) ELSE sheet END AS sheet
FROM {_each(engine, 'customer', SHEET_LIST, 'sheet')}
WHERE NOT (c_custkey % 17 = 0 AND pos = 3) AND NOT (c_custkey % 71 = 0 AND pos < 3)"""


def _fx_s(engine: str) -> str:
    return f"""
SELECT concat('DS_', CAST(c_custkey AS STRING)) AS dataset_id, pos AS row_no,
 CASE WHEN c_custkey % 19 = 0 AND pos = 4 THEN 'Porpoise' ELSE label END AS label,
 CASE WHEN c_custkey % 17 = 0 AND pos = 3 THEN '' WHEN pos = 2 THEN concat('ds_', CAST(c_custkey AS STRING))
  WHEN pos = 7 AND c_custkey % 13 = 0 THEN 'DS_OTHER' WHEN pos = 7 THEN concat('ds_', CAST(c_custkey AS STRING)) ELSE 'some_value' END AS value
FROM {_each(engine, 'customer', SPEC_LIST, 'label')}"""


def _fx_w(engine: str) -> str:
    return f"""
SELECT concat('DS_', CAST(c_custkey AS STRING)) AS dataset_id, 'Domain-0-Transformation' AS stage, table_name,
 CASE WHEN c_custkey % 2 = 0 THEN TIMESTAMP '2025-01-10 00:00:00' ELSE TIMESTAMP '2025-01-11 06:30:00' END AS last_ts
FROM {_each(engine, 'customer', ('t1', 't2'), 'table_name', first=0)}
WHERE c_custkey % 3 <> 0 AND (pos = 0 OR c_custkey % 4 <> 0)"""


def _fx_w_all(engine: str) -> str:
    """Stored watermarks of all customers, first runs included."""
    return f"""
SELECT concat('DS_', CAST(c_custkey AS STRING)) AS dataset_id, 'Domain-0-Transformation' AS stage, table_name,
 CASE WHEN c_custkey % 2 = 0 THEN TIMESTAMP '2025-01-10 00:00:00' ELSE TIMESTAMP '2025-01-11 06:30:00' END AS last_ts
FROM {_each(engine, 'customer', ('t1', 't2'), 'table_name', first=0)}"""


def _fx_marks(engine: str) -> str:
    """Watermarks of the event tables; 'purchase' has none."""
    return """
SELECT table_name, last_ts FROM (VALUES ('click', TIMESTAMP '2024-01-20 00:00:00'),
 ('view', TIMESTAMP '2024-01-25 12:00:00'), ('error', TIMESTAMP '2024-01-29 00:00:00'),
 ('signup', TIMESTAMP '2023-12-31 00:00:00')) AS w(table_name, last_ts)"""


def _fx_line_mark(engine: str) -> str:
    return "SELECT 'lineitem' AS table_name, TIMESTAMP '1999-01-01 00:00:00' AS last_ts"


def _fx_l(engine: str) -> str:
    return """
SELECT concat('e', CAST(event_id AS STRING)) AS event_load_id,
 concat('p', CAST(user_id AS STRING), '-', CAST(CAST(ts AS DATE) AS STRING)) AS process_load_id,
 concat('DS_', CAST(user_id % 10 AS STRING)) AS dataset_id, event_type AS event_name,
 CAST(floor(value) AS INT) AS event_duration, ts AS event_start_datetime, ts AS event_end_datetime,
 CASE WHEN event_type = 'error' THEN 'FAILED' ELSE 'SUCCESS' END AS event_status,
 CASE WHEN event_type = 'error' THEN concat('boom ', CAST(event_id AS STRING)) END AS event_message,
 CAST(event_id % 100 AS BIGINT) AS record_count
FROM events"""


def _fx_k_target(engine: str) -> str:
    return """
SELECT c_custkey, concat('DS_', CAST(c_nationkey AS STRING)) AS dataset_id, concat('S', CAST(c_custkey % 2 AS STRING)) AS stage,
 c_acctbal, c_mktsegment, CAST(c_custkey AS STRING) AS last_run_time FROM customer"""


def _fx_k_incoming(engine: str) -> str:
    """All customers with an order, every tenth under a new key; the last five datasets stay untouched."""
    return """
SELECT CASE WHEN o_custkey % 10 = 0 THEN o_custkey + 100000000 ELSE o_custkey END AS c_custkey,
 concat('DS_', CAST(o_custkey % 20 AS STRING)) AS dataset_id, concat('S', CAST(o_custkey % 2 AS STRING)) AS stage,
 CASE WHEN o_custkey % 10 = 0 THEN NULL ELSE max(o_totalprice) END AS c_acctbal, 'NEW' AS c_mktsegment, CAST(NULL AS STRING) AS last_run_time
FROM orders GROUP BY o_custkey"""


def _fx_j_config(engine: str) -> str:
    """Configured datasets; some share their name with an incoming one."""
    return """
SELECT concat('DS_', CAST(c_custkey AS STRING)) AS dataset_id,
 concat('Name ', CAST(c_custkey % 1000 AS STRING)) AS dataset_name FROM customer"""


def _fx_j_incoming(engine: str) -> str:
    """A dataset for each customer with an order; every fifth is new."""
    return """
SELECT DISTINCT concat('DS_', CAST(CASE WHEN o_custkey % 5 = 0 THEN o_custkey + 100000000 ELSE o_custkey END AS STRING)) AS dataset_id,
 concat(CASE WHEN o_custkey % 10 = 0 THEN 'Own ' ELSE 'Name ' END,
  CAST(CASE WHEN o_custkey % 7 = 0 THEN o_custkey + 1 ELSE o_custkey END % 1000 AS STRING)) AS dataset_name
FROM orders"""


def _fx_a(engine: str) -> str:
    """Configured schedules with earlier run times, for the due report."""
    return """
SELECT concat('DS_', CAST(c_custkey AS STRING)) AS dataset_id, c_custkey % 13 <> 0 AS is_enabled,
 CASE WHEN c_custkey % 3 = 0 THEN 'DAILY' WHEN c_custkey % 3 = 1 THEN 'WEEKLY' ELSE 'MONTHLY' END AS schedule,
 CASE WHEN c_custkey % 3 = 1 THEN CASE WHEN c_custkey % 5 = 0 THEN 'Friday' WHEN c_custkey % 5 = 1 THEN 'sunday,Thursday' ELSE 'Monday, wednesday' END END AS week_days,
 CASE WHEN c_custkey % 3 = 2 THEN CASE WHEN c_custkey % 4 = 0 THEN '31' WHEN c_custkey % 4 = 1 THEN '1, 15, 31' WHEN c_custkey % 4 = 2 THEN '30, 29' ELSE '28' END END AS dates_of_month,
 CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE TIMESTAMP '2025-01-20 02:00:00' END AS last_run_time,
 CASE WHEN c_custkey % 7 = 0 OR c_custkey % 11 = 0 THEN NULL WHEN c_custkey % 2 = 0 THEN TIMESTAMP '2025-01-30 02:00:00' ELSE TIMESTAMP '2025-02-10 02:00:00' END AS next_run_due_time
FROM customer"""


def _fx_r_config(engine: str) -> str:
    """The schedules of the due report, with their stage."""
    return f"SELECT *, 'S' AS stage FROM ({_fx_a(engine)}) q"


def _fx_r_states(engine: str) -> str:
    """Latest runs: none, at work, done or failed."""
    return """
SELECT concat('DS_', CAST(c_custkey AS STRING)) AS dataset_id, 'S' AS stage, 'r1' AS run_id,
 CASE WHEN c_custkey % 4 = 1 THEN 'RUNNING' WHEN c_custkey % 4 = 2 THEN 'DONE' ELSE 'FAILED' END AS state,
 CASE WHEN c_custkey % 8 = 1 THEN TIMESTAMP '2025-01-30 02:00:00' ELSE TIMESTAMP '2025-02-27 23:30:00' END AS started,
 CASE WHEN c_custkey % 4 = 1 THEN NULL ELSE TIMESTAMP '2025-02-28 01:00:00' END AS finished
FROM customer WHERE c_custkey % 4 <> 0"""


def _fx_r_events(engine: str) -> str:
    """One event for nearly every dataset, some of other runs, some that came before."""
    return """
SELECT concat('DS_', CAST(c_custkey AS STRING)) AS dataset_id, 'S' AS stage,
 CASE WHEN c_custkey % 5 = 0 THEN 'r2' ELSE 'r1' END AS run_id,
 CASE WHEN c_custkey % 3 = 0 THEN 'START' WHEN c_custkey % 17 = 0 THEN 'FAIL' ELSE 'FINISH' END AS action,
 TIMESTAMP '2025-03-01 04:00:00' AS at
FROM customer WHERE c_custkey % 19 <> 0"""


_FIXTURES = {
    "fx_c": _fx_c, "fx_p": _fx_p, "fx_i": _fx_i, "fx_t": _fx_t, "fx_s": _fx_s, "fx_w": _fx_w,
    "fx_marks": _fx_marks, "fx_line_mark": _fx_line_mark, "fx_l": _fx_l, "fx_k_target": _fx_k_target, "fx_k_incoming": _fx_k_incoming,
    "fx_j_config": _fx_j_config, "fx_j_incoming": _fx_j_incoming, "fx_a": _fx_a,
    "fx_w_all": _fx_w_all, "fx_r_config": _fx_r_config, "fx_r_states": _fx_r_states, "fx_r_events": _fx_r_events,
}
_TABLES = {
    "fx_p": "customer", "fx_i": "orders", "fx_t": "customer", "fx_s": "customer", "fx_w": "customer",
    "fx_l": "events", "fx_k_target": "customer", "fx_k_incoming": "orders",
    "fx_j_config": "customer", "fx_j_incoming": "orders", "fx_a": "customer",
    "fx_w_all": "customer", "fx_r_config": "customer", "fx_r_states": "customer", "fx_r_events": "customer",
}


def sql(name: str) -> str:
    """The fixture as DuckDB text."""
    return _FIXTURES[name]("duckdb").strip()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def frame(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The fixture as a DataFrame over the parquet tables of ``sf_dir``."""
    if name in _TABLES:
        table(spark, sf_dir, _TABLES[name]).createOrReplaceTempView(_TABLES[name])
    return spark.sql(_FIXTURES[name]("spark"))
