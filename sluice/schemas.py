"""Fixed schemas and key lists of the control and log tables."""

from __future__ import annotations

from pyspark.sql import types as T

_S, _B, _TS, _L, _I = T.StringType(), T.BooleanType(), T.TimestampType(), T.LongType(), T.IntegerType()


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, dtype, True) for name, dtype in fields])


# Column names, types and order of the four tables.
DATASET_CONFIG = _struct(
    ("dataset_id", _S),
    ("dataset_name", _S),
    ("source_database_name", _S),
    ("load_type", _S),
    ("is_enabled", _B),
    ("pet_dataset_id", _S),
    ("incremental_timestamp_method", _S),
    ("incremental_timestamp_field", _S),
    ("incremental_header_to_tables_link_field", _S),
    ("schedule", _S),
    ("week_days", _S),
    ("dates_of_month", _S),
    ("dataset_owner", _S),
    ("modified_date", _TS),
    ("dataset_modified_by_user", _S),
    ("last_run_time", _TS),
    ("next_run_due_time", _TS),
    ("last_process_datetime", T.MapType(_S, _TS, True)),
    ("stage", _S),
    ("comments", _S),
)

INPUT_FIELDS = _struct(
    ("field_id", _L),
    ("dataset_id", _S),
    ("database_name", _S),
    ("table_name", _S),
    ("field_name", _S),
    ("stage", _S),
    ("comments", _S),
)

PROCESS_LOG = _struct(
    ("process_load_id", _S),
    ("dataset_id", _S),
    ("source_database_name", _S),
    ("target_file_name", _S),
    ("status", _S),
    ("load_type", _S),
    ("start_timestamp", _TS),
    ("end_timestamp", _TS),
    ("last_process_timestamp", _TS),
    ("job_run_duration", _S),
    ("error_message", _S),
    ("record_count", _L),
)

EVENT_LOG = _struct(
    ("event_load_id", _S),
    ("process_load_id", _S),
    ("dataset_id", _S),
    ("event_name", _S),
    ("event_duration", _I),
    ("event_start_datetime", _TS),
    ("event_end_datetime", _TS),
    ("event_status", _S),
    ("event_message", _S),
    ("record_count", _L),
)

# The state of each scope's latest run; a table of this engine.
RUN_STATE = _struct(
    ("dataset_id", _S),
    ("stage", _S),
    ("run_id", _S),
    ("state", _S),
    ("started", _TS),
    ("finished", _TS),
)

# Columns the table definitions declare NOT NULL. load_type is left out:
# a provisioning dataset has none.
CONFIG_REQUIRED = (
    "dataset_id", "dataset_name", "source_database_name", "is_enabled", "pet_dataset_id",
    "dataset_owner", "modified_date", "dataset_modified_by_user", "stage",
)
FIELDS_REQUIRED = ("dataset_id", "database_name", "table_name", "field_name", "stage")

SCOPE = ("dataset_id", "stage")
RUN_TIMES = ("last_run_time", "next_run_due_time")

VIOLATION = _struct(("dataset_id", _S), ("rule_no", _I), ("row_no", _L), ("rule", _S), ("message", _S))

# Sheet names and sheet labels.
SPEC_SHEET, FIELD_SHEET, PARAM_SHEET = "Specification", "Input Schema", "DPS-CDP Params"
REQUIRED_SHEETS = (PARAM_SHEET, FIELD_SHEET, SPEC_SHEET)
FIELD_HEADERS = ("Database Name", "Table Name", "Column Name")
SPEC_LABELS = (
    "Source Tenant", "Dataset Name", "Data Sharing Agreement (DSA)", "Purpose",
    "Privacy Domain - Encryption Key", "Destination Tenant", "ExternalID",
    "Allow Missing Table", "Priority", "Policy",
)
PARAM_KEYS = (
    "Stage", "Pet Dataset ID", "Load Type", "Is Enabled", "Database Name",
    "Incremental Timestamp Method", "Incremental Timestamp Field",
    "Incremental Header To Tables Link Field", "Schedule", "Week Days", "Dates Of Month",
    "Start Process From Date", "Dataset Owner", "Comments",
)
SPEC_KEYS = ("Dataset Name", "ExternalID")

# Accepted parameter texts, all in normalised (upper) form.
PROVISIONING = "DATA-PROVISIONING"
INCREMENTAL, FULL = "INCREMENTAL", "FULL"
HEADER_METHOD, DATA_METHOD = "TIMESTAMP_HEADER_TABLE", "TIMESTAMP_DATA_TABLE"
SCHEDULES = ("DAILY", "WEEKLY", "MONTHLY")
TRUE_WORDS = ("true", "1", "yes", "y")
WEEK_DAYS = ("Sunday", "Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday")


def column_of(key: str) -> str:
    """Column name of a sheet key: 'Pet Dataset ID' -> 'pet_dataset_id'."""
    return "_".join(key.lower().split())
