"""Scalar rules over sheets and parameters; every fault is a row."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice import messages as M
from sluice import schemas as S
from sluice.functions.stamps import parse_start_date
from sluice.functions.text import bracketed, enum, is_blank, message, strip, text_or_empty
from sluice.schemas import column_of

# Required columns that have a value whatever the sheet says.
DEFAULTED = ("is_enabled",)


def violations(
    df: DataFrame, rule_no: int | Column, rule: str | Column, text: Column, row_no: Column | int = 0
) -> DataFrame:
    """Violation rows where ``text`` is not NULL."""
    return df.select(
        "dataset_id",
        F.lit(rule_no).cast("int").alias("rule_no"),
        F.lit(row_no).cast("long").alias("row_no"),
        F.lit(rule).alias("rule"),
        text.alias("message"),
    ).filter(F.col("message").isNotNull())


def fault(rule_no: int, rule: str, text: Column) -> Column:
    """A row-wise rule as a struct; its message is NULL where the rule holds."""
    return F.struct(
        F.lit(rule_no).cast("int").alias("rule_no"), F.lit(rule).alias("rule"), text.alias("message")
    )


def explode_faults(df: DataFrame, faults: list[Column]) -> DataFrame:
    """Violation rows of many row-wise rules in one pass over ``df``."""
    broken = F.filter(F.array(*faults), lambda f: f["message"].isNotNull())
    found = df.select("dataset_id", F.explode(broken).alias("f"))
    return found.select("dataset_id", "f.rule_no", F.lit(0).cast("long").alias("row_no"), "f.rule", "f.message")


def union_all(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


# --- parameters -----------------------------------------------------------------------------


def is_enabled(value: Column | str) -> Column:
    """Only the word FALSE disables; a missing or other value counts as enabled."""
    return enum(value) != "FALSE"


def enabled_only(params: DataFrame) -> DataFrame:
    """P2 as a filter."""
    return params.filter(is_enabled("is_enabled"))


def enabled_fault() -> Column:
    text = F.when(~is_enabled("is_enabled"), message(M.DISABLED, dataset_id=F.col("dataset_id")))
    return fault(30, "enabled", text)


def normalise_enums(params: DataFrame) -> DataFrame:
    """Load type upper, method upper with '-' as '_'; the stage keeps its spelling."""
    return params.withColumns(
        {
            "load_type": enum("load_type"),
            "incremental_timestamp_method": F.replace(
                enum("incremental_timestamp_method"), F.lit("-"), F.lit("_")
            ),
            "stage_key": enum("stage"),
        }
    )


def is_provisioning(stage: Column | str) -> Column:
    return enum(stage) == S.PROVISIONING


def schedule_fault(schedule: Column | str, week_days: Column | str, dates: Column | str) -> Column:
    """Message of the first schedule fault, or NULL. The schedule word is matched exactly."""
    word = strip(schedule)
    word = F.nullif(word, F.lit(""))
    no_days, no_dates = is_blank(week_days), is_blank(dates)
    return (
        F.when(~F.coalesce(word.isin(*S.SCHEDULES), F.lit(False)), message(M.BAD_SCHEDULE, schedule=word))
        .when((word == "DAILY") & ~(no_days & no_dates), M.DAILY_LISTS)
        .when((word == "WEEKLY") & no_days, M.WEEKLY_NO_DAYS)
        .when((word == "WEEKLY") & ~no_dates, M.WEEKLY_DATES)
        .when((word == "MONTHLY") & no_dates, M.MONTHLY_NO_DATES)
        .when((word == "MONTHLY") & ~no_days, M.MONTHLY_DAYS)
    )


def is_active() -> Column:
    """Past the stage check: provisioning datasets skip the load rules. Needs normalised enums."""
    return F.col("stage_key") != S.PROVISIONING


def is_incremental() -> Column:
    return is_active() & (F.col("load_type") == S.INCREMENTAL)


def schedule_rule() -> Column:
    """P8 where it applies: incremental datasets."""
    text = schedule_fault("schedule", "week_days", "dates_of_month")
    return fault(54, "schedule", F.when(is_incremental(), text))


def check_schedule(params: DataFrame) -> DataFrame:
    """P8 for all incremental datasets."""
    return explode_faults(normalise_enums(params), [schedule_rule()])


def calendar_rule() -> Column:
    def capitalised(day: Column) -> Column:
        day = strip(day)
        return F.concat(F.upper(F.substring(day, 1, 1)), F.lower(F.substr(day, F.lit(2))))

    def bad_date(date: Column) -> Column:
        number = F.when(F.rlike(date, F.lit("^[0-9]+$")), date.try_cast("int"))
        return F.coalesce(~number.between(1, 28), F.lit(True))

    days = F.transform(F.split("week_days", ","), capitalised)
    bad_days = F.array_sort(F.array_distinct(F.filter(days, lambda d: ~d.isin(*S.WEEK_DAYS))))
    bad_dates = F.filter(F.transform(F.split("dates_of_month", ","), strip), bad_date)
    day_text = F.when(
        ~is_blank("week_days") & (F.size(bad_days) > 0),
        message(M.BAD_WEEK_DAYS, days=bracketed(bad_days, "{", "}")),
    )
    date_text = F.when(
        ~is_blank("dates_of_month") & (F.size(bad_dates) > 0),
        message(M.BAD_DATES, date=F.get(bad_dates, F.lit(0))),
    )
    return fault(62, "calendar", F.when(is_active(), F.coalesce(day_text, date_text)))


def check_calendar(params: DataFrame) -> DataFrame:
    """Known week days, dates 1 to 28. Optional: the current sheets may list later dates."""
    return explode_faults(normalise_enums(params), [calendar_rule()])


def param_rules() -> list[Column]:
    """P10: required values and their combinations (rules 50-53, 55-57). Needs normalised enums."""
    load, method = F.col("load_type"), F.col("incremental_timestamp_method")
    active = is_active()
    no_field = is_blank("incremental_timestamp_field")
    no_link = is_blank("incremental_header_to_tables_link_field")
    schedule_given = ~(is_blank("schedule") & is_blank("week_days") & is_blank("dates_of_month"))
    full_with_more = active & (load == S.FULL) & (~no_field | schedule_given)
    link_lacks = active & (method == S.HEADER_METHOD) & no_link
    return [
        fault(50, "stage", F.when(F.col("stage_key") == "", M.NO_STAGE)),
        fault(51, "pet_dataset_id", F.when(is_blank("pet_dataset_id"), M.NO_PET_ID)),
        fault(52, "load_type", F.when(active & ~load.isin(S.INCREMENTAL, S.FULL), M.BAD_LOAD_TYPE)),
        fault(53, "timestamp_field", F.when(is_incremental() & no_field, M.NO_TIMESTAMP_FIELD)),
        fault(55, "full_load", F.when(full_with_more, M.FULL_FIELDS)),
        fault(56, "method", F.when(active & ~method.isin(S.HEADER_METHOD, S.DATA_METHOD), M.BAD_METHOD)),
        fault(57, "link_field", F.when(link_lacks, M.NO_LINK)),
    ]


def check_params(params: DataFrame) -> DataFrame:
    """P10, one row per fault."""
    return explode_faults(normalise_enums(params), param_rules())


def start_date_rule() -> Column:
    text = text_or_empty("start_process_from_date")
    bad = is_incremental() & (text != "") & parse_start_date(text).isNull()
    return fault(71, "start_date", F.when(bad, message(M.BAD_START_DATE, text=text)))


def check_start_date(params: DataFrame) -> DataFrame:
    """Rule 71: a start date that is given must parse."""
    return explode_faults(normalise_enums(params), [start_date_rule()])


def database_name_rule() -> Column:
    return fault(31, "database", F.when(is_blank("database_name"), F.lit(M.NO_DATABASE)))


def required_rules() -> list[Column]:
    """Rule 80: parameters that fill a NOT NULL column of the dataset table."""
    source = {"source_database_name": "database_name"}
    keys = [column_of(k) for k in S.PARAM_KEYS]
    given = [(c, source.get(c, c)) for c in S.CONFIG_REQUIRED if source.get(c, c) in keys and c not in DEFAULTED]
    return [fault(80, "not_null", F.when(is_blank(p), message(M.NULL_REQUIRED, column=F.lit(c)))) for c, p in given]


def check_scalar(params: DataFrame, calendar: bool = False, required: bool = False) -> DataFrame:
    """Every rule that needs nothing but the parameters of its own dataset, in one pass.

    ``required`` adds the NOT NULL columns of the dataset table.
    """
    found = [enabled_fault(), database_name_rule(), *param_rules(), schedule_rule(), start_date_rule()]
    if required:
        found += required_rules()
    if calendar:
        found.append(calendar_rule())
    return explode_faults(normalise_enums(params), found)


# --- files and sheets -----------------------------------------------------------------------


def has_workbook_extension(path: Column | str) -> Column:
    path = F.lower(F.col(path) if isinstance(path, str) else path)
    return F.coalesce(F.endswith(path, F.lit(".xlsx")) | F.endswith(path, F.lit(".xls")), F.lit(False))


def check_file_format(files: DataFrame) -> DataFrame:
    """Rule 10 over (dataset_id, path)."""
    text = F.when(~has_workbook_extension("path"), message(M.BAD_EXTENSION, path=F.col("path")))
    return violations(files, 10, "file_format", text)


def check_readable(files: DataFrame) -> DataFrame:
    """Rule 11 over (dataset_id, path): the binary format has the right name and still cannot be read."""
    binary = F.endswith(F.lower("path"), F.lit(".xls"))
    return violations(files, 11, "readable", F.when(binary, message(M.BINARY_XLS, path=F.col("path"))))


def check_faults(tagged: DataFrame) -> DataFrame:
    """Rule 11 over (dataset_id, fault): workbooks that gave a reason instead of cells."""
    found = tagged.where(F.col("fault").isNotNull())
    return violations(found, 11, "readable", message(M.UNREADABLE, reason=F.col("fault")))


def check_file_names(files: DataFrame) -> DataFrame:
    """Rule 12 over (dataset_id, path): one file for each dataset.

    Paths are gathered for datasets with several files only.
    """
    several = files.groupBy("dataset_id").agg(F.min("path").alias("least"), F.max("path").alias("greatest"))
    clashes = several.where(F.col("least") != F.col("greatest")).select("dataset_id")
    paths = files.join(clashes, "dataset_id").groupBy("dataset_id").agg(F.array_sort(F.collect_set("path")).alias("paths"))
    text = message(M.SAME_NAME, dataset_id=F.col("dataset_id"), paths=bracketed(F.col("paths")))
    return violations(paths, 12, "file_name", text)


def check_sheets(sheets: DataFrame, datasets: DataFrame | None = None) -> DataFrame:
    """P5: required sheets minus those present, by exact name.

    One flag per required sheet is aggregated, so a workbook with very many sheets needs no more
    memory. ``datasets`` adds workbooks without any sheet.
    """
    flags = [F.max(F.col("sheet") == s).alias(f"has_{i}") for i, s in enumerate(S.REQUIRED_SHEETS)]
    present = sheets.groupBy("dataset_id").agg(*flags)
    if datasets is not None:
        present = datasets.select("dataset_id").distinct().join(present, "dataset_id", "left")
    absent = [
        F.when(F.coalesce(F.col(f"has_{i}"), F.lit(False)), F.lit(None)).otherwise(F.lit(s))
        for i, s in enumerate(S.REQUIRED_SHEETS)
    ]
    missing = F.array_compact(F.array(*absent))
    text = F.when(F.size(missing) > 0, message(M.MISSING_SHEETS, sheets=bracketed(missing, "{", "}")))
    return violations(present, 20, "required_sheets", text)


def check_spec_layout(spec: DataFrame) -> DataFrame:
    """Rows 1 to 10 of (dataset_id, row_no, label, value) carry the ten labels, each with a value."""
    labels = F.array(*[F.lit(x) for x in S.SPEC_LABELS])
    top = spec.filter(F.col("row_no").between(1, len(S.SPEC_LABELS)))
    expected = F.element_at(labels, F.col("row_no").cast("int"))
    text = (
        F.when(
            ~F.col("label").eqNullSafe(expected),
            message(M.SPEC_LABEL, row=F.col("row_no"), expected=expected, found=F.col("label")),
        ).when(is_blank("value"), message(M.SPEC_VALUE, label=expected, row=F.col("row_no")))
    )
    wrong = violations(top, 25, "spec_layout", text, F.col("row_no"))
    counted = spec.groupBy("dataset_id").agg(
        F.count_if(F.col("row_no").between(1, len(S.SPEC_LABELS))).alias("n")
    )
    few = violations(
        counted, 25, "spec_layout", F.when(F.col("n") < len(S.SPEC_LABELS), message(M.SPEC_ROWS, n=F.col("n")))
    )
    return wrong.unionByName(few)


def check_identity(spec: DataFrame, check_name: bool = False) -> DataFrame:
    """P7 over (dataset_id, externalid, dataset_name): the sheet must name its own dataset."""
    own = F.upper("dataset_id")
    faults = [
        violations(spec, 25, "external_id", F.when(enum("externalid") != own, F.lit(M.ID_MISMATCH)))
    ]
    if check_name:
        faults.append(
            violations(spec, 25, "dataset_name", F.when(enum("dataset_name") != own, F.lit(M.NAME_MISMATCH)))
        )
    return union_all(faults)


def check_input_sheet(cells: DataFrame, datasets: DataFrame) -> DataFrame:
    """Rule 40: the field sheet has data rows, the three headers and at least one filled row."""
    at = (F.col("sheet") == S.FIELD_SHEET) & (F.col("col_no") <= 3)
    header = at & (F.col("row_no") == 1)
    has = [F.max(header & (strip("value") == h)).alias(f"has_{i}") for i, h in enumerate(S.FIELD_HEADERS)]
    in_body = (F.col("sheet") == S.FIELD_SHEET) & (F.col("row_no") > 1)
    facts = cells.groupBy("dataset_id").agg(
        F.max(in_body).alias("any_cell"),
        F.max(at & (F.col("row_no") > 1) & ~is_blank("value")).alias("any_filled"),
        *has,
    )
    f = datasets.select("dataset_id").distinct().join(facts, "dataset_id", "left")
    absent = [
        F.when(F.coalesce(F.col(f"has_{i}"), F.lit(False)), F.lit(None)).otherwise(F.lit(h))
        for i, h in enumerate(S.FIELD_HEADERS)
    ]
    missing = F.array_sort(F.array_compact(F.array(*absent)))
    text = (
        F.when(~F.coalesce(F.col("any_cell"), F.lit(False)), F.lit(M.FIELDS_EMPTY))
        .when(F.size(missing) > 0, message(M.FIELDS_HEADERS, columns=bracketed(missing, "{", "}")))
        .when(~F.col("any_filled"), F.lit(M.FIELDS_NO_ROWS))
    )
    return violations(f, 40, "input_schema", text)


# --- result ---------------------------------------------------------------------------------


def first_error(violation_rows: DataFrame, datasets: DataFrame) -> DataFrame:
    """One row per dataset; the fault with the least (rule_no, row_no) decides.

    Returns (dataset_id, status, errors); errors holds that one message, or nothing.
    """
    worst = violation_rows.groupBy("dataset_id").agg(
        F.min_by("message", F.struct("rule_no", "row_no", "message")).alias("message")
    )
    joined = datasets.select("dataset_id").distinct().join(worst, "dataset_id", "left")
    failed = F.col("message").isNotNull()
    return joined.select(
        "dataset_id",
        F.when(failed, "FAILED").otherwise("SUCCESS").alias("status"),
        F.when(failed, F.array("message")).otherwise(F.array().cast("array<string>")).alias("errors"),
    )
