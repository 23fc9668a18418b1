"""Onboarding of many datasets at once: sheets in, results and control rows out."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice import messages as M
from sluice import schemas as S
from sluice.functions.text import text_or_empty
from sluice.operators import existence, resolve, rules, sheets, watermarks
from sluice.operators.rows import config_rows, input_field_rows
from sluice.operators.skew import existence_join
from sluice.session import cut_lineage, scratch
from sluice.sinks import tables as sinks


@dataclass(frozen=True)
class Sheets:
    """Sheet content of all datasets.

    ``datasets`` is (dataset_id), ``params`` the wide parameters of S3, ``names`` is
    (dataset_id, dataset_name), ``fields`` the cleaned rows of S5.
    """

    datasets: DataFrame
    params: DataFrame
    names: DataFrame
    fields: DataFrame


@dataclass(frozen=True)
class Onboarding:
    violations: DataFrame
    results: DataFrame
    config: DataFrame
    input_fields: DataFrame


def onboard(
    sheet: Sheets, catalog: DataFrame, stored: DataFrame,
    earlier: list[DataFrame] | None = None, calendar: bool = False, stage: Callable[[DataFrame], DataFrame] = cut_lineage,
) -> Onboarding:
    """All checks, one result row per dataset, and control rows of the valid datasets.

    ``stored`` are the watermark rows of the control table, ``earlier`` the violation rows of the
    file and sheet checks. Parameters, fields and declared tables feed many rules each, so they
    are written once by ``stage``; so are the violations, which decide twice. A ``stage`` that returns its argument
    makes one lazy plan of it all.
    """
    params, fields = stage(sheet.params), stage(sheet.fields)
    declared = stage(sheets.declared_tables(fields))
    candidates, starts = sheets.candidate_tables(declared), watermarks.start_dates(params)
    faults = stage(
        rules.union_all(
            [
                rules.check_scalar(params, calendar, required=True),
                existence.check_database_known(params, catalog),
                existence.check_fields(fields, catalog),
                resolve.check_param_fields(params, declared, catalog),
                resolve.check_timestamp_field(params, candidates, catalog),
                watermarks.check_first_run(starts, stored),
                *(earlier or []),
            ]
        )
    )
    results = rules.first_error(faults, sheet.datasets)
    valid = existence_join(sheet.datasets, faults, ["dataset_id"], "left_anti", salts=1)
    good = existence_join(params, valid, ["dataset_id"], "left_semi", salts=1)
    good_fields = existence_join(fields, valid, ["dataset_id"], "left_semi")
    specs = resolve.timestamp_specs(good)
    resolved = resolve.resolve_timestamp_field(specs, candidates, catalog)
    marks = watermarks.build_watermarks(stored, candidates, watermarks.start_dates(good))
    return Onboarding(
        faults, results,
        config_rows(good, sheet.names, resolved, marks),
        input_field_rows(good_fields, good),
    )


def sheets_of(cells: DataFrame, datasets: DataFrame) -> Sheets:
    """Sheet content from cells (dataset_id, sheet, row_no, col_no, value)."""
    spec = sheets.param_columns(sheets.sheet_pairs(cells, S.SPEC_SHEET), S.SPEC_KEYS)
    params = sheets.param_columns(sheets.sheet_pairs(cells, S.PARAM_SHEET))
    fields = sheets.clean_input_fields(
        sheets.input_schema_rows(cells),
        params.select("dataset_id", text_or_empty("database_name").alias("database_name")),
    )
    ids = datasets.select("dataset_id").distinct()
    return Sheets(ids, params, spec.select("dataset_id", "dataset_name"), fields)


def onboard_workbooks(
    spark: SparkSession, cells: DataFrame, datasets: DataFrame, catalog: DataFrame,
    config_table: str, fields_table: str, overwrite: bool = False, calendar: bool = False,
    layout: bool = False, identity: bool = False, unique: bool = False,
) -> DataFrame:
    """The whole job: check all workbooks, write the control rows of the valid ones.

    ``datasets`` is (dataset_id, path). ``cells`` may carry the ``fault`` column of `scan_tagged`: unreadable workbooks
    then fail with their reason. Optional checks: ``layout`` (spec rows), ``identity``
    (ExternalID), ``calendar`` (days and dates), ``unique`` (configured ids are skipped and names
    must be unique). Returns (dataset_id, status, errors, config_written, input_fields_written); only
    what these rows come from stays staged.
    """
    sinks.create_control_table(spark, config_table, S.DATASET_CONFIG)
    sinks.create_control_table(spark, fields_table, S.INPUT_FIELDS)
    skipped = None
    with scratch(spark):
        config = sinks.read_table(spark, config_table)
        cells = cut_lineage(cells)
        earlier = [
            rules.check_file_format(datasets),
            rules.check_readable(datasets),
            rules.check_file_names(datasets),
        ]
        if "fault" in cells.columns:
            earlier.append(rules.check_faults(cells))
            cells = cells.where(F.col("fault").isNull()).drop("fault")
        earlier += [
            rules.check_sheets(cells.select("dataset_id", "sheet"), datasets),
            rules.check_input_sheet(cells, datasets),
        ]
        sheet = sheets_of(cells, datasets)
        if layout:
            # The layout counts rows from the top of the sheet, header row included.
            pairs = sheets.sheet_pairs(cells, S.SPEC_SHEET, header_rows=0)
            earlier.append(rules.check_spec_layout(pairs.withColumnRenamed("key", "label")))
        if identity:
            spec = sheets.param_columns(sheets.sheet_pairs(cells, S.SPEC_SHEET, header_rows=0), S.SPEC_KEYS)
            earlier.append(rules.check_identity(spec))
        if unique:
            named = sheet.datasets.join(sheet.names, "dataset_id", "left").select(
                "dataset_id", F.coalesce("dataset_name", "dataset_id").alias("dataset_name")
            )
            conflicts = cut_lineage(existence.dataset_conflicts(named, config, overwrite), keep=True)
            taken = conflicts.filter("status = 'FAILED'")
            earlier.append(rules.violations(taken, 26, "unique_name", F.col("message")))
            skipped = conflicts.filter("status = 'SKIPPED'").select("dataset_id")
            sheet = Sheets(
                sheet.datasets.join(skipped, "dataset_id", "left_anti"),
                sheet.params.join(skipped, "dataset_id", "left_anti"),
                sheet.names,
                existence_join(sheet.fields, skipped, ["dataset_id"], "left_anti"),
            )
        done = onboard(sheet, catalog, watermarks.watermark_rows(config), earlier, calendar)
        results = cut_lineage(done.results, keep=True)
        new_config, new_fields = cut_lineage(done.config), cut_lineage(done.input_fields)
        # Run times belong to the runs: they stay when a sheet is loaded again, with overwrite or without.
        sinks.commit(spark, [sinks.upserted(config_table, new_config), sinks.input_fields(spark, fields_table, new_fields)])
    written = F.col("status") == "SUCCESS"
    out = results.select(
        "dataset_id", "status", "errors", written.alias("config_written"), written.alias("input_fields_written")
    )
    if skipped is None:
        return out
    none = F.array(F.lit(M.SKIPPED))
    return out.unionByName(
        skipped.select(
            "dataset_id", F.lit("SKIPPED").alias("status"), none.alias("errors"),
            F.lit(False).alias("config_written"), F.lit(False).alias("input_fields_written"),
        )
    )
