"""The tables of the monthly job: columns, types and which of them no row may leave empty."""

from __future__ import annotations

from functools import cache

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from ..operators.upsert import align

PERIOD = "report_year int, report_month int, report_quarter int, period_type string, period_start_date date, period_end_date date"
MAPPING = "mapping_method string, confidence_score double, needs_review boolean"
OBSERVED = (
    "indicator_observation_id string NOT NULL, report_id string NOT NULL, attachment_id string NOT NULL, sheet_report_id string, table_id string, sub_category string, indicator_domain string, indicator_subdomain string, "
    "indicator_name_raw string, indicator_name_normalized string, geography_raw string, sector_raw string, product_raw string, unit_raw string, metric_name_raw string, metric_type string, value_numeric double, value_text string, "
    "currency string, scale string, extraction_method string, extraction_confidence double, needs_review boolean, source_filename string, source_sheet_name string, source_row_index int, source_column_index int, extracted_timestamp timestamp"
)

#: Columns of every table by its name under the job's folder, as Spark's DDL.
TABLES = {
    "reports": f"report_id string NOT NULL, report_url string NOT NULL, title_raw string, category string, sub_category string, {PERIOD}, period_months_covered int, reference_period_raw string, published_date date, next_release_date date, source_page int",
    "attachments": "attachment_id string NOT NULL, report_id string NOT NULL, report_url string, attachment_url string NOT NULL, link_label string, attachment_type string, attachment_role string, filename string, file_extension string, file_size_bytes long, content_hash string, local_path string",
    "log": "attachment_id string NOT NULL, report_id string NOT NULL, attachment_type string, attachment_role string, download_status string, download_attempts int, download_error_message string, parse_status string, parse_error_message string, extraction_status string, extraction_rows_inserted long, updated_at timestamp",
    "parsed": "attachment_id string NOT NULL, report_id string NOT NULL, attachment_url string, filename string, sheet_index int NOT NULL, sheet_name_raw string, sheet_name_normalized string, max_row int, max_column int, non_empty_cell_count int, first_non_empty_row int, first_non_empty_column int, raw_cells_json string, merged_ranges_json string, parse_warnings_json string, detected_text_encoding string, parsed_timestamp timestamp",
    "sheets": "sheet_id string NOT NULL, report_id string NOT NULL, attachment_id string NOT NULL, sheet_index int, sheet_name string, table_title_raw string, header_rows array<int>, data_start_row int, data_end_row int, domain string, subdomain string, dimension_strategy string, method string, confidence double, needs_review boolean, parsed_timestamp timestamp",
    "cells": "sheet_id string NOT NULL, report_id string NOT NULL, attachment_id string NOT NULL, sheet_index int, row int, col int, cell_value_clean string, indent int",
    "observations": f"{OBSERVED}, {PERIOD}",
    "sheet_reports": f"sheet_report_id string NOT NULL, report_id string NOT NULL, attachment_id string NOT NULL, sheet_index int NOT NULL, sheet_name_raw string, sheet_name_normalized string, source_filename string, {PERIOD}, indicator_domain string, indicator_subdomain string, table_title_raw string, parse_status string, extraction_status string, observation_count int, needs_review boolean, warnings_json string, created_at timestamp, updated_at timestamp",
    "sheet_log": "sheet_report_id string NOT NULL, report_id string NOT NULL, attachment_id string NOT NULL, sheet_index int NOT NULL, parse_status string, extraction_status string, rows_extracted int, warnings_json string, error_message string, run_timestamp timestamp, updated_at timestamp",
    "dim_indicator": f"indicator_name_raw string, indicator_name_normalized string, indicator_name_en string, indicator_domain string, indicator_subdomain string, preferred_unit string, preferred_scale string, {MAPPING}",
    "dim_geography": f"geography_raw string, geography_normalized string, geography_en string, geography_type string, {MAPPING}",
    "dim_unit": f"unit_raw string, unit_normalized string, unit_en string, scale string, multiplier_to_base double, {MAPPING}",
    "curated": f"{OBSERVED}, {PERIOD}, report_url string, report_title string, published_date date, indicator_name_en string, metric_basis string, metric_measure string, metric_ref_month int, metric_ref_year int, metric_ref_quarter int, metric_cumulative_months int, metric_comparison string, metric_period_grain string, metric_ref_year_effective int, unit_en string, value_numeric_base_scale double, value_growth_pct double, analytical_unit string, geography_en string, geography_type string",
}


@cache
def schema(name: str) -> T.StructType:
    """The columns of a table; Spark reads the DDL, so a session must be there."""
    return T.StructType.fromDDL(TABLES[name])


def required(name: str) -> tuple[str, ...]:
    """The columns of a table in which no row may have a null."""
    return tuple(f.name for f in schema(name) if not f.nullable)


def conform(df: DataFrame, name: str) -> DataFrame:
    """df with the columns of a table: missing ones null, types cast; columns that the table does not name stay, after the others."""
    known = schema(name)
    more = [f for f in df.schema if f.name not in known.names]
    return align(df, T.StructType([*known, *more]))


def misfits(df: DataFrame, name: str) -> dict[str, tuple[str, str]]:
    """Columns of the table that df lacks or has with another type: (type of the table, type found or empty)."""
    found = {f.name: f.dataType.simpleString() for f in df.schema}
    return {f.name: (f.dataType.simpleString(), found.get(f.name, "")) for f in schema(name) if found.get(f.name) != f.dataType.simpleString()}
