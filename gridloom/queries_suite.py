"""The whole assertion suite as a registered query, with SQL for every check."""

from __future__ import annotations

from . import oracle as O
from .operators import checks as K
from .queries import _ALL_NAMES, _NO_YEAR, _OWN_NAME, _bounded, curated, query
from .sources import observations as S

total = O.total


def _share(part: str, whole: str = "count(*)") -> str:
    return f"CAST(100.0 AS DOUBLE) * {part} / {whole}"


def _blank(column: str) -> str:
    return total(f"{column} IS NULL OR trim({column}) = ''")


def _outside(column: str, low: int, high: int) -> str:
    return total(f"{column} NOT BETWEEN {low} AND {high}")


def _unknown(column: str, *known: str) -> str:
    return total(f"{column} NOT IN ({', '.join(repr(k) for k in known)})")


TEXTS = "concat_ws(' ', indicator_name_raw, metric_name_raw, unit_raw, source_sheet_name)"
GROWING = "metric_type IN ('yoy_growth', 'mom_growth')"
MONEY = O.like("usd|vnd", "unit_raw")
MARKS = """'"', '""'"""

#: key, category, value, comparison, threshold, severity.
SUITE = [
    ("rows_present", "structure", "count(*)", ">", 0, "error"),
    ("null_sheet_report_id", "structure", total("sheet_report_id IS NULL"), "==", 0, "error"),
    ("null_report_id", "structure", total("report_id IS NULL"), "==", 0, "error"),
    ("null_indicator_name", "structure", _blank("indicator_name_raw"), "==", 0, "error"),
    ("null_source_file", "structure", total("source_filename IS NULL"), "==", 0, "error"),
    ("replacement_char", "encoding", total(f"contains({TEXTS}, chr(65533))"), "==", 0, "error"),
    ("mojibake_text", "encoding", total("regexp_matches(concat_ws(' ', indicator_name_raw, unit_raw), 'Ã¢|Ã' || chr(173) || '|Ä‘|áº')"), "==", 0, "error"),
    ("tcvn3_garbled", "encoding", total("regexp_matches(indicator_name_raw, '[¸¨£µ¬®Ç×Ð]')"), "<=", 500, "warn"),
    ("control_chars", "encoding", total("regexp_matches(indicator_name_raw, '[\\x01-\\x08]')"), "==", 0, "error"),
    ("min_year_sane", "coverage", "min(report_year)", ">=", 1995, "error"),
    ("max_year_recent", "coverage", "max(report_year)", ">=", 2024, "error"),
    *[(f"rows_{y}", "coverage", total(f"report_year = {y}"), ">", 0, "error") for y in (2023, 2024, 2025, 2026)],
    ("null_report_year", "coverage", total("report_year IS NULL"), "==", 0, "error"),
    ("report_month_range", "period", _outside("report_month", 1, 12), "==", 0, "error"),
    ("report_quarter_range", "period", _outside("report_quarter", 1, 4), "==", 0, "error"),
    ("period_order", "period", total("period_end_date < period_start_date"), "==", 0, "error"),
    ("period_end_year_matches", "period", total("year(period_end_date) <> report_year"), "==", 0, "error"),
    ("monthly_has_month", "period", total("starts_with(period_type, 'monthly') AND report_month IS NULL"), "==", 0, "error"),
    ("period_type_present", "period", _blank("period_type"), "==", 0, "error"),
    ("month5_not_dominant", "period", _share(total("report_month = 5"), "nullif(count(report_month), 0)"), "<=", 30, "error"),
    ("value_present_pct", "values", _share("count(value_numeric)"), ">=", 60, "error"),
    ("value_finite", "values", total("NOT isfinite(value_numeric)"), "==", 0, "error"),
    ("value_magnitude", "values", total("abs(value_numeric) > 1e13"), "==", 0, "error"),
    ("zero_share", "values", _share(total("value_numeric = 0"), "nullif(count(value_numeric), 0)"), "<=", 40, "warn"),
    ("negative_quantity", "values", total("metric_measure = 'quantity' AND value_numeric < 0"), "<=", 50, "warn"),
    ("base_scale_present", "values", total("value_numeric IS NOT NULL AND value_numeric_base_scale IS NULL"), "==", 0, "error"),
    ("index_value_band", "values", total("metric_type IN ('index', 'index_yoy_base100') AND (value_numeric < 0 OR value_numeric > 100000)"), "==", 0, "error"),
    ("unit_null_pct", "units", _share(total("unit_raw IS NULL")), "<=", 60, "warn"),
    ("quantity_currency_unit", "units", total(f"metric_measure = 'quantity' AND {MONEY}"), "==", 0, "error"),
    ("analytical_unit_present", "units", total("unit_raw IS NOT NULL AND analytical_unit IS NULL"), "==", 0, "error"),
    ("pct_unit_sanity", "units", total("unit_raw = '%' AND abs(value_numeric) > 100000"), "==", 0, "error"),
    ("currency_consistency", "units", total(f"{MONEY} AND currency IS NULL"), "==", 0, "error"),
    ("metric_month_range", "metric", _outside("metric_ref_month", 1, 12), "==", 0, "error"),
    ("metric_quarter_range", "metric", _outside("metric_ref_quarter", 1, 4), "==", 0, "error"),
    ("metric_cum_range", "metric", _outside("metric_cumulative_months", 1, 12), "==", 0, "error"),
    ("metric_year_range", "metric", _outside("metric_ref_year", 1990, 2035), "==", 0, "error"),
    ("metric_year_missing", "metric", total(_NO_YEAR), "==", 0, "error"),
    ("metric_measure_domain", "metric", _unknown("metric_measure", "quantity", "value"), "==", 0, "error"),
    ("metric_basis_domain", "metric", _unknown("metric_basis", "preliminary", "estimated", "final"), "==", 0, "error"),
    ("metric_grain_domain", "metric", _unknown("metric_period_grain", "month", "quarter", "ytd_cumulative", "year"), "==", 0, "error"),
    ("grain_null_pct", "metric", _share(total("metric_period_grain IS NULL")), "<=", 60, "warn"),
    ("grain_month_consistency", "grain", total("metric_period_grain = 'month' AND metric_ref_month IS NULL AND metric_cumulative_months IS NULL"), "==", 0, "error"),
    ("grain_quarter_consistency", "grain", total("metric_period_grain = 'quarter' AND metric_ref_quarter IS NULL"), "==", 0, "error"),
    ("grain_ytd_consistency", "grain", total("metric_period_grain = 'ytd_cumulative' AND metric_cumulative_months IS NULL"), "==", 0, "error"),
    ("grain_year_consistency", "grain", total("metric_period_grain = 'year' AND (metric_ref_month IS NOT NULL OR metric_ref_quarter IS NOT NULL)"), "==", 0, "error"),
    ("unconverted_growth", "growth", total(f"{GROWING} AND value_growth_pct = value_numeric"), "==", 0, "error"),
    ("growth_conversion_valid", "growth", total("metric_type IN ('index_yoy_base100', 'yoy_growth', 'mom_growth') AND abs(value_growth_pct - (value_numeric - 100.0)) > 0.000001"), "==", 0, "error"),
    ("growth_band", "growth", total("abs(value_growth_pct) > 10000"), "==", 0, "error"),
    ("comparison_vocabulary", "growth", _unknown("metric_comparison", "yoy", "mom", "vs_plan"), "==", 0, "error"),
    ("subdomain_present", "classification", total("indicator_subdomain IS NULL"), "==", 0, "error"),
    ("confidence_present", "classification", total("extraction_confidence IS NULL"), "==", 0, "error"),
    ("confidence_range", "classification", total("extraction_confidence < 0 OR extraction_confidence > 1"), "==", 0, "error"),
    ("placeholder_metric_pct", "classification", _share(total("regexp_matches(metric_name_raw, '^column_')")), "<=", 15, "warn"),
    ("normalized_name_present", "dimensions", _blank("indicator_name_normalized"), "==", 0, "error"),
    ("product_raw_coverage", "dimensions", _share("count(product_raw)"), ">=", 10, "warn"),
    ("sector_raw_coverage", "dimensions", _share("count(sector_raw)"), ">=", 10, "warn"),
    ("any_dimension_coverage", "dimensions", "count(coalesce(geography_raw, sector_raw, product_raw))", ">", 0, "warn"),
    ("dimension_not_ditto", "dimensions", total(f"trim(coalesce(sector_raw, '')) IN ({MARKS}) OR trim(coalesce(product_raw, '')) IN ({MARKS})"), "==", 0, "error"),
    ("dup_observation_ids", "structure", "count(*) - count(DISTINCT indicator_observation_id)", "==", 0, "error"),
    ("distinct_reports", "structure", "count(DISTINCT report_id)", ">", 1, "error"),
    ("distinct_sheets", "structure", "count(DISTINCT sheet_report_id)", ">", 1, "error"),
    ("year_span", "coverage", "count(DISTINCT report_year)", ">=", 5, "error"),
    ("year_gaps", "coverage", "max(report_year) - min(report_year) + 1 - count(DISTINCT report_year)", "==", 0, "warn"),
    ("value_not_constant", "values", "count(DISTINCT value_numeric)", ">", 10, "error"),
    ("unit_cardinality", "units", "count(DISTINCT unit_raw)", "<=", 400, "warn"),
    ("misfiled_from_other_domain", "classification", total(f"{_OWN_NAME} = 0 AND {_ALL_NAMES} = 1"), "<=", 2000, "error"),
]
#: The dimension that a domain should fill; all others should fill any.
FILLED = {"product_raw_coverage": ["agriculture_forestry_fishery", "industry", "trade_prices"], "sector_raw_coverage": ["investment_construction", "retail_services_tourism", "national_accounts", "transport_post_telecom"]}


def _rows(key: str, category: str, value: str, op: str, threshold: float, severity: str, source: str = "named GROUP BY indicator_domain", having: str = "") -> str:
    compare = "=" if op == "==" else op
    return f"SELECT indicator_domain, '{key}' AS key, '{category}' AS category, CAST({value} AS DOUBLE) AS value, '{op}' AS op, CAST({threshold} AS DOUBLE) AS threshold, '{severity}' AS severity, coalesce(CAST({value} AS DOUBLE) {compare} {threshold}, false) AS passed FROM {source}{having}"


def _having(key: str) -> str:
    quoted = lambda names: ", ".join(f"'{n}'" for n in names)
    if key in FILLED:
        return f" HAVING indicator_domain IN ({quoted(FILLED[key])})"
    return f" HAVING indicator_domain NOT IN ({quoted(sum(FILLED.values(), []))})" if key == "any_dimension_coverage" else ""


GAPS = " UNION ALL ".join(f"SELECT '{d}' AS indicator_domain, count(*) AS gaps FROM (SELECT report_year FROM named WHERE regexp_matches(nm, '{_bounded(p)}') GROUP BY 1 HAVING sum(CASE WHEN indicator_domain = '{d}' THEN 1 ELSE 0 END) = 0)" for d, p in K.SHEET_NAMES.items() if d in S.DOMAIN_OF_TYPE.values())
SQL = f"WITH {O.ALL}, named AS (SELECT *, lower(source_sheet_name) AS nm FROM curated), gaps AS ({GAPS}) " + " UNION ALL ".join([*[_rows(*row, having=_having(row[0])) for row in SUITE], _rows("year_gaps_with_source", "coverage", "gaps", "==", 0, "error", source="gaps")])


@query(SQL)
def check_suite_all(spark, sf_dir):
    return K.run_checks(curated(spark, sf_dir, *K.COLUMNS))
