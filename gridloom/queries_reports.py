"""Registered queries: the datasets of the dashboard and the sample of a release check, each with its SQL."""

from __future__ import annotations

from . import oracle as O
from .operators import reports as R
from .queries import AS_OF, curated, query
from .sources import observations as S

COUNT = "format('{:,}', count(*))"
DISTINCT = "format('{{:,}}', count(DISTINCT {}))"
ROUNDED = "CAST(round(CAST({} AS DECIMAL(38,6)), 2) AS DOUBLE)"
SHOWN_UNIT = "coalesce(unit_raw, '(no unit)')"


def _lack(condition: str) -> str:
    return O.percent(O.total(condition), "count(*)", 1)


@query(O.over_curated(f"SELECT {COUNT} AS observations, {DISTINCT.format('report_id')} AS reports, {DISTINCT.format('sheet_report_id')} AS sheets, {DISTINCT.format('indicator_name_raw')} AS indicators, CAST(max(period_end_date) AS VARCHAR) AS latest_period, CAST(date_diff('day', max(published_date), DATE '{AS_OF}') AS VARCHAR) AS days_since_publish FROM curated"))
def dashboard_overview(spark, sf_dir):
    return R.dashboard_overview(curated(spark, sf_dir), AS_OF)


@query(O.over_curated("SELECT indicator_domain AS domain, count(*) AS observations, count(DISTINCT indicator_name_raw) AS indicators, count(DISTINCT sheet_report_id) AS sheets FROM curated GROUP BY 1"))
def dashboard_domains(spark, sf_dir):
    return R.dashboard_domains(curated(spark, sf_dir, "indicator_domain", "indicator_name_raw", "sheet_report_id"))


@query(O.over_curated("SELECT report_year, indicator_domain AS domain, count(*) AS observations FROM curated WHERE report_year IS NOT NULL GROUP BY 1, 2"))
def dashboard_timeline(spark, sf_dir):
    return R.dashboard_timeline(curated(spark, sf_dir, "report_year", "indicator_domain"))


@query(O.over_curated("SELECT metric_type, count(*) AS observations FROM curated GROUP BY 1"))
def dashboard_metric_mix(spark, sf_dir):
    return R.dashboard_metric_mix(curated(spark, sf_dir, "metric_type"))


@query(O.over_curated(f"""SELECT indicator_domain AS domain, count(*) AS observations, {_lack('unit_raw IS NULL')} AS pct_no_unit, {_lack("regexp_matches(metric_name_raw, '^column_[0-9]+$')")} AS pct_placeholder_metric, {_lack('geography_raw IS NULL')} AS pct_no_geography,
 {_lack('sector_raw IS NULL')} AS pct_no_sector, {_lack('review')} AS pct_needs_review FROM curated GROUP BY 1"""))
def dashboard_fields(spark, sf_dir):
    return R.dashboard_fields(curated(spark, sf_dir))


@query(f"WITH {O.REPORTS} SELECT report_year, sub_category AS period_type, count(DISTINCT report_id) AS reports FROM reports WHERE report_year IS NOT NULL GROUP BY 1, 2")
def dashboard_reports(spark, sf_dir):
    return R.dashboard_reports(S.reports(spark, sf_dir), "sub_category")


@query(O.over_curated("SELECT period_end_date, period_type, count(*) AS observations FROM curated WHERE period_end_date IS NOT NULL GROUP BY 1, 2"))
def dashboard_periods(spark, sf_dir):
    return R.dashboard_periods(curated(spark, sf_dir, "period_end_date", "period_type"))


@query(O.over_curated(f"SELECT {COUNT} AS observations, {DISTINCT.format('indicator_name_raw')} AS indicators, {DISTINCT.format('sheet_report_id')} AS sheets, min(report_year) || ' - ' || max(report_year) AS year_range FROM curated WHERE indicator_domain = 'industry'"))
def domain_kpis(spark, sf_dir):
    return R.domain_kpis(curated(spark, sf_dir), "industry")


@query(O.over_curated("SELECT report_year, count(*) AS observations, count(DISTINCT indicator_name_raw) AS indicators FROM curated WHERE indicator_domain = 'industry' AND report_year IS NOT NULL GROUP BY 1"))
def domain_coverage(spark, sf_dir):
    return R.domain_coverage(curated(spark, sf_dir), "industry")


@query(O.over_curated(f"SELECT {SHOWN_UNIT} AS unit, metric_type, count(*) AS observations FROM curated WHERE indicator_domain = 'industry' GROUP BY 1, 2"))
def domain_units(spark, sf_dir):
    return R.domain_units(curated(spark, sf_dir), "industry")


@query(O.over_curated(f"""SELECT *, row_number() OVER (ORDER BY observations DESC, indicator NULLS FIRST, metric NULLS FIRST, metric_type NULLS FIRST, unit NULLS FIRST, breakdown NULLS FIRST) AS rn FROM (
 SELECT indicator_name_raw AS indicator, metric_name_raw AS metric, metric_type, {SHOWN_UNIT} AS unit, coalesce(sector_raw, product_raw, geography_raw, '') AS breakdown, count(*) AS observations, {ROUNDED.format('quantile_cont(value_numeric, 0.5)')} AS median_value,
 {ROUNDED.format('min(value_numeric)')} AS min_value, {ROUNDED.format('max(value_numeric)')} AS max_value, CAST(min(period_end_date) AS VARCHAR) AS first_period, CAST(max(period_end_date) AS VARCHAR) AS last_period FROM curated WHERE indicator_domain = 'trade_prices' GROUP BY 1, 2, 3, 4, 5)"""))
def domain_indicators(spark, sf_dir):
    return R.domain_indicators(curated(spark, sf_dir, *R.SERIES_COLUMNS), "trade_prices")


@query(O.over_curated("""SELECT indicator_domain AS domain, indicator_subdomain AS subdomain, indicator_name_raw AS indicator, metric_name_raw AS metric, unit_raw AS unit, metric_type, value_numeric, value_growth_pct, source_sheet_name AS sheet FROM curated
 WHERE value_numeric IS NOT NULL AND report_year = 1996 AND report_month IN (4) AND regexp_matches(lower(trim(source_sheet_name)), '^(iip|cpi|18xk|gdp|5nn|vt|01nn|xd)')
 AND (regexp_matches(lower(indicator_name_raw), 'bolt|blue|widget') OR abs(value_numeric - 105) < 0.01 OR abs(value_numeric - 109) < 0.01)
 ORDER BY indicator_domain NULLS FIRST, source_sheet_name NULLS FIRST, indicator_name_raw NULLS FIRST, metric_name_raw NULLS FIRST, indicator_observation_id LIMIT 60"""))
def recent_numeric_sample(spark, sf_dir):
    return R.recent_numeric_sample(curated(spark, sf_dir), 1996, 4, sheets="^(iip|cpi|18xk|gdp|5nn|vt|01nn|xd)", labels="bolt|blue|widget", values=(105.0, 109.0))
