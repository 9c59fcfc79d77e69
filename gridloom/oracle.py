"""SQL of the views that the registered queries start from, for a second engine to check against."""

from __future__ import annotations

from .sources.observations import CONFIDENCES, DOMAIN_OF_TYPE, METRIC_TYPES, SCALES, SHEET_NAMES, UNITS


def _list(values: list) -> str:
    return "[" + ", ".join(f"'{v}'" if isinstance(v, str) else f"CAST({v} AS DOUBLE)" for v in values) + "]"


def md5_16(*parts: str) -> str:
    return "left(md5(" + " || '|' || ".join(f"CAST({p} AS VARCHAR)" for p in parts) + "), 16)"


_BASIS = "CASE WHEN l_linestatus = 'O' THEN 'So bo' ELSE 'Uoc tinh' END"
_DOMAIN = "CASE p_type " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in DOMAIN_OF_TYPE.items()) + " END"
_HEADER = f"""CASE l_orderkey % 7
    WHEN 0 THEN {_BASIS} || ' / thang ' || lpad(CAST(month(l_shipdate) AS VARCHAR), 2, '0') || ' / nam ' || CAST(year(l_shipdate) AS VARCHAR)
    WHEN 1 THEN {_BASIS} || ' / ' || CAST(month(l_shipdate) AS VARCHAR) || ' thang / nam ' || CAST(year(l_shipdate) AS VARCHAR)
    WHEN 2 THEN 'Quy ' || ['I', 'II', 'III', 'IV'][quarter(l_shipdate)] || ' / nam ' || CAST(year(l_shipdate) AS VARCHAR)
    WHEN 3 THEN {_BASIS} || ' / nam ' || CAST(year(l_shipdate) AS VARCHAR)
    WHEN 5 THEN 'thang ' || lpad(CAST(month(l_shipdate) AS VARCHAR), 2, '0') || ' so voi cung ky nam truoc'
    ELSE {_BASIS} || ' / nam' END"""

FX = f"""fx AS (
  SELECT *, coalesce(extraction_confidence <= 0.70, NULL) AS needs_review,
    CASE WHEN l_orderkey % 101 <> 0 THEN CASE WHEN l_returnflag = 'A' THEN l_quantity WHEN regexp_matches(metric_type, 'growth|index') THEN 100 + l_discount * 100 ELSE l_extendedprice END END AS value_numeric
  FROM (SELECT CASE WHEN l_orderkey % 97 <> 0 THEN {md5_16('l_orderkey')} END AS sheet_report_id, {md5_16('l_orderkey', 'l_linenumber')} AS indicator_observation_id,
    {md5_16('l_suppkey')} AS report_id, {md5_16('l_suppkey', 'l_orderkey % 3')} AS attachment_id, left(md5(CAST(l_orderkey AS VARCHAR) || '|table|1'), 16) AS table_id,
    CAST(l_linenumber AS INTEGER) AS source_row_index, CAST(l_partkey % 20 AS INTEGER) AS source_column_index, CAST(year(l_shipdate) AS INTEGER) AS report_year,
    CASE WHEN l_linenumber <> 3 THEN CAST(month(l_shipdate) AS INTEGER) END AS report_month, CASE WHEN l_linenumber = 3 THEN CAST(quarter(l_shipdate) AS INTEGER) END AS report_quarter,
    CASE l_linenumber WHEN 1 THEN 'annual' WHEN 3 THEN 'quarterly' ELSE 'monthly' END AS period_type,
    CAST(date_trunc('month', l_shipdate) AS DATE) AS period_start_date, CAST(last_day(CAST(l_shipdate AS DATE)) AS DATE) AS period_end_date,
    CASE l_linenumber WHEN 1 THEN 'annual' WHEN 3 THEN 'quarterly' ELSE 'monthly_single_month' END AS sub_category,
    {_DOMAIN} AS indicator_domain, CASE WHEN p_type = 'PROMO' THEN CASE WHEN l_returnflag = 'R' THEN 'exports' ELSE 'imports' END ELSE lower(p_type) END AS indicator_subdomain,
    p_name AS indicator_name_raw, lower(trim(p_name)) AS indicator_name_normalized,
    CASE WHEN l_orderkey % 7 = 4 THEN 'column_' || CAST(l_linenumber AS VARCHAR) ELSE {_HEADER} || CASE l_returnflag WHEN 'A' THEN ' / Luong' WHEN 'R' THEN ' / Tri gia' ELSE '' END END AS metric_name_raw,
    {_list(METRIC_TYPES)}[l_partkey % 7 + 1] AS metric_type, {_list(UNITS)}[l_suppkey % 5 + 1] AS unit_raw, {_list(SCALES)}[l_suppkey % 5 + 1] AS scale,
    CASE WHEN regexp_matches({_list(UNITS)}[l_suppkey % 5 + 1], '(?i)usd') AND (l_orderkey * 7 + l_linenumber) % 100 <> 0 THEN 'USD' END AS currency,
    l_returnflag AS value_text, CASE WHEN l_partkey % 11 <> 0 THEN n_name END AS geography_raw, CASE WHEN l_suppkey % 7 <> 0 THEN p_type END AS sector_raw, CASE WHEN l_orderkey % 5 <> 0 THEN p_brand END AS product_raw,
    'rule' AS extraction_method, {_list(CONFIDENCES)}[l_orderkey % 5 + 1] AS extraction_confidence, 'file_' || CAST(l_suppkey AS VARCHAR) || '.xlsx' AS source_filename,
    {_list(SHEET_NAMES)}[l_orderkey % {len(SHEET_NAMES)} + 1] AS source_sheet_name, l_shipdate AS extracted_timestamp, l_partkey AS part_key, l_orderkey, l_returnflag, l_quantity, l_discount, l_extendedprice
    FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey))"""

REPORTS = f"""reports AS (SELECT {md5_16('s_suppkey')} AS report_id, 'https://archive.example/report/' || CAST(s_suppkey AS VARCHAR) AS report_url, s_name AS title_raw, CAST(2000 + s_suppkey % 5 AS INTEGER) AS report_year,
  CASE s_suppkey % 3 WHEN 0 THEN 'annual' WHEN 1 THEN 'quarterly' ELSE 'monthly_single_month' END AS sub_category, CAST(DATE '2001-01-01' + CAST(s_suppkey % 300 AS INTEGER) AS DATE) AS published_date FROM supplier)"""

ATTACHMENTS = f"""attachments AS (SELECT {md5_16('s_suppkey', 'n')} AS attachment_id, {md5_16('s_suppkey')} AS report_id, s_suppkey, n,
  CASE (s_suppkey + n) % 4 WHEN 0 THEN 'pdf' WHEN 1 THEN 'xls' ELSE 'xlsx' END AS attachment_type, CASE (s_suppkey + n) % 4 WHEN 0 THEN 'pdf_attachment' ELSE 'statistical_tables' END AS attachment_role
  FROM supplier, (VALUES (0), (1), (2)) AS k(n))"""

LOG = """log AS (SELECT attachment_id, report_id, attachment_type, attachment_role, 'success' AS download_status,
  ['success', 'pending', 'failed', 'success'][(s_suppkey * 3 + n) % 4 + 1] AS parse_status, ['success', 'pending', 'success', 'failed', 'pending'][(s_suppkey * 3 + n) % 5 + 1] AS extraction_status
  FROM attachments WHERE (s_suppkey * 3 + n) % 10 <> 0)"""

DIM_INDICATOR = """di AS (SELECT * EXCLUDE (rn, row_count) FROM (SELECT *, row_number() OVER (PARTITION BY indicator_name_normalized, indicator_domain, indicator_subdomain
  ORDER BY row_count DESC, indicator_name_raw NULLS FIRST, preferred_unit NULLS FIRST, preferred_scale NULLS FIRST) AS rn
  FROM (SELECT indicator_name_raw, indicator_name_normalized, indicator_domain, indicator_subdomain, unit_raw AS preferred_unit, scale AS preferred_scale, count(*) AS row_count FROM fx WHERE indicator_name_raw IS NOT NULL GROUP BY ALL)) WHERE rn = 1)"""

DIM_UNIT = """du AS (SELECT * EXCLUDE (rn, n) FROM (SELECT *, row_number() OVER (PARTITION BY unit_normalized ORDER BY n DESC, scale NULLS FIRST, unit_raw) AS rn
  FROM (SELECT unit_raw, lower(trim(unit_raw)) AS unit_normalized, scale, CASE scale WHEN 'thousand' THEN 1e3 WHEN 'million' THEN 1e6 WHEN 'billion' THEN 1e9 WHEN 'trillion' THEN 1e12 ELSE 1e0 END AS multiplier_to_base, count(*) AS n FROM fx WHERE unit_raw IS NOT NULL GROUP BY ALL)) WHERE rn = 1)"""

DIM_GEOGRAPHY = "dg AS (SELECT min(geography_raw) AS geography_raw, lower(trim(geography_raw)) AS geography_normalized FROM fx WHERE geography_raw IS NOT NULL GROUP BY 2)"

LATEST = """latest AS (SELECT * EXCLUDE rn FROM (SELECT *, row_number() OVER (PARTITION BY indicator_observation_id ORDER BY extracted_timestamp DESC NULLS LAST, report_id NULLS FIRST, attachment_id NULLS FIRST,
  sheet_report_id NULLS FIRST, source_row_index NULLS FIRST, source_column_index NULLS FIRST, part_key) AS rn FROM fx) WHERE rn = 1)"""


def first(pattern: str, name: str = "metric_name_raw") -> str:
    return f"nullif(regexp_extract(lower({name}), '{pattern}', 1), '')"


MONTH, YEAR, MONTHS = first("thang *([0-9]{1,2})([^0-9]|$)"), first("nam *([0-9]{4})"), first("([0-9]{1,2}) *thang")


def like(pattern: str, name: str = "metric_name_raw") -> str:
    return f"regexp_matches({name}, '(?i){pattern}')"


PARTS = f"""CASE WHEN {like('so bo')} THEN 'preliminary' WHEN {like('uoc tinh|uoc thuc hien')} THEN 'estimated' WHEN {like('chinh thuc')} THEN 'final' END AS metric_basis,
  CASE WHEN {like('(^|/) *luong *(/|$)')} THEN 'quantity' WHEN {like('(^|/) *tri gia')} THEN 'value' END AS metric_measure,
  CAST({MONTH} AS INTEGER) AS metric_ref_month, CAST({YEAR} AS INTEGER) AS metric_ref_year,
  CASE WHEN {like('quy *iv')} THEN 4 WHEN {like('quy *iii')} THEN 3 WHEN {like('quy *ii')} THEN 2 WHEN {like('quy *i([^ivx]|$)')} THEN 1 END AS metric_ref_quarter,
  CAST({MONTHS} AS INTEGER) AS metric_cumulative_months,
  CASE WHEN {like('cung ky|nam truoc')} THEN 'yoy' WHEN {like('thang truoc')} THEN 'mom' WHEN {like('ke hoach')} THEN 'vs_plan' END AS metric_comparison,
  CASE WHEN {MONTH} IS NOT NULL THEN 'month' WHEN {MONTHS} = '12' THEN 'year' WHEN {MONTHS} = '1' THEN 'month' WHEN {MONTHS} IS NOT NULL THEN 'ytd_cumulative' WHEN {like('quy *(i|ii|iii|iv)')} THEN 'quarter' WHEN {YEAR} IS NOT NULL THEN 'year' END AS metric_period_grain"""

GROWTH = "CASE WHEN metric_type = 'index_yoy_base100' THEN value_numeric - 100.0 WHEN metric_type IN ('yoy_growth', 'mom_growth') AND (unit_raw = '%' OR value_numeric BETWEEN 20 AND 400) THEN value_numeric - 100.0 END"
ANALYTICAL = "CASE WHEN metric_type IN ('index_yoy_base100', 'yoy_growth') THEN 'Percent change vs same period previous year' WHEN metric_type = 'mom_growth' THEN 'Percent change vs previous month' WHEN metric_type = 'index' THEN 'Index' ELSE coalesce(du.unit_raw, l.unit_raw) END"

CURATED = f"""curated AS (SELECT l.*, r.report_url, r.title_raw AS report_title, r.published_date, coalesce(di.indicator_name_raw, l.indicator_name_raw) AS indicator_name_en, {PARTS.replace('metric_name_raw', 'l.metric_name_raw')},
  coalesce(CAST({YEAR} AS INTEGER), l.report_year) AS metric_ref_year_effective, coalesce(du.unit_raw, l.unit_raw) AS unit_en, coalesce(l.value_numeric * du.multiplier_to_base, l.value_numeric) AS value_numeric_base_scale,
  {GROWTH.replace('unit_raw', 'l.unit_raw')} AS value_growth_pct, {ANALYTICAL} AS analytical_unit, coalesce(dg.geography_raw, l.geography_raw) AS geography_en, CASE WHEN dg.geography_raw IS NOT NULL THEN 'unknown' END AS geography_type,
  (l.needs_review OR l.indicator_name_raw IS NULL OR trim(l.indicator_name_raw) = '' OR l.value_numeric IS NULL OR coalesce(l.extraction_confidence, 1.0) < 0.5 OR l.indicator_domain = 'other_or_unknown') AS review
  FROM latest l LEFT JOIN reports r ON l.report_id = r.report_id
  LEFT JOIN di ON l.indicator_name_normalized IS NOT DISTINCT FROM di.indicator_name_normalized AND l.indicator_domain IS NOT DISTINCT FROM di.indicator_domain AND l.indicator_subdomain IS NOT DISTINCT FROM di.indicator_subdomain
  LEFT JOIN du ON lower(trim(l.unit_raw)) IS NOT DISTINCT FROM du.unit_normalized LEFT JOIN dg ON lower(trim(l.geography_raw)) IS NOT DISTINCT FROM dg.geography_normalized)"""

ALL = ",\n".join([FX, REPORTS, DIM_INDICATOR, DIM_UNIT, DIM_GEOGRAPHY, LATEST, CURATED])


def over_fx(sql: str) -> str:
    return f"WITH {FX}\n{sql}"


def over_curated(sql: str) -> str:
    return f"WITH {ALL}\n{sql}"


def total(condition: str) -> str:
    return f"CAST(sum(CASE WHEN {condition} THEN 1 ELSE 0 END) AS BIGINT)"


def percent(part: str, whole: str, digits: int) -> str:
    return f"round(CAST(100.0 AS DOUBLE) * {part} / nullif({whole}, 0), {digits})"
