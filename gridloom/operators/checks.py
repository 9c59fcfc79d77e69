"""The assertion suite: all checks of all domains in a few aggregates by domain."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.bind import let
from ..settle import settled_columns
from .quality import GROWTH, total, year_missing

c = F.col

#: Domains, and the dimension that each should fill; fixed values.
DIMENSION = {
    "agriculture_forestry_fishery": "product_raw", "industry": "product_raw", "trade_prices": "product_raw", "investment_construction": "sector_raw", "retail_services_tourism": "sector_raw",
    "national_accounts": "sector_raw", "transport_post_telecom": "sector_raw", "enterprise_business_registration": None, "population_labor_social": None, "environment_safety_disaster": None, "other_or_unknown": None,
}
#: What a sheet name says about its domain, for the suite; fixed values.
SHEET_NAMES = {
    "trade_prices": r"(?<![a-z])(xk|nk|xnk)|xuat khau|nhap khau|(?<![a-z])cpi",
    "industry": r"(?<![a-z])(iip|spcn|gtcn|ldcn)|cong nghiep",
    "investment_construction": r"(?<![a-z])(vdt|dtnn|fdi|nsnn|xd)|von dau tu|xay dung",
    "transport_post_telecom": r"van ?tai|(?<![a-z])(vt|vthh|vthk)",
    "retail_services_tourism": r"du lich|khach quoc te|(?<![a-z])kqt|tong ?muc|ban le",
    "enterprise_business_registration": r"(?<![a-z])dn|doanh nghiep|giai the",
    "agriculture_forestry_fishery": r"(?<![a-z])nn|nong nghiep|thuy san|lam nghiep",
    "national_accounts": r"(?<![a-z])(gdp|grdp)",
    "population_labor_social": r"lao dong|dan ?so|that nghiep",
    "environment_safety_disaster": r"(?<![a-z])(xhmt|thpt)|moi truong|thien tai|giao duc",
}


@dataclass(frozen=True)
class Check:
    """An aggregate of a domain's rows and the condition on it."""

    key: str
    category: str
    value: Column | None
    op: str
    threshold: float
    severity: str = "error"


def _share(part: Column, whole: Column) -> Column:
    return F.try_divide(F.lit(100.0) * part, whole)


def _set_and(column: str, bad: Column) -> Column:
    return total(c(column).isNotNull() & bad)


def _blank(column: str) -> Column:
    return total(c(column).isNull() | (F.trim(column) == ""))


def plain_checks() -> list[Check]:
    """Checks without distinct counts: one pass, sums that combine on the map side."""
    rows, value = F.count("*"), c("value_numeric")
    garbled = "[" + "¸¨£µ¬®Ç×Ð" + "]"
    infinite = value.isin(float("inf"), float("-inf"))
    outside = lambda column, lo, hi: _set_and(column, ~c(column).between(lo, hi))
    unknown = lambda column, *known: _set_and(column, ~c(column).isin(*known))
    texts = F.concat_ws(" ", "indicator_name_raw", "metric_name_raw", "unit_raw", "source_sheet_name")
    grain, name = c("metric_period_grain"), c("metric_name_raw")
    growth = c("value_growth_pct")
    marks = ['"', '""']
    return [
        Check("rows_present", "structure", rows, ">", 0),
        Check("null_sheet_report_id", "structure", total(c("sheet_report_id").isNull()), "==", 0),
        Check("null_report_id", "structure", total(c("report_id").isNull()), "==", 0),
        Check("null_indicator_name", "structure", _blank("indicator_name_raw"), "==", 0),
        Check("null_source_file", "structure", total(c("source_filename").isNull()), "==", 0),
        Check("replacement_char", "encoding", total(texts.contains("�")), "==", 0),
        Check("mojibake_text", "encoding", total(F.concat_ws(" ", "indicator_name_raw", "unit_raw").rlike("Ã¢|Ã­|Ä‘|áº")), "==", 0),
        Check("tcvn3_garbled", "encoding", total(c("indicator_name_raw").rlike(garbled)), "<=", 500, "warn"),
        Check("control_chars", "encoding", total(c("indicator_name_raw").rlike(r"[\x00-\x08]")), "==", 0),
        Check("min_year_sane", "coverage", F.min("report_year"), ">=", 1995),
        Check("max_year_recent", "coverage", F.max("report_year"), ">=", 2024),
        *[Check(f"rows_{y}", "coverage", total(c("report_year") == y), ">", 0) for y in (2023, 2024, 2025, 2026)],
        Check("null_report_year", "coverage", total(c("report_year").isNull()), "==", 0),
        Check("report_month_range", "period", outside("report_month", 1, 12), "==", 0),
        Check("report_quarter_range", "period", outside("report_quarter", 1, 4), "==", 0),
        Check("period_order", "period", total(c("period_end_date") < c("period_start_date")), "==", 0),
        Check("period_end_year_matches", "period", total(F.year("period_end_date") != c("report_year")), "==", 0),
        Check("monthly_has_month", "period", total(c("period_type").startswith("monthly") & c("report_month").isNull()), "==", 0),
        Check("period_type_present", "period", _blank("period_type"), "==", 0),
        Check("month5_not_dominant", "period", _share(total(c("report_month") == 5), F.nullif(total(c("report_month").isNotNull()), F.lit(0))), "<=", 30),
        Check("value_present_pct", "values", _share(total(value.isNotNull()), rows), ">=", 60),
        Check("value_finite", "values", _set_and("value_numeric", F.isnan(value) | infinite), "==", 0),
        Check("value_magnitude", "values", total(F.abs(value) > 1e13), "==", 0),
        Check("zero_share", "values", _share(total(value == 0), F.nullif(total(value.isNotNull()), F.lit(0))), "<=", 40, "warn"),
        Check("negative_quantity", "values", total((c("metric_measure") == "quantity") & (value < 0)), "<=", 50, "warn"),
        Check("base_scale_present", "values", _set_and("value_numeric", c("value_numeric_base_scale").isNull()), "==", 0),
        Check("index_value_band", "values", total(c("metric_type").isin("index", "index_yoy_base100") & ((value < 0) | (value > 100_000))), "==", 0),
        Check("unit_null_pct", "units", _share(total(c("unit_raw").isNull()), rows), "<=", 60, "warn"),
        Check("quantity_currency_unit", "units", total((c("metric_measure") == "quantity") & c("unit_raw").rlike("(?i)usd|vnd")), "==", 0),
        Check("analytical_unit_present", "units", _set_and("unit_raw", c("analytical_unit").isNull()), "==", 0),
        Check("pct_unit_sanity", "units", total((c("unit_raw") == "%") & (F.abs(value) > 100_000)), "==", 0),
        Check("currency_consistency", "units", total(c("unit_raw").rlike("(?i)usd|vnd") & c("currency").isNull()), "==", 0),
        Check("metric_month_range", "metric", outside("metric_ref_month", 1, 12), "==", 0),
        Check("metric_quarter_range", "metric", outside("metric_ref_quarter", 1, 4), "==", 0),
        Check("metric_cum_range", "metric", outside("metric_cumulative_months", 1, 12), "==", 0),
        Check("metric_year_range", "metric", outside("metric_ref_year", 1990, 2035), "==", 0),
        Check("metric_year_missing", "metric", total(year_missing(name)), "==", 0),
        Check("metric_measure_domain", "metric", unknown("metric_measure", "quantity", "value"), "==", 0),
        Check("metric_basis_domain", "metric", unknown("metric_basis", "preliminary", "estimated", "final"), "==", 0),
        Check("metric_grain_domain", "metric", unknown("metric_period_grain", "month", "quarter", "ytd_cumulative", "year"), "==", 0),
        Check("grain_null_pct", "metric", _share(total(grain.isNull()), rows), "<=", 60, "warn"),
        Check("grain_month_consistency", "grain", total((grain == "month") & c("metric_ref_month").isNull() & c("metric_cumulative_months").isNull()), "==", 0),
        Check("grain_quarter_consistency", "grain", total((grain == "quarter") & c("metric_ref_quarter").isNull()), "==", 0),
        Check("grain_ytd_consistency", "grain", total((grain == "ytd_cumulative") & c("metric_cumulative_months").isNull()), "==", 0),
        Check("grain_year_consistency", "grain", total((grain == "year") & (c("metric_ref_month").isNotNull() | c("metric_ref_quarter").isNotNull())), "==", 0),
        Check("unconverted_growth", "growth", total(c("metric_type").isin(*GROWTH) & (growth == value)), "==", 0),
        Check("growth_conversion_valid", "growth", total(c("metric_type").isin("index_yoy_base100", *GROWTH) & (F.abs(growth - (value - 100.0)) > 1e-6)), "==", 0),
        Check("growth_band", "growth", total(F.abs(growth) > 10_000), "==", 0),
        Check("comparison_vocabulary", "growth", unknown("metric_comparison", "yoy", "mom", "vs_plan"), "==", 0),
        Check("subdomain_present", "classification", total(c("indicator_subdomain").isNull()), "==", 0),
        Check("confidence_present", "classification", total(c("extraction_confidence").isNull()), "==", 0),
        Check("confidence_range", "classification", total((c("extraction_confidence") < 0) | (c("extraction_confidence") > 1)), "==", 0),
        Check("placeholder_metric_pct", "classification", _share(total(name.rlike("^column_")), rows), "<=", 15, "warn"),
        Check("normalized_name_present", "dimensions", _blank("indicator_name_normalized"), "==", 0),
        Check("product_raw_coverage", "dimensions", _share(total(c("product_raw").isNotNull()), rows), ">=", 10, "warn"),
        Check("sector_raw_coverage", "dimensions", _share(total(c("sector_raw").isNotNull()), rows), ">=", 10, "warn"),
        Check("any_dimension_coverage", "dimensions", total(F.coalesce("geography_raw", "sector_raw", "product_raw").isNotNull()), ">", 0, "warn"),
        Check("dimension_not_ditto", "dimensions", total(F.trim(F.coalesce("sector_raw", F.lit(""))).isin(marks) | F.trim(F.coalesce("product_raw", F.lit(""))).isin(marks)), "==", 0),
    ]


def distinct_checks() -> list[Check]:
    """Checks on distinct counts, apart from the others so that only their columns are expanded."""
    years = F.count_distinct("report_year")
    return [
        Check("dup_observation_ids", "structure", F.count("*") - F.count_distinct("indicator_observation_id"), "==", 0),
        Check("distinct_reports", "structure", F.count_distinct("report_id"), ">", 1),
        Check("distinct_sheets", "structure", F.count_distinct("sheet_report_id"), ">", 1),
        Check("year_span", "coverage", years, ">=", 5),
        Check("year_gaps", "coverage", F.max("report_year") - F.min("report_year") + 1 - years, "==", 0, "warn"),
        Check("value_not_constant", "values", F.count_distinct("value_numeric"), ">", 10),
        Check("unit_cardinality", "units", F.count_distinct("unit_raw"), "<=", 400, "warn"),
    ]


NAME_CHECKS = [Check("year_gaps_with_source", "coverage", None, "==", 0), Check("misfiled_from_other_domain", "classification", None, "<=", 2000)]


def named_domains(sheet_name: Column) -> Column:
    """All domains that a sheet name speaks of."""
    return let(F.lower(sheet_name), lambda name: F.filter(F.array(*[F.when(name.rlike(p), F.lit(d)) for d, p in SHEET_NAMES.items()]), lambda d: d.isNotNull()))


def _by_name(curated: DataFrame) -> DataFrame:
    """Per domain the two checks on sheet names; patterns run once for each (name, year, domain)."""
    names = curated.groupBy("source_sheet_name", "report_year", "indicator_domain").agg(F.count("*").alias("n")).withColumn("named", named_domains(c("source_sheet_name")))
    misfiled = (F.size("named") == 1) & ~F.array_contains("named", c("indicator_domain"))
    leaked = names.groupBy("indicator_domain").agg(F.coalesce(F.sum(F.when(F.coalesce(misfiled, F.lit(False)), c("n")).otherwise(0)), F.lit(0)).cast("double").alias("misfiled_from_other_domain"))
    # explode_outer: a plain explode would push a filter on the patterns below the count
    seen = names.withColumn("d", F.explode_outer("named")).groupBy("d", "report_year").agg(F.max(c("d") == c("indicator_domain")).alias("own"))
    gaps = seen.groupBy(c("d").alias("indicator_domain")).agg(total(~F.coalesce("own", F.lit(False))).cast("double").alias("year_gaps_with_source"))
    known = F.when(c("indicator_domain").isin(*SHEET_NAMES), F.coalesce("year_gaps_with_source", F.lit(0.0)))
    return leaked.join(gaps, "indicator_domain", "left").select("indicator_domain", "misfiled_from_other_domain", known.alias("year_gaps_with_source"))


def passes(value: Column, op: Column, threshold: Column) -> Column:
    """Whether a check holds; a missing value fails."""
    held = F.when(op == "==", value == threshold).when(op == "<=", value <= threshold).when(op == ">=", value >= threshold).when(op == "<", value < threshold).when(op == ">", value > threshold)
    return F.coalesce(held, F.lit(False))


def check_table(spark: SparkSession) -> DataFrame:
    """All checks as rows: key, category, op, threshold, severity."""
    rows = [(k.key, k.category, k.op, float(k.threshold), k.severity) for k in [*plain_checks(), *distinct_checks(), *NAME_CHECKS]]
    return spark.createDataFrame(rows, "key string, category string, op string, threshold double, severity string")


#: What the checks read of the curated table.
COLUMNS = [
    "indicator_observation_id", "report_id", "sheet_report_id", "report_year", "report_month", "report_quarter", "period_type", "period_start_date", "period_end_date", "indicator_domain", "indicator_subdomain",
    "indicator_name_raw", "indicator_name_normalized", "metric_name_raw", "metric_basis", "metric_measure", "metric_ref_month", "metric_ref_year", "metric_ref_quarter", "metric_cumulative_months", "metric_comparison",
    "metric_period_grain", "metric_type", "unit_raw", "value_numeric", "value_numeric_base_scale", "value_growth_pct", "analytical_unit", "currency", "geography_raw", "sector_raw", "product_raw",
    "extraction_confidence", "source_filename", "source_sheet_name",
]


def run_checks(curated: DataFrame, keys: tuple[str, ...] = ()) -> DataFrame:
    """indicator_domain, key, category, value, op, threshold, severity, passed: one row per domain and check.

    With keys only those checks are made. Up to three groups of checks read the curated rows, which are
    settled first where there are several, only with the columns that the suite reads.
    """
    chosen = lambda checks: [k for k in checks if not keys or k.key in keys]
    plain, distinct, by_name = chosen(plain_checks()), chosen(distinct_checks()), chosen(NAME_CHECKS)
    if bool(plain) + bool(distinct) + bool(by_name) > 1:
        curated = settled_columns(curated.select(*COLUMNS))
    parts = [curated.groupBy("indicator_domain").agg(*[k.value.cast("double").alias(k.key) for k in checks]) for checks in (plain, distinct) if checks]
    parts += [_by_name(curated)] if by_name else []
    joined = parts[0]
    for part in parts[1:]:
        joined = joined.join(part, "indicator_domain")
    every = [*plain, *distinct, *by_name]
    fields = F.array(*[F.struct(F.lit(k.key).alias("key"), F.lit(k.category).alias("category"), c(k.key).alias("value"), F.lit(k.op).alias("op"), F.lit(float(k.threshold)).alias("threshold"), F.lit(k.severity).alias("severity")) for k in every])
    rows = joined.select("indicator_domain", F.explode(fields).alias("k")).select("indicator_domain", "k.*")
    wanted = F.create_map(*[F.lit(x) for d, column in DIMENSION.items() for x in (d, f"{column}_coverage" if column else "any_dimension_coverage")])
    own = F.coalesce(F.element_at(wanted, c("indicator_domain")), F.lit("any_dimension_coverage"))
    active = ~c("key").isin("product_raw_coverage", "sector_raw_coverage", "any_dimension_coverage") | (c("key") == own)
    named = (c("key") != "year_gaps_with_source") | c("indicator_domain").isin(*SHEET_NAMES)
    return rows.filter(active & named).withColumn("passed", passes(c("value"), c("op"), c("threshold")))


def markdown(results: DataFrame) -> str:
    """A table of counts by domain and a list of what failed; the suite has a bounded number of rows."""
    rows = results.orderBy("indicator_domain", "key").collect()
    lines = ["| domain | checks | passed | failed | warned |", "|---|---|---|---|---|"]
    for domain in sorted({r.indicator_domain for r in rows}):
        own = [r for r in rows if r.indicator_domain == domain]
        bad = [r for r in own if not r.passed]
        lines.append(f"| {domain} | {len(own)} | {len(own) - len(bad)} | {sum(r.severity == 'error' for r in bad)} | {sum(r.severity == 'warn' for r in bad)} |")
    lines += ["", *[f"- {r.indicator_domain}.{r.key}: {r.value} (wanted {r.op} {r.threshold:g}, {r.severity})" for r in rows if not r.passed]]
    return "\n".join(lines)
