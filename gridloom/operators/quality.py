"""Quality views over the curated table and the gate on them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.bind import let
from ..settle import settled_columns

c = F.col
GROWTH = ("yoy_growth", "mom_growth")


def total(condition: Column) -> Column:
    """SUM(CASE WHEN ... THEN 1 ELSE 0 END): null on no rows, as against a conditional count."""
    return F.sum(F.when(condition, 1).otherwise(0)).cast("long")


def percent(part: Column, whole: Column, digits: int) -> Column:
    return F.round(F.try_divide(F.lit(100.0) * part, whole), digits)


def report_coverage(reports: DataFrame, attachments: DataFrame, log: DataFrame) -> DataFrame:
    joined = reports.alias("r").join(attachments.alias("a"), c("r.report_id") == c("a.report_id"), "left").join(log.alias("l"), c("a.attachment_id") == c("l.attachment_id"), "left")
    of = lambda when, what: F.count_distinct(F.when(when, what))
    return joined.groupBy("r.report_year", "r.sub_category").agg(
        F.count_distinct("r.report_id").alias("reports"), F.count_distinct("a.attachment_id").alias("attachments"),
        of(c("a.attachment_type").isin("xls", "xlsx", "xlsm"), c("a.attachment_id")).alias("workbook_attachments"),
        of(c("l.parse_status") == "success", c("l.attachment_id")).alias("parsed_attachments"),
        of(c("l.extraction_status") == "success", c("l.attachment_id")).alias("extracted_attachments"),
    )


def counts_by(df: DataFrame, *keys: str, name: str = "rows") -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias(name))


def review_queue(curated: DataFrame) -> DataFrame:
    return curated.filter("needs_review = true")


#: What quality_summary reads of the curated table.
SUMMARY_COLUMNS = [
    "indicator_observation_id", "report_id", "attachment_id", "sheet_report_id", "needs_review", "value_numeric", "source_sheet_name", "indicator_name_raw", "metric_name_raw", "unit_raw",
    "geography_raw", "sector_raw", "product_raw", "period_start_date", "period_end_date", "extracted_timestamp",
]


def quality_summary(curated: DataFrame) -> DataFrame:
    broken = None
    for name in ("source_sheet_name", "indicator_name_raw", "metric_name_raw", "unit_raw", "geography_raw", "sector_raw", "product_raw"):
        broken = c(name).contains("�") if broken is None else broken | c(name).contains("�")
    # the curated rows are dealt by id already: the first of an id is found where it is, and ids are not dealt again to count them
    found = c("indicator_observation_id")
    first = found.isNotNull() & F.lag(F.lit(1)).over(W.partitionBy(found).orderBy(found)).isNull()
    distinct = F.count(F.when(c("_first"), 1))
    review = total(c("needs_review"))
    return curated.withColumn("_first", first).agg(
        F.count("*").alias("curated_rows"), distinct.alias("distinct_observation_ids"), (F.count("*") - distinct).alias("duplicate_observation_extra_rows"),
        F.count_distinct("report_id").alias("reports"), F.count_distinct("attachment_id").alias("attachments"), F.count_distinct("sheet_report_id").alias("sheet_reports"),
        total(c("sheet_report_id").isNull()).alias("rows_missing_sheet_report_id"), review.alias("rows_needing_review"), percent(review, F.count("*"), 2).alias("rows_needing_review_pct"),
        total(c("value_numeric").isNull()).alias("rows_missing_numeric_value"), total(c("indicator_name_raw").isNull() | (F.trim("indicator_name_raw") == "")).alias("rows_missing_indicator_name"),
        total(broken).alias("rows_with_replacement_character"), F.min("period_start_date").alias("min_period_start_date"), F.max("period_end_date").alias("max_period_end_date"),
        F.min("extracted_timestamp").alias("min_source_extracted_timestamp"), F.max("extracted_timestamp").alias("max_source_extracted_timestamp"),
    )


def lineage_reconciliation(observations: DataFrame, curated: DataFrame) -> DataFrame:
    """Row counts of both tables and of the sheet summary, side by side (three one-row tables)."""
    missing = total(c("sheet_report_id").isNull())
    a = observations.agg(F.count("*").alias("extracted_rows"), missing.alias("extracted_null_sheet_report_id"))
    b = curated.agg(F.count("*").alias("curated_rows"), missing.alias("curated_null_sheet_report_id"))
    s = curated.groupBy("report_id").agg(F.count("*").alias("n")).agg(F.sum("n").cast("long").alias("curated_sheet_summary_observations"))
    one = a.join(b, F.lit(True)).join(s, F.lit(True))
    return one.withColumn("curated_minus_sheet_summary_observations", c("curated_rows") - c("curated_sheet_summary_observations"))


def _semantic() -> list[Column]:
    sheet = F.lower(F.trim("source_sheet_name"))
    growth = c("metric_type").isin("index_yoy_base100", *GROWTH)
    return [
        total(sheet.rlike("^14[. _-]*xk") & (c("indicator_domain") != "trade_prices")).alias("export_rows_wrong_domain"),
        total(sheet.rlike("^15[. _-]*nk") & (c("indicator_domain") != "trade_prices")).alias("import_rows_wrong_domain"),
        total(sheet.rlike("^2[. _-]*iip") & ~c("metric_type").isin("index", "index_yoy_base100")).alias("iip_rows_wrong_metric_type"),
        total(growth & c("value_growth_pct").isNotNull() & (F.abs(c("value_growth_pct") - (c("value_numeric") - 100.0)) > 1e-6)).alias("invalid_growth_conversion"),
        total(c("metric_type").isin(*GROWTH) & (c("value_growth_pct") == c("value_numeric"))).alias("unconverted_growth_rows"),
        total(c("unit_raw").rlike("[ÃÂÄ]")).alias("rows_with_mojibake_unit"),
    ]


def semantic_validation(curated: DataFrame) -> DataFrame:
    return curated.agg(*_semantic(), F.count("*").alias("curated_rows"))


def _age(as_of: str) -> Column:
    return F.date_diff(F.lit(as_of).cast("date"), F.max("published_date")).cast("long")


def freshness(curated: DataFrame, as_of: str) -> DataFrame:
    return curated.agg(F.max("published_date").alias("latest_published"), F.max("period_end_date").alias("latest_period_end"), _age(as_of).alias("days_since_publish"), F.count_distinct("report_id").alias("reports"), F.count("*").alias("curated_rows"))


def extremes(value: str) -> list[Column]:
    """_least and _most of a column: they differ if it holds several distinct values, which needs no exchange by value."""
    return [F.min(value).alias("_least"), F.max(value).alias("_most")]


def ambiguous_groups(curated: DataFrame, *keys: str) -> DataFrame:
    """Business keys with several rows and several values, with their row counts n."""
    return curated.groupBy(*keys).agg(F.count("*").alias("n"), *extremes("value_numeric")).filter("n > 1 AND _least <> _most").drop("_least", "_most")


def business_key_uniqueness(curated: DataFrame) -> DataFrame:
    groups = ambiguous_groups(curated, "sheet_report_id", "indicator_domain", "indicator_name_raw", "metric_name_raw")
    return groups.groupBy("indicator_domain").agg(F.count("*").alias("ambiguous_groups"), F.sum("n").cast("long").alias("rows_in_ambiguous_groups"), F.count_distinct("sheet_report_id").alias("sheets_affected"))


def _coherence() -> list[Column]:
    growth = c("metric_type").isin(*GROWTH)
    justified = c("metric_name_raw").rlike("(?i)%|phan tram|co cau|chi so|tang|giam|so voi")
    return [
        total(growth & c("unit_raw").isNotNull() & (c("unit_raw") != "%")).alias("growth_type_with_level_unit"),
        total(growth & (F.abs("value_numeric") > 1000)).alias("growth_value_implausible"),
        total((c("unit_raw") == "%") & ~justified).alias("pct_unit_unjustified_by_header"),
        total(c("metric_type").isin("share", "percent") & ((c("value_numeric") < 0) | (c("value_numeric") > 100))).alias("share_out_of_range"),
        total(c("metric_name_raw").rlike("^column_[0-9]+$")).alias("placeholder_metric_rows"),
    ]


def unit_metric_coherence(curated: DataFrame) -> DataFrame:
    return curated.agg(*_coherence())


def calendar_model(curated: DataFrame) -> DataFrame:
    month = c("report_month")
    return curated.agg(
        total(month == 3).alias("rows_month_3"), total(month.isNull()).alias("rows_null_month"),
        total((month == 12) & (c("period_type") == "annual")).alias("month12_annual_rows"), total((month == 12) & (c("period_type") == "monthly")).alias("month12_monthly_rows"),
    )


#: What a sheet's folded name says about its domain; fixed values.
NAMED_DOMAINS = {
    "trade_prices": r"(?<![a-z])(xk|nk|xnk)|xuat khau|nhap khau|(?<![a-z])cpi|gia tieu dung",
    "industry": r"(?<![a-z])(iip|spcn|gtcn|ldcn)|sp cn|cong nghiep",
    "investment_construction": r"(?<![a-z])(vdt|dtnn|fdi|nsnn)|von dau tu|xay dung",
    "transport_post_telecom": r"van ?tai|(?<![a-z])(vt|vthh|vthk)|buu chinh|vien thong",
    "retail_services_tourism": r"du lich|khach quoc te|(?<![a-z])kqt|tong ?muc|ban le",
    "enterprise_business_registration": r"(?<![a-z])dn|doanh nghiep|giai the",
    "agriculture_forestry_fishery": r"(?<![a-z])nn|nong nghiep|thuy san|lam nghiep",
    "national_accounts": r"(?<![a-z])(gdp|grdp)",
    "population_labor_social": r"lao dong|dan so|that nghiep|viec lam",
    "environment_safety_disaster": r"(?<![a-z])(xhmt|thpt)|moi truong|thien tai|giao duc|tot nghiep",
}


def expected_domain(sheet_name: Column) -> Column:
    """The one domain that a sheet name speaks of; null if it speaks of none or several."""
    hits = lambda name: F.filter(F.array(*[F.when(name.rlike(p), F.lit(d)) for d, p in NAMED_DOMAINS.items()]), lambda d: d.isNotNull())
    only = lambda found: F.when(F.size(found) == 1, F.try_element_at(found, F.lit(1)))
    return let(let(F.lower(F.regexp_replace(sheet_name, "[^a-zA-Z0-9 ._-]", "d")), hits), only)


def domain_classification(curated: DataFrame) -> DataFrame:
    """Distinct (domain, sheet name) pairs are counted first, so the patterns run once a name.

    Names that speak of no domain are left out by conditional sums: a filter on them would be pushed
    below the count and run the patterns on every row.
    """
    names = curated.groupBy("indicator_domain", "source_sheet_name").agg(F.count("*").alias("n")).withColumn("expected", expected_domain(c("source_sheet_name")))
    wrong = c("expected") != c("indicator_domain")
    rows = F.coalesce(F.sum(F.when(c("expected").isNotNull(), c("n"))), F.lit(0)).cast("long")
    bad = F.sum(F.when(c("expected").isNotNull(), F.when(wrong, c("n")).otherwise(0))).cast("long")
    return names.agg(rows.alias("rows_with_named_domain"), bad.alias("misclassified_rows"), percent(bad, rows, 1).alias("misclassified_pct"), F.count_distinct(F.when(wrong, c("source_sheet_name"))).alias("sheets_affected"))


def year_missing(name: Column) -> Column:
    return name.rlike("(?i)(^|/) *nam *(/|$)") & name.rlike("(?i)so bo|uoc tinh|thang|quy ") & ~name.rlike("[0-9]{4}")


def _decomposition() -> list[Column]:
    return [total(year_missing(c("metric_name_raw"))).alias("metric_year_missing"), total((c("metric_measure") == "quantity") & c("unit_raw").rlike("(?i)usd|vnd|dong")).alias("quantity_with_currency_unit")]


def metric_decomposition(curated: DataFrame) -> DataFrame:
    name = c("metric_name_raw")
    return curated.agg(
        F.count("*").alias("rows_total"), *_decomposition(),
        total(c("metric_ref_year").isNull() & c("metric_ref_month").isNotNull()).alias("metric_month_without_year"), total(c("metric_period_grain").isNull()).alias("metric_grain_unknown"),
        F.count_distinct("metric_period_grain").alias("distinct_grain"), total(c("metric_measure").isNull() & name.rlike("(?i)(^|/) *(luong|tri gia)")).alias("measure_unparsed"),
        total(c("metric_ref_year").isNotNull() & (c("metric_ref_year") != c("report_year"))).alias("metric_year_differs_from_report"),
        F.count_distinct("metric_basis").alias("distinct_basis"), F.count_distinct("metric_measure").alias("distinct_measure"),
    )


def dimension_coverage(curated: DataFrame) -> DataFrame:
    return curated.agg(
        F.count("*").alias("curated_rows"), total(c("geography_raw").isNull()).alias("null_geography"), total(c("sector_raw").isNull()).alias("null_sector"), total(c("product_raw").isNull()).alias("null_product"),
        total(c("geography_raw").isNotNull() & (c("geography_type") == "unknown")).alias("geography_unclassified"), F.count_distinct("geography_type").alias("distinct_geography_types"),
        percent(total(c("indicator_name_en") == c("indicator_name_raw")), F.count("*"), 1).alias("indicator_en_untranslated_pct"), percent(total(c("unit_en") == c("unit_raw")), F.count("*"), 1).alias("unit_en_untranslated_pct"),
    )


#: Gate checks: name, threshold, whether the gap is known; fixed values, sized for a corpus of 700,000 rows.
GATE = [
    ("freshness_days_since_publish", 45, False), ("unconverted_growth_rows", 0, False), ("invalid_growth_conversion", 0, False), ("rows_with_mojibake_unit", 0, False),
    ("duplicate_observation_extra_rows", 0, False), ("rows_missing_sheet_report_id", 0, False), ("curated_minus_sheet_summary", 0, False), ("rows_in_ambiguous_groups", 85_000, True),
    ("pct_unit_unjustified_by_header", 12_000, True), ("growth_type_with_level_unit", 70_000, True), ("placeholder_metric_rows", 20_000, True), ("domain_misclassified_rows", 5_000, False),
    ("metric_year_missing", 100, False), ("quantity_with_currency_unit", 500, False),
]


#: What the gate reads of the curated table.
GATE_COLUMNS = [
    "indicator_observation_id", "report_id", "sheet_report_id", "published_date", "indicator_domain", "indicator_name_raw", "metric_name_raw", "metric_measure", "metric_type", "unit_raw",
    "value_numeric", "value_growth_pct", "source_sheet_name",
]


def gate(observations: DataFrame, curated: DataFrame, as_of: str, thresholds: dict[str, int] | None = None, null_fails: bool = False) -> DataFrame:
    """One row per check: check_name, value, threshold, known_open_issue, status.

    A null value passes unless null_fails. The columns that the checks read are settled once. All
    measures that are sums over the curated rows share one pass; with three more one-row aggregates
    beside it they are turned into rows.
    """
    curated = settled_columns(curated.select(*GATE_COLUMNS))
    missing, rows = total(c("sheet_report_id").isNull()), F.count("*")
    measured = curated.agg(
        _age(as_of).alias("freshness_days_since_publish"), *_semantic(), *_coherence(), *_decomposition(),
        (rows - F.count_distinct("indicator_observation_id")).alias("duplicate_observation_extra_rows"), missing.alias("rows_missing_sheet_report_id"),
    )
    ambiguous = business_key_uniqueness(curated).agg(F.coalesce(F.sum("rows_in_ambiguous_groups"), F.lit(0)).cast("long").alias("rows_in_ambiguous_groups"))
    lineage = lineage_reconciliation(observations, curated).select(F.abs("curated_minus_sheet_summary_observations").alias("curated_minus_sheet_summary"))
    filed = domain_classification(curated).select(c("misclassified_rows").alias("domain_misclassified_rows"))
    one = measured
    for part in (lineage, ambiguous, filed):
        one = one.join(part, F.lit(True))
    limits = {name: limit for name, limit, _ in GATE} | (thresholds or {})
    rows = F.array(*[F.struct(F.lit(n).alias("check_name"), c(n).cast("long").alias("value"), F.lit(limits[n]).cast("long").alias("threshold"), F.lit(known).alias("known_open_issue")) for n, _, known in GATE])
    checks = one.select(F.explode(rows).alias("k")).select("k.*")
    return checks.withColumn("status", F.when(c("value").isNull(), "FAIL" if null_fails else "PASS").when(c("value") > c("threshold"), "FAIL").otherwise("PASS"))


def enforce(gate_rows: DataFrame) -> None:
    """Raise if a check fails that is not a known gap."""
    failed = gate_rows.filter("status = 'FAIL' AND NOT known_open_issue").orderBy("check_name").collect()
    if failed:
        raise AssertionError("quality gate: " + "; ".join(f"{r.check_name}: {r.value} > {r.threshold}" for r in failed))
