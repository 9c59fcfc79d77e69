"""Reporting datasets: summaries, profiles and top lists."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..settle import settled, settled_columns
from . import quality as Q
from .quality import percent, total
from .ranks import exact_median, numbered

c = F.col


def domain_split(curated: DataFrame) -> DataFrame:
    return curated.groupBy("indicator_domain").agg(F.count("*").alias("rows"), total(c("needs_review")).alias("needs_review"))


def overall_kpis(curated: DataFrame, as_of: str) -> DataFrame:
    """One row of headline counts, numbers written with separators."""
    return curated.agg(
        F.format_number(F.count("*"), 0).alias("observations"), F.count_distinct("report_id").alias("reports"), F.count_distinct("indicator_domain").alias("domains"),
        F.concat_ws("-", F.min("report_year").cast("string"), F.max("report_year").cast("string")).alias("years"),
        F.date_diff(F.lit(as_of).cast("date"), F.max("published_date")).cast("long").alias("days_since_publish"),
    )


def coverage_by_year(curated: DataFrame, domain: str) -> DataFrame:
    return curated.filter(c("indicator_domain") == domain).groupBy("report_year").agg(F.count("*").alias("rows"), F.count_distinct("sheet_report_id").alias("sheets"), F.count_distinct("indicator_name_normalized").alias("indicators"))


def year_domain_matrix(curated: DataFrame) -> DataFrame:
    return curated.groupBy("report_year", "indicator_domain").agg(F.count("*").alias("rows"))


def unit_mix(curated: DataFrame, domain: str) -> DataFrame:
    return curated.filter(c("indicator_domain") == domain).groupBy(F.coalesce("analytical_unit", F.lit("(none)")).alias("unit")).agg(F.count("*").alias("rows"))


def field_completeness(curated: DataFrame) -> DataFrame:
    filled = lambda name: percent(total(c(name).isNotNull()), F.count("*"), 1)
    return curated.groupBy("indicator_domain").agg(*[filled(n).alias(f"{n}_pct") for n in ("value_numeric", "unit_raw", "geography_raw", "sector_raw", "product_raw")])


def indicator_profile(curated: DataFrame, domain: str, most: int = 250) -> DataFrame:
    """The most frequent series of a domain: rows, exact median, smallest and largest value, first and last period."""
    keys = ["indicator_name_raw", "metric_type", "metric_measure", "metric_period_grain"]
    unit = F.coalesce("analytical_unit", F.lit("(none)")).alias("unit")
    grouped = curated.filter((c("indicator_domain") == domain) & c("value_numeric").isNotNull()).groupBy(*keys, unit)
    profile = grouped.agg(
        F.count("*").alias("rows"), F.round(F.percentile("value_numeric", F.lit(0.5)), 4).alias("median_value"), F.min("value_numeric").alias("min_value"), F.max("value_numeric").alias("max_value"),
        F.min("period_start_date").alias("first_period"), F.max("period_end_date").alias("last_period"),
    )
    return profile.orderBy(F.desc("rows"), *[F.asc_nulls_first(k) for k in (*keys, "unit")]).limit(most)


def ambiguous_share(curated: DataFrame) -> DataFrame:
    """Rows in ambiguous groups by domain, and their share.

    The rows are dealt by business key once; the groups and their domains are counted where they lie.
    """
    keys = ["sheet_report_id", "indicator_name_raw", "metric_name_raw"]
    dealt = curated.select(*keys, "indicator_domain", "value_numeric").repartition(*keys)
    parts = dealt.groupBy(*keys, "indicator_domain").agg(F.count("*").alias("n"), *Q.extremes("value_numeric"))
    group = W.partitionBy(*keys)
    several = (F.sum("n").over(group) > 1) & (F.min("_least").over(group) != F.max("_most").over(group))
    inside = F.coalesce(several, F.lit(False)) & c(keys[0]).isNotNull() & c(keys[1]).isNotNull() & c(keys[2]).isNotNull()
    counted = parts.withColumn("_inside", inside).groupBy("indicator_domain").agg(F.sum("n").alias("rows"), F.sum(F.when(c("_inside"), c("n")).otherwise(0)).alias("rows_ambiguous"))
    # rows without a domain match no group by domain
    found = counted.withColumn("rows_ambiguous", F.when(c("indicator_domain").isNotNull(), c("rows_ambiguous")).otherwise(0))
    return found.withColumn("share_pct", percent(c("rows_ambiguous"), c("rows"), 2))


def residual_artifacts(tables: list[tuple[DataFrame, str, str]], words: list[str], most: int = 100) -> DataFrame:
    """source, label, rows: labels of several tables that still hold suspicious words, the most frequent first."""
    pattern = "|".join(words)
    parts = [df.filter(c(column).rlike(pattern)).select(F.lit(name).alias("source"), c(column).alias("label")) for df, column, name in tables]
    every = parts[0]
    for part in parts[1:]:
        every = every.unionByName(part)
    return every.groupBy("source", "label").agg(F.count("*").alias("rows")).orderBy(F.desc("rows"), "source", "label").limit(most)


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """table_name, rows of several tables in one plan."""
    parts = [df.agg(F.count("*").alias("rows")).select(F.lit(name).alias("table_name"), "rows") for name, df in tables.items()]
    every = parts[0]
    for part in parts[1:]:
        every = every.unionByName(part)
    return every


def year_gaps(df: DataFrame, group: str, year: Column) -> DataFrame:
    return df.groupBy(group).agg((F.max(year) - F.min(year) + 1 - F.count_distinct(year)).cast("long").alias("gaps"), F.count_distinct(year).alias("years"))


def first_per_sheet(observations: DataFrame, *tie_breakers: str) -> DataFrame:
    """Row counts and the first observation of each sheet."""
    first = F.min_by(F.struct("source_filename", "report_year", "period_type"), F.struct("source_row_index", "source_column_index", "indicator_observation_id", *tie_breakers))
    return observations.filter("sheet_report_id is not null").groupBy("sheet_report_id").agg(F.count("*").alias("observations"), first.alias("_f")).select("sheet_report_id", "observations", "_f.*")


#: Sheets of the released sample and the labels that it shows; fixed values.
SAMPLE_SHEETS = r"^(2[. _-]*iip|14[. _-]*xk|15[. _-]*nk)"
SAMPLE_LABELS = "tong|toan nganh|cong nghiep che bien"
SAMPLE_VALUES = (109.2, 109.9)


def recent_numeric_sample(curated: DataFrame, year: int, month: int, most: int = 60, sheets: str = SAMPLE_SHEETS, labels: str = SAMPLE_LABELS, values: tuple[float, ...] = SAMPLE_VALUES) -> DataFrame:
    """Up to `most` values of one month from production and trade sheets: headline rows, or values near those that were published."""
    near = F.lit(False)
    for v in values:
        near = near | (F.abs(c("value_numeric") - v) < 0.01)
    rows = curated.filter(c("value_numeric").isNotNull() & (c("report_year") == year) & (c("report_month") == month) & F.lower(F.trim("source_sheet_name")).rlike(sheets) & (F.lower("indicator_name_raw").rlike(labels) | near))
    order = [F.asc_nulls_first(k) for k in ("indicator_domain", "source_sheet_name", "indicator_name_raw", "metric_name_raw", "indicator_observation_id")]
    return rows.orderBy(*order).limit(most).select(
        c("indicator_domain").alias("domain"), c("indicator_subdomain").alias("subdomain"), c("indicator_name_raw").alias("indicator"), c("metric_name_raw").alias("metric"), c("unit_raw").alias("unit"),
        "metric_type", "value_numeric", "value_growth_pct", c("source_sheet_name").alias("sheet"),
    )


def quality_bundle(observations: DataFrame, curated: DataFrame, as_of: str, year: int, month: int) -> dict[str, DataFrame]:
    """The result sets of a release check by name."""
    return {
        "dashboard": Q.gate(observations, curated, as_of).orderBy(F.desc("status"), "check_name"), "freshness": Q.freshness(curated, as_of), "semantic_qc": Q.semantic_validation(curated), "quality_summary": Q.quality_summary(curated),
        "unit_metric_coherence": Q.unit_metric_coherence(curated), "business_key_uniqueness": Q.business_key_uniqueness(curated).orderBy(F.desc("rows_in_ambiguous_groups")), "recent_numeric_sample": recent_numeric_sample(curated, year, month),
    }


def month_histogram(df: DataFrame, month: str) -> DataFrame:
    """Rows by month, unknown months last."""
    return df.groupBy(month).agg(F.count("*").alias("rows")).orderBy(F.asc_nulls_last(month))


# --- datasets of the dashboard ----------------------------------------------------------------------


def _number(value: Column) -> Column:
    return F.format_number(value, 0)


def dashboard_overview(curated: DataFrame, as_of: str) -> DataFrame:
    """Headline figures as they are shown: numbers with separators, dates as text."""
    return curated.agg(
        _number(F.count("*")).alias("observations"), *[_number(F.count_distinct(k)).alias(n) for k, n in (("report_id", "reports"), ("sheet_report_id", "sheets"), ("indicator_name_raw", "indicators"))],
        F.max("period_end_date").cast("string").alias("latest_period"), F.date_diff(F.lit(as_of).cast("date"), F.max("published_date")).cast("string").alias("days_since_publish"),
    )


def dashboard_domains(curated: DataFrame) -> DataFrame:
    return curated.groupBy(c("indicator_domain").alias("domain")).agg(F.count("*").alias("observations"), F.count_distinct("indicator_name_raw").alias("indicators"), F.count_distinct("sheet_report_id").alias("sheets"))


def dashboard_timeline(curated: DataFrame) -> DataFrame:
    return curated.filter("report_year is not null").groupBy("report_year", c("indicator_domain").alias("domain")).agg(F.count("*").alias("observations"))


def dashboard_metric_mix(curated: DataFrame) -> DataFrame:
    return curated.groupBy("metric_type").agg(F.count("*").alias("observations"))


def dashboard_fields(curated: DataFrame) -> DataFrame:
    """Shares of rows, by domain, that lack a field."""
    lack = lambda condition: percent(total(condition), F.count("*"), 1)
    return curated.groupBy(c("indicator_domain").alias("domain")).agg(
        F.count("*").alias("observations"), lack(c("unit_raw").isNull()).alias("pct_no_unit"), lack(c("metric_name_raw").rlike("^column_[0-9]+$")).alias("pct_placeholder_metric"), lack(c("geography_raw").isNull()).alias("pct_no_geography"),
        lack(c("sector_raw").isNull()).alias("pct_no_sector"), lack(c("needs_review")).alias("pct_needs_review"),
    )


def dashboard_reports(reports: DataFrame, period: str = "period_type") -> DataFrame:
    return reports.filter("report_year is not null").groupBy("report_year", c(period).alias("period_type")).agg(F.count_distinct("report_id").alias("reports"))


def dashboard_periods(curated: DataFrame) -> DataFrame:
    return curated.filter("period_end_date is not null").groupBy("period_end_date", "period_type").agg(F.count("*").alias("observations"))


def domain_kpis(curated: DataFrame, domain: str) -> DataFrame:
    years = F.concat(F.min("report_year").cast("string"), F.lit(" - "), F.max("report_year").cast("string"))
    return curated.filter(c("indicator_domain") == domain).agg(_number(F.count("*")).alias("observations"), _number(F.count_distinct("indicator_name_raw")).alias("indicators"), _number(F.count_distinct("sheet_report_id")).alias("sheets"), years.alias("year_range"))


def domain_coverage(curated: DataFrame, domain: str) -> DataFrame:
    return curated.filter((c("indicator_domain") == domain) & c("report_year").isNotNull()).groupBy("report_year").agg(F.count("*").alias("observations"), F.count_distinct("indicator_name_raw").alias("indicators"))


def _shown_unit() -> Column:
    return F.coalesce("unit_raw", F.lit("(no unit)")).alias("unit")


def domain_units(curated: DataFrame, domain: str) -> DataFrame:
    return curated.filter(c("indicator_domain") == domain).groupBy(_shown_unit(), "metric_type").agg(F.count("*").alias("observations"))


#: What domain_indicators reads of the curated table.
SERIES_COLUMNS = ["indicator_domain", "indicator_name_raw", "metric_name_raw", "metric_type", "unit_raw", "sector_raw", "product_raw", "geography_raw", "value_numeric", "period_end_date"]


def domain_indicators(curated: DataFrame, domain: str) -> DataFrame:
    """Every series of a domain with its exact median, range and periods, numbered by its rows.

    Equal counts are numbered by name, which the original leaves to chance. Medians are found by rank and
    rows are numbered by ranges, so neither a series nor the list of series is held by one task. Values
    are rounded as decimals, halves away from zero.
    """
    breakdown = F.coalesce("sector_raw", "product_raw", "geography_raw", F.lit("")).alias("breakdown")
    keys = [c("indicator_name_raw").alias("indicator"), c("metric_name_raw").alias("metric"), c("metric_type"), _shown_unit(), breakdown]
    names = ["indicator", "metric", "metric_type", "unit", "breakdown"]
    rows = settled_columns(curated.filter(c("indicator_domain") == domain).select(*keys, "value_numeric", "period_end_date"))
    shown = lambda value: F.round(value.cast("decimal(38,6)"), 2).cast("double")
    series = rows.groupBy(*names).agg(
        F.count("*").alias("observations"), shown(F.min("value_numeric")).alias("min_value"), shown(F.max("value_numeric")).alias("max_value"),
        F.min("period_end_date").cast("string").alias("first_period"), F.max("period_end_date").cast("string").alias("last_period"),
    )
    medians = exact_median(rows, names, "value_numeric", "median_value").withColumn("median_value", shown(c("median_value")))
    same = [series[k].eqNullSafe(medians[k]) for k in names]
    joined = series.join(medians, same, "left").select(*[series[k] for k in series.columns], "median_value")
    return numbered(settled(joined), [-c("observations"), *map(c, names)])
