"""Gap checks on the curated table, and reports on the processing state."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .quality import GROWTH, ambiguous_groups, extremes, percent, total

c = F.col


def growth_gaps(curated: DataFrame) -> DataFrame:
    kind, value, growth = c("metric_type"), c("value_numeric"), c("value_growth_pct")
    return curated.agg(
        total(kind.isin(*GROWTH) & (growth == value)).alias("unconverted_growth_rows"), total((kind == "yoy_growth") & value.between(50, 200)).alias("index_like_yoy_rows"),
        total(kind.isin(*GROWTH, "index") & growth.isNull()).alias("growth_rows_missing_growth_pct"),
    )


def ambiguous_overall(curated: DataFrame) -> DataFrame:
    """Ambiguous business keys of the whole table; the table's size comes from the same groups."""
    keys = ["sheet_report_id", "indicator_name_raw", "metric_name_raw"]
    groups = curated.groupBy(*keys).agg(F.count("*").alias("n"), *extremes("value_numeric"))
    bad = (c("n") > 1) & (c("_least") != c("_most"))
    rows = F.coalesce(F.sum(F.when(bad, c("n"))), F.lit(0)).cast("long")
    return groups.agg(F.count(F.when(bad, 1)).alias("ambiguous_groups"), rows.alias("rows_in_ambiguous_groups"), F.count_distinct(F.when(bad, c("sheet_report_id"))).alias("sheets_affected"), percent(rows, F.sum("n"), 2).alias("pct_of_corpus"))


def label_pathologies(curated: DataFrame) -> DataFrame:
    name = c("indicator_name_raw")
    return curated.agg(total(name.contains('"')).alias("rows_with_ditto_mark"), total(F.length(F.trim(name)) <= 3).alias("rows_label_len_le_3"))


def reports_by_month(curated: DataFrame) -> DataFrame:
    return curated.groupBy("report_month").agg(F.count_distinct("report_id").alias("reports"), F.count("*").alias("rows")).orderBy(F.asc_nulls_last("report_month"))


def translation_coverage(curated: DataFrame) -> DataFrame:
    rows = F.count("*")
    return curated.agg(
        percent(total(c("indicator_name_en") == c("indicator_name_raw")), rows, 1).alias("indicator_en_untranslated_pct"), percent(total(c("unit_en") == c("unit_raw")), rows, 1).alias("unit_en_untranslated_pct"),
        total(c("indicator_name_raw").rlike("[Ạ-ỹ]")).alias("rows_retaining_vietnamese_unicode"),
    )


def confidence_mix(curated: DataFrame) -> DataFrame:
    return curated.groupBy("extraction_confidence", "needs_review").agg(F.count("*").alias("rows"), F.count_distinct("indicator_domain").alias("domains")).orderBy(F.desc("rows"), "extraction_confidence", "needs_review")


def legacy_residuals(curated: DataFrame, parsed: DataFrame) -> DataFrame:
    """Placeholder metrics, and rows from attachments whose text encoding is doubtful (a flag join, since a sum is asked for)."""
    doubtful = parsed.filter("detected_text_encoding = 'possible_legacy_low_confidence'").select("attachment_id").distinct().withColumn("_d", F.lit(True))
    return curated.join(doubtful, "attachment_id", "left").agg(total(c("metric_name_raw").rlike("^column_[0-9]+$")).alias("placeholder_metric_rows"), total(c("_d")).alias("rows_from_unvalidated_legacy_sheets"))


def failed_downloads(log: DataFrame, reports: DataFrame) -> DataFrame:
    return log.filter("download_status = 'failed'").join(reports, "report_id").select("report_id", "report_year", "sub_category", "attachment_type", F.substring("title_raw", 1, 70).alias("title"))


def lineage_nulls(observations: DataFrame) -> DataFrame:
    return observations.agg(F.count("*").alias("rows"), *[total(c(n).isNull()).alias(f"null_{n}") for n in ("sheet_report_id", "report_id", "attachment_id", "table_id", "source_sheet_name")])


def workbook_sizes(parsed: DataFrame) -> DataFrame:
    """Workbooks, sheets and cells by detected encoding."""
    return parsed.groupBy("detected_text_encoding").agg(F.count_distinct("attachment_id").alias("workbooks"), F.count("*").alias("sheets"), F.sum("cells").cast("long").alias("cells"))


def latest_parsed(parsed: DataFrame, most: int = 50, only: str | None = None) -> DataFrame:
    """The sheets parsed last, of one encoding if asked."""
    rows = parsed.filter(c("detected_text_encoding") == only) if only else parsed
    return rows.orderBy(F.desc("parsed_timestamp"), "attachment_id", "sheet_index").limit(most)
