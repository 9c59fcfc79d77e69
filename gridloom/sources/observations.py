"""Observations, reports and processing tables derived from order data, for queries and benchmarks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.ids import md5_16
from ..operators.classify import KNOWN_NAMES

SHEET_NAMES = [name for name, _ in KNOWN_NAMES]
#: Part types and the domains they stand for; fixed values of this view.
DOMAIN_OF_TYPE = {"ECONOMY": "national_accounts", "LARGE": "industry", "MEDIUM": "agriculture_forestry_fishery", "PROMO": "trade_prices", "SMALL": "retail_services_tourism", "STANDARD": "transport_post_telecom"}
CONFIDENCES = [1.0, 0.95, 0.90, 0.70, 0.35]
UNITS = ["%", "Million USD", "Thousand tonnes", " million usd "]
SCALES = ["percent", "million", "thousand", "million"]
#: Suppliers, each a key and the name of a nation, that are broadcast; more are left to the optimiser.
BROADCAST_PLACES = 2_000_000
METRIC_TYPES = ["value", "ytd_value", "yoy_growth", "mom_growth", "index", "index_yoy_base100", "share"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _nth(values: list, index: Column) -> Column:
    """values[index], null behind the end."""
    return F.try_element_at(F.array(*[F.lit(v) for v in values]), (index + 1).cast("int"))


def observations(spark: SparkSession, sf_dir: str, by_id: bool = False) -> DataFrame:
    """One observation per order line, with duplicates of ids and seeded gaps.

    With by_id the rows are dealt by observation id while they are narrow, before their texts are derived;
    windows over the id then need no exchange of their own.
    """
    c = F.col
    suppliers = table(spark, sf_dir, "supplier")
    places = suppliers.join(table(spark, sf_dir, "nation"), c("s_nationkey") == c("n_nationkey")).select("s_suppkey", "n_name")
    if suppliers.count() <= BROADCAST_PLACES:
        places = F.broadcast(places)
    metric_type = _nth(METRIC_TYPES, c("l_partkey") % 7)
    value = F.when(c("l_returnflag") == "A", c("l_quantity")).when(metric_type.rlike("growth|index"), 100 + c("l_discount") * 100).otherwise(c("l_extendedprice"))
    # of the three amounts of a line only the one that is read moves
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_returnflag", "l_linestatus", "l_shipdate", value.alias("value"))
    joined = lines.join(table(spark, sf_dir, "part"), c("l_partkey") == c("p_partkey"))
    order, part, supplier, line, shipped = c("l_orderkey"), c("l_partkey"), c("l_suppkey"), c("l_linenumber"), c("l_shipdate")
    observation = md5_16(order, line)
    if by_id:
        joined = joined.repartition(observation)
    joined = joined.join(places, c("l_suppkey") == c("s_suppkey"))  # names of nations do not move with the lines
    two = lambda x: F.lpad(x.cast("string"), 2, "0")
    year, month = F.year(shipped), F.month(shipped)
    quarterly = line == 3
    basis = F.when(c("l_linestatus") == "O", "So bo").otherwise("Uoc tinh")
    suffix = F.when(c("l_returnflag") == "A", " / Luong").when(c("l_returnflag") == "R", " / Tri gia").otherwise("")
    y = year.cast("string")
    kind = order % 7
    header = (
        F.when(kind == 0, F.concat(basis, F.lit(" / thang "), two(month), F.lit(" / nam "), y))
        .when(kind == 1, F.concat(basis, F.lit(" / "), month.cast("string"), F.lit(" thang / nam "), y))
        .when(kind == 2, F.concat(F.lit("Quy "), _nth(["I", "II", "III", "IV"], F.quarter(shipped) - 1), F.lit(" / nam "), y))
        .when(kind == 3, F.concat(basis, F.lit(" / nam "), y))
        .when(kind == 5, F.concat(F.lit("thang "), two(month), F.lit(" so voi cung ky nam truoc")))
        .otherwise(F.concat(basis, F.lit(" / nam")))
    )
    metric = F.when(kind == 4, F.concat(F.lit("column_"), line.cast("string"))).otherwise(F.concat(header, suffix))
    unit = _nth(UNITS, supplier % 5)
    money = unit.rlike("(?i)usd") & ((order * 7 + line) % 100 != 0)
    confidence = _nth(CONFIDENCES, order % 5)
    domain = F.element_at(F.create_map(*[F.lit(x) for pair in DOMAIN_OF_TYPE.items() for x in pair]), c("p_type"))
    traded = F.when(c("l_returnflag") == "R", "exports").otherwise("imports")
    sheet = F.when(order % 97 != 0, md5_16(order))
    return joined.select(
        sheet.alias("sheet_report_id"), observation.alias("indicator_observation_id"), md5_16(supplier).alias("report_id"), md5_16(supplier, order % 3).alias("attachment_id"),
        md5_16(order, F.lit("table"), F.lit(1)).alias("table_id"), line.cast("int").alias("source_row_index"), (part % 20).cast("int").alias("source_column_index"),
        year.alias("report_year"), F.when(~quarterly, month).alias("report_month"), F.when(quarterly, F.quarter(shipped)).alias("report_quarter"),
        F.when(line == 1, "annual").when(quarterly, "quarterly").otherwise("monthly").alias("period_type"),
        F.trunc(shipped.cast("date"), "month").alias("period_start_date"), F.last_day(shipped.cast("date")).alias("period_end_date"),
        F.when(line == 1, "annual").when(quarterly, "quarterly").otherwise("monthly_single_month").alias("sub_category"),
        domain.alias("indicator_domain"), F.when(c("p_type") == "PROMO", traded).otherwise(F.lower("p_type")).alias("indicator_subdomain"),
        c("p_name").alias("indicator_name_raw"), F.lower(F.trim("p_name")).alias("indicator_name_normalized"), metric.alias("metric_name_raw"), metric_type.alias("metric_type"),
        unit.alias("unit_raw"), _nth(SCALES, supplier % 5).alias("scale"), F.when(money, "USD").alias("currency"), F.when(order % 101 != 0, c("value")).alias("value_numeric"), c("l_returnflag").alias("value_text"),
        F.when(part % 11 != 0, c("n_name")).alias("geography_raw"), F.when(supplier % 7 != 0, c("p_type")).alias("sector_raw"), F.when(order % 5 != 0, c("p_brand")).alias("product_raw"),
        F.lit("rule").alias("extraction_method"), confidence.alias("extraction_confidence"), (confidence <= 0.70).alias("needs_review"),
        F.concat(F.lit("file_"), supplier.cast("string"), F.lit(".xlsx")).alias("source_filename"), _nth(SHEET_NAMES, order % len(SHEET_NAMES)).alias("source_sheet_name"),
        shipped.alias("extracted_timestamp"), part.alias("part_key"),
    )


def reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One report per supplier: report_id, report_url, title_raw, report_year, sub_category, published_date."""
    key = F.col("s_suppkey")
    kind = F.when(key % 3 == 0, "annual").when(key % 3 == 1, "quarterly").otherwise("monthly_single_month")
    return table(spark, sf_dir, "supplier").select(
        md5_16(key).alias("report_id"), F.concat(F.lit("https://archive.example/report/"), key.cast("string")).alias("report_url"), F.col("s_name").alias("title_raw"),
        (2000 + key % 5).cast("int").alias("report_year"), kind.alias("sub_category"), F.date_add(F.lit("2001-01-01").cast("date"), (key % 300).cast("int")).alias("published_date"),
    )


def attachments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three attachments per report."""
    key, n = F.col("s_suppkey"), F.col("n")
    types = F.when((key + n) % 4 == 0, "pdf").when((key + n) % 4 == 1, "xls").otherwise("xlsx")
    exploded = table(spark, sf_dir, "supplier").select("s_suppkey", F.explode(F.array(F.lit(0), F.lit(1), F.lit(2))).alias("n"))
    return exploded.select(md5_16(key, n).alias("attachment_id"), md5_16(key).alias("report_id"), types.alias("attachment_type"), F.when(types == "pdf", "pdf_attachment").otherwise("statistical_tables").alias("attachment_role"), key.alias("s_suppkey"), n.alias("n"))


def processing_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A log row for most attachments, with statuses that cycle."""
    state = F.col("s_suppkey") * 3 + F.col("n")
    cycle = lambda values: _nth(values, state % len(values))
    rows = attachments(spark, sf_dir).filter(state % 10 != 0)
    return rows.select(
        "attachment_id", "report_id", "attachment_type", "attachment_role", F.lit("success").alias("download_status"),
        cycle(["success", "pending", "failed", "success"]).alias("parse_status"), cycle(["success", "pending", "success", "failed", "pending"]).alias("extraction_status"),
    )
