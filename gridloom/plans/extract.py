"""From parsed sheets to long-form observations, as one lazy plan keyed by sheet."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import units as U
from ..functions.bind import let
from ..functions.ids import md5_16
from ..functions.text import CORRECTIONS, corrected_label, norm
from ..operators import grid as G
from ..operators import sheets as S
from ..operators.classify import FALLBACK, classification
from ..settle import dealt_by, settled_by

#: What follows from the name of a column alone.
METRIC_RULES = {"kind": U.metric_type, "metric_unit": U.unit_from_text, "metric_scale": U.scale, "metric_currency": U.currency}


def number_sheets(parsed: DataFrame) -> DataFrame:
    """parsed with sheet_id and table_id."""
    ids = parsed.withColumn("sheet_id", md5_16("report_id", "attachment_id", "sheet_index"))
    return ids.withColumn("table_id", md5_16(F.col("sheet_id"), F.lit("table"), F.lit(1)))


def classify_sheets(zoned: DataFrame, sheets: DataFrame) -> DataFrame:
    """sheets with title and rule, a struct that says where a sheet is filed and why."""
    text = sheets.join(G.titles(zoned), "sheet_id", "left")
    titled = text.withColumn("title", F.coalesce("title", F.nullif("sheet_name", F.lit("")), F.lit("unknown_sheet")))
    return titled.withColumn("rule", filing(F.col("body_text"))).drop("top_text", "body_text")


def filing(body: Column) -> Column:
    """Where a sheet of a sheet_name, a title and a body is filed and why."""
    return classification(norm(F.col("sheet_name")), norm(F.col("title")), norm(F.concat_ws(" | ", "sheet_name", body)))


def head_facts(heads: DataFrame) -> DataFrame:
    """What the heads of sheets say of their columns and of the sheet: names and units, and where it is filed if name or title tell."""
    named = heads.withColumn("all_metric_name", S.header_names(F.col("spans"), F.col("cols"))).withColumn("all_header_unit", S.header_units(F.col("spans"), F.col("cols")))
    named = named.withColumns({f"all_{k}": F.transform("all_metric_name", rule) for k, rule in METRIC_RULES.items()})
    texts = named.withColumn("_texts", S.filled_texts(F.col("top"), F.col("labels"), F.col("spans")))
    texts = texts.withColumn("head_text", F.array_join(F.flatten(F.slice("_texts", 1, G.TOP_ROWS)), " | ")).withColumn("explicit", S.explicit_unit(F.col("_texts"))).drop("_texts")
    units = texts.withColumn("head_unit", F.coalesce(U.unit_from_text(F.col("title")), U.unit_from_text(F.col("name")))).withColumn("head_combined", U.combined_caption(F.col("title"), F.col("name")))
    told = classification(norm(F.col("name")), norm(F.col("title")), F.lit(""))
    return units.withColumn("head_rule", let(told, lambda r: F.when(r["method"] != FALLBACK, r)))


def extract_observations(parsed: DataFrame, run_ts: str, period_columns: tuple[str, ...] = ("report_year", "report_month", "report_quarter", "period_type", "period_start_date", "period_end_date", "sub_category")) -> DataFrame:
    """Observations of all sheets: one row per number in a labelled data row.

    parsed: attachment_id, report_id, sheet_index, sheet_name_raw, filename, raw_cells_json,
    merged_ranges_json and those of period_columns that it has. Sheets without data rows give none.
    """
    # sheets are dealt once, while their cells are one text; all below is done where a sheet lies
    kept = [c for c in period_columns if c in parsed.columns]
    read = S.read_rows(dealt_by(number_sheets(parsed).withColumnRenamed("sheet_name_raw", "sheet_name"), "sheet_id"))
    titled = read.withColumn("title", F.coalesce(S.title(F.col("rows")), F.nullif("sheet_name", F.lit("")), F.lit("unknown_sheet")))
    below = titled.withColumn("_below", F.when(F.col("first") > 0, F.slice("rows", F.col("first"), F.size("rows"))).otherwise(F.slice("rows", 1, 0)))
    data = below.withColumn("_unit_col", S.unit_column(F.col("_below"))).withColumn("data", S.data_rows(F.col("_below"), F.col("_unit_col"))).withColumn("flat", S.is_flat(F.col("data")))
    meta = ["sheet_id", "table_id", "report_id", "attachment_id", "filename", "sheet_name", *kept]
    sheets = settled_by(data.select(*meta, "first", "flat", "data", S.lines(F.col("rows")).alias("lines"), S.head(F.col("sheet_name"), F.col("title"), F.col("merged_ranges_json")).alias("head")), "sheet_id")
    known = S.with_heads(sheets.filter("first > 0"), head_facts)
    top = F.concat_ws(" | ", F.nullif("head_text", F.lit("")), F.array_join(F.slice("lines", F.greatest(F.col("first"), F.lit(1)), F.greatest(G.TOP_ROWS + 1 - F.col("first"), F.lit(0))), " | "))
    filed = known.withColumn("rule", F.coalesce("head_rule", filing(F.array_join("lines", " | ")))).withColumn("title_unit", F.coalesce("head_unit", U.unit_from_text(top))).withColumn("combined", F.coalesce("head_combined", U.combined_caption(top)))
    meta = [*meta, "title", "rule", "explicit", "title_unit", "combined"]
    columns = ["metric_name", "header_unit", *METRIC_RULES]
    of_row = lambda name: F.transform("_at", lambda i: F.get(F.col(name), i))

    def rows_of(some: DataFrame) -> DataFrame:
        # outer, as else the rows are tested, and so derived, once more before they are exploded
        rows = some.select(*meta, "cols", *[f"all_{k}" for k in columns], F.explode_outer("data").alias("r")).filter("r.row is not null")
        rows = rows.withColumn("_at", F.transform("r.numbers", lambda x: S.place(F.col("cols"), x["col"])))
        return rows.select(*meta, "r.*", *[of_row(f"all_{k}").alias(f"of_{k}") for k in columns])

    # only rows of sheets that are not flat hang on rows above them and so are put in order
    flat, nested = G.hierarchy(rows_of(filed.filter("flat")), flat=True), G.hierarchy(rows_of(filed.filter("not flat")))
    labelled = flat.unionByName(nested).filter(G.keeps_row(F.col("label")))
    routed = labelled.withColumns(G.route(F.col("rule.dimension_strategy"), F.col("label"), F.col("title"), F.col("parent"), F.col("child")))
    named = routed.withColumn("label_unit", U.unit_from_label(F.col("label"))).withColumn("indicator_name_normalized", norm(corrected_label(F.col("label"), CORRECTIONS)))
    cells = named.select("*", F.posexplode_outer("numbers").alias("_i", "n")).filter(F.col("n.col").isNotNull() & ~F.col("n.col").eqNullSafe(F.col("label_col")))
    cells = cells.withColumns({k: F.get(F.col(f"of_{k}"), F.col("_i")) for k in columns}).withColumns({"col": F.col("n.col"), "value": F.col("n.value"), "number": F.col("n.number")})
    unit = U.chosen_unit(F.col("label_unit"), F.col("row_unit"), F.col("kind"), F.col("explicit"), F.col("metric_unit"), F.col("header_unit"), F.col("title_unit"))
    with_unit = cells.withColumn("unit", unit).withColumn("scale_0", F.coalesce("metric_scale", U.scale(F.col("unit"))))
    corrected = with_unit.withColumn("_s", U.settle_semantics(F.col("sheet_name"), F.col("rule.subdomain"), F.col("metric_name"), F.col("unit"), F.col("kind"), F.col("scale_0"), F.col("combined"), F.col("explicit"), F.col("title_unit"))).select("*", "_s.*").drop("_s")
    typed = corrected.withColumn("metric_type", U.reconcile_type(F.col("metric_type"), F.col("unit_raw"), F.col("number"), F.col("metric_name")))
    return typed.select(
        F.col("sheet_id").alias("sheet_report_id"),
        md5_16("sheet_id", "table_id", "row", "col", "label", "value").alias("indicator_observation_id"),
        "report_id", "attachment_id", "table_id",
        F.col("row").alias("source_row_index"), F.col("col").alias("source_column_index"),
        *kept,
        F.col("rule.domain").alias("indicator_domain"), F.col("rule.subdomain").alias("indicator_subdomain"),
        F.col("label").alias("indicator_name_raw"), "indicator_name_normalized",
        "geography_raw", "sector_raw", "product_raw", "unit_raw",
        F.col("metric_name").alias("metric_name_raw"), "metric_type",
        F.col("number").alias("value_numeric"), F.col("value").alias("value_text"),
        F.when(F.nullif("unit_raw", F.lit("")).isNotNull(), U.currency(F.col("unit_raw"))).otherwise(F.col("metric_currency")).alias("currency"), "scale",
        F.col("rule.method").alias("extraction_method"), F.col("rule.confidence").alias("extraction_confidence"), F.col("rule.needs_review").alias("needs_review"),
        F.col("filename").alias("source_filename"), F.col("sheet_name").alias("source_sheet_name"),
        F.lit(run_ts).cast("timestamp").alias("extracted_timestamp"),
    )


def inventory(parsed: DataFrame) -> DataFrame:
    """One row per sheet: where its table starts and ends, its title and where it is filed."""
    sheets = number_sheets(parsed)
    zoned = G.with_zones(G.parse_cells(sheets))
    filed = classify_sheets(zoned, sheets.select("sheet_id", F.col("sheet_name_raw").alias("sheet_name")).distinct())
    zones = zoned.groupBy("sheet_id").agg(F.min("data_start").alias("data_start_row"), F.max("data_end").alias("data_end_row"), F.array_sort(F.collect_set(F.when(F.col("header"), F.col("row")))).alias("header_rows"))
    return filed.join(zones, "sheet_id").select("sheet_id", "sheet_name", F.col("title").alias("table_title_raw"), "data_start_row", "data_end_row", "header_rows", "rule.*")


def extracted_cells(parsed: DataFrame) -> DataFrame:
    """Long cell table: the raw text stays beside the cleaned one."""
    return G.parse_cells(number_sheets(parsed), keep=("sheet_id", "report_id", "attachment_id", "sheet_index")).withColumnRenamed("value", "cell_value_clean")
