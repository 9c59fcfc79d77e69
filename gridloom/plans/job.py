"""The monthly run: crawl, download, parse, extract, curate and gate, each step over tables under one folder.

A step reads what the steps before it wrote and puts new tables in place by swapped writes, so a
run that ends half-way is taken up where the processing log says that work is left.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import html as H
from ..functions.text import norm
from ..operators import quality as Q
from ..operators.curated import curate, dim_geography, dim_indicator, keep_first
from ..operators.upsert import align, insert_only, reconcile_counts, sweep_stale, update_in, update_matched, upsert
from ..settle import settled
from ..sources import pages as P
from ..sources.xlsx import read_workbooks, repair_sheets
from .extract import extract_observations, extracted_cells, inventory, number_sheets
from .schemas import conform, required, schema
from .tables import OBSERVATION, exists, merge_buckets, qualified, write_observations, write_swapped

c = F.col
PARSE_STATUS = ("parse_status", "parse_error_message", "extraction_status", "updated_at")

#: Dimensions that outlive a run, with their keys.
DIMENSIONS = {"dim_indicator": (dim_indicator, ["indicator_name_normalized", "indicator_domain", "indicator_subdomain"]), "dim_geography": (dim_geography, ["geography_normalized"])}


#: Tables of which a run rewrites some buckets only, so that older files may lack columns.
BUCKETED = ("parsed", "sheets", "cells", "sheet_reports", "sheet_log")


def read(spark: SparkSession, root: str, name: str) -> DataFrame:
    return spark.read.option("mergeSchema", name in BUCKETED).parquet(f"{root}/{name}")


def _put(df: DataFrame, root: str, name: str, partition_by: list[str] | None = None) -> None:
    """Put df in the place of a table, whose schema it takes; nulls in required columns are refused."""
    write_swapped(conform(df, name), f"{root}/{name}", partition_by, required(name))


def _merge(fresh: DataFrame, root: str, name: str, keys: list[str], merge: Callable[..., DataFrame] = upsert) -> None:
    """Put fresh rows into a table, which they begin if there is none; both sides take the table's schema first, so tables of older runs still merge."""
    spark, path = fresh.sparkSession, f"{root}/{name}"
    fresh = settled(conform(fresh, name))
    if exists(spark, path):
        old = conform(spark.read.parquet(path), name)
        fresh = merge(old, align(fresh, old.schema), keys)
    _put(fresh, root, name)


def _merge_buckets(fresh: DataFrame, root: str, name: str, merge: Callable[[DataFrame, DataFrame], DataFrame]) -> None:
    """Put fresh rows into a table that is kept by buckets of the attachment."""
    merge_buckets(conform(fresh, name), f"{root}/{name}", ["attachment_id"], merge, required=required(name))


def merge_listed(target: DataFrame, source: DataFrame, keys: list[str]) -> DataFrame:
    """attachments with what a crawl lists: known files take what their page says now and keep what their download found."""
    found = ("local_path", "file_size_bytes", "content_hash")
    columns = {k: F.coalesce(f"s.{k}", f"t.{k}") if k in found else k for k in target.columns if k not in keys}
    return insert_only(update_matched(target, source, keys, columns), source, keys)


def crawl_reports(pages: DataFrame, root: str, get: Callable[[str], bytes], run_ts: str, **options) -> None:
    """Reports of the archive pages, the files that their pages link, and log rows for files not seen before."""
    reports = settled(P.crawl(pages, **options))
    asked = reports.select(c("report_id").alias("attachment_id"), c("report_url").alias("attachment_url"))
    bodies = P.fetch(asked, get).filter("download_status = 'success'").select(c("attachment_id").alias("report_id"), c("content").cast("string").alias("html"))
    linked = settled(P.attachments(reports, reports.select("report_id", "report_url").join(bodies, "report_id").select("report_url", "html")))
    _merge(reports, root, "reports", ["report_id"])
    _merge(linked.drop("download_status").withColumn("local_path", F.lit(None).cast("string")), root, "attachments", ["attachment_id"], merge_listed)
    log = linked.filter("attachment_role <> 'inline_html'").select("attachment_id", "report_id", "attachment_type", "attachment_role", F.lit("pending").alias("download_status"), F.lit(run_ts).cast("timestamp").alias("updated_at"))
    _merge(align(log, schema("log")), root, "log", ["attachment_id"], insert_only)


def download_files(spark: SparkSession, root: str, get: Callable[[str], bytes], run_ts: str, refresh: bool = False, **options) -> None:
    """Fetch the files that the log has not as downloaded and present; their paths go to `attachments`, their status to `log`.

    A file is parsed anew only if its content changed; one that cannot be fetched again keeps what was parsed.
    """
    store = qualified(spark, f"{root}/files")
    files, log, reports = (read(spark, root, name) for name in ("attachments", "log", "reports"))
    known = log.join(files.select("attachment_id", "local_path"), "attachment_id")
    present = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(store).select("path") if exists(spark, store) else spark.createDataFrame([], "path string")
    candidates = log.select("attachment_id").join(files, "attachment_id").join(reports.select("report_id", "report_year", "report_month", "period_type"), "report_id")
    wanted = P.pending_downloads(P.reuse_downloads(candidates, known, present, refresh))
    path = H.storage_path(c("report_year"), c("report_month"), c("period_type"), c("attachment_id"), c("filename"))
    got = settled(P.download(wanted.withColumn("storage_path", path), get, store, **options))
    held = files.select("attachment_id", F.coalesce("content_hash", F.lit("")).alias("held_hash"))
    stamped = got.join(held, "attachment_id").withColumn("updated_at", F.lit(run_ts).cast("timestamp"))
    again = c("s.download_status") == "success"
    changed = again & (F.coalesce("s.content_hash", F.lit("")) != c("s.held_hash"))
    columns = {k: k for k in ("download_status", "download_attempts", "download_error_message", "updated_at")} | {"parse_status": F.when(changed, F.lit("pending")).otherwise(c("t.parse_status"))}
    _put(update_matched(log, stamped, ["attachment_id"], columns), root, "log")
    _put(update_matched(files, got, ["attachment_id"], {k: k for k in ("local_path", "file_size_bytes", "content_hash")}, again), root, "attachments")


def update_parse_status(log: DataFrame, status: DataFrame) -> DataFrame:
    """log with the statuses of a parse; extraction is pending again only where the parse succeeded."""
    open_again = F.when(c("s.parse_status") == "success", c("s.extraction_status")).otherwise(c("t.extraction_status"))
    return update_matched(log, status, ["attachment_id"], {k: k for k in PARSE_STATUS} | {"extraction_status": open_again})


def parse_files(spark: SparkSession, root: str, run_ts: str) -> None:
    """Sheets of the workbooks that wait for it."""
    log = read(spark, root, "log")
    waiting = settled(P.pending_parses(log, read(spark, root, "attachments")).select("attachment_id", "report_id", "attachment_url", "filename", "local_path"))
    paths = [r.local_path for r in waiting.select("local_path").collect() if r.local_path]  # names only, as Spark lists files itself
    if not paths:
        return
    sheets = repair_sheets(read_workbooks(spark.read.format("binaryFile").load(paths))).join(waiting, c("path") == c("local_path")).drop("path", "local_path")
    parsed = settled(sheets.withColumn("parsed_timestamp", F.lit(run_ts).cast("timestamp")))
    good = parsed.filter("parse_status = 'success'")
    _merge_buckets(good.drop("parse_status", "parse_error"), root, "parsed", lambda old, new: upsert(old, new, ["attachment_id", "sheet_index"]))
    done = parsed.groupBy("attachment_id").agg(F.min("parse_status").alias("parse_status"), F.max("parse_error").alias("parse_error_message"))
    unread = waiting.join(done, "attachment_id", "left_anti").select("attachment_id", F.lit("failed").alias("parse_status"), F.lit("not a workbook that can be read").alias("parse_error_message"))
    status = done.unionByName(unread).withColumn("extraction_status", F.when(c("parse_status") == "success", "pending")).withColumn("updated_at", F.lit(run_ts).cast("timestamp"))
    _put(update_parse_status(log, settled(status)), root, "log")


def processed_keys(*parts: DataFrame) -> DataFrame:
    """The attachments that any of the parts names, once each."""
    every = parts[0].select("attachment_id")
    for part in parts[1:]:
        every = every.unionByName(part.select("attachment_id"))
    return every.filter("attachment_id is not null").distinct()


def reset_extraction(spark: SparkSession, root: str, run_ts: str, attachments: DataFrame | None = None) -> int:
    """Let parsed workbooks be extracted again, all or those that `attachments` names; how many there are."""
    log = read(spark, root, "log")
    wanted = log.filter("parse_status = 'success'").select("attachment_id").join(read(spark, root, "parsed").select("attachment_id"), "attachment_id", "left_semi")
    if attachments is not None:
        wanted = wanted.join(attachments.select("attachment_id"), "attachment_id", "left_semi")
    wanted = settled(wanted)
    _put(update_in(log, "attachment_id", wanted, {"extraction_status": F.lit("pending"), "updated_at": F.lit(run_ts).cast("timestamp")}), root, "log")
    return wanted.count()


def sheet_reports(listed: DataFrame, waiting: DataFrame, observations: DataFrame, run_ts: str) -> DataFrame:
    """One row for each sheet of the inventory: where it is filed, its period, how many observations it gave.

    A sheet without observations is "empty" and has no period, file name or count but zero.
    """
    counted = observations.groupBy(c("sheet_report_id").alias("sheet_id")).agg(F.count("*").cast("int").alias("n"))
    period = ("report_year", "report_month", "report_quarter", "period_type", "period_start_date", "period_end_date")
    of_sheet = number_sheets(waiting).select("sheet_id", c("sheet_name_raw"), c("filename").alias("source_filename"), *period)
    found = listed.join(of_sheet, "sheet_id").join(counted, "sheet_id", "left")
    now = F.lit(run_ts).cast("timestamp")
    return found.select(
        c("sheet_id").alias("sheet_report_id"), "report_id", "attachment_id", "sheet_index", "sheet_name_raw", norm(c("sheet_name_raw")).alias("sheet_name_normalized"),
        *[F.when(c("n") > 0, c(k)).alias(k) for k in ("source_filename", *period)],
        c("domain").alias("indicator_domain"), c("subdomain").alias("indicator_subdomain"), "table_title_raw", F.lit("success").alias("parse_status"),
        F.when(c("n") > 0, F.lit("success")).otherwise(F.lit("empty")).alias("extraction_status"), F.coalesce("n", F.lit(0)).alias("observation_count"),
        F.coalesce("needs_review", F.lit(False)).alias("needs_review"), now.alias("created_at"), now.alias("updated_at"),
    )


def write_sheets(waiting: DataFrame, observations: DataFrame, root: str, run_ts: str) -> None:
    """Inventory, cells, reports and log rows of the waiting sheets, in place of what the tables had of these sheets."""
    where = waiting.select("attachment_id", "sheet_index", "report_id", "parsed_timestamp")
    listed = settled(number_sheets(where).drop("table_id").join(inventory(waiting), "sheet_id"))
    by = lambda key: lambda old, new: upsert(old, new, [key])
    _merge_buckets(listed, root, "sheets", by("sheet_id"))
    by_sheet = lambda old, new: old.join(new.select("sheet_id").distinct(), "sheet_id", "left_anti").select(*new.columns).unionByName(new)
    _merge_buckets(extracted_cells(waiting), root, "cells", by_sheet)
    reported = settled(sheet_reports(listed, waiting, observations, run_ts))
    _merge_buckets(reported, root, "sheet_reports", by("sheet_report_id"))
    logged = reported.select("sheet_report_id", "report_id", "attachment_id", "sheet_index", "parse_status", "extraction_status", c("observation_count").alias("rows_extracted"), c("updated_at").alias("run_timestamp"), "updated_at")
    _merge_buckets(logged, root, "sheet_log", by("sheet_report_id"))


def extract_tables(spark: SparkSession, root: str, run_ts: str) -> None:
    """Observations of the sheets that wait for it; rows that an earlier run had of them and this one has not go."""
    log = read(spark, root, "log")
    if not exists(spark, f"{root}/parsed"):
        return
    waiting = settled(P.pending_sheets(read(spark, root, "parsed"), read(spark, root, "reports"), log))
    keys = processed_keys(waiting, log.filter("extraction_status = 'failed'"))
    fresh = settled(keep_first(align(extract_observations(waiting, run_ts), OBSERVATION), ["indicator_observation_id"], F.asc("source_row_index"), F.asc("source_column_index")))
    write_sheets(waiting, fresh, root, run_ts)
    path = f"{root}/observations"
    every = upsert(spark.read.parquet(path).select(*fresh.columns), fresh, ["indicator_observation_id"]) if exists(spark, path) else fresh
    kept = settled(sweep_stale(every, "attachment_id", keys, "extracted_timestamp", F.lit(run_ts).cast("timestamp")))
    write_observations(kept, path, required("observations"))
    counted = reconcile_counts(log.join(keys, "attachment_id", "left_semi"), kept, "attachment_id", "extraction_rows_inserted", "extraction_status")
    _merge(counted.withColumn("updated_at", F.lit(run_ts).cast("timestamp")), root, "log", ["attachment_id"])


def keep_dimensions(observations: DataFrame, root: str) -> dict[str, DataFrame]:
    """The lasting dimensions with the keys that the observations add; rows that are there, such as ones mapped by hand, stay as they are."""
    spark = observations.sparkSession
    for name, (derive, keys) in DIMENSIONS.items():
        path, derived = f"{root}/{name}", settled(derive(observations))
        if not exists(spark, path):
            _put(derived, root, name)
            continue
        old = conform(spark.read.parquet(path), name)
        both = settled(insert_only(old, align(derived, old.schema), keys))
        if both.count() > old.count():
            _put(both, root, name)
    return {name: read(spark, root, name) for name in DIMENSIONS}


def curate_and_gate(spark: SparkSession, root: str, as_of: str, thresholds: dict[str, int] | None = None, lasting_dimensions: bool = False) -> DataFrame:
    """Write the curated table and give the gate's rows.

    Dimensions are derived anew, or with lasting_dimensions kept from run to run, so that names and
    codes put in by hand survive; units are always derived, as their scale follows the rows.
    """
    observations = read(spark, root, "observations")
    dims = keep_dimensions(observations, root) if lasting_dimensions else {}
    curated = curate(observations, read(spark, root, "reports"), dims.get("dim_indicator"), dims.get("dim_geography"))
    _put(curated, root, "curated", ["indicator_domain"])
    return Q.gate(observations, read(spark, root, "curated"), as_of, thresholds)


def run_month(spark: SparkSession, root: str, pages: DataFrame, get: Callable[[str], bytes], run_ts: str, thresholds: dict[str, int] | None = None, lasting_dimensions: bool = False, refresh: bool = False, **options) -> DataFrame:
    """All steps in order; the gate's rows, to be looked at or enforced. With refresh all files are fetched again."""
    crawl_reports(pages, root, get, run_ts, **options)
    download_files(spark, root, get, run_ts, refresh)
    parse_files(spark, root, run_ts)
    extract_tables(spark, root, run_ts)
    return curate_and_gate(spark, root, run_ts[:10], thresholds, lasting_dimensions)
