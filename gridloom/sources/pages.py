"""Archive pages: report lists, attachments, incremental downloads."""

from __future__ import annotations

import hashlib
import time
import uuid
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import html as H
from ..functions.ids import md5_16
from ..functions.periods import classify_report, parse_date
from ..operators.curated import keep_first

ITEM = r"""(?is)<a\s+href=["']([^"']+)["'][^>]*>\s*</p>\s*<section class="item">(.*?)</section>"""
TITLE_PREFIX = "báo cáo tình hình kinh tế"


def parse_archive(pages: DataFrame, title_prefix: str = TITLE_PREFIX) -> DataFrame:
    """Report rows of archive pages (page_no, url, html), in every page's order; titles without the prefix are left out."""
    found = F.arrays_zip(F.regexp_extract_all("html", F.lit(ITEM), F.lit(1)).alias("href"), F.regexp_extract_all("html", F.lit(ITEM), F.lit(2)).alias("block"))
    items = pages.select("page_no", F.col("url").alias("page_url"), F.posexplode(found).alias("n", "i")).select("page_no", "page_url", "n", "i.href", "i.block")
    field = lambda name: H.clean_text(F.regexp_extract("block", rf'(?is)class="{name}"[^>]*>(.*?)</span>', 1))
    titled = items.withColumn("title_raw", H.clean_text(F.regexp_extract("block", "(?is)<h3>(.*?)</h3>", 1))).filter(F.lower("title_raw").startswith(title_prefix))
    url = H.absolute_url(F.col("href"), F.col("page_url"))
    named = titled.withColumn("report_url", url).withColumn("p", classify_report(F.col("title_raw")))
    reference = F.nullif(F.trim(F.replace(field("archive-reference-period"), F.lit("Kỳ tham chiếu:"), F.lit(""))), F.lit(""))
    return named.select(
        md5_16("report_url").alias("report_id"), "report_url", "title_raw", F.lit("socio_economic_report").alias("category"), "p.*", reference.alias("reference_period_raw"),
        parse_date(field("archive-issue-date")).alias("published_date"), parse_date(field("archive-next-release")).alias("next_release_date"), F.col("page_no").alias("source_page"), F.col("n").alias("place"),
    )


def _listed(pages: DataFrame, **options) -> DataFrame:
    """Reports, each from the first page that lists it."""
    return keep_first(parse_archive(pages, **options), ["report_url"], F.asc("source_page"), F.asc("place"))


def _stops(pages: DataFrame, listed: DataFrame, empty_pages: int) -> DataFrame:
    """One row: the page at which a loop over the pages ends, or null. The running counts are over one row per page."""
    fresh = pages.select("page_no").distinct().join(listed.groupBy(F.col("source_page").alias("page_no")).agg(F.count("*").alias("n")), "page_no", "left")
    order = W.orderBy("page_no")
    window = order.rowsBetween(-(empty_pages - 1), 0)
    dry = (F.sum(F.coalesce("n", F.lit(0))).over(window) == 0) & (F.count("*").over(window) == empty_pages)
    gap = F.col("page_no") != F.lag("page_no", 1).over(order) + 1
    return fresh.withColumn("dry", dry).withColumn("gap", gap).filter(F.col("dry") | F.coalesce("gap", F.lit(False))).agg(F.min("page_no").alias("stop"))


def stop_page(pages: DataFrame, empty_pages: int = 2, **options) -> int | None:
    return _stops(pages, _listed(pages, **options), empty_pages).first().stop


def crawl(pages: DataFrame, empty_pages: int = 2, **options) -> DataFrame:
    """Reports of the pages up to the stop: a missing page, or empty_pages pages in a row without a new report.

    A report is new on the first page that lists it.
    """
    listed = _listed(pages, **options)
    stops = _stops(pages, listed, empty_pages)
    return listed.join(stops, F.col("stop").isNull() | (F.col("source_page") < F.col("stop"))).drop("stop", "place")


def attachments(reports: DataFrame, bodies: DataFrame) -> DataFrame:
    """Files linked from report pages and the page itself as a virtual HTML attachment.

    reports: report_id, report_url; bodies: report_url, html. Of equal URLs on a page the first stays.
    """
    joined = reports.select("report_id", "report_url").join(bodies.select("report_url", "html"), "report_url")
    linked = joined.select("report_id", "report_url", F.posexplode(H.links(F.col("html"))).alias("n", "l")).withColumn("attachment_url", H.absolute_url(F.col("l.href"), F.col("report_url")))
    files = keep_first(linked, ["report_id", "attachment_url"], F.asc("n"))
    url = F.col("attachment_url")
    name = H.filename(url)
    rows = files.select(
        md5_16("report_url", "attachment_url").alias("attachment_id"), "report_id", "report_url", "attachment_url", F.col("l.label").alias("link_label"), H.attachment_type(url).alias("attachment_type"),
        H.attachment_role(url).alias("attachment_role"), name.alias("filename"), H.extension(name).alias("file_extension"), F.lit(None).cast("long").alias("file_size_bytes"), F.lit(None).cast("string").alias("content_hash"), F.lit("pending").alias("download_status"),
    )
    page = joined.filter(F.length("html") > 0).select(
        md5_16(F.col("report_url"), F.lit("inline_html")).alias("attachment_id"), "report_id", "report_url", F.col("report_url").alias("attachment_url"), F.lit(None).cast("string").alias("link_label"), F.lit("html").alias("attachment_type"),
        F.lit("inline_html").alias("attachment_role"), F.concat("report_id", F.lit(".html")).alias("filename"), F.lit("html").alias("file_extension"), F.octet_length("html").cast("long").alias("file_size_bytes"), F.md5("html").alias("content_hash"), F.lit("success").alias("download_status"),
    )
    return rows.unionByName(page)


def reuse_downloads(candidates: DataFrame, log: DataFrame, present: DataFrame, refresh: bool = False) -> DataFrame:
    """candidates with local_path and `reused`: files that the log has and that are still there need no fetch.

    present: path of the files that exist, as a binaryFile listing gives them.
    """
    had = log.filter("download_status = 'success' AND local_path is not null").select("attachment_id", "local_path")
    there = had.join(present.select(F.col("path").alias("local_path")).distinct(), "local_path", "left_semi")
    joined = candidates.drop("local_path").join(keep_first(there, ["attachment_id"], F.asc("local_path")), "attachment_id", "left")
    reused = F.lit(False) if refresh else F.col("local_path").isNotNull()
    return joined.withColumn("reused", reused)


def pending_downloads(candidates: DataFrame) -> DataFrame:
    return candidates.filter("NOT reused")


def attempts(get: Callable[[str], bytes], url: str, tries: int, pause: float) -> tuple[bytes | None, int, str | None]:
    """(content, tries made, error) of get(url), with growing pauses between tries."""
    for attempt in range(1, tries + 1):
        try:
            return get(url), attempt, None
        except Exception as e:  # noqa: BLE001  any failure of a fetch is a status, not an end
            error = str(e)[:500]
            time.sleep(pause * attempt if attempt < tries else 0)
    return None, tries, error


def fetch(files: DataFrame, get: Callable[[str], bytes], tries: int = 3, pause: float = 1.5) -> DataFrame:
    """attachment_id, content, download_status, attempts, error of files (attachment_id, attachment_url).

    With download(), the only steps that need the network; they run in tasks, one row at a time.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [(key, *attempts(get, url, tries, pause)) for key, url in zip(batch["attachment_id"], batch["attachment_url"])]
            rows = [(key, content, "success" if error is None else "failed", made, error) for key, content, made, error in rows]
            yield pd.DataFrame(rows, columns=["attachment_id", "content", "download_status", "download_attempts", "download_error_message"])

    return files.select("attachment_id", "attachment_url").mapInPandas(run, "attachment_id string, content binary, download_status string, download_attempts int, download_error_message string")


def _system(root: str):
    """A file system that tasks can write to, and the path of root on it."""
    from pyarrow import fs

    if root.startswith("file:"):
        return fs.LocalFileSystem(), "/" + root[5:].lstrip("/")
    return fs.FileSystem.from_uri(root.replace("s3a://", "s3://", 1))


def download(files: DataFrame, get: Callable[[str], bytes], root: str, tries: int = 3, pause: float = 1.5) -> DataFrame:
    """attachment_id, local_path, file_size_bytes, content_hash, download_status, download_attempts, download_error_message.

    files: attachment_id, attachment_url, storage_path. A task fetches a file and writes it under root
    (a URI that all hosts share), beside its place first and then moved there, so that a rerun of a
    task gives the same files. No content leaves its task.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        system, base = _system(root)
        names = ["attachment_id", "local_path", "file_size_bytes", "content_hash", "download_status", "download_attempts", "download_error_message"]
        for batch in batches:
            rows = []
            for key, url, path in zip(batch["attachment_id"], batch["attachment_url"], batch["storage_path"]):
                content, attempt, error = attempts(get, url, tries, pause)
                if error is not None:
                    rows.append((key, None, None, None, "failed", attempt, error))
                    continue
                place, folder = f"{base}/{path}", f"{base}/{path}".rsplit("/", 1)[0]
                system.create_dir(folder, recursive=True)
                fresh = f"{folder}/.{key}.{uuid.uuid4().hex}"
                with system.open_output_stream(fresh) as out:
                    out.write(content)
                system.move(fresh, place)
                rows.append((key, f"{root}/{path}", len(content), hashlib.md5(content).hexdigest(), "success", attempt, None))
            yield pd.DataFrame(rows, columns=names).astype({"file_size_bytes": "Int64", "download_attempts": "Int32"})

    schema = "attachment_id string, local_path string, file_size_bytes long, content_hash string, download_status string, download_attempts int, download_error_message string"
    return files.select("attachment_id", "attachment_url", "storage_path").mapInPandas(run, schema)


def pending_parses(log: DataFrame, files: DataFrame) -> DataFrame:
    """Workbooks that are downloaded and not parsed, with their address and, if files has it, their local_path."""
    wanted = [c for c in ("attachment_url", "filename", "local_path") if c in files.columns]
    waiting = log.filter("download_status = 'success' AND coalesce(parse_status, 'pending') IN ('pending', 'failed')")
    joined = waiting.drop(*wanted).join(files.select("attachment_id", *wanted), "attachment_id", "left")
    return joined.filter(H.is_workbook(F.col("attachment_type"), F.col("attachment_url"), F.col("filename") if "filename" in wanted else None))


def pending_sheets(parsed: DataFrame, reports: DataFrame, log: DataFrame) -> DataFrame:
    """Parsed sheets that wait for extraction, with their report's period."""
    open_ = log.filter("parse_status = 'success' AND coalesce(extraction_status, 'pending') IN ('pending', 'failed')").select("attachment_id")
    return parsed.join(reports.drop("report_url"), "report_id").join(open_, "attachment_id")
