"""The monthly run end to end, on local pages and workbooks."""

import io
import json
import zipfile

from gridloom.plans import job, tables
from pyspark.sql import functions as F

MAIN = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'


def book(sheets):
    """A workbook of sheets {name: rows}; numbers as values, all else as inline strings."""
    def cell(r, n, v):
        ref = f"{chr(65 + n)}{r}"
        return f'<c r="{ref}"><v>{v}</v></c>' if isinstance(v, int | float) else f'<c r="{ref}" t="inlineStr"><is><t>{v}</t></is></c>'

    names = list(sheets)
    files = {
        "xl/workbook.xml": f'<workbook {MAIN} xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"><sheets>' + "".join(f'<sheet name="{k}" sheetId="{i}" r:id="r{i}"/>' for i, k in enumerate(names)) + "</sheets></workbook>",
        "xl/_rels/workbook.xml.rels": '<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships">' + "".join(f'<Relationship Id="r{i}" Target="worksheets/s{i}.xml"/>' for i in range(len(names))) + "</Relationships>",
    }
    for i, k in enumerate(names):
        rows = "".join(f'<row r="{r}">' + "".join(cell(r, n, v) for n, v in enumerate(row) if v is not None) + "</row>" for r, row in enumerate(sheets[k], 1))
        files[f"xl/worksheets/s{i}.xml"] = f"<worksheet {MAIN}><sheetData>{rows}</sheetData></worksheet>"
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        for name, body in files.items():
            z.writestr(name, body)
    return out.getvalue()


def sheet(shift):
    return [["1. Chi so san xuat cong nghiep"], [None, "Thang 03 nam 2024", "Thang 04 nam 2024"], [None, "%", "%"], ["Toan nganh", 101.5 + shift, 102.5], ["Khai khoang", 99.5, 98.25]]


def item(n, month):
    return f'<p><a href="/r/{n}" class="x"></p>\n<section class="item"><h3>Báo cáo tình hình kinh tế tháng {month} năm 2024</h3><span class="archive-issue-date">Ngày đăng: 0{n}/04/2024</span></section>'


def web(shift=0.0, broken=()):
    files = {f"https://a.example/r/{n}": f'<a href="/f/{n}.xlsx">Bang</a><a href="/f/{n}.pdf">p</a>'.encode() for n in (1, 2)}
    files |= {f"https://a.example/f/{n}.xlsx": book({"2. IIP": sheet(shift + n), "Ghi chu": [["note"]]}) for n in (1, 2)} | {f"https://a.example/f/{n}.pdf": b"%PDF" for n in (1, 2)}

    def get(url):
        if url in broken:
            raise OSError("gone")
        return files[url]

    return get


def test_monthly_run(spark, tmp_path):
    root = str(tmp_path)
    pages = spark.createDataFrame([(1, "https://a.example/list", item(1, 3) + item(2, 4))], "page_no int, url string, html string")
    one = ("https://a.example/f/2.xlsx",)
    options = {"tries": 1, "pause": 0}
    job.crawl_reports(pages, root, web(), "2024-05-01 00:00:00")
    job.download_files(spark, root, web(broken=one), "2024-05-01 00:00:00", **options)
    log = {r.attachment_type + r.download_status for r in job.read(spark, root, "log").collect()}
    assert log == {"xlsxsuccess", "xlsxfailed", "pdfsuccess"}
    job.parse_files(spark, root, "2024-05-01 00:00:00")
    job.extract_tables(spark, root, "2024-05-01 00:00:00")
    assert job.read(spark, root, "observations").count() == 4
    gate = job.run_month(spark, root, pages, web(), "2024-05-02 00:00:00")  # the failed file comes in, nothing is done twice
    assert gate.count() == 14 and {r.check_name: r.status for r in gate.collect()}["duplicate_observation_extra_rows"] == "PASS"
    rows = job.read(spark, root, "observations")
    assert rows.count() == 8 and rows.filter("extracted_timestamp < '2024-05-02'").count() == 4
    parsed = job.read(spark, root, "parsed").collect()
    assert sorted((r.sheet_index, r.sheet_name_raw) for r in parsed) == [(1, "2. IIP"), (1, "2. IIP"), (2, "Ghi chu"), (2, "Ghi chu")]
    states = {(r.attachment_type, r.parse_status, r.extraction_status, r.extraction_rows_inserted) for r in job.read(spark, root, "log").collect()}
    assert states == {("xlsx", "success", "success", 4), ("pdf", None, None, None)} or states == {("xlsx", "success", "success", 4), ("pdf", "pending", None, None)}
    curated = job.read(spark, root, "curated")
    assert curated.count() == 8 and {r.indicator_domain for r in curated.collect()} == {"industry"}
    stored = job.read(spark, root, "attachments").filter("local_path is not null").collect()
    assert len(stored) == 4 and all("/report_year=2024/report_month=0" in r.local_path and r.content_hash for r in stored)


def test_second_month(spark, tmp_path):
    """Unchanged files are not parsed again, a changed one is; names put in by hand stay; buckets without new rows stay as files."""
    root = str(tmp_path)
    pages = spark.createDataFrame([(1, "https://a.example/list", item(1, 3) + item(2, 4))], "page_no int, url string, html string")
    get = web()
    job.run_month(spark, root, pages, get, "2024-05-01 00:00:00", lasting_dimensions=True)
    stamps = lambda: {r.attachment_id: (r.parsed_timestamp.month, r.sheet_name_raw) for r in job.read(spark, root, "parsed").filter("sheet_index = 1").collect()}
    files = lambda name: {p.relative_to(tmp_path).as_posix() for p in (tmp_path / name).rglob("*.parquet")}
    by_hand = job.read(spark, root, "dim_indicator").withColumn("indicator_name_en", F.when(F.col("indicator_name_raw") == "Khai khoang", "Mining").otherwise(F.col("indicator_name_en"))).withColumn("code", F.lit("B"))
    tables.write_swapped(by_hand, f"{root}/dim_indicator")
    assert {m for m, _ in stamps().values()} == {5} and job.read(spark, root, "sheets").count() == 4 and job.read(spark, root, "cells").filter("cell_value_clean = 'Khai khoang'").count() == 2
    before = {name: files(name) for name in ("parsed", "cells")}

    job.download_files(spark, root, get, "2024-06-01 00:00:00", refresh=True)  # the same bytes
    job.parse_files(spark, root, "2024-06-01 00:00:00")
    assert {m for m, _ in stamps().values()} == {5} and {name: files(name) for name in before} == before
    assert {r.updated_at.month for r in job.read(spark, root, "log").filter("download_status = 'success'").collect()} == {6}
    assert {r.parse_status for r in job.read(spark, root, "log").filter("attachment_type = 'xlsx'").collect()} == {"success"}

    fresh = book({"2. IIP": [*sheet(7.0), ["Dien", 1.5, 2.5]], "Ghi chu": [["note"]]})
    changed = lambda url: fresh if url.endswith("2.xlsx") else get(url)
    job.run_month(spark, root, pages, changed, "2024-07-01 00:00:00", lasting_dimensions=True, refresh=True)
    assert sorted(m for m, _ in stamps().values()) == [5, 7]
    for name in before:
        folders = lambda paths: {p.split("/")[1]: p for p in sorted(paths)}
        old, new = folders(before[name]), folders(files(name))
        assert len(old) == 2 and [old[k] == new[k] for k in sorted(old)].count(True) == 1
    assert job.read(spark, root, "observations").count() == 10 and job.read(spark, root, "cells").filter("cell_value_clean = 'Dien'").count() == 1
    curated = {(r.indicator_name_raw, r.indicator_name_en) for r in job.read(spark, root, "curated").collect()}
    assert {("Khai khoang", "Mining"), ("Dien", "Dien"), ("Toan nganh", "Toan nganh")} == curated
    dims = {r.indicator_name_raw: r.code for r in job.read(spark, root, "dim_indicator").collect()}
    assert dims == {"Khai khoang": "B", "Toan nganh": "B", "Dien": None}

    one = job.read(spark, root, "parsed").limit(1).select("attachment_id")
    assert job.reset_extraction(spark, root, "2024-08-01 00:00:00", one) == 1
    assert sorted(r.extraction_status for r in job.read(spark, root, "log").filter("attachment_type = 'xlsx'").collect()) == ["pending", "success"]
    assert job.reset_extraction(spark, root, "2024-08-01 00:00:00") == 2


def test_a_page_that_lists_a_file_anew(spark):
    schema = "attachment_id string, link_label string, local_path string, file_size_bytes long, content_hash string"
    held = spark.createDataFrame([("a", "old", "/f/a", 5, "h"), ("b", "kept", "/f/b", 6, "i"), ("page", None, None, 7, "j")], schema)
    listed = spark.createDataFrame([("a", "new", None, None, None), ("page", None, None, 8, "k"), ("c", "added", None, None, None)], schema)
    got = sorted(tuple(r) for r in job.merge_listed(held, listed, ["attachment_id"]).collect())
    assert got == [("a", "new", "/f/a", 5, "h"), ("b", "kept", "/f/b", 6, "i"), ("c", "added", None, None, None), ("page", None, None, 8, "k")]


def test_merge_by_bucket(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = lambda *r: spark.createDataFrame(list(r), "k string, v int")
    merge = lambda old, new: job.upsert(old, new, ["k"])
    tables.merge_buckets(rows(), path, ["k"], merge)
    assert not tables.exists(spark, path)
    tables.merge_buckets(rows(*[(str(i), i) for i in range(200)], (None, -1)), path, ["k"], merge, 8)
    tables.merge_buckets(rows(), path, ["k"], merge, 8)
    for _ in range(2):  # a repeated run changes nothing
        tables.merge_buckets(rows(("7", 70), (None, -2), ("new", 1)), path, ["k"], merge, 8)
    want = {str(i): i for i in range(200)} | {"7": 70, None: -2, "new": 1}
    assert spark.read.parquet(path).count() == 202 and {r.k: r.v for r in spark.read.parquet(path).collect()} == want


def test_parse_status_leaves_extraction_alone_on_failure(spark):
    schema = "attachment_id string, parse_status string, parse_error_message string, extraction_status string, updated_at timestamp"
    log = spark.createDataFrame([("a", "pending", None, "success", None), ("b", "failed", "x", None, None), ("c", "pending", None, "empty", None)], schema)
    status = spark.createDataFrame([("a", "failed", "broken", None, None), ("b", "success", None, "pending", None)], schema)
    got = {r.attachment_id: (r.parse_status, r.parse_error_message, r.extraction_status) for r in job.update_parse_status(log, status).collect()}
    assert got == {"a": ("failed", "broken", "success"), "b": ("success", None, "pending"), "c": ("pending", None, "empty")}


def test_processed_keys_are_a_set(spark):
    part = lambda *ids: spark.createDataFrame([(i,) for i in ids], "attachment_id string")
    assert sorted(r[0] for r in job.processed_keys(part("a", "b", None), part("b", "c"), part("a")).collect()) == ["a", "b", "c"]


def test_a_swap_that_fails_leaves_the_old_table(spark, tmp_path):
    path, plain, calls = str(tmp_path / "t"), tables.rename, []
    tables.write_swapped(spark.range(3), path)

    def failing(session, source, target):
        calls.append(source)
        if len(calls) == 2:
            raise OSError("no")
        plain(session, source, target)

    tables.rename = failing
    try:
        tables.write_swapped(spark.range(9), path)
        raise AssertionError("the failure must be seen")
    except OSError:
        pass
    finally:
        tables.rename = plain
    assert len(calls) == 3 and spark.read.parquet(path).count() == 3
    tables.write_swapped(spark.range(5), path)
    assert spark.read.parquet(path).count() == 5


def test_topic_views(spark, tmp_path):
    tables.write_observations(spark.createDataFrame([("industry", 2020, 1.0), ("trade_prices", 2021, 2.0)], "indicator_domain string, report_year int, value_numeric double"), str(tmp_path / "o"))
    tables.topic_views(spark, str(tmp_path / "o"), ["industry", "trade_prices"])
    assert [r.value_numeric for r in spark.sql("SELECT value_numeric FROM trade_prices_report").collect()] == [2.0]
    assert json.loads(spark.table("industry_report").select(F.to_json(F.struct("report_year"))).first()[0]) == {"report_year": 2020}
