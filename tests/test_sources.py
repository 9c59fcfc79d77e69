import io
import json
import tracemalloc
import zipfile

from pyspark.sql import functions as F

from gridloom.functions import html as H
from gridloom.sources import pages as P
from gridloom.sources import xlsx as X


def workbook() -> bytes:
    main = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
    files = {
        "xl/workbook.xml": f'<workbook {main} xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"><sheets><sheet name="GDP" sheetId="1" r:id="rId1"/></sheets></workbook>',
        "xl/_rels/workbook.xml.rels": '<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships"><Relationship Id="rId1" Target="worksheets/sheet1.xml"/></Relationships>',
        "xl/sharedStrings.xml": f"<sst {main}><si><t>Tong</t></si><si><r><t>Chi </t></r><r><t>tieu</t></r></si></sst>",
        "xl/styles.xml": f'<styleSheet {main}><numFmts><numFmt numFmtId="170" formatCode="dd\\/mm\\/yyyy;@"/><numFmt numFmtId="171" formatCode="[Red]0.0&quot; day&quot;"/></numFmts><cellXfs><xf/><xf><alignment indent="2"/></xf><xf numFmtId="14"/><xf numFmtId="170"/><xf numFmtId="171"/></cellXfs></styleSheet>',
        "xl/worksheets/sheet1.xml": f'<worksheet {main}><sheetData><row r="1"><c r="A1" t="s"><v>0</v></c><c r="B1" t="s" s="1"><v>1</v></c><c r="C1"/></row><row r="2"><c r="AA2"><v>12.0</v></c><c r="AB2"><v>1.5</v></c><c r="AC2" t="b"><v>1</v></c><c r="AD2" t="inlineStr"><is><t> x  y </t></is></c></row><row r="3"><c r="A3" s="2"><v>45291</v></c><c r="B3" s="3"><v>45291.5</v></c><c r="C3" s="4"><v>45291</v></c><c r="D3" s="2"><v>0.25</v></c><c r="E3"><v>12345678901234567890</v></c><c r="F3" t="inlineStr"><is><t>{"z" * 20_001}</t></is></c></row></sheetData><mergeCells><mergeCell ref="A1:B1"/></mergeCells></worksheet>',
    }
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        for name, body in files.items():
            z.writestr(name, body)
    return out.getvalue()


def test_workbooks(spark, tmp_path):
    (tmp_path / "a.xlsx").write_bytes(workbook())
    (tmp_path / "broken.xlsx").write_bytes(b"PK\x03\x04nothing")
    (tmp_path / "old.xls").write_bytes(bytes.fromhex("D0CF11E0A1B11AE1"))
    rows = {r.path.rsplit("/", 1)[1]: r for r in X.load_workbooks(spark, str(tmp_path)).collect()}
    assert set(rows) == {"a.xlsx", "broken.xlsx", "old.xls"} and {rows[n].parse_status for n in ("broken.xlsx", "old.xls")} == {"failed"}
    good = rows["a.xlsx"]
    cells = {c["cell_ref"]: (c["cell_value_raw"], c["indent_level"], c["column_index"]) for c in json.loads(good.raw_cells_json)}
    dates = {"A3": ("2023-12-31T00:00:00", 0, 1), "B3": ("2023-12-31T12:00:00", 0, 2), "C3": ("45291", 0, 3), "D3": ("06:00:00", 0, 4), "E3": ("12345678901234567890", 0, 5), "F3": ("z" * 20_000 + "…[truncated]", 0, 6)}
    assert cells == {"A1": ("Tong", 0, 1), "B1": ("Chi tieu", 2, 2), "AA2": ("12", 0, 27), "AB2": ("1.5", 0, 28), "AC2": ("TRUE", 0, 29), "AD2": ("x y", 0, 30)} | dates
    assert (good.sheet_index, good.sheet_name_raw, good.max_row, good.max_column, json.loads(good.merged_ranges_json), good.detected_text_encoding) == (1, "GDP", 3, 30, ["A1:B1"], "unicode")
    assert (good.sheet_name_normalized, good.non_empty_cell_count, good.first_non_empty_row, good.first_non_empty_column, json.loads(good.parse_warnings_json)) == ("gdp", 12, 1, 1, [])


def test_cells_are_streamed(spark, tmp_path):
    (tmp_path / "a.xlsx").write_bytes(workbook())
    (tmp_path / "broken.xlsx").write_bytes(b"PK\x03\x04nothing")
    files = spark.read.format("binaryFile").load(str(tmp_path))
    rows = X.read_cells(files).collect()
    (sheet,) = [r for r in X.read_workbooks(files).collect() if r.parse_status == "success"]
    names = ["row_index", "column_index", "cell_ref", "cell_value_raw", "indent_level"]
    assert [[r[n] for n in names] for r in rows if r.cell_ref] == [[c[n] for n in names] for c in json.loads(sheet.raw_cells_json)]
    assert [(r.sheet_index, r.sheet_name_raw, r.merged_range) for r in rows if r.merged_range] == [(1, "GDP", "A1:B1")]
    assert [r.path.rsplit("/", 1)[1] for r in rows if r.parse_error] == ["broken.xlsx"] and len(rows) == 12 + 2


def test_a_large_sheet_needs_little_memory():
    """The peak does not grow with the rows of a sheet."""
    main = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'

    def peak(rows):
        small = io.BytesIO(workbook())
        out = io.BytesIO()
        with zipfile.ZipFile(small) as old, zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as new:
            for name in old.namelist():
                if "sheet1" not in name:
                    new.writestr(name, old.read(name))
            with new.open("xl/worksheets/sheet1.xml", "w") as f:
                f.write(f"<worksheet {main}><sheetData>".encode())
                for r in range(1, rows + 1):
                    f.write(f'<row r="{r}"><c r="A{r}" t="s"><v>0</v></c><c r="B{r}"><v>{r}</v></c><c r="C{r}"/></row>'.encode())
                f.write(b"</sheetData></worksheet>")
        book = X.open_book(out.getvalue())
        tracemalloc.start()
        count = sum(1 for _ in X.cells_of(book, book.sheets[0][1]))
        most = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert count == 2 * rows
        return most

    assert peak(40_000) < 1.2 * peak(4_000) + 100_000


def test_dates_count_from_1904_where_the_workbook_says_so():
    assert X.date_of(0.0, True) == "1904-01-01T00:00:00" and X.date_of(1.0, False) == "1900-01-01T00:00:00" and X.date_of(61.0, False) == "1900-03-01T00:00:00"
    assert [X.shows_date(code) for code in ("General", "0.00", "yyyy-mm", '0" mm"', "[h]:mm", "[$-409]d-mmm", "#,##0;[Red]d")] == [False, False, True, False, True, True, False]


def test_legacy_sheets_are_repaired_by_their_first_texts(spark):
    cell = lambda n, text: {"row_index": n, "column_index": 1, "cell_ref": f"A{n}", "cell_value_raw": text, "indent_level": 0}
    legacy = [cell(1, "N«ng nghiÖp"), cell(2, "Kh¸ch s¹n"), cell(3, "Khách sạn đã"), cell(4, "hua  chat")]
    late = [cell(n, "plain") for n in range(300)] + [cell(301, "«µ¸¶·¹¨")]
    rows = [(1, "A", json.dumps(legacy)), (2, "B", json.dumps(late)), (3, "C", json.dumps([cell(1, "dien tich §")])), (4, "D", None)]
    got = {r.sheet_index: r for r in X.repair_sheets(spark.createDataFrame(rows, "sheet_index int, sheet_name_raw string, raw_cells_json string")).collect()}
    assert [got[i].detected_text_encoding for i in range(1, 5)] == ["tcvn3", "unicode", "possible_legacy_low_confidence", None]
    cells = [(x.get("cell_value_raw"), x.get("cell_value_unicode"), x.get("cell_value_normalized")) for x in json.loads(got[1].raw_cells_json)]
    assert cells == [("N«ng nghiÖp", "Nông nghiệp", "Nong nghiep"), ("Kh¸ch s¹n", "Khách sạn", "Khach san"), ("Khách sạn đã", "Khách sạn đã", "Khach san da"), ("hua  chat", "hua chat", "hoa chat")]
    assert json.loads(got[1].parse_warnings_json) == ["legacy_tcvn3_font_detected_and_converted"] and json.loads(got[3].parse_warnings_json) == ["possible_legacy_font_low_confidence_not_converted"]


def item(n):
    return f'<p><a href="/r/{n}" class="x"></p>\n<section class="item"><h3>Báo cáo tình hình kinh tế tháng {n} năm 2024</h3><span class="archive-issue-date">Ngày đăng: 0{n}/03/2024</span></section>'


def test_crawl_stops_after_two_pages_without_news(spark):
    pages = [(1, item(1) + item(2)), (2, item(2)), (3, item(3)), (4, item(3)), (5, item(1)), (6, item(4))]
    df = spark.createDataFrame([(n, "https://a.example/list", h) for n, h in pages], "page_no int, url string, html string")
    got = P.crawl(df).orderBy("report_url").collect()
    assert [(r.report_url, r.source_page, r.report_month, str(r.published_date)) for r in got] == [(f"https://a.example/r/{n}", p, n, f"2024-03-0{n}") for n, p in ((1, 1), (2, 1), (3, 3))]
    assert P.crawl(df.filter("page_no <> 2")).count() == 2  # a missing page ends the crawl
    assert P.crawl(df.limit(0)).count() == 0


def test_attachments_and_downloads(spark, tmp_path):
    reports = spark.createDataFrame([("r1", "https://a.example/r/1")], "report_id string, report_url string")
    body = '<a href="/f/a.xlsx">Bang</a><a href="/f/a.xlsx">again</a><a href="b.pdf">p</a>'
    got = P.attachments(reports, spark.createDataFrame([("https://a.example/r/1", body)], "report_url string, html string"))
    rows = {r.attachment_url: r for r in got.collect()}
    assert set(rows) == {"https://a.example/f/a.xlsx", "https://a.example/r/b.pdf", "https://a.example/r/1"}
    assert (rows["https://a.example/f/a.xlsx"].link_label, rows["https://a.example/r/1"].attachment_role, rows["https://a.example/r/1"].file_size_bytes) == ("Bang", "inline_html", len(body))
    log = got.filter("attachment_type = 'xlsx'").select("attachment_id", F.lit("success").alias("download_status"), F.lit("/x/a.xlsx").alias("local_path"))
    present = spark.createDataFrame([("/x/a.xlsx",)], "path string")
    assert {r.attachment_url: r.reused for r in P.reuse_downloads(got, log, present).collect()}["https://a.example/f/a.xlsx"] is True
    assert P.pending_downloads(P.reuse_downloads(got, log, present.limit(0))).count() == 3

    def get(url):
        if url.endswith("pdf"):
            raise OSError("gone")
        return url.encode()

    fetched = {r.download_status: r for r in P.fetch(got.filter("attachment_type IN ('xlsx', 'pdf')"), get, tries=2, pause=0).collect()}
    assert (fetched["failed"].download_attempts, fetched["failed"].download_error_message, bytes(fetched["success"].content)) == (2, "gone", b"https://a.example/f/a.xlsx")


def test_pending(spark):
    log = spark.createDataFrame([("a", "XLSX", "success", None), ("b", "pdf", "success", "pending"), ("c", "other", "success", "failed"), ("d", "xls", "failed", None)], "attachment_id string, attachment_type string, download_status string, parse_status string")
    files = spark.createDataFrame([("c", "http://x/y.XLSX?v=1")], "attachment_id string, attachment_url string")
    assert sorted(r.attachment_id for r in P.pending_parses(log, files).collect()) == ["a", "c"]
    kinds = spark.createDataFrame([("excel", None, None), (None, "A.XLSM", None), (None, "", "http://x/a.xls"), (None, "a.pdf", "http://x/a.xls"), (None, None, "http://x/a.xls?v=1"), (None, None, None)], "k string, n string, u string")
    got = kinds.select(H.is_workbook_file(F.col("k"), F.col("n"), F.col("u")).alias("strict"), H.is_workbook(F.col("k"), F.col("u"), F.col("n")).alias("wide")).collect()
    assert [(r.strict, r.wide) for r in got] == [(True, True), (True, True), (True, True), (False, True), (False, True), (False, False)]
