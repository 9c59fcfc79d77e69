"""Workbook files as sheet rows.

Files are read by Spark's binaryFile source, so any store that Spark reads will do; a small reader
built on the standard library turns the bytes of one .xlsx file into its sheets.
"""

from __future__ import annotations

import io
import json
import re
import zipfile
from collections.abc import Iterator
from dataclasses import dataclass
from datetime import datetime, timedelta
from itertools import islice
from xml.etree import ElementTree

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import encoding_from_hits, legacy_hits, normalize_name, normalized_cell, repair_unicode
from .xls import SIGNATURE, read_old_workbook

MAIN = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
REL = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}"
SCHEMA = "path string, sheet_index int, sheet_name_raw string, max_row int, max_column int, raw_cells_json string, merged_ranges_json string, parse_status string, parse_error string"
MOST_TEXT, MARK = 20_000, "…[truncated]"  # of a cell; fixed values
#: Built-in number formats that show dates or times; fixed values.
DATE_FORMATS = {*range(14, 23), *range(27, 37), 45, 46, 47, *range(50, 59)}


def sniff(content: Column, name: Column) -> Column:
    """xlsx, xls or unknown by magic bytes, then by extension."""
    return (
        F.when(F.hex(F.substring(content, 1, 4)) == "504B0304", "xlsx")
        .when(F.hex(F.substring(content, 1, 8)) == "D0CF11E0A1B11AE1", "xls")
        .when(F.lower(name).rlike(r"\.xlsx$"), "xlsx")
        .when(F.lower(name).rlike(r"\.xls$"), "xls")
        .otherwise("unknown")
    )


def place(reference: str) -> tuple[int, int]:
    """Row and column of a cell reference."""
    letters, digits = re.match(r"([A-Z]+)([0-9]+)$", reference).groups()
    column = 0
    for ch in letters:
        column = column * 26 + ord(ch) - 64
    return int(digits), column


def shows_date(code: str) -> bool:
    """Whether a number format has date or time letters outside of quotes, escapes and brackets."""
    bare = re.sub(r'"[^"]*"|\\.|_.|\*.|\[(?!h+\]|m+\]|s+\])[^\]]*\]', "", code.split(";")[0], flags=re.I)
    return "general" not in bare.lower() and re.search("[dmhysDMHYS]", bare) is not None


def date_of(number: float, from_1904: bool) -> str:
    """ISO text of a date serial; a serial below one is a time of day."""
    base, days = (datetime(1904, 1, 1), number) if from_1904 else (datetime(1899, 12, 30), number + (1 if 1 <= number < 60 else 0))
    moment = base + timedelta(milliseconds=round(days * 86_400_000))
    return moment.time().isoformat() if 0 <= number < 1 and not from_1904 else moment.isoformat()


def text_of(value: str, kind: str, shared: list[str], dated: bool = False, from_1904: bool = False) -> str | None:
    """A cell's cached value as text: shared strings, booleans, ISO dates, whole numbers without a fraction."""
    if kind == "s":
        return shared[int(value)]
    if kind == "b":
        return "TRUE" if value == "1" else "FALSE"
    if kind in ("str", "inlineStr", "e", "d"):
        return value
    try:
        number = float(value)
        if dated:
            return date_of(number, from_1904)
    except (ValueError, OverflowError):
        return value
    if re.fullmatch("-?[0-9]+", value):
        return str(int(value))
    return str(int(number)) if number.is_integer() else repr(number)


def trimmed(text: str) -> str:
    return text[:MOST_TEXT] + MARK if len(text) > MOST_TEXT else text


@dataclass
class Book:
    """What the cells of all sheets of an .xlsx file refer to."""

    file: zipfile.ZipFile
    shared: list[str]
    styles: list[tuple[int, bool]]  # indent, shows a date
    sheets: list[tuple[str, str]]  # name, place in the file
    from_1904: bool


def _joined(node: ElementTree.Element) -> str:
    return "".join(t.text or "" for t in node.iter(f"{MAIN}t"))


def _elements(book: zipfile.ZipFile, name: str, wanted: str) -> Iterator[ElementTree.Element]:
    """The wanted elements of a file as its stream is read; what has been read is let go of."""
    with book.open(name) as stream:
        path: list[ElementTree.Element] = []
        for event, node in ElementTree.iterparse(stream, ("start", "end")):
            if event == "start":
                path.append(node)
                continue
            path.pop()
            if node.tag == wanted:
                yield node
            if path and not any(p.tag == wanted for p in path):
                path[-1].remove(node)


def open_book(content: bytes) -> Book:
    book = zipfile.ZipFile(io.BytesIO(content))
    files = set(book.namelist())
    xml = lambda name: ElementTree.fromstring(book.read(name))
    shared = [_joined(si) for si in _elements(book, "xl/sharedStrings.xml", f"{MAIN}si")] if "xl/sharedStrings.xml" in files else []
    styles: list[tuple[int, bool]] = []
    if "xl/styles.xml" in files:
        sheet = xml("xl/styles.xml")
        own = {int(f.get("numFmtId")): shows_date(f.get("formatCode", "")) for f in sheet.iter(f"{MAIN}numFmt")}
        formats = sheet.find(f"{MAIN}cellXfs")
        for xf in formats if formats is not None else []:
            alignment, number = xf.find(f"{MAIN}alignment"), int(xf.get("numFmtId", 0))
            styles.append((int(float(alignment.get("indent", 0))) if alignment is not None else 0, own.get(number, number in DATE_FORMATS)))
    targets = {r.get("Id"): r.get("Target") for r in xml("xl/_rels/workbook.xml.rels")}
    root = xml("xl/workbook.xml")
    settings = root.find(f"{MAIN}workbookPr")
    sheets = [(sheet.get("name"), targets[sheet.get(f"{REL}id")]) for sheet in root.iter(f"{MAIN}sheet")]
    places = [(name, target.lstrip("/") if target.startswith("/") else f"xl/{target}") for name, target in sheets]
    return Book(book, shared, styles, places, settings is not None and settings.get("date1904") in ("1", "true"))


def cells_of(book: Book, place_in_file: str) -> Iterator[dict]:
    """The non-empty cells of a sheet, one at a time."""
    for c in _elements(book.file, place_in_file, f"{MAIN}c"):
        inline, v = c.find(f"{MAIN}is"), c.find(f"{MAIN}v")
        raw = _joined(inline) if inline is not None else v.text if v is not None else None
        indent, dated = book.styles[style] if (style := int(c.get("s", 0))) < len(book.styles) else (0, False)
        text = None if raw is None else text_of(raw, c.get("t", "n"), book.shared, dated, book.from_1904)
        text = " ".join((text or "").split())
        if text:
            row, column = place(c.get("r"))
            yield {"row_index": row, "column_index": column, "cell_ref": c.get("r"), "cell_value_raw": trimmed(text), "indent_level": indent}


def merged_of(book: Book, place_in_file: str) -> list[str]:
    return [m.get("ref") for m in _elements(book.file, place_in_file, f"{MAIN}mergeCell")]


def read_workbook(content: bytes) -> Iterator[dict]:
    """The sheets of one workbook, numbered from 1, with their non-empty cells and merged ranges."""
    book = open_book(content)
    for index, (name, at) in enumerate(book.sheets, start=1):
        cells = list(cells_of(book, at))
        yield {
            "sheet_index": index, "sheet_name_raw": name, "max_row": max((c["row_index"] for c in cells), default=0), "max_column": max((c["column_index"] for c in cells), default=0),
            "raw_cells_json": json.dumps(cells, ensure_ascii=False), "merged_ranges_json": json.dumps(merged_of(book, at)),
        }


def sheets_of(content: bytes) -> Iterator[dict]:
    """The sheets of a workbook of either format, told apart by its first bytes."""
    if content[:8] == SIGNATURE:
        dated = lambda number, code: shows_date(code) if code is not None else number in DATE_FORMATS
        return read_old_workbook(content, dated, date_of, trimmed)
    return read_workbook(content)


def read_workbooks(files: DataFrame) -> DataFrame:
    """files (path, content) -> one row per sheet of .xlsx and .xls files; a file that cannot be read gives one row with its error."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = [f.split(" ")[0] for f in SCHEMA.split(", ")]
        for batch in batches:
            for path, content in zip(batch["path"], batch["content"]):
                try:
                    rows = [s | {"path": path, "parse_status": "success", "parse_error": None} for s in sheets_of(bytes(content))]
                except Exception as e:  # noqa: BLE001  one broken file must not end the job
                    rows = [{"path": path, "sheet_index": None, "sheet_name_raw": None, "max_row": None, "max_column": None, "raw_cells_json": None, "merged_ranges_json": None, "parse_status": "failed", "parse_error": str(e)[:500]}]
                yield pd.DataFrame(rows, columns=names).astype({k: "Int32" for k in ("sheet_index", "max_row", "max_column")})

    return files.filter(sniff(F.col("content"), F.col("path")).isin("xlsx", "xls")).select("path", "content").mapInPandas(run, SCHEMA)


CELLS = "path string, sheet_index int, sheet_name_raw string, row_index int, column_index int, cell_ref string, cell_value_raw string, indent_level int, merged_range string, parse_error string"
BATCH_CELLS = 10_000


def _streamed(content: bytes) -> Iterator[dict]:
    """Rows of CELLS without the path: cells as they are read, then the sheet's merged ranges."""
    if content[:8] == SIGNATURE:
        for sheet in sheets_of(content):
            own = {k: sheet[k] for k in ("sheet_index", "sheet_name_raw")}
            yield from (own | cell for cell in json.loads(sheet["raw_cells_json"]))
        return
    book = open_book(content)
    for index, (name, at) in enumerate(book.sheets, start=1):
        own = {"sheet_index": index, "sheet_name_raw": name}
        yield from (own | cell for cell in cells_of(book, at))
        yield from (own | {"merged_range": ref} for ref in merged_of(book, at))


def read_cells(files: DataFrame) -> DataFrame:
    """files (path, content) -> one row for each non-empty cell and each merged range, for sheets of any size.

    An .xlsx sheet is read as a stream and handed on in batches of BATCH_CELLS rows, so no sheet is held
    as a document or as one text; only the file's bytes and its shared strings are. A row has either a
    cell or a merged_range; a file that breaks off gives a row with its parse_error after the cells before it.
    """
    names = [c.split(" ")[0] for c in CELLS.split(", ")]
    kinds = pa.schema([(n, pa.int32() if n in ("sheet_index", "row_index", "column_index", "indent_level") else pa.string()) for n in names])

    def rows(path: str, content: bytes) -> Iterator[dict]:
        try:
            yield from ({"path": path} | r for r in _streamed(content))
        except Exception as e:  # noqa: BLE001  one broken file must not end the job
            yield {"path": path, "parse_error": str(e)[:500]}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content in zip(batch.column(0), batch.column(1)):
                found = rows(path.as_py(), content.as_py())
                while some := list(islice(found, BATCH_CELLS)):
                    yield pa.RecordBatch.from_pylist([{n: r.get(n) for n in names} for r in some], kinds)

    return files.filter(sniff(F.col("content"), F.col("path")).isin("xlsx", "xls")).select("path", "content").mapInArrow(run, CELLS)


CELL = "struct<row_index:int,column_index:int,cell_ref:string,cell_value_raw:string,indent_level:int>"
SAMPLE = 300  # texts of a sheet that settle its encoding


def repair_sheets(sheets: DataFrame) -> DataFrame:
    """sheets with what their cells tell: encoding, repaired texts, counts and warnings.

    The encoding is settled by the sheet's first SAMPLE texts and then holds for all of its cells,
    which get cell_value_unicode (legacy glyphs translated) and cell_value_normalized (without
    marks, known artefacts corrected). Sheets without cells stay as they are.
    """
    cells = F.from_json("raw_cells_json", f"array<{CELL}>")
    read = sheets.withColumn("_cells", cells)
    texts = F.transform(F.slice("_cells", 1, SAMPLE), lambda x: x["cell_value_raw"])
    found = read.withColumn("detected_text_encoding", F.when(F.col("_cells").isNotNull(), encoding_from_hits(legacy_hits(F.array_join(texts, " ")))))
    legacy = F.col("detected_text_encoding") == "tcvn3"

    def repaired(x: Column) -> Column:
        unicode = repair_unicode(x["cell_value_raw"], legacy)
        return F.struct(*[x[f].alias(f) for f in ("row_index", "column_index", "cell_ref", "cell_value_raw", "indent_level")], unicode.alias("cell_value_unicode"), normalized_cell(unicode).alias("cell_value_normalized"))

    first = lambda field: F.array_min(F.transform("_cells", lambda x: x[field]))
    warning = F.when(legacy, F.array(F.lit("legacy_tcvn3_font_detected_and_converted"))).when(F.col("detected_text_encoding") != "unicode", F.array(F.lit("possible_legacy_font_low_confidence_not_converted"))).otherwise(F.array().cast("array<string>"))
    return found.select(
        *[F.to_json(F.transform("_cells", repaired)).alias(c) if c == "raw_cells_json" else F.col(c) for c in sheets.columns],
        normalize_name(F.col("sheet_name_raw")).alias("sheet_name_normalized"), F.coalesce(F.size("_cells"), F.lit(0)).alias("non_empty_cell_count"), first("row_index").alias("first_non_empty_row"), first("column_index").alias("first_non_empty_column"),
        F.to_json(warning).alias("parse_warnings_json"), "detected_text_encoding",
    )


def load_workbooks(spark: SparkSession, path: str) -> DataFrame:
    """Sheets of all .xlsx and .xls files under a path, their texts repaired."""
    return repair_sheets(read_workbooks(spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)))
