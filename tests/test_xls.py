"""Old binary workbooks, written here record by record."""

import json
import struct

import pytest
from test_sources import workbook

from gridloom.sources import xls
from gridloom.sources import xlsx as X

FREE, ENDED = 0xFFFFFFFF, 0xFFFFFFFE


def record(number, data=b""):
    return struct.pack("<2H", number, len(data)) + data


def text(value, length="<H", wide=True):
    return struct.pack(length, len(value)) + bytes([wide]) + (value.encode("utf-16-le") if wide else value.encode("latin-1"))


def compound(stream, loop=False, cut=False):
    """A compound file with one stream, in short sectors where it is short."""
    short = len(stream) < 4096
    body = stream.ljust(-(-len(stream) // 64) * 64, b"\0") if short else stream
    n = max(1, -(-len(body) // 512))
    data = body.ljust(n * 512, b"\0")
    chain = [*range(3, 2 + n), ENDED]  # the data begins in sector 2
    mini = [*range(1, len(body) // 64), ENDED] if short else []
    table = [0xFFFFFFFD, ENDED, *chain, ENDED] + [FREE] * 128
    if loop:
        table[2] = 2
    mini_at = 2 + n
    entry = lambda name, kind, start, size: (name.encode("utf-16-le") + b"\0\0").ljust(64, b"\0") + struct.pack("<HBB", 2 * len(name) + 2, kind, 1) + b"\xff" * 12 + b"\0" * 36 + struct.pack("<3I", start, size, 0)
    root = entry("Root Entry", 5, 2 if short else ENDED, len(body) if short else 0)
    directory = (root + entry("Workbook", 2, 0 if short else 2, len(stream))).ljust(512, b"\0")
    header = xls.SIGNATURE + b"\0" * 16 + struct.pack("<5H", 0x3E, 3, 0xFFFE, 9, 6) + b"\0" * 10 + struct.pack("<3I", 1, 1, 0) + struct.pack("<I", 4096) + struct.pack("<4I", mini_at if short else ENDED, int(short), ENDED, 0)
    header += struct.pack("<109I", 0, *[FREE] * 108)
    out = header + struct.pack("<128I", *table[:128]) + directory + data
    if short:
        out += struct.pack("<128I", *(mini + [FREE] * 128)[:128])
    return out[: 512 * 3 + 100] if cut else out


def globals_and(sheets, strings, pad=0, formats=(), split=None, first=0x600):
    """Workbook stream of (name, records, kind) sheets; strings: bytes of the shared strings' records."""
    head = record(xls.BEGIN, struct.pack("<2H", first, 5) + b"\0" * 12) + record(xls.DATE_MODE, b"\0\0")
    head += b"".join(record(xls.FORMAT, struct.pack("<H", n) + text(code)) for n, code in formats)
    for number, indent in ((0, 0), (0, 2), (14, 0), (170, 0), (171, 0)):
        head += record(xls.XF, struct.pack("<3H", 0, number, 0) + bytes([0, 0, indent]) + b"\0" * 11)
    head += b"".join(strings) + record(0x200, b"\0" * pad)
    names = [record(xls.SHEET, struct.pack("<IBB", 0, 0, kind) + text(name, "<B")) for name, _, kind in sheets]
    at = len(head) + sum(map(len, names)) + 4
    placed, bodies = b"", b""
    for (name, body, kind), _ in zip(sheets, names):
        placed += record(xls.SHEET, struct.pack("<IBB", at + len(bodies), 0, kind) + text(name, "<B"))
        bodies += record(xls.BEGIN, struct.pack("<2H", 0x600, 16) + b"\0" * 12) + body + record(xls.END)
    return head + placed + record(xls.END) + bodies


def at(number, row, column, style, data):
    return record(number, struct.pack("<3H", row, column, style) + data)


def rk(integer, hundredths=False):
    return struct.pack("<I", (integer << 2 | 2 | hundredths) & 0xFFFFFFFF)


def strings_of(*texts):
    return [record(xls.STRINGS, struct.pack("<2I", len(texts), len(texts)) + b"".join(texts))]


def twin(pad=0):
    """The sheet of test_sources.workbook() in the old format."""
    cells = (
        at(xls.INDEXED, 0, 0, 0, struct.pack("<I", 0)) + at(xls.INDEXED, 0, 1, 1, struct.pack("<I", 1)) + at(xls.NUMBER, 1, 26, 0, struct.pack("<d", 12.0)) + at(xls.SHORT_NUMBER, 1, 27, 0, rk(150, True))
        + at(xls.FORMULA, 1, 28, 0, bytes([0, 0, 0, 0, 0, 0, 255, 255]) + b"\0" * 6) + record(xls.RESULT, text("TRUE")) + at(xls.LABEL, 1, 29, 0, text(" x  y ", wide=False))
        + at(xls.SHORT_NUMBER, 2, 0, 2, rk(45291)) + at(xls.NUMBER, 2, 1, 3, struct.pack("<d", 45291.5)) + at(xls.SHORT_NUMBER, 2, 2, 4, rk(45291)) + at(xls.NUMBER, 2, 3, 2, struct.pack("<d", 0.25))
    )
    return compound(globals_and([("chart", b"", 2), ("GDP", cells, 0)], strings_of(text("Tong", wide=False), text("Chi tieu")), pad, [(170, "dd\\/mm\\/yyyy;@"), (171, '[Red]0.0" day"')]))


@pytest.mark.parametrize("pad", [0, 8000])
def test_equal_to_the_new_format(pad):
    (old,), (new,) = list(X.sheets_of(twin(pad))), list(X.sheets_of(workbook()))
    known = [c for c in json.loads(new["raw_cells_json"]) if c["cell_ref"] not in ("E3", "F3")]
    assert json.loads(old["raw_cells_json"]) == known and old["sheet_name_raw"] == "GDP" and old["sheet_index"] == 1
    assert (old["max_row"], old["max_column"]) == (3, 30)


def test_strings_over_several_records():
    rich = struct.pack("<HB", 3, 8) + struct.pack("<H", 1) + b"abc" + b"\1\2\3\4"
    first = struct.pack("<2I", 4, 4) + text("one", wide=False) + struct.pack("<HB", 6, 1) + "Chỉ".encode("utf-16-le")
    parts = [record(xls.STRINGS, first), record(xls.CONTINUE, b"\0" + b" so" + rich[:-2]), record(xls.CONTINUE, rich[-2:] + struct.pack("<HBI", 1, 5, 3) + "đ".encode("utf-16-le") + b"\0\0\0")]
    cells = b"".join(at(xls.INDEXED, i, 0, 0, struct.pack("<I", i)) for i in range(4))
    (sheet,) = X.sheets_of(compound(globals_and([("Bảng", cells, 0)], parts)))
    assert [c["cell_value_raw"] for c in json.loads(sheet["raw_cells_json"])] == ["one", "Chỉ so", "abc", "đ"] and sheet["sheet_name_raw"] == "Bảng"


def test_numbers_charts_and_broken_pairs():
    assert [xls.short_number(struct.unpack("<I", b)[0]) for b in (rk(-5), rk(-1234, True), struct.pack("<d", 0.75)[4:])] == [-5.0, -12.34, 0.75]
    chart = record(xls.BEGIN, b"\0" * 16) + at(xls.NUMBER, 9, 9, 0, struct.pack("<d", 1.0)) + record(xls.END)
    several = record(xls.MULTIPLE, struct.pack("<2H", 4, 1) + b"".join(struct.pack("<H", s) + rk(n) for s, n in ((0, 7), (1, 8))) + struct.pack("<H", 2))
    lone = at(xls.LABEL, 5, 0, 0, struct.pack("<HB", 2, 1) + b"\x00\xd8a\0")
    cells = chart + several + lone + at(xls.BOOLEAN, 6, 0, 0, b"\1\0") + at(xls.FORMULA, 6, 1, 0, struct.pack("<d", 2.5) + b"\0" * 6) + at(xls.NUMBER, 4, 1, 0, struct.pack("<d", 70.0))
    (sheet,) = X.sheets_of(compound(globals_and([("s", cells, 0)], [])))
    assert {c["cell_ref"]: (c["cell_value_raw"], c["indent_level"]) for c in json.loads(sheet["raw_cells_json"])} == {"B5": ("70", 0), "C5": ("8", 2), "A6": ("�a", 0), "A7": ("1", 0), "B7": ("2.5", 0)}
    assert [xls.column_letters(n) for n in (1, 26, 27, 702, 703)] == ["A", "Z", "AA", "ZZ", "AAA"]


def test_files_of_both_formats_and_broken_ones(spark, tmp_path):
    stream = globals_and([("s", b"", 0)], [], 9000)
    files = {
        "a.xlsx": workbook(), "b.xls": twin(), "loop.xls": compound(stream, loop=True), "cut.xls": compound(stream, cut=True), "empty.xls": xls.SIGNATURE, "text.xls": b"plain",
        "older.xls": compound(globals_and([("s", b"", 0)], [], first=0x500)), "locked.xls": compound(globals_and([("s", b"", 0)], [record(xls.PASSWORD, b"\0\0")])),
    }
    for name, content in files.items():
        (tmp_path / name).write_bytes(content)
    rows = {r.path.rsplit("/", 1)[1]: r for r in X.load_workbooks(spark, str(tmp_path)).collect()}
    assert {n for n, r in rows.items() if r.parse_status == "success"} == {"a.xlsx", "b.xls"} and set(rows) == set(files)
    assert rows["b.xls"].sheet_name_normalized == "gdp" and rows["b.xls"].non_empty_cell_count == 10
    assert "chain" in rows["loop.xls"].parse_error and "outside" in rows["cut.xls"].parse_error and "encrypted" in rows["locked.xls"].parse_error
