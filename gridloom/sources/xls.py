"""Old binary workbooks (.xls): the compound file, its workbook stream and the records of its sheets."""

from __future__ import annotations

import json
import struct
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

SIGNATURE = bytes.fromhex("D0CF11E0A1B11AE1")
LAST = 0xFFFFFFFA  # sector numbers from here on are marks, not sectors
#: Record numbers of the workbook stream; fixed values.
FORMULA, END, DATE_MODE, PASSWORD, CONTINUE, SHEET, MULTIPLE, RICH, XF, STRINGS, INDEXED, NUMBER, LABEL, BOOLEAN, RESULT, SHORT_NUMBER, FORMAT, BEGIN = (
    0x06, 0x0A, 0x22, 0x2F, 0x3C, 0x85, 0xBD, 0xD6, 0xE0, 0xFC, 0xFD, 0x203, 0x204, 0x205, 0x207, 0x27E, 0x41E, 0x809,
)


class BrokenFile(ValueError):
    pass


class CompoundFile:
    """Streams of a compound file by name; chains of sectors that loop or leave the file are errors."""

    def __init__(self, content: bytes):
        if content[:8] != SIGNATURE or len(content) < 512:
            raise BrokenFile("not a compound file")
        self.content = content
        self.size, self.mini_size = (1 << s for s in struct.unpack_from("<2H", content, 30))
        if self.size not in (512, 4096) or self.mini_size > self.size:
            raise BrokenFile("unknown sector size")
        directory, self.least = struct.unpack_from("<I", content, 48)[0], struct.unpack_from("<I", content, 56)[0]
        mini_start, _, more, n_more = struct.unpack_from("<4I", content, 60)
        tables = list(struct.unpack_from("<109I", content, 76))
        per = self.size // 4
        for _ in range(n_more):
            if more >= LAST:
                break
            numbers = struct.unpack(f"<{per}I", self._sector(more))
            tables += numbers[:-1]
            more = numbers[-1]
        self.next: list[int] = []
        for t in tables:
            if t < LAST:
                self.next += struct.unpack(f"<{per}I", self._sector(t))
        entries = self._chain(directory)
        self.entries = {}
        mini = b""
        for at in range(0, len(entries) - 127, 128):
            length, kind = struct.unpack_from("<HB", entries, at + 64)
            start, size = struct.unpack_from("<2I", entries, at + 116)
            if kind == 5:
                mini = self._chain(start)[:size] if start < LAST else b""
            elif kind == 2:
                name = entries[at : at + max(0, min(length, 64) - 2)].decode("utf-16-le", "replace")
                self.entries[name.lower()] = start, size
        self.mini = mini
        table = self._chain(mini_start) if mini_start < LAST else b""
        self.next_mini = struct.unpack(f"<{len(table) // 4}I", table)

    def _sector(self, number: int) -> bytes:
        at = (number + 1) * self.size
        found = self.content[at : at + self.size]
        if not found:
            raise BrokenFile(f"sector {number} lies outside the file")
        return found.ljust(self.size, b"\0")

    def _chain(self, start: int) -> bytes:
        out, at = [], start
        while at < LAST:
            if at >= len(self.next) or len(out) > len(self.next):
                raise BrokenFile("broken chain of sectors")
            out.append(self._sector(at))
            at = self.next[at]
        return b"".join(out)

    def stream(self, name: str) -> bytes:
        if name.lower() not in self.entries:
            raise BrokenFile(f"no stream {name}")
        start, size = self.entries[name.lower()]
        if size >= self.least:
            return self._chain(start)[:size]
        out, at = [], start
        while at < LAST:
            if at >= len(self.next_mini) or len(out) > len(self.next_mini):
                raise BrokenFile("broken chain of short sectors")
            out.append(self.mini[at * self.mini_size : (at + 1) * self.mini_size])
            at = self.next_mini[at]
        return b"".join(out)[:size]


def records(stream: bytes, at: int = 0) -> Iterator[tuple[int, list[bytes]]]:
    """(number, data with that of the records that continue it) from a place on; a cut record ends the stream."""
    found: tuple[int, list[bytes]] | None = None
    while at + 4 <= len(stream):
        number, size = struct.unpack_from("<2H", stream, at)
        data = stream[at + 4 : at + 4 + size]
        at += 4 + size
        if number == CONTINUE and found:
            found[1].append(data)
            continue
        if found:
            yield found
        found = number, [data]
    if found:
        yield found


class Pieces:
    """Data that runs over several records; the characters of a string begin anew, with a mark of their width, in each."""

    def __init__(self, parts: list[bytes]):
        self.parts, self.part, self.at = parts, 0, 0

    def _here(self) -> bytes:
        while self.part < len(self.parts) and self.at >= len(self.parts[self.part]):
            self.part, self.at = self.part + 1, 0
        if self.part >= len(self.parts):
            raise BrokenFile("strings end too early")
        return self.parts[self.part]

    def take(self, n: int) -> bytes:
        out = b""
        while len(out) < n:
            own = self._here()
            got = own[self.at : self.at + n - len(out)]
            out, self.at = out + got, self.at + len(got)
        return out

    def text(self, length_bytes: int = 2) -> str:
        n, marks = int.from_bytes(self.take(length_bytes), "little"), self.take(1)[0]
        runs = int.from_bytes(self.take(2), "little") if marks & 8 else 0
        extra = int.from_bytes(self.take(4), "little") if marks & 4 else 0
        wide, out = marks & 1, []
        while n:
            if self.at >= len(self.parts[self.part]):
                own = self._here()
                wide, self.at = own[self.at] & 1, self.at + 1
            own = self.parts[self.part]
            some = min(n, (len(own) - self.at) // (2 if wide else 1))
            if not some:
                raise BrokenFile("a string is cut inside a character")
            raw = self.take(some * (2 if wide else 1))
            out.append(raw if wide else raw.decode("latin-1").encode("utf-16-le"))
            n -= some
        self.take(4 * runs + extra)
        return b"".join(out).decode("utf-16-le", "replace")


def short_number(rk: int) -> float:
    """A number of 30 bits: the upper bits of a double or an integer, either of them perhaps in hundredths."""
    if rk & 2:
        number = float((rk - (1 << 32) if rk >> 31 else rk) >> 2)
    else:
        number = struct.unpack("<d", struct.pack("<Q", (rk & 0xFFFFFFFC) << 32))[0]
    return number / 100 if rk & 1 else number


@dataclass
class Globals:
    strings: list[str] = field(default_factory=list)
    codes: dict[int, str] = field(default_factory=dict)
    styles: list[tuple[int, int]] = field(default_factory=list)  # number format, indent
    sheets: list[tuple[str, int]] = field(default_factory=list)  # name, place
    from_1904: bool = False


def read_globals(stream: bytes) -> Globals:
    out = Globals()
    for i, (number, parts) in enumerate(records(stream)):
        data = parts[0]
        if i == 0 and (number != BEGIN or struct.unpack_from("<H", data)[0] != 0x600):
            raise BrokenFile("not a workbook of the format of 1997 and later")
        if number == PASSWORD:
            raise BrokenFile("the workbook is encrypted")
        if number == DATE_MODE:
            out.from_1904 = data[:2] == b"\1\0"
        elif number == FORMAT:
            out.codes[struct.unpack_from("<H", data)[0]] = Pieces([data[2:], *parts[1:]]).text()
        elif number == XF:
            out.styles.append((struct.unpack_from("<H", data, 2)[0], data[8] & 15 if len(data) > 8 else 0))
        elif number == SHEET and data[5] == 0:  # a worksheet, hidden or not
            out.sheets.append((Pieces([data[6:]]).text(1), struct.unpack_from("<I", data)[0]))
        elif number == STRINGS:
            texts = Pieces([data[8:], *parts[1:]])
            out.strings = [texts.text() for _ in range(struct.unpack_from("<I", data, 4)[0])]
        elif number == END:
            break
    return out


def read_cells(stream: bytes, at: int, strings: list[str]) -> dict[tuple[int, int], tuple[float | str, int]]:
    """(row, column) from 0 -> value and style of a sheet's cells; booleans and errors are their numbers."""
    cells: dict[tuple[int, int], tuple[float | str, int]] = {}
    depth, waiting = 0, None
    for number, parts in records(stream, at):
        data = parts[0]
        if number == BEGIN:
            depth += 1
        elif number == END:
            depth -= 1
            if not depth:
                break
        elif depth != 1:  # inside a chart
            continue
        elif number in (NUMBER, SHORT_NUMBER, INDEXED, LABEL, RICH, BOOLEAN, FORMULA):
            row, column, style = struct.unpack_from("<3H", data)
            if number == NUMBER:
                value = struct.unpack_from("<d", data, 6)[0]
            elif number == SHORT_NUMBER:
                value = short_number(struct.unpack_from("<I", data, 6)[0])
            elif number == INDEXED:
                value = strings[struct.unpack_from("<I", data, 6)[0]]
            elif number == BOOLEAN:
                value = float(data[6])
            elif number != FORMULA:
                value = Pieces([data[6:], *parts[1:]]).text()
            elif data[12:14] != b"\xff\xff":
                value = struct.unpack_from("<d", data, 6)[0]
            elif data[6] in (1, 2):
                value = float(data[8])
            else:  # text follows in a record of its own
                waiting = (row, column, style) if data[6] == 0 else None
                continue
            cells[row, column] = value, style
        elif number == MULTIPLE:
            row, first = struct.unpack_from("<2H", data)
            for i in range((len(data) - 6) // 6):
                style, rk = struct.unpack_from("<HI", data, 4 + 6 * i)
                cells[row, first + i] = short_number(rk), style
        elif number == RESULT and waiting:
            cells[waiting[0], waiting[1]] = Pieces(parts).text(), waiting[2]
            waiting = None
    return cells


def column_letters(column: int) -> str:
    """Letters of a column counted from 1."""
    out = ""
    while column:
        column, rest = divmod(column - 1, 26)
        out = chr(65 + rest) + out
    return out


def read_old_workbook(content: bytes, dated: Callable[[int, str | None], bool], date_of: Callable[[float, bool], str], trimmed: Callable[[str], str]) -> Iterator[dict]:
    """The sheets of one .xls workbook, numbered from 1, with their non-empty cells row by row; merged ranges are not told.

    dated says whether a number format (number, code) shows dates; indents come from the cell styles.
    """
    stream = CompoundFile(content).stream("Workbook")
    book = read_globals(stream)
    shows_date = [dated(number, book.codes.get(number)) for number, _ in book.styles]
    for index, (name, at) in enumerate(book.sheets, start=1):
        cells = []
        for (row, column), (value, style) in sorted(read_cells(stream, at, book.strings).items()):
            if not isinstance(value, str):
                try:
                    value = date_of(value, book.from_1904) if style < len(shows_date) and shows_date[style] else str(int(value)) if value.is_integer() else repr(value)
                except (ValueError, OverflowError):
                    value = repr(value)
            text = " ".join(value.split())
            if text:
                indent = book.styles[style][1] if style < len(book.styles) else 0
                cells.append({"row_index": row + 1, "column_index": column + 1, "cell_ref": f"{column_letters(column + 1)}{row + 1}", "cell_value_raw": trimmed(text), "indent_level": indent})
        yield {
            "sheet_index": index, "sheet_name_raw": name, "max_row": max((c["row_index"] for c in cells), default=0), "max_column": max((c["column_index"] for c in cells), default=0),
            "raw_cells_json": json.dumps(cells, ensure_ascii=False), "merged_ranges_json": "[]",
        }
