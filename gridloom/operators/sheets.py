"""Tables rebuilt where a sheet lies: its cells stay in one array, so no cell is dealt, sorted or joined.

The rules are those of `grid`, which has a row for each cell. A sheet's rows are an array of row, data and cells,
in order; cells (row, col, value, indent, number) are in order too. Columns of a sheet are an array of their
numbers, and what is known of each is an array in the same order. What stands above the data is the sheet's head;
many sheets have the same, so what follows from it is derived once for each that there is.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import units as U
from ..functions.bind import let
from ..functions.numbers import column_index, looks_like_year, to_number
from ..functions.text import clean_cell, norm
from ..settle import settled_columns
from .grid import BODY_ROWS, DITTO, HEADER_ROWS, NO_DATA_ROWS, TITLE_ROWS

CELLS = "array<struct<row_index:int,column_index:int,cell_value_raw:string,indent_level:int,cell_value_normalized:string>>"
RANGE = r"^([A-Z]+)([0-9]+):([A-Z]+)([0-9]+)$"
ENTRY = "struct<value:string,number:double>"
HEAD = "struct<name:string,title:string,ranges:string,cols:array<int>,top:array<struct<row:int,cells:array<struct<col:int,value:string>>>>>"
#: Heads, and columns of all of them, up to which their names are broadcast; beyond that every sheet derives its own.
BROADCAST_HEADS, BROADCAST_COLUMNS = 10_000, 200_000

#: is_ditto of a text that is clean already, by one pattern.
DITTO_TEXT = r"(?i)^[ ._-]*(?:" + "|".join(re.escape(mark) for mark in DITTO) + r")[ ._-]*\z"


def runs(items: Column, key: str) -> Column:
    """Arrays of neighbours with the same key, of an array in order of it."""

    def cut(a: Column) -> Column:
        places = F.filter(F.transform(a, lambda x, i: F.when((i == 0) | ~x[key].eqNullSafe(F.get(a, i - 1)[key]), i)), lambda i: i.isNotNull())
        return let(places, lambda p: F.transform(p, lambda at, i: F.slice(a, at + 1, F.coalesce(F.get(p, i + 1), F.size(a)) - at)))

    return let(items, cut)


def place(cols: Column, col: Column) -> Column:
    """Where a column stands in the sheet's columns, from 0; at once where they have no gap."""
    near = col - F.get(cols, F.lit(0))
    return F.when(F.get(cols, near) == col, near).otherwise(F.array_position(cols, col).cast("int") - 1)


def read_rows(sheets: DataFrame, json_col: str = "raw_cells_json") -> DataFrame:
    """sheets with cols, rows and first in place of the JSON; first is the place of the first data row, from 1, or 0.

    Data rows hold a text and a number that is no year. Cells without a row or column have no place and are left out.
    """

    def cell(x: Column) -> Column:
        value = clean_cell(F.coalesce(F.nullif(x["cell_value_normalized"], F.lit("")), x["cell_value_raw"]))
        return F.struct(x["row_index"].alias("row"), x["column_index"].alias("col"), value.alias("value"), F.coalesce(x["indent_level"], F.lit(0)).alias("indent"))

    def typed(x: Column) -> Column:
        return F.struct(x["row"].alias("row"), x["col"].alias("col"), x["value"].alias("value"), x["indent"].alias("indent"), to_number(x["value"]).alias("number"))

    def row(cells: Column) -> Column:
        data = F.exists(cells, lambda x: x["number"].isNull()) & F.exists(cells, lambda x: x["number"].isNotNull() & ~looks_like_year(x["value"]))
        return F.struct(cells[0]["row"].alias("row"), data.alias("data"), cells.alias("cells"))

    read = F.filter(F.transform(F.from_json(json_col, CELLS), cell), lambda x: (x["value"] != "") & x["row"].isNotNull() & x["col"].isNotNull())
    cells = sheets.withColumn("_cells", F.transform(F.sort_array(read), typed)).drop(json_col)
    shaped = cells.withColumn("rows", F.transform(runs(F.col("_cells"), "row"), row)).withColumn("cols", F.sort_array(F.array_distinct(F.transform("_cells", lambda x: x["col"])))).drop("_cells")
    return shaped.withColumn("first", F.array_position(F.transform("rows", lambda r: r["data"]), True).cast("int"))


def read_ranges(json_col: str) -> Column:
    """r1, r2, c1, c2 of merged ranges such as "C4:D4", in their order; all else is left out."""

    def corner(text: Column) -> Column:
        part = lambda i: F.regexp_extract(text, RANGE, i)
        return F.struct(part(2).try_cast("int").alias("a"), part(4).try_cast("int").alias("b"), column_index(part(1)).alias("c"), column_index(part(3)).alias("d"))

    good = F.filter(F.transform(F.from_json(json_col, "array<string>"), lambda t: F.upper(F.trim(t))), lambda t: t.rlike(RANGE))
    sides = lambda x: F.struct(F.least(x["a"], x["b"]).alias("r1"), F.greatest(x["a"], x["b"]).alias("r2"), F.least(x["c"], x["d"]).alias("c1"), F.greatest(x["c"], x["d"]).alias("c2"))
    return F.coalesce(F.transform(F.transform(good, corner), sides), F.array().cast("array<struct<r1:int,r2:int,c1:int,c2:int>>"))


def head(name: Column, title: Column, ranges_json: Column) -> Column:
    """What names the columns of a sheet, as JSON: all rows before the first data row, or the first five of a sheet without data rows."""
    above = F.when(F.col("first") > 0, F.slice("rows", 1, F.greatest(F.col("first") - 1, F.lit(0)))).otherwise(F.slice("rows", 1, NO_DATA_ROWS))
    top = F.transform(above, lambda r: F.struct(r["row"].alias("row"), F.transform(r["cells"], lambda x: F.struct(x["col"].alias("col"), x["value"].alias("value"))).alias("cells")))
    return F.to_json(F.struct(name.alias("name"), title.alias("title"), ranges_json.alias("ranges"), F.col("cols"), top.alias("top")))


def read_heads(heads: DataFrame) -> DataFrame:
    """heads (head and more) with its name, title and cols, its rows top, those that are labels, and their spans filled."""
    typed = lambda x: F.struct(x["col"].alias("col"), x["value"].alias("value"), to_number(x["value"]).alias("number"))
    opened = heads.withColumn("_h", F.from_json("head", HEAD)).select(*heads.columns, "_h.name", "_h.title", "_h.cols", read_ranges("_h.ranges").alias("ranges"), F.col("_h.top").alias("_top"))
    rows = F.transform("_top", lambda r: F.struct(r["row"].alias("row"), F.transform(r["cells"], typed).alias("cells")))
    labels = opened.withColumn("top", rows).drop("_top").withColumn("labels", label_rows(F.col("top")))
    return labels.withColumn("spans", expand_headers(F.col("labels"), F.col("cols"), F.col("ranges")))


def with_heads(sheets: DataFrame, derive: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """sheets (head and more) with title, cols and what derive adds to read_heads: once for each head, or sheet by sheet where there are too many.

    sheets are read twice, so they should be settled.
    """
    parts = ("name", "ranges", "top", "labels", "spans")
    heads = settled_columns(sheets.select("head").distinct())
    found = heads.select(F.size(F.from_json("head", HEAD)["cols"]).alias("n")).agg(F.count("*").alias("heads"), F.sum("n").alias("cols")).first()
    if found["heads"] > BROADCAST_HEADS or (found["cols"] or 0) > BROADCAST_COLUMNS:
        return derive(read_heads(sheets)).drop(*parts)
    return sheets.join(F.broadcast(derive(read_heads(heads)).drop(*parts)), "head")


def label_rows(top: Column) -> Column:
    """The header rows that name columns: of the last seven rows of a head those of two cells and more, or all where there is none."""
    header = F.slice(top, F.greatest(F.size(top) - HEADER_ROWS + 1, F.lit(1)), HEADER_ROWS)
    return let(header, lambda h: let(F.filter(h, lambda r: F.size(r["cells"]) >= 2), lambda many: F.when(F.size(many) > 0, many).otherwise(h)))


def expand_headers(labels: Column, cols: Column, ranges: Column) -> Column:
    """For each label row and column of the sheet its entries (value, number): one, or none where it stays empty.

    Merged ranges come first: the text at a row's left end fills the row's empty cells. Then a text
    fills empty cells to its right up to the next occupied one, in columns that have header text on
    some header row. Numbers stop a fill and do not fill, except that a year fills a merged range.
    """
    none = F.array().cast(f"array<{ENTRY}>")
    entry = lambda x: F.struct(x["value"].alias("value"), x["number"].alias("number"))
    texts = F.array_distinct(F.flatten(F.transform(labels, lambda r: F.transform(F.filter(r["cells"], lambda x: x["number"].isNull()), lambda x: x["col"]))))

    def expand(r: Column, named: Column) -> Column:
        source = lambda m: F.filter(r["cells"], lambda x: (x["col"] == m["c1"]) & (x["number"].isNull() | looks_like_year(x["value"])))
        over = F.filter(ranges, lambda m: (m["c2"] > m["c1"]) & (m["r1"] <= r["row"]) & (m["r2"] >= r["row"]))
        spans = F.filter(F.transform(over, lambda m: F.struct(m["c1"].alias("c1"), m["c2"].alias("c2"), F.get(source(m), F.lit(0)).alias("x"))), lambda s: s["x"].isNotNull())
        return let(spans, lambda s: let(runs(r["cells"], "col"), lambda taken: F.concat(before(taken), F.flatten(F.transform(taken, lambda own, i: gap(own, F.get(taken, i + 1), s, named))))))

    def before(taken: Column) -> Column:
        return F.transform(F.slice(cols, 1, place(cols, taken[0][0]["col"])), lambda k: none)

    def gap(own: Column, after: Column, spans: Column, named: Column) -> Column:
        """A column's own entries and those of the empty columns behind it."""
        last = F.element_at(own, -1)
        start, stop = place(cols, last["col"]) + 1, F.coalesce(place(cols, after[0]["col"]), F.size(cols))

        def fill(k: Column) -> Column:
            merged = F.get(F.filter(spans, lambda s: (s["c1"] <= k) & (s["c2"] >= k)), F.lit(0))["x"]
            held = F.when(last["number"].isNull() & F.array_contains(named, k), last)
            return let(F.coalesce(merged, held), lambda x: F.when(x.isNotNull(), F.array(entry(x))).otherwise(none))

        return F.concat(F.array(F.transform(own, entry)), F.transform(F.slice(cols, start + 1, F.greatest(stop - start, F.lit(0))), fill))

    return let(texts, lambda named: F.transform(labels, lambda r: expand(r, named)))


def header_names(expanded: Column, cols: Column) -> Column:
    """The name of every column: header texts from top to bottom joined by " / ".

    Numbers are left out except years, which read "nam YYYY" and take the place of a bare "nam" just
    above; texts that fold to one already there are left out; a column without any is column_N.
    """
    empty = F.array().cast("array<string>")
    start = F.struct(empty.alias("parts"), empty.alias("seen"), F.lit("").alias("last"))

    def titled(x: Column) -> Column:
        year = F.concat(F.lit("nam "), clean_cell(x["value"]))
        return F.when(x["number"].isNotNull(), F.struct(year.alias("text"), year.alias("key"), F.lit(True).alias("year"))).otherwise(F.struct(x["value"].alias("text"), norm(x["value"]).alias("key"), F.lit(False).alias("year")))

    def step(acc: Column, h: Column) -> Column:
        absorbed = h["year"] & (acc["last"] == "nam")
        kept = F.when(absorbed, F.slice(acc["parts"], 1, F.greatest(F.size(acc["parts"]) - 1, F.lit(0)))).otherwise(acc["parts"])
        pushed = F.struct(F.concat(kept, F.array(h["text"])).alias("parts"), F.concat(acc["seen"], F.array(h["key"])).alias("seen"), h["key"].alias("last"))
        return F.when(absorbed | ~F.array_contains(acc["seen"], h["key"]), pushed).otherwise(acc)

    def name(k: Column, i: Column) -> Column:
        listed = F.filter(stack(expanded, i), lambda x: x["number"].isNull() | looks_like_year(x["value"]))
        joined = F.array_join(F.aggregate(F.transform(listed, titled), start, step)["parts"], " / ")
        return F.coalesce(F.nullif(joined, F.lit("")), F.concat(F.lit("column_"), k.cast("string")))

    return F.transform(cols, name)


def stack(expanded: Column, i: Column) -> Column:
    """The entries of the column at place i from top to bottom."""
    return F.flatten(F.transform(expanded, lambda row: F.get(row, i)))


def header_units(expanded: Column, cols: Column) -> Column:
    """The unit of every column: of its lowest header cell that names one."""
    return F.transform(cols, lambda k, i: F.element_at(F.concat(F.array(F.lit(None).cast("string")), F.filter(F.transform(stack(expanded, i), lambda x: U.unit_from_text(x["value"])), lambda u: u.isNotNull())), -1))


def lines(rows: Column) -> Column:
    """Each of the first 12 rows as one line."""
    return F.transform(F.slice(rows, 1, BODY_ROWS), line)


def line(r: Column) -> Column:
    return F.array_join(F.transform(r["cells"], lambda x: x["value"]), " | ")


def title(rows: Column) -> Column:
    """Up to three text-only rows of the first six, or null."""
    plain = F.filter(F.slice(rows, 1, TITLE_ROWS), lambda r: (F.size(r["cells"]) <= 5) & ~F.exists(r["cells"], lambda x: x["number"].isNotNull()))
    return F.nullif(F.array_join(F.transform(F.slice(plain, 1, 3), line), " | "), F.lit(""))


def filled_texts(rows: Column, labels: Column, expanded: Column) -> Column:
    """The texts of each row, header cells with their spans filled."""
    spread = F.transform(labels, lambda r, i: F.struct(r["row"].alias("row"), F.transform(F.flatten(F.get(expanded, i)), lambda x: x["value"]).alias("texts")))
    own = lambda r: F.transform(r["cells"], lambda x: x["value"])
    return let(spread, lambda s: F.transform(rows, lambda r: F.coalesce(F.get(F.filter(s, lambda x: x["row"].eqNullSafe(r["row"])), F.lit(0))["texts"], own(r))))


def explicit_unit(texts: Column) -> Column:
    """The unit of the first "unit:" cell before the data that has one; texts are those of filled_texts."""
    found = lambda row: F.transform(row, lambda t, i: F.when(norm(t).rlike(U.CAPTION), U.unit_from_caption(t, [F.get(row, i + n) for n in (1, 2, 3)])))
    units = F.filter(F.flatten(F.transform(texts, found)), lambda u: u.isNotNull())
    # a cell with a caption shows in the texts as one, which is tested first
    return F.when(norm(F.array_join(F.flatten(texts), "\n")).rlike(U.CAPTION), F.get(units, F.lit(0)))


def unit_column(data: Column) -> Column:
    """The column of data cells that are mostly units and ditto marks, or null; data are the rows from the first data row on.

    At least four cells, two ditto marks and a share of 0.6; the best share wins, then the leftmost.
    """
    marked = lambda x: x["number"].isNull() & x["value"].rlike(DITTO_TEXT)

    def counted(cells: Column) -> Column:
        dittos, others = F.filter(cells, marked), F.filter(cells, lambda x: x["number"].isNull() & ~x["value"].rlike(DITTO_TEXT))
        hits = F.size(dittos) + F.size(F.filter(others, lambda x: U.unit_text(x["value"]).isNotNull()))
        good = (F.size(cells) >= 4) & (F.size(dittos) >= 2)
        return F.when(good, F.struct((hits / F.size(cells)).alias("share"), (-cells[0]["col"]).alias("left")))

    def best(cells: Column) -> Column:
        columns = runs(F.sort_array(F.transform(cells, lambda x: F.struct(x["col"].alias("col"), x["row"].alias("row"), x["value"].alias("value"), x["number"].alias("number")))), "col")
        return -F.array_max(F.filter(F.transform(columns, counted), lambda x: x["share"] >= 0.6))["left"]

    # few sheets have two ditto marks at all
    return let(F.flatten(F.transform(data, lambda r: r["cells"])), lambda cells: F.when(F.size(F.filter(cells, marked)) >= 2, best(cells)))


def data_rows(data: Column, unit_col: Column) -> Column:
    """row, texts (the first two outside the unit column), unit and numbers of each of the rows."""
    in_unit = lambda x: x["col"].eqNullSafe(unit_col)

    def parts(r: Column) -> Column:
        texts = F.slice(F.filter(r["cells"], lambda x: x["number"].isNull() & ~in_unit(x) & ~x["value"].rlike(DITTO_TEXT)), 1, 2)
        unit = F.when(unit_col.isNotNull(), F.array_max(F.transform(F.filter(r["cells"], in_unit), lambda x: x["value"])))
        number = lambda x: F.struct(x["col"].alias("col"), x["value"].alias("value"), x["number"].alias("number"))
        text = lambda x: F.struct(x["col"].alias("col"), x["value"].alias("value"), x["indent"].alias("indent"))
        return F.struct(r["row"].alias("row"), F.transform(texts, text).alias("texts"), unit.alias("unit"), F.transform(F.filter(r["cells"], lambda x: x["number"].isNotNull()), number).alias("numbers"))

    return F.transform(data, parts)


def is_flat(data: Column) -> Column:
    """Whether no row of data_rows is indented or has a unit, so that no row hangs on those above it."""
    return F.forall(data, lambda r: r["unit"].isNull() & (F.coalesce(F.get(r["texts"], F.lit(0))["indent"], F.lit(0)) == 0))
