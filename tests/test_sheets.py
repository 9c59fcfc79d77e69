"""Sheets rebuilt in arrays equal the rules on a row for each cell, and take no sort, window or join of cells."""

import json
import random

import pytest
from gridloom import queries
from gridloom.operators import grid as G
from gridloom.operators import sheets as S
from gridloom.plans.extract import head_facts
from pyspark.sql import functions as F

DIR = "/root/testdata/sf0.001"
PARSED = "attachment_id string, report_id string, sheet_index int, sheet_name_raw string, filename string, raw_cells_json string, merged_ranges_json string"
c = F.col


def letters(k):
    return chr(64 + k)


def random_sheets(n, seed):
    """Headers with gaps, years, numbers and merged ranges; data rows with indents, units and ditto marks; some sheets without data."""
    rng, out = random.Random(seed), []
    for s in range(n):
        cells, cols = [], rng.choice([[1, 2, 3, 4, 5], [1, 2, 4, 7], [2, 3, 9]])
        put = lambda r, k, v, indent=0: cells.append({"row_index": r, "column_index": k, "cell_value_raw": v, "indent_level": indent})
        for r in range(1, rng.randint(2, 11)):
            for k in cols:
                if rng.random() < 0.4:
                    put(r, k, rng.choice(["nam", " Nam ", "Lượng", "Tri gia (Trieu USD)", "Đơn vị tính: Ty dong", "Don vi:", "2024", "2025", "So voi cung ky", "x  y"]))
        for r in range(12, 12 + rng.choice([0, 0, 1, 4, 9])):
            if rng.random() < 0.9:
                put(r, cols[0], rng.choice(["Hang", "Than (Nghin tan)", "Ha Noi", "hua", '"', "a"]) + str(r), rng.choice([0, 0, 0, 1, 2]) if s % 2 else 0)
            if rng.random() < 0.7:
                put(r, cols[1], rng.choice(["Nghin tan", '"', '"', " -nt- ", "Trieu hop"]) if s % 3 else str(r))
            for k in cols[2:]:
                if rng.random() < 0.9:
                    put(r, k, rng.choice([str(r * 7), "1.234,5", "12%", "(5)", "2020", "-", "4800"]))
        rng.shuffle(cells)
        ranges = [f"{letters(a)}{r}:{letters(a + rng.randint(0, 4))}{r + rng.randint(0, 1)}" for a, r in ((rng.choice(cols), rng.randint(1, 9)) for _ in range(rng.randrange(4)))] + ["B9", "", "a1:b2"]
        out.append((f"a{s}", "r", s, rng.choice(["18XK", "Bieu 7", "2. IIP", "5NN"]), "f.xlsx", json.dumps(cells), json.dumps(ranges)))
    return out


@pytest.fixture(scope="module")
def sheets(spark):
    given = spark.createDataFrame(random_sheets(150, 3), PARSED).withColumnRenamed("attachment_id", "sheet_id").cache()
    yield given
    given.unpersist()


def test_names_of_heads_equal_those_of_cells(spark, sheets):
    zoned = G.with_zones(G.parse_cells(sheets))
    spans = G.expand_headers(zoned, G.parse_ranges(sheets))
    want = sorted((r.sheet_id, r.col, r.metric_name) for r in G.header_names(spans, zoned).collect())
    none = F.lit(None).cast("string")
    heads = S.read_rows(sheets).select("sheet_id", S.head(none, none, c("merged_ranges_json")).alias("head"))
    derive = lambda h: h.withColumn("x", F.arrays_zip("cols", S.header_names(c("spans"), c("cols")).alias("n"), S.header_units(c("spans"), c("cols")).alias("u")))
    got = S.with_heads(heads, derive).select("sheet_id", F.explode("x").alias("x")).select("sheet_id", "x.*").collect()
    assert sorted((r.sheet_id, r.cols, r.n) for r in got) == want and len({n for _, _, n in want}) > 40
    units = {(r.sheet_id, r.col): r.header_unit for r in G.header_units(spans).collect()}
    assert {(r.sheet_id, r.cols): r.u for r in got if r.u} == units and len(units) > 20


def test_rows_and_titles_equal_those_of_cells(sheets):
    zoned = G.with_zones(G.parse_cells(sheets))
    read = S.read_rows(sheets).filter("first > 0").withColumn("data", F.slice("rows", F.greatest(c("first"), F.lit(1)), F.size("rows"))).withColumn("unit_col", S.unit_column(c("data")))
    units = G.unit_columns(zoned)
    assert {r.sheet_id: r.unit_col for r in read.filter("unit_col is not null").collect()} == {r.sheet_id: r.unit_col for r in units.collect()} != {}
    data = read.withColumn("d", S.data_rows(c("data"), c("unit_col"))).withColumn("flat", S.is_flat(c("d"))).select("sheet_id", "flat", F.explode("d").alias("r")).select("sheet_id", "flat", "r.*").drop("numbers")
    names = ["sheet_id", "row", "label_col", "child", "parent", "label", "row_unit"]
    got = G.hierarchy(data.filter("flat"), flat=True).select(names).unionByName(G.hierarchy(data.filter("not flat")).select(names))
    want = G.row_context(zoned, units).select(names)
    assert got.count() == want.count() > 200 and got.exceptAll(want).count() == 0 and data.select("flat").distinct().count() == 2
    titles = {r.sheet_id: (r.title, r.body_text) for r in G.titles(zoned).collect()}
    assert {r.sheet_id: (r.t, r.b) for r in S.read_rows(sheets).filter("size(rows) > 0").select("sheet_id", S.title(c("rows")).alias("t"), F.array_join(S.lines(c("rows")), " | ").alias("b")).collect()} == titles


def test_units_of_sheets_equal_those_of_cells(sheets):
    zoned = G.with_zones(G.parse_cells(sheets))
    filed = sheets.select("sheet_id", c("sheet_name_raw").alias("sheet_name")).join(G.titles(zoned).select("sheet_id", "title"), "sheet_id")
    want = {r.sheet_id: (r.explicit, r.title_unit, r.combined) for r in G.context_units(zoned, G.expand_headers(zoned, G.parse_ranges(sheets)), filed).collect()}
    read = S.read_rows(sheets).withColumn("title", S.title(c("rows")))
    heads = read.select("sheet_id", "first", S.head(c("sheet_name_raw"), c("title"), c("merged_ranges_json")).alias("head")).filter("first > 0")
    facts = {r.sheet_id: r.explicit for r in S.with_heads(heads, head_facts).collect()}
    assert facts == {k: want[k][0] for k in facts} and len({v for v in facts.values() if v}) > 1


def test_heads_too_many_to_broadcast_give_the_same(sheets, monkeypatch):
    heads = S.read_rows(sheets).select("sheet_id", S.head(c("sheet_name_raw"), F.lit("t"), c("merged_ranges_json")).alias("head"))
    names = lambda h: h.withColumn("names", S.header_names(c("spans"), c("cols")))
    found = lambda: sorted(map(str, S.with_heads(heads, names).select("sheet_id", "head", "title", "cols", "names").collect()))
    want = found()
    monkeypatch.setattr(S, "BROADCAST_HEADS", 0)
    assert found() == want and len(want) == 150


def plan_without_broadcasts(spark, name):
    """The plan as for tables too large to broadcast."""
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        return queries.queries()[name](spark, DIR)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_extraction_sorts_and_joins_no_cells(spark):
    text = plan_without_broadcasts(spark, "extract_pipeline")
    # rows below one another are put in order, and only those of sheets with indents or units
    assert "SortMergeJoin" not in text and "dense_rank" not in text and text.count("Sort [") == 1


def test_columns_with_gaps_are_placed(spark):
    got = spark.createDataFrame([([3, 4, 5], 5), ([3, 5, 9], 9), ([1, 3], 3), ([7], 7)], "cols array<int>, col int").select(S.place(c("cols"), c("col")).alias("i"))
    assert [r.i for r in got.collect()] == [2, 2, 1, 0]


def test_header_fill_sorts_and_joins_no_cells(spark):
    text = plan_without_broadcasts(spark, "header_fill")
    assert not [x for x in ("SortMergeJoin", "Window", "Sort [", "explode(from_json") if x in text]
