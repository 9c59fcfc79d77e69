"""Header and label rules derive the cells of a grid as few times as they need."""

from gridloom import queries
from gridloom.functions import text as T
from gridloom.operators import grid as G
from pyspark.sql import functions as F

CELLS = "sheet_id string, row int, col int, value string, indent int"


def optimized(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_header_cells_are_derived_once(spark):
    zoned = G.with_zones(spark.createDataFrame([("s", 1, 1, "a", 0)], CELLS))
    assert optimized(G.expand_headers(zoned)).count("dense_rank(row") == 1
    assert optimized(queries.queries()["grid_header_rows"](spark, "/root/testdata/sf0.001")).count("dense_rank(row") == 1


def test_columns_of_units_without_enough_ditto_marks_are_none(spark):
    rows = [("s", r, 1, f"Hang {r}", 0) for r in range(2, 8)] + [("s", r, 3, str(r), 0) for r in range(2, 8)]
    units = [("s", r, 2, v, 0) for r, v in zip(range(2, 8), ["Nghin tan", '"', '"', "x y z", '"', "Trieu hop"])]
    found = lambda cells: [(r.sheet_id, r.unit_col) for r in G.unit_columns(G.with_zones(spark.createDataFrame(cells, CELLS))).collect()]
    assert found(rows + units) == [("s", 2)] and found(rows) == []


def test_white_space_is_that_of_unicode(spark):
    texts = ["a" + chr(i) + "b " + chr(i) + chr(i) + " c" for i in range(1, 0x10000) if not 0xD800 <= i < 0xE000]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    plain = F.trim(F.regexp_replace("t", r"(?U)\s+", " "))
    assert df.filter(~plain.eqNullSafe(T.clean_cell(F.col("t")))).count() == 0
