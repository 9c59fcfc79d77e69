"""What the curated queries move: narrow rows, once, and no table that no column needs."""

import re

from gridloom import queries
from gridloom.operators import checks as K
from gridloom.operators import gaps as X
from gridloom.operators import quality as Q
from gridloom.operators import reports as R
from pyspark.sql import functions as F

DIR = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_rows_are_dealt_by_id_once_while_narrow_and_without_a_second_sort(spark):
    text = plan(queries.curated(spark, DIR, "report_year", "indicator_domain"))
    assert "WindowGroupLimit" not in text and text.count("Exchange hashpartitioning") == 1 and text.count("Sort [") == 1
    dealt = re.search(r"Exchange hashpartitioning.*?\n.*?Project \[(.*?)\]\n", text, re.S).group(1)
    assert "md5" not in dealt and "p_name" not in dealt


def test_chosen_columns_equal_those_of_the_whole_table(spark):
    chosen = ("report_id", "published_date", "indicator_name_en", "value_numeric_base_scale", "geography_type", "needs_review", "metric_ref_year")
    for names in (chosen, chosen[:1], chosen[2:3]):
        got = queries.curated(spark, DIR, *names).select(*names)
        assert got.exceptAll(queries.curated(spark, DIR).select(*names)).count() == 0 and got.count() == queries.curated(spark, DIR).count()


def test_chosen_checks_equal_those_of_the_suite(spark):
    table = queries.curated(spark, DIR).cache()
    every = K.run_checks(table)
    for keys in (("misfiled_from_other_domain",), ("rows_present", "year_span"), ("year_gaps_with_source", "unit_cardinality")):
        got, want = K.run_checks(table, keys=keys), every.filter(F.col("key").isin(*keys))
        assert got.count() == want.count() > 0 and got.exceptAll(want).count() == 0
    table.unpersist()


def test_ambiguous_groups_by_extremes(spark):
    nan = float("nan")
    rows = [("s", "a", "m", "x", 1.0), ("s", "a", "m", "y", 2.0), ("s", "b", "m", "x", 0.0), ("s", "b", "m", "x", -0.0), ("s", "c", "m", "y", nan), ("s", "c", "m", "y", nan), ("s", "d", "m", "x", nan), ("s", "d", "m", "x", 1.0)]
    rows += [(None, "a", "m", "x", 1.0), (None, "a", "m", "x", 2.0), ("s", "e", "m", "x", None), ("s", "e", "m", "x", 3.0), ("s", "f", "m", None, 1.0), ("s", "f", "m", "y", 2.0)]
    table = spark.createDataFrame(rows, "sheet_report_id string, indicator_name_raw string, metric_name_raw string, indicator_domain string, value_numeric double")
    got = {r.indicator_domain: (r["rows"], r.rows_ambiguous) for r in R.ambiguous_share(table).collect()}
    assert got == {"x": (9, 3), "y": (4, 2), None: (1, 0)}
    groups = Q.ambiguous_groups(table, "sheet_report_id", "indicator_name_raw").collect()
    assert {(r.sheet_report_id, r.indicator_name_raw): r.n for r in groups} == {("s", "a"): 2, ("s", "d"): 2, (None, "a"): 2, ("s", "f"): 2}
    assert plan(R.ambiguous_share(table)).count("Exchange hashpartitioning") == 2


def test_extraction_deals_cells_while_they_are_one_text(spark):
    rows = queries.queries()["extract_pipeline"](spark, DIR)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as for tables too large to broadcast
    try:
        text = plan(rows.select("*"))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert "Exchange hashpartitioning" not in text and "Bucketed: true" in text
    lines = spark.read.parquet(f"{DIR}/lineitem.parquet").select("l_orderkey", "l_linenumber").distinct()
    assert rows.count() == 3 * lines.count() == rows.select("report_id", "source_row_index", "source_column_index").distinct().count()
    assert not [t.name for t in spark.catalog.listTables() if t.name.startswith("settled_")]


def test_lines_move_for_parts_and_ids_only_and_with_one_amount(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(queries.curated(spark, DIR, "value_numeric", "geography_raw"))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert "Exchange hashpartitioning(l_suppkey" not in text and text.count("Exchange hashpartitioning(l_partkey") == 1
    for moved in re.findall(r"Exchange hashpartitioning.*?\n.*?Project \[(.*?)\]\n", text, re.S):
        names = {re.sub("#.*", "", x.split(" AS ")[-1].strip()) for x in moved.split(",")}
        assert "l_orderkey" not in names or not {"l_quantity", "l_extendedprice", "l_discount", "n_name"} & names


def test_ids_are_counted_where_they_are(spark):
    table = queries.curated(spark, DIR, *Q.SUMMARY_COLUMNS)
    text = plan(Q.quality_summary(table))
    assert not [x for x in re.findall(r"Expand \[(.*?)\n", text) if "indicator_observation_id" in x]
    some = table.limit(5)
    rows = some.unionByName(some.limit(2)).unionByName(some.limit(3).withColumn("indicator_observation_id", F.lit(None).cast("string")))
    got = Q.quality_summary(rows).first()
    assert (got.curated_rows, got.distinct_observation_ids, got.duplicate_observation_extra_rows) == (10, 5, 5)
    none = Q.quality_summary(table.filter("false")).first()
    assert (none.curated_rows, none.distinct_observation_ids, none.duplicate_observation_extra_rows) == (0, 0, 0)


def test_ambiguous_overall_deals_rows_once_by_their_keys(spark):
    nan = float("nan")
    rows = [("s", "a", "m", 1.0), ("s", "a", "m", 2.0), ("s", "b", "m", 0.0), ("s", "b", "m", -0.0), ("t", "c", "m", nan), ("t", "c", "m", nan), ("s", "d", "m", nan), ("s", "d", "m", 1.0), (None, "a", "m", 1.0), (None, "a", "m", 2.0), ("u", "e", "m", None), ("u", "e", "m", 3.0)]
    table = spark.createDataFrame(rows, "sheet_report_id string, indicator_name_raw string, metric_name_raw string, value_numeric double")
    assert X.ambiguous_overall(table).first().asDict() == {"ambiguous_groups": 3, "rows_in_ambiguous_groups": 6, "sheets_affected": 1, "pct_of_corpus": 50.0}
    assert "value_numeric" not in " ".join(re.findall(r"Exchange hashpartitioning\(.*?\)", plan(X.ambiguous_overall(table))))
