import pytest
from pyspark.sql import functions as F

from gridloom.operators import upsert as D
from gridloom.plans.tables import OBSERVATION, run_script, to_json_rows, write_observations, write_swapped

T, S = [(1, "a", "x"), (2, "b", None), (None, "n", "z")], [(2, "B", "y"), (3, "C", "w"), (None, "N", "q")]


def frames(spark):
    return spark.createDataFrame(T, "k int, v string, h string"), spark.createDataFrame(S, "k int, v string, h string")


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_upsert_is_idempotent_and_null_safe(spark):
    t, s = frames(spark)
    once = D.upsert(t, s, ["k"])
    assert rows(once) == sorted([(1, "a", "x"), *S], key=str)
    assert rows(D.upsert(once, s, ["k"])) == rows(once)
    with pytest.raises(ValueError):
        D.upsert(t, s.union(s), ["k"])
    assert rows(D.upsert(t, s.limit(0), ["k"])) == sorted(T, key=str)


def test_other_merges(spark):
    t, s = frames(spark)
    assert rows(D.insert_only(t, s, ["k"])) == sorted([*T, (3, "C", "w")], key=str)
    assert rows(D.update_matched(t, s, ["k"], {"v": "v"})) == sorted([(1, "a", "x"), (2, "B", None), (None, "N", "z")], key=str)
    same = s.withColumn("h", F.when(F.col("k") == 2, None).otherwise(F.col("h")))
    assert rows(D.upsert_gated(t, same, ["k"], "h", ["v"])) == sorted([(1, "a", "x"), (2, "b", None), (3, "C", "w"), (None, "N", "q")], key=str)
    assert rows(D.backfill_null(t, s, ["k"], "h")) == sorted([(1, "a", "x"), (2, "b", "y"), (None, "n", "z")], key=str)


def test_updates_and_deletes(spark):
    t, _ = frames(spark)
    swapped = D.update_where(t, F.col("k") == 1, {"v": F.col("h"), "h": F.col("v")})
    assert (1, "x", "a") in rows(swapped) and (2, "b", None) in rows(swapped)
    assert rows(D.delete_where(t, F.col("h") == "x")) == sorted(T[1:], key=str)
    keys = spark.createDataFrame([(1,), (1,), (None,)], "k int")
    assert rows(D.update_in(t, "k", keys, {"v": F.lit("!")})) == sorted([(1, "!", "x"), *T[1:]], key=str)
    assert rows(D.sweep_stale(t, "k", keys, "v", F.lit("b"))) == sorted(T[1:], key=str)
    left, right = D.move_rows(t, t.limit(0), F.col("k") == 2, ["k"])
    assert (left.count(), rows(right)) == (2, [(2, "b", None)])


def test_repair_of_misfiled_rows(spark):
    from gridloom.plans import repair

    names = "indicator_observation_id string, attachment_id string, source_sheet_name string"
    investment = spark.createDataFrame([("a", "f1", "14.XK"), ("b", "f1", " 15_NK "), ("c", "f2", "12.FDI"), ("d", "f2", None)], names)
    trade = spark.createDataFrame([("b", "f1", "15_NK")], names)
    left, right = repair.move_trade_rows(investment, trade)
    assert sorted(r[0] for r in left.collect()) == ["c", "d"] and sorted(r[0] for r in right.collect()) == ["a", "b"]
    log = spark.createDataFrame([("f1", 0, "failed"), ("f3", 9, "success")], "attachment_id string, extraction_rows_inserted long, extraction_status string")
    assert rows(repair.repair_log(log, right)) == [("f1", 2, "success"), ("f3", 0, "empty")]


def test_align(spark):
    df = spark.createDataFrame([("1", 5)], "report_year string, other int")
    out = D.align(df, OBSERVATION)
    assert out.schema == OBSERVATION or [f.dataType for f in out.schema] == [f.dataType for f in OBSERVATION]
    assert out.first().report_year == 1 and "indicator_domain" in D.missing_columns(df, OBSERVATION)


def test_swapped_write_reads_its_own_table(spark, tmp_path):
    path = str(tmp_path / "t")
    write_swapped(spark.range(3).toDF("k"), path)
    write_swapped(spark.read.parquet(path).withColumn("k", F.col("k") + 1), path)
    assert rows(spark.read.parquet(path)) == [(1,), (2,), (3,)]
    facts = str(tmp_path / "facts")
    write_observations(spark.createDataFrame([("industry", 2020), ("trade_prices", 2021)], "indicator_domain string, report_year int"), facts)
    assert spark.read.parquet(facts).filter("indicator_domain = 'industry'").count() == 1


def test_scripts(spark):
    out = run_script(spark, "-- c\nUSE x;\nSELECT 1 AS a;\nSELECT 2 AS a;\n")
    assert [d.first().a for d in out] == [1, 2]
    assert to_json_rows(spark.range(1)).first().value == '{"id":0}'


def test_stream(spark, tmp_path):
    from pyspark.sql.types import StructType

    from gridloom.streaming.ingest import upsert_stream

    schema = StructType.fromDDL("k int, v string, at int")
    run = lambda: upsert_stream(spark, str(tmp_path / "in"), schema, str(tmp_path / "t"), ["k"], "at", str(tmp_path / "c"))
    spark.createDataFrame([(1, "a", 1), (1, "b", 2)], schema).coalesce(1).write.parquet(str(tmp_path / "in"))
    run()
    spark.createDataFrame([(2, "c", 1), (1, "d", 3)], schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    run()
    run()
    table = spark.read.parquet(str(tmp_path / "t"))
    assert rows(table.drop("key_bucket")) == [(1, "d", 3), (2, "c", 1)]
    untouched = lambda: {f.name: f.stat().st_mtime for f in (tmp_path / "t").glob("key_bucket=*/*") if f.parent.name != touched}
    touched = f"key_bucket={table.filter('k = 1').first().key_bucket}"
    before = untouched()
    spark.createDataFrame([(1, "e", 4)], schema).write.mode("append").parquet(str(tmp_path / "in"))
    run()
    assert rows(spark.read.parquet(str(tmp_path / "t")).drop("key_bucket")) == [(1, "e", 4), (2, "c", 1)] and untouched() == before and before
