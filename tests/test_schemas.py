"""Tables of the job: schemas, required columns, sheet reports."""

import os

import pytest
from gridloom.operators.upsert import upsert
from gridloom.plans import job, tables
from gridloom.plans.schemas import TABLES, conform, misfits, required, schema
from pyspark.sql import functions as F
from test_job import item, web


def test_required_columns(spark):
    assert required("observations") == ("indicator_observation_id", "report_id", "attachment_id")
    assert required("sheet_reports") == ("sheet_report_id", "report_id", "attachment_id", "sheet_index") == required("sheet_log")
    assert required("reports") == ("report_id", "report_url") and required("attachments") == ("attachment_id", "report_id", "attachment_url")
    assert required("dim_unit") == ()
    assert all(len({f.name.lower() for f in schema(t)}) == len(schema(t)) for t in TABLES)


def test_conform(spark):
    df = spark.createDataFrame([("a", "7", 1)], "report_id string, report_year string, own int")
    got = conform(df, "reports")
    assert got.columns == [*schema("reports").names, "own"] and misfits(got, "reports") == {}
    row = got.first()
    assert row.report_year == 7 and row.own == 1 and row.report_url is None
    assert misfits(df, "reports")["report_year"] == ("int", "string") and misfits(df, "reports")["report_url"] == ("string", "")


@pytest.mark.parametrize("parts", [None, ["part"]])
def test_a_null_in_a_required_column_leaves_the_old_table(spark, tmp_path, parts):
    path, of = str(tmp_path / "t"), lambda rows: spark.createDataFrame(rows, "k string, v string, part int")
    tables.write_swapped(of([("a", None, 1), ("b", "x", 2)]), path, parts, required=("k",))
    with pytest.raises(tables.NullsRefused) as e:
        tables.write_swapped(of([("c", "y", 1), (None, "y", 1), (None, None, 2)]).repartition(3), path, parts, required=("k", "v"))
    assert e.value.counts == {"k": 2, "v": 1}
    assert sorted(r.k for r in spark.read.parquet(path).collect()) == ["a", "b"] and os.listdir(tmp_path) == ["t"]
    tables.write_swapped(of([]), path, required=("k",))
    assert spark.read.parquet(path).count() == 0
    tables.write_swapped(of([(None, "z", 1)]), path, parts)  # nothing is required
    assert spark.read.parquet(path).count() == 1


def test_buckets_refuse_nulls_and_take_new_columns(spark, tmp_path):
    path, merge = str(tmp_path / "t"), lambda old, new: upsert(old, new, ["k"])
    tables.merge_buckets(spark.createDataFrame([(i, "old") for i in range(50)], "k long, v string"), path, ["k"], merge, 8, ("k",))
    with pytest.raises(tables.NullsRefused) as e:
        tables.merge_buckets(spark.createDataFrame([(1, "new", 1), (2, None, 1)], "k long, v string, w int"), path, ["k"], merge, 8, ("k", "v"))
    assert e.value.counts == {"v": 1} and {r.v for r in spark.read.parquet(path).collect()} == {"old"}
    tables.merge_buckets(spark.createDataFrame([(1, "new", 5), (99, "new", 6)], "k long, v string, w int"), path, ["k"], merge, 8, ("k", "v"))
    got = {r.k: (r.v, r.w) for r in spark.read.option("mergeSchema", "true").parquet(path).collect()}
    assert len(got) == 51 and got[1] == ("new", 5) and got[99] == ("new", 6) and {got[k] for k in got if k not in (1, 99)} == {("old", None)}
    tables.merge_buckets(spark.createDataFrame([(3, "newer")], "k long, v string"), path, ["k"], merge, 8, ("k", "v"))
    got = {r.k: (r.v, r.w) for r in spark.read.option("mergeSchema", "true").parquet(path).collect()}
    assert len(got) == 51 and got[3] == ("newer", None)
    tables.merge_buckets(spark.createDataFrame([], "k long, v string"), path, ["k"], merge, 8, ("k", "v"))
    assert spark.read.parquet(path).count() == 51


def test_tables_of_a_month(spark, tmp_path):
    root = str(tmp_path)
    pages = spark.createDataFrame([(1, "https://a.example/list", item(1, 3) + item(2, 4))], "page_no int, url string, html string")
    job.run_month(spark, root, pages, web(), "2024-05-01 00:00:00", lasting_dimensions=True)
    written = [t for t in TABLES if t != "dim_unit"]  # always derived
    read = {t: job.read(spark, root, t) for t in written}
    assert {t: misfits(df, t) for t, df in read.items()} == dict.fromkeys(written, {})
    for t, df in read.items():
        assert df.filter(" OR ".join(f"{k} IS NULL" for k in required(t)) or "false").count() == 0
    counted = {r.sheet_report_id: r["count"] for r in read["observations"].groupBy("sheet_report_id").count().collect()}
    reported = {r.sheet_report_id: r for r in read["sheet_reports"].collect()}
    assert len(reported) == read["parsed"].count() == 4
    assert {k: r.observation_count for k, r in reported.items() if r.observation_count} == counted
    assert {(r.sheet_name_raw, r.extraction_status, r.observation_count > 0, r.report_year) for r in reported.values()} == {("2. IIP", "success", True, 2024), ("Ghi chu", "empty", False, None)}
    of_sheet = read["observations"].select("sheet_report_id", "report_month", "period_start_date", "source_filename").distinct().collect()
    assert all((r.report_month, r.period_start_date, r.source_filename) == (reported[r[0]].report_month, reported[r[0]].period_start_date, reported[r[0]].source_filename) for r in of_sheet)
    logged = {r.sheet_report_id: r.rows_extracted for r in read["sheet_log"].collect()}
    assert logged == {k: r.observation_count for k, r in reported.items()}

    job.reset_extraction(spark, root, "2024-06-01 00:00:00", spark.createDataFrame([(min(r.attachment_id for r in reported.values()),)], "attachment_id string"))
    job.extract_tables(spark, root, "2024-06-01 00:00:00")
    again = job.read(spark, root, "sheet_reports").select("sheet_report_id", F.month("updated_at").alias("m"), "observation_count").collect()
    assert sorted(r.m for r in again) == [5, 5, 6, 6] and {r[0]: r.observation_count for r in again} == logged
