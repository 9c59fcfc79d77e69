import datetime

import pytest
from pyspark.sql import functions as F

from gridloom.operators import checks as K
from gridloom.operators import curated as CU
from gridloom.operators import quality as Q
from gridloom.sources import observations as S

DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def curated(spark):
    df = CU.curate(S.observations(spark, DIR), S.reports(spark, DIR), tie_breakers=("part_key",)).filter("report_year is not null")
    return df.cache()


def failed(curated, key, domain="industry"):
    (row,) = K.run_checks(curated).filter((F.col("key") == key) & (F.col("indicator_domain") == domain)).collect()
    return not row.passed


CLEAN = {"report_year": 2023, "report_month": 1, "period_start_date": datetime.date(2023, 1, 1), "period_end_date": datetime.date(2023, 1, 31), "period_type": "monthly"}

#: check -> columns of one seeded row that breaks it
SEEDS = {
    "null_sheet_report_id": {"sheet_report_id": None}, "null_report_id": {"report_id": None}, "null_indicator_name": {"indicator_name_raw": " "}, "null_source_file": {"source_filename": None},
    "replacement_char": {"unit_raw": "a�"}, "mojibake_text": {"unit_raw": "Ã¢"}, "control_chars": {"indicator_name_raw": "a\x01"}, "min_year_sane": {"report_year": 1900}, "null_report_year": {"report_year": None},
    "report_month_range": {"report_month": 13}, "report_quarter_range": {"report_quarter": 5}, "period_order": {"period_end_date": datetime.date(2022, 1, 1), "report_year": 2022}, "period_end_year_matches": {"report_year": 2001},
    "monthly_has_month": {"report_month": None}, "period_type_present": {"period_type": " "}, "value_finite": {"value_numeric": float("inf")}, "value_magnitude": {"value_numeric": 1e14}, "base_scale_present": {"value_numeric": 1.0, "value_numeric_base_scale": None},
    "index_value_band": {"metric_type": "index", "value_numeric": -1.0}, "quantity_currency_unit": {"metric_measure": "quantity", "unit_raw": "USD"}, "analytical_unit_present": {"unit_raw": "x", "analytical_unit": None},
    "pct_unit_sanity": {"unit_raw": "%", "value_numeric": 1e6}, "currency_consistency": {"unit_raw": "VND", "currency": None}, "metric_month_range": {"metric_ref_month": 13}, "metric_quarter_range": {"metric_ref_quarter": 5},
    "metric_cum_range": {"metric_cumulative_months": 13}, "metric_year_range": {"metric_ref_year": 1800}, "metric_year_missing": {"metric_name_raw": "So bo / nam / Luong"}, "metric_measure_domain": {"metric_measure": "x"}, "metric_basis_domain": {"metric_basis": "x"},
    "metric_grain_domain": {"metric_period_grain": "x"}, "grain_month_consistency": {"metric_period_grain": "month", "metric_ref_month": None, "metric_cumulative_months": None}, "grain_quarter_consistency": {"metric_period_grain": "quarter", "metric_ref_quarter": None},
    "grain_ytd_consistency": {"metric_period_grain": "ytd_cumulative", "metric_cumulative_months": None}, "grain_year_consistency": {"metric_period_grain": "year", "metric_ref_month": 3}, "unconverted_growth": {"metric_type": "yoy_growth", "value_growth_pct": 5.0, "value_numeric": 5.0},
    "growth_conversion_valid": {"metric_type": "mom_growth", "value_growth_pct": 1.0, "value_numeric": 5.0}, "growth_band": {"value_growth_pct": 20_000.0}, "comparison_vocabulary": {"metric_comparison": "x"}, "subdomain_present": {"indicator_subdomain": None},
    "confidence_present": {"extraction_confidence": None}, "confidence_range": {"extraction_confidence": 1.5}, "normalized_name_present": {"indicator_name_normalized": ""}, "dimension_not_ditto": {"sector_raw": '"'}, "dup_observation_ids": {"indicator_observation_id": "same"},
}


def test_seeded_violations_fail_their_checks(spark, curated):
    base = curated.filter("indicator_domain = 'industry'").limit(1).first().asDict() | CLEAN
    base |= {"metric_name_raw": "So bo / nam 2023", "metric_period_grain": "year", "metric_ref_month": None, "metric_ref_quarter": None, "metric_cumulative_months": None, "metric_ref_year": 2023, "metric_measure": None, "metric_comparison": None, "unit_raw": "x", "analytical_unit": "x", "currency": None}
    base |= {"metric_type": "value", "value_numeric": 5.0, "value_numeric_base_scale": 5.0, "value_growth_pct": None, "sector_raw": "s", "product_raw": "p", "sheet_report_id": "s"}
    every, clean = [], []
    for i, (key, change) in enumerate(SEEDS.items()):
        row = base | {"indicator_observation_id": f"o{i}"}
        clean.append(row | {"indicator_domain": f"clean_{key}"})
        every += [row | change | {"indicator_domain": key}, row | {"indicator_domain": key, "indicator_observation_id": "same"}]
    results = {(r.indicator_domain, r.key): r.passed for r in K.run_checks(spark.createDataFrame([tuple(r[c] for c in curated.columns) for r in every + clean], curated.schema)).collect()}
    assert [k for k in SEEDS if results[k, k]] == []
    assert [k for k in SEEDS if not results[f"clean_{k}", k]] == []


def test_suite_size_and_missing_values(spark, curated):
    results = K.run_checks(curated)
    assert {r["count"] for r in results.groupBy("indicator_domain").count().collect()} == {68}
    assert K.check_table(spark).count() == 70  # the coverage variants included
    assert spark.range(1).select(K.passes(F.lit(None).cast("double"), F.lit("=="), F.lit(0.0)).alias("p")).first().p is False
    assert "| industry | 68 |" in K.markdown(results)


def test_gate(spark, curated):
    rows = Q.gate(S.observations(spark, DIR), curated, "2002-01-01", {"rows_missing_sheet_report_id": 10**6, "freshness_days_since_publish": 10**6, "domain_misclassified_rows": 10**6, "metric_year_missing": 10**6, "quantity_with_currency_unit": 10**6})
    Q.enforce(rows)
    broken = curated.withColumn("value_growth_pct", F.col("value_numeric"))
    with pytest.raises(AssertionError, match="unconverted_growth_rows"):
        Q.enforce(Q.gate(S.observations(spark, DIR), broken, "2002-01-01"))
    empty = {r.check_name: r for r in Q.gate(S.observations(spark, DIR).limit(0), curated.limit(0), "2002-01-01", null_fails=True).collect()}
    assert empty["unconverted_growth_rows"].value is None and empty["unconverted_growth_rows"].status == "FAIL"


def test_curated_has_one_row_per_observation_and_no_fan_out(spark, curated):
    ids = S.observations(spark, DIR).select("indicator_observation_id").distinct().count()
    assert curated.count() == ids and len(curated.columns) == 53


def test_curated_joins_are_broadcast_and_scans_pruned(spark):
    plan = CU.curate(S.observations(spark, DIR), S.reports(spark, DIR))._jdf.queryExecution().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
