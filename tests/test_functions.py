import datetime

import pytest
from pyspark.sql import functions as F

from gridloom.functions import html as H
from gridloom.functions import metrics as M
from gridloom.functions import numbers as N
from gridloom.functions import periods as P
from gridloom.functions import text as T
from gridloom.functions import units as U


def values(spark, texts, column):
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, x string")
    return [r.v for r in rows.select("i", column(F.col("x")).alias("v")).orderBy("i").collect()]


NUMBERS = {
    "1234": 1234, "1,234": 1234, "1,234,567": 1234567, "105,2": 105.2, "1.234,5": 1234.5, "1.234.567,8": 1234567.8, "1 234,5": 1234.5, "1.234": 1.234, "1,2345": 1.2345, "1.234,567": 1.234567,
    "12.345.678": None, "(1234)": -1234, "(-5)": -5, "-5,5": -5.5, "+3": 3, "105,2%": 105.2, "12 %": 12, "5.": 5, "-": None, "–": None, "—": None, "...": None, ".": None, ",": None, "%": None, "": None,
    "--5": None, "nam 2003": None, "#DIV/0!": None, "1e5": None, "2024": 2024, None: None, "1d": None, "NaN": None, " 7 ": 7,
}


def test_to_number(spark):
    got = values(spark, NUMBERS, N.to_number)
    assert got == [None if v is None else pytest.approx(v) for v in NUMBERS.values()]


def test_column_letters(spark):
    rows = spark.range(1, 800).select("id", N.column_index(N.column_letters(F.col("id").cast("int"))).alias("back")).collect()
    assert all(r.id == r.back for r in rows)


D = datetime.date
TITLES = {
    "Báo cáo tháng Một năm 2026": ("monthly_single_month", 1, None, 1, D(2026, 1, 1), D(2026, 1, 31)),
    "tháng Tư và 4 tháng đầu năm 2026": ("monthly_cumulative", 4, None, 4, D(2026, 1, 1), D(2026, 4, 30)),
    "tháng Mười Một và 11 tháng năm 2025": ("monthly_cumulative", 11, None, 11, D(2025, 1, 1), D(2025, 11, 30)),
    "tháng Năm và 5 tháng đầu năm 2023": ("monthly_cumulative", 5, None, 5, D(2023, 1, 1), D(2023, 5, 31)),
    "tháng 8 và 8 tháng năm 2024": ("monthly_cumulative", 8, None, 8, D(2024, 1, 1), D(2024, 8, 31)),
    "8 tháng năm 2024": ("special_or_unknown", None, None, 8, None, None),
    "quý I năm 2026": ("quarterly", None, 1, 3, D(2026, 1, 1), D(2026, 3, 31)),
    "quý II và 6 tháng đầu năm 2024": ("semi_annual", None, 2, 6, D(2024, 1, 1), D(2024, 6, 30)),
    "quý III và 9 tháng năm 2025": ("quarterly", None, 3, 9, D(2025, 7, 1), D(2025, 9, 30)),
    "quý IV và năm 2025": ("annual", 12, 4, 12, D(2025, 1, 1), D(2025, 12, 31)),
}


def test_classify_report(spark):
    got = [(p.sub_category, p.report_month, p.report_quarter, p.period_months_covered, p.period_start_date, p.period_end_date) for p in values(spark, TITLES, P.classify_report)]
    assert got == list(TITLES.values())


def test_parse_date(spark):
    assert values(spark, ["Ngày đăng: 6/3/2025", "31/02/2024", "x", None], P.parse_date) == [D(2025, 3, 6), None, None, None]


METRICS = {
    "So bo / thang 01 / nam 2025 / Tri gia": ("preliminary", "value", 1, 2025, None, None, "month"),
    "So bo / nam 2024 / Luong": ("preliminary", "quantity", None, 2024, None, None, "year"),
    "Uoc tinh / 9 thang / nam 2024": ("estimated", None, None, 2024, None, 9, "ytd_cumulative"),
    "12 thang / nam 2023": (None, None, None, 2023, None, 12, "year"),
    "01 thang / nam 2023": (None, None, None, 2023, None, 1, "ytd_cumulative"),
    "Quy III / nam 2022": (None, None, None, 2022, 3, None, "quarter"),
    "column_7": (None, None, None, None, None, None, None),
}


def test_metric_parts(spark):
    parts = lambda x: F.struct(*[v.alias(k) for k, v in M.metric_parts(x, F.lit(2020)).items()])
    got = [(p.metric_basis, p.metric_measure, p.metric_ref_month, p.metric_ref_year, p.metric_ref_quarter, p.metric_cumulative_months, p.metric_period_grain) for p in values(spark, METRICS, parts)]
    assert got == list(METRICS.values())


def test_growth(spark):
    cases = [("index_yoy_base100", None, 108.3, 8.3), ("yoy_growth", "%", 105.2, 5.2), ("yoy_growth", "Ty dong", 105.2, 5.2), ("yoy_growth", "Ty dong", 1120438.0, None), ("index", None, 110.0, None), ("value", "%", 50.0, None)]
    rows = spark.createDataFrame(cases, "k string, u string, v double, want double").select(M.growth_pct(F.col("k"), F.col("u"), F.col("v")).alias("got"), "want").collect()
    assert all(r.got == (None if r.want is None else pytest.approx(r.want)) for r in rows)


def test_text(spark):
    assert values(spark, ["  Đà  Nẵng ", "Ünïted\n", None, ""], T.norm) == ["da nang", "united", "", ""]
    assert values(spark, ["é", "đĐ"], T.strip_accents) == ["e", "dD"]
    assert values(spark, ["x" * 20_001, "y"], T.trim_cell_text)[0].endswith("[truncated]")
    assert values(spark, ["Kh¸ch s¹n", "Khách sạn"], T.legacy_to_unicode) == ["Khách sạn", "Khách sạn"]
    assert len(T.LEGACY_GLYPHS) == len(T.LEGACY_LETTERS)


def test_encoding_detection(spark):
    cells = [("a", i, 1, v) for i, v in enumerate(["Kh¸ch", "s¹n", "n¨m"])] + [("b", 1, 1, "§ 5"), ("c", 1, 1, "Khach"), ("c", 2, 1, None)]
    got = T.detect_sheet_encoding(spark.createDataFrame(cells, "sheet_id string, row int, col int, value string")).collect()
    assert {r.sheet_id: r.detected_text_encoding for r in got} == {"a": "tcvn3", "b": "possible_legacy_low_confidence", "c": "unicode"}


def test_corrections(spark):
    T.check_corrections(T.CORRECTIONS)
    with pytest.raises(ValueError):
        T.check_corrections([("a.b", "c")])
    df = spark.createDataFrame([("Hang hoo khoc",), ("Bon buun",), ("fine",), (None,)], "label string")
    assert sorted(str(r.label) for r in T.correct_labels(df, "label", T.CORRECTIONS).collect()) == ["Ban buon", "Hang hoa khac", "None", "fine"]


def test_units(spark):
    assert values(spark, ["Nghìn tấn", "(Triệu USD)", "co cau", None], U.unit_phrase) == ["Thousand tonnes", "Million USD", None, None]
    assert values(spark, ["Trị giá (Triệu USD)", "Tổng mức bán lẻ hàng hóa theo giá hiện hành tỷ đồng", "x"], U.unit_from_text) == ["Triệu USD", "Billion VND", None]
    assert values(spark, ["Đơn vị tính: Tỷ đồng", "Nghin tan", "mot hai ba bon nam sau bay"], U.unit_text) == ["Tỷ đồng", "Nghin tan", None]
    assert values(spark, ["Nghin tan; Trieu USD", "nang suat; san luong lua dong xuan"], U.combined_caption) == ["Nghin tan; Trieu USD", None]
    assert values(spark, ["Nghin tan; Trieu USD", "Trieu USD"], lambda x: U.split_caption(x, "quantity")) == ["Nghin tan", None]
    assert values(spark, ["so voi thang truoc", "cung ky", "co cau", "5%", "chi so", "9 thang", "x"], U.metric_type) == ["mom_growth", "yoy_growth", "share", "percent", "index", "ytd_value", "value"]
    assert values(spark, ["%", "nghin ty dong", "ty dong", "trieu", "nghin", "chi xo"], U.scale) == ["percent", "trillion", "billion", "million", "thousand", None]


def test_html(spark):
    page = 'x <a class="l" href="/f/Bang%20so.xlsx">So <b>lieu</b> &amp; 1</a> <a href="b.pdf">p</a>'
    rows = spark.createDataFrame([(page, "https://a.example/r/1?x=2")], "html string, url string")
    got = rows.select(F.explode(H.links(F.col("html"))).alias("l"), "url").select(H.absolute_url(F.col("l.href"), F.col("url")).alias("u"), "l.label").collect()
    assert [(r.u, r.label) for r in got] == [("https://a.example/f/Bang%20so.xlsx", "So lieu & 1"), ("https://a.example/r/b.pdf", "p")]
    assert values(spark, ["https://a.example/f/Bang%20so.xlsx?v=1"], H.filename) == ["Bang so.xlsx"]
    assert values(spark, ["http://x/a.XLS", "http://x/a.zip", "http://x/a"], H.attachment_type) == ["xls", "other", "other"]
