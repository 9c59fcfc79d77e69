"""Metric names taken apart, growth rates and base-scale values."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Multipliers of the scales; fixed values.
MULTIPLIERS = {"thousand": 1e3, "million": 1e6, "billion": 1e9, "trillion": 1e12}


def _first(text: Column, pattern: str) -> Column:
    return F.nullif(F.regexp_extract(F.lower(text), pattern, 1), F.lit(""))


def metric_parts(name: Column, report_year: Column) -> dict[str, Column]:
    """The columns that a stacked header name breaks into, in output order."""
    month, year, months = _first(name, "thang *([0-9]{1,2})(?![0-9])"), _first(name, "nam *([0-9]{4})"), _first(name, "([0-9]{1,2}) *thang")
    basis = F.when(name.rlike("(?i)so bo"), "preliminary").when(name.rlike("(?i)uoc tinh|uoc thuc hien"), "estimated").when(name.rlike("(?i)chinh thuc"), "final")
    measure = F.when(name.rlike("(?i)(^|/) *luong *(/|$)"), "quantity").when(name.rlike("(?i)(^|/) *tri gia"), "value")
    quarter = F.when(name.rlike("(?i)quy *iv"), 4).when(name.rlike("(?i)quy *iii"), 3).when(name.rlike("(?i)quy *ii"), 2).when(name.rlike("(?i)quy *i([^ivx]|$)"), 1)
    comparison = F.when(name.rlike("(?i)cung ky|nam truoc"), "yoy").when(name.rlike("(?i)thang truoc"), "mom").when(name.rlike("(?i)ke hoach"), "vs_plan")
    grain = (
        F.when(month.isNotNull(), "month").when(months == "12", "year").when(months == "1", "month").when(months.isNotNull(), "ytd_cumulative")
        .when(name.rlike("(?i)quy *(i|ii|iii|iv)"), "quarter").when(year.isNotNull(), "year")
    )
    return {
        "metric_basis": basis,
        "metric_measure": measure,
        "metric_ref_month": month.cast("int"),
        "metric_ref_year": year.cast("int"),
        "metric_ref_quarter": quarter,
        "metric_cumulative_months": months.cast("int"),
        "metric_comparison": comparison,
        "metric_period_grain": grain,
        "metric_ref_year_effective": F.coalesce(year.cast("int"), report_year),
    }


def multiplier(scale: Column) -> Column:
    out = F.lit(1.0)
    for name, factor in MULTIPLIERS.items():
        out = F.when(scale == name, factor).otherwise(out)
    return out


def base_scale(value: Column, factor: Column) -> Column:
    return F.coalesce(value * factor, value)


def growth_pct(metric_type: Column, unit: Column, value: Column) -> Column:
    """Growth in percent of a base-100 value, where the row is index-like; else null."""
    index_like = (unit == "%") | value.between(20.0, 400.0)
    return F.when(metric_type == "index_yoy_base100", value - 100.0).when(metric_type.isin("yoy_growth", "mom_growth") & index_like, value - 100.0)


def analytical_unit(metric_type: Column, unit: Column) -> Column:
    return (
        F.when(metric_type.isin("index_yoy_base100", "yoy_growth"), "Percent change vs same period previous year")
        .when(metric_type == "mom_growth", "Percent change vs previous month")
        .when(metric_type == "index", "Index")
        .otherwise(unit)
    )
