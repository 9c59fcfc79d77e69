"""Repair of observations that were filed under the wrong domain, by their sheet's code."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.upsert import move_rows, reconcile_counts, update_where

c = F.col

EXPORTS, TRADE, PRODUCTION = r"^14[. _-]*xk", r"^(14[. _-]*xk|15[. _-]*nk)", r"^2[. _-]*iip"


def sheet_code(name: str = "source_sheet_name") -> Column:
    return F.lower(F.trim(name))


def repair_observations(observations: DataFrame) -> DataFrame:
    """Trade and production sheets get their domain, unit, type and scale; expressions see the old values."""
    metric, code = F.lower("metric_name_raw"), sheet_code()
    side = F.when(code.rlike(EXPORTS), "exports").otherwise("imports")
    compared, valued = metric.rlike("so voi|cung ky"), metric.contains("tri gia")
    sure = {"extraction_confidence": F.lit(1.0), "needs_review": F.lit(False)}
    trade = {
        "indicator_domain": F.lit("trade_prices"), "indicator_subdomain": side, "extraction_method": F.concat(F.lit("sheet_name_override:"), side), **sure,
        "unit_raw": F.when(compared, "Index (same period previous year=100)").when(valued, "Million USD").otherwise(c("unit_raw")), "metric_type": F.when(compared, "index_yoy_base100").otherwise(c("metric_type")),
        "scale": F.when(compared, "index").when(valued, "million").otherwise(c("scale")), "currency": F.when(valued, "USD").otherwise(c("currency")),
    }
    index = {
        "indicator_domain": F.lit("industry"), "indicator_subdomain": F.lit("industrial_production_index"), "extraction_method": F.lit("sheet_name_override:industrial_production_index"), **sure,
        "unit_raw": F.lit("Index (comparison period=100)"), "metric_type": F.when(metric.rlike("cung ky|nam truoc"), "index_yoy_base100").otherwise("index"), "scale": F.lit("index"), "currency": F.lit(None).cast("string"),
    }
    return update_where(update_where(observations, code.rlike(TRADE), trade), code.rlike(PRODUCTION), index)


def move_trade_rows(investment: DataFrame, trade: DataFrame, key: str = "indicator_observation_id") -> tuple[DataFrame, DataFrame]:
    """(investment without trade sheets, trade with the rows that it lacked)."""
    return move_rows(investment, trade, sheet_code().rlike(TRADE), [key])


def repair_log(log: DataFrame, observations: DataFrame) -> DataFrame:
    return reconcile_counts(log, observations, "attachment_id", "extraction_rows_inserted", "extraction_status")
