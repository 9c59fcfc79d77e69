"""Dates and periods named in Vietnamese report titles."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Month names; fixed values.
MONTH_WORDS = {
    "một": 1, "mot": 1, "hai": 2, "ba": 3, "tư": 4, "tu": 4, "bốn": 4, "bon": 4, "năm": 5, "nam": 5, "sáu": 6, "sau": 6, "bảy": 7, "bay": 7, "tám": 8, "tam": 8,
    "chín": 9, "chin": 9, "mười": 10, "muoi": 10, "mười một": 11, "muoi mot": 11, "mười hai": 12, "muoi hai": 12,
}


def parse_date(c: Column) -> Column:
    """The first dd/mm/yyyy anywhere in a text; impossible dates are null."""
    pattern = r"([0-9]{1,2})/([0-9]{1,2})/([0-9]{4})"
    part = lambda i: F.nullif(F.regexp_extract(c, pattern, i), F.lit(""))
    return F.concat_ws("-", part(3), F.lpad(part(2), 2, "0"), F.lpad(part(1), 2, "0")).try_cast("date")


def month_from_title(title: Column) -> Column:
    """Month in a title: digits first, then words, longest first.

    The word for May is also the word for "year": a month word that a year or a this/last-year word
    follows is not a month.
    """
    low = F.lower(title)
    found = [F.nullif(F.regexp_extract(low, r"(?U)tháng\s+(\d{1,2})\b", 1), F.lit("")).try_cast("int")]
    for word in sorted(MONTH_WORDS, key=len, reverse=True):
        found.append(F.when(low.rlike(rf"(?U)tháng\s+{word}\b(?!\s*(?:20\d{{2}}|nay\b|ngo[aá]i\b))"), MONTH_WORDS[word]))
    return F.coalesce(*found)


def classify_report(title: Column) -> Column:
    """struct<sub_category, period_type, report_year, report_month, report_quarter, period_months_covered, period_start_date, period_end_date>.

    Annual comes before quarterly, quarterly before cumulative, cumulative before a single month.
    The second quarter or six months make a half-year; an annual title without a month gets 12.
    """
    low = F.lower(title)
    number = lambda pattern, i=1: F.nullif(F.regexp_extract(low, pattern, i), F.lit("")).try_cast("int")
    year, month, months = number("(20[0-9]{2})"), month_from_title(title), number(r"(?U)([0-9]{1,2})\s+tháng")
    roman = F.regexp_extract(low, r"(?U)quý\s+(iv|iii|ii|i|[1-4])\b", 1)
    quarter = F.when(roman == "i", 1).when(roman == "ii", 2).when(roman == "iii", 3).when(roman == "iv", 4).otherwise(F.nullif(roman, F.lit("")).try_cast("int"))
    annual = low.contains("năm ") & (low.contains("quý iv") | low.contains(" cả năm") | low.rlike(r"(?U)và\s+năm\s+20\d{2}"))
    half = (quarter == 2) | (F.coalesce(months, F.lit(0)) == 6)
    long_text = low.contains("và") | low.contains("tháng")

    base = F.struct(year.alias("y"), month.alias("m"), quarter.alias("q"), months.alias("n"), annual.alias("annual"), half.alias("half"), long_text.alias("long"))

    def decide(s: Column) -> Column:
        kind = (
            F.when(s["annual"], "annual").when(s["q"].isNotNull(), F.when(s["half"], "semi_annual").otherwise("quarterly"))
            .when(s["m"].isNotNull() & (s["n"] > 1), "monthly_cumulative").when(s["m"].isNotNull(), "monthly_single_month").otherwise("special_or_unknown")
        )
        return F.struct(kind.alias("kind"), s["y"].alias("y"), s["m"].alias("m"), s["q"].alias("q"), s["n"].alias("n"), s["long"].alias("long"))

    def fill(s: Column) -> Column:
        kind, y, m, q, n = (s[k] for k in ("kind", "y", "m", "q", "n"))
        day = lambda month, d: F.when(y.isNotNull(), F.make_date(y, month, F.lit(d)))
        month_out = F.when(kind == "annual", F.coalesce(m, F.lit(12))).otherwise(m)
        covered = F.when(kind == "annual", 12).when(kind == "semi_annual", 6).when(kind == "quarterly", F.when(s["long"], q * 3).otherwise(3)).when(kind == "monthly_single_month", 1).otherwise(n)
        safe = F.when(m.between(1, 12), m)
        start = F.when(kind.isin("annual", "semi_annual", "monthly_cumulative"), day(F.lit(1), 1)).when(kind == "quarterly", day(q * 3 - 2, 1)).when(kind == "monthly_single_month", day(safe, 1))
        end = F.when(kind == "annual", day(F.lit(12), 31)).when(kind == "semi_annual", day(F.lit(6), 30)).when(kind == "quarterly", F.last_day(day(q * 3, 1))).when(kind.startswith("monthly"), F.last_day(day(safe, 1)))
        period = F.when(kind.startswith("monthly"), "monthly").when(kind == "special_or_unknown", "unknown").otherwise(kind)
        return F.struct(
            kind.alias("sub_category"), period.alias("period_type"), y.alias("report_year"), month_out.alias("report_month"), q.alias("report_quarter"),
            covered.alias("period_months_covered"), start.alias("period_start_date"), end.alias("period_end_date"),
        )

    # One-element arrays keep the parsed parts from being computed again in every branch.
    return F.transform(F.transform(F.array(base), decide), fill)[0]
