"""Units, scales, currencies and metric types from header and label text.

Every function takes and gives Columns. `folded` arguments are texts that norm() has folded.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .bind import let
from .text import clean_cell, norm

#: Patterns on folded text and the unit each stands for, in order; fixed values.
UNIT_PHRASES = [
    (r"nghin\s+ty\s+dong", "Thousand billion VND"),
    (r"ty\s+dong", "Billion VND"),
    (r"trieu\s+dong", "Million VND"),
    (r"nghin\s+dong", "Thousand VND"),
    (r"vnd|dong", "VND"),
    (r"trieu\s+usd", "Million USD"),
    (r"nghin\s+usd", "Thousand USD"),
    (r"usd", "USD"),
    (r"trieu\s+tan", "Million tonnes"),
    (r"nghin\s+tan", "Thousand tonnes"),
    (r"\btan\b", "Tonnes"),
    (r"trieu\s+ha", "Million ha"),
    (r"nghin\s+ha", "Thousand ha"),
    (r"\bha\b", "Ha"),
    (r"trieu\s+nguoi", "Million persons"),
    (r"nghin\s+nguoi", "Thousand persons"),
    (r"\bnguoi\b", "Persons"),
    (r"trieu\s+luot", "Million visits"),
    (r"nghin\s+luot", "Thousand visits"),
    (r"\bluot\b", "Visits"),
    (r"trieu\s+khach", "Million visitors"),
    (r"nghin\s+khach", "Thousand visitors"),
    (r"doanh\s+nghiep", "Enterprises"),
    (r"lao\s+dong", "Workers"),
    (r"phan\s+tram|%", "%"),
]
#: Units of money; fixed values.
CURRENCY_UNITS = ["USD", "Thousand USD", "Million USD", "VND", "Thousand VND", "Million VND", "Billion VND", "Thousand billion VND"]
#: Metric types that compare rather than measure; fixed values.
COMPARISONS = ["yoy_growth", "mom_growth", "index", "index_yoy_base100", "share", "percent"]

CAPTION = r"(don vi tinh|don vi|unit)"
PAIR = r"(?i)([A-Za-z%][^|;,]{0,28}?)\s*(?:;|,|\bva\b)\s*([^|;,]{0,28}?(?:usd|vnd|dong)[^|;,]{0,12})"
PARENTHESES = r"\(([^)]+)\)"


def _trim(c: Column, characters: str) -> Column:
    return F.btrim(c, F.lit(characters))


def _empty_to_null(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def metric_type(text: Column) -> Column:
    def of(t: Column) -> Column:
        return (
            F.when(t.rlike("thang truoc"), "mom_growth")
            .when(t.rlike("cung ky|nam truoc|so voi"), "yoy_growth")
            .when(t.rlike("co cau|ty trong"), "share")
            .when(text.contains("%") | t.rlike("phan tram"), "percent")
            .when(t.rlike("chi so|index"), "index")
            .when(t.rlike(r"cong don|luy ke|thang dau nam|\b[0-9]+ thang\b"), "ytd_value")
            .otherwise("value")
        )

    return let(norm(text), of)


def scale(text: Column) -> Column:
    def of(t: Column) -> Column:
        return (
            F.when(t.rlike("%|phan tram"), "percent")
            .when(t.rlike("nghin ty"), "trillion")
            .when(t.rlike("ty|billion"), "billion")
            .when(t.rlike("trieu|million"), "million")
            .when(t.rlike("nghin|thousand"), "thousand")
            .when(t.rlike("chi so"), "index")
        )

    return let(norm(text), of)


def currency(text: Column) -> Column:
    return let(norm(text), lambda t: F.when(t.rlike("usd|do la"), "USD").when(t.rlike("dong|vnd"), "VND"))


def _phrase(t: Column) -> Column:
    out = F.when(t == "", F.lit(None).cast("string"))
    for pattern, label in UNIT_PHRASES:
        out = out.when(t.rlike(pattern), label)
    return out


def unit_phrase(text: Column) -> Column:
    """The first unit of the list that the text names, or null."""
    return let(norm(text), _phrase)


def _is_unit(t: Column) -> Column:
    short = (F.length(t) <= 50) & (F.size(F.split(t, " ")) <= 5) & t.rlike("|".join(p for p, _ in UNIT_PHRASES))
    return (t != "") & (t.isin("%", "phan tram", "diem phan tram") | short)


def is_unit_text(text: Column) -> Column:
    """Whether a text is compact enough to be a unit and nothing else."""
    return let(norm(text), _is_unit)


def unit_text(text: Column) -> Column:
    """The text without a unit caption before it, if it is a unit; else null."""

    def body(raw: Column) -> Column:
        captioned = norm(raw).rlike(rf"^{CAPTION}\b") & raw.rlike("[:：-]")
        rest = F.when(captioned, F.regexp_replace(raw, "(?s)^[^:：-]*[:：-]", "")).otherwise(raw)
        return clean_cell(_trim(F.regexp_replace(rest, rf"(?i)^{CAPTION}\s*[:：-]?\s*", ""), " .;,-"))

    return let(let(clean_cell(text), body), lambda b: F.when(is_unit_text(b), b))


def unit_from_label(label: Column) -> Column:
    """What the first brackets of a label say, unit or not."""
    return let(_empty_to_null(F.regexp_extract(clean_cell(label), PARENTHESES, 1)), lambda inside: F.coalesce(unit_text(inside), F.trim(inside)))


def _unit_or_phrase(text: Column) -> Column:
    return let(text, lambda t: F.coalesce(unit_text(t), unit_phrase(t)))


def unit_from_text(text: Column) -> Column:
    """Unit of a header or title: in brackets, else the whole text, else a unit it names."""

    def of(raw: Column) -> Column:
        found = F.filter(F.transform(F.regexp_extract_all(raw, F.lit(PARENTHESES), F.lit(1)), _unit_or_phrase), lambda u: u.isNotNull())
        return F.coalesce(F.try_element_at(found, F.lit(1)), _unit_or_phrase(raw))

    return let(clean_cell(text), of)


def unit_from_caption(cell: Column, neighbours: list[Column]) -> Column:
    """Unit of a "unit:" cell: behind the caption, behind its punctuation, or in one of the next cells."""
    after = F.trim(F.regexp_replace(clean_cell(cell), rf"(?i)^.*?{CAPTION}\s*[:：-]?\s*", ""))
    behind = F.when(cell.rlike("[:：-]"), unit_text(F.regexp_replace(clean_cell(cell), "(?s)^[^:：-]*[:：-]", "")))
    return F.when(norm(cell).rlike(CAPTION), F.coalesce(_unit_or_phrase(after), behind, *map(_unit_or_phrase, neighbours)))


def combined_caption(*texts: Column) -> Column:
    """A two-part caption such as "Nghin tan; Trieu USD": a unit that is no currency, and one that is."""

    def of(raw: Column) -> Column:
        pairs = F.arrays_zip(F.regexp_extract_all(raw, F.lit(PAIR), F.lit(1)).alias("a"), F.regexp_extract_all(raw, F.lit(PAIR), F.lit(2)).alias("b"))
        tidy = F.transform(pairs, lambda p: F.struct(
            _trim(F.regexp_replace(_trim(p["a"], " .;,:"), r"(?i)^\s*(don vi tinh|don vi|unit)\s*[:\-]?\s*", ""), " .;,:").alias("a"), _trim(p["b"], " .;,:").alias("b")))
        good = F.filter(tidy, lambda p: (p["a"] != "") & (p["b"] != "") & ~F.coalesce(unit_phrase(p["a"]), F.lit("USD")).isin(CURRENCY_UNITS) & F.coalesce(unit_phrase(p["b"]), F.lit("")).isin(CURRENCY_UNITS))
        return let(F.try_element_at(good, F.lit(1)), lambda p: F.concat(p["a"], F.lit("; "), p["b"]))

    return F.coalesce(*[let(clean_cell(t), of) for t in texts])


def split_caption(caption: Column, measure: str) -> Column:
    """The currency side of a two-part caption for `value`, the other side for `quantity`."""
    parts = F.filter(F.transform(F.split(clean_cell(caption), r"(?i)\s*(?:;|,|\bva\b|\band\b)\s*"), lambda p: _trim(p, " .;,:")), lambda p: p != "")

    def pick(p: Column) -> Column:
        money = F.filter(p, lambda x: norm(x).rlike(r"usd|vnd|\bdong\b"))
        wanted = money if measure == "value" else F.filter(p, lambda x: ~norm(x).rlike(r"usd|vnd|\bdong\b"))
        return F.when((F.size(p) == 2) & (F.size(money) == 1), F.element_at(wanted, 1))

    return let(parts, pick)


def observation_unit(label: Column, row_unit: Column, kind: Column, explicit: Column, metric: Column, header_unit: Column, title_unit: Column) -> Column:
    """A row's unit by precedence; the row's own unit column says nothing about comparisons, and a title's % is not inherited."""
    return chosen_unit(unit_from_label(label), row_unit, kind, explicit, unit_from_text(metric), header_unit, title_unit)


def chosen_unit(label_unit: Column, row_unit: Column, kind: Column, explicit: Column, metric_unit: Column, header_unit: Column, title_unit: Column) -> Column:
    """As observation_unit, from the units of the label and of the metric."""
    own = F.when(~kind.isin(COMPARISONS), _empty_to_null(row_unit))
    return F.coalesce(label_unit, own, explicit, metric_unit, header_unit, F.when(F.trim(title_unit) != "%", title_unit))


def settle_semantics(sheet_name: Column, subdomain: Column, metric: Column, unit: Column, kind: Column, scale_: Column, combined: Column, explicit: Column, title: Column) -> Column:
    """struct<unit_raw, metric_type, scale> after the corrections for production indices and trade tables."""
    out = lambda u, k, s: F.struct(u.alias("unit_raw"), k.alias("metric_type"), s.alias("scale"))
    usable = lambda u: F.when(~u.isin("Million USD", "Thousand USD", "USD", "%"), u)

    def side(caption: Column) -> Column:
        return let(split_caption(caption, "quantity"), lambda x: F.coalesce(unit_phrase(x), x))

    index = (subdomain == "industrial_production_index") | norm(sheet_name).rlike(r"^\s*2\s*[._-]?\s*iip")
    trade = subdomain.isin("exports", "imports")

    def of(key: Column) -> Column:
        forced = out(F.lit("Index (comparison period=100)"), F.when(key.rlike("cung ky|nam truoc"), "index_yoy_base100").otherwise("index"), F.lit("index"))
        against = out(F.lit("Index (same period previous year=100)"), F.lit("index_yoy_base100"), F.lit("index"))
        measured = F.coalesce(usable(unit_phrase(metric)), usable(F.coalesce(*map(side, (combined, unit, explicit, title)))))
        quantity = let(measured, lambda m: F.when(m.isNotNull(), out(m, kind, scale(m))).otherwise(out(unit, kind, scale_)))
        return (
            F.when(index, forced).when(trade & key.rlike("so voi|cung ky"), against)
            .when(trade & key.rlike("tri gia|value"), out(F.lit("Million USD"), kind, F.lit("million")))
            .when(trade & key.rlike("luong|quantity"), quantity).otherwise(out(unit, kind, scale_))
        )

    return F.when(index | trade, let(norm(metric), of)).otherwise(out(unit, kind, scale_))


def reconcile_type(kind: Column, unit: Column, value: Column, metric: Column) -> Column:
    """Growth with a level unit and a level-sized value is a level, cumulative if the header counts months."""
    level = kind.isin("yoy_growth", "mom_growth") & (F.trim(unit) != "") & (F.trim(unit) != "%") & (F.abs(value) > 1000)
    return F.when(F.coalesce(level, F.lit(False)), F.when(norm(metric).rlike(r"\b[0-9]+\s*thang\b"), "ytd_value").otherwise("value")).otherwise(kind)
