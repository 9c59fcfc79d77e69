"""Text normalisation as Column expressions.

Java's `\\s` and Spark's trim do not know the no-break space; `(?U)` makes the class Unicode-wide.
"""

from __future__ import annotations

import functools
import re
import unicodedata

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .bind import let

#: White space but the plain blank, as `(?U)\s` has it; runs of one plain blank need no replacement.
_RARE = r"\t-\r\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"
NBSP = " "

#: Legacy single-byte glyphs and the letters they stand for; fixed values.
LEGACY_GLYPHS = "µ¸¶·¹¨¾»¼½Æ©ÊÇÈÉËÌÐÎÏÑªÕÒÓÔÖ×ÝØÜÞßãáâä«èåæçé¬íêëìîïóñòô­øõö÷ùúýûþ§¡¢£¤¥¦®"
LEGACY_LETTERS = "àáảãạăắằẳẵặâấầẩẫậèéẻẽẹêếềểễệìíỉĩịòóỏõọôốồổỗộơớờởỡợùúủũụưứừửữựỳỷỹỵđĂÂÊÔƠƯĐ"
#: Glyphs that are letters in no ordinary font, so that they are evidence; fixed values.
LEGACY_EVIDENCE = "µ¸¶·¹¨¾»¼½Æ©ª«¬­®§¡¢£¤¥¦×÷"
#: A text with one of these is proper Unicode already; fixed values.
BEYOND_LATIN1 = "[ĂăĐđĨĩŨũƠơƯưẠ-ỹ]"


@functools.cache
def _folding() -> tuple[str, str]:
    """Letters that decompose into one base character and marks, and those bases, by rule."""
    source, base = [], []
    for code in range(0xC0, 0x10000):
        if 0xD800 <= code < 0xE000:
            continue
        parts = unicodedata.normalize("NFD", chr(code))
        kept = "".join(c for c in parts if unicodedata.category(c) != "Mn")
        if len(parts) > 1 and len(kept) == 1:
            source.append(chr(code))
            base.append(kept)
    return "".join(source) + "Đđ", "".join(base) + "Dd"


def clean_cell(c: Column) -> Column:
    """Collapse white space, no-break spaces included, and trim; null becomes empty."""
    return F.trim(F.regexp_replace(F.coalesce(c, F.lit("")), rf"[{_RARE}][ {_RARE}]*| [ {_RARE}]+", " "))


def strip_accents(c: Column) -> Column:
    source, base = _folding()
    # a text of as many bytes as characters is plain ASCII and has none
    return let(c, lambda t: F.when(F.octet_length(t) == F.length(t), t).otherwise(F.regexp_replace(F.translate(t, source, base), r"\p{Mn}+", "")))


def norm(c: Column) -> Column:
    """Cleaned, without accents, in lower case."""
    return F.lower(strip_accents(clean_cell(c)))


def normalize_name(c: Column) -> Column:
    """Cleaned and in lower case, accents kept."""
    return F.lower(clean_cell(c))


def trim_cell_text(c: Column, most: int = 20_000, mark: str = "…[truncated]") -> Column:
    """Cap a cell's text and mark the cut."""
    return F.when(F.length(c) > most, F.concat(F.substring(c, 1, most), F.lit(mark))).otherwise(c)


def legacy_to_unicode(c: Column) -> Column:
    """Translate legacy glyphs, unless the text holds letters that prove it to be Unicode."""
    return F.when(c.rlike(BEYOND_LATIN1), c).otherwise(F.translate(c, LEGACY_GLYPHS, LEGACY_LETTERS))


def legacy_hits(c: Column) -> Column:
    """Number of glyphs that are evidence of the legacy encoding."""
    return F.length(F.regexp_replace(F.coalesce(c, F.lit("")), f"[^{re.escape(LEGACY_EVIDENCE)}]", ""))


def encoding_from_hits(hits: Column, convert: int = 3, review: int = 1) -> Column:
    return F.when(hits >= convert, "tcvn3").when(hits >= review, "possible_legacy_low_confidence").otherwise("unicode")


def detect_sheet_encoding(cells: DataFrame, sheet: str = "sheet_id", row: str = "row", col: str = "col", value: str = "value", sample: int = 300) -> DataFrame:
    """sheet, hits, detected_text_encoding from the first `sample` texts of every sheet."""
    from pyspark.sql import Window as W

    first = W.partitionBy(sheet).orderBy(row, col)
    head = cells.filter(F.col(value).isNotNull()).withColumn("_n", F.row_number().over(first)).filter(F.col("_n") <= sample)
    counted = head.groupBy(sheet).agg(F.sum(legacy_hits(F.col(value))).cast("long").alias("hits"))
    return counted.withColumn("detected_text_encoding", encoding_from_hits(F.col("hits")))


def repair_unicode(c: Column, legacy: Column) -> Column:
    """Translate where the sheet is legacy, collapse white space, empty to null."""
    return F.nullif(clean_cell(F.when(legacy, legacy_to_unicode(c)).otherwise(c)), F.lit(""))


RULE_TEXT = re.compile(r"^[A-Za-z][A-Za-z ,;]*$")


def check_corrections(rules: list[tuple[str, str]]) -> None:
    """Raise unless all rules are letters, spaces, commas and semicolons only."""
    bad = [r for r in rules if not all(RULE_TEXT.match(side) for side in r)]
    if bad:
        raise ValueError(f"correction rules with other characters: {bad}")


def apply_corrections(c: Column, rules: list[tuple[str, str]]) -> Column:
    """Whole-word replacements, one after the other; the order decides."""
    for wrong, right in rules:
        c = F.regexp_replace(c, rf"\b{wrong}\b", right)
    return c


def normalized_cell(c: Column) -> Column:
    """A repaired cell text without marks, with the artefacts that were known when cells were first read corrected."""
    rules = CORRECTIONS[:CELL_RULES]
    suspicious = "|".join(wrong for wrong, _ in rules)
    return let(strip_accents(c), lambda t: F.nullif(F.when(t.rlike(suspicious), clean_cell(apply_corrections(t, rules))).otherwise(clean_cell(t)), F.lit("")))


def corrected_label(c: Column, rules: list[tuple[str, str]]) -> Column:
    """As correct_labels, where each value is read once or twice only: the rules run over suspicious values."""
    check_corrections(rules)
    return F.when(c.rlike("|".join(wrong for wrong, _ in rules)), let(clean_cell(c), lambda t: apply_corrections(t, rules))).otherwise(c)


def correct_labels(df: DataFrame, column: str, rules: list[tuple[str, str]]) -> DataFrame:
    """df with a column's known artefacts corrected.

    The rules run over the distinct suspicious values only, found by one unanchored pattern, and the
    few that change are joined back.
    """
    check_corrections(rules)
    suspicious = "(" + "|".join(wrong for wrong, _ in rules) + ")"
    labels = df.select(F.col(column).alias("_label")).filter(F.col("_label").rlike(suspicious)).distinct()
    fixed = labels.withColumn("_fixed", apply_corrections(clean_cell(F.col("_label")), rules)).filter("_fixed <> _label")
    joined = df.join(fixed, F.col(column) == F.col("_label"), "left")
    return joined.withColumn(column, F.coalesce("_fixed", F.col(column))).drop("_label", "_fixed")


#: Of the corrections, those that cells get as they are read; labels get all of them.
CELL_RULES = 124
#: Corrections of labels garbled by an old conversion, in order; fixed values.
CORRECTIONS = [
    ("Hang hoo khoc", "Hang hoa khac"), ("hang hoo khoc", "hang hoa khac"), ("Hang hua", "Hang hoa"), ("hang hua", "hang hoa"),
    ("hua", "hoa"), ("Hua", "Hoa"), ("hoo", "hoa"), ("Hoo", "Hoa"), ("khoc", "khac"), ("Khoc", "Khac"),
    ("cho thuo", "cho thue"), ("Cho thuo", "Cho thue"), ("may muc", "may moc"), ("May muc", "May moc"), ("kho boi", "kho bai"), ("Kho boi", "Kho bai"),
    ("cu lion quan", "co lien quan"), ("Cu lion quan", "Co lien quan"), ("cu lien quan", "co lien quan"), ("Cu lien quan", "Co lien quan"),
    ("lion quan", "lien quan"), ("Lion quan", "Lien quan"), ("coc loai", "cac loai"), ("Coc loai", "Cac loai"),
    ("coc dich vu", "cac dich vu"), ("Coc dich vu", "Cac dich vu"), ("coc san pham", "cac san pham"), ("Coc san pham", "Cac san pham"),
    ("coc thiet bi", "cac thiet bi"), ("Coc thiet bi", "Cac thiet bi"), ("Bon buun", "Ban buon"), ("bon buun", "ban buon"),
    ("bon le", "ban le"), ("Bon le", "Ban le"), ("u tu", "o to"), ("U tu", "O to"),
    ("mu tu", "mo to"), ("Mu tu", "Mo to"), ("cu dong", "co dong"), ("Cu dong", "Co dong"),
    ("Nung, lom nghiep", "Nong, lam nghiep"), ("nung, lom nghiep", "nong, lam nghiep"), ("Nung nghiep", "Nong nghiep"), ("nung nghiep", "nong nghiep"),
    ("Lom nghiep", "Lam nghiep"), ("lom nghiep", "lam nghiep"), ("phEm", "pham"), ("thop", "thep"), ("tiou", "tieu"), ("Nghon", "Nghin"), ("nghon", "nghin"),
    ("tonh", "tinh"), ("Tonh", "Tinh"), ("toch", "tich"), ("Toch", "Tich"), ("moy", "may"), ("Moy", "May"), ("Tri gio", "Tri gia"), ("tri gio", "tri gia"),
    ("TriOu", "Trieu"), ("TRiOu", "Trieu"), ("triOu", "trieu"), ("Gioo duc va dao tao", "Giao duc va dao tao"), ("giai tro", "giai tri"),
    ("Bon buun; bon le; sua chua u tu, xe may", "Ban buon; ban le; sua chua o to, xe may"),
    ("Dich vu viec lam; du lich; cho thuo may muc thiet bi, do dung va coc dich vu ho tro khoc", "Dich vu viec lam; du lich; cho thue may moc thiet bi, do dung va cac dich vu ho tro khac"),
    ("Hua chat", "Hoa chat"), ("Kho dot hua long", "Kho dot hoa long"), ("Thanh Hua", "Thanh Hoa"), ("Kim loai thuong khoc", "Kim loai thuong khac"), ("Giay coc loai", "Giay cac loai"),
    ("Cung cap nuoc; hoat dong quan ly va xu ly roc thai, nuoc thai", "Cung cap nuoc; hoat dong quan ly va xu ly rac thai, nuoc thai"),
    ("San xuat da va coc san pham cu lion quan", "San xuat da va cac san pham co lien quan"), ("San xuat san pham thuoc lo", "San xuat san pham thuoc la"),
    ("San xuat thuoc, hoo duoc va duoc lieu", "San xuat thuoc, hoa duoc va duoc lieu"),
    ("Hoat dong thu gom, xu ly va tieu huy roc thai; toi che phe lieu", "Hoat dong thu gom, xu ly va tieu huy rac thai; tai che phe lieu"),
    ("Bonh Duong", "Binh Duong"), ("Thoi Bonh", "Thai Binh"), ("Bonh Dinh", "Binh Dinh"), ("Gioo", "Giao"), ("gioo", "giao"), ("thuoc lo", "thuoc la"), ("Thuoc lo", "Thuoc la"),
    ("roc thai", "rac thai"), ("Roc thai", "Rac thai"), ("toi che", "tai che"), ("cu lion quan", "co lien quan"), ("coc dich vu lion quan", "cac dich vu lien quan"),
    ("Dich vu kho boi va cac dich vu lien quan den ho tro van tai", "Dich vu kho bai va cac dich vu lien quan den ho tro van tai"),
    ("Bon buun va bon le; sua chua u tu, mu tu, xe may va xe cu dong co khoc", "Ban buon va ban le; sua chua o to, mo to, xe may va xe co dong co khac"),
    ("Cung cap nuoc, hoat dong quan ly va xu ly rac thai, nuoc thai", "Cung cap nuoc; hoat dong quan ly va xu ly rac thai, nuoc thai"),
    ("Nuoc tu nhion khai thoc", "Nuoc tu nhien khai thac"), ("Lom nghiep va dich vu co lien quan", "Lam nghiep va dich vu co lien quan"), ("Nung nghiep va dich vu co lien quan", "Nong nghiep va dich vu co lien quan"),
    ("Det, trang phuc, da va coc san pham co lien quan", "Det, trang phuc, da va cac san pham co lien quan"), ("Da va coc san pham co lien quan", "Da va cac san pham co lien quan"),
    ("Hoat dog thu gom", "Hoat dong thu gom"), ("Van hoo", "Van hoa"), ("Bonh keo", "Banh keo"), ("Bonh quon", "Banh quan"), ("bonh", "banh"), ("Bonh", "Banh"),
    ("Cung nghiep", "Cong nghiep"), ("cung nghiep", "cong nghiep"), ("cung nghe", "cong nghe"), ("Cung nghe", "Cong nghe"), ("chuyon mun", "chuyen mon"), ("Chuyon mun", "Chuyen mon"),
    ("chuyon", "chuyen"), ("Chuyon", "Chuyen"), ("hang khung", "hang khong"), ("Hang khung", "Hang khong"), ("khung kho", "khong khi"), ("Khung kho", "Khong khi"),
    ("nuoc nung", "nuoc nong"), ("Nuoc nung", "Nuoc nong"), ("Chi so gio", "Chi so gia"), ("chi so gio", "chi so gia"), ("hanh chonh", "hanh chinh"), ("Hanh chonh", "Hanh chinh"),
    ("gia donh", "gia dinh"), ("Gia donh", "Gia dinh"), ("coc cung viec", "cac cong viec"), ("Coc cung viec", "Cac cong viec"), ("lam thuo", "lam thue"), ("Lam thuo", "Lam thue"),
    ("coc ho", "cac ho"), ("Coc ho", "Cac ho"), ("khoong san", "khoang san"), ("Khoong san", "Khoang san"), ("Kho dot", "Khi dot"), ("kho dot", "khi dot"),
    ("Khai khoong", "Khai khoang"), ("khai khoong", "khai khoang"), ("Giay dop", "Giay dep"), ("giay dop", "giay dep"), ("Giau dep", "Giay dep"), ("giau dep", "giay dep"),
    ("Nguyon", "Nguyen"), ("nguyon", "nguyen"), ("mu nun", "mu non"), ("Mu nun", "Mu non"),
]
