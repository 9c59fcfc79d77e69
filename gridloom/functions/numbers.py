"""Numbers in cells: mixed decimal conventions, accounting negatives, year tokens, cell references."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .bind import let
from .text import clean_cell

#: Cells that mean "no value"; fixed values.
BLANKS = ["", "-", "–", "—", "...", "."]


def looks_like_year(c: Column) -> Column:
    return F.coalesce(c.rlike(r"(?U)^\s*(19|20)[0-9]{2}\s*$"), F.lit(False))


def to_number(c: Column) -> Column:
    """The number that a whole cell spells, or null.

    A cell counts only if it is digits, blanks, dots and commas altogether, after a sign, brackets
    for negatives and percent signs are taken off. A final comma with other than three digits behind
    it is a decimal comma, and dots before it are separators; otherwise commas are separators. Plain
    numbers and cells without a digit or with a letter, which are nearly all, are settled by a pattern each.
    """

    def unwrap(s: Column) -> Column:
        bracketed = s.rlike(r"^\(.+\)$")
        inner = F.when(bracketed, F.trim(F.regexp_extract(s, r"^\((.*)\)$", 1))).otherwise(s)
        return F.struct((~s.isin(BLANKS)).alias("some"), bracketed.alias("bracketed"), inner.alias("inner"))

    def unsign(s: Column) -> Column:
        body = F.trim(F.regexp_replace(F.trim(F.regexp_extract(s["inner"], r"^[+-]?(.*)$", 1)), r"%+$", ""))
        return F.struct(s["some"].alias("some"), (s["bracketed"] | s["inner"].startswith("-")).alias("negative"), body.alias("body"))

    def read(s: Column) -> Column:
        body = s["body"]
        decimal_comma = body.rlike(r"[0-9],[0-9]+$") & ~body.rlike(r"[0-9],[0-9]{3}([^0-9]|$)")
        plain = F.when(decimal_comma, F.translate(F.translate(body, ". ", ""), ",", ".")).otherwise(F.translate(body, ", ", ""))
        value = F.when(s["some"] & body.rlike(r"^[0-9 .,]+$"), plain.try_cast("double"))
        return F.when(s["negative"], -value).otherwise(value)

    careful = let(let(let(clean_cell(c), unwrap), unsign), read)
    return F.when(c.rlike(r"^[0-9]+(\.[0-9]+)?$"), c.try_cast("double")).when(c.rlike(r"^[^A-Za-z]*[0-9][^A-Za-z]*$"), careful)


def column_index(letters: Column) -> Column:
    """Spreadsheet column letters to a number: A is 1, AA is 27."""
    codes = F.transform(F.split(letters, ""), lambda ch: F.ascii(ch) - 64)
    return F.aggregate(codes, F.lit(0), lambda total, code: total * 26 + code)


def column_letters(index: Column) -> Column:
    """The inverse of column_index, up to three letters."""
    letter = lambda n: F.char(65 + n)
    a = index - 1
    return F.when(index <= 26, letter(a)).when(index <= 702, F.concat(letter(F.floor((a - 26) / 26)), letter(F.pmod(a - 26, F.lit(26))))).otherwise(
        F.concat(letter(F.floor((a - 702) / 676)), letter(F.pmod(F.floor((a - 702) / 26), F.lit(26))), letter(F.pmod(a - 702, F.lit(26))))
    )
