"""Web pages: plain text, links and URL parts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Character references that are resolved; the ampersand comes last. Fixed values.
ENTITIES = [("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&apos;", "'"), ("&copy;", "©"), ("&middot;", "·"), ("&amp;", "&")]

LINK = r"""(?is)<a\s+[^>]*href=["']([^"']+\.(?:xlsx|xls|docx|doc|pdf))["'][^>]*>(.*?)</a>"""
ANCHOR = r"""(?is)<a\s+[^>]*href=["']([^"']+)["'][^>]*>(.*?)</a>"""
TYPES = ["xlsx", "xls", "xlsm", "docx", "doc", "pdf", "html"]


def clean_text(html: Column) -> Column:
    """Tags to blanks, character references resolved, white space collapsed."""
    text = F.regexp_replace(F.coalesce(html, F.lit("")), "<[^>]+>", " ")
    for entity, character in ENTITIES:
        text = F.replace(text, F.lit(entity), F.lit(character))
    return F.trim(F.regexp_replace(text, r"(?U)\s+", " "))


def links(html: Column, pattern: str = LINK) -> Column:
    """array<struct<href, label>> of a page's anchors, in order."""
    found = F.arrays_zip(F.regexp_extract_all(html, F.lit(pattern), F.lit(1)).alias("href"), F.regexp_extract_all(html, F.lit(pattern), F.lit(2)).alias("inner"))
    return F.transform(found, lambda x: F.struct(x["href"].alias("href"), clean_text(x["inner"]).alias("label")))


def absolute_url(href: Column, page: Column) -> Column:
    """A link resolved against the page it stands on: absolute, scheme-relative, rooted or beside the page."""
    scheme, host = F.regexp_extract(page, "^([a-zA-Z]+:)//", 1), F.regexp_extract(page, "^([a-zA-Z]+://[^/?#]+)", 1)
    folder = F.regexp_replace(F.regexp_extract(page, "^([^?#]*)", 1), "(?<!/)/[^/]*$", "/")
    return F.when(href.rlike("^[a-zA-Z][a-zA-Z0-9+.-]*:"), href).when(href.startswith("//"), F.concat(scheme, href)).when(href.startswith("/"), F.concat(host, href)).otherwise(F.concat(folder, href))


def url_path(url: Column) -> Column:
    return F.regexp_extract(url, "^(?:[a-zA-Z]+://[^/?#]*)?([^?#]*)", 1)


def filename(url: Column) -> Column:
    """Last segment of a URL's path, percent-decoded."""
    name = F.substring_index(url_path(url), "/", -1)
    return F.coalesce(F.try_url_decode(F.replace(name, F.lit("+"), F.lit("%2B"))), name)


def extension(name: Column) -> Column:
    return F.lower(F.regexp_extract(name, r"[^.]\.([^./]*)$", 1))


def attachment_type(url: Column) -> Column:
    ext = extension(F.lower(F.substring_index(url_path(url), "/", -1)))
    return F.when(ext.isin(TYPES), ext).otherwise("other")


def attachment_role(url: Column) -> Column:
    kind = attachment_type(url)
    return F.when(kind.isin("xlsx", "xls", "xlsm"), "statistical_tables").when(kind == "docx", "narrative").when(kind == "pdf", "pdf_attachment").otherwise("unknown")


def safe_filename(name: Column) -> Column:
    return F.regexp_replace(name, r"(?U)[^\w.\-]+", "_")


#: Types that are workbooks; fixed values.
WORKBOOK_TYPES = ["xls", "xlsx", "excel", "spreadsheet"]


def is_workbook(kind: Column, url: Column, name: Column | None = None) -> Column:
    """A workbook by its type, by its file name, or by a URL that ends so before any query."""
    by = lambda c, pattern: F.lower(F.coalesce(c, F.lit(""))).rlike(pattern)
    named = by(name, "[.](xls|xlsx|xlsm)$") if name is not None else F.lit(False)
    return F.lower(F.coalesce(kind, F.lit(""))).isin(WORKBOOK_TYPES) | named | by(url, "[.](xls|xlsx|xlsm)($|[?])")


def is_workbook_file(kind: Column, name: Column, url: Column) -> Column:
    """The stricter form for a file at hand: its name, or its URL where it has none, must end so."""
    file = F.lower(F.coalesce(F.nullif(name, F.lit("")), F.nullif(url, F.lit("")), F.lit("")))
    return F.lower(F.coalesce(kind, F.lit(""))).isin(WORKBOOK_TYPES) | file.rlike("[.](xls|xlsx|xlsm)$")


def storage_path(year: Column, month: Column, period_type: Column, attachment_id: Column, name: Column) -> Column:
    """Partition-style path of a downloaded file."""
    part = F.when(month.isNotNull(), F.concat(F.lit("report_month="), F.lpad(month.cast("string"), 2, "0"))).otherwise(F.concat(F.lit("period_type="), period_type))
    return F.concat_ws("/", F.concat(F.lit("report_year="), year.cast("string")), part, F.concat_ws("_", attachment_id, safe_filename(name)))
