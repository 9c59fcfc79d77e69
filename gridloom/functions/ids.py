"""Short stable identifiers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def md5_16(*parts: Column | str) -> Column:
    """First 16 hex digits of the MD5 of the parts joined by a bar; null if a part is null."""
    columns = [F.col(p) if isinstance(p, str) else p for p in parts]
    joined = columns[0].cast("string")
    for c in columns[1:]:
        joined = F.concat(joined, F.lit("|"), c.cast("string"))
    return F.substring(F.md5(joined), 1, 16)
