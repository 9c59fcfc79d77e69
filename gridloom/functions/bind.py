"""Bind a value once inside an expression."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value) with value computed once.

    A Column used twice is computed and planned twice; a lambda variable over a one-element array is
    not, which keeps long rule chains linear in size.
    """
    return F.element_at(F.transform(F.array(value), body), 1)
