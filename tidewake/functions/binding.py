"""A value that is computed once and used several times within one expression."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def bind(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once, however often the body uses it.

    Keeps chained functions linear in size; written out, each step would repeat
    the text of the steps before it.
    """
    return F.get(F.transform(F.array(value), body), 0)
