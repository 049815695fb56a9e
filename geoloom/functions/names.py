"""Columns by their exact names, whatever characters these have."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def quoted(name: str) -> str:
    """The name as one identifier of an expression."""
    return "`" + name.replace("`", "``") + "`"


def exact(name: str) -> Column:
    return F.col(quoted(name))
