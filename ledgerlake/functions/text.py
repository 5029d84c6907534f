"""Text helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def col(name: str) -> Column:
    """Column by a name that may contain spaces, hyphens or dots."""
    return F.col(f"`{name}`")


def title_case(c: Column) -> Column:
    """Trim spaces, then upper-case the first letter of each space-separated word.

    ``initcap`` lower-cases everything else and splits on spaces only, so
    ``st. paul-minneapolis`` becomes ``St. Paul-minneapolis``.
    """
    return F.initcap(F.trim(c))
