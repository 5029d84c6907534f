"""Date parsing that never raises under ANSI mode."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DateType, StringType, TimestampNTZType, TimestampType

from ledgerlake.config import DATE_FORMAT


def parse_date(c: Column, dtype: DataType, formats: list[str] | None = None) -> Column:
    """Turn a text, timestamp or date column into DATE.

    Text is parsed with ``try_to_date`` (bad or impossible dates such as
    ``2/29/2019`` or ``13/45/2019`` give NULL instead of an error). With more
    than one format the first that parses wins.
    """
    if isinstance(dtype, DateType):
        return c
    if isinstance(dtype, (TimestampType, TimestampNTZType)):
        return F.to_date(c)
    if not isinstance(dtype, StringType):
        c = c.cast("string")
    fmts = formats or [DATE_FORMAT]
    parsed = [F.try_to_date(c, f) for f in fmts]
    return parsed[0] if len(parsed) == 1 else F.coalesce(*parsed)
