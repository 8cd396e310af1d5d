"""Partition columns and the lookback window."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F


def partition_values(publication_date: Column) -> dict[str, Column]:
    return {
        "year": F.year(publication_date),
        "month": F.month(publication_date),
        "day": F.dayofmonth(publication_date),
    }


def lookback_start(as_of: dt.date | None, days: int) -> Column:
    """First date inside the window; the wall clock is used only when no date is given."""
    anchor = F.current_date() if as_of is None else F.lit(as_of)
    return F.date_sub(anchor, days)


def within_lookback(publication_date: Column, as_of: dt.date | None, days: int) -> Column:
    """Inclusive at the start and open at the end; null dates fall out."""
    return publication_date >= lookback_start(as_of, days)


def first_day(spark: SparkSession, as_of: dt.date | None, days: int) -> dt.date:
    """The window's first date as a value, by the session's clock if no date is given."""
    return spark.range(1).select(lookback_start(as_of, days)).first()[0]
