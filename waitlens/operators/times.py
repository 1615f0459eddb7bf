"""Time filters. Where the rows have a ``sample_date`` partition column, it is filtered too, so that only the days
needed are read."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame

from waitlens.functions import timestamp_text

DAY = "sample_date"


def _days(df: DataFrame, column: str, start: datetime | None, stop: datetime | None) -> list[str]:
    if column != "sample_time" or DAY not in df.columns:
        return []
    bounds = ((">=", start), ("<=", stop))
    return [f"{DAY} {sign} date'{moment.date().isoformat()}'" for sign, moment in bounds if moment is not None]


def in_range(
    df: DataFrame, start: datetime | None = None, stop: datetime | None = None, column: str = "sample_time"
) -> DataFrame:
    """Rows from ``start`` to ``stop``; both ends count."""
    bounds = ((">=", start), ("<=", stop))
    conditions = [f"{column} {sign} {timestamp_text(moment)}" for sign, moment in bounds if moment is not None]
    conditions += _days(df, column, start, stop)
    return df.where(" and ".join(conditions)) if conditions else df


def recent(df: DataFrame, as_of: datetime, span: timedelta, column: str = "sample_time") -> DataFrame:
    """Rows of the last ``span`` before ``as_of``; the early end is left out."""
    start = as_of - span
    conditions = [f"{column} > {timestamp_text(start)}", f"{column} <= {timestamp_text(as_of)}"]
    return df.where(" and ".join(conditions + _days(df, column, start, as_of)))
