"""Date keys (as SQL expression text) and date-range filters."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame

DEFAULT_PARTITION = "default"
MONTH = "trunc(flight_date, 'MM') AS month"


def month_label(day: str) -> str:
    """`YYYY-MM`, without a per-row date formatter."""
    return f"concat(lpad(year({day}), 4, '0'), '-', lpad(month({day}), 2, '0'))"


def date_range(df: DataFrame, start: str | date, end: str | date) -> DataFrame:
    """Rows dated `start`..`end`, both included.

    On a table partitioned by `flight_month` the same range is also put on the
    partition column, which prunes folders; undeclared months live in the default one.
    """
    first, last = (date.fromisoformat(str(day)).isoformat() for day in (start, end))
    cond = f"flight_date BETWEEN DATE'{first}' AND DATE'{last}'"
    if "flight_month" in df.columns:
        months = f"flight_month BETWEEN '{first[:7]}' AND '{last[:7]}'"
        cond += f" AND ({months} OR flight_month = '{DEFAULT_PARTITION}')"
    return df.filter(cond)
