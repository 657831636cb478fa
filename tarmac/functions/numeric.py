"""Exact ratios with half-away-from-zero rounding, as SQL expression text.

Ratios are taken between integer (or two-digit decimal) totals as decimals, so a
result never depends on the order in which partitions were summed and ties round
the same way at any row count. Doubles appear only at the output edge.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T


def ratio(num: str, den: str) -> str:
    """`num / den` with 18 fractional digits; NULL for a zero denominator."""
    return f"(CAST({num} AS DECIMAL(22,2)) / nullif(CAST({den} AS DECIMAL(18,0)), 0))"


def rounded(x: str, digits: int = 2) -> str:
    return f"CAST(round({x}, {digits}) AS DECIMAL(20,{digits}))"


def pct(part: str, whole: str, digits: int = 2) -> str:
    """Percentage of `whole`, rounded."""
    return rounded(ratio(f"100 * {part}", whole), digits)


def mean(total: str, n: str, digits: int = 2) -> str:
    """Mean from a stored sum and count, rounded."""
    return rounded(ratio(total, n), digits)


def round_double(x: str, digits: int) -> str:
    """Round a double the way a decimal would be rounded, staying a double."""
    return f"CAST(round(CAST({x} AS DECIMAL(18,6)), {digits}) AS DOUBLE)"


def decimals_to_double(df: DataFrame) -> DataFrame:
    """Turn every decimal column into a double; the output edge of each report."""
    return df.selectExpr(
        *[
            f"CAST({f.name} AS DOUBLE) AS {f.name}" if isinstance(f.dataType, T.DecimalType) else f.name
            for f in df.schema.fields
        ]
    )
