"""Time-axis helpers.

The transaction time axis is an integer offset in seconds. Timestamps from the
driver tables are mapped to epoch seconds without depending on the session
zone for TIMESTAMP_NTZ columns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SECONDS_PER_DAY = 86400


def epoch_seconds(df: DataFrame, col: str) -> Column:
    """Whole epoch seconds (floor) of a timestamp column.

    TIMESTAMP_NTZ: difference to the NTZ epoch, zone-free.
    TIMESTAMP (LTZ): ``unix_seconds`` is zone-free as well.
    """
    dtype = df.schema[col].dataType
    c = F.col(col)
    if isinstance(dtype, T.TimestampNTZType):
        return F.expr(
            f"floor(timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', `{col}`) / 1000000)"
        ).cast("long")
    if isinstance(dtype, T.TimestampType):
        return F.floor(F.unix_micros(c) / F.lit(1_000_000)).cast("long")
    if isinstance(dtype, T.DateType):
        return (F.unix_date(c).cast("long") * F.lit(SECONDS_PER_DAY))
    return c.cast("long")


def seconds_of_day(dt: Column) -> Column:
    """``dt % 86400`` with floor semantics."""
    return F.pmod(dt, F.lit(SECONDS_PER_DAY)).cast("long")


def fractional_amount(amt: Column) -> Column:
    """``amt % 1`` with floor semantics (-1.5 -> 0.5)."""
    return F.pmod(amt.cast("double"), F.lit(1.0))


def day_index(dt: Column, min_dt: Column) -> Column:
    """P3 body: whole days since the global minimum (truncation; dt >= min)."""
    return F.floor((dt - min_dt) / F.lit(SECONDS_PER_DAY)).cast("int")


def add_time_features(df: DataFrame, time_col: str = "TransactionDT",
                      amount_col: str = "TransactionAmt",
                      seconds_col: str = "TimeDay", cents_col: str = "Cents",
                      day_col: str = "TransactionDay") -> DataFrame:
    """P1-P3 in one projection.

    The global minimum is a scalar subquery (distributed partial ``min`` then a
    one-row final aggregate), so the table is scanned twice but never shuffled
    or joined.
    """
    min_dt = df.select(F.min(time_col)).scalar()
    return df.select(
        *[F.col(c) for c in df.columns],
        seconds_of_day(F.col(time_col)).alias(seconds_col),
        fractional_amount(F.col(amount_col)).alias(cents_col),
        day_index(F.col(time_col), min_dt).alias(day_col),
    )
