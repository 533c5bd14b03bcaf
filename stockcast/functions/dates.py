"""Calendar expressions over dates and timestamps."""

from __future__ import annotations

from pyspark.sql import Column, functions as F, types as T


def parse_date(col: Column, strict: bool = True) -> Column:
    """Text or timestamp to date; bad text raises, or becomes NULL when not strict."""
    return col.cast("date") if strict else col.try_cast("date")


def calendar_parts(col: Column) -> dict[str, Column]:
    """year, month, ISO week, weekday (Monday 0) and month-boundary flags."""
    day = col.cast("date")
    return {
        "year": F.year(day),
        "month": F.month(day),
        "weekofyear": F.weekofyear(day),
        "dayofweek": F.weekday(day),
        "is_month_start": (F.dayofmonth(day) == 1).cast("int"),
        "is_month_end": (day == F.last_day(day)).cast("int"),
    }


def epoch_seconds(col: Column, dtype: T.DataType) -> Column:
    """Seconds since 1970 of the wall-clock value; no session time zone for dates and NTZ."""
    if isinstance(dtype, T.TimestampType):
        return F.unix_seconds(col)
    days = F.unix_date(col.cast("date")).cast("bigint") * 86400
    if isinstance(dtype, T.DateType):
        return days
    return days + F.hour(col) * 3600 + F.minute(col) * 60 + F.second(col)


def order_position(col: Column, dtype: T.DataType) -> Column:
    """A number that sorts like the column: days, microseconds, or the number itself."""
    if isinstance(dtype, T.DateType):
        return F.unix_date(col).cast("bigint")
    if isinstance(dtype, T.TimestampType):
        return F.unix_micros(col)
    if isinstance(dtype, T.TimestampNTZType):
        minutes = F.unix_date(col.cast("date")).cast("bigint") * 1440 + F.hour(col) * 60 + F.minute(col)
        return minutes * 60_000_000 + (F.extract(F.lit("SECOND"), col) * 1_000_000).cast("bigint")
    if isinstance(dtype, T.IntegralType):
        return col.cast("bigint")
    return col.cast("double")
