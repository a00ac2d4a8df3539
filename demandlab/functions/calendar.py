"""Time bucketing and calendar expressions.

They work on naive timestamps without a session-time-zone round trip.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from demandlab.schemas import MANHATTAN_ZONES, WINDOW, ZONE

def _naive(ts: Column | str) -> Column:
    return (F.col(ts) if isinstance(ts, str) else ts).cast("timestamp_ntz")


def floor_minutes(ts: Column | str, minutes: int = 15) -> Column:
    """Start of the ``minutes``-wide bucket holding ``ts``.

    Compiles to plain integer arithmetic. As with every Spark time window, rows
    without a time drop out, and one projection can hold only one floor.
    """
    return F.window(ts, f"{minutes} minutes").start


def floor_hour(ts: Column | str) -> Column:
    return floor_minutes(ts, 60)


def seconds_between(start: Column | str, end: Column | str) -> Column:
    """Seconds from start to end with microsecond precision."""
    span = _naive(end) - _naive(start)
    return span.cast("interval second").cast("decimal(18,6)").cast("double")


def minutes_between(start: Column | str, end: Column | str) -> Column:
    return seconds_between(start, end) / 60


def lasts_between(start: Column | str, end: Column | str, low_minutes: float, high_minutes: float) -> Column:
    """Whether start to end takes strictly between both limits; compares intervals without converting them."""
    span = _naive(end) - _naive(start)
    return (span > _minutes(low_minutes)) & (span < _minutes(high_minutes))


def _minutes(n: float) -> Column:
    return F.make_dt_interval(secs=F.lit(n * 60))


def epoch_seconds(ts: Column | str) -> Column:
    """Whole seconds since 1970 of a naive time."""
    return (_naive(ts) - F.lit("1970-01-01").cast("timestamp_ntz")).cast("interval second").cast("bigint")


def month_start(ts: Column | str) -> Column:
    return F.trunc(ts, "month")


def day_of_week(ts: Column | str) -> Column:
    """Monday is 0."""
    return F.weekday(ts)


def iso_week(ts: Column | str) -> Column:
    return F.weekofyear(ts)


def is_weekend(dow: Column | str) -> Column:
    return F.col(dow).isin(5, 6).cast("int") if isinstance(dow, str) else dow.isin(5, 6).cast("int")


def is_rush_hour(hour: Column) -> Column:
    return hour.isin(7, 8, 9, 17, 18, 19).cast("int")


def time_of_day(hour: Column) -> Column:
    """0 night (to 6), 1 morning (to 12), 2 afternoon (to 18), 3 evening; right-closed."""
    return (F.when(hour.isNull(), None).when(hour <= 6, 0).when(hour <= 12, 1).when(hour <= 18, 2).otherwise(3)
            .cast("int"))


def season(month: Column) -> Column:
    """0 winter, 1 spring, 2 summer, 3 autumn."""
    return F.floor((month % 12) / 3).cast("int")


def in_zones(zone: Column, zones: Iterable[int] = MANHATTAN_ZONES) -> Column:
    return zone.isin(*zones).cast("int")


def minute_text(ts: Column | str) -> Column:
    return F.date_format(ts, "yyyy-MM-dd HH:mm")


def clock_text(ts: Column | str) -> Column:
    return F.date_format(ts, "HH:mm:ss")


def with_window_parts(df: DataFrame, window: str = WINDOW) -> DataFrame:
    """Adds hour, day_of_week and month of the window start."""
    return df.withColumns({"hour": F.hour(window), "day_of_week": day_of_week(window), "month": F.month(window)})


def calendar_columns(window: str = WINDOW, zone: str = ZONE) -> dict[str, Column]:
    """The calendar features that need ``hour``, ``day_of_week`` and ``month`` only."""
    hour, dow, month = F.col("hour"), F.col("day_of_week"), F.col("month")
    return {
        "is_weekend": is_weekend(dow),
        "is_rush_hour": is_rush_hour(hour),
        "day_of_month": F.dayofmonth(window),
        "week_of_year": iso_week(window),
        "time_of_day": time_of_day(hour),
        "season": season(month),
        "is_manhattan": in_zones(F.col(zone)),
    }


def request_features(df: DataFrame, ts: str, zone: str = ZONE) -> DataFrame:
    """All history-free features of a (zone, time) pair."""
    return with_window_parts(df, ts).withColumns(calendar_columns(ts, zone))
