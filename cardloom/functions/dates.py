"""Date parts, floored gaps and event distances. ``as_of`` is always a parameter, never the clock."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

# Base date of the day and month gaps, and the calendar days that event features measure to.
BASE_DATE = "2018-02-28"
EVENT_DAYS = {
    "Christmas_Day_2017": "2017-12-25",
    "Mothers_Day_2017": "2017-06-04",
    "fathers_day_2017": "2017-08-13",
    "Children_day_2017": "2017-10-12",
    "Valentine_Day_2017": "2017-06-12",
    "Black_Friday_2017": "2017-11-24",
    "Mothers_Day_2018": "2018-05-13",
}
EVENT_WINDOW = (0, 100)
DAYS_PER_MONTH = 30
SECONDS_PER_DAY = 86400

PARTS = {
    "year": F.year, "quarter": F.quarter, "month": F.month, "day": F.dayofmonth, "hour": F.hour,
    "weekofyear": F.weekofyear, "weekday": F.weekday,
}


def weekend(ts: Column) -> Column:
    return (F.weekday(ts) >= 5).cast("int")


def date_parts(df: DataFrame, ts: str, parts: Sequence[str]) -> DataFrame:
    """Add the named parts (see ``PARTS``; also ``weekend``), Monday being weekday 0 and weeks ISO."""
    column = F.col(ts)
    return df.withColumns({p: weekend(column) if p == "weekend" else PARTS[p](column) for p in parts})


def timestamp(value: str | Column) -> Column:
    return (F.lit(value) if isinstance(value, str) else value).cast("timestamp_ntz")


def seconds_between(later: Column, earlier: Column) -> Column:
    """Elapsed seconds with their fraction, free of any session time zone."""
    return (timestamp(later) - timestamp(earlier)).cast("interval second").cast("decimal(20,6)")


def floor_days(later: Column, earlier: Column) -> Column:
    """Whole days between two instants, rounded down also when negative."""
    return F.floor(seconds_between(later, earlier) / SECONDS_PER_DAY).cast("int")


def day_seconds(later: Column, earlier: Column) -> Column:
    """Seconds of the gap beyond its whole days, always within one day."""
    return F.pmod(F.floor(seconds_between(later, earlier)), F.lit(SECONDS_PER_DAY)).cast("int")


def epoch_seconds(ts: Column) -> Column:
    return seconds_between(ts, F.lit("1970-01-01 00:00:00")).cast("double")


def day_gap(ts: Column, base: str = BASE_DATE) -> Column:
    """Calendar days from the base date, negative before it."""
    return F.datediff(ts.cast("date"), F.lit(base).cast("date"))


def month_gap(ts: Column, base: str = BASE_DATE) -> Column:
    """Thirty-day steps from the base date, rounded down."""
    return F.floor(day_gap(ts, base) / DAYS_PER_MONTH).cast("int")


def month_age(ts: Column, as_of: str | Column, lag: Column | None = None) -> Column:
    """Thirty-day steps up to ``as_of``, shifted by the month lag when given."""
    age = F.floor(floor_days(timestamp(as_of), ts) / DAYS_PER_MONTH).cast("int")
    return age if lag is None else age + lag


def event_days(ts: Column, event: str, window: tuple[int, int] = EVENT_WINDOW) -> Column:
    """Days until a fixed event where they fall strictly inside the window, else 0."""
    days = floor_days(timestamp(event), ts)
    return F.when((days > window[0]) & (days < window[1]), days).otherwise(0)


def add_event_days(df: DataFrame, ts: str, events: Mapping[str, str] = EVENT_DAYS,
                   amount: str | None = None) -> DataFrame:
    """Event distances, and with ``amount`` also the amount weighted by each distance."""
    days = df.withColumns({name: event_days(F.col(ts), day) for name, day in events.items()})
    if amount is None:
        return days
    return days.withColumns({f"{amount}_{name}": F.col(amount) * F.col(name) for name in events})


def days_to_holiday(df: DataFrame, ts: str, holidays: DataFrame, name: str = "date2Holiday") -> DataFrame:
    """Days to the next holiday of the same calendar year, strictly later than the row.

    After the last holiday of the year the distance to that last one is given instead (zero or negative).
    ``holidays`` has one ``holiday`` date column: a calendar, so a year holds at most 366 of them.
    """
    calendar = (holidays.groupBy(F.year("holiday").alias("_year"))
                .agg(F.array_sort(F.collect_set("holiday")).alias("_days")))
    day = F.col(ts).cast("date")
    upcoming = F.get(F.filter("_days", lambda h: h > day), F.lit(0))
    target = F.coalesce(upcoming, F.try_element_at("_days", F.lit(-1)))
    return (df.withColumn("_year", F.year(ts)).join(calendar, "_year", "left")
            .withColumn(name, F.datediff(target, day)).drop("_year", "_days"))


def tenure(first_month: Column, as_of: str | Column) -> Column:
    """Whole days from the first active month up to ``as_of``."""
    return floor_days(timestamp(as_of), first_month)


def tenure_features(codes: Sequence[str], elapsed: str = "elapsed_time") -> dict[str, Column]:
    """Elapsed days times each code, and each code per elapsed day."""
    result = {}
    for i, code in enumerate(codes, start=1):
        result[f"days_feature{i}"] = F.col(elapsed) * F.col(code)
        result[f"days_feature{i}_ratio"] = F.try_divide(F.col(code).cast("double"), F.col(elapsed).cast("double"))
    return result
