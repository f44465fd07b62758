"""Business-day calendar and the days still to process."""

from __future__ import annotations

from datetime import date, timedelta
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratastar.functions.calendar import day_flag, easter_sunday
from stratastar.operators.asof import next_at_or_after

# Public holidays as (month, day) and as days after Easter Sunday.
FIXED_HOLIDAYS = ((1, 1), (5, 1), (5, 8), (7, 14), (8, 15), (11, 1), (11, 11), (12, 25))
EASTER_HOLIDAYS = (1, 39, 50)
#: No more days than this in a row are weekends or public holidays.
WITHOUT_OPEN = 10


def candidate_days(spark: SparkSession, start: date | None = None, end: date | None = None) -> DataFrame:
    """Days from start to end; only start: that day; neither: yesterday."""
    if start is None and end is None:
        start = date.today() - timedelta(days=1)
    if start is None:
        raise ValueError("an end needs a start")
    end = end or start
    if end < start:
        raise ValueError(f"end {end} lies before start {start}")
    return days_between(spark.range(1).select(F.lit(start).alias("first_day"), F.lit(end).alias("last_day")))


def days_between(bounds: DataFrame) -> DataFrame:
    """Every day of the (first_day, last_day) rows, once."""
    return bounds.select(F.explode(F.sequence("first_day", "last_day")).alias("day")).distinct()


def observed_span(df: DataFrame, column: str) -> DataFrame:
    """First and last day seen in a column, as bounds for `days_between`."""
    day = F.col(column).cast("date")
    return df.agg(F.min(day).alias("first_day"), F.max(day).alias("last_day")).where("first_day is not null")


def public_holidays(years: DataFrame) -> DataFrame:
    """Holidays of every distinct `year`: year, day."""
    staged = reduce(
        lambda df, stage: df.withColumns(stage), easter_sunday("year"), years.select(F.col("year").cast("int")).distinct()
    )
    fixed = [F.make_date(F.col("year"), F.lit(m), F.lit(d)) for m, d in FIXED_HOLIDAYS]
    moving = [F.date_add("easter", n) for n in EASTER_HOLIDAYS]
    return staged.select("year", F.explode(F.array(*fixed, *moving)).alias("day")).distinct()


def business_days(days: DataFrame, exclude_holidays: bool = True) -> DataFrame:
    """The rows of `day` from Monday to Friday that are no public holiday."""
    weekdays = days.where(day_flag("day"))
    if not exclude_holidays:
        return weekdays
    holidays = public_holidays(days.select(F.year("day").alias("year")))
    return weekdays.join(holidays.select("day"), "day", "left_anti")


def next_business_day(days: DataFrame, exclude_holidays: bool = True, closures: DataFrame | None = None) -> DataFrame:
    """For every distinct `day`, the first business day on or after it that is not in `closures` (column `day`).

    The search has no bound: see `next_at_or_after`. Open days are laid out from the first wanted
    day to WITHOUT_OPEN days behind the last wanted or closed one, and those last days hold an open
    one. Everything here works on distinct days, so its size follows the calendar and not the rows.
    """
    wanted = days.select("day").where("day is not null").distinct()
    closed = closures.select("day").where("day is not null").distinct() if closures is not None else wanted.limit(0)
    ends = wanted.select("day", F.col("day").alias("asked")).unionByName(closed.withColumn("asked", F.lit(None).cast("date")))
    bounds = ends.agg(F.min("asked").alias("first_day"), F.date_add(F.max("day"), WITHOUT_OPEN).alias("last_day"))
    open_days = business_days(days_between(bounds.where("first_day is not null")), exclude_holidays).join(closed, "day", "left_anti")
    return next_at_or_after(wanted, open_days, "day", "business_day", lambda day: F.trunc(day, "month"))


def days_to_process(days: DataFrame, log: DataFrame | None, *, force: bool = False, exclude_holidays: bool = True) -> DataFrame:
    """Business days that the run log (column `date_cible`) has not seen; `force` takes all."""
    wanted = business_days(days, exclude_holidays)
    if force or log is None:
        return wanted
    return wanted.join(log.select(F.col("date_cible").alias("day")).distinct(), "day", "left_anti")
