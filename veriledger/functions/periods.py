"""Reporting periods (`yyyymmdd` text) and the dates that follow from them."""

from datetime import date, datetime, timedelta, timezone

from pyspark.sql import Column
from pyspark.sql import functions as F

# Filler date of missing data dates; load times are written in UTC+7.
FILLER_DATE = date(9999, 9, 9)
LOAD_ZONE = timezone(timedelta(hours=7))


def period_date(period: Column) -> Column:
    """The date of a `yyyymmdd` period; NULL when the text is no date."""
    return F.try_to_date(period, "yyyyMMdd")


def next_period_daily(day: Column) -> Column:
    return F.date_add(day, 1)


def next_period_month_end(day: Column) -> Column:
    """Last day of the month after the month of ``day``."""
    return F.last_day(F.add_months(F.last_day(day), 1))


def advance(period: str, cadence: str) -> str:
    """Next period of a job: the next day, or the end of the next month."""
    day = datetime.strptime(period, "%Y%m%d").date()
    if cadence == "monthly":
        first_after_next = (day.replace(day=1) + timedelta(days=62)).replace(day=1)
        return (first_after_next - timedelta(days=1)).strftime("%Y%m%d")
    return (day + timedelta(days=1)).strftime("%Y%m%d")


def load_time(moment: datetime) -> str:
    """Load time in UTC+7 as text. The caller passes the moment, so a re-run can repeat it."""
    return moment.astimezone(LOAD_ZONE).strftime("%Y-%m-%d %H:%M:%S.%f")


def data_date(period: str, cadence: str) -> date:
    """Data date of a period: its day, or the end of its month for monthly data."""
    day = datetime.strptime(period, "%Y%m%d").date()
    if cadence == "monthly":
        return (day.replace(day=1) + timedelta(days=32)).replace(day=1) - timedelta(days=1)
    return day
