"""Month arithmetic and display of times."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from orderloom.schema import BASE_YEAR


def month_index(year: Column, month: Column, base_year: int = BASE_YEAR) -> Column:
    """Months since December of the year before base_year."""
    return ((year - base_year) * 12 + month).cast("long")


def index_year(index: Column, base_year: int = BASE_YEAR) -> Column:
    return (F.floor((index - 1) / 12) + base_year).cast("int")


def index_month(index: Column) -> Column:
    return (F.pmod(index - 1, F.lit(12)) + 1).cast("int")


def month_label(index: Column, base_year: int = BASE_YEAR) -> Column:
    """Label such as 'Aug 2026', right for any index, also zero and below."""
    first_day = F.make_date(index_year(index, base_year), index_month(index), F.lit(1))
    return F.date_format(first_day, "MMM yyyy")


def ist_label(time: Column, zoned: bool = False) -> Column:
    """A time as dd-MM-yyyy HH:mm:ss in India (UTC+5:30).

    Without a zone it is taken as UTC; an instant (zoned) shows the same whatever the
    session's zone is.
    """
    utc = F.to_utc_timestamp(time, F.current_timezone()) if zoned else time
    return F.date_format(utc + F.expr("INTERVAL '5:30' HOUR TO MINUTE"), "dd-MM-yyyy HH:mm:ss")
