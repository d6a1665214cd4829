"""Dates: lenient parsing, calendar parts, week labels and cut-offs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DATE_START = r"^\d{1,4}[-/.]\d{1,2}[-/.]\d{1,4}"
YEAR_LAST = r"^(\d{1,2})[-/.](\d{1,2})[-/.](\d{4})"
YEAR_FIRST = r"^(\d{4})[/.](\d{1,2})[/.]"

# Last day of a week -> the weekday after it, which starts the next one.
_WEEK_ENDS = ("MON", "TUE", "WED", "THU", "FRI", "SAT", "SUN")


def _col(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def _reading(text: Column, order: str) -> Column:
    """Timestamp of a text whose leading numbers stand in ``order`` unless the year comes first; null when invalid.

    The numbers are put in ISO order and cast, which rejects a bad date without raising.
    """
    iso = F.regexp_replace(F.regexp_replace(text, YEAR_LAST, order), YEAR_FIRST, "$1-$2-")
    return F.when(text.rlike(DATE_START), iso.try_cast("timestamp"))


def two_readings(col) -> tuple[Column, Column]:
    """Month-first and day-first date of a text, null where invalid. A text that starts with the year has one."""
    text = F.trim(_col(col))
    return tuple(_reading(text, order).cast("date") for order in ("$3-$1-$2", "$3-$2-$1"))


def parse_date(col, formats=None) -> Column:
    """Timestamp of a date text in mixed form (month first when both readings are valid), else null.

    With ``formats``, the first pattern that reads the whole text decides.
    """
    text = F.trim(_col(col))
    if formats:
        return F.coalesce(*[F.try_to_timestamp(text, F.lit(f)) for f in formats])
    return F.coalesce(_reading(text, "$3-$1-$2"), _reading(text, "$3-$2-$1"))


def has_time(col) -> Column:
    """Whether a raw date text carries a clock time."""
    return _col(col).contains(":")


def calendar_parts(df: DataFrame, date="date") -> DataFrame:
    """Day name, hour, weekday (Monday 0), weekend flag and ISO week of a date column."""
    day = F.col(date)
    return df.withColumns(
        {
            "day_name": F.date_format(day, "EEEE"),
            "hour": F.hour(day.cast("timestamp")),
            "weekday": F.weekday(day),
            "is_weekend": F.weekday(day).isin(5, 6).cast("int"),
            "iso_week": F.weekofyear(day),
        }
    )


def week_end(col, end="SUN") -> Column:
    """Date of the last day of the week a date falls in."""
    if end.upper() not in _WEEK_ENDS:
        raise ValueError(f"week end must be one of {', '.join(_WEEK_ENDS)}")
    return F.next_day(F.date_sub(F.to_date(_col(col)), 1), end)


def as_of(df: DataFrame, date, day) -> DataFrame:
    """Rows dated on or before ``day``."""
    return df.filter(F.to_date(F.col(date)) <= F.lit(day).cast("date"))
