"""Date and time columns.  Text and epochs meet in the session time zone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Text layouts of the warehouse.
DATE_FORMAT = "yyyy-MM-dd"
TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"
TIME_SHAPE = "____-__-__ __:__:__"
LOOSE_TIME = r"^\d{4}-\d{1,2}-\d{1,2}[ T]\d{1,2}:\d{1,2}:\d{1,2}(\.\d{1,9})?$"

YEAR_MS = 365 * 24 * 60 * 60 * 1000


def create_date(text: Column) -> Column:
    """The part of a date-time text before its blank."""
    return F.split(text, " ").getItem(0)


def create_hour(text: Column) -> Column:
    """The part of a date-time text between its blank and the first colon."""
    return F.split(F.get(F.split(text, " "), F.lit(1)), ":").getItem(0)


def to_epoch_ms(text: Column) -> Column:
    """Epoch milliseconds of a date-time text; null where it does not parse.

    A cast behind a check of the layout: much cheaper than parsing by pattern.  Texts of another
    length are checked once more, for one-digit parts and fractions of a second.
    """
    usual = text.like(TIME_SHAPE) | text.rlike(LOOSE_TIME)
    return F.when(usual, F.unix_millis(text.try_cast("timestamp")))


def to_epoch_ms_or(text: Column, fallback_ms: Column) -> Column:
    """As ``to_epoch_ms``, with the record's own time where the text does not parse."""
    return F.coalesce(to_epoch_ms(text), fallback_ms)


def date_text(ts_ms: Column) -> Column:
    return F.date_format(F.timestamp_millis(ts_ms), DATE_FORMAT)


def time_text(ts: Column) -> Column:
    return F.date_format(ts, TIME_FORMAT)


def to_epoch_ms_at(text: Column, offset: str = "+08:00") -> Column:
    """Epoch milliseconds of a date-time text read at a fixed offset, in any session zone."""
    zoned = F.try_to_timestamp(
        F.concat(text, F.lit(offset)), F.lit(f"{TIME_FORMAT}XXX")
    )
    return F.unix_millis(zoned)


def age_years(birthday: Column, as_of_ms: Column) -> Column:
    """Whole 365-day years between a ``yyyy-MM-dd`` text and an instant."""
    birth_ms = F.unix_millis(F.try_to_timestamp(birthday, F.lit(DATE_FORMAT)))
    return F.call_function("div", as_of_ms - birth_ms, F.lit(YEAR_MS)).cast("int")
