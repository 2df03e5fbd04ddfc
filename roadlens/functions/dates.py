"""Time-text expressions.

Pass times are text ``yyyy-MM-dd HH:mm:ss`` whose hour may be 24 or more
(the hour keeps counting past midnight with the same date). Labels are
therefore built by splitting the text, and ordering uses a lenient seconds
value that rolls such hours into the following days.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F, types as T

from roadlens.functions._col import as_col

# Fixed formats of the stored text values.
DATE_PATTERN = "yyyy-MM-dd"
TIME_PATTERN = "yyyy-MM-dd HH:mm:ss"
DATE_KEY_PATTERN = "yyyyMMdd"
TIME_MINUTE_PATTERN = "yyyyMMddHHmm"


def _clock_part(s: Column, i: int) -> Column:
    return F.split_part(F.split_part(s, F.lit(" "), F.lit(2)), F.lit(":"), F.lit(i))


def date_of(time_text: str | Column) -> Column:
    """Date text before the first space."""
    return F.split_part(as_col(time_text), F.lit(" "), F.lit(1))


def date_hour(time_text: str | Column) -> Column:
    """``yyyy-MM-dd_HH`` by splitting the text (hour 25 stays ``_25``)."""
    s = as_col(time_text)
    return F.concat(date_of(s), F.lit("_"), _clock_part(s, 1))


def _fields(s: Column) -> Column:
    # [date, hour, minute, second] of "yyyy-MM-dd HH:mm:ss" in one split;
    # keeps the generated code small enough for the JIT when fused in a stage
    return F.split(s, "[ :]")


def date_and_hour(time_text: str | Column) -> tuple[Column, Column]:
    """The date and the hour, as written, of a time that parses (:func:`lenient_seconds`)."""
    p = _fields(as_col(time_text))
    return F.get(p, 0), F.get(p, 1)


def range_cell(time_text: str | Column) -> tuple[Column, Column, Column]:
    """(date, hour, minute floored to five) of a time text, which identify its five-minute range."""
    p = _fields(as_col(time_text))
    minute = F.get(p, 2).try_cast(T.IntegerType())
    return F.get(p, 0), F.get(p, 1), minute - minute % 5


def cell_label(day: Column, hour: Column, start_min: Column) -> Column:
    """The label of a five-minute range (see :func:`range_label`)."""
    next_hour = F.try_add(hour.try_cast(T.IntegerType()), F.lit(1))
    end_min = F.try_add(start_min, F.lit(5))
    return (F.when(start_min == 55, F.when(
                next_hour.isNotNull(),
                F.format_string("%s %s:%02d~%s %02d:00", day, hour, start_min, day, next_hour)))
            .when(end_min.isNotNull() & day.isNotNull() & hour.isNotNull(),
                  F.format_string("%s %s:%02d~%s %s:%02d", day, hour, start_min, day, hour, end_min)))


def range_label(time_text: str | Column) -> Column:
    """Five-minute range label ``d HH:mm~d HH:mm``.

    The start minute is floored to a multiple of five; the end is five
    minutes later, and minutes 55-59 end at the next hour's ``:00`` without
    a day rollover (``23:57`` gives ``~d 24:00``). The start keeps the hour
    text as written. Null when the minute (or, for minutes 55-59, the hour)
    is not a number.
    """
    return cell_label(*range_cell(time_text))


def lenient_seconds(time_text: str | Column) -> Column:
    """Seconds since 1970-01-01 of the wall-clock text, parsed leniently.

    Fields may overflow (hour 25 is 01:00 of the next day). Null when the
    text does not have the ``date HH:mm:ss`` shape. Time-zone free.
    """
    p = _fields(as_col(time_text))
    day = F.get(p, 0).try_cast(T.DateType())
    h, m, sec = (F.get(p, i).try_cast(T.LongType()) for i in (1, 2, 3))
    # try_ arithmetic: an absurd field gives null instead of an overflow error
    clock = F.try_add(F.try_add(F.try_multiply(h, F.lit(3600)), F.try_multiply(m, F.lit(60))), sec)
    return F.try_add(F.unix_date(day).cast(T.LongType()) * 86400, clock)


def seconds_text(seconds: str | Column) -> Column:
    """``yyyy-MM-dd HH:mm:ss`` of seconds since 1970-01-01 (inverse of
    :func:`lenient_seconds` for well-formed text). Time-zone free."""
    sec = as_col(seconds).cast(T.LongType())
    day = F.date_from_unix_date(F.floor(sec / 86400).cast(T.IntegerType()))
    tod = F.pmod(sec, F.lit(86400))
    return F.format_string("%s %02d:%02d:%02d", day.cast("string"),
                           F.floor(tod / 3600), F.floor(F.pmod(tod, F.lit(3600)) / 60), F.pmod(tod, F.lit(60)))


def after(a: str | Column, b: str | Column) -> Column:
    """True when time ``a`` is strictly after ``b``; false if either does not parse."""
    return F.coalesce(lenient_seconds(a) > lenient_seconds(b), F.lit(False))


def before(a: str | Column, b: str | Column) -> Column:
    """True when time ``a`` is strictly before ``b``; false if either does not parse."""
    return F.coalesce(lenient_seconds(a) < lenient_seconds(b), F.lit(False))


def minus_seconds(a: str | Column, b: str | Column) -> Column:
    """``a - b`` in whole seconds; 0 when either does not parse."""
    return F.coalesce(lenient_seconds(a) - lenient_seconds(b), F.lit(0).cast(T.LongType()))


def today() -> Column:
    return F.date_format(F.current_date(), DATE_PATTERN)


def yesterday() -> Column:
    return F.date_format(F.date_sub(F.current_date(), 1), DATE_PATTERN)


def format_date(ts: str | Column) -> Column:
    return F.date_format(as_col(ts), DATE_PATTERN)


def format_time(ts: str | Column) -> Column:
    return F.date_format(as_col(ts), TIME_PATTERN)


def format_date_key(ts: str | Column) -> Column:
    return F.date_format(as_col(ts), DATE_KEY_PATTERN)


def format_time_minute(ts: str | Column) -> Column:
    return F.date_format(as_col(ts), TIME_MINUTE_PATTERN)


def parse_time(text: str | Column) -> Column:
    """Strict parse of ``yyyy-MM-dd HH:mm:ss``; null on failure."""
    return F.try_to_timestamp(as_col(text), F.lit(TIME_PATTERN))


def parse_date_key(text: str | Column) -> Column:
    """Strict parse of ``yyyyMMdd``; null on failure."""
    return F.try_to_timestamp(as_col(text), F.lit(DATE_KEY_PATTERN))
