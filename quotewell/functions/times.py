"""Exchange clocks, trading sessions and calendar bounds.

Feed times are wall-clock values, so they live in TIMESTAMP_NTZ columns and
never depend on the session time zone. A zone only enters when an instant is
needed (``epoch_ms``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Session bounds as HHmmssSSS numbers, both ends inclusive.
FULL_SESSIONS = ((90000000, 113000000), (130000000, 150000000))
CONTINUOUS_SESSIONS = ((93000000, 113000000), (130000000, 145700000))


def _wall(date8: Column, clock9: Column) -> Column:
    """yyyyMMdd text and HHmmssSSS text -> timestamp_ntz, null when not a time."""

    def part(c: Column, start: int, length: int) -> Column:
        return F.substring(c, start, length)

    text = F.concat(
        part(date8, 1, 4), F.lit("-"), part(date8, 5, 2), F.lit("-"), part(date8, 7, 2), F.lit(" "),
        part(clock9, 1, 2), F.lit(":"), part(clock9, 3, 2), F.lit(":"), part(clock9, 5, 2), F.lit("."),
        part(clock9, 7, 3),
    )
    return text.try_cast("timestamp_ntz")


def parse_ts17(c: Column) -> Column:
    """'yyyyMMddHHmmssSSS'."""
    return _wall(F.substring(c, 1, 8), F.substring(c, 9, 9))


def pad_clock(c: Column) -> Column:
    """HHmmssSSS kept as a number loses its leading zero before 10:00."""
    return F.lpad(c.cast("string"), 9, "0")


def parse_day_clock(date8: Column, clock: Column) -> Column:
    """Day text plus HHmmssSSS number (8 or 9 digits)."""
    return _wall(date8, pad_clock(clock))


def parse_ts14(c: Column) -> Column:
    """'yyyyMMddHHmmss'."""
    return _wall(F.substring(c, 1, 8), F.concat(F.substring(c, 9, 6), F.lit("000")))


def _clock16(c: Column, cs_as_ms: bool) -> Column:
    tail = F.substring(c, 15, 2)
    millis = F.lpad(tail, 3, "0") if cs_as_ms else F.rpad(tail, 3, "0")
    return F.concat(F.substring(c, 9, 6), millis)


def parse_ts16(c: Column, cs_as_ms: bool = True) -> Column:
    """'yyyyMMddHHmmss' plus two digits. The two digits count milliseconds by
    default; ``cs_as_ms=False`` reads them as hundredths of a second."""
    return _wall(F.substring(c, 1, 8), _clock16(c, cs_as_ms))


def text_clock16(c: Column, cs_as_ms: bool = True) -> Column:
    return _clock16(c, cs_as_ms).try_cast("bigint")


def text_clock(c: Column) -> Column:
    """HHmmssSSS number straight from 'yyyyMMddHHmmss[SSS]' text: cheap to
    filter on, since nothing has to be parsed as a time."""
    return F.rpad(F.substring(c, 9, 9), 9, "0").try_cast("bigint")


def text_day(c: Column) -> Column:
    """Date from text that starts with yyyyMMdd."""
    return F.concat_ws(
        "-", F.substring(c, 1, 4), F.substring(c, 5, 2), F.substring(c, 7, 2)
    ).try_cast("date")


def clock_number(ts: Column) -> Column:
    """HHmmssSSS as a number: the form session bounds are written in."""
    return F.hour(ts) * F.lit(10000000).cast("bigint") + F.minute(ts) * 100000 + _second_ms(ts)


def _second_ms(ts: Column) -> Column:
    return F.floor(F.date_part(F.lit("SECOND"), ts) * 1000).cast("bigint")


def in_sessions(clock: Column, sessions=FULL_SESSIONS) -> Column:
    hit = F.lit(False)
    for lo, hi in sessions:
        hit = hit | clock.between(lo, hi)
    return hit


def in_window(clock: Column, start: str, end: str) -> Column:
    """Caller's own clock window, bounds as HHmmssSSS text, inclusive."""
    return clock.between(int(start), int(end))


def epoch_ms(ts: Column, zone: str = "UTC") -> Column:
    """Milliseconds since 1970 of a wall-clock time in ``zone`` (floored)."""
    if zone != "UTC":
        ts = F.convert_timezone(F.lit(zone), F.lit("UTC"), ts)
    # calendar parts only: these read the wall clock as it is, whatever the
    # session time zone
    day = F.unix_date(F.to_date(ts)).cast("bigint") * 86400000
    return day + F.hour(ts) * 3600000 + F.minute(ts) * 60000 + _second_ms(ts)


def from_epoch_ms(ms: Column, zone: str = "UTC") -> Column:
    wall = F.expr("timestamp_ntz'1970-01-01 00:00:00'") + F.make_dt_interval(
        secs=(ms / F.lit(1000)).cast("decimal(18,6)")
    )
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), wall) if zone != "UTC" else wall


def weekday(day: Column) -> Column:
    """True on Monday to Friday."""
    return ~F.dayofweek(day).isin(1, 7)


# --- calendar bounds -------------------------------------------------------

def as_date(day) -> Column:
    """A run date: date object, 'yyyy-MM-dd', 'yyyyMMdd' or a date column."""
    if isinstance(day, Column):
        return day
    text = str(day)
    if len(text) == 8 and text.isdigit():
        text = f"{text[:4]}-{text[4:6]}-{text[6:]}"
    return F.lit(text).cast("date")


def month_begin(day) -> Column:
    return F.trunc(as_date(day), "MM")


def year_begin(day) -> Column:
    return F.trunc(as_date(day), "YEAR")


def previous_month_end(day) -> Column:
    return F.date_sub(month_begin(day), 1)


def date8(day: Column) -> Column:
    return F.replace(day.cast("string"), F.lit("-"), F.lit(""))


def asof_valid(df: DataFrame, day, begin: str = "bgn_dt", end: str = "end_dt") -> DataFrame:
    """Rows whose half-open validity interval [begin, end) holds ``day``."""
    d = as_date(day)
    return df.where((F.col(begin) <= d) & (F.col(end) > d))


def asof_business_day(calendar: DataFrame, day: str = "data_dt",
                      flag: str = "tran_dt_flag", out: str = "recall_dt") -> DataFrame:
    """Latest open day on or before each calendar day. One row per day, so the
    un-partitioned window is over a table as long as the calendar."""
    upto = Window.orderBy(day).rowsBetween(Window.unboundedPreceding, 0)
    open_day = F.when(F.col(flag) == "Y", F.col(day))
    return calendar.withColumn(out, F.max(open_day).over(upto))
