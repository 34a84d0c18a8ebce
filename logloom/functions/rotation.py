"""Index names and calendar rotation stamps."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from logloom.functions.cols import nz

# fixed values: stamp format, zone and default period of rotated index names
ROTATION_ZONE = "Asia/Shanghai"
DEFAULT_PERIOD = "24hr"
PERIOD_TEXT = r"\A(?:(\d+)mo)?(?: ?(\d+)wk)?(?: ?(\d+)hr)?"


def index_name(token: Column, type_: Column) -> Column:
    return F.concat_ws(".", nz(token, "_unknown_"), nz(type_, "_"))


def topic_index_name(topic: Column, token: Column, type_: Column) -> Column:
    return F.concat_ws(".", topic, index_name(token, type_))


def escape_index(c: Column) -> Column:
    """Letters, digits, ``_`` and ``-`` stay, anything else becomes ``-``; lower case."""
    return F.lower(F.regexp_replace(c, r"[^\p{L}\p{Nd}_-]", "-"))


def parse_period(period: str | None) -> tuple[int, int, int]:
    """(months, weeks, hours) of a text such as ``6mo``, ``2wk`` or ``12hr``."""
    text = period if period and period.strip() else DEFAULT_PERIOD
    return tuple(int(g or 0) for g in re.match(PERIOD_TEXT, text).groups())


def rounded_period(period: str | None) -> tuple[str, int]:
    """Largest unit of the period, rounded to a divisor of the year, month or day."""
    months, weeks, hours = parse_period(period)
    if months > 0:
        return "mo", 12 // (12 // min(months, 12))
    if weeks > 0:
        return "wk", 1 if weeks == 1 else 2
    if 0 < hours < 24:
        return "hr", 24 // (24 // hours)
    return "hr", 24


def rotation_stamp(millis: Column, period: str | None = None) -> Column:
    """``yyMMddHH`` of the next rotation boundary after ``millis``; ``_`` without a time."""
    local = F.convert_timezone(None, F.lit(ROTATION_ZONE), F.timestamp_millis(millis))
    unit, n = rounded_period(period)
    day, hour = {"mo": _next_month, "wk": _next_week, "hr": _next_hour}[unit](local, n)
    return nz(F.concat(F.date_format(day, "yyMMdd"), F.lpad(hour.cast("string"), 2, "0")), "_")


def _next_hour(local: Column, n: int) -> tuple[Column, Column]:
    end = F.floor(F.hour(local) / F.lit(n)).cast("int") * n + n
    return F.date_add(F.to_date(local), F.when(end >= 24, 1).otherwise(0)), end % 24


def _next_week(local: Column, n: int) -> tuple[Column, Column]:
    day = F.to_date(local)
    if n == 1:
        # weekday() counts Monday as 0
        return F.date_add(day, F.lit(7) - F.weekday(day)), F.lit(0)
    first = F.trunc(day, "month")
    return F.when(F.dayofmonth(day) <= 15, F.date_add(first, 15)).otherwise(F.add_months(first, 1)), F.lit(0)


def _next_month(local: Column, n: int) -> tuple[Column, Column]:
    day = F.to_date(local)
    ahead = F.floor((F.month(day) - 1) / F.lit(n)).cast("int") * n + n
    return F.add_months(F.trunc(day, "year"), ahead), F.lit(0)


def rotated_index(
    prefix: Column,
    record_millis: Column,
    upload_millis: Column,
    record_period: str | None = None,
    upload_period: str | None = None,
) -> Column:
    return F.concat_ws(
        ".", prefix, rotation_stamp(record_millis, record_period), rotation_stamp(upload_millis, upload_period)
    )


def valid_period(period: Column) -> Column:
    """Is a period text allowed: months divide 12, one or two weeks, hours divide 24."""
    months, weeks, hours = (
        F.coalesce(F.regexp_extract(period, PERIOD_TEXT, i).try_cast("int"), F.lit(0)) for i in (1, 2, 3)
    )
    return (
        F.when(F.trim(nz(period)) == "", False)
        .when(months > 0, (months <= 12) & (F.pmod(F.lit(12), months) == 0))
        .when(weeks > 0, weeks <= 2)
        .otherwise((hours > 0) & (hours <= 24) & (F.when(hours > 0, F.pmod(F.lit(24), hours)) == 0))
    )
