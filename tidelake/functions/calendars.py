"""Calendar arithmetic on hours since 1900-01-01, as column expressions.

Times of any CF calendar are plain numbers here; a date is a struct (y, m, d) of
that calendar, so that 30 February of a 360-day year is as good as any other.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F

STANDARD = ("standard", "gregorian", "proleptic_gregorian")
# Seconds by which an instant is shifted before it is put into a period.
CONVENTIONS = {"end": 1.0, "instant": 0.0}
DEFAULT_CONVENTION = "instant"
_NAMES = {"365_day": "noleap", "366_day": "all_leap"}
_DAYS = {"noleap": [31, 28, 31, 30, 31, 30, 31, 31, 30, 31, 30, 31], "all_leap": [31, 29, 31, 30, 31, 30, 31, 31, 30, 31, 30, 31]}
_JULIAN_1900 = 2415033  # Julian day number of 1900-01-01 in the Julian calendar


def calendar_name(calendar: str | None) -> str:
    """One name for each calendar; missing means standard."""
    name = _NAMES.get(calendar or "standard", calendar or "standard")
    if name in STANDARD:
        return "standard"
    if name not in (*_DAYS, "360_day", "julian"):
        raise ValueError(f"unknown calendar {calendar!r}")
    return name


def epsilon(convention: str | None) -> float:
    """Seconds of a time-stamping convention: `end` stamps an interval's end, `instant` the instant."""
    name = convention or DEFAULT_CONVENTION
    if name not in CONVENTIONS:
        raise ValueError(f"unknown time-stamping convention {name!r}, expected one of {list(CONVENTIONS)}")
    return CONVENTIONS[name]


def hours_since_epoch(ts: Column) -> Column:
    """Hours from 1900-01-01 to a TIMESTAMP_NTZ, whatever the session's time zone."""
    return F.timestamp_diff("MICROSECOND", F.lit("1900-01-01").cast("timestamp_ntz"), ts) / F.lit(3.6e9)


def timestamp_of(time_h: Column) -> Column:
    """TIMESTAMP_NTZ of hours in a standard calendar, to the second."""
    return F.timestamp_add("SECOND", F.round(time_h * 3600).cast("long"), F.lit("1900-01-01").cast("timestamp_ntz"))


def day_number(time_h: Column, eps: float = 0.0) -> Column:
    return F.floor((time_h - F.lit(eps / 3600)) / 24).cast("long")


def _int(x: Column) -> Column:
    return x.cast("int")


def _div(a: Column, n: int) -> Column:
    return F.floor(a / F.lit(n)).cast("long")


def date_of_day(d: Column, calendar: str | None = None) -> Column:
    """Struct (y, m, d) of a day number."""
    name = calendar_name(calendar)
    if name == "standard":
        date = F.date_add(F.lit("1900-01-01").cast("date"), _int(d))
        y, m, day = F.year(date), F.month(date), F.day(date)
    elif name == "360_day":
        y, m, day = 1900 + _div(d, 360), _div(F.pmod(d, F.lit(360)), 30) + 1, F.pmod(d, F.lit(30)) + 1
    elif name == "julian":
        c = d + (_JULIAN_1900 + 32082)
        q = _div(4 * c + 3, 1461)
        e = c - _div(1461 * q, 4)
        k = _div(5 * e + 2, 153)
        y, m, day = q - 4800 + _div(k, 10), k + 3 - 12 * _div(k, 10), e - _div(153 * k + 2, 5) + 1
    else:
        n = sum(_DAYS[name])
        doy, starts = F.pmod(d, F.lit(n)), [sum(_DAYS[name][:i]) for i in range(12)]
        y = 1900 + _div(d, n)
        m = sum(((doy >= s).cast("int") for s in starts[1:]), F.lit(1))
        day = doy - F.element_at(F.array(*map(F.lit, starts)), _int(m)) + 1
    return F.struct(_int(y).alias("y"), _int(m).alias("m"), _int(day).alias("d"))


def day_of_date(y: Column, m: Column, d: Column, calendar: str | None = None) -> Column:
    """Day number of a date: the inverse of date_of_day."""
    name = calendar_name(calendar)
    if name == "standard":
        return F.datediff(F.make_date(_int(y), _int(m), _int(d)), F.lit("1900-01-01").cast("date")).cast("long")
    if name == "360_day":
        return ((y - 1900) * 360 + (m - 1) * 30 + d - 1).cast("long")
    if name == "julian":
        a = (m <= 2).cast("long")
        k = m + 12 * a - 3
        return d + _div(153 * k + 2, 5) + 365 * (y + 4800 - a) + _div(y + 4800 - a, 4) - 32083 - _JULIAN_1900
    starts = F.array(*(F.lit(sum(_DAYS[name][:i])) for i in range(12)))
    return ((y - 1900) * sum(_DAYS[name]) + F.element_at(starts, _int(m)) + d - 1).cast("long")


def date_of(time_h: Column, calendar: str | None = None, convention: str | None = None, eps: float | None = None) -> Column:
    """The day that an instant belongs to; an explicit eps (seconds) overrides the convention."""
    return date_of_day(day_number(time_h, epsilon(convention) if eps is None else eps), calendar)


def month_of(time_h: Column, calendar: str | None = None, convention: str | None = None, eps: float | None = None) -> Column:
    """The month that an instant belongs to, as struct (y, m)."""
    date = date_of(time_h, calendar, convention, eps)
    return F.struct(date["y"].alias("y"), date["m"].alias("m"))


def is_year_start(time_h: Column, calendar: str | None = None) -> Column:
    """Whether an instant is 1 January 00:00:00, fractions of a second aside."""
    whole = F.floor(F.round(time_h * 3600, 3))
    date = date_of_day(_div(whole, 86400), calendar)
    return (F.pmod(whole, F.lit(86400)) == 0) & (date["m"] == 1) & (date["d"] == 1)


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value), with value computed once however often it is used."""
    return F.element_at(F.transform(F.array(value), use), 1)


def time_text(time_h: Column, calendar: str | None = None, separator: str = " ") -> Column:
    """`yyyy-MM-dd HH:mm:ss` of an instant in its calendar, to the second; null for null."""

    def told(seconds: Column) -> Column:
        rest = F.pmod(seconds, F.lit(86400))
        clock = [_div(rest, 3600), F.pmod(_div(rest, 60), F.lit(60)), F.pmod(rest, F.lit(60))]
        return _let(date_of_day(_div(seconds, 86400), calendar), lambda d: F.format_string(f"%04d-%02d-%02d{separator}%02d:%02d:%02d", d["y"], d["m"], d["d"], *clock))

    return F.when(time_h.isNotNull(), _let(F.round(time_h * 3600).cast("long"), told))


def _axis_parts(units: str) -> tuple[int, int, int, float, float]:
    """Year, month and day of an axis's start, its hours, and the hours of its unit."""
    found = re.fullmatch(r"\s*(hour|day|minute|second)s?\s+since\s+(-?\d+)-(\d+)-(\d+)(?:[ T](\d+):(\d+)(?::(\d+(?:\.\d*)?))?)?.*", units)
    if not found:
        raise ValueError(f"unknown time units {units!r}")
    unit, y, m, d, h, mi, s = found.groups()
    # Hours of a unit.
    return int(y), int(m), int(d), int(h or 0) + int(mi or 0) / 60 + float(s or 0) / 3600, {"hour": 1.0, "day": 24.0, "minute": 1 / 60, "second": 1 / 3600}[unit]


def _axis(units: str, calendar: str | None) -> tuple[Column, float, float]:
    """Day number and hours of an axis's start, and the hours of its unit."""
    y, m, d, hours, unit = _axis_parts(units)
    return day_of_date(F.lit(y), F.lit(m), F.lit(d), calendar), hours, unit


def axis_start(units: str, calendar: str | None = None) -> tuple[float, float]:
    """time_h of an axis's start and hours of its unit, as numbers: for readers that decode an axis outside a plan."""
    y, m, d, hours, unit = _axis_parts(units)
    return day_of(y, m, d, calendar) * 24.0 + hours, unit


def day_of(y: int, m: int, d: int, calendar: str | None = None) -> int:
    """day_of_date of plain numbers."""
    name = calendar_name(calendar)
    if name == "standard":
        return (date(y, m, d) - date(1900, 1, 1)).days
    if name == "360_day":
        return (y - 1900) * 360 + (m - 1) * 30 + d - 1
    if name == "julian":
        a = int(m <= 2)
        return d + (153 * (m + 12 * a - 3) + 2) // 5 + 365 * (y + 4800 - a) + (y + 4800 - a) // 4 - 32083 - _JULIAN_1900
    return (y - 1900) * sum(_DAYS[name]) + sum(_DAYS[name][: m - 1]) + d - 1


def year_of(time_h: float, calendar: str | None = None) -> int:
    """The year of an instant, as a plain number."""
    day = int(time_h // 24)
    guess = 1900 + int(day // 366)
    while day_of(guess + 1, 1, 1, calendar) <= day:
        guess += 1
    while day_of(guess, 1, 1, calendar) > day:
        guess -= 1
    return guess


def axis_hours(value: Column, units: str, calendar: str | None = None) -> Column:
    """time_h of values on an axis `<unit> since <y-m-d[ h:m[:s]]>` in the same calendar."""
    day, hours, unit = _axis(units, calendar)
    return value * F.lit(unit) + (day * 24.0 + hours)


def axis_values(time_h: Column, units: str, calendar: str | None = None) -> Column:
    """Values of instants on an axis in the same calendar: the inverse of axis_hours."""
    day, hours, unit = _axis(units, calendar)
    return (time_h - (day * 24.0 + hours)) / F.lit(unit)


def iso_hours(text: Column, calendar: str | None = None) -> Column:
    """time_h of texts `y-m-d[(T| )h:m[:s[.f]]][Z]`, for axes that hold dates instead of numbers; null for other texts and for dates that the calendar lacks."""
    form = r"^\s*(-?[0-9]{1,6})-([0-9]{1,2})-([0-9]{1,2})(?:[T ]([0-9]{1,2}):([0-9]{1,2})(?::([0-9]{1,2}(?:\.[0-9]*)?))?)?\s*Z?\s*$"

    def read(t: Column) -> Column:
        whole = [F.regexp_extract(t, form, i).try_cast("int").alias(n) for i, n in enumerate("ymd", 1)]
        clock = [F.coalesce(F.regexp_extract(t, form, i).try_cast("double"), F.lit(0.0)).alias(n) for i, n in ((4, "hour"), (5, "minute"), (6, "second"))]
        return F.struct(*whole, *clock)

    def counted(x: Column) -> Column:
        ok = x["m"].between(1, 12) & x["d"].between(1, 31) & (x["hour"] <= 24) & (x["minute"] < 60) & (x["second"] < 60)
        # Days are counted from the first of the month; the way back shows whether the date is one.
        day = day_of_date(F.when(ok, x["y"]), F.when(ok, x["m"]), F.lit(1), calendar) + x["d"] - 1
        return _let(day, lambda n: _let(date_of_day(n, calendar), lambda back: F.when((back["m"] == x["m"]) & (back["d"] == x["d"]), n * 24.0 + x["hour"] + x["minute"] / 60 + x["second"] / 3600)))

    return F.when(text.rlike(form), _let(read(text), counted))
