"""Widths of time: what a caller may write, and the one form the rest of the package uses.

A width is a ``datetime.timedelta``, a pair ``(n, unit)``, an interval text such as ``"15 minutes"`` or
``"2 days 04:00:00"``, or a plain ``int`` for tables whose time column is an integer.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from datetime import date, datetime, timedelta, timezone
from fractions import Fraction
from typing import Any

MICROS_PER_SECOND = 1_000_000
MICROS_PER_DAY = 86_400 * MICROS_PER_SECOND

# The units a width may use, in microseconds or in months.
UNIT_MICROS = {
    "microsecond": 1,
    "millisecond": 1_000,
    "second": MICROS_PER_SECOND,
    "minute": 60 * MICROS_PER_SECOND,
    "hour": 3_600 * MICROS_PER_SECOND,
    "day": MICROS_PER_DAY,
    "week": 7 * MICROS_PER_DAY,
}
UNIT_MONTHS = {"month": 1, "year": 12}
# Other names of units, besides plurals.
UNIT_NAMES = {
    "us": "microsecond",
    "usec": "microsecond",
    "ms": "millisecond",
    "msec": "millisecond",
    "s": "second",
    "sec": "second",
    "m": "minute",
    "min": "minute",
    "h": "hour",
    "hr": "hour",
    "d": "day",
    "w": "week",
    "mon": "month",
    "y": "year",
    "yr": "year",
}

# Bucket origins. Fixed widths count from Monday 2000-01-03, calendar widths from 2000-01-01,
# integer widths from zero.
FIXED_ORIGIN = 946_857_600 * MICROS_PER_SECOND
CALENDAR_ORIGIN = "2000-01-01"
CALENDAR_ORIGIN_YEAR = 2000

DEFAULT_CHUNK = "7 days"

_EPOCH = datetime(1970, 1, 1)
_CLOCK = re.compile(r"(\d+):([0-5]?\d)(?::([0-5]?\d)(?:\.(\d{1,6}))?)?")
_AMOUNT = re.compile(r"(\d+(?:\.\d+)?|\.\d+)\s*([a-z]+)")


@dataclass(frozen=True)
class Width:
    """``kind`` is "micros", "months" or "raw"; ``size`` counts them."""

    kind: str
    size: int


def _unit(name: str) -> str:
    name = name.strip().lower()
    singular = name[:-1] if name.endswith("s") and name not in UNIT_NAMES else name
    singular = UNIT_NAMES.get(singular, singular)
    if singular not in UNIT_MICROS and singular not in UNIT_MONTHS:
        raise ValueError(f"unknown time unit: {name!r}")
    return singular


def _whole(amount: str, size: int) -> int:
    """``amount`` units of ``size``; a part of a microsecond or of a month is an error."""
    count = Fraction(amount) * size
    if count.denominator != 1:
        raise ValueError(f"not a whole number of microseconds or months: {amount!r}")
    return int(count)


def _from_text(text: str) -> Width:
    rest = text.strip().lower()
    micros = months = 0
    found = False
    for clock in _CLOCK.finditer(rest):
        hours, minutes, seconds, fraction = clock.groups()
        micros += (int(hours) * 3600 + int(minutes) * 60 + int(seconds or 0)) * MICROS_PER_SECOND
        micros += int((fraction or "").ljust(6, "0"))
        found = True
    rest = _CLOCK.sub(" ", rest)
    for amount, name in _AMOUNT.findall(rest):
        unit = _unit(name)
        if unit in UNIT_MONTHS:
            months += _whole(amount, UNIT_MONTHS[unit])
        else:
            micros += _whole(amount, UNIT_MICROS[unit])
        found = True
    if not found or _AMOUNT.sub("", rest).strip():
        raise ValueError(f"not an interval: {text!r}")
    if months and micros:
        raise ValueError(f"a width cannot mix months with shorter units: {text!r}")
    return Width("months", months) if months else Width("micros", micros)


def parse_width(value: Any, allow_zero: bool = False) -> Width:
    """The width a caller wrote, as microseconds, months or a raw integer. Negative widths are an error."""
    if isinstance(value, Width):
        width = value
    elif isinstance(value, bool):
        raise TypeError("a width cannot be a boolean")
    elif isinstance(value, int):
        width = Width("raw", value)
    elif isinstance(value, timedelta):
        width = Width("micros", value // timedelta(microseconds=1))
    elif isinstance(value, (tuple, list)) and len(value) == 2:
        unit = _unit(value[1])
        amount = int(value[0])
        if unit in UNIT_MONTHS:
            width = Width("months", amount * UNIT_MONTHS[unit])
        else:
            width = Width("micros", amount * UNIT_MICROS[unit])
    elif isinstance(value, str):
        width = _from_text(value)
    else:
        raise TypeError(f"not a width: {value!r}")
    if width.size < 0 or (width.size == 0 and not allow_zero):
        raise ValueError(f"a width must be {'at least' if allow_zero else 'above'} zero: {value!r}")
    return width


def width_text(value: Any) -> str | int:
    """The width as interval text (or the plain integer), the form in which a stored spec keeps it."""
    width = parse_width(value, allow_zero=True)
    if width.kind == "raw":
        return width.size
    if isinstance(value, str):
        return value.strip()
    if isinstance(value, (tuple, list)):
        amount, unit = int(value[0]), _unit(value[1])
        return f"{amount} {unit}" if amount == 1 else f"{amount} {unit}s"
    if width.kind == "months":
        return f"{width.size} month" if width.size == 1 else f"{width.size} months"
    days, micros = divmod(width.size, MICROS_PER_DAY)
    seconds, fraction = divmod(micros, MICROS_PER_SECOND)
    day_text = "" if not days else f"{days} day" if days == 1 else f"{days} days"
    if days and not micros:
        return day_text
    clock = f"{seconds // 3600:02d}:{seconds // 60 % 60:02d}:{seconds % 60:02d}"
    if fraction:
        clock += f".{fraction:06d}".rstrip("0")
    return f"{day_text} {clock}".strip()


def as_instant(value: Any) -> int:
    """A point in time as a position: microseconds since 1970 in UTC, or the integer itself."""
    if isinstance(value, bool):
        raise TypeError("a point in time cannot be a boolean")
    if isinstance(value, int):
        return value
    if isinstance(value, str):
        value = datetime.fromisoformat(value)
    if isinstance(value, datetime):
        if value.tzinfo is not None:
            value = value.astimezone(timezone.utc).replace(tzinfo=None)
        return (value - _EPOCH) // timedelta(microseconds=1)
    if isinstance(value, date):
        return (value - _EPOCH.date()).days * MICROS_PER_DAY
    raise TypeError(f"not a point in time: {value!r}")


def _month_number(position: int) -> int:
    day = _EPOCH + timedelta(microseconds=position)
    return (day.year - CALENDAR_ORIGIN_YEAR) * 12 + day.month - 1


def _month_start(number: int) -> int:
    return as_instant(date(CALENDAR_ORIGIN_YEAR + number // 12, number % 12 + 1, 1))


def bucket_index_at(position: int, width: Width) -> int:
    """Number of the bucket that holds ``position``."""
    if width.kind == "months":
        return _month_number(position) // width.size
    return (position - (FIXED_ORIGIN if width.kind == "micros" else 0)) // width.size


def bucket_start_at(index: int, width: Width) -> int:
    """Position where bucket ``index`` starts."""
    if width.kind == "months":
        return _month_start(index * width.size)
    return index * width.size + (FIXED_ORIGIN if width.kind == "micros" else 0)


def bucket_floor(position: int, width: Width) -> int:
    return bucket_start_at(bucket_index_at(position, width), width)


def bucket_ceiling(position: int, width: Width) -> int:
    floor = bucket_floor(position, width)
    return floor if floor == position else bucket_end(floor, width)


def bucket_end(position: int, width: Width) -> int:
    """End of the bucket that holds ``position``."""
    return bucket_start_at(bucket_index_at(position, width) + 1, width)


def before(position: int, width: Width) -> int:
    """``position`` minus ``width``; calendar widths keep the day of month where it exists."""
    if width.kind != "months":
        return position - width.size
    moment = _EPOCH + timedelta(microseconds=position)
    number = _month_number(position) - width.size
    month_days = (_month_start(number + 1) - _month_start(number)) // MICROS_PER_DAY
    day_in_month = min(moment.day, month_days) - 1
    return _month_start(number) + day_in_month * MICROS_PER_DAY + position % MICROS_PER_DAY
