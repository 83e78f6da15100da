"""Calendar functions.

A zero date is stored as ``ZERO_DATE``. It has no place in a calendar: WEEK, DAYOFYEAR, DAYOFWEEK, WEEKDAY
and interval arithmetic give NULL for it; YEAR, MONTH and DAY give 0, UNIX_TIMESTAMP gives 0, and
DATE_FORMAT writes zeros for numbers of the date and is NULL where it asks for a name, a week or a day of
the year. Times without a zone are read as UTC whatever the session's zone is.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .coercion import ZERO_DATE

UNITS = ("microsecond", "second", "minute", "hour", "day", "week", "month", "quarter", "year")
#: WEEK's modes, fixed by the MySQL manual: whether weeks begin on Monday, whether week 0 exists, whether
#: a year's first week is the one with four or more days in it, rather than the first whole one.
WEEK_MODES = {
    0: (False, True, False), 1: (True, True, True), 2: (False, False, False), 3: (True, False, True),
    4: (False, True, True), 5: (True, True, False), 6: (False, False, True), 7: (True, False, False),
}


def _is_zero(value: Column) -> Column:
    return value.cast("date") == F.lit(ZERO_DATE).cast("date")


def _known(value: Column, result: Column) -> Column:
    return F.when(~_is_zero(value), result)


def _or_zero(value: Column, result: Column) -> Column:
    return F.when(_is_zero(value), F.lit(0)).otherwise(result)


def year(value: Column) -> Column:
    return _or_zero(value, F.year(value))


def month(value: Column) -> Column:
    return _or_zero(value, F.month(value))


def day(value: Column) -> Column:
    return _or_zero(value, F.dayofmonth(value))


def hour(value: Column) -> Column:
    return F.hour(value.cast("timestamp_ntz"))


def minute(value: Column) -> Column:
    return F.minute(value.cast("timestamp_ntz"))


def second(value: Column) -> Column:
    """Whole seconds."""
    return F.second(value.cast("timestamp_ntz"))


def day_of_year(value: Column) -> Column:
    return _known(value, F.dayofyear(value))


def day_of_week(value: Column) -> Column:
    """Sunday is 1."""
    return _known(value, F.dayofweek(value))


def weekday(value: Column) -> Column:
    """Monday is 0."""
    return _known(value, F.weekday(value))


def _decisive(value: Column, monday: bool, four: bool) -> Column:
    """The day whose year owns the week of ``value``: the week's fourth day, or its first."""
    date = value.cast("date")
    return F.date_add(date, (3 if four else 0) - (F.weekday(date) if monday else F.dayofweek(date) - 1))


def _nth(decisive: Column) -> Column:
    """Which of its year's decisive days this is: they are seven days apart."""
    return F.ceil(F.dayofyear(decisive) / 7).cast("int")


def week(value: Column, mode: int = 0) -> Column:
    """WEEK(value, mode), modes 0 to 7.

    Where week 0 exists, days before the year's first week are in it, and days in the next year's first
    week count on from the week before.
    """
    if mode not in WEEK_MODES:
        raise ValueError("the mode is 0 to 7")
    monday, has_zero, four = WEEK_MODES[mode]
    owner = _decisive(value, monday, four)
    if not has_zero:
        return _known(value, _nth(owner))
    own = F.when(F.year(owner) < F.year(value), F.lit(0)).when(F.year(owner) > F.year(value), _nth(F.date_sub(owner, 7)) + 1).otherwise(_nth(owner))
    return _known(value, own)


def week_year(value: Column, monday: bool = False) -> Column:
    """The year that owns the week of ``value``, in modes 2 and 3."""
    return _known(value, F.year(_decisive(value, monday, monday)))


def _digits(number: Column, n: int) -> Column:
    return F.lpad(number.cast("string"), n, "0")


def _suffixed(number: Column) -> Column:
    """1st, 2nd, 3rd, 4th, 11th."""
    last = F.when(number.between(11, 13), 0).otherwise(number % 10)
    return F.concat(number.cast("string"), F.when(last == 1, "st").when(last == 2, "nd").when(last == 3, "rd").otherwise("th"))


def _directives(value: Column) -> dict[str, Column]:
    """The directives of DATE_FORMAT, as MySQL's manual lists them."""
    clock = value.cast("timestamp_ntz")
    twelve = (hour(value) + 11) % 12 + 1
    half = F.when(hour(value) < 12, "AM").otherwise("PM")
    name = lambda pattern: _known(value, F.date_format(clock, pattern))
    time = F.date_format(clock, "HH:mm:ss")
    return {
        "a": name("EEE"), "b": name("MMM"), "c": month(value).cast("string"), "D": _suffixed(day(value)), "d": _digits(day(value), 2), "e": day(value).cast("string"),
        "f": F.date_format(clock, "SSSSSS"), "H": _digits(hour(value), 2), "h": _digits(twelve, 2), "I": _digits(twelve, 2), "i": _digits(minute(value), 2),
        "j": _digits(day_of_year(value), 3), "k": hour(value).cast("string"), "l": twelve.cast("string"), "M": name("MMMM"), "m": _digits(month(value), 2), "p": half,
        "r": F.concat(_digits(twelve, 2), F.date_format(clock, ":mm:ss "), half), "S": _digits(second(value), 2), "s": _digits(second(value), 2), "T": time,
        "U": _digits(week(value, 0), 2), "u": _digits(week(value, 1), 2), "V": _digits(week(value, 2), 2), "v": _digits(week(value, 3), 2), "W": name("EEEE"),
        "w": (day_of_week(value) - 1).cast("string"), "X": _digits(week_year(value), 4), "x": _digits(week_year(value, monday=True), 4), "Y": _digits(year(value), 4), "y": _digits(year(value) % 100, 2),
    }


def date_format(value: Column, pattern: str) -> Column:
    """DATE_FORMAT with all directives and %%."""
    known, parts, i = _directives(value), [], 0
    while i < len(pattern):
        if pattern[i] == "%" and pattern[i + 1 : i + 2] in known:
            parts.append(known[pattern[i + 1]])
            i += 2
        elif pattern[i] == "%" and pattern[i + 1 : i + 2] != "%":
            raise ValueError(f"no directive {pattern[i : i + 2]}")
        else:
            i += 1 if pattern[i] == "%" else 0
            parts.append(F.lit(pattern[i]))
            i += 1
    return F.when(value.isNotNull(), F.concat(*parts) if parts else F.lit(""))


def add(value: Column, number: Column, unit: str) -> Column:
    """``value`` + INTERVAL ``number`` ``unit``."""
    unit = unit.lower()
    if unit not in UNITS:
        raise ValueError(f"no unit {unit}")
    if unit in ("month", "quarter", "year"):
        months = {"month": 1, "quarter": 3, "year": 12}[unit]
        return _known(value, value.cast("timestamp_ntz") + F.make_ym_interval(F.lit(0), (number * months).cast("int")))
    seconds = {"microsecond": 1e-6, "second": 1, "minute": 60, "hour": 3600, "day": 86400, "week": 604800}[unit]
    whole = F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), (number * F.lit(seconds)).cast("decimal(18,6)"))
    return _known(value, value.cast("timestamp_ntz") + whole)


def subtract(value: Column, number: Column, unit: str) -> Column:
    return add(value, -number, unit)


def unix_timestamp(value: Column) -> Column:
    """Seconds since 1970, with their fraction."""
    clock = value.cast("timestamp_ntz")
    days = F.datediff(value.cast("date"), F.lit("1970-01-01").cast("date")).cast("double")
    return _or_zero(value, days * 86400 + F.hour(clock) * 3600 + F.minute(clock) * 60 + F.extract(F.lit("SECOND"), clock).cast("double"))


def now() -> Column:
    """NOW(): the statement's time in the session's zone."""
    return F.localtimestamp()


def today() -> Column:
    """CURDATE()."""
    return F.current_date()


def time_of_day() -> Column:
    """CURTIME() as text."""
    return F.date_format(F.localtimestamp(), "HH:mm:ss")


def utc_now() -> Column:
    """UTC_TIMESTAMP()."""
    return F.convert_timezone(F.current_timezone(), F.lit("UTC"), F.localtimestamp())


def utc_today() -> Column:
    """UTC_DATE()."""
    return utc_now().cast("date")


def utc_time_of_day() -> Column:
    """UTC_TIME() as text."""
    return F.date_format(utc_now(), "HH:mm:ss")
