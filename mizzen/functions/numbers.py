"""Arithmetic, sums and casts on operands of any type.

Operands are column names, Columns or literals of a DataFrame. Text counts as its leading number,
booleans as 1 and 0. A division by zero is NULL; exact operands divide exactly, to four more
digits than the dividend has. A cast that has no result is NULL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .coercion import NUMBER, ZERO_DATE, as_text, kind_of, number, operand

_WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def plus(df: DataFrame, a, b) -> Column:
    return number(df, a) + number(df, b)


def minus(df: DataFrame, a, b) -> Column:
    return number(df, a) - number(df, b)


def times(df: DataFrame, a, b) -> Column:
    return number(df, a) * number(df, b)


def negative(df: DataFrame, a) -> Column:
    return -number(df, a)


def _exact(df: DataFrame, value: Column) -> T.DecimalType | None:
    """The decimal type that holds ``value``, if it is exact."""
    kind = kind_of(df, value)
    if isinstance(kind, _WHOLE):
        return T.DecimalType(19, 0)
    return kind if isinstance(kind, T.DecimalType) else None


def divide(df: DataFrame, a, b) -> Column:
    x, y = number(df, a), number(df, b)
    kinds = _exact(df, x), _exact(df, y)
    if None in kinds:
        return F.try_divide(x.cast("double"), y.cast("double"))
    return F.try_divide(x.cast(kinds[0]), y.cast(kinds[1])).cast(T.DecimalType(38, min(kinds[0].scale + 4, 30)))


def modulo(df: DataFrame, a, b) -> Column:
    return F.try_mod(number(df, a), number(df, b))


def int_divide(df: DataFrame, a, b) -> Column:
    """Quotient truncated toward zero; exact for exact operands."""
    x, y = number(df, a), number(df, b)
    if None not in (_exact(df, x), _exact(df, y)):
        return F.call_function("div", x, F.nullif(y, F.lit(0)))
    q = F.try_divide(x.cast("double"), y.cast("double"))
    return F.when(q < 0, F.ceil(q)).otherwise(F.floor(q)).cast("bigint")


def _bits(df: DataFrame, value) -> Column:
    return F.round(number(df, value)).cast("bigint")


def bits_or(df: DataFrame, a, b) -> Column:
    return _bits(df, a).bitwiseOR(_bits(df, b))


def bits_and(df: DataFrame, a, b) -> Column:
    return _bits(df, a).bitwiseAND(_bits(df, b))


def bits_xor(df: DataFrame, a, b) -> Column:
    return _bits(df, a).bitwiseXOR(_bits(df, b))


def bits_not(df: DataFrame, a) -> Column:
    """All 64 bits turned, as a signed number."""
    return F.bitwise_not(_bits(df, a))


def _shifted(shift, df: DataFrame, a, n: int) -> Column:
    return shift(_bits(df, a), n) if 0 <= n < 64 else F.when(_bits(df, a).isNotNull(), F.lit(0).cast("bigint"))


def shift_left(df: DataFrame, a, n: int) -> Column:
    """``a << n``; 0 once all bits are out."""
    return _shifted(F.shiftleft, df, a, n)


def shift_right(df: DataFrame, a, n: int) -> Column:
    """``a >> n`` without a sign; 0 once all bits are out."""
    return _shifted(F.shiftrightunsigned, df, a, n)


def total(df: DataFrame, value, distinct: bool = False) -> Column:
    """Aggregate: SUM([DISTINCT] value)."""
    return (F.sum_distinct if distinct else F.sum)(number(df, value))


def mean(df: DataFrame, value, distinct: bool = False) -> Column:
    """Aggregate: AVG([DISTINCT] value)."""
    numbers = number(df, value)
    return F.try_divide(F.sum_distinct(numbers), F.count_distinct(numbers)) if distinct else F.avg(numbers)


def signed(df: DataFrame, value) -> Column:
    """CAST(value AS SIGNED), rounded."""
    return F.round(number(df, value)).try_cast("bigint")


def unsigned(df: DataFrame, value) -> Column:
    """CAST(value AS UNSIGNED), rounded."""
    return F.round(number(df, value)).try_cast("decimal(20,0)")


def as_decimal(df: DataFrame, value, precision: int = 10, scale: int = 0) -> Column:
    """CAST(value AS DECIMAL(precision, scale)); exact for text, NULL where it doesn't fit."""
    if isinstance(kind_of(df, value), T.StringType):
        text = operand(value)
        found = F.nullif(F.regexp_extract(text, NUMBER, 1), F.lit(""))
        return F.when(text.isNotNull(), F.coalesce(found, F.lit("0")).try_cast(T.DecimalType(precision, scale)))
    return number(df, value).try_cast(T.DecimalType(precision, scale))


def as_double(df: DataFrame, value) -> Column:
    return number(df, value).cast("double")


def as_float(df: DataFrame, value) -> Column:
    return number(df, value).cast("float")


def as_char(df: DataFrame, value) -> Column:
    """CAST(value AS CHAR)."""
    return as_text(df, value)


def _dated(df: DataFrame, value) -> Column:
    """Text of a date or time with a date of zeros in its stored form, and with dashes if it has only digits."""
    text = F.trim(as_text(df, value))
    plain = F.regexp_replace(text, r"^(\d{4})(\d{2})(\d{2})(?:(\d{2})(\d{2})(\d{2}))?$", "$1-$2-$3 $4:$5:$6")
    return F.regexp_replace(F.regexp_replace(plain, r" ::$", ""), "^0000-00-00", ZERO_DATE)


def as_date(df: DataFrame, value) -> Column:
    """CAST(value AS DATE) of a text, number, date or time."""
    return operand(value).cast("date") if isinstance(kind_of(df, value), (T.DateType, T.TimestampType, T.TimestampNTZType)) else _dated(df, value).try_cast("date")


def as_datetime(df: DataFrame, value) -> Column:
    """CAST(value AS DATETIME) of a text, number, date or time."""
    return operand(value).cast("timestamp_ntz") if isinstance(kind_of(df, value), (T.DateType, T.TimestampType, T.TimestampNTZType)) else _dated(df, value).try_cast("timestamp_ntz")


def as_time(df: DataFrame, value) -> Column:
    """CAST(value AS TIME) as text HH:mm:ss, of a time, or of a text that is or ends in one."""
    if isinstance(kind_of(df, value), (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return F.date_format(operand(value).cast("timestamp_ntz"), "HH:mm:ss")
    return F.nullif(F.regexp_extract(as_text(df, value), r"^(?:.*[ T])?([0-9]{1,3}:[0-5][0-9]:[0-5][0-9])(?:\.[0-9]*)?\s*$", 1), F.lit(""))


def as_json(df: DataFrame, value) -> Column:
    """CAST(value AS JSON): the text as it is spelt if it is JSON, else NULL."""
    text = as_text(df, value)
    return F.when(F.try_parse_json(text).isNotNull(), text)
