"""Numbers out of text, truth of any value, and comparison across types.

Operands are column names, Columns or Python literals; their types come from the DataFrame they are
used on. A Python text is a column's name, but a literal where something is compared with it. Filters on a column against a literal stay plain comparisons that reach the scan: where
possible the literal is converted, not the column. Columns of different types meet as numbers if
one is a number or a boolean, as times if one is a date or a time.
"""

from __future__ import annotations

from datetime import date, datetime
from decimal import Decimal
from functools import reduce
from operator import and_ as both
from operator import or_ as either

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_DIGITS = "[0-9]+"
_MANTISSA = rf"(?:{_DIGITS}\.?[0-9]*|\.{_DIGITS})"
#: What text is read as a number up to: blanks, a sign, digits with or without a point, an exponent.
NUMBER = rf"^\s*([-+]?{_MANTISSA}(?:[Ee][-+]?{_DIGITS})?)"
#: What a date of all zeros is stored as.
ZERO_DATE = "0001-01-01"

_TIMES = (T.DateType, T.TimestampType, T.TimestampNTZType)


def number_of(text: Column) -> Column:
    """The number a text begins with, 0 if there is none, NULL of NULL."""
    found = F.regexp_extract(text, NUMBER, 1)
    return F.when(text.isNull(), F.lit(None).cast("double")).otherwise(F.coalesce(found.try_cast("double"), F.lit(0.0)))


def numeric(value: Column, kind: T.DataType) -> Column:
    """``value`` of type ``kind`` as a number: booleans are 1 and 0, text and dates give their leading number."""
    if isinstance(kind, T.BooleanType):
        return F.when(value.isNull(), F.lit(None).cast("int")).when(value, 1).otherwise(0)
    if isinstance(kind, T.NumericType):
        return value
    if isinstance(kind, T.NullType):
        return F.lit(None).cast("double")
    return number_of(value.cast("string"))


def truth(value: Column, kind: T.DataType) -> Column:
    """Whether ``value`` holds: booleans as they are, anything else if its number isn't 0."""
    return value if isinstance(kind, T.BooleanType) else numeric(value, kind) != 0


def operand(value) -> Column:
    """A column by its name, a Column as it is, any other value as a literal."""
    return F.col(value) if isinstance(value, str) else value if isinstance(value, Column) else F.lit(value)


def kind_of(df: DataFrame, value) -> T.DataType:
    """The type of a column name, Column or literal on ``df``; only analysis, no job."""
    return df.select(operand(value)).schema.fields[0].dataType


def number(df: DataFrame, value) -> Column:
    """``value`` as a number on ``df``."""
    return numeric(operand(value), kind_of(df, value))


def holds(df: DataFrame, value) -> Column:
    """``value`` as a condition on ``df``."""
    return truth(operand(value), kind_of(df, value))


def as_text(df: DataFrame, value) -> Column:
    """``value`` as MySQL prints it: booleans are 1 and 0."""
    kind = kind_of(df, value)
    return (numeric(operand(value), kind) if isinstance(kind, T.BooleanType) else operand(value)).cast("string")


def _literal(value, kind: T.DataType) -> Column:
    """A literal as a value of the column's type; a zero date as its stored form; NULL where it has no such value."""
    if isinstance(value, str) and value.startswith("0000-00-00") and isinstance(kind, _TIMES):
        value = ZERO_DATE + value[10:]
    return F.lit(value).try_cast(kind)


def _met(a: Column, ka: T.DataType, b: Column, kb: T.DataType) -> tuple[Column, Column]:
    """Two expressions ready for comparison."""
    plain = (T.NumericType, T.BooleanType)
    if isinstance(ka, T.BooleanType) and isinstance(kb, T.BooleanType):
        return a, b
    if isinstance(ka, plain) or isinstance(kb, plain):
        return numeric(a, ka), numeric(b, kb)
    if isinstance(ka, _TIMES) != isinstance(kb, _TIMES):
        return (a, b.try_cast(ka)) if isinstance(ka, _TIMES) else (a.try_cast(kb), b)
    if isinstance(ka, _TIMES) and ka != kb:
        return a.cast("timestamp_ntz"), b.cast("timestamp_ntz")
    return a, b


def _pair(df: DataFrame, left, value) -> tuple[Column, Column]:
    """A column or expression of ``df`` and a literal or Column ready for comparison."""
    kind, column = kind_of(df, left), operand(left)
    for name in (left, value):
        _no_json(df, name)
    if isinstance(value, Column):
        return _met(column, kind, value, kind_of(df, value))
    if isinstance(value, bool):
        value = int(value)
    is_number = isinstance(value, (int, float, Decimal))
    if is_number and not isinstance(kind, T.NumericType):
        return numeric(column, kind), F.lit(float(value))
    if is_number or value is None:
        return column, F.lit(value)
    if isinstance(value, (date, datetime)):
        return column, F.lit(value).cast(kind)
    if isinstance(kind, (T.NumericType, T.BooleanType)):
        return numeric(column, kind), number_of(F.lit(value))
    return column, _literal(value, kind)


def _no_json(df: DataFrame, value) -> None:
    """JSON documents have no order or equality here: their spelling is kept, so texts would be compared."""
    if isinstance(value, (str, Column)):
        fields = [df.schema[value]] if isinstance(value, str) and value in df.columns else df.select(value).schema.fields if isinstance(value, Column) else []
        if any(f.metadata.get("declared") == "json" for f in fields):
            raise ValueError("JSON columns can't be compared")


_COMPARE = {
    "=": lambda a, b: a == b,
    "<>": lambda a, b: a != b,
    "<": lambda a, b: a < b,
    "<=": lambda a, b: a <= b,
    ">": lambda a, b: a > b,
    ">=": lambda a, b: a >= b,
    "<=>": lambda a, b: a.eqNullSafe(b),
}


def compare(df: DataFrame, left, operator: str, value) -> Column:
    """``left operator value`` for a column name or Column of ``df`` and a literal or Column.

    A text ``value`` is a literal. A numeric literal makes a text column numeric; any other literal
    takes the column's type; two columns meet by their types.
    """
    if operator not in _COMPARE:
        raise ValueError(f"no comparison {operator!r}")
    if value is None and operator != "<=>":
        return F.lit(None).cast("boolean")
    return _COMPARE[operator](*_pair(df, left, value))


def within(df: DataFrame, left, values: list) -> Column:
    """``left IN (values)`` with NULL among the values leaving unknown what is not found."""
    if not values:
        raise ValueError("IN needs a value")
    pairs = [_pair(df, left, v) for v in values]
    if len({str(a) for a, _ in pairs}) == 1:
        return pairs[0][0].isin(*[b for _, b in pairs])
    return reduce(either, [a == b for a, b in pairs])


def between(df: DataFrame, left, low, high) -> Column:
    return compare(df, left, ">=", low) & compare(df, left, "<=", high)


def same_text(a: Column, b: Column, ignore_case: bool = False) -> Column:
    """Equality of texts, exact unless told otherwise."""
    return F.lower(a) == F.lower(b) if ignore_case else a == b


def as_bytes(value: Column) -> Column:
    """UTF-8 bytes, for binary comparison."""
    return F.encode(value.cast("string"), "UTF-8")


def like(value: Column, pattern: str, escape: str = "\\", binary: bool = False) -> Column:
    """``value LIKE pattern``: case doesn't count unless ``binary``."""
    if binary and escape != "\\":
        raise ValueError("a binary LIKE takes no ESCAPE")
    text = value.cast("string")
    call = F.like if binary else F.ilike
    return call(text, F.lit(pattern), F.lit(escape))


def all_of(df: DataFrame, *values) -> Column:
    """AND of values of any type."""
    return reduce(both, [holds(df, v) for v in values])


def any_of(df: DataFrame, *values) -> Column:
    """OR of values of any type."""
    return reduce(either, [holds(df, v) for v in values])


def none_of(df: DataFrame, value) -> Column:
    """NOT of a value of any type."""
    return ~holds(df, value)


def xor(df: DataFrame, a, b) -> Column:
    return holds(df, a) != holds(df, b)


def is_true(value: Column, kind: T.DataType) -> Column:
    return truth(value, kind).eqNullSafe(F.lit(True))


def is_false(value: Column, kind: T.DataType) -> Column:
    return truth(value, kind).eqNullSafe(F.lit(False))


def aligned(df: DataFrame, *values) -> list[Column]:
    """Branches of one expression in one type: texts if any is a text, booleans among numbers as numbers."""
    kinds = [kind_of(df, v) for v in values]
    real = {type(k) for k in kinds if not isinstance(k, T.NullType)}
    if len(real) > 1 and T.StringType in real:
        return [as_text(df, v) for v in values]
    if len(real) > 1 and T.BooleanType in real:
        return [number(df, v) for v in values]
    return [operand(v) for v in values]


def if_(df: DataFrame, condition, then, otherwise) -> Column:
    """IF(condition, then, otherwise) for a condition of any type; ``then`` and ``otherwise`` meet in one type."""
    a, b = aligned(df, then, otherwise)
    return F.when(holds(df, condition), a).otherwise(b)


def case(df: DataFrame, *branches: tuple, otherwise=None) -> Column:
    """CASE WHEN condition THEN value ... ELSE otherwise END, conditions of any type."""
    values = aligned(df, *[v for _, v in branches], otherwise)
    out = values[-1]
    for (condition, _), value in reversed(list(zip(branches, values))):
        out = F.when(holds(df, condition), value).otherwise(out)
    return out


def case_of(df: DataFrame, left, *branches: tuple, otherwise=None) -> Column:
    """CASE left WHEN value THEN result ... ELSE otherwise END; texts among the values are literals."""
    return case(df, *[(compare(df, left, "=", value), result) for value, result in branches], otherwise=otherwise)


def field(df: DataFrame, left, *choices) -> Column:
    """1-based place of ``left`` among ``choices``, 0 if it isn't there; texts among the choices are literals."""
    out = F.lit(0)
    for k in range(len(choices), 0, -1):
        out = F.when(compare(df, left, "=", choices[k - 1]), k).otherwise(out)
    return out
