"""Changes of a table's columns: what would be lost is counted first, then the rows are rewritten."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_WIDER = [T.ByteType, T.ShortType, T.IntegerType, T.LongType]


def spark_type(declared: str) -> T.DataType:
    """The type that holds a declared column."""
    m = re.fullmatch(r"\s*(\w+)\s*(?:\((\d+)(?:\s*,\s*(\d+))?\))?\s*(unsigned)?\s*", declared.lower())
    if not m:
        raise ValueError(f"no type {declared!r}")
    name, a, b = m[1], m[2], m[3]
    if name in ("tinyint", "smallint"):
        return T.IntegerType()
    if name in ("mediumint", "int", "integer", "bigint"):
        return T.LongType()
    if name in ("decimal", "numeric"):
        return T.DecimalType(int(a or 10), int(b or 0))
    if name in ("char", "varchar", "text", "tinytext", "mediumtext", "longtext", "json"):
        return T.StringType()
    if name in ("datetime", "timestamp"):
        return T.TimestampNTZType()
    if name == "date":
        return T.DateType()
    if name in ("blob", "tinyblob", "mediumblob", "longblob", "varbinary"):
        return T.BinaryType()
    raise ValueError(f"no type {declared!r}")


def losses(df: DataFrame, column: str, declared: str, not_null: bool = False) -> DataFrame:
    """One row: how many values a change of ``column`` would cut, fail to convert, or find NULL."""
    kind, value = spark_type(declared), F.col(column)
    room = re.search(r"char\s*\((\d+)\)", declared.lower())
    count = lambda c: F.coalesce(F.sum(F.when(c, 1).otherwise(0)), F.lit(0)).cast("bigint")
    cut = F.char_length(value.cast("string")) > int(room[1]) if room else F.lit(False)
    number = value.try_cast("decimal(38,10)")
    broken = value.isNotNull() & value.try_cast(kind).isNull()
    if isinstance(kind, T.LongType):
        broken = broken | (value.isNotNull() & number.isNotNull() & (number != F.floor(number)))
    negative = number < 0 if "unsigned" in declared.lower() else F.lit(False)
    empty = value.isNull() if not_null else F.lit(False)
    return df.agg(count(cut).alias("cut"), count(broken).alias("unconvertible"), count(negative).alias("negative"), count(empty).alias("nulls"))


def widens(old: T.DataType, new: T.DataType) -> bool:
    """Whether every value of ``old`` is one of ``new``."""
    ranks = {k: i for i, k in enumerate(_WIDER)}
    if type(old) in ranks and type(new) in ranks:
        return ranks[type(old)] <= ranks[type(new)]
    if isinstance(old, T.DecimalType) and isinstance(new, T.DecimalType):
        return new.scale >= old.scale and new.precision - new.scale >= old.precision - old.scale
    return old == new


def declared_json(df: DataFrame, name: str) -> DataFrame:
    """Mark a text column as JSON: its spelling is kept and it can't be compared."""
    return df.withColumn(name, F.col(name).alias(name, metadata={"declared": "json"}))


def add_column(df: DataFrame, name: str, declared: str, default=None) -> DataFrame:
    if name.lower() in {c.lower() for c in df.columns}:
        raise ValueError(f"column {name} exists")
    return df.withColumn(name, F.lit(default).cast(spark_type(declared)))


def rename_column(df: DataFrame, old: str, new: str) -> DataFrame:
    if new.lower() in {c.lower() for c in df.columns if c.lower() != old.lower()}:
        raise ValueError(f"column {new} exists")
    return df.withColumnRenamed(old, new)


def modify_column(df: DataFrame, name: str, declared: str) -> DataFrame:
    """Give a column a wider type; anything else is refused."""
    if not widens(df.schema[name].dataType, spark_type(declared)):
        raise ValueError(f"{name} can't become {declared} without loss")
    return df.withColumn(name, F.col(name).cast(spark_type(declared)))


def text_length(column: str, room: int) -> Column:
    """The check that stands for a declared length."""
    return F.char_length(column) <= room
