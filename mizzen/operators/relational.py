"""Order, distinct, grouping and union with MySQL's rules, as DataFrame plans."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.coercion import as_text


def ordered(df: DataFrame, *keys: str) -> DataFrame:
    """Sort by columns, a leading ``-`` for descending: NULL is first ascending and last descending."""
    return df.orderBy(*[F.col(k[1:]).desc_nulls_last() if k.startswith("-") else F.col(k).asc_nulls_first() for k in keys])


def page(df: DataFrame, keys: list[str], n: int, skip: int = 0) -> DataFrame:
    """LIMIT skip, n of the sorted rows; planned as a top-k, not a full sort."""
    out = ordered(df, *keys)
    return (out.offset(skip) if skip else out).limit(n)


def found_rows(df: DataFrame) -> int:
    """Rows that a query has without its LIMIT, counted when asked for."""
    return df.count()


def page_and_found(df: DataFrame, keys: list[str], n: int, skip: int = 0) -> DataFrame:
    """A page of the sorted rows with ``found``, how many rows there are without the limit."""
    return ordered(page(df, keys, n, skip).crossJoin(F.broadcast(df.agg(F.count(F.lit(1)).alias("found")))), *keys)


def in_rows(df: DataFrame, column: str, others: DataFrame, other: str) -> DataFrame:
    """Rows of ``df`` WHERE column IN (SELECT other FROM others)."""
    known = others.select(F.col(other).alias(column))
    return df.join(known, column, "left_semi").select(*df.columns)


def not_in_rows(df: DataFrame, column: str, others: DataFrame, other: str) -> DataFrame:
    """Rows of ``df`` WHERE column NOT IN (SELECT other FROM others).

    A NULL among the others leaves nothing, a NULL in ``column`` is kept only if there are no others; one row
    of counts tells which it is, and a plain anti join of the keys does the rest.
    """
    counts = others.agg(F.count(F.lit(1)).alias("__all"), F.count(other).alias("__known"))
    open_ = (F.col("__all") == 0) | ((F.col("__all") == F.col("__known")) & F.col(column).isNotNull())
    known = others.select(F.col(other).alias(column)).dropna()
    return df.crossJoin(F.broadcast(counts)).where(open_).select(*df.columns).join(known, column, "left_anti").select(*df.columns)


def one_row(spark: SparkSession, **values: DataFrame) -> DataFrame:
    """SELECT without FROM: one row of scalar subqueries, each a frame of one row and one column."""
    out = spark.range(1).select()
    for name, frame in values.items():
        out = out.crossJoin(F.broadcast(frame.toDF(name)))
    return out


def union_all(first: DataFrame, *others: DataFrame) -> DataFrame:
    """UNION ALL by position; where numbers meet texts, the numbers become texts, and booleans 1 or 0."""
    frames = [first, *others]
    names = first.columns
    if any(len(f.columns) != len(names) for f in frames):
        raise ValueError("branches differ in their number of columns")
    kinds = [[f.schema.fields[i].dataType for f in frames] for i in range(len(names))]
    texts = [any(isinstance(k, T.StringType) for k in ks) and any(not isinstance(k, T.StringType) for k in ks) for ks in kinds]

    def aligned(f: DataFrame) -> DataFrame:
        plain = f.toDF(*[f"c{i}" for i in range(len(names))])
        return plain.select(*[(as_text(plain, f"c{i}") if texts[i] else F.col(f"c{i}")).alias(n) for i, n in enumerate(names)])

    out = aligned(frames[0])
    for f in frames[1:]:
        out = out.union(aligned(f))
    return out


def union(first: DataFrame, *others: DataFrame) -> DataFrame:
    """UNION: distinct rows."""
    return union_all(first, *others).distinct()


def group_by_key(df: DataFrame, key: list[str], aggregates: list[Column], carried: list[str]) -> DataFrame:
    """Group by a key and carry columns that the key determines, which needn't be grouped by."""
    return df.groupBy(*key).agg(*[F.any_value(c).alias(c) for c in carried], *aggregates)


def distinct_sorted(df: DataFrame, columns: list[str], key: str, by: list[str]) -> DataFrame:
    """DISTINCT ``columns`` sorted by columns outside them that the unique ``key`` among them determines."""
    if key not in columns:
        raise ValueError("the sort columns must be determined by a selected key")
    plain = [b.lstrip("-") for b in by]
    hidden = [b for b in plain if b not in columns]
    rows = df.groupBy(*columns).agg(*[F.any_value(h).alias(h) for h in hidden]) if hidden else df.select(*columns).distinct()
    return ordered(rows, *by).select(*columns)


def distinct_calendar(df: DataFrame, column: str) -> DataFrame:
    """DISTINCT YEAR(column), MONTH(column), latest first."""
    months = df.select(F.year(column).alias("year"), F.month(column).alias("month")).distinct()
    return ordered(months, "-year", "-month")


def duplicates(df: DataFrame, keys: list[str]) -> DataFrame:
    """Key values that several rows have; NULL in a key is never a duplicate."""
    some = df.dropna(subset=keys)
    return some.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def table_status(tables: dict[str, DataFrame]) -> DataFrame:
    """Exact row counts, one row a table; the counts run as one job."""
    parts = [t.select(F.lit(name).alias("table_name")) for name, t in tables.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.union(p)
    return out.groupBy("table_name").agg(F.count(F.lit(1)).alias("table_rows"))
