"""Export, inspect, restore and verify tables: gzipped JSON lines of base64 cells, with digests.

Every step is a distributed job: rows are encoded and hashed where they are. A table's digest doesn't
depend on the order of its rows: exact sums of 128 bits of each row's hash, and the number of rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def cell(name: str, kind: T.DataType) -> Column:
    """A cell as text that gives the value back: bytes as they are, all else in Spark's text form."""
    value = F.col(name)
    raw = value if isinstance(kind, T.BinaryType) else (F.to_json(value) if isinstance(kind, (T.ArrayType, T.MapType, T.StructType)) else value.cast("string")).cast("binary")
    return F.regexp_replace(F.base64(raw), r"[\r\n]", "")


def encoded(df: DataFrame) -> DataFrame:
    """Rows (row): each a JSON array of base64 texts and nulls."""
    cells = F.array(*[cell(f.name, f.dataType) for f in df.schema])
    return df.select(F.to_json(cells, {"ignoreNullFields": "false"}).alias("row"))


def digest(df: DataFrame) -> DataFrame:
    """One row: rows, digest. Equal for equal multisets of rows, in any order and partitioning."""
    hashed = encoded(df).select(F.sha2("row", 256).alias("sha"))
    words = [F.coalesce(F.sum(F.xxhash64(F.lit(k), "sha").cast("decimal(20,0)").cast("decimal(38,0)")), F.lit(0).cast("decimal(38,0)")).cast("string") for k in (1, 2)]
    return hashed.agg(F.count(F.lit(1)).alias("rows"), F.sha2(F.concat_ws(":", F.count(F.lit(1)).cast("string"), *words), 256).alias("digest"))


def export(df: DataFrame, path: str) -> dict:
    """Write ``df`` under ``path`` and give its manifest entry: schema, rows, and the digest of what was written."""
    unsupported(df.schema)
    encoded(df).select(F.col("row").alias("value")).write.mode("errorifexists").option("compression", "gzip").text(path)
    found = digest(read(df.sparkSession, path, df.schema)).first()
    return {"schema": df.schema.json(), "rows": found.rows, "digest": found.digest}


def unsupported(schema: T.StructType, most_columns: int = 255) -> None:
    """Raise ValueError for a table that can't be restored: too many columns, clashing names, or types without a text form."""
    names = [f.name.lower() for f in schema]
    clashing = sorted({n for n in names if names.count(n) > 1})
    if clashing or len(names) > most_columns:
        raise ValueError(f"columns named alike: {', '.join(clashing)}" if clashing else f"more than {most_columns} columns")
    plain = (T.NumericType, T.StringType, T.BinaryType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType, T.ArrayType, T.MapType, T.StructType)
    odd = [f.name for f in schema if not isinstance(f.dataType, plain)]
    if odd:
        raise ValueError(f"no text form for the type of {', '.join(odd)}")


def read(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The rows under ``path`` in the types of ``schema``."""
    cells = spark.read.text(path).select(F.from_json("value", "array<string>").alias("cells"))
    return cells.select(*[_value(F.unbase64(F.get("cells", F.lit(i))), f.dataType).alias(f.name) for i, f in enumerate(schema)])


def _value(raw: Column, kind: T.DataType) -> Column:
    if isinstance(kind, T.BinaryType):
        return raw
    text = F.decode(raw, "UTF-8")
    return F.from_json(text, kind.json()) if isinstance(kind, (T.ArrayType, T.MapType, T.StructType)) else text.cast(kind)


def restore(spark: SparkSession, path: str, entry: dict, target: str) -> DataFrame:
    """Write an exported table to ``target``, which must not exist, and check it against its entry."""
    import json

    schema = T.StructType.fromJson(json.loads(entry["schema"]))
    unsupported(schema)
    read(spark, path, schema).write.mode("errorifexists").parquet(target)
    out = spark.read.parquet(target)
    if not verify(out, entry):
        raise ValueError(f"{target} differs from what was exported")
    return out


def verify(df: DataFrame, entry: dict) -> bool:
    found = digest(df).first()
    return (found.rows, found.digest) == (entry["rows"], entry["digest"])


def preflight(df: DataFrame, most_cell: int = 1 << 20, most_row: int = 1 << 21) -> DataFrame:
    """A row a column: NULLs, cells with a NUL, the longest cell, cells over ``most_cell``; for '*', rows over ``most_row``."""
    sizes = {f.name: F.octet_length(F.col(f.name) if isinstance(f.dataType, T.BinaryType) else F.col(f.name).cast("string")) for f in df.schema if not isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType))}
    count = lambda c: F.coalesce(F.sum(F.when(c, 1).otherwise(0)), F.lit(0)).cast("bigint")
    none = F.lit(0).cast("bigint")
    row = sum((F.coalesce(s, F.lit(0)) for s in sizes.values()), F.lit(0))
    stats = [
        F.struct(F.lit(n).alias("column"), count(F.col(n).isNull()).alias("nulls"), (count(F.col(n).contains("\0")) if isinstance(df.schema[n].dataType, T.StringType) else none).alias("nuls"), F.coalesce(F.max(s), F.lit(0)).cast("bigint").alias("longest"), count(s > most_cell).alias("over"))
        for n, s in sizes.items()
    ]
    stats.append(F.struct(F.lit("*").alias("column"), none.alias("nulls"), none.alias("nuls"), F.coalesce(F.max(row), F.lit(0)).cast("bigint").alias("longest"), count(row > most_row).alias("over")))
    return df.agg(F.array(*stats).alias("stats")).select(F.inline("stats"))


def rewrite(df: DataFrame, target: str) -> DataFrame:
    """Write ``df`` as a table's next version at ``target`` and give it back only if it holds the same rows."""
    df.write.mode("errorifexists").parquet(target)
    out = df.sparkSession.read.parquet(target)
    if not digest(df).union(digest(out)).distinct().count() == 1:
        raise ValueError(f"{target} differs from what was written")
    return out
