"""Row changes. Each function takes the table as it is and gives the table as it will be.

Nothing is changed in place: the caller writes the result as the table's next version. Joins are on
key columns, so table and change are shuffled once each; a small change is broadcast by Spark. Rows
that come in an order are numbered in it once and written, so that no retry numbers them anew.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.scratch import cut
from .relational import duplicates

_N = "__mizzen_n"


def with_defaults(rows: DataFrame, like: DataFrame, defaults: dict[str, object] | None = None) -> DataFrame:
    """``rows`` in the columns and types of ``like``; what is missing has its default or NULL."""
    given = {c.lower(): c for c in rows.columns}
    extra = set(given) - {c.lower() for c in like.columns}
    if extra:
        raise ValueError(f"no column {', '.join(sorted(extra))}")
    cols = [rows[given[f.name.lower()]] if f.name.lower() in given else F.lit((defaults or {}).get(f.name)) for f in like.schema]
    return rows.select(*[c.cast(f.dataType).alias(f.name) for c, f in zip(cols, like.schema)])


def _numbered(rows: DataFrame, order: list[str]) -> DataFrame:
    """``rows`` with a number that rises in ``order``, in the order of all columns where that ties."""
    rest = [c for c in rows.columns if c not in order]
    return cut(rows.orderBy(*order, *rest).withColumn(_N, F.monotonically_increasing_id()))


def with_identity(rows: DataFrame, column: str, order: list[str], last: int) -> DataFrame:
    """Number the rows whose identity is NULL or 0 from ``last`` on, in ``order``.

    The sorted rows are written in parts; the parts' sizes are summed up, so no task sorts all rows.
    """
    asks = F.coalesce(F.col(column), F.lit(0)) == 0
    part, place = F.shiftrightunsigned(F.col(_N), 33), F.col(_N).bitwiseAND(F.lit((1 << 33) - 1))
    new = _numbered(rows.where(asks).drop(column), order).withColumn("__part", part)
    # As many rows as the sort had parts.
    sizes = new.groupBy("__part").agg(F.count(F.lit(1)).alias("__size"))
    before = sizes.withColumn("__before", F.sum("__size").over(Window.orderBy("__part")) - F.col("__size")).drop("__size")
    numbered = new.join(F.broadcast(before), "__part").withColumn(column, (place + 1 + F.col("__before") + last).cast(rows.schema[column].dataType))
    return rows.where(~asks).unionByName(numbered.select(*rows.columns))


def highest_identity(table: DataFrame, column: str) -> int:
    """Where identities go on from."""
    return table.agg(F.max(column)).first()[0] or 0


def insert(table: DataFrame, rows: DataFrame, defaults: dict[str, object] | None = None) -> DataFrame:
    return table.unionByName(with_defaults(rows, table, defaults))


def _free_of(rows: DataFrame, taken: DataFrame, keys: list[list[str]]) -> DataFrame:
    """``rows`` that share no key with a row of ``taken``; NULL in a key is shared with none."""
    for key in keys:
        rows = rows.join(taken.select(*key).dropna().distinct(), key, "left_anti").select(*rows.columns)
    return rows


def insert_ignore(table: DataFrame, rows: DataFrame, keys: list[list[str]], order: list[str], defaults: dict[str, object] | None = None) -> DataFrame:
    """Insert ``rows`` in ``order``, leaving out those that share a unique key with the table or a row inserted before.

    Rounds: rows that are the first of all their keys go in, rows that share a key with them go out. One
    round settles a single key; more follow only where a row waits for one that goes out itself.
    """
    left = _numbered(_free_of(with_defaults(rows, table, defaults), table, keys), order)
    out = table
    while not left.isEmpty():
        leads = left
        for i, key in enumerate(keys):
            firsts = left.dropna(subset=key).groupBy(*key).agg(F.min(_N).alias(f"__first{i}"))
            leads = leads.join(firsts, key, "left").where(F.col(f"__first{i}").isNull() | (F.col(f"__first{i}") == F.col(_N))).select(*left.columns)
        leads = cut(leads)
        out = out.unionByName(leads.drop(_N))
        left = cut(_free_of(left.join(leads.select(_N), _N, "left_anti").select(*left.columns), leads, keys))
    return out


def upsert(table: DataFrame, rows: DataFrame, key: list[str], updates: dict[str, Column], order: list[str] | None = None) -> DataFrame:
    """INSERT ... ON DUPLICATE KEY UPDATE on one unique key.

    ``updates`` gives new values from ``F.col("old.x")``, the row as it is, and ``F.col("new.x")``, the
    one that was to be inserted. Where ``rows`` has a key several times they need an ``order``, and
    the later ones change what the earlier ones left: a round for each repeat, on the repeated keys only.
    """
    new = with_defaults(rows, table)
    again = duplicates(new, key)
    if again.isEmpty():
        return _upserted(table, new, key, updates)
    if not order:
        raise ValueError("a key is given twice; upsert needs an order")
    numbered = _numbered(new, order)
    numbered = cut(numbered.withColumn("__turn", F.row_number().over(Window.partitionBy(*key).orderBy(_N))))
    out = _upserted(table, numbered.where("__turn = 1").select(*table.columns), key, updates)
    many = cut(again.select(*key))
    changed = cut(out.join(many, key, "left_semi").select(*table.columns))
    for turn in range(2, numbered.agg(F.max("__turn")).first()[0] + 1):
        changed = cut(_upserted(changed, numbered.where(F.col("__turn") == turn).select(*table.columns), key, updates))
    return out.join(many, key, "left_anti").select(*table.columns).unionByName(changed)


def _upserted(table: DataFrame, new: DataFrame, key: list[str], updates: dict[str, Column]) -> DataFrame:
    fresh = new.join(table.select(*key), key, "left_anti").select(*table.columns)
    match = reduce(and_, [F.col(f"old.{k}") == F.col(f"new.{k}") for k in key])
    met = F.col(f"new.{key[0]}").isNotNull()
    values = [F.when(met, updates[c]).otherwise(F.col(f"old.{c}")).cast(table.schema[c].dataType) if c in updates else F.col(f"old.{c}") for c in table.columns]
    kept = table.alias("old").join(new.alias("new"), match, "left").select(*[v.alias(c) for v, c in zip(values, table.columns)])
    return kept.unionByName(fresh)


def replace(table: DataFrame, rows: DataFrame, keys: list[list[str]], order: list[str] | None = None) -> DataFrame:
    """REPLACE: rows that share any unique key with a new row go, then the new ones come.

    Where new rows share keys they need an ``order``; a row stays if no later one shares a key with it.
    """
    new = with_defaults(rows, table)
    out = _free_of(table, new, keys)
    if all(duplicates(new, key).isEmpty() for key in keys):
        return out.unionByName(new)
    if not order:
        raise ValueError("a key is given twice; replace needs an order")
    left = numbered = _numbered(new, order)
    for i, key in enumerate(keys):
        lasts = numbered.dropna(subset=key).groupBy(*key).agg(F.max(_N).alias(f"__last{i}"))
        left = left.join(lasts, key, "left").where(F.col(f"__last{i}").isNull() | (F.col(f"__last{i}") == F.col(_N))).select(*numbered.columns)
    return out.unionByName(left.drop(_N))


def _chosen(table: DataFrame, where: Column | None, key: list[str], order: list[Column], limit: int | None) -> DataFrame:
    """Keys of the rows that a limited change is about."""
    rows = table.where(where) if where is not None else table
    return rows.orderBy(*order, *key).limit(limit).select(*key)


def update(table: DataFrame, values: dict[str, Column], where: Column | None = None, key: list[str] | None = None, order: list[Column] = (), limit: int | None = None) -> DataFrame:
    """UPDATE: new values, all computed from the row as it was; with a limit the table needs a key."""
    if limit is None:
        hit = F.coalesce(where, F.lit(False)) if where is not None else F.lit(True)
        rows = table
    else:
        if not key:
            raise ValueError("a limited update needs a key")
        marks = _chosen(table, where, key, list(order), limit).withColumn(_N, F.lit(True))
        rows, hit = table.join(marks, key, "left"), F.coalesce(F.col(_N), F.lit(False))
    return rows.select(*[(F.when(hit, values[f.name].cast(f.dataType)).otherwise(F.col(f.name)) if f.name in values else F.col(f.name)).alias(f.name) for f in table.schema])


def delete(table: DataFrame, where: Column | None = None, key: list[str] | None = None, order: list[Column] = (), limit: int | None = None) -> DataFrame:
    """DELETE: rows for which ``where`` is unknown stay; with a limit the table needs a key."""
    if limit is None:
        return table.limit(0) if where is None else table.where(~F.coalesce(where, F.lit(False)))
    if not key:
        raise ValueError("a limited delete needs a key")
    return table.join(_chosen(table, where, key, list(order), limit), key, "left_anti").select(*table.columns)


def delete_joined(table: DataFrame, on: Column, key: str, targets: tuple[str, ...] = ("a",)) -> DataFrame:
    """DELETE a[, b] FROM table a JOIN table b ON ...: rows that took part in the join as a target."""
    pairs = table.alias("a").join(table.alias("b"), on)
    gone = pairs.select(F.col(f"{targets[0]}.{key}").alias(key))
    for t in targets[1:]:
        gone = gone.union(pairs.select(F.col(f"{t}.{key}").alias(key)))
    return table.join(gone.distinct(), key, "left_anti").select(*table.columns)


def delete_older_of_group(table: DataFrame, group: str, key: str) -> DataFrame:
    """Keep the greatest ``key`` of each ``group``, the usual self-join delete, without the pairs of a group.

    Rows without a group stay, as they join with none.
    """
    last = table.groupBy(group).agg(F.max(key).alias("__last"))
    older = table.join(last, group).where(F.col(key) < F.col("__last")).select(key)
    return table.join(older, key, "left_anti").select(*table.columns)
