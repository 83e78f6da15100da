"""Text functions and grouped concatenation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .coercion import as_text


def concat(df: DataFrame, *parts) -> Column:
    """CONCAT of values of any type; NULL if any is."""
    return F.concat(*[as_text(df, p) for p in parts])


def substring(text: Column, at: int, n: int | None = None) -> Column:
    """From the 1-based place ``at``, or that many from the end if negative; empty at 0."""
    if at == 0:
        return F.when(text.isNotNull(), F.lit(""))
    tail = F.substring(text, at, 2**31 - 1)
    whole = tail if at > 0 else F.when(F.char_length(text) >= -at, tail).otherwise(F.when(text.isNotNull(), F.lit("")))
    return whole if n is None else F.left(whole, F.lit(n))


def group_concat(value: Column, separator: str = ",", distinct: bool = False, descending: bool = False, by: Column | None = None) -> Column:
    """Aggregate: the group's texts in order of ``by`` and then of themselves, NULL left out, NULL for none.

    Distinct texts have no order but their own. One row of output holds the whole list, so a group
    should be of a size to print.
    """
    if distinct and by is not None:
        raise ValueError("distinct texts are ordered by themselves")
    text = value.cast("string")
    keyed = text if by is None else F.when(text.isNotNull(), F.struct(by.alias("by"), text.alias("text")))
    items = F.sort_array((F.collect_set if distinct else F.collect_list)(keyed), asc=not descending)
    return F.when(F.size(items) > 0, F.array_join(items if by is None else F.transform(items, lambda x: x["text"]), separator))
