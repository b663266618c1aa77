"""Row-level helpers."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def select_where(df: DataFrame, cols: list[Column | str],
                 keep: Callable[[Column], Column]) -> DataFrame:
    """``df.select(*cols)`` restricted to the rows where ``keep(row)`` holds,
    with every projected column computed once per row.

    With a plain ``select(...).where(...)`` Catalyst pushes the predicate
    below the projection and inlines the aliased expressions into it, so an
    expensive projection (parsing a whole JSON value) runs twice per row:
    once in the filter and once in the projection. Here the projected row is
    built once as a struct, ``keep`` is applied to it inside a one-element
    array, and ``inline`` emits the surviving row. Nothing can be pushed below
    the generator, and the projection is not repeated.
    """
    return df.select(F.inline(F.filter(F.array(F.struct(*cols)), keep)))
