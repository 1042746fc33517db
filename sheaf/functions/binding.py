"""Columns that are computed once, whatever is built on top of them."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def bound(df: DataFrame, columns: Mapping[str, Column], drop: tuple[str, ...] = ()) -> DataFrame:
    """Add ``columns`` through a generator of one row.

    A filter on a projected column is pushed below the projection together with a copy of the
    column's expression, and copies of copies add up fast where one parse feeds dozens of columns. A
    filter on a generated column stays above, so the expression has one place in the plan.
    """
    kept = [F.col(f"`{c}`") for c in df.columns if c not in columns and c not in drop]
    row = F.struct(*(column.alias(name) for name, column in columns.items()))
    return df.select(*kept, F.inline(F.array(row)))
