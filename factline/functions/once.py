"""Columns that are computed once per row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def once(df: DataFrame, **columns: Column) -> DataFrame:
    """Add columns whose expressions are evaluated exactly once per row.

    Catalyst copies a projected expression into the filters and projections above it. For
    parsing and regular expressions that means the same work several times; a generator of
    one row keeps it in place, in the same stage and without a shuffle.
    """
    made = F.struct(*[column.alias(name) for name, column in columns.items()])
    return df.select("*", F.inline(F.array(made)))
