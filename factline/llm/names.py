"""Column names of operators beside those of the tables they are given."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def quoted(name: str) -> Column:
    """A column by its whole name, dots included."""
    return F.col("`" + name.replace("`", "``") + "`")


def without(docs: DataFrame, names: Iterable[str]) -> DataFrame:
    """The table without columns of these names, in any case."""
    lowered = {name.lower() for name in names}
    return docs.select(*[quoted(c) for c in docs.columns if c.lower() not in lowered])


def unused(columns: Iterable[str], name: str) -> str:
    """The name, lengthened until no column has it in any case."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


def set_aside(docs: DataFrame, *used: str) -> tuple[DataFrame, list[Column]]:
    """The table with all columns but the used ones in one struct `row`, and what selects the table's columns from it again.

    An operator that works on the result can name its own columns freely.
    """
    others, name = [c for c in docs.columns if c not in used], unused(used, "row")
    row = [F.struct(*map(quoted, others)).alias(name)] if others else []
    return docs.select(*map(quoted, used), *row), [quoted(c) if c in used else F.col(name).getField(c).alias(c) for c in docs.columns]
