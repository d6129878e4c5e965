"""Names of helper columns beside those of users' tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def free_names(rows: DataFrame, *wanted: str) -> list[str]:
    """``wanted`` with as many underscores before each as it takes to differ from all columns of ``rows``, in any case."""
    taken = {c.lower() for c in rows.columns}
    out = []
    for name in wanted:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out


def column(name: str) -> Column:
    """A column by its exact name, dots and backticks included."""
    return F.col("`" + name.replace("`", "``") + "`")
