"""Names that helper columns may have whatever a table's columns are called."""

from __future__ import annotations

from pyspark.sql import DataFrame


def positional(df: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """``df`` with columns ``c0, c1, …`` and their names by the old ones (in lower case)."""
    names = [f"c{i}" for i in range(len(df.columns))]
    return df.toDF(*names), {old.lower(): new for old, new in zip(df.columns, names)}


def free_name(wanted: str, columns: list[str]) -> str:
    """``wanted`` with as many underscores before it as keep it apart from ``columns`` in any case."""
    taken = {c.lower() for c in columns}
    while wanted.lower() in taken:
        wanted = f"_{wanted}"
    return wanted
