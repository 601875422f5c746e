"""Values worked out once per row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def once(df: DataFrame, **columns: Column) -> DataFrame:
    """``df`` with ``columns`` added or replaced, each worked out once per row.

    Spark puts the expression of a plain column in the place of every later filter that names it, so a text that is parsed
    and rebuilt in steps is parsed again for each of them. Values that come out of a list of one struct are only read.
    """
    rest = [c for c in df.columns if c not in columns]
    return df.select(*rest, F.inline(F.array(F.struct(*[c.alias(name) for name, c in columns.items()]))))
