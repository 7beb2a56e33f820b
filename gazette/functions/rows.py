"""Whole-row projections."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def computed_once(df: DataFrame, columns: list[Column], *keep: str, where=None) -> DataFrame:
    """``df.select(*keep, *columns)`` whose columns are worked out once per row.

    Spark moves a filter below a projection by writing the projected expressions
    out again inside the filter, so a parsed record would be parsed once more
    for every field the filter looks at. A generator is not rewritten that way.
    ``where`` gets the columns as one struct and says which rows to keep.
    """
    row = F.array(F.struct(*columns))
    return df.select(*keep, F.inline(row if where is None else F.filter(row, where)))
