"""Row selection on an expensive computed column.

``df.where(cond)`` on a column computed by a projection is pushed below that projection with
the column's expression substituted into the condition, so the expression runs twice: once in
the filter and once in the projection. That is right for cheap expressions and wrong for a
per-document page scan. ``filter_computed`` selects the rows inside a generator instead
(``inline`` over a zero-or-one element array of the row), which leaves no Filter to push, so the
projection runs once. Use it only on computed columns; on stored columns a plain ``where`` is
better because it reaches the scan as a pushed filter.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def filter_computed(df: DataFrame, col: str, predicate: Callable[[Column], Column]) -> DataFrame:
    """Rows of ``df`` where ``predicate(df[col])`` is true (null counts as false)."""
    row = F.array(F.struct(*[F.col(c) for c in df.columns]))
    return df.select(F.inline(F.filter(row, lambda s: F.coalesce(predicate(s[col]), F.lit(False)))))
