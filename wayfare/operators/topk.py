from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def top(df: DataFrame, by: str, *, ties: Sequence[str], k: int = 1, ascending: bool = False) -> DataFrame:
    """The k first rows by one column; ``ties`` makes the order total.

    Spark keeps k rows per task and merges those: no full sort.  NULLs go last.
    """
    first: Column = F.col(by).asc_nulls_last() if ascending else F.col(by).desc_nulls_last()
    return df.orderBy(first, *[F.col(t).asc() for t in ties]).limit(k)


def sample_rows(df: DataFrame, rows: int = 5) -> DataFrame:
    """Any ``rows`` rows, for looking at a table."""
    return df.limit(rows)
