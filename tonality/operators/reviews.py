"""Review-table operators: class label (S2), union (U1), empty-text default."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def with_label(df: DataFrame, label: int, out: str = "label") -> DataFrame:
    """Attach a constant class label (folded by Catalyst)."""
    return df.withColumn(out, F.lit(int(label)))


def union_reviews(*dfs: DataFrame) -> DataFrame:
    """Bag union by column name; duplicates are kept and nothing shuffles."""
    return reduce(lambda a, b: a.unionByName(b), dfs)


def default_empty(df: DataFrame, col: str) -> DataFrame:
    """A missing review text becomes ``''``."""
    return df.withColumn(col, F.coalesce(F.col(col), F.lit("")))
