"""Best run (A6): greatest accuracy; ties go to the newest run, then the smallest id.

NaN and null accuracies never win (Spark orders NaN above every number, so
they are filtered first).  The pick is a ``min`` over a struct key - a plain
aggregate with map-side partials - so an experiment with very many runs is
never gathered into one task.  No valid run gives no row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def best_run(runs: DataFrame, by: Sequence[str] = ("experiment",), metric: str = "accuracy",
             time_col: str = "start_ts", id_col: str = "run_id") -> DataFrame:
    """``(*by, run_id, accuracy, start_ts)``: one row per group with a valid run."""
    m = F.col(metric).cast("double")
    valid = runs.where(m.isNotNull() & ~F.isnan(m))
    key = F.struct((-m).alias("m"), (-F.col(time_col).cast("double")).alias("t"),
                   F.col(id_col).alias("id"))
    best = valid.groupBy(*by).agg(F.min(key).alias("_k"))
    return best.select(*by, F.col("_k.id").alias(id_col), (-F.col("_k.m")).alias(metric),
                       (-F.col("_k.t")).alias(time_col))
