"""Run log (S7), run search (S8) and experiment listing (S9) as Parquet tables.

Layout under a root folder (by default in the shared checkpoint location):

* ``experiments/`` - ``experiment_id, name, artifact_location, lifecycle_stage``
* ``runs/experiment=<name>/`` - one row per run: ``run_id, experiment_id,
  start_ts, params map<string,string>, accuracy, roc_auc, f1_score,
  model_path``

Both are append-only.  Reading runs of one experiment filters on the
partition column, so Spark lists and reads only that folder.  Experiment ids
are derived from the name, so logging the same name twice gives one id.
"""

from __future__ import annotations

import posixpath

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tonality.session import shared_dir

RUN_SCHEMA = T.StructType([
    T.StructField("run_id", T.StringType(), False),
    T.StructField("experiment_id", T.StringType(), False),
    T.StructField("start_ts", T.DoubleType(), True),
    T.StructField("params", T.MapType(T.StringType(), T.StringType()), True),
    T.StructField("accuracy", T.DoubleType(), True),
    T.StructField("roc_auc", T.DoubleType(), True),
    T.StructField("f1_score", T.DoubleType(), True),
    T.StructField("model_path", T.StringType(), True),
    T.StructField("experiment", T.StringType(), False),
])

EXPERIMENT_SCHEMA = T.StructType([
    T.StructField("experiment_id", T.StringType(), False),
    T.StructField("name", T.StringType(), False),
    T.StructField("artifact_location", T.StringType(), True),
    T.StructField("lifecycle_stage", T.StringType(), False),
])


def default_root(spark: SparkSession) -> str:
    return shared_dir(spark, "tracking")


def experiment_id(name) -> Column:
    """A stable numeric id from the name: the first 15 hex digits of its SHA-256."""
    name = F.col(name) if isinstance(name, str) else name
    return F.conv(F.substring(F.sha2(name, 256), 1, 15), 16, 10)


def _experiments_path(root: str) -> str:
    return posixpath.join(root, "experiments")


def search_experiments(spark: SparkSession, root: str | None = None) -> DataFrame:
    """``experiment_id, name, artifact_location, lifecycle_stage``."""
    root = root or default_root(spark)
    return _table(spark, _experiments_path(root), EXPERIMENT_SCHEMA).dropDuplicates(["experiment_id"])


def _table(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The table at ``path``, without rows if nothing was ever written there; other errors are raised."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def log_experiments(names: DataFrame, root: str) -> None:
    """Registers the distinct names of column ``experiment`` not known yet."""
    spark = names.sparkSession
    new = names.select(F.col("experiment").alias("name")).distinct()
    known = search_experiments(spark, root).select("name")
    rows = new.join(known, "name", "left_anti").select(
        experiment_id("name").alias("experiment_id"), "name",
        F.concat(F.lit(posixpath.join(root, "artifacts") + "/"), F.col("name")).alias("artifact_location"),
        F.lit("active").alias("lifecycle_stage"))
    rows.write.mode("append").parquet(_experiments_path(root))


def log_runs(runs: DataFrame, experiment: str | None = None, root: str | None = None) -> str:
    """Append runs ``(run_id, start_ts, params, accuracy, roc_auc, f1_score[, model_path])``.

    The experiment is ``experiment`` or, when that is None, each row's
    ``experiment`` column.  Runs whose id the experiment already has are left
    out, so a repeated call adds nothing.  A given experiment is registered by
    its name; else the names come from the rows.  Returns the root used.
    """
    spark = runs.sparkSession
    root = root or default_root(spark)
    if experiment is not None:
        runs = runs.withColumn("experiment", F.lit(experiment))
    cols = {f.name for f in runs.schema.fields}
    out = runs.select(
        F.col("run_id").cast("string"),
        experiment_id(F.col("experiment")).alias("experiment_id"),
        F.col("start_ts").cast("double"),
        (F.col("params") if "params" in cols else F.create_map().cast("map<string,string>")).alias("params"),
        *[(F.col(m).cast("double") if m in cols else F.lit(None).cast("double")).alias(m)
          for m in ("accuracy", "roc_auc", "f1_score")],
        (F.col("model_path") if "model_path" in cols else F.lit(None).cast("string")).alias("model_path"),
        F.col("experiment").cast("string"))
    known = search_runs(spark, experiment, root).select("run_id", "experiment")
    new = out.dropDuplicates(["run_id", "experiment"]).join(known, ["run_id", "experiment"], "left_anti").select(*out.columns)
    new.write.mode("append").partitionBy("experiment").parquet(posixpath.join(root, "runs"))
    log_experiments(spark.range(1).select(F.lit(experiment).alias("experiment")) if experiment is not None
                    else out.select("experiment"), root)
    return root


def search_runs(spark: SparkSession, experiment: str | None = None, root: str | None = None,
                experiment_id: str | None = None) -> DataFrame:
    """Runs of one experiment - by name or by id - or of all.

    Runs are partitioned by name; an id is looked up in the experiments table first (one name), so
    either way only that experiment's files are read.
    """
    root = root or default_root(spark)
    runs = _table(spark, posixpath.join(root, "runs"), RUN_SCHEMA)
    if experiment_id is not None:
        named = search_experiments(spark, root).where(F.col("experiment_id") == experiment_id).select("name").first()
        if named is None or experiment not in (None, named.name):
            return runs.where(F.lit(False))
        experiment = named.name
    return runs if experiment is None else runs.where(F.col("experiment") == experiment)
