"""Durable stage hand-offs (S5, S6) and the model store.

Each stage is a Parquet table with a fixed schema, written in full and read
back by the next stage; a stage written by a job that lost executors is
simply recomputed, and reading it cuts the lineage of everything before.
"""

from __future__ import annotations

import posixpath
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tonality.session import shared_dir

RAW_SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType(), False),
    T.StructField("value", T.StringType(), True),
    T.StructField("label", T.IntegerType(), True),
])

FEATURE_SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType(), False),
    T.StructField("label", T.IntegerType(), True),
    T.StructField("features", T.ArrayType(T.IntegerType(), False), True),
])


def new_stage_root(spark: SparkSession, name: str = "stages") -> str:
    return shared_dir(spark, name, uuid.uuid4().hex)


def write_stage(df: DataFrame, path: str, schema: T.StructType | None = None) -> str:
    cols = [f.name for f in schema.fields] if schema else df.columns
    df.select(*cols).write.mode("overwrite").parquet(path)
    return path


def read_stage(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    reader = spark.read.schema(schema) if schema else spark.read
    return reader.parquet(path)


def write_raw(df: DataFrame, root: str) -> str:
    """``(doc_id, value, label)``."""
    return write_stage(df, posixpath.join(root, "raw"), RAW_SCHEMA)


def read_raw(spark: SparkSession, root: str) -> DataFrame:
    return read_stage(spark, posixpath.join(root, "raw"), RAW_SCHEMA)


def write_features(df: DataFrame, root: str) -> str:
    """``(doc_id, label, features array<int>)``."""
    return write_stage(df, posixpath.join(root, "features"), FEATURE_SCHEMA)


def read_features(spark: SparkSession, root: str) -> DataFrame:
    return read_stage(spark, posixpath.join(root, "features"), FEATURE_SCHEMA)


def save_model(model, path: str) -> str:
    """Save a fitted Spark ML model or pipeline model (overwrite)."""
    model.write().overwrite().save(path)
    return path


def load_model(path: str):
    """Load what :func:`save_model` wrote (any ``PipelineModel``)."""
    from pyspark.ml import PipelineModel
    return PipelineModel.load(path)
