"""Request metrics as a Structured Stream.

The same batch operators (``request_log``, ``resample``) run on a file
stream.  Event time is the request start as a ``TIMESTAMP`` instant; the
watermark (default 10 minutes) bounds state, and rows later than it are
dropped.  Two sinks:

* ``append`` mode to a Parquet folder - each window is written once, when
  the watermark passes its end (the production form; windows still open at
  the end of input are withheld);
* ``update`` mode through ``foreachBatch`` - every trigger writes the windows it
  changed to a folder of its own (a retried trigger replaces that folder), and
  ``latest_windows`` reads the newest version of each, open ones included.

Either way the state holds only the windows that the watermark keeps open.
"""

from __future__ import annotations

import posixpath
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tonality.operators.metrics import request_log, resample
from tonality.session import shared_dir


def file_stream(spark: SparkSession, path: str, schema, max_files_per_trigger: int | None = None) -> DataFrame:
    """A Parquet file stream.  ``path`` is a folder or a glob (a single file is
    addressed as a one-file glob, since a stream's base path must be a folder)."""
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.parquet(path)


def single_file_glob(path: str) -> str:
    return path[:-1] + "[" + path[-1] + "]"


def metrics_stream(events: DataFrame, interval: str = "10 seconds", watermark: str = "10 minutes",
                   by=("handler",)) -> DataFrame:
    """The streaming resample: ``(window_start_s, *by, requests, gauges...)``."""
    log = request_log(events).withWatermark("event_time", watermark)
    return resample(log, interval, by=by)


def start_metrics_stream(spark: SparkSession, source: str, out_dir: str | None = None,
                         interval: str = "10 seconds", watermark: str = "10 minutes",
                         mode: str = "append", by=("handler",), schema=None) -> tuple[StreamingQuery, str]:
    """Starts the stream; returns ``(query, output folder)``.

    ``schema`` is that of the files; without it, it is read from the folder
    ``source`` (a glob needs it given).
    """
    events = file_stream(spark, source, schema or spark.read.parquet(source).schema)
    agg = metrics_stream(events, interval, watermark, by)
    root = out_dir or shared_dir(spark, "streams", "metrics", uuid.uuid4().hex)
    out, ckpt = posixpath.join(root, "out"), posixpath.join(root, "checkpoint")
    if mode == "append":
        q = (agg.writeStream.outputMode("append").format("parquet")
             .option("path", out).option("checkpointLocation", ckpt).start())
    elif mode == "update":
        def write_changes(batch: DataFrame, epoch: int) -> None:
            batch.write.mode("overwrite").parquet(posixpath.join(out, f"batch={epoch}"))
        q = (agg.writeStream.outputMode("update").foreachBatch(write_changes)
             .option("checkpointLocation", ckpt).start())
    else:
        raise ValueError("mode must be 'append' or 'update'")
    return q, out


def latest_windows(spark: SparkSession, out: str, by=("handler",)) -> DataFrame:
    """The newest version of every window that an ``update`` stream wrote below ``out``."""
    changes = spark.read.parquet(out)
    keys = ["window_start_s", *by]
    values = [c for c in changes.columns if c not in (*keys, "batch")]
    newest = changes.groupBy(*keys).agg(F.max_by(F.struct(*values), "batch").alias("_v"))
    return newest.select(*keys, *[F.col("_v")[c].alias(c) for c in values])
