"""Late and repeated requests (R7): nothing is lost silently, nothing counts twice.

* ``start_admission`` looks at every arriving row once and writes it to ``admitted`` or, if it is behind the
  watermark, to ``late`` with the watermark it missed.  The watermark of a micro-batch is the latest event time of all
  earlier ones less ``delay``, kept as one row per batch beside the rows, so a retried batch decides the same and
  replaces its own folders.
* ``distinct_metrics`` drops repeated deliveries by request id (``dropDuplicatesWithinWatermark``: the state of an id
  goes once the watermark has passed it by the delay) and aggregates the windows, in append mode.

A second delivery of an admitted row is either seen while its id is in the state, or it is late.
"""

from __future__ import annotations

import posixpath
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tonality.operators.metrics import epoch_micros, request_log, resample
from tonality.session import shared_dir

MARKS = "latest_us long, batch long"


def start_admission(spark: SparkSession, events: DataFrame, delay_us: int = 600_000_000,
                    root: str | None = None) -> tuple[StreamingQuery, str]:
    """Splits a stream of ``events`` below ``root``: ``admitted/batch=<id>`` and ``late/batch=<id>``; returns ``(query, root)``."""
    root = root or shared_dir(spark, "streams", "admission", uuid.uuid4().hex)
    place = lambda kind, batch: posixpath.join(root, kind, f"batch={batch}")
    spark.createDataFrame([], "latest_us long").write.mode("overwrite").parquet(place("marks", -1))
    at = epoch_micros("ts", isinstance(events.schema["ts"].dataType, T.TimestampType))

    def admit(batch: DataFrame, epoch: int) -> None:
        own = batch.sparkSession
        marks = own.read.schema(MARKS).parquet(posixpath.join(root, "marks")).where(F.col("batch") < epoch)
        latest = marks.agg(F.max("latest_us").alias("m")).first().m                # one number
        limit = F.lit(None).cast("long") if latest is None else F.lit(latest - delay_us).cast("long")
        rows = batch.withColumn("event_us", at).withColumn("watermark_us", limit)
        late = F.coalesce(F.col("event_us") < F.col("watermark_us"), F.lit(False))
        rows.where(late).drop("event_us").write.mode("overwrite").parquet(place("late", epoch))
        rows.where(~late).drop("event_us", "watermark_us").write.mode("overwrite").parquet(place("admitted", epoch))
        rows.agg(F.max("event_us").alias("latest_us")).write.mode("overwrite").parquet(place("marks", epoch))

    q = events.writeStream.foreachBatch(admit).option("checkpointLocation", posixpath.join(root, "checkpoint")).start()
    return q, root


def late_rows(spark: SparkSession, root: str) -> DataFrame:
    """The rows that came behind the watermark, with ``watermark_us`` and their ``batch``."""
    return spark.read.parquet(posixpath.join(root, "late"))


def admitted_stream(spark: SparkSession, root: str, schema) -> DataFrame:
    """The admitted rows as a stream, for ``distinct_metrics`` or any other job."""
    return spark.readStream.schema(schema).parquet(posixpath.join(root, "admitted", "batch=*"))


def distinct_metrics(events: DataFrame, interval: str = "10 seconds", delay: str = "10 minutes", by=("handler",)) -> DataFrame:
    """Windows of a stream in which a request may be delivered more than once; its ``event_id`` counts once."""
    log = request_log(events).withWatermark("event_time", delay).dropDuplicatesWithinWatermark(["event_id"])
    return resample(log, interval, by=by)


def start_distinct_metrics(spark: SparkSession, events: DataFrame, out_dir: str | None = None,
                           **options) -> tuple[StreamingQuery, str]:
    """Starts ``distinct_metrics`` into a Parquet folder (append mode); returns ``(query, folder)``."""
    place = out_dir or shared_dir(spark, "streams", "distinct", uuid.uuid4().hex)
    out = posixpath.join(place, "out")
    q = (distinct_metrics(events, **options).writeStream.outputMode("append").format("parquet").option("path", out)
         .option("checkpointLocation", posixpath.join(place, "checkpoint")).start())
    return q, out
