"""Refresh the O2C job when new exports land (Structured Streaming trigger).

The reference has no streaming operator: its refresh is a full re-run of the
batch job.  This module keeps exactly that semantics, driven by Spark's file
source: a stream over the landing folder of one export notices new files and,
per micro-batch, ``foreachBatch`` re-runs the job over everything landed.
Progress is checkpointed under the session's shared ``spark.checkpoint.dir``
so a restarted driver does not re-trigger for files it already handled.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from opsanalytics.plans.o2c_job import run_job
from opsanalytics.session import checkpoint_dir
from opsanalytics.sources import files as io


def refresh_on_landing(
    spark: SparkSession,
    landing_dir: str,
    out_dir: str,
    columns: Mapping[str, Sequence[str]],
    watch: str = "loading_events",
    checkpoint_location: str | None = None,
    available_now: bool = True,
    **job_kwargs,
) -> StreamingQuery:
    """Start the refresh stream; returns the running query.

    ``columns`` gives each export's CSV header.  With ``available_now`` the
    stream processes what has landed and stops (a scheduled refresh);
    otherwise it keeps watching.
    """
    base = landing_dir.rstrip("/")
    ckpt = checkpoint_location or f"{checkpoint_dir(spark)}/o2c-refresh"
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns[watch]])
    landed = spark.readStream.schema(schema).option("header", True).csv(f"{base}/{watch}")

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        if batch.isEmpty():
            return
        raw = io.read_bundle(spark, {t: f"{base}/{t}" for t in columns}, columns)
        run_job(spark, raw, out_dir, **job_kwargs)

    writer = landed.writeStream.foreachBatch(on_batch).option("checkpointLocation", ckpt)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()
