"""Request scoring on a stream (M7 on Structured Streaming).

The scoring job is stateless per row, so the batch operator runs unchanged
on a streaming DataFrame: ``readStream`` over a directory of request files,
``score_requests``, and a Parquet sink with its own checkpoint location
(exactly-once file sink). ``availableNow`` processes what is there and stops.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seqrisk.config import DEFAULT_THRESHOLD
from seqrisk.operators.ledger import stored_threshold
from seqrisk.session import cut_lineage
from seqrisk.operators.scoring import score_bodies, score_requests


def request_stream(spark: SparkSession, source_dir: str, schema: T.StructType,
                   fmt: str = "parquet", max_files: int | None = None) -> DataFrame:
    r = spark.readStream.schema(schema).format(fmt)
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    return r.load(source_dir)


def score_stream(spark: SparkSession, source_dir: str, schema: T.StructType,
                 scorer: Callable[[DataFrame], Column] | object, out_dir: str, checkpoint_dir: str,
                 threshold=DEFAULT_THRESHOLD, keep: list[str] | None = None, available_now: bool = True):
    """Start the streaming scoring query; returns the StreamingQuery."""
    s = score_requests(request_stream(spark, source_dir, schema), scorer, threshold, keep=keep)
    w = (s.writeStream.format("parquet").option("path", out_dir)
         .option("checkpointLocation", checkpoint_dir).outputMode("append"))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="10 seconds")
    return w.start()


def score_body_stream(spark: SparkSession, source_dir: str, scorer: Callable[[DataFrame], Column] | object, out_dir: str, dead_dir: str,
                      checkpoint_dir: str, threshold=DEFAULT_THRESHOLD, available_now: bool = True, metrics_path: str | None = None):
    """M7 + P18 on raw bodies, one JSON text per line of the files in ``source_dir``: scored rows go to ``out_dir``,
    rejected ones with their body and error to ``dead_dir``. Each micro-batch writes its own partition of both and
    overwrites it when it is repeated, so a restart neither loses nor doubles a request. With ``metrics_path`` each
    micro-batch takes the threshold that the ledger there holds when it starts, so a running stream follows a new run."""
    lines = spark.readStream.schema("value string").text(source_dir).withColumnRenamed("value", "body").withColumn("raw", F.col("body"))
    scored = lines if metrics_path else score_bodies(lines, scorer, threshold, keep=["raw"])

    def write(batch: DataFrame, number: int) -> None:
        if metrics_path:
            batch = score_bodies(batch, scorer, stored_threshold(spark, metrics_path), keep=["raw"])
        rows = cut_lineage(batch)                       # both sinks read what was scored once
        for part, path in ((rows.where("error is null").drop("raw", "error", "message"), out_dir),
                           (rows.where("error is not null").select("raw", "error", "message"), dead_dir)):
            part.write.mode("overwrite").parquet(f"{path}/batch={number}")

    w = scored.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint_dir)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="10 seconds")
    return w.start()
