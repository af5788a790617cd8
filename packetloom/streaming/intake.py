"""Submitted records as a stream: parsed on arrival, deduplicated, counted by time of receipt."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from packetloom.operators import structural_csv as sc


def submitted_stream(spark: SparkSession, folder: str, schema, files_per_trigger: int = 16) -> DataFrame:
    """Raw record rows of parquet files as they arrive in ``folder``."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(folder)


def reject_rates(stream: DataFrame, watermark: str = "1 day", width: str = "1 hour") -> DataFrame:
    """Per window of receipt and reason the number of rejected records; late records within the watermark count."""
    judged = sc.judge_submissions(stream.select("line_id", "raw_line", F.col("received_at").cast("timestamp").alias("received_at")))
    reasons = judged.select("received_at", F.explode("reasons").alias("reason"))
    return reasons.withWatermark("received_at", watermark).groupBy(F.window("received_at", width), "reason").agg(F.count(F.lit(1)).alias("n_records"))


def load_stream(stream: DataFrame, checkpoint: str, valid_sink: Callable[[DataFrame, int], None], reject_sink: Callable[[DataFrame, int], None]) -> StreamingQuery:
    """Runs the batch loader on every micro-batch; a replayed batch has the same number, so sinks can be idempotent."""

    def load(batch: DataFrame, number: int) -> None:
        valid, rejected = sc.load_submissions(batch)
        valid_sink(valid, number)
        reject_sink(rejected, number)

    return stream.writeStream.foreachBatch(load).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
