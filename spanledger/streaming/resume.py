"""Resumable processing as Structured Streaming: each batch keeps only keys that the output does not have yet."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException


def known(spark: SparkSession, path: str, keys: list[str]) -> DataFrame | None:
    try:
        return spark.read.parquet(path).select(*keys)
    except AnalysisException:
        return None


def resume_writer(path: str, keys: list[str], work: Callable[[DataFrame], DataFrame]) -> Callable[[DataFrame, int], None]:
    """A foreachBatch function: rows whose key is done are skipped, each key is worked on once per batch, results are appended."""

    def run(batch: DataFrame, epoch: int) -> None:
        done = known(batch.sparkSession, path, keys)
        todo = batch.dropDuplicates(keys)
        todo = todo.join(done, keys, "left_anti") if done is not None else todo
        work(todo).write.mode("append").parquet(path)

    return run


def run_resumable(stream: DataFrame, path: str, checkpoint: str, keys: list[str], work: Callable[[DataFrame], DataFrame]) -> None:
    """Works off what the stream has now; a second run goes on where the first one ended."""
    query = stream.writeStream.foreachBatch(resume_writer(path, keys, work)).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()


def sessions(events: DataFrame, gap: str = "30 minutes", late: str | None = None) -> DataFrame:
    """user_id, started, ended, n_events, total of runs of events with no pause of gap or more; late: a watermark, for streams."""
    events = events.withWatermark("ts", late) if late else events
    grouped = events.groupBy("user_id", F.session_window("ts", gap).alias("w")).agg(F.count(F.lit(1)).alias("n_events"), F.round(F.sum("value"), 3).alias("total"))
    return grouped.select("user_id", F.col("w.start").alias("started"), F.col("w.end").alias("ended"), "n_events", "total")


def tumbling(events: DataFrame, size: str = "1 hour", late: str | None = None) -> DataFrame:
    """event_type, started, n_events per window of fixed size."""
    events = events.withWatermark("ts", late) if late else events
    grouped = events.groupBy("event_type", F.window("ts", size).alias("w")).agg(F.count(F.lit(1)).alias("n_events"))
    return grouped.select("event_type", F.col("w.start").alias("started"), "n_events")
