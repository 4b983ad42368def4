"""Streams: the change log kept as a current state, and events counted in windows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.operators.changes import overlay


def maintain_state(log: DataFrame, folder: str, checkpoint: str):
    """Apply each batch of a change log stream to the state in the folder: state n is overlaid to state n + 1.

    A batch that runs again writes the same state again, so a restart neither loses nor doubles changes. Within a batch
    a key's last revision counts.
    """

    def apply(batch: DataFrame, n: int) -> None:
        spark = batch.sparkSession
        last = batch.where("operation <> 'ALIAS'").groupBy("entity_type", "entity_key").agg(F.max_by(F.struct(*batch.columns), "revision").alias("r")).select("r.*")
        before = spark.read.parquet(f"{folder}/batch={n - 1}") if n else None
        after = overlay(before, last) if n else overlay(spark.createDataFrame([], overlay_schema(last)), last)
        after.write.mode("overwrite").parquet(f"{folder}/batch={n}")

    return log.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def overlay_schema(changes: DataFrame):
    return changes.select(
        "entity_type", "entity_key", "row_hash", "content_hash", "state", "retired_revision", F.col("revision").alias("last_revision"), F.col("operation").alias("last_operation")
    ).schema


def window_counts(events: DataFrame, at: str, key: str, width: str, late: str) -> DataFrame:
    """Events a window and key; those later than ``late`` behind the newest are left out."""
    return events.withWatermark(at, late).groupBy(F.window(at, width).alias("w"), key).agg(F.count("*").alias("n")).select(F.col("w.start").alias("start"), key, "n")


def run_once(stream: DataFrame, folder: str, mode: str = "append") -> DataFrame:
    """Run a stream over what is there now, into Parquet files, and read them."""
    query = stream.writeStream.format("parquet").option("path", f"{folder}/out").option("checkpointLocation", f"{folder}/checkpoint").outputMode(mode).trigger(availableNow=True).start()
    query.awaitTermination()
    spark: SparkSession = stream.sparkSession
    return spark.read.schema(stream.schema).parquet(f"{folder}/out")
