"""Incremental progress: a file stream over a folder of stage outputs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pageloom.operators import work


def stream_outputs(spark: SparkSession, folder: str) -> DataFrame:
    """New JSON outputs (without templates) as they appear: (stem, payload)."""
    rows = spark.readStream.format("text").option("wholetext", True).option("pathGlobFilter", "*.json").load(folder)
    name = F.element_at(F.split(F.input_file_name(), "/"), -1)
    return rows.select(F.regexp_replace(name, r"\.json$", "").alias("stem"), F.col("value").alias("payload")).where(~F.col("stem").endswith(".template"))


def watch(outputs: DataFrame, prompts: DataFrame, job: str, item: str, sink: str, checkpoint: str):
    """Appends each batch's outputs to ``sink``, idempotent by batch, and returns the query."""

    def save(batch: DataFrame, epoch: int) -> None:
        known = batch.join(prompts.select(item), batch["stem"] == prompts[item], "left_semi")
        known.write.mode("overwrite").parquet(f"{sink}/batch={epoch}")

    return outputs.writeStream.foreachBatch(save).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def progress(spark: SparkSession, prompts: DataFrame, sink: str, job: str, item: str) -> DataFrame:
    """Stage progress from what ``watch`` has saved."""
    done = prompts.join(spark.read.parquet(sink).select(F.col("stem").alias(item)).distinct(), item, "left_semi")
    return work.progress(prompts, done, job, item)
