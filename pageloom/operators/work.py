"""Work operators: which items of a stage are missing, progress, and what to do next."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pageloom.functions import text as t

#: Stages in order, and what is done in each: its prompts are built, then answered.
STAGES = ("chunks", "chapters", "final", "verify", "assemble")


def missing(prompts: DataFrame, outputs: DataFrame, keys: list[str]) -> DataFrame:
    """Prompts without an output."""
    return prompts.join(outputs.select(*keys).distinct(), keys, "left_anti")


def unknown(outputs: DataFrame, prompts: DataFrame, keys: list[str]) -> DataFrame:
    """Outputs that answer no prompt."""
    return outputs.join(prompts.select(*keys).distinct(), keys, "left_anti")


def next_items(prompts: DataFrame, outputs: DataFrame, job: str, item: str) -> DataFrame:
    """The first missing item of every job."""
    return missing(prompts, outputs, [job, item]).groupBy(job).agg(F.min(item).alias(item))


def progress(prompts: DataFrame, outputs: DataFrame, job: str, item: str) -> DataFrame:
    """(job, total, completed) of a stage."""
    done = outputs.select(job, item).distinct().withColumn("_d", F.lit(True))
    return prompts.join(done, [job, item], "left").groupBy(job).agg(F.count(F.lit(1)).alias("total"), F.count_if(F.coalesce("_d", F.lit(False))).alias("completed"))


def next_action(status: DataFrame) -> DataFrame:
    """(job, stage, action_type) from one status row per job.

    Columns: next_chunk, next_chapter (null: none missing), chapters_prepared, final_prompt, final_output, verify_prompt,
    verify_output, assembled (booleans).
    """
    steps = (
        (F.col("next_chunk").isNotNull(), "chunks", "complete_prompt", F.col("next_chunk")),
        (~F.col("chapters_prepared"), "chapters", "run_command", F.lit("build-chapters")),
        (F.col("next_chapter").isNotNull(), "chapters", "complete_prompt", F.col("next_chapter")),
        (~F.col("final_prompt"), "final", "run_command", F.lit("build-final")),
        (~F.col("final_output"), "final", "complete_prompt", F.lit("final")),
        (~F.col("verify_prompt"), "verify", "run_command", F.lit("build-verify")),
        (~F.col("verify_output"), "verify", "complete_prompt", F.lit("verify")),
        (~F.col("assembled"), "assemble", "run_command", F.lit("assemble")),
    )
    chosen = F
    for holds, stage, kind, target in steps:
        chosen = chosen.when(holds, F.struct(F.lit(stage).alias("stage"), F.lit(kind).alias("action_type"), target.alias("target")))
    done = F.struct(F.lit("done").alias("stage"), F.lit("none").alias("action_type"), F.lit("").alias("target"))
    return status.withColumn("_a", chosen.otherwise(done)).select("job", "_a.*")


def require_complete(progress_rows: DataFrame) -> DataFrame:
    """The same rows; the query fails on a job that still misses outputs."""
    short = F.raise_error(F.concat(F.lit("expected "), F.col("total").cast("string"), F.lit(" outputs, found "), F.col("completed").cast("string")))
    return progress_rows.withColumn("completed", F.when(F.col("completed") < F.col("total"), short.cast("long")).otherwise(F.col("completed")))


def numbered_chapters(profiles: DataFrame) -> DataFrame:
    """Chapters in order of appearance with the names of their prompts."""
    no = F.row_number().over(Window.partitionBy("doc_id").orderBy("chapter_pos"))
    return profiles.withColumn("item_id", F.concat(F.format_string("c%03d-", no), t.slugify(F.col("chapter_title"), "chapter")))
