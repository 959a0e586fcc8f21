"""Shared pieces of the training-data operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pageloom.session import bounded_batches, checkpoint_dir, cut_lineage, release_memory, releasing  # noqa: F401

#: A word: a run of anything but the six ASCII white-space bytes.
WORD = r"[^\x20\x09-\x0D]+"

#: Rows that a window or a grouped task should hold on average.
ROWS_PER_BUCKET = 4000


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    bounded_batches(spark)
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def buckets_for(rows: int, per_bucket: int = ROWS_PER_BUCKET) -> int:
    return max(1, -(-rows // per_bucket))


def text_or_empty(col: Column | str = "text") -> Column:
    return F.coalesce(F.col(col) if isinstance(col, str) else col, F.lit(""))


def word_count(col: Column | str = "text") -> Column:
    """Words of a text; a null text has none."""
    return F.coalesce(F.regexp_count(col, F.lit(WORD)), F.lit(0)).cast("long")
