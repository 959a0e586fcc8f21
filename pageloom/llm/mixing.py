"""Mixing sources to target weights: capped water-filling, in DataFrame operations only.

Each source asks for a share of the total by its weight.  A source may be read at most ``max_epochs``
times, so its target stops at that multiple of its size and what it cannot take is dealt to the other
sources by weight until none is above its cap.  With sources in ascending order of cap / weight the
capped ones are a prefix, so one running sum finds the level.

Sampling: a source read r times takes every document floor(r) times; the fraction that is left is filled
in a seeded order (md5 of seed and doc_id), whole documents first and, for the one document at the edge,
only as many words as are missing.  What a source takes is thus its target rounded to a word.

No source is ever held in one task: the order is cut into ranges of the hash, as many as the rows ask for, per-range
sums are pre-aggregated, and only a range is sorted at a time.

Defined cases: null text has size 0 and takes 0; null source is a source of its own, last in order; rows
with the same doc_id are separate rows next to each other in the order; an empty table gives an empty
result; other columns are ignored, or travel untouched inside the struct ``row`` when ``carry`` is set.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pageloom.llm.common import ROWS_PER_BUCKET, word_count

#: Hex digits of the hash that name a range of a source's order, at least; more rows have more ranges.
LEAST_DIGITS = 3


def range_digits(rows: int) -> int:
    """Digits whose ranges hold about ROWS_PER_BUCKET rows each, were all rows one source's."""
    digits = LEAST_DIGITS
    while rows > ROWS_PER_BUCKET << 4 * digits:
        digits += 1
    return digits


def water_fill(sizes: DataFrame, weights: Sequence[float], max_epochs: int, share: float) -> DataFrame:
    """(source, source_size) -> the same with ``weight`` and ``target``.  One row per source: a small table."""
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    by_level = Window.orderBy("_ratio", "_no")
    before = by_level.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    ranked = (
        sizes.withColumn("_no", F.row_number().over(by_name))
        .withColumn("weight", F.element_at(cycle, ((F.col("_no") - 1) % len(weights) + 1).cast("int")))
        .withColumn("_cap", F.col("source_size") * max_epochs)
        .withColumn("_ratio", F.col("_cap") / F.col("weight"))
    )
    levels = (
        ranked.withColumn("_budget", F.sum("source_size").over(everything) * F.lit(float(share)))
        .withColumn("_capped", F.coalesce(F.sum("_cap").over(before), F.lit(0)))
        .withColumn("_open", F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0)))
        .withColumn("_level", (F.col("_budget") - F.col("_capped")) / F.col("_open"))
    )
    level = F.min(F.when(F.col("_level") <= F.col("_ratio"), F.struct("_ratio", "_no", "_level"))).over(everything)
    return levels.withColumn("_found", level["_level"]).select(
        "source",
        "source_size",
        "weight",
        F.when(F.col("_found").isNull() | (F.col("_found") * F.col("weight") > F.col("_cap")), F.col("_cap").cast("double"))
        .otherwise(F.col("_found") * F.col("weight"))
        .alias("target"),
    )


def mix_sources(
    docs: DataFrame, weights: Sequence[float] = (5, 2, 1), max_epochs: int = 3, share: float = 1.0, seed: int = 7, carry: bool = False
) -> DataFrame:
    """One row per input row: doc_id, source, size, source_size, target, taken (and ``row`` if ``carry``).

    ``weights`` go to the sources in code-point order and repeat; ``share`` is the part of all words that
    the mix has; ``taken`` counts repeats.
    """
    order = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).cast("binary"))
    sized = docs.select(
        "doc_id",
        "source",
        word_count("text").alias("size"),
        order.alias("_key"),
        *([F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")] if carry else []),
    ).withColumn("_bucket", F.substring("_key", 1, range_digits(docs.count())))

    ranges = sized.groupBy("source", "_bucket").agg(F.sum("size").alias("_in_range"))
    targets = water_fill(ranges.groupBy("source").agg(F.sum("_in_range").alias("source_size")), weights, max_epochs, share)
    running = Window.partitionBy("_s").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    plan = (
        ranges.withColumnsRenamed({"source": "_s", "_bucket": "_b"})
        .withColumn("_before", F.coalesce(F.sum("_in_range").over(running), F.lit(0)))
        .drop("_in_range")
        .join(targets.withColumnRenamed("source", "_t"), F.col("_s").eqNullSafe(F.col("_t")))
        .withColumn("_whole", F.when(F.col("source_size") > 0, F.floor(F.round("target") / F.col("source_size"))).otherwise(F.lit(0)).cast("long"))
        .withColumn("_rest", F.round("target").cast("long") - F.col("_whole") * F.col("source_size"))
        .drop("_t", "weight")
    )
    inside = (
        Window.partitionBy("source", "_bucket").orderBy("_key", "doc_id", "size").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return (
        sized.join(plan, F.col("source").eqNullSafe(F.col("_s")) & (F.col("_bucket") == F.col("_b")))
        .withColumn("_start", F.col("_before") + F.sum("size").over(inside) - F.col("size"))
        .withColumn("_part", F.greatest(F.lit(0), F.least(F.col("size"), F.col("_rest") - F.col("_start"))))
        .select(
            "doc_id", "source", "size", "source_size", "target",
            (F.col("_whole") * F.col("size") + F.col("_part")).cast("long").alias("taken"),
            *(["row"] if carry else []),
        )
    )
