"""Packet operators: sections gathered into packets of bounded size, large sections split by paragraph.

Which sections may share a packet at all is a matter of neighbours: a chapter, documentary or supplemental
change, or an oversized section on either side, starts an island.  Inside an island only the running size
matters, and that greedy count is the one fold; it sees numbers, never text.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pageloom.functions import fixed, text as t
from pageloom.session import settled

SEPARATOR = "\n\n---\n\n"


def greedy_parts(rows: DataFrame, by: list[str], order: str, size: str, target: int, close_at: int | None = None) -> DataFrame:
    """by + [order, part]: greedy groups of rows in order.  An item that would overflow ``target`` opens the next group, and a
    group that has reached ``close_at`` takes no more.

    One pass over each partition's sorted numbers, which keeps three of them between rows, however many rows a
    document has; rows are dealt by all of ``by``, so that a document with many groups is in many partitions.
    """
    fields = {f.name: f.dataType.simpleString() for f in rows.schema.fields}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, part, held = None, 0, 0
        for batch in batches:
            parts = []
            sizes = batch.column(len(by) + 1).to_pylist()
            for key, n in zip(zip(*(batch.column(k).to_pylist() for k in range(len(by))), strict=True), sizes, strict=True):
                if key != last:
                    last, part, held = key, 0, 0
                elif held + n > target or (close_at is not None and held >= close_at):
                    part, held = part + 1, 0
                held += n
                parts.append(part)
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(parts, pa.int64())], [*by, order, "part"])

    sorted_rows = rows.select(*by, order, size).repartition(*by).sortWithinPartitions(*by, order)
    return sorted_rows.mapInArrow(run, ", ".join(f"`{c}` {fields[c]}" for c in [*by, order]) + ", part long")


def with_flags(sections: DataFrame, most: int) -> DataFrame:
    return (
        t.with_kind(sections.withColumn("label", F.array_join("path", " > ")), F.col("label"), "kind")
        .withColumn("is_doc", F.col("kind").isin(*fixed.DOCUMENTARY))
        .withColumn("is_supplemental", t.is_supplemental_title(F.col("label")))
        .withColumn("is_big", F.col("token_estimate") > most)
    )


def islands(flagged: DataFrame) -> DataFrame:
    """Adds ``island``: runs of sections between which nothing but size can start a packet."""
    w = Window.partitionBy("doc_id").orderBy("pos")
    same = F.struct("chapter_title", "is_doc", "is_supplemental")
    starts = F.lag("pos").over(w).isNull() | F.col("is_big") | F.lag("is_big").over(w) | (same != F.lag(same).over(w))
    return flagged.withColumn("_start", starts.cast("int")).withColumn(
        "island", F.sum("_start").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    ).drop("_start")


def large_section_parts(sections: DataFrame, target: int, most: int) -> DataFrame:
    """Paragraphs of sections above ``most``: doc_id, pos, n, paragraph, tokens, part."""
    paragraphs = F.filter(F.transform(F.split("raw_text", "\n{2,}"), t.strip), lambda p: p != "")
    rows = sections.where(F.col("token_estimate") > most).select("doc_id", "pos", F.posexplode(paragraphs).alias("n", "paragraph"))
    sized = rows.select("doc_id", "pos", "n", t.token_estimate(F.col("paragraph")).alias("tokens"))
    return greedy_parts(sized, ["doc_id", "pos"], "n", "tokens", target, most).join(rows, ["doc_id", "pos", "n"])


def packets(sections: DataFrame, target: int = 6500, most: int = 8500) -> DataFrame:
    """doc_id, packet_id, chapter_title, section_labels, raw_text, token_estimate, packet_no.

    Islands, sizes and packet numbers are worked out without texts, which are joined to them by section and by packet.
    """
    placed = settled(islands(with_flags(sections, most).select("doc_id", "pos", "chapter_title", "label", "is_doc", "is_supplemental", "is_big", "token_estimate")))
    small = greedy_parts(placed.where(~F.col("is_big")), ["doc_id", "island"], "pos", "token_estimate", target)
    paragraphs = large_section_parts(sections, target, most)
    first = small.groupBy("doc_id", "island", "part").agg(F.min("pos").alias("first"))
    starts = first.select("doc_id", "first", "part").unionByName(paragraphs.select("doc_id", F.col("pos").alias("first"), "part").distinct())
    numbers = starts.withColumn("packet_no", F.row_number().over(Window.partitionBy("doc_id").orderBy("first", "part")).cast("long"))

    told = small.join(placed.select("doc_id", "pos", "label", "chapter_title"), ["doc_id", "pos"]).join(sections.select("doc_id", "pos", "raw_text"), ["doc_id", "pos"])
    in_order = lambda column: F.transform(F.array_sort(F.collect_list(F.struct("pos", column))), lambda s: s[column])
    gathered = told.groupBy("doc_id", "island", "part").agg(
        F.min("pos").alias("first"), F.min_by("chapter_title", "pos").alias("chapter_title"), in_order("label").alias("section_labels"),
        F.array_join(in_order("raw_text"), SEPARATOR).alias("raw_text"),
    )
    parts = paragraphs.groupBy("doc_id", "pos", "part").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("n", "paragraph"))), lambda s: s["paragraph"]), "\n\n").alias("raw_text")
    )
    large = parts.join(sections.select("doc_id", "pos", "path", "chapter_title"), ["doc_id", "pos"]).select(
        "doc_id", F.col("pos").alias("first"), "part", "chapter_title",
        F.array(F.concat(F.array_join("path", " > "), F.lit(" (part "), F.col("part") + 1, F.lit(")"))).alias("section_labels"), "raw_text",
    )
    every = gathered.select("doc_id", "first", "part", "chapter_title", "section_labels", "raw_text").unionByName(large).join(numbers, ["doc_id", "first", "part"])
    return every.select(
        "doc_id", F.format_string("p%04d", "packet_no").alias("packet_id"), "chapter_title", "section_labels", "raw_text",
        t.token_estimate(F.col("raw_text")).alias("token_estimate"), "packet_no",
    )
