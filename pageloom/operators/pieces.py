"""Documents in pieces: what a row needs of its document beyond its own piece, without a task that holds a document.

A document is (doc_id, text), or (doc_id, piece, text): pieces of whole lines in order, with a line feed between them, all
but the first of which begin with a blank line, so that a block lies in one piece.  Windows over a document see one row
of flags or counts per piece; windows over rows stay within a piece.  Rows without ``piece`` take one window per document.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pageloom.session import settled

PLACE = ["doc_id", "piece"]


def in_pieces(docs: DataFrame) -> DataFrame:
    """One text is one piece."""
    return docs if "piece" in docs.columns else docs.withColumn("piece", F.lit(0))


def _pieces() -> Window:
    return Window.partitionBy("doc_id").orderBy("piece")


def _within(rows: DataFrame) -> Window:
    return Window.partitionBy(*[c for c in PLACE if c in rows.columns]).orderBy("block_no")


def kept(rows: DataFrame) -> DataFrame:
    """Rows that the next operator reads more than once, as it does where documents are in pieces."""
    return settled(rows) if "piece" in rows.columns else rows


def offsets(counts: DataFrame, n: str) -> DataFrame:
    """(doc_id, piece, _offset): the sum of ``n`` over a document's earlier pieces."""
    before = _pieces().rowsBetween(Window.unboundedPreceding, -1)
    return counts.select(*PLACE, F.coalesce(F.sum(n).over(before), F.lit(0)).alias("_offset"))


def beside(rows: DataFrame, before: Column | None = None, after: Column | None = None) -> DataFrame:
    """Adds ``_before`` of the row before and ``_after`` of the one behind, structs of flags; null where there is none."""
    w = _within(rows)
    asked = {k: (shift, flags) for k, shift, flags in (("_before", F.lag, before), ("_after", F.lead, after)) if flags is not None}
    near = rows.select("*", *[shift(flags).over(w).alias(k) for k, (shift, flags) in asked.items()])
    if "piece" not in rows.columns:
        return near
    ends = rows.groupBy(*PLACE).agg(*[(F.max_by if k == "_before" else F.min_by)(flags, "block_no").alias(k) for k, (_, flags) in asked.items()])
    ends = ends.select(*PLACE, *[shift(k).over(_pieces()).alias(f"{k}_piece") for k, (shift, _) in asked.items()])
    joined = near.join(ends, PLACE)
    return joined.select(*rows.columns, *[F.coalesce(k, f"{k}_piece").alias(k) for k in asked])


def latest(rows: DataFrame, value: Column, name: str) -> DataFrame:
    """Adds the last ``value`` up to a row that is not null, of values that grow along the document."""
    near = rows.withColumn(name, F.last(value, True).over(_within(rows).rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    if "piece" not in rows.columns:
        return near
    before = _pieces().rowsBetween(Window.unboundedPreceding, -1)
    found = rows.groupBy(*PLACE).agg(F.max(value).alias("_m")).select(*PLACE, F.max("_m").over(before).alias("_m"))
    return near.join(found, PLACE).withColumn(name, F.coalesce(name, "_m")).drop("_m")


def numbered(rows: DataFrame, *order: str) -> DataFrame:
    """``block_no`` from 1 along the document by ``order``."""
    w = Window.partitionBy(*[c for c in PLACE if c in rows.columns]).orderBy(*order)
    local = rows.withColumn("block_no", F.row_number().over(w).cast("long"))
    if "piece" not in rows.columns:
        return local
    counts = offsets(rows.groupBy(*PLACE).agg(F.count(F.lit(1)).alias("_n")), "_n")
    return local.join(counts, PLACE).withColumn("block_no", F.col("block_no") + F.col("_offset")).drop("_offset")
