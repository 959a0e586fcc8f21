"""The normalizer as one plan: (doc_id, text) -> cleaned Markdown and a summary row per document."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pageloom.functions import fixed, spelling
from pageloom.operators import blocks as b, lines as ln, sections
from pageloom.operators.pieces import kept, offsets
from pageloom.sources.markdown import read_lines


def filtered_lines(docs: DataFrame) -> DataFrame:
    """Lines of all documents, characters repaired, boilerplate marked."""
    repaired = docs.withColumn("text", spelling.repair_characters(F.col("text"))).select(*[c for c in ("doc_id", "piece", "text") if c in docs.columns])
    return ln.mark_boilerplate(read_lines(repaired), repaired=True)


def segmented(docs: DataFrame, words: tuple[str, ...] = fixed.LEXICON, lines: DataFrame | None = None) -> DataFrame:
    kept_lines = ln.split_lists((filtered_lines(docs) if lines is None else lines).where(~F.col("removed")))
    return b.classify(b.raw_blocks(kept_lines, ("pos", "part")), words)


def rewritten(blocks: DataFrame, words: tuple[str, ...] = fixed.LEXICON) -> DataFrame:
    """The rewrites, in the order that they depend on each other."""
    found = kept(b.merge_paragraphs(kept(b.demote_contextual(kept(blocks))), words))
    found = kept(b.contents_to_list(kept(b.normalize_heading_levels(found, words))))
    return b.merge_paragraphs(kept(b.demote_for_rendering(kept(b.demote_backmatter(found)))), words)


def normalize(docs: DataFrame, words: tuple[str, ...] = fixed.LEXICON) -> DataFrame:
    """(doc_id, output) of every document."""
    output = b.render(rewritten(segmented(docs, words), words))
    ids = docs.select("doc_id").distinct() if "piece" in docs.columns else docs.select("doc_id")
    return ids.join(output, "doc_id", "left").select("doc_id", F.coalesce("output", F.lit("\n")).alias("output"))


def file_summary(docs: DataFrame, words: tuple[str, ...] = fixed.LEXICON) -> DataFrame:
    """One row per document: what the normalizer read, removed and made.  Documents in pieces are never put together."""
    marked = kept(filtered_lines(docs))
    lines = marked.groupBy("doc_id").agg(F.count(F.lit(1)).alias("input_lines"), F.count_if("removed").alias("removed_repeats"))
    made = kept(rewritten(segmented(docs, words, marked), words))
    counted = made.groupBy("doc_id").agg(F.count(F.lit(1)).alias("blocks"), F.count_if(F.col("kind") == "heading").alias("headings"))
    if "piece" in docs.columns:
        shown, skips = _pieces_shown(docs, kept(b.rendered_pieces(made)))
    else:
        output = docs.join(b.render(made), "doc_id", "left").withColumn("output", F.coalesce("output", F.lit("\n")))
        skips = sections.heading_skips(output.select("doc_id", F.col("output").alias("text")))
        shown = output.select("doc_id", (F.col("text") != F.col("output")).alias("changed"), F.regexp_count("output", F.lit("\n")).cast("long").alias("output_lines"))
    joined = shown.join(lines, "doc_id", "left").join(counted, "doc_id", "left").join(skips, "doc_id", "left")
    return joined.fillna(0, ["input_lines", "removed_repeats", "blocks", "headings", "heading_skips"])


def _pieces_shown(docs: DataFrame, output: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(doc_id, changed, output_lines) and heading skips, from a document's pieces before and after.

    A document whose length has changed has changed; others are compared line by line.
    """
    breaks = lambda c: F.regexp_count(c, F.lit("\n"))
    before = docs.groupBy("doc_id").agg((F.sum(F.length("text")) + F.count("text") - 1).alias("_n"), F.max("text").isNull().alias("_none"))
    # Pieces of the output stand a blank line apart and end with a line feed; no piece at all is a line feed.
    after = output.groupBy("doc_id").agg((F.sum(F.length("output")) + 2 * F.count(F.lit(1)) - 1).alias("_m"), (F.sum(breaks("output")) + 2 * F.count(F.lit(1)) - 1).alias("_l"))
    both = before.join(after, "doc_id", "left").fillna(1, ["_m", "_l"])
    same = F.broadcast(both.where("_n = _m").select("doc_id"))

    def numbered(rows: DataFrame, text: Column, more: int) -> DataFrame:
        split = rows.join(same, "doc_id", "left_semi").select("doc_id", "piece", F.split(text, "\n", -1).alias("_x"))
        before = offsets(split.select("doc_id", "piece", (F.size("_x") + more).alias("_k")), "_k")
        return split.join(before, ["doc_id", "piece"]).select("doc_id", "_offset", F.posexplode("_x").alias("_i", "line")).select("doc_id", (F.col("_offset") + F.col("_i")).alias("_i"), "line")

    # The text's last line feed opens an empty line, as do the blanks between the output's pieces.
    told = lambda rows: rows.where("line <> ''")
    ours, theirs = told(numbered(output, F.col("output"), 1)), told(numbered(docs, F.col("text"), 0))
    differ = theirs.join(ours, ["doc_id", "_i", "line"], "left_anti").union(ours.join(theirs, ["doc_id", "_i", "line"], "left_anti")).select("doc_id").distinct()
    marked = both.join(differ.withColumn("_d", F.lit(True)), "doc_id", "left")
    changed = F.when(~F.col("_none"), (F.col("_n") != F.col("_m")) | F.coalesce("_d", F.lit(False)))
    shown = marked.select("doc_id", changed.alias("changed"), F.col("_l").cast("long").alias("output_lines"))
    skips = sections.heading_skips(docs.select("doc_id", "piece").join(output, ["doc_id", "piece"], "left").select("doc_id", "piece", F.col("output").alias("text")))
    return shown, skips
