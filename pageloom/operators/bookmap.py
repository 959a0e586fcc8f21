"""Book map: packet profiles, chapter profiles by weighted vote, review findings, renderings."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pageloom.functions import fixed, text as t

def _profiled(rows: DataFrame) -> DataFrame:
    """Weight, guidance and role as they follow from ``packet_kind``."""
    kind = F.col("packet_kind")
    return (
        rows.withColumn("priority_weight", t.priority(kind))
        .withColumn("detail_guidance", t.guidance(F.col("priority_weight"), kind))
        .withColumn("role_in_book", t.role(kind, F.col("chapter_title"), F.col("covered_sections")))
    )


def packet_profiles(packets: DataFrame, titles: DataFrame | None = None) -> DataFrame:
    """One row per packet; with ``titles``, packets of the chapter named like the book count as framing."""
    named = F.array_join("section_labels", " ")
    kinds = t.with_kind(packets, F.when(named == "", F.col("chapter_title")).otherwise(named), "packet_kind")
    rows = kinds.select("doc_id", "packet_id", "packet_no", "chapter_title", F.col("section_labels").alias("covered_sections"), "packet_kind")
    if titles is not None:
        titled = (t.title_key(F.col("chapter_title")) == t.title_key(F.col("book_title"))) & F.col("packet_kind").isin("reference", "mixed")
        rows = rows.join(titles, "doc_id").withColumn("packet_kind", F.when(titled, "framing").otherwise(F.col("packet_kind"))).drop("book_title")
    return _profiled(rows)


def kind_votes(profiles: DataFrame, weighted: bool = True) -> DataFrame:
    """(doc_id, chapter_title, chapter_kind): the winning kind of a chapter's packets.

    Documentary packets vote only among themselves.  Ties go to the higher priority, then by name.  Unweighted, every
    packet counts one and all vote.
    """
    chapter = Window.partitionBy("doc_id", "chapter_title")
    is_doc = F.col("packet_kind").isin(*fixed.DOCUMENTARY)
    voting = profiles.withColumn("_open", F.max((~is_doc).cast("int")).over(chapter)).where((F.col("_open") == 0) | ~is_doc) if weighted else profiles
    votes = voting.groupBy("doc_id", "chapter_title", "packet_kind").agg((F.sum("priority_weight") if weighted else F.count(F.lit(1))).alias("_votes"))
    best = F.struct((-F.col("_votes")).alias("v"), (-t.priority(F.col("packet_kind"))).alias("p"), F.col("packet_kind").alias("k"))
    return votes.groupBy("doc_id", "chapter_title").agg(F.min(best)["k"].alias("chapter_kind"))


def chapter_profiles(profiles: DataFrame, sections: DataFrame) -> DataFrame:
    """One row per chapter in order of appearance; of titles that differ only by case, the first alone."""
    order = Window.partitionBy("doc_id", t.casefold(t.strip(F.col("chapter_title")))).orderBy("packet_no")
    first = profiles.withColumn("_n", F.row_number().over(order)).where((F.col("_n") == 1) & (t.strip(F.col("chapter_title")) != ""))
    first = first.select("doc_id", t.strip(F.col("chapter_title")).alias("chapter_title"), F.col("packet_no").alias("chapter_pos"))
    labels = F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("packet_no", "covered_sections"))), lambda s: s["covered_sections"]))
    rolled = profiles.groupBy("doc_id", "chapter_title").agg(F.max("priority_weight").alias("priority_weight"), F.count(F.lit(1)).alias("packet_count"), labels.alias("_labels"))
    counted = sections.groupBy("doc_id", "chapter_title").agg(F.count(F.lit(1)).alias("section_count"))
    keys = ["doc_id", "chapter_title"]
    kind = F.col("chapter_kind")
    return first.join(rolled, keys).join(kind_votes(profiles), keys).join(counted, keys, "left").select(
        "doc_id", "chapter_title", "chapter_kind", "priority_weight", t.guidance(F.col("priority_weight"), kind).alias("detail_guidance"), "packet_count",
        F.coalesce("section_count", "packet_count").alias("section_count"), t.role(kind, F.col("chapter_title"), F.col("_labels")).alias("role_in_book"),
        F.slice(t.distinct_in_order(F.col("_labels")), 1, 5).alias("representative_sections"), "chapter_pos",
    )


def compact(chapters: DataFrame) -> DataFrame:
    return chapters.select("doc_id", "chapter_title", "chapter_kind", "priority_weight", "detail_guidance", "role_in_book", "chapter_pos")


def map_review(profiles: DataFrame, chapters: DataFrame) -> DataFrame:
    """Findings: doc_id, scope, item, ord, warning."""
    labels, weight = F.col("covered_sections"), F.col("priority_weight").cast("string")
    mixes = F.exists(labels, t.is_supplemental_label) & F.exists(labels, lambda x: ~t.is_supplemental_label(x))
    mixed = (F.col("packet_kind") == "mixed") & (F.col("priority_weight") >= 3)
    of_packet = F.array(
        F.when(mixes, F.concat("packet_id", F.lit(fixed.AUDIT_SENTENCES["packet_mixes"]))),
        F.when(mixed, F.concat("packet_id", F.lit(fixed.AUDIT_SENTENCES["packet_mixed"]), weight, F.lit(fixed.AUDIT_SENTENCES["packet_mixed_end"]))),
    )
    of_chapter = F.array(
        F.when((F.col("chapter_kind") == "mixed") & (F.col("priority_weight") >= 3), F.concat("chapter_title", F.lit(fixed.AUDIT_SENTENCES["chapter_mixed"]))),
        F.when(
            F.col("chapter_kind").isin(*fixed.DOCUMENTARY) & (F.col("priority_weight") >= 4),
            F.concat("chapter_title", F.lit(fixed.AUDIT_SENTENCES["chapter_documentary"])),
        ),
    )
    packets = profiles.select("doc_id", F.lit("packet").alias("scope"), F.col("packet_id").alias("item"), F.posexplode(of_packet).alias("ord", "warning"))
    whole = chapters.select("doc_id", F.lit("chapter").alias("scope"), F.col("chapter_title").alias("item"), F.posexplode(of_chapter).alias("ord", "warning"))
    return packets.union(whole).where("warning is not null")


def render_map(chapters: DataFrame, titles: DataFrame) -> DataFrame:
    """(doc_id, markdown) of a book map."""
    line = lambda name, column: F.concat(F.lit(f"- {name}: "), F.col(column).cast("string"))
    shown = F.when(F.size("representative_sections") > 0, F.concat(F.lit("- Representative sections: "), F.array_join("representative_sections", ", ")))
    block = F.concat_ws(
        "\n", F.concat(F.lit("### "), F.col("chapter_title")), F.lit(""), line("Kind", "chapter_kind"), line("Priority weight", "priority_weight"),
        line("Detail guidance", "detail_guidance"), line("Packet count", "packet_count"), line("Section count", "section_count"), line("Role", "role_in_book"), shown,
    )
    blocks = chapters.groupBy("doc_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("chapter_pos", block.alias("b")))), lambda s: s["b"]), "\n\n").alias("_b"))
    head = "".join(f"- {g}\n" for g in fixed.OVERALL_GUIDANCE)
    return titles.join(blocks, "doc_id", "left").select(
        "doc_id", F.concat(F.lit("# "), "book_title", F.lit(f" - Book Map\n\n## Overall Guidance\n\n{head}\n## Chapter Profiles"), F.coalesce(F.concat(F.lit("\n\n"), "_b"), F.lit("")), F.lit("\n")).alias("markdown")
    )


def render_review(findings: DataFrame, titles: DataFrame) -> DataFrame:
    """(doc_id, markdown) of a map review."""
    order = F.array_sort(F.collect_list(F.struct((F.col("scope") == "chapter").alias("s"), "item", "ord", "warning")))
    listed = findings.groupBy("doc_id").agg(F.array_join(F.transform(order, lambda w: F.concat(F.lit("- "), w["warning"])), "\n").alias("_w"))
    told = F.when(F.col("_w").isNotNull(), F.concat(F.lit(f"## Warnings\n\n{fixed.REVIEW_INTRODUCTION}\n\n"), "_w")).otherwise(F.lit(fixed.REVIEW_NONE))
    guidance = "".join(f"- {g}\n" for g in fixed.REVIEW_GUIDANCE)
    return titles.join(listed, "doc_id", "left").select(
        "doc_id", F.concat(F.lit("# "), "book_title", F.lit(" - Map Review\n\n"), told, F.lit(f"\n\n## Guidance\n\n{guidance}")).alias("markdown")
    )


def run_statistics(sections: DataFrame, packets: DataFrame, chapters: DataFrame, titles: DataFrame) -> DataFrame:
    """Counts and token sums per document."""
    s = sections.groupBy("doc_id").agg(F.count(F.lit(1)).alias("section_count"), F.sum("token_estimate").alias("source_token_estimate"))
    p = packets.groupBy("doc_id").agg(F.count(F.lit(1)).alias("packet_count"), F.sum("token_estimate").alias("packet_token_estimate"))
    c = chapters.groupBy("doc_id").agg(F.count(F.lit(1)).alias("book_map_chapter_count"))
    zero = ["section_count", "source_token_estimate", "packet_count", "packet_token_estimate", "book_map_chapter_count"]
    return titles.join(s, "doc_id", "left").join(p, "doc_id", "left").join(c, "doc_id", "left").fillna(0, zero)
