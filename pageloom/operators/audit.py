"""Audit operators: every rule is one predicate that makes a finding row (doc_id, scope, item, ord, warning)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pageloom.functions import fixed, text as t
from pageloom.operators import payloads

_SAID = fixed.AUDIT_SENTENCES


def _findings(rows: DataFrame, scope: str, item: Column, rules: list[tuple[Column, str | Column]]) -> DataFrame:
    said = F.array(*[F.when(rule, F.lit(text) if isinstance(text, str) else text) for rule, text in rules])
    return rows.select("doc_id", F.lit(scope).alias("scope"), item.alias("item"), F.posexplode(said).alias("ord", "warning")).where("warning is not null")


def _count(column: str) -> Column:
    return F.size(t.clean_strings(F.col(column)))


def _weight() -> Column:
    return F.coalesce(F.when(F.col("priority_weight") != 0, F.col("priority_weight")), F.lit(3))


def chunk_findings(chunks: DataFrame) -> DataFrame:
    """Thin, long or incomplete chunk summaries."""
    kind, length, weight = F.coalesce("packet_kind", F.lit("mixed")), t.word_count(F.col("summary")), _weight()
    minor = kind.isin(*fixed.DOCUMENTARY)
    rules = [
        (minor & (length > 180), _SAID["chunk_long"]),
        ((weight >= 4) & (length < 90), _SAID["chunk_short"]),
        ((weight >= 4) & (_count("main_points") < 3), _SAID["chunk_points_few"]),
        ((kind == "core_argument") & (_count("primary_claims") == 0), _SAID["chunk_no_claims"]),
        ((kind == "core_argument") & (_count("methods_or_principles") == 0), _SAID["chunk_no_methods"]),
        ((kind == "case_study") & (_count("story_events") == 0), _SAID["chunk_no_events"]),
        (minor & (_count("main_points") > 4), _SAID["chunk_points_many"]),
        (F.coalesce(F.size("covered_sections"), F.lit(0)) == 0, _SAID["chunk_no_sections"]),
    ]
    return _findings(chunks, "chunk", F.col("item_id"), rules)


def chapter_findings(chapters: DataFrame) -> DataFrame:
    """Thin, long or incomplete chapter summaries."""
    kind, length, weight = F.coalesce("chapter_kind", F.lit("mixed")), t.word_count(F.col("summary")), _weight()
    minor = kind.isin(*fixed.DOCUMENTARY)
    rules = [
        (minor & (length > 220), _SAID["chapter_long"]),
        ((weight >= 4) & (length < 140), _SAID["chapter_short"]),
        ((weight >= 4) & (_count("major_points") < 3), _SAID["chapter_points_few"]),
        ((kind == "case_study") & (_count("story_progression") == 0), _SAID["chapter_no_story"]),
        ((kind == "core_argument") & (_count("methods_or_principles") == 0), _SAID["chapter_no_methods"]),
        (minor & (_count("major_points") > 5), _SAID["chapter_points_many"]),
        (F.coalesce(F.size("what_to_preserve_in_final"), F.lit(0)) == 0, _SAID["chapter_no_cues"]),
    ]
    return _findings(chapters, "chapter", F.col("item_id"), rules)


def ungrounded(items: DataFrame, pool: DataFrame, item: str = "item", text: str = "text") -> DataFrame:
    """Items of a document none of whose significant tokens occurs in its pool (an anti join on tokens).

    Items without significant tokens are grounded in anything, and a document without a pool grounds all.
    """
    tokens = items.select("doc_id", item, F.explode(t.significant_tokens(F.col(item))).alias("token")).distinct()
    known = pool.select("doc_id", F.explode(t.significant_tokens(F.col(text))).alias("token")).distinct()
    grounded = tokens.join(known, ["doc_id", "token"], "left_semi").select("doc_id", item).distinct()
    told = pool.select("doc_id").distinct()
    return tokens.select("doc_id", item).distinct().join(told, "doc_id", "left_semi").join(grounded, ["doc_id", item], "left_anti")


def final_findings(finals: DataFrame, chapters: DataFrame, profiles: DataFrame) -> DataFrame:
    """What a final summary has against it, by itself and against its chapters (all enriched) and the map."""
    strings = lambda c: t.clean_strings(F.col(c))
    evaluative = F.concat(F.array(*[F.coalesce(F.col(c), F.lit("")) for c in ("executive_summary", "central_thesis", "structural_overview")]), F.transform("chapter_summaries", lambda s: s["summary"]), strings("major_themes"), strings("practical_takeaways"))
    pool = chapters.select("doc_id", payloads.chapter_pool().alias("pool"), t.clean_strings(F.col("ambiguity_flags")).alias("flags"))
    upstream = pool.groupBy("doc_id").agg(
        F.max(t.has_marker(F.array_join("pool", " "), fixed.BOOK_FORMS)).alias("form_told"), F.max(F.size("flags") > 0).alias("ambiguous")
    )
    mapped = profiles.groupBy("doc_id").agg(F.count_distinct("chapter_title").alias("mapped"))
    named = F.array_distinct(F.filter(F.transform("chapter_summaries", lambda s: s["chapter_title"]), lambda c: c != ""))
    own = finals.join(upstream, "doc_id", "left").join(mapped, "doc_id", "left")
    rules = [
        (t.word_count(F.col("executive_summary")) < 180, _SAID["final_summary_brief"]),
        (t.word_count(F.col("structural_overview")) < 70, _SAID["final_structure_brief"]),
        (_count("major_themes") < 5, _SAID["final_themes_thin"]),
        (_count("notable_examples") < 6, _SAID["final_examples_thin"]),
        (_count("practical_takeaways") < 5, _SAID["final_takeaways_thin"]),
        (t.any_marker(evaluative, fixed.EVALUATIVE), _SAID["final_evaluative"]),
        (F.col("form_told") & ~t.has_marker(F.col("executive_summary"), fixed.BOOK_FORMS), _SAID["final_form"]),
        (F.col("ambiguous") & ~t.mentions_uncertainty(strings("faithfulness_notes")), _SAID["final_uncertainty"]),
        (F.size(named) != F.coalesce("mapped", F.lit(0)), _SAID["final_chapter_count"]),
    ]
    about_whole = _findings(own, "final", F.lit("final"), rules)

    told = finals.select("doc_id", payloads.final_pool().alias("final_pool"), F.posexplode("chapter_summaries").alias("n", "s"))
    told = told.groupBy("doc_id", F.col("s.chapter_title").alias("chapter_title")).agg(F.max_by("s.summary", "n").alias("told"), F.first("final_pool").alias("final_pool"))
    both = chapters.join(finals.select("doc_id").distinct(), "doc_id", "left_semi").join(told, ["doc_id", "chapter_title"], "left")
    title, weight, length = F.col("chapter_title"), _weight(), t.word_count(F.col("told"))
    cues = t.clean_strings(F.col("what_to_preserve_in_final"))
    around = F.concat(F.array("told"), F.col("final_pool"))
    lost = F.filter(cues, lambda c: ~t.shares_tokens(c, around))
    both = both.withColumn("_lost", F.when(F.col("told").isNotNull(), lost)).withColumn("_cues", F.size(cues))
    here, under = F.col("told").isNotNull(), (weight >= 4) & (F.size("_lost") >= 2)
    about_chapters = _findings(
        both, "final", title,
        [
            (~here, F.concat(F.lit(_SAID["chapter_missing"]), title)),
            (here & (weight <= 2) & (length > 170), F.concat(title, F.lit(_SAID["chapter_over_expanded"]))),
            (here & (weight >= 4) & (length < 110), F.concat(title, F.lit(_SAID["chapter_compressed"]))),
            (here & ~t.shares_tokens(F.col("told"), payloads.chapter_pool()), F.concat(title, F.lit(_SAID["chapter_ungrounded"]))),
            (here & under, F.concat(title, F.lit(_SAID["chapter_cues_lost"]), F.array_join(F.slice("_lost", 1, 2), "; "), F.lit(")"))),
            (here & ~under & (F.col("_cues") > 0) & (F.size("_lost") == F.col("_cues")), F.concat(title, F.lit(_SAID["chapter_cues_none"]))),
        ],
    )
    extra = told.where(F.col("chapter_title") != "").join(chapters.select("doc_id", "chapter_title"), ["doc_id", "chapter_title"], "left_anti")
    unexpected = extra.select("doc_id", F.lit("final").alias("scope"), title.alias("item"), F.lit(6).alias("ord"), F.concat(F.lit(_SAID["chapter_unexpected"]), title).alias("warning"))
    examples = finals.select("doc_id", F.explode(strings("notable_examples")).alias("item"))
    source = chapters.select("doc_id", F.explode(F.concat(strings("notable_examples"), strings("story_progression"))).alias("text"))
    loose = ungrounded(examples, source).select("doc_id", F.lit("final").alias("scope"), "item", F.lit(7).alias("ord"), F.concat(F.lit(_SAID["example_ungrounded"]), F.col("item")).alias("warning"))
    return about_whole.unionByName(about_chapters).unionByName(unexpected).unionByName(loose)


def audit(chunks: DataFrame, chapters: DataFrame, finals: DataFrame, profiles: DataFrame, review: DataFrame) -> DataFrame:
    """All findings of a job."""
    return review.unionByName(chunk_findings(chunks)).unionByName(chapter_findings(chapters)).unionByName(final_findings(finals, chapters, profiles))
