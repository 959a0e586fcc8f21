"""Structure-first summaries as plans: structure, prompts, templates, and assembly of what a model answers."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pageloom.functions import fixed, schemas, text as t
from pageloom.operators import bookmap, packets as pk, payloads, sections as sec, work
from pageloom.session import settled

#: Our own wording of what each stage asks.
INSTRUCTIONS = {
    "chunk": "Summarize this packet faithfully. Keep claims, methods and examples apart, keep proportion to its weight, and flag what is unclear.",
    "chapter": "Combine the packet summaries of one chapter. State its thesis, keep what the final summary must preserve, and flag what is unclear.",
    "final": "Combine the chapter summaries into one summary of the book. Follow the book map's weights and describe rather than judge.",
    "verify": "Check the final summary against the chapter summaries. List issues, and return the corrected summary.",
}

#: What a reader of a job's folder is told to do, in order.
RUNBOOK = (
    "Read the map review and the book map.",
    "Answer every chunk prompt with one JSON object of its template's shape.",
    "Build the chapter prompts and answer them; then the final prompt.",
    "Build the verify prompt, unless the profile leaves it out, and answer it.",
    "Assemble the summary, and read the audit before it is used.",
)


@dataclass(frozen=True)
class Config:
    """Packet sizes and whether a verification stage follows."""

    target: int = 6500
    most: int = 8500
    verify: bool = True

    @classmethod
    def profile(cls, name: str, **overrides: int | bool | None) -> Config:
        base = cls(*fixed.PROFILES[name])
        return replace(base, **{k: v for k, v in overrides.items() if v is not None})


@dataclass(frozen=True)
class Structure:
    titles: DataFrame
    sections: DataFrame
    packets: DataFrame
    profiles: DataFrame
    chapters: DataFrame


def structure(docs: DataFrame, config: Config = Config(), titles: DataFrame | None = None) -> Structure:  # noqa: B008
    """What is known of documents before any model call."""
    # Every later step reads these several times: they are written once.
    named = settled(sec.book_titles(docs) if titles is None else titles)
    sections = settled(sec.sections(docs, named))
    packets = settled(pk.packets(sections, config.target, config.most))
    profiles = settled(bookmap.packet_profiles(packets, named))
    return Structure(named, sections, packets, profiles, bookmap.chapter_profiles(profiles, sections))


def plan(docs: DataFrame, config: Config = Config()) -> DataFrame:  # noqa: B008
    """The dry run: statistics of every document."""
    s = structure(docs, config)
    return bookmap.run_statistics(s.sections, s.packets, s.chapters, s.titles)


def _prompt(stage: str, contract: str, user: Column) -> Column:
    import json

    shape = json.dumps(schemas.template(schemas.SCHEMAS[stage]), indent=2)
    head = f"{contract.strip()}\n\n{INSTRUCTIONS[stage]}\n\nAnswer with one JSON object of this shape:\n{shape}\n\n"
    return F.concat(F.lit(head), user)


def chunk_prompts(s: Structure, contract: str = "") -> DataFrame:
    """(doc_id, item_id, prompt, template): one row per packet."""
    user = F.concat(
        F.lit("Book: "), F.col("book_title"), F.lit("\nPacket: "), F.col("packet_id"), F.lit("\nChapter: "), F.col("chapter_title"), F.lit("\nKind: "), F.col("packet_kind"),
        F.lit("\nPriority: "), F.col("priority_weight").cast("string"), F.lit("\nGuidance: "), F.col("detail_guidance"), F.lit("\nSections: "), F.array_join("section_labels", "; "), F.lit("\n\n"), F.col("raw_text"),
    )
    # Titles go to the profiles, so that texts are dealt by packet and not by document.
    told = s.profiles.drop("chapter_title", "packet_no").join(s.titles, "doc_id")
    rows = s.packets.join(told, ["doc_id", "packet_id"])
    return rows.select("doc_id", F.col("packet_id").alias("item_id"), _prompt("chunk", contract, user).alias("prompt"), chunk_template().alias("template"))


def _filled(ddl: str, **known: Column) -> Column:
    """A payload of the given type with placeholders but for what is known, as JSON."""
    empty = {"string": F.lit(""), "int": F.lit(3)}
    fields = [f.split(" ", 1) for f in ddl.split(", ")]
    return F.to_json(F.struct(*[known.get(n, empty.get(kind, F.array().cast(kind) if kind not in empty else None)).alias(n) for n, kind in fields]))


def chunk_template() -> Column:
    return _filled(
        payloads.CHUNK_TYPE, chapter_title=F.col("chapter_title"), covered_sections=F.col("section_labels"), confidence=F.lit("medium"),
        packet_kind=F.coalesce("packet_kind", F.lit("mixed")), role_in_book=F.coalesce("role_in_book", F.lit("")), priority_weight=F.coalesce("priority_weight", F.lit(3)),
    )


def chapter_template() -> Column:
    return _filled(
        payloads.CHAPTER_TYPE, chapter_title=F.col("chapter_title"), confidence=F.lit("medium"), chapter_kind=F.coalesce("chapter_kind", F.lit("mixed")),
        priority_weight=F.coalesce("priority_weight", F.lit(3)),
    )


def chapter_prompts(s: Structure, chunks: DataFrame, contract: str = "") -> DataFrame:
    """One row per chapter, with the enriched chunk summaries of its packets in order."""
    told = chunks.groupBy("doc_id", "chapter_title").agg(
        F.to_json(F.array_sort(F.collect_list(F.struct("item_id", "summary", "main_points", "primary_claims", "story_events", "ambiguity_flags")))).alias("_told")
    )
    rows = work.numbered_chapters(s.chapters).join(told, ["doc_id", "chapter_title"]).join(s.titles, "doc_id")
    user = F.concat(F.lit("Book: "), F.col("book_title"), F.lit("\nChapter: "), F.col("chapter_title"), F.lit("\nGuidance: "), F.col("detail_guidance"), F.lit("\n\nPacket summaries:\n"), F.col("_told"))
    return rows.select("doc_id", "item_id", _prompt("chapter", contract, user).alias("prompt"), chapter_template().alias("template"))


def final_template(s: Structure, verify: bool = False) -> DataFrame:
    """(doc_id, template): the final (or verify) payload with its chapters named."""
    named = F.transform(F.array_sort(F.collect_list(F.struct("chapter_pos", "chapter_title"))), lambda c: F.struct(c["chapter_title"].alias("chapter_title"), F.lit("").alias("summary")))
    rows = s.chapters.groupBy("doc_id").agg(named.alias("_c")).join(s.titles, "doc_id")
    none = F.array().cast("array<string>")
    issues = [F.array().cast("array<struct<severity:string,problem:string,correction:string>>").alias("issues")] if verify else []
    body = F.struct(
        *issues, F.col("book_title"), F.lit("").alias("executive_summary"), F.lit("").alias("central_thesis"), F.lit("").alias("structural_overview"), F.col("_c").alias("chapter_summaries"),
        *[none.alias(c) for c in ("major_themes", "notable_examples", "practical_takeaways", "faithfulness_notes")],
    )
    return rows.select("doc_id", F.to_json(body).alias("template"))


def final_prompts(s: Structure, chapters: DataFrame, contract: str = "", stage: str = "final") -> DataFrame:
    """One row per document, with its enriched chapter summaries and the compact book map."""
    told = chapters.groupBy("doc_id").agg(F.to_json(F.array_sort(F.collect_list(F.struct("item_id", "chapter_title", "summary", "chapter_thesis", "major_points", "what_to_preserve_in_final", "ambiguity_flags")))).alias("_told"))
    mapped = bookmap.compact(s.chapters).groupBy("doc_id").agg(F.to_json(F.array_sort(F.collect_list(F.struct("chapter_pos", "chapter_title", "chapter_kind", "priority_weight", "role_in_book")))).alias("_map"))
    rows = told.join(mapped, "doc_id").join(s.titles, "doc_id").join(final_template(s, stage == "verify"), "doc_id")
    user = F.concat(F.lit("Book: "), F.col("book_title"), F.lit("\n\nBook map:\n"), F.col("_map"), F.lit("\n\nChapter summaries:\n"), F.col("_told"))
    return rows.select("doc_id", F.lit(stage).alias("item_id"), _prompt(stage, contract, user).alias("prompt"), "template")


def assemble(finals: DataFrame, verified: DataFrame | None = None) -> DataFrame:
    """(doc_id, markdown): the verified summary where there is one, else the final one."""
    last = finals.select("doc_id", F.from_json("payload", payloads.FINAL_TYPE).alias("p")).select("doc_id", "p.*")
    plain = last.select("doc_id", payloads.final_markdown().alias("_f"))
    if verified is None:
        return plain.select("doc_id", F.col("_f").alias("markdown"))
    ddl = f"{payloads.ISSUES_TYPE}, {payloads.FINAL_TYPE}"
    checked = verified.select("doc_id", F.from_json("payload", ddl).alias("p")).select("doc_id", "p.*").select("doc_id", payloads.final_markdown(True).alias("_v"))
    return plain.join(checked, "doc_id", "full").select("doc_id", F.coalesce("_v", "_f").alias("markdown"))


def run_with(docs: DataFrame, clients: dict[str, payloads.ModelClient], config: Config = Config()) -> DataFrame:  # noqa: B008
    """All stages with a model behind each: documents -> (doc_id, markdown).  For few documents; stages depend in turn."""
    s = structure(docs, config)
    # Every stage reads the structure again: it is kept, and stages in between are too.
    s = Structure(s.titles, s.sections.persist(), s.packets.persist(), s.profiles.persist(), s.chapters.persist())
    key = F.concat_ws("\x1f", F.col("doc_id").cast("string"), "item_id")

    def answers(prompts: DataFrame, stage: str) -> DataFrame:
        got = clients[stage].run(prompts.withColumn("item_id", key))
        parts = F.split("item_id", "\x1f")
        split = got.select(F.get(parts, F.lit(0)).alias("doc_id"), F.get(parts, F.lit(1)).alias("item_id"), "payload")
        return payloads.validate(split, stage).persist()

    chunks = payloads.enrich_chunks(answers(chunk_prompts(s), "chunk"), s.profiles, s.chapters)
    titled = chunks.drop("chapter_title").join(s.profiles.select(F.col("doc_id").cast("string").alias("doc_id"), F.col("packet_id").alias("item_id"), "chapter_title"), ["doc_id", "item_id"])
    chapters = payloads.enrich_chapters(answers(chapter_prompts(s, titled), "chapter"), s.chapters)
    finals = answers(final_prompts(s, chapters), "final")
    return assemble(finals, answers(final_prompts(s, chapters, stage="verify"), "verify") if config.verify else None)
