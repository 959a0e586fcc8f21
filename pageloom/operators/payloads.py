"""Payload operators: validation of raw JSON, enrichment from the book map, grounding pools, digests."""

from __future__ import annotations

import hashlib
import json
import time
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from pageloom.functions import schemas, text as t

_STRINGS = "array<string>"
CHUNK_TYPE = (
    "chapter_title string, covered_sections array<string>, summary string, main_points array<string>, examples_or_evidence array<string>, "
    "ambiguity_flags array<string>, confidence string, packet_kind string, role_in_book string, primary_claims array<string>, "
    "methods_or_principles array<string>, story_events array<string>, priority_weight int"
)
CHAPTER_TYPE = (
    "chapter_title string, summary string, major_points array<string>, notable_examples array<string>, ambiguity_flags array<string>, "
    "confidence string, chapter_kind string, chapter_thesis string, priority_weight int, primary_claims array<string>, "
    "methods_or_principles array<string>, story_progression array<string>, what_to_preserve_in_final array<string>"
)
FINAL_TYPE = (
    "book_title string, executive_summary string, central_thesis string, structural_overview string, "
    "chapter_summaries array<struct<chapter_title:string,summary:string>>, major_themes array<string>, notable_examples array<string>, "
    "practical_takeaways array<string>, faithfulness_notes array<string>"
)
ISSUES_TYPE = "issues array<struct<severity:string,problem:string,correction:string>>"


def _faults(payload: str | None, names: tuple[str, ...]) -> list[dict]:
    try:
        value = json.loads(payload) if payload is not None else None
    except ValueError as e:
        return [{"schema_name": n, "ord": 0, "path": "$", "message": f"not JSON: {e.__class__.__name__}"} for n in names]
    return [{"schema_name": n, "ord": k, "path": p, "message": m} for n in names for k, (p, m) in enumerate(schemas.errors(value, schemas.SCHEMAS[n]))]


def schema_errors(rows: DataFrame, stage: str) -> DataFrame:
    """(doc_id, item_id, schema_name, ord, path, message): what each schema of the stage has against each payload."""
    names = tuple(schemas.STAGE_SCHEMAS[stage])

    @F.pandas_udf("array<struct<schema_name:string,ord:int,path:string,message:string>>")
    def check(payloads: pd.Series) -> pd.Series:
        return pd.Series([_faults(p, names) for p in payloads])

    return rows.select("doc_id", "item_id", F.explode(check("payload")).alias("e")).select("doc_id", "item_id", "e.*")


def matched_schema(rows: DataFrame, stage: str) -> DataFrame:
    """Payloads with ``matched``: the first schema of the stage that has nothing against them, else null.

    Item ids repeat from document to document, and a document may answer an item twice: each row has its own match.
    """
    names = tuple(schemas.STAGE_SCHEMAS[stage])

    @F.pandas_udf("string")
    def first(payloads: pd.Series) -> pd.Series:
        faulty = [{f["schema_name"] for f in _faults(p, names)} for p in payloads]
        return pd.Series([next((n for n in names if n not in f), None) for f in faulty], dtype=object)

    return rows.withColumn("matched", first("payload"))


def validate(rows: DataFrame, stage: str) -> DataFrame:
    """Payloads with their schema; the query fails on the first one that matches none."""
    checked = matched_schema(rows, stage)
    complaint = F.raise_error(F.concat_ws(" ", F.col("doc_id").cast("string"), F.col("item_id"), F.lit(f"does not match expected schema of stage {stage}")))
    return checked.withColumn("matched", F.coalesce("matched", complaint.cast("string")))


def _parsed(rows: DataFrame, ddl: str) -> DataFrame:
    return rows.withColumn("p", F.from_json("payload", ddl)).withColumn("_keys", F.coalesce(F.json_object_keys("payload"), F.array().cast(_STRINGS)))


def _or_default(field: str, default: Column) -> Column:
    """The field as it is where the payload has the key at all, even empty; else the default."""
    return F.when(F.array_contains("_keys", field), F.col(f"p.{field}")).otherwise(default).alias(field)


def _first_true(*values: Column) -> Column:
    return F.coalesce(*[F.when(v != "", v) for v in values])


def enrich_chunks(rows: DataFrame, profiles: DataFrame, chapters: DataFrame) -> DataFrame:
    """(doc_id, item_id, payload) -> all chunk fields, missing ones from packet, then chapter, then defaults."""
    p = profiles.select("doc_id", F.col("packet_id").alias("item_id"), F.col("packet_kind").alias("_pk"), F.col("role_in_book").alias("_pr"), F.col("priority_weight").alias("_pw"))
    c = chapters.select(F.col("doc_id").alias("_cd"), F.col("chapter_title").alias("_ct"), F.col("chapter_kind").alias("_ck"), F.col("priority_weight").alias("_cw"))
    parsed = _parsed(rows, CHUNK_TYPE)
    joined = parsed.join(p, ["doc_id", "item_id"], "left").join(c, (F.col("doc_id") == F.col("_cd")) & (F.col("p.chapter_title") == F.col("_ct")), "left")
    kind = _first_true(F.col("p.packet_kind"), F.col("_pk"), F.col("_ck"), F.lit("mixed"))
    none = F.array().cast(_STRINGS)
    listed = lambda f: F.coalesce(f"p.{f}", none)
    plain = ("chapter_title", "covered_sections", "summary", "main_points", "examples_or_evidence", "ambiguity_flags", "confidence")
    return joined.select(
        "doc_id", "item_id", *[F.col(f"p.{f}").alias(f) for f in plain], _or_default("packet_kind", kind),
        _or_default("role_in_book", F.coalesce("_pr", t.role(kind, F.coalesce("p.chapter_title", F.lit("Book")), listed("covered_sections")))),
        _or_default("primary_claims", listed("main_points")), _or_default("methods_or_principles", none), _or_default("story_events", listed("examples_or_evidence")),
        _or_default("priority_weight", F.coalesce("_pw", "_cw", t.priority(kind)).cast("int")),
    )


def enrich_chapters(rows: DataFrame, chapters: DataFrame) -> DataFrame:
    """(doc_id, item_id, payload) -> all chapter fields, missing ones from the map, then the payload itself."""
    c = chapters.select(F.col("doc_id").alias("_cd"), F.col("chapter_title").alias("_ct"), F.col("chapter_kind").alias("_ck"), F.col("priority_weight").alias("_cw"))
    parsed = _parsed(rows, CHAPTER_TYPE)
    joined = parsed.join(c, (F.col("doc_id") == F.col("_cd")) & (F.col("p.chapter_title") == F.col("_ct")), "left")
    kind = _first_true(F.col("p.chapter_kind"), F.col("_ck"), F.lit("mixed"))
    none = F.array().cast(_STRINGS)
    listed = lambda f: F.coalesce(f"p.{f}", none)
    thesis = F.coalesce(_first_true(t.leading_sentence(F.coalesce("p.summary", F.lit(""))), t.leading_sentence(F.array_join(listed("major_points"), " "))), F.lit(""))
    plain = ("chapter_title", "summary", "major_points", "notable_examples", "ambiguity_flags", "confidence")
    return joined.select(
        "doc_id", "item_id", *[F.col(f"p.{f}").alias(f) for f in plain], _or_default("chapter_kind", kind), _or_default("chapter_thesis", thesis),
        _or_default("priority_weight", F.coalesce("_cw", t.priority(kind)).cast("int")), _or_default("primary_claims", listed("major_points")),
        _or_default("methods_or_principles", none), _or_default("story_progression", listed("notable_examples")),
        _or_default("what_to_preserve_in_final", F.slice(t.distinct_in_order(F.concat(listed("major_points"), listed("notable_examples"))), 1, 6)),
    )


def ambiguity_flags(rows: DataFrame, order: str = "item_id") -> DataFrame:
    """(doc_id, flags): all ambiguity flags of a document, each once, in order."""
    gathered = F.flatten(F.transform(F.array_sort(F.collect_list(F.struct(order, F.coalesce("ambiguity_flags", F.array().cast(_STRINGS)).alias("f")))), lambda s: s["f"]))
    return rows.groupBy("doc_id").agg(t.distinct_in_order(gathered).alias("flags"))


def ambiguity_digest(rows: DataFrame, label: str) -> DataFrame:
    flags = t.distinct_in_order(F.col("ambiguity_flags"))
    return rows.select("doc_id", label, flags.alias("ambiguity_flags")).where(F.size("ambiguity_flags") > 0)


def grounding_pool(fields: tuple[str, ...], lists: tuple[str, ...]) -> Column:
    """Texts of a row as one array: plain fields, then cleaned lists."""
    return F.concat(F.array(*[F.coalesce(F.col(f), F.lit("")) for f in fields]), *[t.clean_strings(F.col(c)) for c in lists])


def chapter_pool() -> Column:
    return grounding_pool(
        ("summary", "chapter_thesis"), ("major_points", "primary_claims", "methods_or_principles", "story_progression", "notable_examples", "what_to_preserve_in_final")
    )


def final_pool() -> Column:
    told = F.transform(F.coalesce("chapter_summaries", F.array().cast("array<struct<chapter_title:string,summary:string>>")), lambda s: F.coalesce(s["summary"], F.lit("")))
    return F.concat(
        grounding_pool(("executive_summary", "central_thesis", "structural_overview"), ()), told,
        *[t.clean_strings(F.col(c)) for c in ("major_themes", "notable_examples", "practical_takeaways", "faithfulness_notes")],
    )


def project_to_schema(payload: Column, name: str) -> Column:
    """The payload's fields that its schema knows, as JSON."""
    ddl = {"chunk": CHUNK_TYPE, "chapter": CHAPTER_TYPE, "final": FINAL_TYPE, "verify": f"{ISSUES_TYPE}, {FINAL_TYPE}"}[name]
    return F.to_json(F.from_json(payload, ddl))


def final_markdown(with_issues: bool = False) -> Column:
    """A final payload's columns as Markdown; with ``with_issues``, what verification corrected too."""
    none = F.array().cast(_STRINGS)
    paragraph = lambda name, c: F.concat(F.lit(f"## {name}\n\n"), t.strip(F.col(c)))
    bullets = lambda name, c: F.concat(F.lit(f"## {name}\n\n"), F.array_join(F.transform(F.coalesce(F.col(c), none), lambda v: F.concat(F.lit("- "), v)), "\n"))
    told = F.array_join(F.transform("chapter_summaries", lambda s: F.concat(F.lit("\n\n### "), s["chapter_title"], F.lit("\n\n"), t.strip(s["summary"]))), "")
    parts = [
        F.concat(F.lit("# "), "book_title", F.lit(" - Faithful Summary")), paragraph("Executive Summary", "executive_summary"), paragraph("Central Thesis", "central_thesis"),
        paragraph("Structure", "structural_overview"), F.concat(F.lit("## Chapter-by-Chapter Summary"), told), bullets("Major Themes", "major_themes"),
        bullets("Notable Examples", "notable_examples"), bullets("Practical Takeaways", "practical_takeaways"), bullets("Faithfulness Notes", "faithfulness_notes"),
    ]
    if with_issues:
        each = F.transform("issues", lambda i: F.concat(F.lit("- ["), i["severity"], F.lit("] "), i["problem"], F.lit(" -> "), i["correction"]))
        parts.append(F.when(F.size("issues") > 0, F.concat(F.lit("## Verification Issues Addressed\n\n"), F.array_join(each, "\n"))))
    return F.concat(t.strip(F.concat_ws("\n\n", *parts)), F.lit("\n"))


class ModelClient:
    """Where a model's answers come from: (item_id, prompt) -> (item_id, payload).  The engine makes no calls itself."""

    schema = "item_id string, payload string"

    def answer(self, item_id: str, prompt: str) -> str:
        raise NotImplementedError

    def run(self, prompts: DataFrame) -> DataFrame:
        def ask(batches: Iterator) -> Iterator:
            for pdf in batches:
                yield pdf.assign(payload=[self.answer(i, p) for i, p in zip(pdf["item_id"], pdf["prompt"], strict=True)])[["item_id", "payload"]]

        return prompts.select("item_id", "prompt").mapInPandas(ask, self.schema)


class TemplateClient(ModelClient):
    """Answers every prompt with the stage's empty template: for tests and dry runs."""

    def __init__(self, stage: str):
        self._payload = json.dumps(schemas.template(schemas.SCHEMAS[stage], choose=True))

    def answer(self, item_id: str, prompt: str) -> str:
        return self._payload


def response_text(body: dict) -> str:
    """The text of a model's answer: the whole of it where it is given, else its message parts; a refusal is an error."""
    whole = body.get("output_text")
    if isinstance(whole, str) and whole.strip():
        return whole
    contents = [c for item in body.get("output", ()) if item.get("type") == "message" for c in item.get("content", ())]
    refused = next((c for c in contents if c.get("type") == "refusal"), None)
    if refused is not None:
        raise ValueError(f"refused: {refused.get('refusal', '')}")
    text = "".join(c.get("text", "") for c in contents if c.get("type") == "output_text").strip()
    if not text:
        raise ValueError("an answer without text")
    return text


class PatientClient(ModelClient):
    """Another client's answers, asked for again while they are no valid JSON of the stage: ``attempts`` times, with longer
    and longer pauses."""

    def __init__(self, client: ModelClient, stage: str, attempts: int = 3, pause: float = 1.5):
        self._client, self._stage, self._attempts, self._pause = client, stage, attempts, pause

    def answer(self, item_id: str, prompt: str) -> str:
        last: Exception | None = None
        for attempt in range(self._attempts):
            try:
                payload = self._client.answer(item_id, prompt)
                names = schemas.STAGE_SCHEMAS[self._stage]
                if any(not schemas.errors(json.loads(payload), schemas.SCHEMAS[n]) for n in names):
                    return payload
                last = ValueError(f"no {' or '.join(names)}")
            except Exception as e:  # noqa: BLE001
                last = e
            time.sleep(self._pause * (attempt + 1))
        raise RuntimeError(f"{self._stage} {item_id}: no answer in {self._attempts} attempts: {last}")


class CachedClient(ModelClient):
    """Another client's answers, looked up in a store by the hash of the stage and prompt before they are asked for."""

    def __init__(self, client: ModelClient, store, stage: str):
        self._client, self._store, self._stage = client, store, stage

    def run(self, prompts: DataFrame) -> DataFrame:
        keyed = prompts.withColumn("key", canonical_key(F.lit(self._stage), F.col("prompt")))
        asked = self._store.missing(keyed.dropDuplicates(["key"]))
        named = asked.select(F.col("key").alias("item_id"), "prompt")
        self._store.save(self._client.run(named).select(F.col("item_id").alias("key"), "payload"))
        return self._store.load(keyed).select("item_id", "payload")


@F.pandas_udf(StringType())
def _canonical(stage: pd.Series, payload: pd.Series) -> pd.Series:
    stated = (json.dumps({"stage": s, "payload": p}, sort_keys=True, ensure_ascii=False) for s, p in zip(stage, payload, strict=True))
    return pd.Series([hashlib.sha256(x.encode()).hexdigest() for x in stated])


def canonical_key(stage: Column, payload: Column) -> Column:
    """SHA-256 of stage and payload as JSON with sorted keys."""
    return _canonical(stage, payload)
