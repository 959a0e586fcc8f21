"""Summary jobs: all stages of many documents as tables under one folder.

``structure/`` has what is known before any model call, ``prompts/<stage>`` what a stage asks, ``outputs/<stage>`` what came back,
``reports/`` the texts for readers and ``result`` the summaries.  A stage is built only when the one before has an output for
every prompt.  All files go through Spark's writers, so a folder may be in any store.
"""

from __future__ import annotations

import json
from dataclasses import asdict
from functools import cached_property, reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pageloom.functions import fixed
from pageloom.operators import audit as au, bookmap, packets as pk, payloads, sections as sec, work
from pageloom.plans import summarize

JOB_VERSION = 3
PARTS = ("titles", "sections", "packets", "profiles", "chapters")
OUTPUT = "doc_id string, item_id string, payload string"


class Job:
    def __init__(self, spark: SparkSession, root: str):
        self._spark, self.root = spark, root.rstrip("/")

    # ---- files

    def _read(self, name: str) -> DataFrame | None:
        try:
            return self._spark.read.parquet(f"{self.root}/{name}")
        except AnalysisException as e:
            if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
                return None
            raise

    def _write(self, name: str, rows: DataFrame) -> DataFrame:
        rows.write.mode("overwrite").parquet(f"{self.root}/{name}")
        return self._spark.read.parquet(f"{self.root}/{name}")

    def _fs(self):
        path = self._spark._jvm.org.apache.hadoop.fs.Path(self.root)
        return path.getFileSystem(self._spark._jsc.hadoopConfiguration()), path

    @cached_property
    def manifest(self) -> dict:
        rows = self._spark.read.text(f"{self.root}/manifest").collect()
        return json.loads(rows[0][0])

    def _save_manifest(self, **known) -> None:
        stated = json.dumps({"job_version": JOB_VERSION, **known}, sort_keys=True)
        self._spark.createDataFrame([(stated,)], "value string").coalesce(1).write.mode("overwrite").text(f"{self.root}/manifest")
        self.__dict__.pop("manifest", None)

    # ---- structure

    def init(self, docs: DataFrame, config: summarize.Config = summarize.Config(), contract: str = "") -> Job:  # noqa: B008
        """Structure, map, review, chunk prompts and reports of the documents."""
        docs = docs.withColumn("doc_id", F.col("doc_id").cast("string"))
        titles = self._write("structure/titles", sec.book_titles(docs))
        sections = self._write("structure/sections", sec.sections(docs, titles))
        self._write("structure/packets", pk.packets(sections, config.target, config.most))
        self._save_manifest(config=asdict(config), contract=contract)
        self.map(rebuild=True)
        self.review()
        s = self.structure()
        self._write("prompts/chunk", summarize.chunk_prompts(s, contract))
        self._write("reports/book_map", bookmap.render_map(s.chapters, s.titles))
        self._write("reports/runbook", self._runbook(s))
        return self

    def map(self, rebuild: bool = False) -> tuple[DataFrame, DataFrame]:
        """Packet and chapter profiles: the stored ones, or made anew from the stored sections and packets."""
        found = [None if rebuild else self._read(f"structure/{name}") for name in ("profiles", "chapters")]
        if found[0] is not None and found[1] is not None:
            return found[0], found[1]
        titles, sections, packets = (self._read(f"structure/{name}") for name in PARTS[:3])
        profiles = self._write("structure/profiles", bookmap.packet_profiles(packets, titles))
        return profiles, self._write("structure/chapters", bookmap.chapter_profiles(profiles, sections))

    def structure(self) -> summarize.Structure:
        profiles, chapters = self.map()
        return summarize.Structure(*(self._read(f"structure/{name}") for name in PARTS[:3]), profiles, chapters)

    def review(self) -> DataFrame:
        """The map's findings, kept as rows and as a report."""
        rows = self._write("review", bookmap.map_review(*self.map()))
        self._write("reports/map_review", bookmap.render_review(rows, self._read("structure/titles")))
        return rows

    def _runbook(self, s: summarize.Structure) -> DataFrame:
        counted = bookmap.run_statistics(s.sections, s.packets, s.chapters, s.titles)
        steps = "".join(f"{k}. {line}\n" for k, line in enumerate(summarize.RUNBOOK, 1))
        said = [F.concat(F.lit(f"- {name}: "), F.col(c).cast("string"), F.lit("\n")) for name, c in (("Sections", "section_count"), ("Packets", "packet_count"), ("Chapters", "book_map_chapter_count"))]
        return counted.select("doc_id", F.concat(F.lit("# "), "book_title", F.lit(" - Runbook\n\n"), *said, F.lit(f"\n{steps}")).alias("markdown"))

    # ---- stages

    def prompts(self, stage: str) -> DataFrame | None:
        return self._read(f"prompts/{stage}")

    def outputs(self, stage: str) -> DataFrame:
        """The last output of every item, by the order in which they were recorded."""
        rows = self._read(f"outputs/{stage}")
        if rows is None:
            return self._spark.createDataFrame([], OUTPUT)
        return rows.groupBy("doc_id", "item_id").agg(F.max_by("payload", "recorded").alias("payload"))

    def record(self, stage: str, rows: DataFrame) -> None:
        """Appends outputs (doc_id, item_id, payload) of items that the stage has asked for."""
        known = rows.join(self.prompts(stage).select("doc_id", "item_id"), ["doc_id", "item_id"], "left_semi")
        known.select("doc_id", "item_id", "payload", F.current_timestamp().alias("recorded")).write.mode("append").parquet(f"{self.root}/outputs/{stage}")

    def _answered(self, stage: str) -> DataFrame:
        """A stage's valid outputs; the query fails while one is missing, or if one matches no schema."""
        prompts = self.prompts(stage)
        if prompts is None:
            raise ValueError(f"stage {stage} has not been built")
        outputs = self.outputs(stage)
        work.require_complete(work.progress(prompts, outputs, "doc_id", "item_id")).select("completed").collect()
        return payloads.validate(outputs, stage).drop("matched")

    def chunks(self) -> DataFrame:
        s = self.structure()
        rows = payloads.enrich_chunks(self._answered("chunk"), s.profiles, s.chapters)
        return rows.drop("chapter_title").join(s.profiles.select("doc_id", F.col("packet_id").alias("item_id"), "chapter_title"), ["doc_id", "item_id"])

    def chapters(self) -> DataFrame:
        return payloads.enrich_chapters(self._answered("chapter"), self.structure().chapters)

    def build(self, stage: str) -> DataFrame:
        """Prompts of chapter, final or verify, once all outputs of the stage before are there and valid."""
        s, contract = self.structure(), self.manifest["contract"]
        if stage == "chapter":
            rows = summarize.chapter_prompts(s, self.chunks(), contract)
        else:
            if stage == "verify":
                self._answered("final").select("payload").write.format("noop").mode("overwrite").save()
            rows = summarize.final_prompts(s, self.chapters(), contract, stage)
        return self._write(f"prompts/{stage}", rows)

    def assemble(self) -> DataFrame:
        """(doc_id, markdown, payload): the verified summary where there is one, else the final one."""
        finals, verified = self._answered("final"), None
        if self.prompts("verify") is not None:
            verified = self._answered("verify")
        told = summarize.assemble(finals, verified)
        own = finals.select("doc_id", "payload")
        if verified is not None:
            checked = verified.select("doc_id", payloads.project_to_schema(F.col("payload"), "final").alias("_v"))
            own = own.join(checked, "doc_id", "full").select("doc_id", F.coalesce("_v", "payload").alias("payload"))
        return self._write("result", told.join(own, "doc_id"))

    # ---- progress

    def status(self) -> DataFrame:
        """(job, stage, action_type, target) with total and completed prompts of every stage, one row per document."""
        titles = self._read("structure/titles").select(F.col("doc_id").alias("job"))
        result = self._read("result")
        rows, prepared = titles, {}
        for stage in ("chunk", "chapter", "final", "verify"):
            prompts = self.prompts(stage)
            prepared[stage] = prompts is not None
            asked = self._spark.createDataFrame([], "doc_id string, item_id string") if prompts is None else prompts.select("doc_id", "item_id")
            outputs = self.outputs(stage)
            counted = work.progress(asked, outputs, "doc_id", "item_id").select(F.col("doc_id").alias("job"), F.col("total").alias(f"{stage}_total"), F.col("completed").alias(f"{stage}_completed"))
            first = work.next_items(asked, outputs, "doc_id", "item_id").select(F.col("doc_id").alias("job"), F.col("item_id").alias(f"next_{stage}"))
            rows = rows.join(counted, "job", "left").join(first, "job", "left").fillna(0, [f"{stage}_total", f"{stage}_completed"])
        done = self._spark.createDataFrame([], "job string") if result is None else result.select(F.col("doc_id").alias("job"))
        rows = rows.join(done.withColumn("assembled", F.lit(True)), "job", "left").fillna(False, ["assembled"])
        verify = self.manifest["config"]["verify"]
        flags = rows.withColumns({
            "chapters_prepared": F.lit(prepared["chapter"]), "final_prompt": F.lit(prepared["final"]), "final_output": F.col("next_final").isNull() & F.lit(prepared["final"]),
            "verify_prompt": F.lit(prepared["verify"] or not verify), "verify_output": F.lit(not verify) | (F.col("next_verify").isNull() & F.lit(prepared["verify"])),
        })
        return work.next_action(flags).join(rows.select("job", *[f"{s}_{c}" for s in prepared for c in ("total", "completed")]), "job")

    # ---- audit

    def audit(self) -> tuple[DataFrame, DataFrame]:
        """(findings, statistics): everything that stands against the job's outputs, and a row of counts per document."""
        s = self.structure()
        docs = s.titles.select("doc_id")
        review, finals, verified = self._read("review"), self.outputs("final"), self.outputs("verify")
        found, stats = [review], docs.join(review.groupBy("doc_id").agg(F.count(F.lit(1)).alias("map_review_warning_count")), "doc_id", "left")

        def whole(rows: DataFrame, scope: str, warning: Column) -> DataFrame:
            return rows.select("doc_id", F.lit(scope).alias("scope"), F.lit(scope).alias("item"), F.lit(-1).alias("ord"), warning.alias("warning"))

        for stage, what in (("chunk", "chunk"), ("chapter", "chapter")):
            prompts = self.prompts(stage)
            if prompts is None:
                stats = stats.withColumns({f"{stage}_output_count": F.lit(0).cast("long"), f"expected_{stage}_count": F.lit(0).cast("long")})
                continue
            matched = payloads.matched_schema(self.outputs(stage), stage)
            made = matched.groupBy("doc_id").agg(F.count(F.lit(1)).alias(f"{stage}_output_count"), F.count_if(F.col("matched") != stage).alias("_legacy"))
            asked = prompts.groupBy("doc_id").agg(F.count(F.lit(1)).alias(f"expected_{stage}_count"))
            counted = docs.join(made, "doc_id", "left").join(asked, "doc_id", "left").fillna(0)
            n, m = F.col(f"{stage}_output_count"), F.col(f"expected_{stage}_count")
            found.append(whole(counted.where(n != m), stage, F.concat(F.lit(what + fixed.AUDIT_SENTENCES["count_mismatch"]), m.cast("string"), F.lit(", found "), n.cast("string"))))
            found.append(whole(counted.where("_legacy > 0"), stage, F.concat(F.col("_legacy").cast("string"), F.lit(f" {what}{fixed.AUDIT_SENTENCES['legacy_count']}"))))
            stats = stats.join(counted.drop("_legacy"), "doc_id")
        chunks = payloads.enrich_chunks(self.outputs("chunk"), s.profiles, s.chapters)
        chapters = payloads.enrich_chapters(self.outputs("chapter"), s.chapters)
        typed = finals.select("doc_id", F.from_json("payload", payloads.FINAL_TYPE).alias("p")).select("doc_id", "p.*")
        found += [au.chunk_findings(chunks), au.chapter_findings(chapters), au.final_findings(typed, chapters, s.profiles)]
        prepared = (self.prompts("chapter") or self._spark.createDataFrame([], "doc_id string")).groupBy("doc_id").agg(F.count(F.lit(1)).alias("_n"))
        uneven = typed.join(prepared, "doc_id", "left").where(F.size("chapter_summaries") != F.coalesce("_n", F.lit(0)))
        found.append(whole(uneven, "final", F.lit(fixed.AUDIT_SENTENCES["prepared_count"])))
        found.append(whole(docs.join(finals, "doc_id", "left_anti"), "final", F.lit(fixed.AUDIT_SENTENCES["final_missing"])))
        found.append(whole(docs.join(verified, "doc_id", "left_anti"), "verify", F.lit(fixed.AUDIT_SENTENCES["verify_missing"])))
        issues = F.size(F.from_json("payload", payloads.ISSUES_TYPE)["issues"])
        listed = verified.select("doc_id", issues.cast("long").alias("verification_issue_count"), payloads.project_to_schema(F.col("payload"), "final").alias("_v"))
        same = listed.where("verification_issue_count > 0").join(finals.select("doc_id", payloads.project_to_schema(F.col("payload"), "final").alias("_f")), "doc_id").where("_v = _f")
        found.append(whole(same, "verify", F.lit(fixed.AUDIT_SENTENCES["verify_unchanged"])))
        findings = reduce(DataFrame.unionByName, found)
        counted = findings.where("scope not in ('packet') or ord < 0").groupBy("doc_id").agg(F.count(F.lit(1)).alias("warning_count"))
        return findings, stats.join(listed.drop("_v"), "doc_id", "left").join(counted, "doc_id", "left").fillna(0)

    # ---- end

    def archive(self, to: str) -> str:
        """Copies the job's folder, to be kept when the job is cleaned up; never into itself."""
        if is_within(to, self.root):
            raise ValueError(f"{to} lies in the job's own folder")
        fs, path = self._fs()
        conf = self._spark._jsc.hadoopConfiguration()
        target = self._spark._jvm.org.apache.hadoop.fs.Path(to)
        self._spark._jvm.org.apache.hadoop.fs.FileUtil.copy(fs, path, target.getFileSystem(conf), target, False, conf)
        return to

    def cleanup(self, keep: tuple[str, ...] = ("result", "manifest")) -> list[str]:
        """Deletes what lies directly in the job's folder but for ``keep``; only a folder with a job's manifest is touched."""
        if self.manifest.get("job_version") != JOB_VERSION:
            raise ValueError(f"{self.root} is no job of this version")
        fs, path = self._fs()
        gone = [s.getPath() for s in fs.listStatus(path) if s.getPath().getName() not in keep]
        for p in gone:
            fs.delete(p, True)
        return sorted(p.getName() for p in gone)


def is_within(path: str, folder: str) -> bool:
    """Whether a path names the folder or something in it, dots resolved."""
    parts: list[list[str]] = []
    for p in (path, folder):
        out: list[str] = []
        for name in p.split("/"):
            if name == "..":
                out = out[:-1]
            elif name not in ("", "."):
                out.append(name)
        parts.append(out)
    return parts[0][: len(parts[1])] == parts[1]


def config_of(profile: str, **overrides) -> summarize.Config:
    if profile not in fixed.PROFILES:
        raise ValueError(f"profile must be one of {', '.join(fixed.PROFILES)}")
    return summarize.Config.profile(profile, **overrides)
