"""A summary job from its documents to its end, and the parts that only a job uses."""

import json

import pytest
from pyspark.sql import functions as F

from pageloom import __main__ as cli
from pageloom.functions import schemas
from pageloom.operators import payloads
from pageloom.plans import jobs, summarize
from pageloom.sources import markdown as src

TEXTS = {
    "a": "# Alpha Book\n\nWhat it is.\n\n## Chapter 1: Rise\n\nThe method and the principle of rising.\n\n## Chapter 2: Fall\n\nIn 1901, 1902, 1903 and 1904 it fell.\n\n## Sources\n\nA list.\n",
    "b": "# Beta Book\n\n## Chapter 1: Only\n\nJust words.\n",
}


class Failing(payloads.ModelClient):
    def __init__(self, answers):
        self._answers = list(answers)

    def answer(self, item_id, prompt):
        return self._answers.pop(0)


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    path = tmp_path_factory.mktemp("texts")
    for name, text in TEXTS.items():
        (path / f"{name}.md").write_text(text)
    return path


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(list(TEXTS.items()), "doc_id string, text string")


def answer(job, stage, drop=None):
    prompts = job.prompts(stage)
    filled = prompts.select("doc_id", "item_id", F.col("template").alias("payload"))
    job.record(stage, filled if drop is None else filled.where(~drop))


def stages(job):
    return {r.job: (r.stage, r.action_type, r.target) for r in job.status().collect()}


def test_a_job_from_end_to_end(spark, docs, tmp_path):
    job = jobs.Job(spark, str(tmp_path / "job")).init(docs, jobs.config_of("compromise"), "Be faithful.")
    assert job.manifest["job_version"] == jobs.JOB_VERSION and job.manifest["config"]["verify"] is True
    prompts = job.prompts("chunk")
    assert all(r.prompt.startswith("Be faithful.") and json.loads(r.template)["confidence"] == "medium" for r in prompts.collect())
    first = {r.doc_id: r.i for r in prompts.groupBy("doc_id").agg(F.min("item_id").alias("i")).collect()}
    assert stages(job) == {d: ("chunks", "complete_prompt", i) for d, i in first.items()}
    reports = {r.doc_id: r.markdown for r in spark.read.parquet(f"{job.root}/reports/map_review").collect()}
    assert reports["a"].startswith("# Alpha Book - Map Review") and "## Guidance" in reports["b"]
    assert "# Beta Book - Runbook" in {r.doc_id: r.markdown for r in spark.read.parquet(f"{job.root}/reports/runbook").collect()}["b"]

    # The barrier: one output is missing, then all are there, one of them twice.
    answer(job, "chunk", drop=(F.col("doc_id") == "a") & (F.col("item_id") == first["a"]))
    with pytest.raises(Exception, match="outputs, found"):
        job.build("chapter")
    missing = {r.warning for r in job.audit()[0].where("doc_id = 'a'").collect()}
    assert {"final output is missing", "verify output is missing"} <= missing and any(w.startswith("chunk output count mismatch: expected") for w in missing)
    answer(job, "chunk")
    assert job.outputs("chunk").count() == prompts.count()
    assert {s for s, *_ in stages(job).values()} == {"chapters"}

    chapters = job.build("chapter")
    assert {r.item_id for r in chapters.where("doc_id = 'b'").collect()} == {"c001-beta-book", "c002-chapter-1-only"}
    answer(job, "chapter")
    assert set(stages(job).values()) == {("final", "run_command", "build-final")}
    job.build("final")
    answer(job, "final")
    assert set(stages(job).values()) == {("verify", "run_command", "build-verify")}
    job.build("verify")
    told = job.prompts("verify").select("doc_id", "item_id", F.regexp_replace("template", r'"issues":\[\]', '"issues":[{"severity":"low","problem":"p","correction":"c"}]').alias("payload"))
    job.record("verify", told)
    assert set(stages(job).values()) == {("assemble", "run_command", "assemble")}
    result = {r.doc_id: r for r in job.assemble().collect()}
    assert set(result) == {"a", "b"} and "- [low] p -> c" in result["a"].markdown and "issues" not in json.loads(result["a"].payload)
    assert set(stages(job).values()) == {("done", "none", "")}

    findings, counts = job.audit()
    said = {r.warning for r in findings.where("doc_id = 'b'").collect()}
    assert "verify output lists issues but leaves the final summary unchanged" in said and "final output is missing" not in said
    row = counts.where("doc_id = 'b'").first()
    assert (row.chunk_output_count, row.expected_chunk_count, row.verification_issue_count) == (row.expected_chunk_count, row.expected_chunk_count, 1)

    with pytest.raises(ValueError, match="own folder"):
        job.archive(f"{job.root}/x/../archive")
    job.archive(str(tmp_path / "archive"))
    assert job.cleanup() == ["outputs", "prompts", "reports", "review", "structure"]
    assert spark.read.parquet(f"{job.root}/result").count() == 2 and spark.read.parquet(str(tmp_path / "archive") + "/prompts/final").count() == 2


def test_legacy_outputs_are_counted(spark, docs, tmp_path):
    job = jobs.Job(spark, str(tmp_path / "job")).init(docs, jobs.config_of("cheap"))
    legacy = json.dumps(schemas.template(schemas.SCHEMAS["chunk_legacy"], choose=True))
    job.record("chunk", job.prompts("chunk").withColumn("payload", F.lit(legacy)))
    n = job.prompts("chunk").where("doc_id = 'a'").count()
    assert f"{n} chunk outputs still use the legacy schema and are being auto-enriched" in {r.warning for r in job.audit()[0].where("doc_id = 'a'").collect()}


def test_the_map_is_kept_until_it_is_made_anew(spark, docs, tmp_path):
    job = jobs.Job(spark, str(tmp_path / "job")).init(docs)
    changed = job.map()[1].withColumn("priority_weight", F.lit(1))
    rows = spark.createDataFrame(changed.collect(), changed.schema)
    rows.write.mode("overwrite").parquet(f"{job.root}/structure/chapters")
    assert {r.priority_weight for r in job.map()[1].collect()} == {1}
    assert {r.priority_weight for r in job.map(rebuild=True)[1].collect()} != {1}


def test_run_with_clients(spark, docs):
    got = summarize.run_with(docs.where("doc_id = 'b'"), {s: payloads.TemplateClient(s) for s in ("chunk", "chapter", "final", "verify")}).collect()
    assert [r.doc_id for r in got] == ["b"] and "## Executive Summary" in got[0].markdown


def test_patience_and_cache(spark, tmp_path):
    good = json.dumps(schemas.template(schemas.SCHEMAS["final"], choose=True))
    assert payloads.PatientClient(Failing(["no json", "{}", good]), "final", pause=0).answer("x", "p") == good
    with pytest.raises(RuntimeError, match="3 attempts"):
        payloads.PatientClient(Failing(["{}"] * 3), "final", pause=0).answer("x", "p")
    prompts = spark.createDataFrame([("1", "p"), ("2", "p"), ("3", "q")], "item_id string, prompt string")
    store = src.CacheTable(spark, str(tmp_path / "cache"))
    client = payloads.CachedClient(payloads.TemplateClient("final"), store, "final")
    assert {r.item_id: r.payload for r in client.run(prompts).collect()} == {k: good for k in "123"}
    assert spark.read.parquet(str(tmp_path / "cache")).count() == 2
    # What is stored is not asked for again, by whatever client.
    again = payloads.CachedClient(payloads.TemplateClient("chunk"), store, "final").run(prompts)
    assert {r.payload for r in again.collect()} == {good}


def test_response_text():
    assert payloads.response_text({"output_text": " x "}) == " x "
    parts = [{"type": "reasoning"}, {"type": "message", "content": [{"type": "output_text", "text": "a"}, {"type": "output_text", "text": "b "}]}]
    assert payloads.response_text({"output": parts}) == "ab"
    for body, why in (({}, "without text"), ({"output": [{"type": "message", "content": [{"type": "refusal", "refusal": "no"}]}]}, "refused: no")):
        with pytest.raises(ValueError, match=why):
            payloads.response_text(body)


def test_canonical_key(spark):
    import hashlib

    row = spark.createDataFrame([("s", "é")], "a string, b string").select(payloads.canonical_key(F.col("a"), F.col("b")).alias("k")).first()
    assert row.k == hashlib.sha256('{"payload": "é", "stage": "s"}'.encode()).hexdigest()


def test_paths():
    assert jobs.is_within("/a/b/c", "/a/b") and jobs.is_within("/a/b", "/a/b/") and not jobs.is_within("/a/bc", "/a/b") and not jobs.is_within("/a/b/../c", "/a/b")
    with pytest.raises(ValueError, match="profile"):
        jobs.config_of("lavish")
    assert jobs.config_of("quality", target=9).target == 9


def test_command_lines(spark, folder, tmp_path, capsys):
    cli.main(["normalize", f"{folder}/*.md", "--output", str(tmp_path / "clean")], spark)
    lines = [json.loads(x) for x in capsys.readouterr().out.splitlines()]
    assert [x["headings"] for x in lines] == [4, 2] and spark.read.parquet(str(tmp_path / "clean/documents")).count() == 2
    cli.main(["plan", f"{folder}/*.md", "--profile", "cheap"], spark)
    assert [json.loads(x)["section_count"] for x in capsys.readouterr().out.splitlines()] == [4, 2]
    (tmp_path / "contract.txt").write_text(" Say it.\n")
    root = str(tmp_path / "job")
    cli.main(["job", "init", root, f"{folder}/*.md", "--contract", str(tmp_path / "contract.txt"), "--no-verify"], spark)
    cli.main(["job", "next", root], spark)
    assert [json.loads(x)["stage"] for x in capsys.readouterr().out.splitlines()] == ["chunks", "chunks"]
    assert jobs.Job(spark, root).manifest["contract"] == "Say it."
    cli.main(["job", "cleanup", root], spark)
    assert "structure" in json.loads(capsys.readouterr().out)
