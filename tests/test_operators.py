"""Operators on small documents, worked out by hand."""

from pyspark.sql import functions as F

from pageloom.operators import audit, blocks, bookmap, lines, packets, payloads, sections, work
from pageloom.plans import normalize, summarize
from pageloom.sources import markdown as src


def docs(spark, *texts):
    return spark.createDataFrame([(f"d{k}", x) for k, x in enumerate(texts)], "doc_id string, text string")


def test_boilerplate(spark):
    text = "Head\n" + "\n".join(f"Running 1\nline {k}.\nPage {k}" for k in range(4))
    rows = lines.mark_boilerplate(src.read_lines(docs(spark, text))).orderBy("pos").collect()
    assert [r.line for r in rows if not r.removed] == ["Head", *[f"line {k}." for k in range(4)]]


def test_first_line_is_exempt(spark):
    text = "\nSame\n\nSame\nSame\nSame"
    rows = lines.mark_boilerplate(src.read_lines(docs(spark, text))).orderBy("pos").collect()
    assert [r.pos for r in rows if not r.removed] == [0, 1, 2]


def test_list_items(spark):
    rows = lines.split_lists(src.read_lines(docs(spark, "• a • b\n1. a 2. b\n- single\nplain"))).orderBy("pos", "part").collect()
    assert [r.line for r in rows] == ["• a", "• b", "1. a", "2. b", "- single", "plain"]


def test_sections(spark):
    text = "intro\n# Book\n## Chapter One\nbody\n### Deep\nx\n## Two\ny"
    rows = sections.sections(docs(spark, text, "", "no headings")).orderBy("doc_id", "pos").collect()
    assert [(r.doc_id, r.section_id, r.path, r.chapter_title) for r in rows] == [
        ("d0", "s0000", ["Front Matter"], "Front Matter"), ("d0", "s0001", ["Book"], "Book"), ("d0", "s0002", ["Book", "Chapter One"], "Chapter One"),
        ("d0", "s0003", ["Book", "Chapter One", "Deep"], "Chapter One"), ("d0", "s0004", ["Book", "Two"], "Chapter One"),
        ("d1", "s0001", ["d1"], "d1"), ("d2", "s0000", ["Front Matter"], "Front Matter"),
    ]
    assert rows[2].raw_text == "## Chapter One\n\nbody"


def test_level_jumps(spark):
    rows = sections.sections(docs(spark, "# A\n### C\n## B\n### D")).orderBy("pos").collect()
    assert [r.path for r in rows] == [["A"], ["A", "C"], ["A", "B"], ["A", "B", "D"]]


def test_contents_make_anchors(spark):
    text = "# Book\n## Contents\n1. Alpha\n- Beta\n## Alpha\na\n## Gamma\ng\n## Beta\nb"
    rows = {r.title: r.chapter_title for r in sections.sections(docs(spark, text)).collect()}
    assert rows == {"Book": "Book", "Contents": "Book", "Alpha": "Alpha", "Gamma": "Alpha", "Beta": "Beta"}


def test_greedy_parts(spark):
    sizes = {"a": [3, 3, 3, 9, 1, 1], "b": [5, 1, 1], "c": [1] * 25_000}
    rows = spark.createDataFrame([(d, k % 3, k, n) for d, s in sizes.items() for k, n in enumerate(s)], "d string, other int, i int, n long").repartition(5)
    got = {d: [r.part for r in packets.greedy_parts(rows.where(F.col("d") == d), ["d"], "i", "n", 6, 8).orderBy("i").collect()] for d in sizes}
    assert got == {"a": [0, 0, 1, 2, 3, 3], "b": [0, 0, 1], "c": [k // 6 for k in range(25_000)]}
    assert packets.greedy_parts(rows.where("false"), ["d"], "i", "n", 6).count() == 0


def test_packets_split_and_gather(spark):
    big = "\n\n".join(["w" * 400] * 5)
    text = f"# A\nsmall\n## B\n{big}\n## C\nmore"
    rows = packets.packets(sections.sections(docs(spark, text)), 200, 300).orderBy("packet_no").collect()
    assert [r.packet_id for r in rows] == [f"p{k:04d}" for k in range(1, len(rows) + 1)]
    assert rows[1].section_labels == ["A > B (part 1)"] and rows[-1].section_labels == ["A > C"]
    assert "".join(r.raw_text for r in rows).count("w") == 2000


def test_chapter_vote(spark):
    rows = spark.createDataFrame(
        [("d", "c", "p1", 1, "case_study", ["x"]), ("d", "c", "p2", 2, "mixed", ["x"]), ("d", "c", "p3", 3, "reference", ["y"]), ("d", "r", "p4", 4, "endmatter", ["z"])],
        "doc_id string, chapter_title string, packet_id string, packet_no long, packet_kind string, covered_sections array<string>",
    )
    profiled = bookmap._profiled(rows)
    got = {r.chapter_title: (r.chapter_kind, r.priority_weight, r.packet_count, r.representative_sections) for r in bookmap.chapter_profiles(profiled, spark.createDataFrame([], "doc_id string, chapter_title string")).collect()}
    assert got == {"c": ("case_study", 4, 3, ["x", "y"]), "r": ("endmatter", 1, 1, ["z"])}


def test_blocks_and_tables(spark):
    text = "A | b | c\n1 | 2 | 3\n4 | 5 | 6\n\n- one\n- two\n  more\n\nplain text\ngoes on"
    rows = blocks.classify(blocks.raw_blocks(src.read_lines(docs(spark, text)))).orderBy("block_no").collect()
    assert [r.kind for r in rows] == ["table", "list", "paragraph"]
    assert rows[0].text == "| A | b | c |\n| --- | --- | --- |\n| 1 | 2 | 3 |\n| 4 | 5 | 6 |"
    assert rows[1].text == "- one\n- two more" and rows[2].text == "plain text goes on"


def test_heading_levels(spark):
    rows = [("d", k, "heading", f"x{k}", level, True) for k, level in enumerate([1, 3, 4, 2, 6, 1])]
    frame = spark.createDataFrame(rows, "doc_id string, block_no long, kind string, text string, level int, explicit boolean")
    assert [r.level for r in blocks.heading_levels(frame).orderBy("block_no").collect()] == [1, 2, 3, 2, 3, 2]


def test_contents_run(spark):
    kinds = [("heading", "Contents"), ("heading", "One"), ("heading", "Two"), ("heading", "Last"), ("paragraph", "text")]
    frame = spark.createDataFrame([("d", k, *b, 2, True) for k, b in enumerate(kinds)], "doc_id string, block_no long, kind string, text string, level int, explicit boolean")
    rows = blocks.contents_to_list(frame).orderBy("block_no").collect()
    assert [(r.kind, r.text) for r in rows] == [("heading", "Contents"), ("list", "- One\n- Two"), ("heading", "Last"), ("paragraph", "text")]


def test_normalize(spark):
    text = "# My Book\n\nA line that\ngoes on.\n\n## Chapter 1\n\nText of the chap-\nter here.\n\nPage 3\n"
    row = normalize.normalize(docs(spark, text, "")).orderBy("doc_id").collect()
    assert row[0].output == "# My Book\n\nA line that goes on.\n\n## Chapter 1\n\nText of the chap-ter here.\n"
    assert row[1].output == "\n"
    summary = normalize.file_summary(docs(spark, text)).first()
    assert (summary.removed_repeats, summary.headings, summary.heading_skips, summary.changed) == (1, 2, 0, True)


def test_enrichment_keeps_present_fields(spark):
    legacy = '{"chapter_title":"c","covered_sections":[],"summary":"s","main_points":["m"],"examples_or_evidence":["e"],"ambiguity_flags":[],"confidence":"high"}'
    kept = legacy[:-1] + ',"primary_claims":[]}'
    rows = spark.createDataFrame([("d", "p1", legacy), ("d", "p2", kept)], "doc_id string, item_id string, payload string")
    profiles = spark.createDataFrame([("d", "p1", "case_study", "role", 4)], "doc_id string, packet_id string, packet_kind string, role_in_book string, priority_weight int")
    chapters = spark.createDataFrame([("d", "c", "framing", 2)], "doc_id string, chapter_title string, chapter_kind string, priority_weight int")
    got = payloads.enrich_chunks(rows, profiles, chapters).orderBy("item_id").collect()
    assert (got[0].packet_kind, got[0].priority_weight, got[0].primary_claims) == ("case_study", 4, ["m"])
    assert (got[1].packet_kind, got[1].priority_weight, got[1].primary_claims) == ("framing", 2, [])
    found = {r.warning for r in audit.chunk_findings(payloads.enrich_chunks(rows, profiles, chapters)).where("item = 'p1'").collect()}
    assert "high-priority chunk summary looks too short for its weighting" in found and "chunk output is missing covered_sections content" in found


def test_payloads_are_matched_by_document(spark):
    good = payloads.TemplateClient("chunk")._payload
    rows = spark.createDataFrame([("d1", "p0001", good), ("d2", "p0001", "{}"), ("d3", "p0001", None), ("d4", "p0001", "{")], "doc_id string, item_id string, payload string")
    assert {r.doc_id: r.matched for r in payloads.matched_schema(rows, "chunk").collect()} == {"d1": "chunk", "d2": None, "d3": None, "d4": None}
    assert {r.doc_id for r in payloads.schema_errors(rows, "chunk").where("schema_name = 'chunk'").collect()} == {"d2", "d3", "d4"}
    assert payloads.validate(rows.where("doc_id = 'd1'"), "chunk").first().matched == "chunk"


def test_ungrounded(spark):
    items = spark.createDataFrame([("d", "alpha things"), ("d", "the of"), ("d", "omega")], "doc_id string, item string")
    pool = spark.createDataFrame([("d", "Some ALPHA here")], "doc_id string, text string")
    assert [r.item for r in audit.ungrounded(items, pool).collect()] == ["omega"]


def test_work(spark):
    prompts = spark.createDataFrame([("j", "p2"), ("j", "p1"), ("k", "p1")], "job string, item string")
    outputs = spark.createDataFrame([("j", "p1"), ("k", "p1"), ("k", "p9")], "job string, item string")
    assert [tuple(r) for r in work.next_items(prompts, outputs, "job", "item").collect()] == [("j", "p2")]
    assert {tuple(r) for r in work.progress(prompts, outputs, "job", "item").collect()} == {("j", 2, 1), ("k", 1, 1)}
    assert [r.item for r in work.unknown(outputs, prompts, ["job", "item"]).collect()] == ["p9"]


def test_assemble(spark):
    final, verify = (payloads.TemplateClient(s)._payload for s in ("final", "verify"))
    rows = lambda *r: spark.createDataFrame(list(r), "doc_id string, payload string")
    got = summarize.assemble(rows(("a", final), ("b", final)), rows(("b", verify.replace('"issues": []', '"issues": [{"severity":"high","problem":"p","correction":"c"}]')))).orderBy("doc_id").collect()
    assert all("## Executive Summary" in r.markdown for r in got)
    assert "- [high] p -> c" in got[1].markdown and "Issues" not in got[0].markdown


def test_cache(spark, tmp_path):
    requests = spark.createDataFrame([("chunk", "a"), ("chunk", "b")], "stage string, payload string").select(src.cache_key(F.col("stage"), F.col("payload")).alias("key"))
    table = src.CacheTable(spark, str(tmp_path / "cache"))
    table.save(requests.limit(1).withColumn("payload", F.lit("{}")))
    assert table.missing(requests).count() == 1 and table.load(requests).where("payload is not null").count() == 1


def test_stage_outputs(spark, tmp_path):
    for name in ("b.json", "a.json", "a.template.json", "x.md"):
        (tmp_path / name).write_text("{}")
    assert [r.stem for r in src.read_stage_outputs(spark, str(tmp_path)).collect()] == ["a", "b"]
