"""Documents in pieces give what the same documents give in one text, and no task is sent a whole document."""

import pytest
from pyspark.sql import functions as F

from pageloom.operators import blocks, lines, packets, sections
from pageloom.plans import fixtures, normalize
from pageloom.sources import markdown as src

PIECES = {
    "a": [
        "intro\n\n# Book\n\n## Contents\n- Alpha", "\n- Beta", "\n## Alpha\n\nA text that\n\ngoes on and", "\non with more.\n\n### Deep\r", "\nRunning 1\n\nPage 1", "\nRunning 2\n\nwell-", "\nknown words\n\nPage 2",
        "\n#### Low\n\nRunning 3", "\nRunning 4\n\n• a • b", "\n## Beta\n\n" + "w" * 900 + "\n\n" + "v" * 900, "\n## Index\n\n## Gone", "\n## Also gone\n\nlast",
    ],
    "b": ["", "\n\n", "\n  "],
    "c": ["# Contents\n\n# One", "\n# Two", "\n# Three\n\ntext", "\n# Contents", "\n# Four"],
}


@pytest.fixture(scope="module")
def whole(spark):
    return spark.createDataFrame([(d, "\n".join(p)) for d, p in PIECES.items()], "doc_id string, text string")


@pytest.fixture(scope="module")
def cut(spark):
    return spark.createDataFrame([(d, k, x) for d, p in PIECES.items() for k, x in enumerate(p)], "doc_id string, piece int, text string").repartition(5)


def rows(df, *columns):
    return sorted(map(str, (df.select(*columns) if columns else df.drop("piece")).collect()))


def test_sections_and_packets(whole, cut):
    for found in (sections.headings, sections.book_titles, sections.contents_titles, sections.heading_skips, sections.sections):
        assert rows(found(cut)) == rows(found(whole)), found
    columns = ("doc_id", "packet_id", "chapter_title", "section_labels", "raw_text", "token_estimate")
    assert rows(packets.packets(sections.sections(cut), 100, 150), *columns) == rows(packets.packets(sections.sections(whole), 100, 150), *columns)
    assert len({r.raw_text for r in sections.sections(cut).where("title = 'Alpha'").collect()}) == 1


def test_boilerplate(whole, cut):
    columns = ("doc_id", "line", "removed")
    assert rows(lines.mark_boilerplate(src.read_lines(cut)), *columns) == rows(lines.mark_boilerplate(src.read_lines(whole)), *columns)


def test_blocks(whole, cut):
    raw = blocks.raw_blocks(src.read_lines(whole))
    assert rows(blocks.text_blocks(cut), "doc_id", "block_no", "lines") == rows(raw)
    assert rows(blocks.raw_blocks(src.read_lines(cut)), "doc_id", "block_no", "lines") == rows(raw)
    ours, theirs = blocks.classify(blocks.text_blocks(cut)), blocks.classify(raw)
    for change in (blocks.demote_contextual, blocks.demote_for_rendering, blocks.merge_paragraphs, blocks.normalize_heading_levels, blocks.contents_to_list, blocks.demote_backmatter):
        assert rows(change(ours)) == rows(change(theirs)), change


def test_normalize(whole, cut):
    assert rows(normalize.normalize(cut)) == rows(normalize.normalize(whole))
    assert rows(normalize.file_summary(cut), "doc_id", "changed", "output_lines", "input_lines", "removed_repeats", "blocks", "headings", "heading_skips") == rows(
        normalize.file_summary(whole), "doc_id", "changed", "output_lines", "input_lines", "removed_repeats", "blocks", "headings", "heading_skips"
    )


def test_an_unchanged_text_is_told_from_one_of_the_same_length(spark):
    same, other = ["# A\n\nOne.", "\n# B\n\nTwo.\n"], ["# A\n\n*\tx", "\nTwo.\n"]
    cut = spark.createDataFrame([(d, k, x) for d, p in (("s", same), ("o", other)) for k, x in enumerate(p)], "doc_id string, piece int, text string")
    got = {r.doc_id: r.changed for r in normalize.file_summary(cut).collect()}
    assert got == {"s": False, "o": True}


def test_books_come_in_pieces(spark, tmp_path):
    docs = [(k, f"t{k}\nu", "s0" if k % 3 else "s1") for k in range(30)] + [(7, "again", "s0"), (99, None, "s0"), (None, "x", "s1")]
    spark.createDataFrame(docs, "doc_id long, text string, source string").repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    got = fixtures.markdown(spark, str(tmp_path), noise=True)
    assert got.groupBy("doc_id").count().where("count > 5").count() == 2
    text = {d: "\n".join(x for _, x in sorted(p)) for d, p in ((r.doc_id, r.p) for r in got.groupBy("doc_id").agg(F.collect_list(F.struct("piece", "text")).alias("p")).collect())}
    ids = sorted(d for d, _, s in docs if s == "s0")
    assert text["s0"].startswith("# Book s0\n\n## Chapter 1: Doc 1\n\nt1\n\nu\n\nRunning Head s0\n\nPage 1\n\n## Chapter 2: Doc 2\n\nt2")
    assert text["s0"].count("Running Head s0") == len(ids) - 1 and f"Page {len(ids) - 1}" in text["s0"]
    # Row 1 of s1 has no doc_id, so no heading: the book begins with row 2.
    assert text["s1"].startswith("## Chapter 2: Doc 0\n\nt0")


def test_many_headings(spark):
    n = 60_000
    heads = spark.range(n).select(F.lit("d").alias("doc_id"), F.col("id").alias("block_no"), F.lit("x").alias("text"), (F.col("id") % 4 + 1).cast("int").alias("level"), F.lit(True).alias("explicit"))
    got = blocks.heading_levels(heads.repartition(7)).groupBy("level").count().collect()
    assert {r.level: r["count"] for r in got} == {1: 1, 2: n // 2 - 1, 3: n // 4, 4: n // 4}


def test_batches_to_python_are_bounded(spark, tmp_path):
    from pageloom.plans import registry

    spark.createDataFrame([(1, "é a")], "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    for name in ("nfc_text", "fix_spacing"):
        spark.conf.unset("spark.sql.execution.arrow.maxBytesPerBatch")
        assert registry.QUERIES[name](spark, str(tmp_path)).count() == 1
        assert int(spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch")) == 8 << 20
