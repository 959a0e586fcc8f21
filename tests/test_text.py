"""Goldens of the text functions, each value worked out by hand."""

import re

import pytest
from pyspark.sql import functions as F

from pageloom.functions import fixed, schemas, spelling, text as t


def values(spark, inputs, expression):
    rows = spark.createDataFrame(list(enumerate(inputs)), "i int, x string").orderBy("i").select(expression(F.col("x")).alias("y")).collect()
    return [r.y for r in rows]


def test_hash_marks(spark):
    got = values(spark, ["# T", "#T", "## T", "###T", "# # T", "\tx  ", "####### T"], t.normalize_line)
    assert got == ["# T", "# T", "# # T", "## # T", "# # T", "  x", "##### # # T"]


def test_repeat_keys(spark):
    got = values(spark, ["# Chapter 12", "did mild 3", "Ends here.", "a" * 81, "a" * 80, " ".join("ab" for _ in range(11)), "  ", "- 4. Page 9"], t.repeat_key)
    assert got == ["chapter <n>", "<r> <r> <n>", None, None, "a" * 80, None, None, "<n>. page <n>"]


def test_page_lines(spark):
    assert values(spark, ["Page 3", "page iv", "Page 3 of 4", " PAGE 12 "], t.is_page_line) == [True, True, False, True]


def test_characters(spark):
    got = values(spark, ["﻿a\xa0b", "â€™s", "â€“", "â€x", "ﬃ", "é"], spelling.repair_characters)
    assert got == ["a b", "’s", "–", '"x', "ffi", "é"]


def test_headings(spark):
    rows = values(spark, ["## Title", "Chapter one", "by Someone", "Index, 12", "A b | c", "WORDS IN CAPS", "plain words go on here and on", "# “quote", "## ABC"], t.heading_parts)
    assert [(r.is_heading, r.level, r.explicit) for r in rows] == [
        (True, 2, True), (True, 2, False), (False, None, False), (False, None, False), (False, None, False), (True, None, False), (False, None, False), (False, None, False),
        (False, None, False),
    ]


def test_titles(spark):
    assert values(spark, ["Chapter 3: The Fall", "12. Rise", " A  b "], t.title_key) == ["the fall", "rise", "a b"]
    assert values(spark, ["A: b!", "--", "Café x"], t.slugify) == ["a-b", "book", "caf-x"]
    assert values(spark, ["One. Two. ", "no end", ""], t.leading_sentence) == ["One.", "no end", ""]
    assert values(spark, ["", "abc", "a" * 9], t.token_estimate) == [0, 1, 2]


def test_case_folding(spark):
    texts = ["Straße", "ŉ ﬁx", "ΣΑΣ", "Iı", "İ", "ABC", "Été", "ſ"]
    assert values(spark, texts, t.casefold) == [x.casefold() for x in texts]
    assert values(spark, ["Chapter 2: Straße"], t.title_key) == ["strasse"]
    row = spark.createDataFrame([(["Straße", "STRASSE ", "x"],)], "v array<string>").select(t.distinct_in_order(F.col("v")).alias("d")).first()
    assert row.d == ["Straße", "x"]


def test_significant_tokens(spark):
    texts = ["Große STRASSE\tgroße  abc abcd", "ﬁnden İstanbul ſehr KelvinK ıabcd", "ÉTÉété\u2028with the 12345", "", "ﬁrst\xa0Ab12 AB12"]
    plain = [list(dict.fromkeys(w for w in re.findall("[a-z0-9]+", " ".join(x.split()).casefold()) if len(w) >= 4 and w not in fixed.GROUNDING_STOPWORDS)) for x in texts]
    assert values(spark, texts, t.significant_tokens) == plain


def test_repair_comes_before_composition(spark):
    from pageloom.plans import normalize

    lines = normalize.filtered_lines(spark.createDataFrame([("d", "caﬁ\u0301 \ufefftail")], "doc_id string, text string")).collect()
    assert [r.line for r in lines] == ["cafí tail"]


def test_kinds(spark):
    rows = spark.createDataFrame(
        [("Resources", "x"), ("Notes", "the method and a principle"), ("Life", "1901 1902 1903 and 1999"), ("Bonus", ""), ("Start", "preface words"), ("Other", "nothing")], "a string, b string"
    )
    got = [r.k for r in rows.select(t.section_kind(F.col("a"), F.col("b")).alias("k")).collect()]
    assert got == ["reference", "core_argument", "case_study", "endmatter", "framing", "mixed"]


def test_spacing(spark):
    got = values(spark, ["link- ed in", "pay pal grew", "http://a.com for", "He left.Then 12apples , ok"], spelling.repair_spacing)
    assert got == ["link-ed in", "paypal grew", "http://a.comfor", "He left. Then 12 apples, ok"]


def test_distinct_in_order(spark):
    row = spark.createDataFrame([(["b ", "A", "a", "", "B", "c"],)], "v array<string>").select(t.distinct_in_order(F.col("v")).alias("d")).first()
    assert row.d == ["b", "A", "c"]


def test_glued_words():
    known = spelling.Lexicon(["paypal", "naval"])
    assert known.split("thepaypal") == "the paypal"
    assert known.split("PAYPALAND") == "PAYPAL AND"
    assert known.split("unknownword") == "unknownword"
    assert known.knows("navals") and not known.knows("navy")
    assert known.split("Tothepaypal") == "To the Paypal"
    assert known.split("thepaypalof") == "the paypal of" and known.split("navalwith") == "naval with"
    made = spelling.Lexicon(["Make", "ox"])
    assert all(made.knows(w) for w in ("making", "makers", "make’s", "the-ox", "OX")) and not any(made.knows(w) for w in ("oxen", "oxs", "mak", "ox-cart"))


def test_cuts_against_a_plain_search():
    """The rank of cuts, against trying the shorter cuts first by hand: a stopword, then what is left."""
    import itertools
    import random

    known, stop = spelling.Lexicon(["paypal", "then", "here", "naval", "order"]), set(fixed.NORMALIZER_STOPWORDS)
    rng = random.Random(1)
    pool = [*known.words, *rng.sample(sorted(stop), 25), "zzz"]

    def shapes(low):
        for i in range(2, len(low) - 1):
            yield [(low[:i], low[i:])], "SK"
            yield [(low[:i], low[i:j], low[j:]) for j in range(i + 2, len(low) - 1)], "SSK|SKS"
            yield [(low[:i], low[i:])], "KS"

    def fits(parts, shape):
        return all((p in stop) if c == "S" else known.knows(p) for p, c in zip(parts, shape, strict=True))

    for size in (2, 3):
        for parts in itertools.islice(itertools.product(pool, repeat=size), 0, None, 7):
            token = "".join(parts)
            if 7 <= len(token) <= 22 and not known.knows(token):
                wanted = next((" ".join(c) for cuts, kinds in shapes(token) for c in cuts for k in kinds.split("|") if len(k) == len(c) and fits(c, k)), token)
                assert known.split(token) == wanted


def test_fragments():
    known = spelling.Lexicon(["paypal"])
    got = [spelling.joined(a, b, known) for a, b in (("", "x"), ("x", ""), ("the pay- ", " pal grew"), ("well-", "known"), ("see -", "3"), ("at www.a.com/", "b c"), ("the end.", "Next"), ("the end", "goes on"))]
    assert got == ["x", "x", "the paypal grew", "well-known", "see -3", "at www.a.com/b c", "the end.Next", "the end goes on"]


@pytest.mark.parametrize(
    ("change", "path"),
    [({"confidence": "unsure"}, "$.confidence"), ({"priority_weight": True}, "$.priority_weight"), ({"priority_weight": 6}, "$.priority_weight"), ({"extra": 1}, "$.extra"), ({"main_points": [1]}, "$.main_points[0]")],
)
def test_schema_errors(change, path):
    good = schemas.template(schemas.SCHEMAS["chunk"], choose=True)
    assert schemas.errors(good, schemas.SCHEMAS["chunk"]) == []
    assert [p for p, _ in schemas.errors(good | change, schemas.SCHEMAS["chunk"])] == [path]


def test_schema_shapes():
    assert schemas.errors([], schemas.SCHEMAS["final"]) == [("$", "expected object, got list")]
    legacy = schemas.template(schemas.SCHEMAS["chunk_legacy"], choose=True)
    assert [m for _, m in schemas.errors(legacy, schemas.SCHEMAS["chunk"])] == ["missing required property"] * 6
