"""Lines of op2 by what separates their words."""

import corpus_pipeline
from newsloom.llm import line_dedup as L

from .test_line_dedup import near

SCHEMA = "doc_id long, text string"


def kept(spark, *texts):
    docs = spark.createDataFrame([*enumerate(texts)], SCHEMA)
    return [r.text for r in L.dedup_lines(docs).orderBy("doc_id").collect()]


def test_words_are_runs_of_non_blank_characters(spark):
    first = "all the words of this line"
    again = ["  all the   words of this line", "all\tthe\twords\tof\tthis\tline", "all the words of this line \r", "all the words \f\x0b of this line here"]
    assert kept(spark, first, *again) == [first, "", "", "", ""]


def test_tabs_alone_separate_words(spark):
    row = "name\tprice\tcolour\tsize\tweight"
    assert kept(spark, row + "\nx", row) == [row + "\nx", ""]


def test_blanks_are_no_words(spark):
    texts = ["    a b", "a     b", "      ", "\t\t\t\t\t\t", "      "]
    assert kept(spark, "a\n" + texts[0], *texts[1:])[2:] == texts[2:]


def test_short_lines_go_if_equal(spark):
    got = kept(spark, "All rights reserved.\n漢字漢字\n\nMenu", "All rights  reserved.\nAll rights reserved\n\n漢字漢字\n漢字字字\nMenu")
    assert got == ["All rights reserved.\n漢字漢字\n\nMenu", "All rights reserved\n\n漢字字字"]


def test_short_lines_are_near_none(spark):
    texts = ["a b c d", "a b c x", "a b c d e", "a b c d f", "a b c"]
    assert kept(spark, *texts) == ["a b c d", "a b c x", "a b c d e", "", "a b c"]


def test_pipeline_stage_removes_short_repeats(spark):
    docs = spark.createDataFrame([(0, "Menu\nfirst"), (1, "Menu\nsecond"), (2, "Menu")], SCHEMA)
    left = corpus_pipeline.without_repeated_lines(spark, docs, "")
    assert sorted(tuple(r) for r in left.collect()) == [(0, "Menu\nfirst"), (1, "second")]


def test_given_documents_against_all_pairs(spark):
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()]
    lines = [((i, n), tuple(x.split())) for i, t in sorted(rows) for n, x in enumerate((t or "").split("\n"))]
    first = {}
    for place, ws in lines:
        first.setdefault(ws, place)
    long = [ws for ws in first if len(ws) >= L.MIN_WORDS]
    gone = {a for a in long for b in long if first[b] < first[a] and abs(len(a) - len(b)) < 2 and near(a, b)}
    expected = {place for place, ws in lines if ws and (first[ws] != place or ws in gone)}
    got = L.repeated_lines(spark.createDataFrame(rows, SCHEMA)).select("doc_id", "line_no").collect()
    assert {tuple(r) for r in got} == expected
    assert sum(len(ws) < L.MIN_WORDS for place, ws in lines if place in expected) > 50
