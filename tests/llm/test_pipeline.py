import zlib
from collections import Counter

import numpy as np
import pytest

import corpus_pipeline
from newsloom.llm import quality
from newsloom.llm.queries import table, tokenizer_path

from . import test_decontaminate, test_jaccard, test_line_dedup
from .test_packing import check_packed, plain_ids

SF = "/root/testdata/sf0.001"


def test_stages_and_their_order():
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality", "lines", "near_copies", "decontaminate", "pack"]


def test_run_against_plain_stages(spark):
    pytest.importorskip("public_tokenizers")
    docs = table(spark, SF, "documents")
    model = quality.learn(quality.statistics_table(docs), table(spark, SF, "labels"))
    rows = [(r.doc_id, r.text) for r in docs.orderBy("doc_id").collect()]
    import pyarrow as pa

    scores = model.scores(quality.statistics_of(pa.array([t for _, t in rows])))
    assert 0 < np.sum(scores < 0.3) < 60
    rows = [r for r, s in zip(rows, scores) if s >= 0.3]
    rows = [(i, t) for i, t, n in test_line_dedup.plain(rows) if not n or t.split()]
    rows = [r for r, judged in zip(rows, test_jaccard.plain(rows)) if judged[0] == judged[3]]
    items = [(r.item_id, r.text) for r in table(spark, SF, "benchmark").collect()]
    rows = [r for r, judged in zip(rows, test_decontaminate.plain(rows, items)) if not judged[5]]
    expected = Counter()
    for i, t in rows:
        ids = plain_ids(tokenizer_path(), t)
        for at in range(0, len(ids), 4096):
            part = ids[at : at + 4096]
            expected[i, at // 4096, at, len(part), zlib.crc32(np.array(part, "<u4").tobytes())] += 1
    got = corpus_pipeline.run(spark, SF).collect()
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == expected
    check_packed(got, 4096)


def test_awkward_rows_pass_through_every_stage(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long, row string, lines string, node string, h long"
    plain = "these words are plain enough to stay in any corpus number"
    rows = [(i, f"{plain} {i} " + " ".join(f"w{i * 50 + k}" for k in range(30)), "en", None, None, "", "", "", 0) for i in range(40)]
    rows += [(100, None, None, None, None, None, None, None, None), (101, "", "", "", 0, "", "", "", 0), (None, "no id", "", "", 5, "", "", "", 0)]
    rows += [(102, "a long one " * 40_000, "", "", 0, "", "", "", 0), rows[0], rows[0]]
    docs = spark.createDataFrame(rows, schema)
    for name, stage in corpus_pipeline.STAGES:
        got = stage(spark, docs, SF)
        if name != "pack":
            assert got.columns == docs.columns and got.dtypes == docs.dtypes
        assert got.count() <= len(rows) or name == "pack"
        assert stage(spark, docs.limit(0), SF).collect() == []
