"""The corpus pipeline: every stage on what its predecessor kept, against
brute force, and on odd rows."""

import re
from collections import Counter

import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from driftwood.llm import langid
from llm_rows import ODD, SF_SMALL, docs_of
from test_near import jaccard_links, line_removals, paragraph_removals, roots, shingles, without_spans
from test_tokens import JSON, check_packing

STAGE = dict(corpus_pipeline.STAGES)


@pytest.fixture(scope="module")
def steps(spark, tmp_path_factory):
    """Input and output of each stage over the small tables."""
    docs, out = spark.read.parquet(f"{SF_SMALL}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path_factory.mktemp("stage") / name)
        stage(spark, docs, SF_SMALL).write.parquet(path)
        new = spark.read.parquet(path)
        out.append((docs, new))
        docs = new
    return dict(zip(STAGE, out))


def texts(frame):
    return sorted((r["doc_id"], r["text"]) for r in frame.collect())


def test_stages_are_as_asked(steps):
    assert list(STAGE) == ["language_id", "line_dedup", "near_copies", "paragraph_dedup", "packing"]
    for name, (old, new) in steps.items():
        if name != "packing":
            assert new.columns == old.columns
            assert new.where("n_chars <> length(text)").count() == 0


def test_language_stage_keeps_clean_documents(steps):
    old, new = steps["language_id"]
    gone = old.join(new, "doc_id", "left_anti").collect()
    assert len(gone) <= 0.02 * old.count()
    assert all(len(r["text"].split()) < 5 for r in gone)


def test_line_stage(spark, steps):
    old, new = (texts(f) for f in steps["line_dedup"])
    gone, _ = line_removals(spark, old)
    want = []
    for i, t in old:
        kept = "\n".join(x for k, x in enumerate(t.split("\n")) if (i, k) not in gone)
        if kept == t or re.search(r"[^\W_]", kept):
            want.append((i, kept))
    assert new == want


def test_near_copy_stage(steps):
    old, new = (texts(f) for f in steps["near_copies"])
    sets = {i: shingles(re.findall(r"\w+", t.lower())) for i, t in old}
    root = roots(list(sets), jaccard_links(sets))
    assert new == [(i, t) for i, t in old if root[i] == i]


def test_paragraph_stage(steps):
    old, new = (texts(f) for f in steps["paragraph_dedup"])
    gone, _ = paragraph_removals(old)
    want = []
    for i, t in old:
        kept = without_spans(t, gone.get(i, []))
        if kept == t or re.search(r"[^\W_]", kept):
            want.append((i, kept))
    assert new == want


def test_packing_stage(steps):
    old, new = steps["packing"]
    library = Tokenizer.from_file(JSON)
    library.encode_special_tokens = True
    check_packing(texts(old), new.collect(), library)


def test_odd_rows_through_all_stages(spark, tmp_path):
    odd = ODD + [(20 + i, " ".join(f"word{i}x{k * k}" for k in range(14))) for i in range(5)]
    (docs_of(spark, odd).drop("line", "node", "key").write.parquet(str(tmp_path / "documents.parquet")))
    rows = corpus_pipeline.run(spark, str(tmp_path)).collect()
    kept = Counter(r["doc_id"] for r in rows if r["piece"] == 0)
    assert kept[None] == 1 and kept[4] == 1 and all(kept[i] == 1 for i in (6, 8, 20, 21, 22, 23, 24))
    assert not any(kept[i] for i in (1, 2, 3, 5, 7))
    docs_of(spark, []).drop("line", "node", "key").write.parquet(str(tmp_path / "empty/documents.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path / "empty")).count() == 0


def test_rejection_takes_effect(spark):
    docs = docs_of(spark, ODD)
    kept = STAGE["language_id"](spark, docs, "")
    assert kept.columns == docs.columns and {r["doc_id"] for r in kept.collect()} == {None, 4, 5, 6, 8}
    none = langid.accepted(docs.withColumn("lang", F.lit(None).cast("string")),
                           langid.train(docs.withColumn("lang", F.lit(None).cast("string"))))
    assert none.count() == 0
