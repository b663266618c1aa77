"""Operator 1: held-out accuracy, calibration bounds and edge rows."""

from pyspark.sql import functions as F

from driftwood.llm import langid
from driftwood.llm.queries import QUERIES
from llm_rows import ODD, SF_SMALL, docs_of


def test_held_out_accuracy(spark):
    out = QUERIES["op1_language_id"](spark, SF_SMALL)
    truth = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "lang")
    rows = out.join(truth, "doc_id").where("held_out").collect()
    assert len(rows) > 40
    assert sum(r["lang"] == r["lang_pred"] for r in rows) / len(rows) >= 0.97
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_label_and_source_of_a_held_out_row_do_not_matter(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    model = langid.train(docs.where("doc_id % 3 <> 1"), sample_per_lang=20, rounds=1)
    one = langid.predict(docs, model).orderBy("doc_id").collect()
    two = langid.predict(docs.withColumn("lang", F.lit("xx")), model).orderBy("doc_id").collect()
    assert one == two


def test_odd_rows(spark):
    docs = docs_of(spark, ODD)
    model = langid.train(docs)
    assert model.langs == ["en"]
    got = langid.predict(docs, model, keep=("line",)).collect()
    assert len(got) == len(ODD)
    assert {r["doc_id"] for r in got if r["lang_pred"] == "und"} == {1, 2, 3, 7}
    assert all(r["score"] == 0 for r in got if r["lang_pred"] == "und")
    kept = langid.accepted(docs, model)
    assert kept.columns == docs.columns and kept.count() == len(ODD) - 4


def test_nothing_to_learn_from(spark):
    docs = docs_of(spark, [(1, "words")], lang=None)
    assert langid.predict(docs, langid.train(docs)).first()["lang_pred"] == "und"
    assert langid.predict(docs.limit(0), langid.train(docs.limit(0))).count() == 0


def test_sparse_weights_and_long_texts():
    at, n = langid.counts("ab" * 700_000)  # longer than a counting step
    assert n.sum() == 3 * 1_400_000 - 3 and len(at) <= 6
