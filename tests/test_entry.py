"""Driver contract: entry() runs, every query has a name-compatible oracle
or is a declared rows-only query, and every oracle agrees at sf0.001."""

import os
import re
import sys

import duckdb

import __spark_entry__ as E

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(__file__)), "tools"))
from check_oracle import TABLES, digest  # noqa: E402

from conftest import SF_SMALL

ROWS_ONLY = {"device_iforest"}


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["msisdn", "domain", "duration_sec", "fdr_count", "kbps",
                          "is_audio", "is_video"]
    assert df.count() >= 0


def test_every_query_has_an_oracle():
    own = {q for q in E.queries() if q != "pipeline" and not re.match(r"op\d+_", q)}  # without the corpus package's
    assert own - set(E.oracle_sql()) == ROWS_ONLY
    assert set(E.oracle_sql()) <= set(E.queries())


def test_other_queries_survive_a_corpus_package_that_cannot_be_imported(monkeypatch):
    for name in [m for m in sys.modules if m == "corpus_pipeline" or m.startswith("driftwood.llm")]:
        monkeypatch.delitem(sys.modules, name)
    import driftwood
    monkeypatch.delattr(driftwood, "llm", raising=False)
    monkeypatch.setitem(sys.modules, "public_tokenizers", None)
    found = E.queries()
    assert "calls_bitrate" in found and "pipeline" not in found and not any(q.startswith("op1") for q in found)
    assert set(E.oracle_sql()) <= set(found)


def test_oracles_agree_on_small_tables(spark):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    bad = []
    for name, sql in sorted(E.oracle_sql().items()):
        sdf = E.queries()[name](spark, SF_SMALL)
        srows = [tuple(r) for r in sdf.collect()]
        res = con.execute(sql)
        dcols = [d[0] for d in res.description]
        drows = res.fetchall()
        if sorted(sdf.columns) != sorted(dcols) or digest(sdf.columns, srows)[0] != digest(dcols, drows)[0]:
            bad.append(name)
    assert bad == []
