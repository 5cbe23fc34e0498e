"""The registered queries: SQL where there is some, and the pipeline's stages."""

import importlib
import re
import sys

import duckdb
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from ecoflux.llm import decontaminate, oracle, queries
from ecoflux.llm.common import table
from tests.llm import brute

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", oracle.ORACLE_SQL)
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "embeddings", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    rel = con.sql(oracle.ORACLE_SQL[name])
    got = queries.QUERIES[name](spark, SF)
    cols = sorted(got.columns)
    assert cols == sorted(rel.columns)
    key = lambda r: tuple(map(str, r))
    mine = sorted((tuple(r[c] for c in cols) for r in got.collect()), key=key)
    order = [rel.columns.index(c) for c in cols]
    assert mine == sorted((tuple(r[i] for i in order) for r in rel.fetchall()), key=key)


def test_one_query_for_each_operator():
    assert sorted(int(re.match(r"op(\d+)_", n)[1]) for n in queries.QUERIES) == list(range(1, 14))


def test_queries_without_sql_equal_brute_force(spark):
    rows = [(r.doc_id, r.text) for r in table(spark, SF, "documents").collect()]
    fps = {i: brute.fingerprint(t) for i, t in rows}
    names = brute.components(fps)
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in queries.op6_simhash(spark, SF).collect()}
    assert got == {i: (format(fps[i], "016x"), names[i]) for i in fps}


@pytest.mark.parametrize("sf, least", [("/root/testdata/sf0.01", 0.98)])
def test_classifiers_on_held_out_rows(spark, sf, least):
    docs, labels = table(spark, sf, "documents"), table(spark, sf, "labels")
    lang = queries.op8_language_id(spark, sf).join(docs.select("doc_id", "lang"), "doc_id").where("held_out")
    assert lang.agg(F.avg((F.col("lang_pred") == F.col("lang")).cast("int"))).first()[0] >= least
    good = queries.op2_quality(spark, sf).join(labels, "doc_id").where("held_out")
    assert good.agg(F.avg((F.col("predicted") == F.col("quality")).cast("int"))).first()[0] >= 0.95


def test_pipeline_stage_by_stage(spark, tmp_root):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "line_dedup", "near_dedup", "decontamination", "mixing"]
    docs = table(spark, SF, "documents")
    seen = [docs]
    for n, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, seen[-1], SF).write.parquet(f"{tmp_root}/{n}")
        seen.append(spark.read.parquet(f"{tmp_root}/{n}"))
    assert all(x.dtypes == docs.dtypes for x in seen[:-1])
    rows = [[(r.doc_id, r.text) for r in x.collect()] for x in seen]
    assert len(rows[1]) == len(rows[0])  # every text of these has a known language
    assert dict(rows[2]) == {i: kept for i, (_, _, kept) in brute.lines(rows[1]).items()}
    assert {i for i, _ in rows[3]} == set(brute.components({i: brute.fingerprint(t) for i, t in rows[2]}).values())
    items = [(r.item_id, r.text) for r in table(spark, SF, "benchmark").collect()]
    assert {i for i, _ in rows[4]} == {i for i, w in brute.leaks(rows[3], items).items() if not w[1]}
    assert sorted(i for i, _ in rows[5]) == sorted(i for i, _ in rows[4]) and seen[5].where("taken > 3 * size").isEmpty()
    assert decontaminate.hits(seen[4], table(spark, SF, "benchmark")).isEmpty()
    assert corpus_pipeline.run(spark, SF).count() == len(rows[5])


def test_stages_take_an_empty_table(spark):
    docs = table(spark, SF, "documents").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, SF).count() == 0


def test_entry_works_without_the_subpackage(monkeypatch):
    import __spark_entry__ as entry

    assert "pipeline" in entry.queries() and "op9_line_dedup" in entry.oracle_sql()

    class Gone:
        def find_spec(self, name, path=None, target=None):
            if name == "corpus_pipeline" or name.startswith("ecoflux.llm"):
                raise ModuleNotFoundError(f"No module named {name!r}", name=name)

    for m in [m for m in sys.modules if m == "corpus_pipeline" or m.startswith("ecoflux.llm")]:
        monkeypatch.delitem(sys.modules, m)
    monkeypatch.delattr(importlib.import_module("ecoflux"), "llm", raising=False)
    monkeypatch.setattr(sys, "meta_path", [Gone(), *sys.meta_path])
    assert "pipeline" not in entry.queries() and "op9_line_dedup" not in entry.oracle_sql() and "dim_plant" in entry.queries()
