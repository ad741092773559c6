"""The pipeline's stages, on documents and on odd rows."""

import duckdb
import pytest
from pyspark.sql import functions as F

import corpus_pipeline as C
from llm.cases import ODD
from parley.llm.common import shared_path, written
from parley.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


def test_stage_list():
    assert [n for n, _ in C.STAGES] == ["quality rules", "quality classifier", "simhash near-dedup", "substring dedup", "packing"]


def test_run_equals_the_stages_one_by_one(spark):
    docs = spark.read.parquet(SF + "/documents.parquet")
    counts = []
    for name, stage in C.STAGES:
        out = written(stage(spark, docs, SF), "stage-test")
        if name != "packing":
            assert out.columns == docs.columns and dict(out.dtypes) == dict(docs.dtypes)
            texts = {r.doc_id: r.text for r in docs.collect()}
            for r in out.collect():
                if name != "substring dedup":
                    assert r.text == texts[r.doc_id]
                else:
                    assert r.n_chars == len(r.text) and set(r.text.split()) <= set(texts[r.doc_id].split())
        counts.append(out.count())
        docs = out
    assert counts[0] < 200 and counts[2] <= counts[1] <= counts[0] and counts[3] == counts[2]
    got = C.run(spark, SF)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, docs.collect()))


@pytest.fixture(scope="module")
def odd_tables(spark, odd):
    path = shared_path(spark, "odd-tables")
    odd.write.parquet(path + "/documents.parquet")
    spark.createDataFrame([(8, 0, 0), (4, 1, 0), (None, 1, None)], "doc_id bigint, quality int, toxic int").write.parquet(path + "/labels.parquet")
    return path


def test_stages_take_odd_rows(spark, odd, odd_tables):
    for name, stage in C.STAGES:
        out = stage(spark, odd, odd_tables).collect()
        assert name in ("quality rules", "quality classifier", "simhash near-dedup") or out
        if name == "substring dedup":
            assert len(out) == len(ODD)
        assert stage(spark, odd.where("false"), odd_tables).count() == 0


def test_empty_tables_run_through(spark, odd_tables, odd):
    path = shared_path(spark, "empty-tables")
    odd.where("false").write.parquet(path + "/documents.parquet")
    spark.read.parquet(odd_tables + "/labels.parquet").where("false").write.parquet(path + "/labels.parquet")
    assert C.run(spark, path).count() == 0


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_oracles(spark, name):
    con = duckdb.connect()
    for t in ("documents", "conversations", "embeddings"):
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    got, want = QUERIES[name](spark, SF), con.execute(ORACLES[name])
    columns = [d[0] for d in want.description]
    assert sorted(got.columns) == sorted(columns)
    assert sorted(map(tuple, got.select(*columns).collect())) == sorted(want.fetchall())


def test_every_operator_has_a_query():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


def test_queries_return_one_row_each(spark):
    n = spark.read.parquet(SF + "/documents.parquet").count()
    for name in ("op3_bpe", "op6_quality_classifier", "op7_document_fingerprints", "op9_quality_rules"):
        out = QUERIES[name](spark, SF)
        assert out.count() == n and out.select("doc_id").distinct().count() == n
    assert QUERIES["op5_warc"](spark, SF).where(F.col("record_type") == "response").count() > 0
