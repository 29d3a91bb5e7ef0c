import pytest

import corpus_pipeline
from fieldtally.llm import simhash
from fieldtally.llm.oracle import ORACLE_SQL
from fieldtally.llm.queries import REGISTERED
from tests.compare import oracle_connection, oracle_rows, oracle_types, spark_rows, spark_types
from tests.llm.test_documents import check_packing

SF_DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_equals_sql(spark, name):
    connection, sql = oracle_connection(SF_DIR), ORACLE_SQL[name]
    found = REGISTERED[name](spark, SF_DIR)
    assert spark_rows(found) == oracle_rows(connection, sql)
    assert spark_types(found) == oracle_types(connection, sql)


@pytest.mark.parametrize("name", ["op2_language", "op4_toxicity", "op6_simhash", "op9_token_counts"])
def test_one_row_for_each_document(spark, name):
    ids = sorted(r["doc_id"] for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect())
    assert sorted(r["doc_id"] for r in REGISTERED[name](spark, SF_DIR).collect()) == ids


def test_pipeline(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before, docs = docs, stage(spark, docs, SF_DIR)
        assert docs.columns == columns
        docs.write.parquet(path := corpus_pipeline.run_folder(spark, "test"))
        docs = spark.read.parquet(path)
        if name == "toxicity":
            assert 0.8 * before.count() < docs.count() <= before.count()
        if name == "simhash_dedup":
            prints = [r["fp"] & (2**64 - 1) for r in simhash.fingerprints(docs).collect()]
            assert not any((a ^ b).bit_count() <= 2 for i, a in enumerate(prints) for b in prints[:i])
    rows = [(r["doc_id"], r["text"]) for r in docs.dropDuplicates(["doc_id"]).collect()]
    copies = docs.groupBy("doc_id").count().collect()
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, SF_DIR).collect()
    firsts = [p for p in pieces if p["piece"] == 0]
    assert len(firsts) == sum(r["count"] for r in copies) and {p["doc_id"] for p in pieces} == {i for i, _ in rows}
    single = docs.dropDuplicates(["doc_id"])
    check_packing(rows, corpus_pipeline.STAGES[-1][1](spark, single, SF_DIR).collect())
