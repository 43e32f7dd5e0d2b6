"""The pipeline's stages each do their part; queries and SQL are registered."""

import __spark_entry__ as entry
import corpus_pipeline
from tests.conftest import DATA


def test_stages_in_order(spark):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "near_dedup", "decontamination", "pii", "packing"]
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    columns, sizes = docs.columns, [docs.count()]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, DATA)
        assert docs.columns == columns
        sizes.append(docs.count())
    assert sizes == sorted(sizes, reverse=True) and sizes[-1] > 0.8 * sizes[0]


def test_run_gives_whole_documents(spark):
    rows = corpus_pipeline.run(spark, DATA).select("doc_id", "length", "doc_tokens").collect()
    total: dict = {}
    for r in rows:
        total.setdefault(r["doc_id"], [0, r["doc_tokens"]])[0] += r["length"]
    assert total and all(a == b for a, b in total.values())


def test_registered():
    names = set(entry.queries())
    assert {n.split("_")[0] for n in names if n.startswith("op")} == {f"op{i}" for i in range(1, 11)} and "pipeline" in names
    assert set(entry.oracle_sql()) <= names
