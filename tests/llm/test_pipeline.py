import duckdb
import pytest

import corpus_pipeline
from meterlake.llm.catalog import QUERIES, SQL
from tests.conftest import SF_SMALL
from tools.check_oracle import TABLES, digest


@pytest.mark.parametrize("key", sorted(SQL))
def test_sql(spark, key):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    df = QUERIES[key](spark, SF_SMALL)
    rel = con.execute(SQL[key])
    cols = [d[0] for d in rel.description]
    assert digest(df.columns, [tuple(r) for r in df.collect()])[0] == digest(cols, rel.fetchall())[0]


def test_every_operator_has_a_query():
    assert sorted(int(k[2:].split("_")[0]) for k in QUERIES) == list(range(1, 11))
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "near duplicates", "repeats", "decontamination", "tokens"]


def test_stages(spark, odd_docs, no_docs, workdir):
    odd_docs.write.parquet(f"{workdir}/documents.parquet")
    spark.createDataFrame([(1, 1, 0), (12, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{workdir}/labels.parquet")
    spark.createDataFrame([(1, "one")], "item_id long, text string").write.parquet(f"{workdir}/benchmark.parquet")
    docs = odd_docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        new = stage(spark, docs, workdir)
        assert new.columns == docs.columns
        new.write.parquet(f"{workdir}/{name.replace(' ', '-')}")
        docs = spark.read.parquet(f"{workdir}/{name.replace(' ', '-')}")
        assert all(r["n_chars"] == len(r["text"]) for r in docs.collect() if r["text"] is not None)
        assert stage(spark, no_docs, workdir).count() == 0
    whole = corpus_pipeline.run(spark, workdir)
    assert whole.count() == docs.count()
    assert {r["doc_id"]: r["n_tokens"] for r in whole.collect()}[5] == 0
