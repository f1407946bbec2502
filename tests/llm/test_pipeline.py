from brute import components, jaccard_links, shingles
from conftest import TESTDATA
from pyspark.sql import functions as F
from corpora import documents, prepared, texts  # noqa: F401

import corpus_pipeline
from accrual.llm.queries import callables, oracles


def test_registration():
    import __spark_entry__ as driver

    names = set(driver.queries())
    assert {n.split("_")[0] for n in callables()} == {f"op{i}" for i in range(1, 14)}
    assert set(callables()) | {"pipeline"} <= names and set(oracles()) <= set(driver.oracle_sql())


def test_whole_pipeline(spark, monkeypatch):
    """Every stage is checked on what its predecessor kept."""
    seen, sf = {}, str(TESTDATA / "sf0.001")
    keep = corpus_pipeline.stored
    monkeypatch.setattr(corpus_pipeline, "stored", lambda df, name: seen.setdefault(name, keep(df, name)))
    out = corpus_pipeline.run(spark, sf)
    documents = spark.read.parquet(f"{sf}/documents.parquet")
    language, jaccard, clean, tokens = list(seen.values())
    assert [d.columns for d in (language, jaccard, clean)] == [documents.columns] * 3
    assert language.count() == documents.where(F.col("text").rlike(r"\p{L}")).count()
    rows = language.select("doc_id", "text").collect()
    roots = components([r["doc_id"] for r in rows], jaccard_links([r["text"] for r in rows], percent=80, words=5))
    want = {c if shingles(r["text"]) else r["doc_id"] for r, c in zip(rows, roots)}
    assert {r["doc_id"] for r in jaccard.collect()} == want
    assert 0 < clean.count() < jaccard.count()
    assert out.count() == clean.count() == tokens.count() and out.where("round_trip").count() == out.count()


def test_stages_keep_odd_rows(spark, documents):
    """NULLs, repeats and clashing columns go through every stage."""
    docs = documents.withColumn("n_chars", F.lit(1).cast("long"))
    sf = str(TESTDATA / "sf0.001")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, docs, sf)
        assert after.columns == docs.columns
        docs = after
    assert corpus_pipeline.STAGES[-1][1](spark, docs, sf).count() == docs.count()
