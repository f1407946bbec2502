import numpy as np
import pytest
from pyspark.sql import functions as F
from conftest import TESTDATA
from corpora import prepared  # noqa: F401

from accrual.llm.language_id import (
    codewords, drop_undetermined, held_out, identify_documents, predict_languages, train, training_rows,
)


def test_codewords_are_far_apart():
    for n in (2, 3, 4, 5, 12, 40):
        codes = codewords(n)
        assert len({tuple(r) for r in codes}) == n
        assert all(abs(column.sum()) < n for column in codes.T)
    apart = [(codewords(12)[i] != codewords(12)[j]).sum() for i in range(12) for j in range(i)]
    assert min(apart) >= 10


def test_held_out_accuracy(spark):
    documents = spark.read.parquet(str(TESTDATA / "sf0.01" / "documents.parquet"))
    out = identify_documents(documents, per_language=60).where("held_out")
    right, rows = out.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int")), F.count("*")).first()
    assert rows > 150 and right > 0.97
    assert out.where("score < 0 or score > 1 or lang_pred = 'und'").count() == 0


@pytest.fixture
def known(spark):
    words = {"aa": "abba baab abab ", "bb": "cddc dccd cdcd ", "cc": "effe feef efef "}
    rows = [(i, words[x] * (1 + i % 4), x) for i, x in enumerate(["aa", "bb", "cc"] * 20)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string")


def test_defined_results(spark, known):
    rows = [
        (1, "ABBA!", "x", 5), (2, None, "x", 5), (3, "", "x", 5), (4, "123 ... \n", "x", 5), (None, "dccd", "x", 5),
        (1, "ABBA!", "x", 5), (6, "effe " * 400_000, "x", 5),
    ]
    given = spark.createDataFrame(rows, "doc_id long, text string, lang_pred string, score int")
    model = train(training_rows(known, "text", "lang", F.lit(True), 1000))
    out = predict_languages(given, model)
    assert out.columns == ["doc_id", "text", "lang_pred", "score", "ambiguous"]
    got = sorted((r["doc_id"] or 0, r["lang_pred"]) for r in out.collect())
    assert got == [(0, "bb"), (1, "aa"), (1, "aa"), (2, "und"), (3, "und"), (4, "und"), (6, "cc")]
    mixed = spark.createDataFrame([("abba dccd",)], "text string")
    assert predict_languages(mixed, model).first()["score"] < 0.9


def test_nothing_to_learn_from(known):
    unlabelled = known.withColumn("lang", F.lit(None).cast("string"))
    out = identify_documents(unlabelled)
    assert {r["lang_pred"] for r in out.collect()} == {"und"}
    assert drop_undetermined(unlabelled).count() == 0
    assert identify_documents(known.limit(0)).count() == 0


def test_one_language(known):
    out = identify_documents(known.where("lang = 'aa'"))
    assert {(r["lang_pred"], r["score"]) for r in out.collect()} == {("aa", 1.0)}


def test_held_out_rows_and_labels_do_not_matter(known):
    wrong = known.withColumn("lang", F.when(held_out(F.col("doc_id")), "zz").otherwise(F.col("lang")))
    a, b = (
        {r["doc_id"]: (r["lang_pred"], r["score"]) for r in identify_documents(d).collect()} for d in (known, wrong)
    )
    assert a == b


def test_filter_keeps_columns(known):
    clashing = known.withColumns({"score": F.lit(7), "_found": F.lit("x")})
    out = drop_undetermined(clashing)
    assert out.columns == clashing.columns and out.count() == known.count()
    assert {(r["score"], r["_found"]) for r in out.collect()} == {(7, "x")}
    assert np.isfinite(codewords(1)).all()


def test_sample_does_not_depend_on_files(known):
    """Copies count once, and the same texts are drawn whatever the order and number of files."""
    many = known.withColumn("text", F.concat("text", F.md5(F.col("doc_id").cast("string"))))
    draw = lambda d: sorted(map(tuple, training_rows(d, "text", "lang", F.lit(True), 10).collect()))
    one = draw(many.coalesce(1))
    assert one == draw(many.repartition(7).union(many.orderBy(F.desc("doc_id")))) and 10 < len(one) < 55


def test_many_labels(spark):
    """Of 10 000 labels those with the most texts are learned, and a table of them trains at once."""
    dirty = spark.range(10_000).selectExpr("id AS doc_id", "concat('x', id) AS text", "concat('l', id) AS lang")
    clean = spark.range(400).selectExpr(
        "id AS doc_id", "concat(if(id % 2 = 0, 'abba baab ', 'effe feef '), chr(97 + id % 7)) AS text",
        "if(id % 2 = 0, 'aa', 'ee') AS lang",
    )
    rows = training_rows(clean.union(dirty), "text", "lang", F.lit(True), 1000, max_languages=2)
    assert {r["lang"] for r in rows.select("lang").distinct().collect()} == {"aa", "ee"}
    model = train(training_rows(clean.union(dirty), "text", "lang", F.lit(True), 1000))
    assert len(model.languages) == 256 and {"aa", "ee"} <= set(model.languages)


def test_filter_rejects_what_cannot_be_told(spark, known):
    rows = [(i, w * 40, x) for i, (w, x) in enumerate([("abba baab ", "aa"), ("cddc dccd ", "bb")] * 150)]
    mixed = [(1000, "abba baab " * 20 + "cddc dccd " * 20, None)]
    docs = spark.createDataFrame(rows + mixed, known.schema)
    kept = {r["doc_id"] for r in drop_undetermined(docs).collect()}
    assert kept == set(range(300))


def test_labels_that_are_the_same_language(spark, known):
    """Every row is ambiguous between two spellings of a label; the filter still keeps nearly all."""
    docs = spark.range(2000).selectExpr(
        "id AS doc_id", "concat('abba baab ', repeat(chr(97 + pmod(hash(id), 20)), 3 + pmod(hash(id, 1), 30))) AS text",
        "if(pmod(hash(id, 2), 2) = 0, 'en', 'EN') AS lang",
    )
    assert drop_undetermined(docs).count() > 1800
