"""What the stages of the pipeline must keep and drop, row by row."""

from brute import components, shingles
from conftest import TESTDATA
from corpora import prepared  # noqa: F401

import corpus_pipeline

SF = str(TESTDATA / "sf0.001")
COLUMNS = "doc_id long, text string, lang string, source string"


def links(texts, words=5, percent=80):
    sets = [shingles(t, words) for t in texts]
    return [
        (i, j)
        for i in range(len(sets))
        for j in range(i)
        if sets[i] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j])
    ]


def changed(words, *places):
    return " ".join(f"new{i}" if i in places else w for i, w in enumerate(words))


def test_near_duplicates_of_five_words(spark):
    """Four isolated words of 200 leave 176 of 216 5-word n-grams (and 186 of 210 3-word ones)."""
    base = [f"w{i}" for i in range(200)]
    texts = [
        " ".join(base), changed(base, 30, 70, 110, 150), changed(base, 20, 50, 80, 110, 140, 170), "one two", "One  two",
    ]
    docs = spark.createDataFrame([(i, t, "en", "s") for i, t in enumerate(texts)], COLUMNS)
    assert (1, 0) in links(texts) and (1, 0) not in links(texts, 3, 90)
    got = sorted(r["doc_id"] for r in corpus_pipeline.deduplicate(spark, docs, SF).collect())
    assert got == sorted(set(components(list(range(len(texts))), links(texts)))) == [0, 2, 3]


def test_near_duplicates_of_given_documents(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet")
    kept = {r["doc_id"] for r in corpus_pipeline.deduplicate(spark, rows, SF).collect()}
    rows = rows.select("doc_id", "text").collect()
    roots = components([r["doc_id"] for r in rows], links([r["text"] for r in rows]))
    assert kept == {c if shingles(r["text"], 5) else r["doc_id"] for r, c in zip(rows, roots)}


def test_contaminated_rows_take_no_others_with_them(spark, monkeypatch):
    """Rows that share an id with a contaminated row, or have none like it, are judged by their own text."""
    item, clean = " ".join(f"b{i}" for i in range(20)), "c " * 30
    rows = [
        (None, item, None, "a"), (None, clean, "en", None), (None, None, "en", "b"), (None, "", None, None),
        (1, item, "en", "c"), (1, clean, "de", "d"), (1, None, "de", "e"), (2, clean, "de", "f"), (2, clean, "de", "f"),
        (3, clean + item, "en", "g"),
    ]
    benchmark = spark.createDataFrame([(1, item)], "item_id long, text string")
    monkeypatch.setattr(corpus_pipeline, "table", lambda *_: benchmark)
    docs = spark.createDataFrame([(*r, 1, "x") for r in rows], COLUMNS + ", _hash int, _id string").repartition(3)
    out = corpus_pipeline.decontaminate(spark, docs, SF)
    assert out.columns == docs.columns
    want = [(*r, 1, "x") for r in rows if item not in (r[1] or "")]
    assert sorted(map(tuple, out.collect()), key=repr) == sorted(want, key=repr)


def test_documents_without_labels_stay(spark):
    rows = [(1, "one text", None, "s"), (2, "été", None, None), (None, "three", None, "s"), (4, "12 34", None, "s"), (5, None, None, "s")]
    docs = spark.createDataFrame(rows, COLUMNS)
    out = corpus_pipeline.identify_language(spark, docs, SF)
    assert out.columns == docs.columns
    assert sorted(map(tuple, out.collect()), key=repr) == sorted(rows[:3], key=repr)
