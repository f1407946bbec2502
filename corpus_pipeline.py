"""The corpus pipeline: language, near duplicates, benchmark decontamination, tokens.

Each stage takes (spark, docs, sf_dir) and decides about every row of ``docs``; ``run`` writes its
result to the shared folder and gives it to the next. All but the last return the columns of
``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from accrual.llm.common import ready, stored, table
from accrual.llm.decontaminate import drop_contaminated_rows
from accrual.llm.jaccard_join import drop_near_duplicates
from accrual.llm.language_id import drop_undetermined
from accrual.llm.sentencepiece_backend import encode_texts, read_model


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can be told; those without a text or a letter go, and those in doubt.

    In doubt is a text whose best language leads by less than 0.1 and by less than 99 % of the training
    texts. If no document has a label, all that have a letter stay. An empty table stays empty.
    """
    ready(spark)
    return drop_undetermined(docs, unlabelled="keep")


def deduplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: sets of 5-word n-grams, Jaccard of 0.8 or more.

    Documents without words or text are nobody's duplicates and stay; so do rows without an id that have
    no duplicate. An empty table stays empty.
    """
    ready(spark)
    return drop_near_duplicates(docs, percent=80, words=5)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated by the benchmark; each row is judged by its own text."""
    return drop_contaminated_rows(docs, table(ready(spark), sf_dir, "benchmark"))


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, and whether decoding gives its text back.

    A NULL or empty text has no ids; every row, repeated or without an id, gives one row, and texts of any
    length are read whole. An empty table gives no rows. Further columns are left out.
    """
    ready(spark)
    return encode_texts(docs.select("doc_id", "lang", "source", "text"), read_model(), keep_text=False)


STAGES = [
    ("language identification", identify_language),
    ("n-gram jaccard join", deduplicate),
    ("benchmark decontamination", decontaminate),
    ("sentencepiece encoding", tokenize),
]

# A trained language model and a tokenizer cannot be expressed in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(ready(spark), sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
