"""Language identification with error-correcting output codes.

Every language gets a codeword of bits. For each bit one binary classifier over hashed byte trigrams
of the letters of a text says which side of the bit the text is on: the weight of a trigram is the
log odds of seeing it in languages whose bit is 1 rather than 0 (each language counts the same), and the
margin is the mean weight. Decoding adds up, over the bits, a logistic loss of the margin against each
language's codeword, weighted by how reliable the bit is for that language on the training rows; the
nearest codeword wins. Where the runner-up is almost as near, the row is flagged as ambiguous.

Training needs two small aggregates: trigram counts per language and correct bits per language. Both
come from a sample of about ``per_language`` different texts of each label, chosen by a hash of the text:
copies count once, and the order and files of the rows do not matter. At most ``max_languages`` labels are
learned, those with the most texts, which bounds the model whatever a dirty label column holds.
Prediction is one pass without a shuffle, over whole texts.

A filter rejects a text if the lead of its best language is below ``AMBIGUOUS`` and also below that of all
but a share ``DOUBTED`` of the training rows. So labels that cannot be told apart, such as two spellings of
one language, do not empty a corpus.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from accrual.llm.common import free_name, release_memory, scratch, stored

BITS = 16
BINS = 1 << BITS
PER_LANGUAGE = 10_000
MAX_LANGUAGES = 256
SEED = 7
UNDETERMINED = "und"
PIECE = 1 << 18
DRAWS = 1 << 30
AMBIGUOUS = 0.1
DOUBTED = 0.01


@dataclass
class Model:
    languages: list[str]
    codes: np.ndarray  # languages x bits, +1 or -1
    weights: np.ndarray  # bins x bits
    scale: np.ndarray  # typical size of each bit's margin
    reliability: np.ndarray  # languages x bits, each row adds up to 1
    doubt: float = AMBIGUOUS  # a lead below it is too small to tell the language


def codewords(languages: int, seed: int = 7) -> np.ndarray:
    """All distinct splits of up to five languages; random balanced ones for more."""
    if languages < 2:
        return np.ones((languages, 0))
    if languages <= 5:
        rest = list(itertools.product((1, -1), repeat=languages - 1))[1:]
        return np.array([(1, *bits) for bits in rest], dtype=np.float64).T
    columns: list[tuple] = []
    random = np.random.default_rng(seed)
    wanted = math.ceil(10 * math.log2(languages))
    while len(columns) < wanted:
        side = np.where(random.permutation(languages) % 2, 1.0, -1.0)
        if tuple(side) not in columns and tuple(-side) not in columns:
            columns.append(tuple(side))
    return np.array(columns).T


def letters(text: Column) -> Column:
    """Lower-cased letters of ``text``, each run of anything else as one space."""
    return F.regexp_replace(F.lower(text), r"\P{L}+", " ")


def _pieces(texts) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Hashed trigrams of consecutive texts, about ``PIECE`` at a time: (row numbers, bins).

    A text longer than that comes in several pieces; together they have all its trigrams.
    """
    rows, parts, held = [], [], 0
    for row, text in enumerate(texts):
        data = np.frombuffer(f" {text} ".encode(), dtype=np.uint8)
        for at in range(0, max(1, len(data) - 2), PIECE):
            part = data[at : at + PIECE + 2].astype(np.uint32)
            if len(part) < 3:
                continue
            code = (part[:-2] << np.uint32(16)) | (part[1:-1] << np.uint32(8)) | part[2:]
            parts.append((code * np.uint32(2654435761)) >> np.uint32(32 - BITS))
            rows.append((row, len(code)))
            held += len(code)
            if held >= PIECE:
                yield _joined(rows, parts)
                rows, parts, held = [], [], 0
    if parts:
        yield _joined(rows, parts)


def _joined(rows, parts):
    return np.repeat([r for r, _ in rows], [n for _, n in rows]), np.concatenate(parts)


def _counts(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Trigram counts of each language among the rows of one task."""
    total: dict[str, np.ndarray] = {}
    for frame in frames:
        for language, group in frame.groupby("lang"):
            held = total.setdefault(language, np.zeros(BINS, dtype=np.int64))
            for _, bins in _pieces(group["text"]):
                held += np.bincount(bins, minlength=BINS)
    for language, counts in total.items():
        seen = np.flatnonzero(counts)
        yield pd.DataFrame({"lang": language, "bin": seen, "n": counts[seen]})


def _margins(texts, weights: np.ndarray) -> np.ndarray:
    sums = np.zeros((len(texts), weights.shape[1]))
    number = np.zeros(len(texts))
    for rows, bins in _pieces(texts):
        starts = np.flatnonzero(np.diff(rows, prepend=-1))
        owner = rows[starts]
        sums[owner] += np.add.reduceat(weights[bins], starts, axis=0, dtype=np.float64)
        number[owner] += np.diff(np.append(starts, len(rows)))
    return sums / np.maximum(number, 1)[:, None]


def _bit_weights(counts: np.ndarray, codes: np.ndarray) -> np.ndarray:
    share = counts / np.maximum(counts.sum(axis=1, keepdims=True), 1)
    columns = []
    for code in codes.T:
        sides = [share[code == s].mean(axis=0) + 1e-6 for s in (1, -1)]
        columns.append(np.log(sides[0]) - np.log(sides[1]))
    return np.array(columns, dtype=np.float32).T.reshape(counts.shape[1], -1)


def training_rows(
    documents: DataFrame,
    text: str,
    lang: str,
    allowed: Column,
    per_language: int,
    max_languages: int = MAX_LANGUAGES,
) -> DataFrame:
    """``text`` (its letters) and ``lang``: different texts of each label, about ``per_language`` at most.

    Texts are drawn by their hash, so equal tables give equal samples in whatever files they lie. Of more
    than ``max_languages`` labels those with the most texts are kept (by an estimate that does not depend
    on the order of rows either), ties by label; the others are not learned.
    """
    usable = allowed & F.col(lang).isNotNull() & F.col(text).isNotNull()
    labelled = documents.where(usable).select(
        F.col(text).alias("text"), F.col(lang).alias("lang"), F.xxhash64(F.lit(SEED), text).alias("_hash")
    )
    counts = labelled.groupBy("lang").agg(F.approx_count_distinct("_hash").alias("_texts"))
    most = counts.orderBy(F.desc("_texts"), "lang").limit(max_languages).collect()
    if not most:
        return labelled.select(letters(F.col("text")).alias("text"), "lang").limit(0)
    steps = {r["lang"]: math.ceil(DRAWS * min(1.0, per_language / r["_texts"])) for r in most}
    step = F.create_map(*(F.lit(x) for pair in steps.items() for x in pair))[F.col("lang")]
    drawn = labelled.where(F.pmod("_hash", F.lit(DRAWS)) < step)
    return drawn.select(letters(F.col("text")).alias("text"), "lang").distinct()


def train(rows: DataFrame) -> Model:
    """Fit on ``text`` and ``lang``; nothing else is read. No rows give a model without languages."""
    found = rows.mapInPandas(_counts, "lang string, bin long, n long")
    found = found.groupBy("lang", "bin").agg(F.sum("n").alias("n")).toPandas()
    languages = sorted(found["lang"].unique())
    counts = np.zeros((len(languages), BINS))
    counts[[languages.index(x) for x in found["lang"]], found["bin"].to_numpy(dtype=int)] = found["n"]
    codes = codewords(len(languages))
    weights = _bit_weights(counts, codes)
    bits = codes.shape[1]
    sizes, right = np.zeros(bits), np.ones((len(languages), bits))
    if bits:

        def judge(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for frame in frames:
                margins = _margins(frame["text"], weights)
                target = codes[[languages.index(x) for x in frame["lang"]]]
                judged = pd.DataFrame({"lang": np.repeat(frame["lang"].to_numpy(), bits)})
                judged["bit"] = np.tile(np.arange(bits), len(frame))
                judged["ok"] = (margins * target > 0).ravel().astype(float)
                judged["size"] = np.abs(margins).ravel()
                judged["n"] = 1
                yield judged.groupby(["lang", "bit"], as_index=False).sum()

        schema = "lang string, bit long, ok double, size double, n long"
        sums = rows.mapInPandas(judge, schema).groupBy("lang", "bit")
        for r in sums.agg(*(F.sum(c).alias(c) for c in ("ok", "size", "n"))).collect():
            right[languages.index(r["lang"]), r["bit"]] = (r["ok"] + 1) / (r["n"] + 2)
            sizes[r["bit"]] += r["size"] / r["n"] / len(languages)
    reliability = right / np.maximum(right.sum(axis=1, keepdims=True), 1e-9)
    model = Model(languages, codes, weights, np.maximum(np.round(sizes, 4), 1e-4), reliability)
    if bits:

        def leads(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for frame in frames:
                yield pd.DataFrame({"lead": decode(_margins(frame["text"], weights), model)[2]})

        least = rows.mapInPandas(leads, "lead double").agg(F.percentile("lead", F.lit(DOUBTED))).first()[0]
        model = replace(model, doubt=min(AMBIGUOUS, least))
    return model


def decode(margins: np.ndarray, model: Model) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Best language of each row, its score from 0 to 1, and its lead over the runner-up."""
    agreement = (margins / model.scale)[:, None, :] * model.codes[None]
    loss = (np.log1p(np.exp(-np.clip(4 * agreement, -50, 50))) * model.reliability[None]).sum(axis=2)
    odds = np.exp(-4 * (loss - loss.min(axis=1, keepdims=True)))
    odds /= odds.sum(axis=1, keepdims=True)
    best = odds.argmax(axis=1)
    ordered = np.sort(odds, axis=1)
    lead = ordered[:, -1] - (ordered[:, -2] if odds.shape[1] > 1 else 0)
    return best, odds[np.arange(len(best)), best], lead


FOUND = "struct<lang_pred:string,score:double,ambiguous:boolean,lead:double>"


def language_of(model: Model, text: Column) -> Column:
    """The prediction for ``text`` as a struct: ``lang_pred``, ``score``, ``ambiguous`` and ``lead``."""
    values = {"lang_pred": UNDETERMINED, "score": 0.0, "ambiguous": False, "lead": 0.0}
    unknown = F.struct(*(F.lit(v).alias(c) for c, v in values.items()))
    if not model.languages:
        return unknown

    @F.pandas_udf(FOUND)
    def identify(texts: pd.Series) -> pd.DataFrame:
        known = texts.notna().to_numpy()
        result = pd.DataFrame(values, index=range(len(texts)))
        if known.any():
            best, score, lead = decode(_margins(texts[known].tolist(), model.weights), model)
            result.loc[known, "lang_pred"] = [model.languages[i] for i in best]
            result.loc[known, "score"] = score
            result.loc[known, "ambiguous"] = lead < AMBIGUOUS
            result.loc[known, "lead"] = lead
        release_memory()
        return result

    return identify(F.when(text.rlike(r"\p{L}"), letters(text)))


def predict_languages(documents: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``documents`` with ``lang_pred``, ``score`` and ``ambiguous`` (columns so named are replaced).

    A NULL text, one without a letter, or a model without languages gives ``und`` with score 0. Texts
    are read whole, equal texts get equal results.
    """
    made = ["lang_pred", "score", "ambiguous"]
    kept = documents.drop(*made)
    out = free_name(kept, "_found")
    found = kept.withColumn(out, language_of(model, F.col(text)))
    return found.select(*kept.columns, *(F.col(out)[c].alias(c) for c in made))


def held_out(doc_id: Column) -> Column:
    """Rows that training never sees: CRC-32 of the id as text leaves 2 when divided by 4."""
    return F.crc32(doc_id.cast("string")) % 4 == 2


def train_on_documents(
    documents: DataFrame, per_language: int = PER_LANGUAGE, max_languages: int = MAX_LANGUAGES
) -> Model:
    """A model of the labelled rows that are not held out; rows without an id are not used."""
    allowed = ~held_out(F.col("doc_id"))
    with scratch(documents.sparkSession):
        rows = training_rows(documents, "text", "lang", allowed, per_language, max_languages)
        return train(stored(rows, "languages"))


def identify_documents(documents: DataFrame, per_language: int = PER_LANGUAGE) -> DataFrame:
    """``documents`` with ``held_out`` (false without an id) and what ``predict_languages`` adds."""
    model = train_on_documents(documents, per_language)
    marked = documents.withColumn("held_out", F.coalesce(held_out(F.col("doc_id")), F.lit(False)))
    return predict_languages(marked, model)


def drop_undetermined(
    documents: DataFrame, per_language: int = PER_LANGUAGE, unlabelled: str = "drop"
) -> DataFrame:
    """The rows of ``documents`` whose language can be told, with their columns as they were.

    Texts without a letter go, and so do those whose best language leads by less than the model's
    ``doubt``, such as texts half in one language and half in another. If no row teaches a language,
    nothing can be told and all rows go; ``unlabelled="keep"`` then keeps those that have a letter.
    """
    model = train_on_documents(documents, per_language)
    if unlabelled == "keep" and not model.languages:
        return documents.where(F.col("text").rlike(r"\p{L}"))
    name = free_name(documents, "_found")
    found = documents.withColumn(name, language_of(model, F.col("text")))
    told = (F.col(name)["lang_pred"] != UNDETERMINED) & (F.col(name)["lead"] >= model.doubt)
    return found.where(told).drop(name)
