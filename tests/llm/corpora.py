"""Fixtures that the tests of the corpus operators share; each test module imports those it uses."""

import random

import pytest

from accrual.llm.common import ready


@pytest.fixture(autouse=True)
def prepared(spark):
    ready(spark)


@pytest.fixture(scope="session")
def texts():
    """Texts with copies, near copies, long ones, and ones without words."""
    dice = random.Random(3)
    vocabulary = [f"w{i}" for i in range(60)] + ["é" * 3, "ß", "The", "of"]
    made = [" ".join(dice.choice(vocabulary) for _ in range(dice.randint(1, 60))) for _ in range(30)]
    base = [dice.choice(vocabulary) for _ in range(90)]
    for _ in range(14):  # near copies, of which some are too far apart
        words = list(base)
        for _ in range(dice.randint(0, 4)):
            words[dice.randrange(len(words))] = f"new{dice.randint(0, 99)}"
        made.append(" ".join(words))
    made += [made[0], made[0].upper(), made[31], "", " \t\n ", "one", "One", "two words", "x " * 30_000]
    return made


@pytest.fixture(scope="session")
def documents(spark, texts):
    """``texts`` as documents, with NULLs, repeated rows and columns whose names clash."""
    rows = [(i, t, "en" if i % 2 else "de", f"s{i % 3}", 1, "x") for i, t in enumerate(texts)]
    rows += [(900, None, "en", None, 2, None), (None, texts[3], None, "s", 3, None), rows[5], rows[5]]
    return spark.createDataFrame(
        rows, "doc_id long, text string, lang string, source string, score int, _h string"
    ).repartition(3)


@pytest.fixture(scope="session")
def nothing(documents):
    return documents.limit(0)
