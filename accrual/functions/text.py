"""Free-text predicates."""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Condition wordings that name no diagnosis.
NON_DIAGNOSTIC_TERMS = [
    "Healthy",
    "Healthy Volunteers",
    "Healthy Volunteer",
    "Healthy Subjects",
    "Healthy Participants",
    "Healthy Aging",
    "Aging",
    "Pregnancy",
    "Pharmacokinetics",
    "Bioequivalence",
    "Anesthesia",
    "General Anesthesia",
    "Nerve Block",
    "Contraception",
]
# Fixed value: marks city names that are not place names.
DIRTY_CITY_PATTERN = r"\d|^'s-|\(|\?"


def any_term(
    texts: Column | str,
    terms: Iterable[str] = NON_DIAGNOSTIC_TERMS,
    whole_word: bool = False,
) -> Column:
    """True when any element of a string array holds any of the terms, ignoring case.

    Substring matching by default, so ``Aging`` also fires on ``Imaging``;
    ``whole_word`` needs word boundaries. NULL arrays and NULL elements count as no match.
    """
    texts = F.col(texts) if isinstance(texts, str) else texts
    terms = list(dict.fromkeys(term.lower() for term in terms))
    if not whole_word:
        # A text that holds the longer term holds the shorter one inside it too.
        terms = [t for t in terms if not any(other != t and other in t for other in terms)]
    body = "|".join(re.escape(term) for term in terms)
    pattern = rf"(?i)\b({body})\b" if whole_word else f"(?i)({body})"
    return F.coalesce(F.exists(texts, lambda text: text.rlike(pattern)), F.lit(False))


def is_usable_facility(name: Column | str, placeholder: str = "UNKNOWN FACILITY") -> Column:
    """False for NULL, blank and placeholder facility names."""
    trimmed = F.trim(F.col(name) if isinstance(name, str) else name)
    return trimmed.isNotNull() & (trimmed != "") & (F.upper(trimmed) != placeholder)


def clean_name(name: Column | str, dirty: str = DIRTY_CITY_PATTERN) -> Column:
    """True for a name that does not match the dirty-name pattern."""
    return ~(F.col(name) if isinstance(name, str) else name).rlike(dirty)
