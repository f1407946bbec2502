"""Ids of whole texts from a byte-level BPE tokenizer, each different word encoded once.

The tokenizers library splits a text by a rule, and the ids of a split do not depend on what stands
around it. So a worker splits texts itself, has the library's model encode the splits it has not seen
yet, and joins the ids from a bounded cache. The split follows Python's character classes; every
character that occurs is compared with the library's own class first, and a text with one that differs,
or with an added token, goes to the library whole. Other kinds of tokenizers always do.
"""

from __future__ import annotations

import functools
import json
import os
import re
import sys
from array import array
from collections.abc import Iterator

import numpy as np

from accrual.llm.bpe_transducer import byte_letters

MAX_WORDS = 300_000
LONGEST_WORD = 64
SEGMENT = 1 << 20

# The rule by which byte-level BPE splits, in Python's character classes.
SPLIT = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?[^\W\d_]+| ?\d+| ?(?:[^\s\w]|_)+|\s+(?!\S)|\s+")
_KINDS = [("a", re.compile(r"[^\W\d_]")), ("1", re.compile(r"\d")), ("!", re.compile(r"[^\s\w]|_"))]
# No split reaches over the place between another character and white space.
_EDGE = re.compile(r"(?<=\S)\s")


class _Words(dict):
    """Ids of splits; a missing one is encoded, and kept unless it is long."""

    def __init__(self, model):
        super().__init__()
        self.model = model
        self.letters = byte_letters()

    def __missing__(self, word: str) -> bytes:
        spelled = word.encode().decode("latin-1").translate(self.letters)
        ids = array("I", [t.id for t in self.model.tokenize(spelled)])
        if sys.byteorder == "big":
            ids.byteswap()
        found = ids.tobytes()
        if len(word) <= LONGEST_WORD:
            self[word] = found
        return found


class WordIds:
    """Ids of texts as little-endian unsigned 32-bit numbers, as the library gives them without added
    special tokens, padding or truncation."""

    def __init__(self, serial: str):
        # Spark runs as many workers as there are cores.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_str(serial)
        self.library.no_padding()
        self.library.no_truncation()
        said = json.loads(serial)
        before, model = said.get("pre_tokenizer") or {}, said.get("model") or {}
        self.splits = (
            before.get("type") == "ByteLevel"
            and not before.get("add_prefix_space")
            and before.get("use_regex", True)
            and said.get("normalizer") is None
            and model.get("type") == "BPE"
            and not model.get("dropout")
        )
        self.added = [t["content"] for t in said.get("added_tokens") or []]
        self.known: dict[str, bool] = {}
        self.words = _Words(self.library.model)

    def _same_kind(self, char: str) -> bool:
        """Whether the library puts ``char`` into the class that ``SPLIT`` puts it into."""
        split = self.library.pre_tokenizer.pre_tokenize_str
        theirs = [len(split(first + char)) == 1 for first, _ in _KINDS]
        ours = [bool(kind.match(char)) for _, kind in _KINDS]
        return theirs == ours

    def _plain(self, text: str) -> bool:
        """Whether ``text`` can be split here."""
        if not self.splits or any(token in text for token in self.added):
            return False
        chars = set(text)
        for char in chars.difference(self.known):
            self.known[char] = self._same_kind(char)
        return all(map(self.known.__getitem__, chars))

    def _segments(self, text: str) -> Iterator[str]:
        """``text`` in parts of about ``SEGMENT`` characters that split as the whole does."""
        at = 0
        while len(text) - at > SEGMENT:
            edge = _EDGE.search(text, at + SEGMENT)
            if edge is None:
                break
            yield text[at : edge.start()]
            at = edge.start()
        yield text[at:] if at else text

    def _joined(self, segment: str) -> bytes:
        """Ids of a text that can be split, from the cache."""
        return b"".join(map(self.words.__getitem__, SPLIT.findall(segment)))

    def encode(self, text: str) -> bytes:
        """The ids of one whole text."""
        if not self._plain(text):
            found = self.library.encode(text, add_special_tokens=False).ids
            return np.array(found, dtype="<u4").tobytes()
        parts = []
        for segment in self._segments(text):
            if len(self.words) > MAX_WORDS:
                self.words.clear()
            parts.append(self._joined(segment))
        return b"".join(parts)


@functools.lru_cache(maxsize=1)
def word_ids(serial: str) -> WordIds:
    """The worker's encoder; its words are kept from task to task."""
    return WordIds(serial)
