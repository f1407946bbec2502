import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer
from test_tokens import strings

from accrual.llm import word_ids
from accrual.llm.bpe_transducer import read_tokenizer
from accrual.llm.word_ids import WordIds


def library_ids(serial, texts):
    library = Tokenizer.from_str(serial)
    return [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]


def ids_of(encoder, texts):
    return [[int.from_bytes(b[i : i + 4], "little") for i in range(0, len(b), 4)] for b in map(encoder.encode, texts)]


@pytest.fixture(scope="module")
def serial():
    return read_tokenizer()


def test_every_text_as_the_library_encodes(serial):
    texts = [*strings(3000), "", "a" * 3000, " " * 3000, "'" * 50, "x²y Ⅷ ½", "a_b __c 1_2"]
    assert ids_of(WordIds(serial), texts) == library_ids(serial, texts)


def test_all_characters(serial):
    """Those that Python sees otherwise than the library, too."""
    dice = random.Random(1)
    chars = [chr(c) for c in range(0x3000) if not 0xD800 <= c < 0xE000] + [chr(c) for c in range(0x1F300, 0x1F700)]
    texts = ["".join(f"{dice.choice(['a', '1', '!', ' ', ''])}{c}{c}" for c in chars[i : i + 40]) for i in range(0, len(chars), 40)]
    encoder = WordIds(serial)
    assert ids_of(encoder, texts) == library_ids(serial, texts)
    assert not all(encoder.known.values())


def test_segments_and_a_small_cache(serial, monkeypatch):
    texts = strings(300)
    long = " ".join(texts).replace("<|endoftext|>", "")
    monkeypatch.setattr(word_ids, "SEGMENT", 50)
    monkeypatch.setattr(word_ids, "MAX_WORDS", 20)
    assert ids_of(WordIds(serial), [long, *texts]) == library_ids(serial, [long, *texts])


def test_other_tokenizers_go_to_the_library():
    with open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8") as file:
        serial = file.read()
    assert ids_of(WordIds(serial), ["Two words", ""]) == library_ids(serial, ["Two words", ""])
