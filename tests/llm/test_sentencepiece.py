import random
import struct
import subprocess

import pytest
import sentencepiece
from corpora import documents, nothing, prepared, texts  # noqa: F401

from accrual.llm.common import release_memory
from accrual.llm.sentencepiece_backend import (
    BYTE, CONTROL, NORMAL, UNKNOWN, _batches, build, comes_back, decode_ids, encode_texts, parse_model, read_model, spellings, verify_parity,
)


@pytest.fixture(scope="module")
def model():
    return read_model()


def strings(number):
    dice = random.Random(8)
    parts = ["the ", "a", "  ", "é", "ß", "\n", "\t", "你", "😀", "▁", "12", "###", "<s>", "tion", "\x00", "ment ", "'", " "]
    return ["".join(dice.choice(parts) for _ in range(dice.randint(0, 40))) for _ in range(number)]


def test_parity_with_the_library(model, texts):
    verify_parity(model, build(parse_model(model)), [*strings(1500), *texts])


def _field(number, value):
    def varint(n):
        out = b""
        while n > 127:
            out, n = out + bytes([n & 127 | 128]), n >> 7
        return out + bytes([n])

    if isinstance(value, bytes):
        return varint(number << 3 | 2) + varint(len(value)) + value
    if isinstance(value, float):
        return varint(number << 3 | 5) + struct.pack("<f", value)
    return varint(number << 3) + varint(value)


def unigram_model(fallback):
    """A hand-made unigram model file."""
    pieces = [("<unk>", 0.0, UNKNOWN), ("<s>", 0.0, CONTROL), ("</s>", 0.0, CONTROL)]
    if fallback:
        pieces += [(f"<0x{b:02X}>", 0.0, BYTE) for b in range(256)]
    words = {"▁": -2.0, "▁the": -3.0, "th": -4.5, "e": -3.5, "t": -5.0, "h": -5.5, "tion": -4.0, "▁a": -3.3, "a": -4.2, "n": -4.4, "nt": -4.6}
    pieces += [(p, s, NORMAL) for p, s in words.items()]
    body = b"".join(
        _field(1, _field(1, p.encode()) + _field(2, s) + _field(3, k)) for p, s, k in pieces
    )
    trainer = _field(3, 1) + _field(35, int(fallback))
    return body + _field(2, trainer) + _field(3, _field(1, b"identity") + _field(3, 1) + _field(4, 0) + _field(5, 1))


@pytest.mark.parametrize("fallback", [True, False])
def test_unigram_models(fallback):
    data = unigram_model(fallback)
    spec = parse_model(data)
    assert (spec.model_type, spec.byte_fallback) == (1, fallback)
    assert sentencepiece.SentencePieceProcessor(model_proto=data).get_piece_size() == len(spec.pieces)
    texts = ["the ant", "then a tion", "", "a  the", "hat", "than than"]
    verify_parity(data, build(spec), [*texts, "é ß"] if fallback else texts)


def test_wrong_tokenizers_are_found(model):
    spec = parse_model(model)
    spec.add_dummy_prefix = False
    with pytest.raises(ValueError):
        verify_parity(model, build(spec))


def test_documents_round_trip(documents, model):
    library = sentencepiece.SentencePieceProcessor(model_proto=model)
    rows = documents.collect()
    encoded = encode_texts(documents, model)
    assert encoded.columns == [*documents.columns, "n_tokens", "ids_sha256", "round_trip", "ids"]
    back = decode_ids(encoded, model).collect()
    key = lambda r: (repr(r["doc_id"]), r["text"] or "")
    for given, got in zip(sorted(rows, key=key), sorted(back, key=key), strict=True):
        assert got["ids"] == library.encode(given["text"] or "")
        assert got["n_tokens"] == len(got["ids"]) and got["round_trip"]
        assert got["decoded"] == (given["text"] or "") and got["score"] == given["score"]


def test_empty(nothing, model):
    assert encode_texts(nothing, model).count() == 0


class _Counting:
    """A tokenizer that counts how many texts the library decodes."""

    def __init__(self, tokenizer):
        self.tokenizer, self.decoded = tokenizer, 0

    def decode(self, ids, **options):
        self.decoded += 1
        return self.tokenizer.decode(ids, **options)


def test_round_trip_without_decoding(model, texts):
    """The same answer as the library's, which decodes only texts that do not come back."""
    tokenizer = build(parse_model(model), own_ids=True)
    spelled, given = spellings(tokenizer), ["", "  a", "line\nline", "mark ▁", "é😀\x00", *strings(500), *texts]
    for text in given:
        ids = tokenizer.encode(text, add_special_tokens=False).ids
        counted = _Counting(tokenizer)
        want = tokenizer.decode(ids, skip_special_tokens=False) == text
        assert comes_back(text, ids, spelled, counted, True) == want
        assert counted.decoded == (0 if want else 1)
    assert not comes_back("é", [spelled.index(b"\xc3")], spelled, tokenizer, True)
    assert comes_back("\ufffd", [spelled.index(b"\xc3")], spelled, tokenizer, True)


def test_texts_are_encoded_a_few_at_a_time():
    """Runs are made as texts are read, are far smaller than a batch of rows, and hold every text in order."""
    texts = [str(i) * 500 for i in range(1000, 2000)]
    read = []
    runs = _batches(read.append(t) or t for t in texts)
    first = next(runs)
    assert len(read) == len(first) < 200
    assert first + [t for run in runs for t in run] == texts
    assert [len(run) for run in _batches(["x" * 3_000_000, "", "a"])] == [1, 2]


def test_giving_memory_back_starts_no_process(monkeypatch):
    def refuse(*given, **options):
        raise AssertionError(given)

    monkeypatch.setattr(subprocess, "Popen", refuse)
    release_memory()
