import random

import pytest
from tokenizers import Tokenizer
from corpora import documents, nothing, prepared, texts  # noqa: F401

from accrual.llm.bpe_transducer import Transducer, count_tokens, read_tokenizer


@pytest.fixture(scope="module")
def serial():
    return read_tokenizer()


def strings(number):
    dice = random.Random(5)
    parts = [
        *"aàre'stmdlvI  \n\t 1٣中你。!#é’ 　\u0085", "the", " lower", "'re", "'ve", "'ll", "\r\n", "   ", "😀", "<|endoftext|>",
        "<|", "|>", "'S", "don't", " 2024", "\x00", "\x1c",
    ]
    return ["".join(dice.choice(parts) for _ in range(dice.randint(0, 40))) for _ in range(number)]


def test_every_text_as_the_library_counts(serial):
    library, machine = Tokenizer.from_str(serial), Transducer(serial, max_states=500)
    texts = [*strings(3000), "", "a" * 3000, " " * 3000, "'" * 50]
    want = [len(e.ids) for e in library.encode_batch(texts, add_special_tokens=False)]
    assert [machine.count(t) for t in texts] == want


def test_chunk_maps_compose_in_any_order(serial):
    machine, dice = Transducer(serial), random.Random(6)
    for text in strings(400):
        cuts = sorted(dice.randint(0, len(text)) for _ in range(5))
        chunks = [text[a:b] for a, b in zip([0, *cuts], [*cuts, len(text)])]
        maps = [machine.map_of(c) for c in chunks]
        want = machine.count(text)
        assert machine.total(maps) == want
        right = maps[-1]
        for m in reversed(maps[:-1]):
            right = machine.compose(m, right)
        assert machine.total([right]) == want


def test_documents(spark, documents, serial):
    library = Tokenizer.from_str(serial)
    rows = documents.select("doc_id", "text").collect()
    want = []
    for r in rows:
        text = r["text"] or ""
        n = len(library.encode(text, add_special_tokens=False).ids)
        want.append((r["doc_id"], len(text.encode()), n, n > 512))
    for chunk in (1 << 16, 11):
        got = [tuple(r) for r in count_tokens(documents, serial, chunk=chunk).collect()]
        assert sorted(got, key=repr) == sorted(want, key=repr)


def test_empty(nothing, serial):
    assert count_tokens(nothing, serial).count() == 0


def test_other_tokenizers_are_refused():
    import public_tokenizers

    with open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8") as file:
        with pytest.raises(ValueError):
            Transducer(file.read())
