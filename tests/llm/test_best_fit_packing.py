import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from corpora import documents, nothing, prepared, texts  # noqa: F401
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from accrual.llm.best_fit_packing import (
    best_fit_slots, cuts_of, pack_documents, packed_sequences, plan_groups, runs_of, token_pieces,
)
from accrual.llm.bpe_transducer import read_tokenizer


@pytest.fixture(scope="module")
def serial():
    return read_tokenizer()


def best_fit(lengths, capacity):
    """Best fit decreasing, piece by piece: the contents of every sequence."""
    made = []
    for length in sorted(lengths, reverse=True):
        room = [capacity - sum(m) for m in made]
        fits = [i for i, r in enumerate(room) if r >= length]
        if fits:
            made[min(fits, key=lambda i: room[i])].append(length)
        else:
            made.append([length])
    return made


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(1, 30), max_size=120))
def test_plan_is_best_fit_decreasing(lengths):
    groups = plan_groups(dict(Counter(lengths)), 30)
    planned = Counter()
    for g in groups:
        assert 30 - g.room == sum(length * times for length, times, _ in g.parts)
        planned[g.room] += g.many
    # Which of equally full sequences comes first is free, and changes nothing that follows.
    assert planned == Counter(30 - sum(m) for m in best_fit(lengths, 30))
    slots = Counter()
    for length, low, high, _, _, _ in runs_of(groups):
        slots[length] += high - low
    assert slots == Counter(lengths)


def test_plan_does_not_grow_with_the_counts():
    dice = random.Random(2)
    counts = {length: dice.randint(1, 10**9) for length in range(1, 1025)}
    groups = plan_groups(counts)
    assert len(groups) <= 4 * 1024 and len(runs_of(groups)) < 180_000
    total = sum(length * n for length, n in counts.items())
    assert sum(g.many for g in groups) <= 1.03 * total / 1024


@pytest.mark.parametrize("length, want", [(1, [1]), (10, [10]), (11, [1, 10]), (20, [10, 10]), (25, [5, 10, 10])])
def test_cuts(length, want):
    cuts = cuts_of(length, 10)
    assert [b - a for a, b in cuts] == want and cuts[0][0] == 0 and cuts[-1][1] == length


def test_lengths_beyond_the_capacity_are_refused():
    with pytest.raises(ValueError):
        plan_groups({31: 1}, 30)


def test_hot_lengths_get_every_place_once(spark):
    """A third of the pieces have one length, and equal rows stay apart."""
    dice = random.Random(9)
    rows = [(i, 1 if i % 3 == 0 else dice.randint(1, 40), "x", 5) for i in range(3000)] + [(7, 9, "x", 5)] * 3
    df = spark.createDataFrame(rows, "id long, length int, _slice string, offset int").repartition(13)
    got = best_fit_slots(df, "length", 40).collect()
    places = defaultdict(list)
    for r in got:
        assert r["_slice"] == "x"
        places[r["sequence_id"]].append((r["offset"], r["length"]))
    assert Counter((r["id"], r["length"]) for r in got) == Counter((r[0], r[1]) for r in rows)
    assert sorted(places) == list(range(len(places)))
    for parts in places.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 40
    assert len(places) == len(best_fit([r[1] for r in rows], 40))


@pytest.mark.parametrize("capacity", [1024, 16])
def test_documents(spark, documents, serial, capacity):
    library = Tokenizer.from_str(serial)
    want = Counter()
    for r in documents.collect():
        ids = np.array([*library.encode(r["text"] or "", add_special_tokens=False).ids, 2], dtype="<u4")
        for piece, (a, b) in enumerate(cuts_of(len(ids), capacity)):
            want[r["doc_id"], piece, a, b - a, zlib.crc32(ids[a:b].tobytes())] += 1
    got = pack_documents(documents, serial, capacity).collect()
    assert Counter(tuple(r)[:5] for r in got) == want
    assert len({r["sequence_id"] for r in got}) == len(best_fit([r["length"] for r in got], capacity))


def test_packed_ids_are_those_of_the_pieces(spark, documents, serial):
    pieces = token_pieces(documents.select("doc_id", "text"), serial, 64, keep_ids=True)
    placed = best_fit_slots(pieces, "length", 64)
    sequences = {r["sequence_id"]: r["ids"] for r in packed_sequences(placed).collect()}
    for r in placed.collect():
        assert sequences[r["sequence_id"]][r["offset"] : r["offset"] + r["length"]] == r["ids"]
    assert max(map(len, sequences.values())) <= 64


def test_empty(nothing, serial):
    assert pack_documents(nothing, serial).count() == 0
