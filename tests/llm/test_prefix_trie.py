import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from corpora import prepared  # noqa: F401

from accrual.llm.prefix_trie import choose_splitters, conversation_paths, prefix_trie, rebuilt_paths, skeleton_of

SCHEMA = "conv_id long, turn long, role string, text string, path string"
COLUMNS = [
    "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256",
]


def conversations():
    """Families with shared beginnings, many equal conversations, gaps, NULLs, repeated and long ones."""
    dice, rows = random.Random(4), []
    for c in [*range(0, 90), *range(200, 260, 3), 9999, 12_345]:
        kind = dice.choice("abc")
        for t in range(dice.randint(1, 7)):
            text = f"{kind}{t}" if dice.random() < 0.8 else f"é{dice.randint(0, 3)}"
            rows.append((c, t, ["user", "assistant"][t % 2], text, "x"))
    rows += [(300 + i, 0, "user", "same", None) for i in range(0, 120)]
    rows += [(600, t, "user", "long " * (t % 3), None) for t in range(700)]
    rows += [(601, t, "user", "long " * (t % 3), None) for t in range(650)]
    rows += [(7, None, None, "first", None), (8, None, "user", None, None), (9, 3, "user", "", None)]
    rows += [(10, 2, "a", "tie", None), (10, 2, "b", "tie", None), (10, 2, "b", "tie", None)]
    rows += [(None, 0, "user", "nobody", None), (-5, 0, "user", "below", None)]
    return rows


def own_turns(rows):
    turns = defaultdict(list)
    for c, t, role, text, _ in rows:
        if c is not None:
            turns[c].append((t is not None, t or 0, role or "", text or ""))
    return {c: [x[2:] for x in sorted(v)] for c, v in turns.items()}


def rebuilt(own):
    made = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        made[c] = own.get(c - (c % 5 if c >= 0 else -(-c % 5)), [])[:h] + turns[h:]
    return made


def brute(paths):
    members = defaultdict(list)
    for c, path in paths.items():
        for d in range(len(path) + 1):
            members[tuple(path[:d])].append(c)
    out = []
    for node in members:
        below = [n for n in members if n[: len(node)] == node] if len(node) < 20 else [
            n for n in members if len(n) >= len(node) and n[: len(node)] == node
        ]
        parents = {n[:-1] for n in members if n}
        ends = sorted(c for c in members[node] if len(paths[c]) == len(node))
        out.append((
            min(members[node]), len(node), min(members[node[:-1]]) if node else None, len(members[node]),
            sum(1 for n in below if len(n) == len(node) + 1), sum(1 for n in below if n not in parents),
            sum((len(members[n]) - 1) * len(n[-1][1].encode()) for n in below if n),
            hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest(),
        ))
    return sorted(out, key=repr)


def small(rows):
    """``rows`` with long conversations cut, as brute force compares all nodes."""
    return [r for r in rows if r[1] is None or r[1] < 60]


@pytest.mark.parametrize("shards", [None, 1, 40])
def test_against_brute_force(spark, shards):
    rows = small(conversations())
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    for paths, want in ((conversation_paths(df), own_turns(rows)), (rebuilt_paths(df), rebuilt(own_turns(rows)))):
        got = prefix_trie(paths, shards).select(*COLUMNS).collect()
        assert sorted((tuple(r) for r in got), key=repr) == brute(want)


def test_any_number_of_shards_gives_one_answer(spark):
    paths = conversation_paths(spark.createDataFrame(conversations(), SCHEMA))
    found = [sorted(map(repr, prefix_trie(paths, n).collect())) for n in (1, 7, 64)]
    assert found[0] == found[1] == found[2]


def test_skeleton_holds_every_node_with_members_on_both_sides():
    dice = random.Random(1)
    turns = [bytes([i]) * 20 for i in range(4)]
    paths = sorted({b"".join(dice.choice(turns) for _ in range(dice.randint(0, 6))) for _ in range(400)})
    splitters = choose_splitters([(p, len(p) + 20) for p in paths], 12)
    skeleton = set(skeleton_of(splitters))
    assert len(splitters) == 11
    for cut in splitters:
        left = {p[:i] for p in paths if p < cut for i in range(0, len(p) + 1, 20)}
        right = {p[:i] for p in paths if p >= cut for i in range(0, len(p) + 1, 20)}
        assert left & right <= skeleton


def test_ids_of_one_path_over_several_runs(spark):
    rows = [(i * 1000, 0, "user", "same", None) for i in range(300)]
    got = prefix_trie(conversation_paths(spark.createDataFrame(rows, SCHEMA)))
    ids = ",".join(str(r[0]) for r in rows)
    leaf = got.where("depth = 1").first()
    assert leaf["ends_sha256"] == hashlib.sha256(ids.encode()).hexdigest()
    assert (leaf["n_convs"], leaf["saved_tokens"]) == (300, 299 * 4)


def test_empty(spark):
    assert prefix_trie(rebuilt_paths(spark.createDataFrame([], SCHEMA))).count() == 0
