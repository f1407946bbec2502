"""Counting byte-level BPE tokens with a transducer.

The tokenizer is compiled into one deterministic transducer over characters. Its state holds

* where the splitting rule stands: inside letters, digits, signs or white space, or after an
  apostrophe that may begin a contraction;
* where the merges stand inside the current piece. For every place of the piece from which a token
  could still reach the end (the bytes since then begin some token), the state keeps the trie node
  reached, the last token of the tokenisation up to that place, and how many tokens that tokenisation
  has less than the one of the whole piece so far. A byte moves the nodes on; exactly one place has a
  token that ends here and may follow its last token, and that extends the tokenisation.

Two tokens may follow each other if the merges, applied to both together, give them back; a split of a
piece is its tokenisation if and only if all neighbours may follow each other. Every transition is
annotated with the number of tokens it emits: the change of the count (it may be negative, as a
longer token can replace several). States and transitions are made when they are first needed and
kept up to a bound; the set of states is finite for any text because tokens have a longest length.

A text is cut into chunks. A chunk's state map is found without knowing the state before it: at a space
after anything but white space every state is left for the same one, so from the first such place (the
reset) count and final state do not depend on what came before. The map is (characters before the
reset, tokens from there on, characters after the last reset); maps compose associatively, and a
prefix scan over the chunks of a document gives its count. Chunks are rows, so a long text is
spread over tasks.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CHUNK = 1 << 16
MAX_STATES = 200_000

# Where the splitting rule stands.
START, LETTER, NUMBER, SIGN, WHITE, QUOTE, QUOTE_R, QUOTE_V, QUOTE_L = range(9)
_AFTER_QUOTE = {"r": QUOTE_R, "v": QUOTE_V, "l": QUOTE_L}
_COMPLETED = {(QUOTE_R, "e"), (QUOTE_V, "e"), (QUOTE_L, "l")}
_SHORT = "stmd"


def byte_letters() -> dict[int, str]:
    """The printable character that stands for each byte in the vocabulary."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in set(plain)]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(other)}


class State(dict):
    """A state: its transitions by character; ``emit`` is the count of the transition into it."""

    __slots__ = ("machine", "mode", "places", "emit", "held")

    def __init__(self, machine, mode, places, emit, held):
        self.machine, self.mode, self.places = machine, mode, places
        self.emit, self.held = emit, held

    def __missing__(self, char: str) -> State:
        self[char] = made = self.machine.step(self, char)
        return made


class Transducer:
    """Compiled from the JSON of a byte-level BPE tokenizer of the ``tokenizers`` library."""

    def __init__(self, serial: str, max_states: int = MAX_STATES):
        spec = json.loads(serial)
        model, split = spec["model"], spec["pre_tokenizer"]
        if model["type"] != "BPE" or split["type"] != "ByteLevel" or not split["use_regex"]:
            raise ValueError("not a byte-level BPE tokenizer")
        if split["add_prefix_space"] or spec["normalizer"] or model.get("ignore_merges"):
            raise ValueError("prefix spaces, normalisers and whole-word look-ups are not compiled")
        from tokenizers import Tokenizer

        self.backend = Tokenizer.from_str(serial)
        self.specials = [t["content"] for t in spec["added_tokens"]]
        if any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in spec["added_tokens"]):
            raise ValueError("added tokens that take in their surroundings are not compiled")
        letters = byte_letters()
        self.letter = letters
        byte_of = {c: b for b, c in letters.items()}
        # A trie over bytes: node -> {byte: node}, and the token that ends at a node.
        self.trie: list[dict[int, int]] = [{}]
        self.token: list[str | None] = [None]
        for text in model["vocab"]:
            if not all(c in byte_of for c in text):
                continue
            node = 0
            for c in text:
                following = self.trie[node].get(byte_of[c])
                if following is None:
                    following = self.trie[node][byte_of[c]] = len(self.trie)
                    self.trie.append({})
                    self.token.append(None)
                node = following
            self.token[node] = text
        self.max_states = max_states
        self.kinds: dict[str, int] = {}
        self.clear()

    def clear(self) -> None:
        self.states: dict[tuple, State] = {}
        self.follows: dict[tuple, bool] = {}
        self.start = self._state(START, (), 0, ())

    # The merges inside a piece

    def _may_follow(self, left: str | None, right: str) -> bool:
        known = self.follows.get((left, right))
        if known is None:
            got = [t.value for t in self.backend.model.tokenize((left or "") + right)]
            known = self.follows[left, right] = got == [left, right] if left else got == [right]
        return known

    def _advance(self, places: tuple, data: bytes) -> tuple[tuple, int]:
        """Move the live places of a piece over ``data``: the new places and the tokens emitted.

        A place is (trie node, last token before it, tokens fewer than at the newest place).
        """
        emitted = 0
        if not places:
            places = ((0, None, 0),)
        for byte in data:
            moved, last = [], None
            for node, before, fewer in places:
                node = self.trie[node].get(byte)
                if node is None:
                    continue
                moved.append((node, before, fewer))
                token = self.token[node]
                if last is None and token is not None and self._may_follow(before, token):
                    last = (token, 1 - fewer)
            token, change = last
            emitted += change
            places = (*((n, b, f + change) for n, b, f in moved if self.trie[n]), (0, token, 0))
        return places, emitted

    # The splitting rule

    def kind(self, char: str) -> int:
        """LETTER, NUMBER, WHITE or SIGN, as the tokenizers library itself sees the character."""
        known = self.kinds.get(char)
        if known is None:
            split = self.backend.pre_tokenizer.pre_tokenize_str
            if len(split("a" + char)) == 1:
                known = LETTER
            elif len(split("1" + char)) == 1:
                known = NUMBER
            elif len(split("!" + char)) == 1:
                known = SIGN
            else:
                known = WHITE
            self.kinds[char] = known
        return known

    def _state(self, mode: int, places: tuple, emit: int, held: tuple) -> State:
        key = (mode, places, emit, held)
        found = self.states.get(key)
        if found is None:
            found = self.states[key] = State(self, mode, places, emit, held)
        return found

    def _begin(self, char: str, kind: int, emit: int) -> State:
        """A new piece that begins with ``char``; ``emit`` tokens come from before."""
        data = char.encode()
        if kind == WHITE:
            # The last white space of a run may belong to the next piece, so it is held back.
            return self._state(WHITE, (), emit, (char,))
        places, count = self._advance((), data)
        return self._state(QUOTE if char == "'" else kind, places, emit + count, ())

    def step(self, state: State, char: str) -> State:
        """The state after ``char``, and in it what the transition emits."""
        kind, mode = self.kind(char), state.mode
        if mode == START:
            return self._begin(char, kind, 0)
        if mode == WHITE:
            return self._after_white(state, char, kind)
        if mode == QUOTE and char in _SHORT:
            places, count = self._advance(state.places, char.encode())
            return self._state(START, (), count, ())
        if mode == QUOTE and char in _AFTER_QUOTE:
            # Either a contraction or a sign and a word: the letter is held back.
            return self._state(_AFTER_QUOTE[char], state.places, 0, (char,))
        if mode in (QUOTE_R, QUOTE_V, QUOTE_L):
            if (mode, char) in _COMPLETED:
                places, count = self._advance(state.places, (state.held[0] + char).encode())
                return self._state(START, (), count, ())
            places, count = self._advance((), state.held[0].encode())
            word = self._state(LETTER, places, count, ())
            after = self.step(word, char)
            return self._state(after.mode, after.places, after.emit + count, after.held)
        if mode == QUOTE:
            mode = SIGN
        if kind == mode:
            places, count = self._advance(state.places, char.encode())
            return self._state(mode, places, count, ())
        return self._begin(char, kind, 0)

    def _after_white(self, state: State, char: str, kind: int) -> State:
        held = state.held[0]
        if kind == WHITE:
            places, count = self._advance(state.places, held.encode())
            return self._state(WHITE, places, count, (char,))
        if held == " ":
            places, count = self._advance((), (held + char).encode())
            return self._state(kind, places, count, ())
        _, count = self._advance((), held.encode())
        return self._begin(char, kind, count)

    def final(self, state: State) -> int:
        """Tokens that the end of the text emits."""
        if not state.held:
            return 0
        if state.mode == WHITE:
            return self._advance(state.places, state.held[0].encode())[1]
        return self._advance((), state.held[0].encode())[1]

    def run(self, text: str) -> int:
        """Tokens of ``text``, in which no added token occurs.

        States are only dropped between texts; a chunk makes a bounded number of them.
        """
        if len(self.states) >= self.max_states:
            self.clear()
        state, total = self.start, 0
        for char in text:
            state = state[char]
            total += state.emit
        return total + self.final(state)

    def count(self, text: str) -> int:
        """Tokens of ``text``; each added token in it is one token of its own."""
        total = 0
        for special in self.specials:
            if special in text:
                parts = text.split(special)
                return len(parts) - 1 + sum(self.count(p) for p in parts)
        return total + self.run(text)

    # Chunks

    def map_of(self, chunk: str) -> tuple[str, int, str, bool]:
        """The chunk's state map: (before the first reset, tokens, from the last reset, any reset)."""
        first = _RESET.search(chunk)
        if first is None:
            return chunk, 0, "", False
        at, last = first.end() - 1, chunk.rfind(" ")
        while chunk[last - 1].isspace():
            last = chunk.rfind(" ", 0, last)
        return chunk[:at], self.count(chunk[at:last]), chunk[last:], True

    def compose(self, left: tuple, right: tuple) -> tuple[str, int, str, bool]:
        """The map of two neighbouring chunks together; associative."""
        if not left[3]:
            return left[0] + right[0], right[1], right[2], right[3]
        if not right[3]:
            return left[0], left[1], left[2] + right[0], True
        return left[0], left[1] + self.count(left[2] + right[0]) + right[1], right[2], True

    def total(self, maps: list[tuple]) -> int:
        """Tokens of the document whose chunks have these maps: neighbours are composed in rounds."""
        while len(maps) > 1:
            pairs = [self.compose(a, b) for a, b in zip(maps[::2], maps[1::2])]
            maps = pairs + maps[len(pairs) * 2 :]
        return self.count(maps[0][0]) + maps[0][1] + self.count(maps[0][2])


# A space after something that no engine takes for white space.
_RESET = re.compile(r"[^\s\x00-\x20\x7f-\xa0] ")

_machines: dict[str, Transducer] = {}


def machine(serial: str) -> Transducer:
    """The worker's transducer; its states are kept from task to task."""
    if serial not in _machines:
        _machines.clear()
        _machines[serial] = Transducer(serial)
    return _machines[serial]


MAP_SCHEMA = "row long, doc_id long, n_bytes long, chunk int, n long, head string, tail string, reset boolean"


def count_tokens(
    documents: DataFrame, serial: str, limit: int = 512, chunk: int = CHUNK
) -> DataFrame:
    """Per row of ``documents``: ``doc_id, n_bytes, n_tokens, over_limit``.

    ``serial`` is the JSON of a byte-level BPE tokenizer. A NULL text counts as empty: no bytes, no
    tokens. Texts are counted whole, repeated rows are counted each.
    """
    machine(serial)  # an unsuitable tokenizer fails here, not on the executors
    shipped = documents.sparkSession.sparkContext.broadcast(serial)
    texts = documents.select(
        F.monotonically_increasing_id().alias("row"),
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    # The chunks are made first and then exploded: no row carries more than its chunk.
    long_text = F.char_length("text") > chunk
    chunks = F.regexp_extract_all("text", F.lit(f"(?s).{{1,{chunk}}}"), F.lit(0))
    chunks = F.when(long_text, chunks).otherwise(F.array("text"))
    pieces = texts.select(
        "row", "doc_id", (~long_text).alias("whole"), F.posexplode(chunks).alias("chunk", "text")
    )

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counter = machine(shipped.value)
        for frame in frames:
            maps = [
                ("", counter.count(t), "", True) if whole else counter.map_of(t)
                for t, whole in zip(frame["text"], frame["whole"])
            ]
            out = frame[["row", "doc_id", "chunk"]].copy()
            out["doc_id"] = out["doc_id"].astype("Int64")
            out["n_bytes"] = [len(t.encode()) for t in frame["text"]]
            for i, name in enumerate(("head", "n", "tail", "reset")):
                out[name] = [m[i] for m in maps]
            yield out[[c.split()[0] for c in MAP_SCHEMA.split(", ")]]

    @F.pandas_udf("long")
    def total(lists: pd.Series) -> pd.Series:
        counter = machine(shipped.value)
        return lists.map(
            lambda maps: counter.total(
                [(m["head"], m["n"], m["tail"], m["reset"]) for m in sorted(maps, key=lambda m: m["chunk"])]
            )
        ).astype("int64")

    maps = pieces.mapInPandas(run, MAP_SCHEMA)
    one = maps.groupBy("row").agg(
        F.first("doc_id").alias("doc_id"),
        F.sum("n_bytes").alias("n_bytes"),
        F.collect_list(F.struct("chunk", "head", "n", "tail", "reset")).alias("maps"),
    )
    counted = one.withColumn("n_tokens", total("maps"))
    return counted.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))


def read_tokenizer(path: str | None = None) -> str:
    """The tokenizer's JSON; ``path`` defaults to the public 50k byte-level BPE."""
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path("byte_bpe_50k.json")
    with open(path, encoding="utf-8") as file:
        return file.read()
