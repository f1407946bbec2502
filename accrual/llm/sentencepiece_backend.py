"""SentencePiece encoding and decoding with the tokenizers library as backend.

The model file is a protobuf. It is read here field by field, and a tokenizer is rebuilt from it: the
normaliser (its compiled character map, the dummy prefix, white space as the metaspace mark), the pieces
with their scores (a unigram model as it is; the merges of a BPE model follow from the scores of its
pieces), byte fallback, and the decoder. The driver builds the tokenizer once, compares it with the
sentencepiece library on probe texts, and ships it as JSON; workers encode batches with the library's
own threads.
"""

from __future__ import annotations

import functools
import hashlib
import os
import re
import struct
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from accrual.llm.common import free_name, release_memory

SPACE = "▁"
# Kinds of pieces and of models in the model file's format.
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
UNIGRAM, BPE = 1, 2
BATCH_CHARS = 1 << 18

PROBES = [
    "", " ", "  two  spaces ", "Plain words, and 1234 numbers.", "\n\nlines\tand tabs\r\n",
    "élève où çà für Größe ñandú", "你好 世界 مرحبا", "\U0001f600 emoji \U0001f468‍\U0001f469",
    "<s> </s> <unk> <0x41>", "a" * 300, SPACE + "mark" + SPACE, "\x00\x01\x7f", "###$$$%%%&&&***",
]


@dataclass
class Spec:
    pieces: list[tuple[str, float, int]] = field(default_factory=list)
    model_type: int = UNIGRAM
    byte_fallback: bool = False
    unk_id: int = 0
    charsmap: bytes = b""
    add_dummy_prefix: bool = True
    remove_extra_whitespaces: bool = True
    escape_whitespaces: bool = True
    suffix: bool = False


def _varint(data: bytes, at: int) -> tuple[int, int]:
    value = shift = 0
    while True:
        byte = data[at]
        value |= (byte & 0x7F) << shift
        at, shift = at + 1, shift + 7
        if byte < 0x80:
            return value, at


def _fields(data: bytes) -> Iterator[tuple[int, object]]:
    """(number, value) of the fields of one protobuf message."""
    at = 0
    while at < len(data):
        tag, at = _varint(data, at)
        kind = tag & 7
        if kind == 0:
            value, at = _varint(data, at)
        elif kind == 2:
            length, at = _varint(data, at)
            value, at = data[at : at + length], at + length
        elif kind in (1, 5):
            length = 8 if kind == 1 else 4
            value, at = struct.unpack("<d" if kind == 1 else "<f", data[at : at + length])[0], at + length
        else:
            raise ValueError(f"unknown wire type {kind}")
        yield tag >> 3, value


def parse_model(data: bytes) -> Spec:
    """What a model file says, with the format's defaults where it is silent."""
    spec = Spec()
    for number, value in _fields(data):
        if number == 1:
            piece = dict(_fields(value))
            spec.pieces.append((piece.get(1, b"").decode(), piece.get(2, 0.0), piece.get(3, NORMAL)))
        elif number == 2:
            trainer = dict(_fields(value))
            spec.model_type = trainer.get(3, UNIGRAM)
            spec.byte_fallback = bool(trainer.get(35, 0))
            spec.suffix = bool(trainer.get(24, 0))
        elif number == 3:
            rules = dict(_fields(value))
            spec.charsmap = rules.get(2, b"")
            spec.add_dummy_prefix = bool(rules.get(3, 1))
            spec.remove_extra_whitespaces = bool(rules.get(4, 1))
            spec.escape_whitespaces = bool(rules.get(5, 1))
    spec.unk_id = next((i for i, p in enumerate(spec.pieces) if p[2] == UNKNOWN), 0)
    return spec


def merges_of(spec: Spec) -> list[tuple[str, str]]:
    """Merges that a BPE model's scores stand for: every way to make a piece from two, best first."""
    usable = {p: score for p, score, kind in spec.pieces if kind in (NORMAL, USER_DEFINED)}
    found = []
    for piece, score in usable.items():
        for cut in range(1, len(piece)):
            left, right = piece[:cut], piece[cut:]
            if left in usable and right in usable:
                found.append((-score, -cut, left, right))
    return [(left, right) for _, _, left, right in sorted(found)]


def build(spec: Spec, own_ids: bool = False):
    """A ``tokenizers.Tokenizer`` that works as the model file says.

    With ``own_ids`` it decodes faster: the mark is replaced once in the joined text. That is the same
    for ids that come from encoding a text, where byte pieces never spell the mark (it is a piece of its
    own), but not for any ids. What is not rebuilt here is refused: user-defined pieces and the
    mark as a suffix.
    """
    from tokenizers import Regex, Tokenizer, decoders, models, normalizers, pre_tokenizers

    if spec.suffix:
        raise ValueError("models that mark white space at the end of a piece are not rebuilt")
    if any(kind == USER_DEFINED for _, _, kind in spec.pieces):
        raise ValueError("models with user-defined pieces are not rebuilt")
    if spec.model_type == UNIGRAM:
        model = models.Unigram(
            [(p, s) for p, s, _ in spec.pieces], unk_id=spec.unk_id, byte_fallback=spec.byte_fallback
        )
    elif spec.model_type == BPE:
        model = models.BPE(
            {p: i for i, (p, _, _) in enumerate(spec.pieces)},
            merges_of(spec),
            unk_token=spec.pieces[spec.unk_id][0],
            fuse_unk=True,
            byte_fallback=spec.byte_fallback,
        )
    else:
        raise ValueError(f"model type {spec.model_type} is neither unigram nor BPE")
    tokenizer = Tokenizer(model)
    steps = []
    if spec.charsmap:
        steps.append(normalizers.Precompiled(spec.charsmap))
    if spec.remove_extra_whitespaces:
        steps += [normalizers.Strip(), normalizers.Replace(Regex(" {2,}"), " ")]
    if spec.add_dummy_prefix:
        steps.append(normalizers.Prepend(SPACE if spec.escape_whitespaces else " "))
    if spec.escape_whitespaces:
        steps.append(normalizers.Replace(" ", SPACE))
    if steps:
        tokenizer.normalizer = normalizers.Sequence(steps)
    # Where no piece has the mark after another character, words can be encoded one by one.
    if not any(SPACE in p.lstrip(SPACE) for p, _, kind in spec.pieces if kind in (NORMAL, USER_DEFINED)):
        words = Regex(f"{SPACE}+[^{SPACE}]*|[^{SPACE}]+")
        tokenizer.pre_tokenizer = pre_tokenizers.Split(words, behavior="isolated")
    after = [decoders.Replace(SPACE, " "), decoders.ByteFallback(), decoders.Fuse()]
    if own_ids and any(p == SPACE for p, _, kind in spec.pieces if kind == NORMAL):
        after = [decoders.ByteFallback(), decoders.Fuse(), decoders.Replace(SPACE, " ")]
    if spec.add_dummy_prefix:
        after.append(decoders.Strip(" ", 1, 0))
    tokenizer.decoder = decoders.Sequence(after)
    return tokenizer


def verify_parity(data: bytes, tokenizer, texts: list[str] = PROBES) -> None:
    """Raise where the rebuilt tokenizer and the sentencepiece library differ in ids or text."""
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_proto=data)
    for text, mine in zip(texts, tokenizer.encode_batch(texts, add_special_tokens=False)):
        ids = library.encode(text)
        if mine.ids != ids:
            raise ValueError(f"ids of {text[:60]!r} differ: {mine.ids[:20]} and {ids[:20]}")
        if tokenizer.decode(ids, skip_special_tokens=False) != library.decode(ids):
            raise ValueError(f"decoded text of {text[:60]!r} differs")


THREADS = 2


@functools.lru_cache(maxsize=1)
def _loaded(serial: str):
    """The worker's tokenizer. Each core has a worker of its own, and every thread of the library costs
    memory and time, so it gets ``THREADS`` and not as many as the machine has cores."""
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "true")
    os.environ.setdefault("RAYON_NUM_THREADS", str(THREADS))
    from tokenizers import Tokenizer

    return Tokenizer.from_str(serial)


_BYTE_PIECE = re.compile(r"<0x([0-9A-Fa-f]{2})>")


def spellings(tokenizer) -> list[bytes]:
    """What each id adds to a decoded text: the byte of a byte piece, else the piece with marks as spaces."""
    spelled = []
    for i in range(tokenizer.get_vocab_size()):
        piece = tokenizer.id_to_token(i) or ""
        byte = _BYTE_PIECE.fullmatch(piece)
        spelled.append(bytes([int(byte[1], 16)]) if byte else piece.replace(SPACE, " ").encode())
    return spelled


def comes_back(text: str, ids: list[int], spelled: list[bytes], tokenizer, prefixed: bool) -> bool:
    """Whether decoding ``ids`` gives ``text``, as ``tokenizer`` decodes.

    Spellings that make up the text are the decoded text: all their bytes are characters then. The library
    decodes only where they do not.
    """
    joined = b"".join([spelled[i] for i in ids])
    if prefixed and joined.startswith(b" "):
        joined = joined[1:]
    return joined == text.encode() or tokenizer.decode(ids, skip_special_tokens=False) == text


def _batches(texts: Iterable[str]) -> Iterator[list[str]]:
    """Runs of texts with about ``BATCH_CHARS`` characters, so that encodings stay small."""
    held, size = [], 0
    for text in texts:
        held.append(text)
        size += len(text)
        if size >= BATCH_CHARS:
            yield held
            held, size = [], 0
    if held:
        yield held


def encode_texts(
    documents: DataFrame, model: bytes, text: str = "text", keep_ids: bool = True, keep_text: bool = True
) -> DataFrame:
    """``documents`` with ``ids``, ``n_tokens``, ``ids_sha256`` and ``round_trip``.

    ``ids_sha256`` is over the ids as little-endian 32-bit numbers; ``round_trip`` says whether decoding
    gives the text back (a text with the metaspace mark itself does not come back). ``keep_ids=False``
    leaves ``ids`` out, ``keep_text=False`` the text. A NULL text counts as empty: no ids, and it comes back. Texts are encoded whole;
    columns with these names are replaced.
    """
    spec = parse_model(model)
    tokenizer = build(spec, own_ids=True)
    verify_parity(model, tokenizer)
    prefixed = spec.add_dummy_prefix
    spark = documents.sparkSession
    shipped = spark.sparkContext.broadcast(tokenizer.to_str())
    made = {"n_tokens": T.LongType(), "ids_sha256": T.StringType(), "round_trip": T.BooleanType()}
    if keep_ids:
        made["ids"] = T.ArrayType(T.IntegerType())
    kept = documents.drop(*made)
    source = free_name(kept, "_source")
    names = [c for c in kept.columns if keep_text or c != text]

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        backend = _loaded(shipped.value)
        spelled = spellings(backend)
        release_memory()  # what building took
        kinds = {"n_tokens": pa.int64(), "ids_sha256": pa.string(), "round_trip": pa.bool_(), "ids": pa.list_(pa.int32())}
        for given in batches:
            out: dict[str, list] = {c: [] for c in made}
            for batch in _batches(given.column(source).to_pylist()):
                ids = [e.ids for e in backend.encode_batch_fast(batch, add_special_tokens=False)]
                packed = [np.array(i, dtype="<i4") for i in ids]
                out["n_tokens"] += [len(i) for i in ids]
                out["ids_sha256"] += [hashlib.sha256(p).hexdigest() for p in packed]
                out["round_trip"] += [comes_back(t, i, spelled, backend, prefixed) for t, i in zip(batch, ids)]
                if keep_ids:
                    out["ids"] += packed
            columns = [given.column(c) for c in names]
            columns += [pa.array(out[c], type=kinds[c]) for c in made]
            yield pa.RecordBatch.from_arrays(columns, names=[*names, *made])
            # The batch and its results are gone before the next one is read.
            del given, out, columns
            release_memory()
        # The worker goes on to other stages; the next task builds its tokenizer anew.
        del backend, spelled
        _loaded.cache_clear()
        release_memory()

    schema = T.StructType([*(kept.schema[c] for c in names), *(T.StructField(c, t) for c, t in made.items())])
    given = kept.withColumn(source, F.coalesce(F.col(text), F.lit("")))
    return given.mapInArrow(encode, schema)


def decode_ids(encoded: DataFrame, model: bytes, ids: str = "ids", to: str = "decoded") -> DataFrame:
    """``encoded`` with the text of ``ids`` in column ``to``; NULL ids give NULL."""
    tokenizer = build(parse_model(model))
    shipped = encoded.sparkSession.sparkContext.broadcast(tokenizer.to_str())

    @F.pandas_udf("string")
    def decode(column: pd.Series) -> pd.Series:
        backend = _loaded(shipped.value)
        return column.map(
            lambda x: None if x is None else backend.decode([int(i) for i in x], skip_special_tokens=False)
        )

    return encoded.withColumn(to, decode(F.col(ids)))


def read_model(path: str | None = None) -> bytes:
    """The model file's bytes; ``path`` defaults to the public 32k BPE model."""
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path("piece_bpe_32k.model")
    with open(path, "rb") as file:
        return file.read()
