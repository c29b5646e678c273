"""Byte-level BPE encoding and decoding with a sentencepiece model built straight from a rank file.

The vocabulary of a rank file (bytes -> rank) is serialised as a sentencepiece BPE model: every byte is mapped to one
character, every token to the string of its mapped bytes, and its score is the negative rank, so that the merge of the
lowest rank comes first. Normalisation is the identity. A text is split into pre-tokens by a pattern; each pre-token is
encoded on its own; decoding maps ids back to pieces and pieces back to bytes. Nothing is trained.

Defined results: a null or empty text has no tokens and decodes to no bytes; repeated rows and repeated ids are each
encoded; extra columns are not read; an empty table gives an empty table. Memory is bounded by one slice of rows
(``common.slices``), the longest text and a cache of pre-tokens of fixed size.
"""

from __future__ import annotations

import base64
import struct
from collections import ChainMap
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import accumulate, chain, islice

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetscope.llm.common import slices, table
from fleetscope.session import ship_package

VOCABULARY = "byte_bpe_multi_50k.tiktoken"
#: Pre-tokens whose ids a worker keeps; the cache is emptied when full.
CACHE_TOKENS = 250_000
#: Longest pre-token that is cached, in characters.
CACHE_CHARS = 64
#: Characters joined for one call of the encoder.
CALL_CHARS = 20_000
#: Byte b is character FIRST + b: none of them is white space or a mark of sentencepiece.
FIRST = 0x100
#: Stands between pre-tokens in one call; it is in no piece, so that no merge crosses it.
BREAK = "\x01"
#: The public pattern for Python's faster ``re``. It gives the same pre-tokens for texts without BEYOND_LATIN: letters up
#: to U+024F, ASCII digits, and no character that ``re`` alone calls white space or a letter.
LATIN = r"'(?:[stmd]|re|ve|ll)| ?[^\W\d_]+| ?[0-9]+| ?(?:[^\s\w]|_)+|\s+(?!\S)|\s+"
BEYOND_LATIN = "[\x1c-\x1f\u00b2\u00b3\u00b9\u00bc-\u00be\u0250-\u200f\u2028-\U0010ffff]"


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}


# -- the model file -----------------------------------------------------------------------------------------------

def _varint(n: int) -> bytes:
    out = bytearray()
    n &= (1 << 64) - 1
    while n > 127:
        out.append(n & 127 | 128)
        n >>= 7
    return bytes(out + bytes([n]))


def _number(field: int, value: int) -> bytes:
    return _varint(field << 3) + _varint(value)


def _block(field: int, data: bytes) -> bytes:
    return _varint(field << 3 | 2) + _varint(len(data)) + data


_MAP = {b: FIRST + b for b in range(256)}


def to_chars(data: bytes) -> str:
    """One character for each byte."""
    return data.decode("latin-1").translate(_MAP)


def to_bytes(chars: str) -> bytes:
    """Inverse of :func:`to_chars`."""
    return bytes(ord(c) - FIRST for c in chars)


def serialise(ranks: dict[bytes, int]) -> bytes:
    """A sentencepiece ModelProto of type BPE. Ids are the ranks, which must run from 0 without gaps and hold all
    256 bytes; the unknown piece, which a byte-level text never needs, follows them."""
    tokens = sorted(ranks, key=ranks.get)
    if [ranks[t] for t in tokens] != list(range(len(tokens))):
        raise ValueError("ranks must be 0, 1, 2, ... without gaps")
    if any(bytes([b]) not in ranks for b in range(256)):
        raise ValueError("a byte-level vocabulary holds all 256 bytes")

    def piece(text: str, score: float, kind: int) -> bytes:
        return _block(1, _block(1, text.encode()) + _varint(2 << 3 | 5) + struct.pack("<f", score) + _number(3, kind))

    pieces = [piece(to_chars(t), -float(i), 1) for i, t in enumerate(tokens)] + [piece("<unk>", 0.0, 2)]
    # trainer: type BPE, size, unknown id, and no begin, end or padding piece
    trainer = _number(3, 2) + _number(4, len(pieces)) + _number(40, len(tokens)) + b"".join(
        _number(field, -1) for field in (41, 42, 43))
    # normaliser: identity, no dummy prefix, white space kept, white space not escaped
    normaliser = _block(1, b"identity") + b"".join(_number(field, 0) for field in (3, 4, 5))
    return b"".join(pieces) + _block(2, trainer) + _block(3, normaliser)


# -- pre-tokens ---------------------------------------------------------------------------------------------------

@lru_cache(maxsize=4)
def newer_characters(spec: str = r"\p{L}\p{N}") -> str:
    """Characters that Python's ``regex`` counts as letters or numbers and the tiktoken library, whose Unicode tables
    are older, does not: the body of a character class, empty if there are none."""
    import regex
    import tiktoken

    every = "".join(map(chr, chain(range(0xD800), range(0xE000, 0x110000))))
    single = {bytes([b]): b for b in range(256)}
    out: list[list[int]] = []
    for kind in (r"\p{L}", r"\p{N}"):
        probe = tiktoken.Encoding("probe", pat_str=kind, mergeable_ranks=single, special_tokens={})
        theirs = set(bytes(probe.encode_ordinary(every)).decode())
        ours = set(regex.findall(kind, every))
        if theirs - ours:
            raise RuntimeError("the tiktoken library knows letters or numbers that regex does not")
        for c in sorted(map(ord, ours - theirs)):
            if out and out[-1][1] == c - 1:
                out[-1][1] = c
            else:
                out.append([c, c])
    return "".join(f"\\U{a:08X}-\\U{b:08X}" for a, b in out)


class Codec:
    """Encoder and decoder of one worker process."""

    def __init__(self, model: bytes, pattern: str, newer: str):
        import re

        import regex
        import sentencepiece

        self.sp = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.unk = self.sp.unk_id()
        tokens = [to_bytes(self.sp.id_to_piece(i)) for i in range(self.unk)]
        self.whole = {t: struct.pack("=i", i) for i, t in enumerate(tokens)}
        self.bytes = np.frombuffer(b"".join(tokens), np.uint8)
        self.lengths = np.fromiter(map(len, tokens), np.int64, len(tokens))
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.split = regex.compile(pattern).findall
        self.split_latin = re.compile(LATIN).findall if pattern == public_tokenizers.PATTERN else self.split
        self.beyond_latin = re.compile(BEYOND_LATIN).search
        self.newer = re.compile(f"[{newer}]") if newer else None
        if newer:
            other = r"[^\s\p{L}\p{N}]"
            parts = [part.replace(r"\p{L}", rf"[\p{{L}}--[{newer}]]").replace(r"\p{N}", rf"[\p{{N}}--[{newer}]]")
                     for part in pattern.split(other)]
            pattern = f"[{other}||[{newer}]]".join(parts)
            self.split_newer = regex.compile(pattern, regex.V1).findall
        #: ids of a pre-token, four bytes each
        self.cache: dict[str, bytes] = {}

    def pretokens(self, text: str) -> list[str]:
        if not self.beyond_latin(text):
            return self.split_latin(text)
        if self.newer and self.newer.search(text):
            return self.split_newer(text)
        return self.split(text)

    def _encode_new(self, tokens: Iterable[str]) -> dict[str, bytes]:
        out: dict[str, bytes] = {}
        run: list[str] = []
        rest: list[str] = []
        size = 0

        def call() -> None:
            ids = np.array(self.sp.encode(BREAK.join(run), num_threads=1), np.int32)
            ends = np.flatnonzero(ids == self.unk).tolist()
            data, at = ids.tobytes(), 0
            for token, end in zip(rest, [*ends, len(ids)], strict=True):
                out[token] = data[4 * at:4 * end]
                at = end + 1

        for token in tokens:
            data = token.encode()
            if found := self.whole.get(data):
                out[token] = found
                continue
            run.append(to_chars(data))
            rest.append(token)
            size += len(data)
            if size >= CALL_CHARS:
                call()
                run, rest, size = [], [], 0
        if rest:
            call()
        return out

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, list[int]]:
        """All ids one after the other, and the number of ids up to each text's end."""
        parts = [self.pretokens(t) if t else () for t in texts]
        new = self._encode_new(set(chain.from_iterable(parts)).difference(self.cache))
        known = ChainMap(self.cache, new) if len(self.cache) + len(new) > CACHE_TOKENS else self.cache
        if known is self.cache:
            known.update(new)
        rows = [b"".join(map(known.__getitem__, part)) for part in parts]
        if known is not self.cache:  # full: start anew with what this slice has found
            self.cache = dict(islice(new.items(), CACHE_TOKENS))
        for token in filter(_long, new):
            self.cache.pop(token, None)
        ends = list(accumulate(len(row) // 4 for row in rows))
        return np.frombuffer(b"".join(rows), np.int32), ends

    def decode(self, ids: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The bytes of all ids one after the other, and the number of bytes up to each text's end."""
        lengths = self.lengths[ids]
        after = np.cumsum(lengths)
        total = int(after[-1]) if len(after) else 0
        at = np.arange(total) + np.repeat(self.starts[ids] - after + lengths, lengths)
        return self.bytes[at], np.concatenate([[0], after])[ends]


def _long(token: str) -> bool:
    return len(token) > CACHE_CHARS


_CODECS: dict[tuple[int, str], Codec] = {}


class Bpe:
    """A vocabulary that Spark tasks can use: the serialised model goes out once as a broadcast (its size is that of
    the rank file, about 1 MB; more than ``max_bytes`` is refused)."""

    def __init__(self, spark: SparkSession, path: str | None = None, pattern: str = public_tokenizers.PATTERN,
                 max_bytes: int = 64 << 20):
        ship_package(spark)
        model = serialise(read_ranks(path or public_tokenizers.path(VOCABULARY)))
        if len(model) > max_bytes:
            raise ValueError(f"the model has {len(model)} bytes, more than {max_bytes}")
        self.model = spark.sparkContext.broadcast(model)
        self.pattern = pattern
        self.newer = newer_characters()

    def codec(self) -> Codec:
        key = (len(self.model.value), hash(self.model.value), self.pattern)
        if key not in _CODECS:
            _CODECS[key] = Codec(self.model.value, self.pattern, self.newer)
        return _CODECS[key]


def encode(docs: DataFrame, bpe: Bpe, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, token_ids array<int>) of every row of ``docs``."""
    picked = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = bpe.codec()
        for part in slices(batches, 1):
            flat, ends = codec.encode(part.column(1).to_pylist())
            ids = pa.ListArray.from_arrays(pa.array([0, *ends], pa.int32()), pa.array(flat))
            yield pa.RecordBatch.from_arrays([part.column(0), ids], names=["id", "token_ids"])

    kind = picked.schema["id"].dataType.simpleString()
    return picked.mapInArrow(run, f"id {kind}, token_ids array<int>").withColumnRenamed("id", id_col)


def decode(encoded: DataFrame, bpe: Bpe, id_col: str = "doc_id") -> DataFrame:
    """(id, token_ids, decoded binary) of every row that :func:`encode` gave."""
    picked = encoded.select(F.col(id_col).alias("id"), "token_ids")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = bpe.codec()
        for part in slices(batches, 1):
            ids = part.column(1)
            counts = np.asarray(pc.fill_null(ids.value_lengths(), 0), np.int64)
            texts = _texts(codec, ids.flatten().to_numpy(zero_copy_only=False), np.cumsum(counts))
            yield pa.RecordBatch.from_arrays([part.column(0), ids, texts],
                                             names=["id", "token_ids", "decoded"])

    kind = picked.schema["id"].dataType.simpleString()
    return picked.mapInArrow(run, f"id {kind}, token_ids array<int>, decoded binary").withColumnRenamed("id", id_col)


def round_trip(docs: DataFrame, bpe: Bpe, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, token_ids, decoded binary) of every row of ``docs``: encoded, and decoded from the ids, in one step, which
    takes one worker process for a task instead of two."""
    picked = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = bpe.codec()
        for part in slices(batches, 1):
            flat, ends = codec.encode(part.column(1).to_pylist())
            ids = pa.ListArray.from_arrays(pa.array([0, *ends], pa.int32()), pa.array(flat))
            yield pa.RecordBatch.from_arrays([part.column(0), ids, _texts(codec, flat, np.array(ends, np.int64))],
                                             names=["id", "token_ids", "decoded"])

    kind = picked.schema["id"].dataType.simpleString()
    return picked.mapInArrow(run, f"id {kind}, token_ids array<int>, decoded binary").withColumnRenamed("id", id_col)


def _texts(codec: Codec, ids: np.ndarray, ends: np.ndarray) -> pa.Array:
    data, stops = codec.decode(ids, ends)
    offsets = pa.py_buffer(np.concatenate([[0], stops]).astype(np.int64))
    rows = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(ends), [None, offsets, pa.py_buffer(data)])
    return rows.cast(pa.binary())


def digests(docs: DataFrame, bpe: Bpe, keep_ids: bool = False) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every document, from the encoded ids and their decoding; with
    ``keep_ids`` the token_ids too."""
    return round_trip(docs, bpe).select(
        "doc_id", F.size("token_ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("token_ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"), *(["token_ids"] if keep_ids else []))


def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(table(spark, sf_dir, "documents"), Bpe(spark))
