"""Byte-level BPE with sentencepiece: rank vocabulary in, token ids out, and back.

A sentencepiece BPE model is written from the rank file alone: each token's bytes are mapped
to printable characters (one per byte), and the piece's score is minus its rank, so the
pair that merges first is the pair of lowest rank, leftmost first, as in rank-based BPE.
Normalisation is the identity, and nothing is added or escaped. Texts are cut by the public
pre-token pattern and each piece of text is encoded on its own; decoding maps every id back
to its bytes. Nothing is trained.

The model (about 1 MB, fixed by the vocabulary) is broadcast. Tasks keep the ids of
pre-tokens they have met in a bounded table.

Defined cases: null or empty text gives no ids; texts of any length are encoded whole;
rows with equal ids are separate rows; an empty table gives an empty result.
"""

from __future__ import annotations

import array
import base64
import hashlib
import re
import struct
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame

from .common import arrow_rows, picked, table

#: Pre-tokens whose ids a task remembers before it starts afresh.
REMEMBERED = 150_000
#: Pre-tokens that are looked up together; what is new among them is encoded in one call.
GROUP = 200_000

#: The public pattern, and the same cuts by the standard library's faster matcher for texts
#: of Latin letters, where its classes say the same as ``\\p{L}``, ``\\p{N}`` and ``\\s``.
PATTERN_OF_QUICK = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
QUICK = re.compile(r"'(?:[stmd]|re|ve|ll)| ?[^\W\d_²³¹¼½¾]+| ?[\d²³¹¼½¾]+| ?(?:[^\s\w]|_)+|\s+(?!\S)|\s+")
BEYOND_QUICK = re.compile("[^\x00-\x1b\x20-\u024f]").search


def _byte_letters() -> list[str]:
    """One character for each byte: printable Latin-1 stands for itself, every other byte
    for the next free character from U+0100 on."""
    printable = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    letters, free = [], 0x100
    for b in range(256):
        letters.append(chr(b if b in printable else free))
        free += b not in printable
    return letters


def _varint(n: int) -> bytes:
    out = bytearray()
    while n > 127:
        out.append(n & 127 | 128)
        n >>= 7
    return bytes(out) + bytes([n])


def _message(field: int, body: bytes) -> bytes:
    return _varint(field << 3 | 2) + _varint(len(body)) + body


def _number(field: int, n: int) -> bytes:
    return _varint(field << 3) + _varint(n)


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in (x.split() for x in f if x.strip())}


def model_bytes(ranks: dict[bytes, int]) -> bytes:
    """A serialised sentencepiece model. Piece 0 is the unknown piece it must have; the
    token of the r-th lowest rank is piece r + 1."""
    letters = _byte_letters()
    pieces = [_message(1, b"<unk>") + b"\x15" + struct.pack("<f", 0.0) + _number(3, 2)]
    for token, rank in sorted(ranks.items(), key=lambda x: x[1]):
        text = "".join(letters[b] for b in token).encode()
        pieces.append(_message(1, text) + b"\x15" + struct.pack("<f", -float(rank)) + _number(3, 1))
    trainer = _number(3, 2) + _number(4, len(pieces)) + _number(40, 0) + _number(41, 2**64 - 1) + \
        _number(42, 2**64 - 1) + _number(43, 2**64 - 1)
    normalizer = _message(1, b"identity") + _number(3, 0) + _number(4, 0) + _number(5, 0)
    return b"".join(_message(1, p) for p in pieces) + _message(2, trainer) + _message(3, normalizer)


class Codec:
    """Encoder and decoder of one task."""

    def __init__(self, model: bytes, pattern: str):
        import regex
        import sentencepiece
        self._sp = sentencepiece.SentencePieceProcessor(model_proto=model)
        self._cut = regex.compile(pattern).findall
        self._quick = QUICK.findall if pattern == PATTERN_OF_QUICK else None
        letters = _byte_letters()
        self._letters = {b: c for b, c in enumerate(letters)}
        back = {c: b for b, c in enumerate(letters)}
        pieces = [self._sp.id_to_piece(i) for i in range(1, self._sp.get_piece_size())]
        tokens = [bytes(back[c] for c in p) for p in pieces]
        #: ranks by piece; the scores hold them
        self.ranks = [-1, *(int(-self._sp.get_score(i)) for i in range(1, self._sp.get_piece_size()))]
        self.by_rank = [b""] * (max(self.ranks) + 1)
        for rank, token in zip(self.ranks[1:], tokens, strict=True):
            self.by_rank[rank] = token
        self._known = _Numbered()
        self._ids: list[bytes] = []

    def _learn(self) -> None:
        """Encode the pre-tokens that were met for the first time."""
        parts, ranks = self._known.new, self.ranks
        mapped = [x.encode().decode("latin-1").translate(self._letters) for x in parts]
        for ids in self._sp.encode(mapped, out_type=int, num_threads=1):
            self._ids.append(array.array("I", [ranks[i] for i in ids]).tobytes())
        parts.clear()

    def _look_up(self, group: list[list[int]]) -> list[bytes]:
        if self._known.new:
            self._learn()
        at = self._ids
        out = [b"".join([at[i] for i in parts]) for parts in group]
        if len(self._known) > REMEMBERED:
            self._known.clear()
            self._ids.clear()
        return out

    def _parts(self, text: str) -> list[str]:
        return self._cut(text) if self._quick is None or BEYOND_QUICK(text) else self._quick(text)

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        out: list[bytes] = []
        group: list[list[int]] = []
        size = 0
        number = self._known.__getitem__
        for text in texts:
            group.append(list(map(number, self._parts(text))) if text else [])
            size += len(group[-1])
            if size > GROUP:
                out += self._look_up(group)
                group, size = [], 0
        return out + self._look_up(group)

    def decode(self, ids: bytes) -> bytes:
        tokens = self.by_rank
        return b"".join([tokens[i] for i in memoryview(ids).cast("I")])


class _Numbered(dict):
    """Numbers pre-tokens in the order they are met; ``new`` lists those not yet encoded."""

    def __init__(self):
        super().__init__()
        self.new: list[str] = []

    def __missing__(self, part: str) -> int:
        n = self[part] = len(self)
        self.new.append(part)
        return n


@lru_cache(maxsize=2)
def _worker_codec(model: bytes, pattern: str) -> Codec:
    """One codec for all tasks of a Python worker."""
    return Codec(model, pattern)


def _codec(docs: DataFrame, path: str, pattern: str):
    model = docs.sparkSession.sparkContext.broadcast(model_bytes(read_ranks(path)))
    return lambda: _worker_codec(model.value, pattern)


def encode(docs: DataFrame, path: str, pattern: str, keep=("doc_id",), text_col: str = "text") -> DataFrame:
    """``keep`` columns and ``ids`` (binary: little-endian unsigned 32-bit), ``n_tokens``."""
    new_codec = _codec(docs, path, pattern)

    def make():
        codec = new_codec()

        def run(text):
            ids = codec.encode(text.to_pylist())
            return [pa.array(ids, pa.binary()), pa.array([len(x) // 4 for x in ids], pa.int64())]
        return run
    return arrow_rows(docs, list(keep), [text_col], "ids binary, n_tokens long", make)


def decode(encoded: DataFrame, path: str, pattern: str, keep=("doc_id",), ids_col: str = "ids") -> DataFrame:
    """``keep`` columns and ``decoded`` (the bytes)."""
    new_codec = _codec(encoded, path, pattern)

    def make():
        codec = new_codec()
        return lambda ids: [pa.array([codec.decode(x or b"") for x in ids.to_pylist()], pa.binary())]
    return arrow_rows(encoded, list(keep), [ids_col], "decoded binary", make)


def round_trip(docs: DataFrame, path: str, pattern: str, keep=("doc_id",), text_col: str = "text") -> DataFrame:
    """Encode, decode the ids and return ``keep``, n_tokens and both digests in one pass."""
    new_codec = _codec(docs, path, pattern)

    def make():
        codec = new_codec()
        sha = lambda x: hashlib.sha256(x).hexdigest()

        def run(text):
            n, ids_sha, bytes_sha = [], [], []
            for ids in codec.encode(text.to_pylist()):
                n.append(len(ids) // 4)
                ids_sha.append(sha(ids))
                bytes_sha.append(sha(codec.decode(ids)))
            return [pa.array(n, pa.int64()), pa.array(ids_sha, pa.string()), pa.array(bytes_sha, pa.string())]
        return run
    return arrow_rows(docs, list(keep), [text_col],
                      "n_tokens long, ids_sha256 string, decoded_sha256 string", make)


def encoded_and_checked(docs: DataFrame, path: str, pattern: str, keep=("doc_id",), text_col: str = "text") -> DataFrame:
    """``keep``, ids, n_tokens and round_trip (do the ids decode to the very bytes of the text)."""
    new_codec = _codec(docs, path, pattern)

    def make():
        codec = new_codec()

        def run(text):
            texts = text.to_pylist()
            ids = codec.encode(texts)
            same = [codec.decode(x) == (t or "").encode() for x, t in zip(ids, texts, strict=True)]
            return [pa.array(ids, pa.binary()), pa.array([len(x) // 4 for x in ids], pa.int64()), pa.array(same, pa.bool_())]
        return run
    return arrow_rows(docs, list(keep), [text_col], "ids binary, n_tokens long, round_trip boolean", make)


def vocabulary() -> tuple[str, str]:
    """Path of the public rank file and the pattern that cuts texts before its merges."""
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN


def query(spark, sf_dir: str) -> DataFrame:
    docs = picked(table(spark, sf_dir, "documents"), doc_id="doc_id", text="text")
    return round_trip(docs, *vocabulary())
