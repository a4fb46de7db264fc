"""Byte-pair encoding by backtracking, and decoding by an offset table.

A byte sequence is cut greedily: the longest vocabulary token starting here, as
found by an Aho-Corasick automaton, is taken if it may stand beside the token
before it.  Two tokens are compatible if byte-pair merging their joint bytes
gives just these two again; a sequence whose neighbours are all compatible is
the one that merging would reach.  If no token fits, the last one is undone and
its place is marked as a dead end, so that every position is visited a bounded
number of times and the work is linear in the length.

Defined results: null and empty texts have no tokens; any other column is
passed through; equal texts give equal tokens; an empty table gives none.
Special tokens standing in a text are recognised, as in the tokenizer file.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardline.llm.text import slices

#: Fixed values of byte-level tokenizers: how a text is cut into pieces ...
PIECES = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+"
    r"|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+"
)
#: ... and which bytes stand for themselves in the vocabulary file.
PRINTED = [*range(33, 127), *range(161, 173), *range(174, 256)]

#: Pieces and token pairs that a generation of a worker's memory holds.
REMEMBERED = 160_000


def _written_bytes() -> dict[str, int]:
    """The character that stands for each byte in the vocabulary file."""
    others = [b for b in range(256) if b not in set(PRINTED)]
    return {chr(b): b for b in PRINTED} | {chr(256 + i): b for i, b in enumerate(others)}


class _Known(dict):
    """A bounded memory of a function's results: what a full generation did not use again is forgotten."""

    def __init__(self, function):
        super().__init__()
        self.function, self.older = function, {}

    def __missing__(self, key):
        value = self.older.get(key)
        if value is None:
            value = self.function(key)
        if len(self) >= REMEMBERED:
            self.older = dict(self)
            self.clear()
        self[key] = value
        return value


class Vocabulary:
    """A byte-level BPE vocabulary, from the text of a tokenizer file."""

    def __init__(self, definition: str):
        spec = json.loads(definition)
        written = _written_bytes()
        raw = lambda s: bytes(map(written.__getitem__, s))
        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.ids = {raw(s): i for s, i in spec["model"]["vocab"].items() if s not in special}
        self.special = {s: np.uint32(i).tobytes() for s, i in special.items()}
        pairs = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
        self.ranks = {(raw(a), raw(b)): n for n, (a, b) in enumerate(pairs)}
        size = 1 + max([*self.ids.values(), *special.values()])
        tokens = [b""] * size
        for token, i in self.ids.items():
            tokens[i] = token
        for s, i in special.items():
            tokens[i] = s.encode()
        self.tokens = tokens
        self.automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS)
        for token, i in self.ids.items():
            self.automaton.add_word(token.decode("latin-1"), i)
        self.automaton.make_automaton()
        self.shorter = [self._next_shorter(t) for t in tokens]
        self.pieces = regex.compile(PIECES)
        self.specials = regex.compile("(" + "|".join(map(regex.escape, sorted(special, key=len, reverse=True))) + ")") if special else None
        self.compatible = _Known(lambda pair: self.merged(tokens[pair[0]] + tokens[pair[1]]) == list(pair))
        self.piece = _Known(lambda piece: np.array(self.encode_piece(piece.encode()), dtype="<u4").tobytes())
        # The offset table: all tokens one after the other, and where each begins.
        self.flat = np.frombuffer(b"".join(tokens), dtype=np.uint8)
        self.lengths = np.array([len(t) for t in tokens], dtype=np.int64)
        self.offsets = np.concatenate([[0], np.cumsum(self.lengths)])

    def _next_shorter(self, token: bytes) -> int:
        """The longest token that is a proper prefix of this one, or -1."""
        return next((self.ids[token[:n]] for n in range(len(token) - 1, 0, -1) if token[:n] in self.ids), -1)

    def merged(self, data: bytes) -> list[int]:
        """Tokens by merging pairs in rank order: the definition, used for short sequences."""
        parts = [data[i : i + 1] for i in range(len(data))]
        while len(parts) > 1:
            rank, at = min((self.ranks.get(pair, len(self.ranks)), i) for i, pair in enumerate(zip(parts, parts[1:], strict=False)))
            if rank == len(self.ranks):
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return [self.ids[p] for p in parts]

    def encode_piece(self, data: bytes) -> list[int]:
        whole = self.ids.get(data)
        if whole is not None and self.merged(data) == [whole]:
            return [whole]
        tokens, compatible = self.tokens, self.compatible
        longest = [-1] * len(data)
        for end, token in self.automaton.iter(data.decode("latin-1")):
            start = end + 1 - len(tokens[token])
            if longest[start] < 0 or len(tokens[longest[start]]) < len(tokens[token]):
                longest[start] = token
        out: list[int] = []
        open_at = bytearray(b"\x01") * (len(data) + 1)
        at, token = 0, longest[0]
        while at < len(data):
            while token >= 0 and not (
                open_at[at + len(tokens[token])] and (not out or compatible[out[-1], token])
            ):
                token = self.shorter[token]
            if token >= 0:
                out.append(token)
                at += len(tokens[token])
                token = longest[at] if at < len(data) else -1
            else:
                open_at[at] = 0
                token = out.pop()
                at -= len(tokens[token])
        return out

    def encode(self, text: str) -> bytes:
        """Token ids as little-endian unsigned 32-bit integers."""
        if self.specials is None or not self.specials.search(text):
            return b"".join(map(self.piece.__getitem__, self.pieces.findall(text)))
        return b"".join(
            self.special[part] if part in self.special else b"".join(map(self.piece.__getitem__, self.pieces.findall(part)))
            for part in self.specials.split(text)
        )

    def decode(self, ids: np.ndarray) -> np.ndarray:
        """Bytes of a token sequence, copied from the offset table."""
        lengths = self.lengths[ids]
        ends = np.cumsum(lengths)
        shift = self.offsets[ids] - (ends - lengths)
        return self.flat[np.arange(ends[-1] if len(ends) else 0) + np.repeat(shift, lengths)]


@lru_cache(maxsize=2)
def _vocabulary(definition: str) -> Vocabulary:
    return Vocabulary(definition)


def _definition(spark, path: str):
    """The tokenizer file, sent to each executor once; it has a fixed size of a few MB."""
    with open(path, encoding="utf-8") as file:
        return spark.sparkContext.broadcast(file.read())


def _ids(vocabulary: Vocabulary, column: pa.Array) -> list[bytes]:
    return [vocabulary.encode(text or "") for text in column.to_pylist()]


def _texts(vocabulary: Vocabulary, ids: list[bytes]) -> pa.Array:
    decoded = (vocabulary.decode(np.frombuffer(x, dtype="<u4")).tobytes() for x in ids)
    return pa.array([data.decode("utf-8", "replace") for data in decoded], pa.string())


def _counts(ids: list[bytes]) -> pa.Array:
    return pa.array([len(x) // 4 for x in ids], pa.int64())


def _with(docs: DataFrame, path: str, column: str, new: dict[str, str], work) -> DataFrame:
    """``docs`` with new columns that ``work`` makes of one column; that column itself goes."""
    others = [c for c in docs.columns if c not in (column, *new)]
    definition = _definition(docs.sparkSession, path)
    schema = docs.select(*others).schema
    for name, kind in new.items():
        schema = schema.add(name, kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = _vocabulary(definition.value)
        for batch in slices(batches, column, 1 << 20):
            made = work(vocabulary, batch.column(column))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in others), *made], names=[*others, *new])

    return docs.select(*others, column).mapInArrow(run, schema)


def encode(docs: DataFrame, path: str, column: str = "text") -> DataFrame:
    """``docs`` with ``ids`` (little-endian unsigned 32-bit integers) and ``n_tokens`` in place of its text."""

    def work(vocabulary: Vocabulary, texts: pa.Array) -> list[pa.Array]:
        ids = _ids(vocabulary, texts)
        return [pa.array(ids, pa.binary()), _counts(ids)]

    return _with(docs, path, column, {"ids": "binary", "n_tokens": "long"}, work)


def decode(encoded: DataFrame, path: str, column: str = "text") -> DataFrame:
    """``encoded`` with the text that its ``ids`` stand for in their place."""

    def work(vocabulary: Vocabulary, ids: pa.Array) -> list[pa.Array]:
        return [_texts(vocabulary, pc.fill_null(ids, b"").to_pylist())]

    return _with(encoded, path, "ids", {column: "string"}, work)


def round_trip(docs: DataFrame, path: str, column: str = "text") -> DataFrame:
    """``docs`` with ``ids``, ``n_tokens`` and the text ``decoded`` from the ids, in one pass over the texts."""

    def work(vocabulary: Vocabulary, texts: pa.Array) -> list[pa.Array]:
        ids = _ids(vocabulary, texts)
        return [pa.array(ids, pa.binary()), _counts(ids), _texts(vocabulary, ids)]

    return _with(docs, path, column, {"ids": "binary", "n_tokens": "long", "decoded": "string"}, work)


def byte_bpe_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op8_bpe_round_trip(spark, sf_dir: str, path: str | None = None) -> DataFrame:
    """Tokens of every document's whole text and the text decoded from them, as digests."""
    path = path or byte_bpe_path()
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return round_trip(docs, path).select(
        "doc_id",
        "n_tokens",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )
