"""Language identification with error-correcting output codes.

Every language has a codeword; a binary classifier per bit tells, from hashed
character n-grams, the languages whose codeword has a one there from the others.
The classifiers are naive Bayes: their weights follow from n-gram counts per
language, which are summed over all labelled training rows.  A text is decoded
to the codeword with the smallest weighted loss over all bits; so a few wrong
bits do no harm, and a small lead over the runner-up marks a text as ambiguous.

Defined results: a null text, or one without a letter, is ``und`` with score 0
and not ambiguous; a null language is not learned from; equal texts get equal
results; with no training rows everything is ``und``; other columns pass through.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardline.llm.exchange import packed, unpacked
from wardline.llm.text import mix, slices

UNKNOWN = "und"

#: Hash buckets of n-grams, and the lengths of n-grams that are used.
BUCKETS, ORDERS = 1 << 16, (1, 2, 3)

#: Buckets of counts that travel as one row.
CHUNK = 1 << 12

#: Bytes of text worked on at once; n-grams take many times their size.
SLICE = 1 << 19

#: How sharply losses turn into a score, and the score under which a text is ambiguous.
SHARPNESS, CLEAR = 2.0, 0.5


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), dtype=bool, count=0x110000)


def _grams(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """N-gram buckets of all texts, where each text's begin, and whether it has a letter.

    Everything but letters counts as one blank; each text is set between blanks.
    """
    lowered = [t.lower() if t else "" for t in texts]
    points = np.frombuffer((" " + " ".join(lowered) + " ").encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    letter = _letters()[points]
    points = np.where(letter, points, 32).astype(np.uint64)
    sizes = np.fromiter((len(t) + 1 for t in lowered), dtype=np.int64, count=len(lowered))
    bounds = np.concatenate([[0], np.cumsum(sizes)])
    padded = np.append(points, np.full(max(ORDERS), 32, dtype=np.uint64))
    grams = np.zeros((len(points) - 1, len(ORDERS)), dtype=np.int64)
    for k, order in enumerate(ORDERS):
        rolled = np.zeros(len(points) - 1, dtype=np.uint64)
        for i in range(order):
            rolled = rolled * np.uint64(0x110000) + padded[i : i + len(rolled)]
        grams[:, k] = (mix(rolled + np.uint64(order << 62)) >> np.uint64(48)).astype(np.int64)
    known = np.add.reduceat(letter[:-1].astype(np.int64), bounds[:-1]) > 0 if len(texts) else np.zeros(0, dtype=bool)
    # Two blanks in a row tell nothing.
    told = letter[:-1] | letter[1:]
    starts = np.concatenate([[0], np.cumsum(told)])[bounds]
    return grams[told], starts, known


def codewords(count: int) -> np.ndarray:
    """``count`` codewords of signs: the exhaustive code for few languages, else well separated random ones."""
    if count < 2:
        return np.ones((count, 0), dtype=np.int8)
    if count <= 6:
        words = [[1 - 2 * (column >> row & 1) for column in range(0, 1 << count, 2)][1:] for row in range(count)]
        return np.array(words, dtype=np.int8)
    length = 12 * int(np.ceil(np.log2(count)))
    rng = np.random.default_rng(count)
    best, apart = None, -1
    for _ in range(50):
        words = rng.choice(np.array([-1, 1], dtype=np.int8), size=(count, length))
        agree = words.astype(np.int32) @ words.T.astype(np.int32)
        np.fill_diagonal(agree, -length)
        split = np.abs(words.sum(axis=0)).max() < count
        distance = (length - agree.max()) // 2 if split else -1
        if distance > apart:
            best, apart = words, distance
    return best


@dataclass(frozen=True)
class Model:
    """Languages, their codewords, and the binary classifiers."""

    languages: list[str]
    codes: np.ndarray
    weights: np.ndarray
    centre: np.ndarray
    spread: np.ndarray
    trust: np.ndarray

    @classmethod
    def fit(cls, languages: list[str], counts: np.ndarray) -> Model:
        """``counts``: n-gram counts, a row per language."""
        codes = codewords(len(languages))
        rates = (counts + 0.5) / (counts + 0.5).sum(axis=1, keepdims=True)
        weights = np.empty((BUCKETS, codes.shape[1]), dtype=np.float32)
        for bit in range(codes.shape[1]):
            ones, zeros = rates[codes[:, bit] > 0].mean(axis=0), rates[codes[:, bit] < 0].mean(axis=0)
            weights[:, bit] = np.log(ones) - np.log(zeros)
        typical = rates @ weights  # a language's usual margin at each bit
        high = np.where(codes > 0, typical, np.inf).min(axis=0, initial=np.inf)
        low = np.where(codes < 0, typical, -np.inf).max(axis=0, initial=-np.inf)
        spread = np.maximum((high - low) / 2, 1e-6)
        trust = spread / spread.sum() if len(spread) else spread
        return cls(languages, codes, weights, (high + low) / 2, spread, trust)

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Language, score and ambiguity of each text."""
        grams, starts, known = _grams(texts)
        lengths = np.diff(starts)
        known = known & (lengths > 0) & bool(self.languages)
        margins = np.zeros((len(texts), self.codes.shape[1]))
        if known.any() and margins.shape[1]:
            per_place = np.zeros((len(grams), margins.shape[1]), dtype=np.float32)
            for k in range(grams.shape[1]):
                per_place += self.weights[grams[:, k]]
            rows = np.flatnonzero(known)
            # Rows without a place lie between the kept starts and are empty.
            margins[rows] = np.add.reduceat(per_place, starts[rows], axis=0) / (lengths[rows, None] * grams.shape[1])
        margins = (margins - self.centre) / self.spread if margins.shape[1] else margins
        losses = np.logaddexp(0, -margins[:, None, :] * self.codes[None, :, :]) @ self.trust
        shares = np.exp(-SHARPNESS * len(self.trust) * (losses - losses.min(axis=1, keepdims=True))) if self.languages else losses
        best = shares.argmax(axis=1) if self.languages else np.zeros(len(texts), dtype=int)
        scores = np.where(known, shares[np.arange(len(texts)), best] / shares.sum(axis=1), 0.0) if self.languages else np.zeros(len(texts))
        names = [self.languages[b] if k else UNKNOWN for b, k in zip(best, known, strict=True)]
        return names, scores, known & (scores < CLEAR)


def held_out(doc_id: Column, folds: int = 5) -> Column:
    """Whether a row belongs to the fold that is never learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds == 0, F.lit(False))


def train(labelled: DataFrame, text: str = "text", language: str = "lang") -> Model:
    """Learn from every row with a language.  What reaches the driver is a fixed number of counts per language."""
    rows = labelled.where(F.col(language).isNotNull()).select(F.col(text).alias("text"), F.col(language).alias("lang"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in slices(batches, limit=SLICE):
            names, codes = np.unique(np.array(batch.column("lang").to_pylist(), dtype=object), return_inverse=True)
            grams, starts, _ = _grams(batch.column("text").to_pylist())
            owner = np.repeat(codes, np.diff(starts))
            for i, name in enumerate(names):
                total = sums.setdefault(name, np.zeros(BUCKETS, dtype=np.int64))
                total += np.bincount(grams[owner == i].ravel(), minlength=BUCKETS)
        for name, total in sums.items():
            for part in packed(np.arange(BUCKETS) // CHUNK, {"counts": total}):
                yield part.append_column("lang", pa.array([name] * part.num_rows))

    def add(table: pa.Table) -> pa.Table:
        total = unpacked(table["counts"], np.int64).reshape(table.num_rows, -1).sum(axis=0)
        return table.slice(0, 1).drop_columns("counts").append_column("counts", pa.array([total.tobytes()], pa.binary()))

    parts = rows.mapInArrow(count, "bucket int, counts binary, lang string")
    summed = parts.groupBy("lang", "bucket").applyInArrow(add, "bucket int, lang string, counts binary").collect()
    languages = sorted({r["lang"] for r in summed})
    counts = np.zeros((len(languages), BUCKETS))
    for r in summed:
        at = r["bucket"] * CHUNK
        counts[languages.index(r["lang"]), at : at + CHUNK] = np.frombuffer(r["counts"], dtype=np.int64)
    return Model.fit(languages, counts)


def identify(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred``, ``score`` and ``ambiguous``."""
    kept = [c for c in docs.columns if c not in ("lang_pred", "score", "ambiguous")]
    schema = docs.select(*kept).schema.add("lang_pred", "string").add("score", "double").add("ambiguous", "boolean")
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text, SLICE):
            names, scores, ambiguous = shared.value.predict(batch.column(text).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(names, pa.string()), pa.array(scores), pa.array(ambiguous)],
                names=[*kept, "lang_pred", "score", "ambiguous"],
            )

    return docs.select(*kept).mapInArrow(run, schema)


def keep_identified(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """The rows whose language is clear, as they are."""
    told = identify(docs.select(F.struct("*").alias("doc"), F.col(text).alias("text")), model)
    return told.where((F.col("lang_pred") != UNKNOWN) & ~F.col("ambiguous")).select("doc.*")


def op1_language(spark, sf_dir: str) -> DataFrame:
    """The language of every document, learned from the labels of four fifths of them."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = train(docs.where(~held_out(F.col("doc_id"))))
    found = identify(docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "text"), model)
    return found.select("doc_id", "held_out", "lang_pred", "score", "ambiguous")
