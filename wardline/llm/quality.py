"""Document quality: ridge regression on random Fourier features, calibrated to probabilities.

Every text is reduced to a few dozen statistics of its characters, words and
lines.  Random Fourier features of these approximate a Gaussian kernel, so that a
linear model on them can bend; its normal equations are sums over rows, which
partitions form on their own.  Two half models, each fitted on one half of the
training rows, score the other half; isotonic regression of the labels on these
scores gives the probabilities.  What reaches the driver are sums and score bins
of fixed size.

Defined results: null and empty texts are scored by their (empty) statistics;
equal texts get equal scores; a null label is not learned from; a document with
several labels is learned once with each; without any label all scores are 0.5;
other columns do not matter.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType

from wardline.llm.exchange import packed, stored, unpacked
from wardline.llm.langid import held_out
from wardline.llm.text import BYTE_VALUES, PrefixHash, Words, slices

#: Random features, ridge penalty per feature, bins of scores for calibration.
FEATURES, PENALTY, BINS = 384, 1.0, 512

#: Least score that counts as good.
GOOD = 0.3

#: Values that travel as one row when sums are added up.
CHUNK = 1 << 13

_CLASSES = {
    "upper": [*range(65, 91)],
    "lower": [*range(97, 123)],
    "digit": [*range(48, 58)],
    "wide": [*range(128, 256)],
    "stop": [ord(c) for c in ".,;:?"],
    "loud": [ord("!")],
    "rule": [ord(c) for c in "|_=~"],
    "mark": [ord(c) for c in "*#%&$@^+<>{}[]\\/"],
    "line": [10],
}
_TABLE = np.zeros((len(_CLASSES), 256), dtype=bool)
for _row, _bytes in enumerate(_CLASSES.values()):
    _TABLE[_row, _bytes] = True

STATISTICS = [
    *_CLASSES, "length", "words", "word_length", "word_spread", "distinct", "doubled", "topped",
    "pairs", "ended", "capital", "line_length", "lines_distinct",
]


def _per_document(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    return np.diff(np.concatenate([[0], np.cumsum(values, dtype=np.float64)])[bounds])


def _distinct(owner: np.ndarray, values: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values of each owner, and how often its most frequent one occurs."""
    order = np.lexsort((values, owner))
    owner, values = owner[order], values[order]
    fresh = np.ones(len(owner), dtype=bool)
    fresh[1:] = (owner[1:] != owner[:-1]) | (values[1:] != values[:-1])
    first = np.flatnonzero(fresh)
    most = np.zeros(count)
    np.maximum.at(most, owner[first], np.diff(np.append(first, len(owner))))
    return np.bincount(owner[first], minlength=count), most


def statistics(column: pa.Array) -> np.ndarray:
    """One row of statistics per text, each of moderate size."""
    words = Words(column)
    n, data, offsets = len(words.counts), words.data, words.offsets
    size, count = np.diff(offsets).astype(float), words.counts.astype(float)
    shares = [_per_document(row[data], offsets) / np.maximum(size, 1) for row in _TABLE]
    lengths = (words.ends - words.starts).astype(float)
    mean = _per_document(lengths, words.bounds) / np.maximum(count, 1)
    square = _per_document(lengths * lengths, words.bounds) / np.maximum(count, 1)
    hashes = words.hashes()
    distinct, most = _distinct(words.doc, hashes, n)
    same = np.zeros(len(hashes))
    same[1:] = (hashes[1:] == hashes[:-1]) & (words.doc[1:] == words.doc[:-1])
    starts, pairs = words.runs(hashes, 2)
    pair_count, _ = _distinct(words.doc[starts], pairs, n)
    ended = _TABLE[4][data[words.ends - 1]] if len(hashes) else np.zeros(0)
    capital = _TABLE[0][data[words.starts]] if len(hashes) else np.zeros(0)
    # A line is named by the sum of its bytes' places; good enough to notice repeated ones.
    breaks = data == 10
    line = np.cumsum(breaks) + np.repeat(np.arange(n), size.astype(int)) if len(data) else np.zeros(0, dtype=int)
    first = np.flatnonzero(np.diff(line, prepend=-1)) if len(data) else np.zeros(0, dtype=int)
    ends = np.append(first[1:], len(data)) if len(first) else first
    names = PrefixHash(BYTE_VALUES[np.where(breaks, 32, data)]).of(first, ends - first)
    owner = np.searchsorted(offsets, first, side="right") - 1
    lines = np.bincount(owner, minlength=n).astype(float)
    lines_distinct, _ = _distinct(owner, names, n)
    safe = np.maximum(count, 1)
    return np.column_stack(
        [
            *(np.sqrt(s) for s in shares),
            np.log1p(size), np.log1p(count), np.log1p(mean), np.log1p(np.sqrt(np.maximum(square - mean * mean, 0))),
            distinct / safe, np.sqrt(_per_document(same, words.bounds) / safe), most / safe,
            pair_count / np.maximum(count - 1, 1), _per_document(ended, words.bounds) / safe,
            _per_document(capital, words.bounds) / safe, np.log1p(count / np.maximum(lines, 1)), lines_distinct / np.maximum(lines, 1),
        ]
    )


@dataclass(frozen=True)
class Model:
    """Scaling, random features, ridge weights, and the calibration's corners."""

    mean: np.ndarray
    scale: np.ndarray
    directions: np.ndarray
    phases: np.ndarray
    weights: np.ndarray
    scores: np.ndarray
    shares: np.ndarray

    def mapped(self, x: np.ndarray) -> np.ndarray:
        """Random Fourier features of standardised statistics, and a constant."""
        x = np.clip((x - self.mean) / self.scale, -8, 8)
        waves = np.cos(x @ self.directions + self.phases) * np.sqrt(2 / self.directions.shape[1])
        return np.column_stack([waves, np.ones(len(x))])

    def predict(self, x: np.ndarray) -> np.ndarray:
        return np.interp(self.mapped(x) @ self.weights, self.scores, self.shares)


def _added(rows: DataFrame, sums, size: int) -> np.ndarray:
    """Sum over all rows of what ``sums`` makes of a batch: partitions add up, then pieces of the vector do."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size)
        for batch in batches:
            total += sums(batch)
        yield from packed(np.arange(size) // CHUNK, {"total": total})

    def add(table: pa.Table) -> pa.Table:
        total = unpacked(table["total"], np.float64).reshape(table.num_rows, -1).sum(axis=0)
        return pa.table({"bucket": table["bucket"].slice(0, 1), "total": pa.array([total.tobytes()], pa.binary())})

    parts = rows.mapInArrow(run, "bucket int, total binary").groupBy("bucket").applyInArrow(add, "bucket int, total binary")
    out = np.zeros(size)
    for row in parts.collect():
        piece = np.frombuffer(row["total"])
        out[row["bucket"] * CHUNK : row["bucket"] * CHUNK + len(piece)] = piece
    return out


def _table(batch: pa.RecordBatch) -> np.ndarray:
    return batch.column("statistics").flatten().to_numpy().reshape(batch.num_rows, -1)


def isotonic(position: np.ndarray, count: np.ndarray, good: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool neighbouring bins until the share of good ones never falls; the pools' mean positions and shares."""
    pools: list[list[float]] = []
    for p, n, g in zip(position, count, good, strict=True):
        pools.append([p * n, n, g])
        while len(pools) > 1 and pools[-2][2] * pools[-1][1] >= pools[-1][2] * pools[-2][1]:
            last = pools.pop()
            pools[-1] = [a + b for a, b in zip(pools[-1], last, strict=True)]
    table = np.array(pools).reshape(-1, 3)
    # Half a document more on either side keeps scores off 0 and 1.
    return table[:, 0] / table[:, 1], (table[:, 2] + 0.5) / (table[:, 1] + 1)


def train(labelled: DataFrame, seed: int = 11) -> Model:
    """Learn from rows of ``statistics``, ``label`` (0 or 1) and ``half`` (0 or 1)."""
    wide = len(STATISTICS)
    moments = _added(
        labelled,
        lambda b: np.concatenate([[b.num_rows], (x := _table(b)).sum(axis=0), (x * x).sum(axis=0)]),
        1 + 2 * wide,
    )
    n = max(moments[0], 1)
    mean = moments[1 : 1 + wide] / n
    scale = np.sqrt(np.maximum(moments[1 + wide :] / n - mean * mean, 1e-6))
    rng = np.random.default_rng(seed)
    directions = rng.normal(size=(wide, FEATURES)) / np.sqrt(wide)
    blank = Model(mean, scale, directions, rng.uniform(0, 2 * np.pi, FEATURES), np.zeros(FEATURES + 1), np.zeros(1), np.full(1, 0.5))
    if not moments[0]:
        return blank
    size = FEATURES + 1

    def equations(batch: pa.RecordBatch) -> np.ndarray:
        z, y = blank.mapped(_table(batch)), batch.column("label").to_numpy().astype(float)
        half = batch.column("half").to_numpy()
        return np.concatenate([np.concatenate([(z[half == h].T @ z[half == h]).ravel(), z[half == h].T @ y[half == h]]) for h in (0, 1)])

    sums = _added(labelled, equations, 2 * (size * size + size)).reshape(2, -1)

    def solve(total: np.ndarray) -> np.ndarray:
        penalty = np.full(size, PENALTY)
        penalty[-1] = 1e-6
        return np.linalg.solve(total[: size * size].reshape(size, size) + np.diag(penalty), total[size * size :])

    halves = [solve(sums[1]), solve(sums[0])]  # the model for a half is fitted on the other

    def binned(batch: pa.RecordBatch) -> np.ndarray:
        z, y, half = blank.mapped(_table(batch)), batch.column("label").to_numpy().astype(float), batch.column("half").to_numpy()
        score = np.where(half == 0, z @ halves[0], z @ halves[1])
        at = np.clip(((score + 0.5) / 2 * BINS).astype(int), 0, BINS - 1)
        return np.concatenate([np.bincount(at, weights=w, minlength=BINS) for w in (np.ones(len(y)), y, score)])

    count, good, score = _added(labelled, binned, 3 * BINS).reshape(3, -1)
    used = count > 0
    scores, shares = isotonic(score[used] / count[used], count[used], good[used])
    return Model(mean, scale, directions, blank.phases, solve(sums.sum(axis=0)), scores, shares)


def described(docs: DataFrame) -> DataFrame:
    """``doc_id, statistics`` of every whole text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            values = statistics(batch.column("text"))
            lists = pa.FixedSizeListArray.from_arrays(pa.array(values.ravel()), values.shape[1]).cast(pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), lists], names=["doc_id", "statistics"])

    schema = docs.select("doc_id").schema.add("statistics", ArrayType(DoubleType()))
    return docs.select("doc_id", "text").mapInArrow(run, schema)


def score(rows: DataFrame, model: Model) -> DataFrame:
    """Rows of ``doc_id, statistics`` with their ``score``."""
    shared = rows.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = shared.value.predict(_table(batch)) if batch.num_rows else np.zeros(0)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found)], names=["doc_id", "score"])

    schema = rows.select("doc_id").schema.add("score", "double")
    return rows.select("doc_id", "statistics").mapInArrow(run, schema)


def op4_quality(spark, sf_dir: str) -> DataFrame:
    """The quality of every document, learned from the labels of four fifths of them."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", F.col("quality").alias("label"))
    rows = stored(described(docs), "statistics")
    fold = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5
    taught = rows.join(labels.where(F.col("label").isin(0, 1)), "doc_id").where(fold != 0)
    model = train(stored(taught.select("statistics", "label", (fold % 2).cast("int").alias("half")), "labelled"))
    return score(rows, model).select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= GOOD).cast("int").alias("predicted"),
    )
