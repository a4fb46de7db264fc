"""Importance resampling of documents towards the distribution of a target corpus.

Features of a text are its runs of one to three words, hashed to a fixed number of
buckets.  How much more often the target corpus uses a bucket than the documents do is
the bucket's gain; all gains are one array, and a text's weight is the sum of its
features' entries.  Gumbel noise drawn from the document's id turns the highest scores
into a sample without replacement.

The sample is found without sorting the documents: scores are written once, then the
cutoff is found by bisection, each step an exact count over the stored numbers; where
the cutoff is tied, a second bisection over ids decides.  Only the rows above it are
range-partitioned, which gives them their ranks.

Defined results: null and empty texts have no features, weight 0 and are never drawn;
a null id is noise of the empty id and ranks after all others of its score; equal
rows are drawn one by one, any of them first; an empty target gives every bucket
the same share; an empty table gives an empty result; other columns do not matter.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from wardline.llm.exchange import stored
from wardline.llm.text import FOLD, slices, text_bytes

#: Buckets of features, longest run of words, percentage drawn, fewest words of a drawn document, seed.
BUCKETS, LONGEST, PERCENT, FEWEST, SEED = 10_000, 3, 5, 20, 42

#: Points at which one job counts: so many halve an interval four times.
POINTS = 15

#: Bytes of letters, digits and everything beyond ASCII; the rest separates words.
_WORD = np.zeros(256, dtype=bool)
_WORD[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True


def _byte_table() -> np.ndarray:
    """What CRC-32 makes of each byte, by its polynomial."""
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = (table >> np.uint32(1)) ^ (np.uint32(0xEDB88320) * (table & np.uint32(1)))
    return table


_BYTES = _byte_table()

#: Words up to this length are hashed byte by byte, all at once; a distance is split here too.
_NEAR = 64


def _moved(shift: np.ndarray, crc: np.ndarray) -> np.ndarray:
    """``crc`` as if the bytes that ``shift`` (four tables) stands for had followed, all zero."""
    out = shift[..., 0, crc & np.uint32(255)]
    for k in (1, 2, 3):
        out = out ^ shift[..., k, (crc >> np.uint32(8 * k)) & np.uint32(255)]
    return out


def _shift_tables() -> tuple[np.ndarray, list[np.ndarray]]:
    """Tables for 0 to 63 zero bytes, and for 64, 128, 256 ... of them."""
    values = np.arange(256, dtype=np.uint32)
    one = np.stack([values << np.uint32(8 * k) for k in range(4)])
    near = [one]
    for _ in range(_NEAR):
        near.append((near[-1] >> np.uint32(8)) ^ _BYTES[near[-1] & np.uint32(255)])
    far = [near[_NEAR]]
    for _ in range(25):
        far.append(_moved(far[-1], far[-1]))
    return np.stack(near[:_NEAR]), far


_SHIFT, _FAR = _shift_tables()


def followed(crc: np.ndarray, length: np.ndarray) -> np.ndarray:
    """CRC-32 values carried over ``length`` bytes: ``followed(crc(a), len(b)) ^ crc(b)`` is ``crc(a + b)``."""
    low = length % _NEAR
    out = _SHIFT[low, 0, crc & np.uint32(255)]
    for k in (1, 2, 3):
        out = out ^ _SHIFT[low, k, (crc >> np.uint32(8 * k)) & np.uint32(255)]
    high = length // _NEAR
    for table in _FAR:
        chosen = np.flatnonzero(high & 1)
        if len(chosen):
            out[chosen] = _moved(table, out[chosen])
        high = high >> 1
        if not high.any():
            break
    return out


class Features:
    """The hashed features of a slice of texts."""

    def __init__(self, column: pa.Array):
        data, offsets = text_bytes(column)
        data = FOLD[data]
        edge = np.zeros(len(data) + 1, dtype=bool)
        edge[offsets] = True
        inside = _WORD[data]
        first, last = inside.copy(), inside.copy()
        if len(data):
            first[1:] &= ~inside[:-1] | edge[1:-1]
            last[:-1] &= ~inside[1:] | edge[1:-1]
        starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
        self.n_words = np.diff(np.searchsorted(starts, offsets))
        self.bounds = np.concatenate([[0], np.cumsum(self.n_words)])
        self.doc = np.repeat(np.arange(len(self.n_words)), self.n_words)
        lengths = ends - starts
        self._crcs = self._hashed(data, starts, lengths)
        self._lengths = lengths

    @staticmethod
    def _hashed(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """CRC-32 of every word."""
        out = np.zeros(len(starts), dtype=np.uint32)
        order = np.argsort(-np.minimum(lengths, _NEAR + 1).astype(np.int8), kind="stable")
        long = int((lengths > _NEAR).sum())
        for i in order[:long]:
            out[i] = zlib.crc32(data[starts[i] : starts[i] + lengths[i]].tobytes())
        order = order[long:]
        at, state = starts[order], np.full(len(order), 0xFFFFFFFF, dtype=np.uint32)
        alive = len(order) - np.cumsum(np.bincount(lengths[order], minlength=_NEAR + 1))
        for k in range(_NEAR):
            n = int(alive[k])
            if not n:
                break
            state[:n] = (state[:n] >> np.uint32(8)) ^ _BYTES[(state[:n] ^ data[at[:n] + k]) & np.uint32(255)]
        out[order] = ~state
        return out

    def runs(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """For each run length: the first words of the runs, and their buckets."""
        crc, n = self._crcs, len(self._crcs)
        if not n:
            return
        space = np.full(n, zlib.crc32(b" "), dtype=np.uint32)
        spaced = followed(space, self._lengths) ^ self._crcs
        for length in range(1, LONGEST + 1):
            if length > 1:
                crc = followed(crc[:-1], self._lengths[length - 1 :] + 1) ^ spaced[length - 1 :]
            at = np.flatnonzero(self.doc[: n - length + 1] == self.doc[length - 1 :])
            yield at, (crc[at] % np.uint32(BUCKETS)).astype(np.int64)


def bucket_counts(texts: DataFrame) -> DataFrame:
    """``bucket, n``: the features of all whole texts, counted in each task before they travel."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = np.zeros(BUCKETS, dtype=np.int64)
        for part in slices(batches):
            for _, buckets in Features(part.column("text")).runs():
                found += np.bincount(buckets, minlength=BUCKETS)
        used = np.flatnonzero(found)
        yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), pa.array(found[used])], names=["bucket", "n"])

    parts = texts.select("text").mapInArrow(counted, "bucket int, n long")
    return parts.groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(docs: DataFrame, target: DataFrame) -> np.ndarray:
    """The gain of every bucket; two lists of at most ``BUCKETS`` counts reach the driver."""
    have, want = np.zeros(BUCKETS), np.zeros(BUCKETS)
    for side, texts in ((have, docs), (want, target)):
        for bucket, n in bucket_counts(texts).collect():
            side[bucket] = n
    ratio = ((want + 1) * (have.sum() + BUCKETS)) / ((have + 1) * (want.sum() + BUCKETS))
    return np.array([math.floor(1000 * math.log(x)) for x in ratio], dtype=np.int64)


def _noise(doc_id: Column) -> Column:
    """Gumbel noise of an id, in thousandths."""
    digest = F.sha2(F.concat(F.lit(f"{SEED}:"), F.coalesce(doc_id.cast("string"), F.lit(""))).cast("binary"), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0)))


def scored(docs: DataFrame, gain: np.ndarray, carry: bool = False) -> DataFrame:
    """``doc_id, n_words, n_features, weight, score``, with ``carry`` also the row itself as ``doc``."""
    rows = docs.select("doc_id", "text", *([F.struct("*").alias("doc")] if carry else []))
    kept = [f for f in rows.schema.fields if f.name != "text"]
    numbers = ("n_words", "n_features", "weight")

    def weighed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            features = Features(part.column("text"))
            each, count = np.zeros(len(features.doc), dtype=np.int64), np.zeros(len(features.doc), dtype=np.int64)
            for at, buckets in features.runs():
                each[at] += gain[buckets]
                count[at] += 1
            weight, total = (np.diff(np.concatenate([[0], np.cumsum(x)])[features.bounds]) for x in (each, count))
            yield pa.RecordBatch.from_arrays(
                [
                    *(part.column(f.name) for f in kept),
                    pa.array(features.n_words.astype(np.int64)), pa.array(total), pa.array(weight),
                ],
                names=[*(f.name for f in kept), *numbers],
            )

    found = rows.mapInArrow(weighed, StructType([*kept, *(StructField(n, LongType()) for n in numbers)]))
    return found.withColumn("score", (F.col("weight") + _noise(F.col("doc_id"))).cast("long"))


def bisected(low: int, high: int, holds: Callable[[list[int]], list[bool]]) -> int:
    """The greatest value in ``low..high`` that holds, if all below it do; ``low`` is known to.

    ``holds`` judges ``POINTS`` values at once, so a call stands for four halvings.
    """
    while low < high:
        step = max(1, -(-(high - low) // (POINTS + 1)))
        points = list(range(low + step, high + 1, step))
        passed = [p for p, ok in zip(points, holds(points), strict=True) if ok]
        low, high = (passed[-1] if passed else low), min(high, (passed[-1] if passed else low) + step - 1)
    return low


def _counts(rows: DataFrame, conditions: list[Column]) -> list[int]:
    """One job: how many rows meet each condition."""
    return list(rows.agg(*[F.count_if(c) for c in conditions]).first())


def above_cutoff(rows: DataFrame, wanted: int) -> Column:
    """Which of ``rows`` (stored, with ``score`` and ``doc_id``) are the ``wanted`` first.

    Rows equal in score and id may be one group of which only some are wanted; all of
    them meet the condition.
    """
    score, doc = F.col("score"), F.col("doc_id")
    if wanted <= 0:
        return F.lit(False)
    low, high = rows.agg(F.min("score"), F.max("score")).first()
    cut = bisected(low, high, lambda points: [n >= wanted for n in _counts(rows, [score >= p for p in points])])
    more, named = _counts(rows, [score > cut, (score == cut) & doc.isNotNull()])
    above, tied = F.coalesce(score > cut, F.lit(False)), score == cut
    if wanted - more > named:
        return above | tied
    least, most = rows.where(tied).agg(F.min("doc_id"), F.max("doc_id")).first()
    # Ids up to one below the last wanted are too few; the greatest such value decides.
    short = bisected(
        least - 1, most, lambda points: [n < wanted - more for n in _counts(rows.where(tied), [doc <= p for p in points])]
    )
    return above | F.coalesce(tied & (doc <= short + 1), F.lit(False))


def ranked(chosen: DataFrame) -> DataFrame:
    """``chosen`` with its ``rank`` by falling score, then id: places within ranges, behind all earlier ranges."""
    order = [F.desc("score"), F.asc_nulls_last("doc_id"), F.asc("turn")]
    place = F.monotonically_increasing_id()
    ranges = stored(chosen.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("place", place), "resample-ranges")
    ranges = ranges.withColumn("range", F.shiftright("place", 33)).withColumn("place", F.col("place").bitwiseAND((1 << 33) - 1))
    sizes = ranges.groupBy("range").agg(F.count("*").alias("n"))  # a row for each partition
    earlier = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("range", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("start"))
    return ranges.join(starts, "range").withColumn("rank", F.col("start") + F.col("place") + 1).drop("range", "place", "start")


def resampled(docs: DataFrame, target: DataFrame, percent: int = PERCENT, fewest: int = FEWEST, carry: bool = False) -> DataFrame:
    """Per document ``doc_id, n_words, n_features, weight, score, rank``, with ``carry`` also ``doc``, the row itself.

    ``percent`` of the documents with at least ``fewest`` words are drawn; ``rank`` is
    null for the others.
    """
    turn = F.monotonically_increasing_id()
    rows = stored(scored(docs, gains(docs, target), carry).withColumn("turn", turn), "resample-scores")
    able = rows.where(F.col("n_words") >= fewest)
    wanted = percent * able.count() // 100
    drawn = above_cutoff(able, wanted) & (F.col("n_words") >= fewest)
    first = ranked(rows.where(drawn))
    rank = F.when(F.col("rank") <= wanted, F.col("rank")).cast("long")  # copies at the very end may be too many
    rest = rows.where(~drawn).withColumn("rank", F.lit(None).cast("long"))
    return first.withColumn("rank", rank).unionByName(rest).drop("turn")


def draw(docs: DataFrame, target: DataFrame, percent: int = PERCENT, fewest: int = FEWEST) -> DataFrame:
    """The drawn rows of ``docs``, highest score first."""
    return resampled(docs, target, percent, fewest, carry=True).where("rank IS NOT NULL").orderBy("rank").select("doc.*")


ORACLE = r"""
WITH nibbles AS MATERIALIZED (
  SELECT list(CASE WHEN d & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END ORDER BY n) AS t FROM (
    SELECT n, c, c AS d FROM (
      SELECT n, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END AS c FROM (
        SELECT n, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END AS c FROM (
          SELECT n, CASE WHEN n & 1 = 1 THEN xor(n >> 1, 3988292384) ELSE n >> 1 END AS c FROM range(0, 16) AS r(n)))))
), sides AS (
  SELECT row_number() OVER () AS row, doc_id, text, true AS own FROM documents
  UNION ALL SELECT -row_number() OVER (), NULL, text, false FROM benchmark
), listed AS MATERIALIZED (
  SELECT row, doc_id, own,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
  FROM sides
), places AS (
  SELECT row, words, unnest(range(1, len(words) + 1)) AS i FROM listed
), features AS MATERIALIZED (
  SELECT row, array_to_string(words[i : i + k], ' ') AS feature
  FROM places, range(0, 3) AS r(k) WHERE i + k <= len(words)
), kinds AS (
  SELECT DISTINCT feature FROM features
), spelled AS (
  SELECT feature, hex(encode(feature)) AS h FROM kinds
), hashed AS MATERIALIZED (
  SELECT feature, xor(4294967295, list_reduce(
    list_prepend(4294967295::BIGINT, flatten(list_transform(range(0, length(h) // 2), lambda j: [
      strpos('0123456789ABCDEF', h[2 * j + 2])::BIGINT - 1, strpos('0123456789ABCDEF', h[2 * j + 1])::BIGINT - 1]))),
    lambda c, n: xor(c >> 4, t[xor(c, n) % 16 + 1]))) % 10000 AS bucket
  FROM spelled, nibbles
), counts AS (
  SELECT bucket, count_if(own) AS s, count_if(NOT own) AS t
  FROM features JOIN hashed USING (feature) JOIN listed USING (row) GROUP BY bucket
), gains AS (
  SELECT bucket, floor(1000 * ln(((t + 1)::DOUBLE * (sum(s) OVER () + 10000)::DOUBLE)
                                 / ((s + 1)::DOUBLE * (sum(t) OVER () + 10000)::DOUBLE)))::BIGINT AS gain FROM counts
), weights AS (
  SELECT row, count(*) AS n_features, sum(gain)::BIGINT AS weight
  FROM features JOIN hashed USING (feature) JOIN gains USING (bucket) GROUP BY row
), scores AS (
  SELECT row, doc_id, len(words) AS n_words, coalesce(n_features, 0)::BIGINT AS n_features, coalesce(weight, 0)::BIGINT AS weight,
         coalesce(weight, 0)::BIGINT
         + floor(-1000 * ln(-ln((('0x' || substring(sha256('42:' || doc_id), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296)))::BIGINT AS score
  FROM listed LEFT JOIN weights USING (row) WHERE own
), ordered AS (
  SELECT row, row_number() OVER (ORDER BY score DESC, doc_id) AS place, count(*) OVER () AS n FROM scores WHERE n_words >= 20
)
SELECT doc_id, n_features, weight, score, CASE WHEN place <= 5 * n // 100 THEN place END AS rank
FROM scores LEFT JOIN ordered USING (row)
"""


def op11_resample(spark, sf_dir: str) -> DataFrame:
    """5% of all documents drawn towards the texts of ``benchmark``."""
    docs, target = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "benchmark"))
    return resampled(docs, target).select("doc_id", "n_features", "weight", "score", "rank")
