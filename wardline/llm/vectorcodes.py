"""Compressing vectors to a few bytes: a codebook for each part, trained by active-entry rounds.

A vector is cut into equal parts; each part is replaced by the number of the nearest
entry of its position's codebook, and codebooks are improved by Lloyd's rounds over
all vectors.  Vectors are whole numbers (components times a scale, rounded down), so
distances, sums and ties are exact.

A round remembers for every part its entry and the exact distance to it.  Where that
entry did not move in the last round, the distance still holds and no entry that stayed
can have become better, so only moved entries are compared with it; parts whose entry
moved are compared with the whole codebook.  Lower numbers win ties either way.

A round is one pass that reads the remembered table, writes the next one and adds to
it one row per task with the sums of what each entry was given; those meet in one
aggregation whose size depends on the codebooks only.

Defined results: a vector that is null or holds a null or a component that is not
finite is dropped; a null id stays and stands last among the vectors that codebooks
start from; rows with equal ids are rows of their own, in the order of their vectors;
shorter vectors are filled up with zeros, to a length that the parts divide; fewer
vectors than entries make a smaller codebook; an error beyond a 64-bit number is null;
an empty table, or one without any component, gives an empty result; other columns do not matter.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import ArrayType, BinaryType, LongType, StructField, StructType

from wardline.llm.exchange import stored
from wardline.llm.vectors import finite, matrix
from wardline.session import shared_dir
from wardline.sources import files

#: Parts of a vector, entries of a codebook (a code is a byte), rounds, scale of the components.
PARTS, ENTRIES, ROUNDS, SCALE = 4, 256, 4, 1024

#: Vectors compared at once.
BLOCK = 4096

#: Sums travel in limbs of so many bits, so that they are exact however large.
LIMB = 40


class Numbers:
    """Whole numbers of a size that is known to be exact: doubles, 64 bits, or as long as it takes."""

    def __init__(self, largest: float, width: int):
        self.width = width
        most = 2 * width * (2 * self.whole(largest) + 2) ** 2
        self.kind = np.float64 if most < 1 << 53 else np.int64 if most < 1 << 62 else object

    @staticmethod
    def whole(x: float) -> int:
        """``x`` times the scale, rounded down; scaling by a power of two loses nothing."""
        return math.floor(x * SCALE) if abs(x) < 2.0**60 else int(x) * SCALE

    def of(self, values: np.ndarray) -> np.ndarray:
        if self.kind is object:
            return np.array([self.whole(x) for x in values.ravel()], dtype=object).reshape(values.shape)
        return np.floor(values * SCALE).astype(self.kind)


def nearest(x: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each row of ``x`` its nearest entry, the lowest of several, and the squared distance."""
    apart = (entries * entries).sum(axis=1)[None, :] - 2 * (x @ entries.T)
    best = np.argmin(apart, axis=1)
    return best, apart[np.arange(len(x)), best] + (x * x).sum(axis=1)


def assigned(x: np.ndarray, book: np.ndarray, moved: np.ndarray, code: np.ndarray | None, apart: np.ndarray | None) -> tuple:
    """Entries and distances of the parts ``x``, given those of the round before (none in the first).

    ``apart`` is -1 where the distance is not known; such a part is compared with everything.
    """
    if code is None:
        return nearest(x, book)
    code, apart = code.astype(np.int64), apart.copy()
    still = ~moved[code] & (apart >= 0)
    anew = np.flatnonzero(~still)
    if len(anew):
        code[anew], apart[anew] = nearest(x[anew], book)
    active, rows = np.flatnonzero(moved), np.flatnonzero(still)
    if len(active) and len(rows):
        best, distance = nearest(x[rows], book[active])
        best = active[best]
        better = (distance < apart[rows]) | ((distance == apart[rows]) & (best < code[rows]))
        code[rows[better]], apart[rows[better]] = best[better], distance[better]
    return code, apart


def _sums(x: np.ndarray, code: np.ndarray, entries: int) -> np.ndarray:
    """Per entry the sum of the parts it was given, and last their number."""
    out = np.zeros((entries, x.shape[1] + 1), dtype=object if x.dtype == object else np.int64)
    out[:, -1] = np.bincount(code, minlength=entries)
    for j in range(x.shape[1]):
        if x.dtype == np.float64:
            out[:, j] = np.bincount(code, weights=x[:, j], minlength=entries)
        else:
            np.add.at(out[:, j], code, x[:, j])
    return out


def _limbs(sums: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sums as limbs that are not zero: ``64 * place + limb``, and the limb's value; the last carries the sign."""
    none = np.zeros(0, dtype=np.int64)
    keys, values, rest, limb = [none], [none], sums.ravel(), 0
    while rest.any():
        if limb and np.all((rest == 0) | (rest == -1)):
            low, rest = rest, rest * 0
        else:
            low, rest = rest & ((1 << LIMB) - 1), rest >> LIMB
        used = np.flatnonzero(low)
        keys.append(used * 64 + limb)
        values.append(low[used].astype(np.int64))
        limb += 1
    return np.concatenate(keys), np.concatenate(values)


_SPENT = [StructField("keys", ArrayType(LongType())), StructField("sums", ArrayType(LongType()))]


def _round(state: DataFrame, kept: list[StructField], numbers: Numbers, books: np.ndarray, before: np.ndarray | None, add: bool) -> DataFrame:
    """The state after one pass: codes and distances under ``books``, and a row of sums per task."""
    parts, entries, width = books.shape
    moved = np.ones((parts, entries), dtype=bool) if before is None else (books != before).any(axis=2)
    names = [f.name for f in kept]

    def passed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((parts, entries, width + 1), dtype=object if numbers.kind is object else np.int64)
        for whole in batches:
            for start in range(0, whole.num_rows, BLOCK):
                batch = whole.slice(start, BLOCK)
                n = batch.num_rows
                values = matrix(pa.chunked_array([batch.column("embedding")]), numbers.width, np.float64)
                x = numbers.of(values).reshape(n, parts, width)
                codes = np.zeros((n, parts), dtype=np.uint8)
                apart = np.zeros((n, parts), dtype=x.dtype)
                if before is not None:
                    old = np.frombuffer(b"".join(batch.column("code").to_pylist()), dtype=np.uint8).reshape(n, parts)
                    known = batch.column("apart").flatten().to_numpy(zero_copy_only=False).reshape(n, parts).astype(x.dtype)
                for p in range(parts):
                    own = (None, None) if before is None else (old[:, p], known[:, p])
                    code, apart[:, p] = assigned(x[:, p], books[p], moved[p], *own)
                    codes[:, p] = code
                    if add:
                        total[p] += _sums(x[:, p], code, entries)
                limit = (1 << 63) - 1
                apart = np.where(apart > limit, -1, apart).astype(np.int64)
                edges = np.arange(n + 1, dtype=np.int32) * parts
                empty = pa.nulls(n, pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays(
                    [
                        *(batch.column(c) for c in names),
                        pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer(edges.tobytes()), pa.py_buffer(codes.tobytes())]),
                        pa.ListArray.from_arrays(pa.array(edges), pa.array(apart.ravel())),
                        empty, empty,
                    ],
                    names=[*names, "code", "apart", "keys", "sums"],
                )
        if add:
            keys, sums = _limbs(total)
            blank = [pa.nulls(1, f.type) for f in arrow if f.name not in ("keys", "sums")]
            yield pa.RecordBatch.from_arrays(
                [*blank, *(pa.array([x.tolist()], pa.list_(pa.int64())) for x in (keys, sums))],
                names=[*names, "code", "apart", "keys", "sums"],
            )

    schema = StructType([*kept, StructField("code", BinaryType()), StructField("apart", ArrayType(LongType())), *_SPENT])
    arrow = list(to_arrow_schema(schema))
    return state.mapInArrow(passed, schema)


def _improved(state: DataFrame, books: np.ndarray) -> np.ndarray:
    """Each entry the rounded-down mean of its parts; unused entries stay.

    To the driver come the sums of the codebooks' components, two or three numbers each.
    """
    parts, entries, width = books.shape
    found = (
        state.where(F.col("keys").isNotNull())
        .select(F.explode(F.arrays_zip("keys", "sums")).alias("x"))
        .groupBy(F.col("x.keys").alias("key"))
        .agg(F.sum("x.sums").alias("sum"))
    )
    total = np.zeros(parts * entries * (width + 1), dtype=object)
    for key, value in found.collect():
        total[key // 64] += int(value) << (LIMB * (key % 64))
    total = total.reshape(parts, entries, width + 1)
    out = books.astype(object)
    for p, e in zip(*np.nonzero(total[:, :, -1]), strict=True):
        out[p, e] = total[p, e, :-1] // total[p, e, -1]
    return out.astype(books.dtype)


def compressed(
    vectors: DataFrame, keep: tuple[str, ...] = (), parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS
) -> tuple[DataFrame, list]:
    """``vec_id, *keep, code, error`` of every usable vector, and the codebooks ``[part][entry][position]``.

    ``code`` is a byte per part; ``error`` the squared distance to what the code stands for.
    """
    if not 1 <= entries <= 256:
        raise ValueError("a code is one byte: 1 to 256 entries")
    spark = vectors.sparkSession
    rows = vectors.where(finite()).select("vec_id", F.col("embedding"), *keep)
    kept = [StructField(f.name, f.dataType) for f in rows.schema.fields]
    length, largest = rows.agg(
        F.max(F.size("embedding")), F.max(F.array_max(F.transform("embedding", lambda x: F.abs(x.cast("double")))))
    ).first()
    width = -(-(length or 0) // parts)
    numbers = Numbers(largest or 0.0, width * parts)
    first = rows.select("vec_id", "embedding").orderBy(F.asc_nulls_last("vec_id"), "embedding").limit(entries).collect()
    start = np.zeros((len(first), width * parts))
    for i, r in enumerate(first):
        start[i, : len(r.embedding)] = r.embedding
    books = np.ascontiguousarray(numbers.of(start).reshape(len(first), parts, width).transpose(1, 0, 2))
    if not len(first) or not width:
        schema = StructType([*kept, StructField("code", BinaryType()), StructField("error", LongType())])
        return spark.createDataFrame([], schema).drop("embedding"), books.tolist()
    state, before, folder = rows, None, None
    for turn in range(rounds + 1):
        passed, used, folder = _round(state, kept, numbers, books, before, turn < rounds), folder, shared_dir(spark, "codes")
        passed.write.parquet(folder)
        written = spark.read.schema(passed.schema).parquet(folder)
        if turn < rounds:
            before, books = books, _improved(written, books)
        state = written.where(F.col("keys").isNull()).drop("keys", "sums")
        if used:
            files.delete(spark, used)  # nothing reads the round before any more
    far = F.expr("exists(apart, x -> x < 0)")
    total = F.aggregate("apart", F.lit(0).cast("decimal(38,0)"), lambda a, x: (a + x).cast("decimal(38,0)"))
    error = F.when(~far, total.try_cast("long"))
    return state.select("vec_id", *keep, "code", error.alias("error")), [[[int(x) for x in e] for e in b] for b in books]


def books_digest(books: list) -> str:
    return hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()


def with_label_error(coded: DataFrame, label: str = "label") -> DataFrame:
    """``coded`` with the errors of each label summed; a null where one of them is null.

    Errors are summed before they meet the rows, so a frequent label is a row like any other.
    """
    total = F.sum(F.col("error").cast("decimal(38,0)")).try_cast("long")
    sums = coded.groupBy(F.col(label).alias("of")).agg(F.when(F.count("error") == F.count("*"), total).alias("label_error"))
    sums = stored(sums, "label-errors")
    return coded.join(sums, F.col(label).eqNullSafe(F.col("of"))).drop("of")


def oracle(parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> str:
    """The query in SQL, its rounds written one after the other; every part is compared with every entry each time."""
    steps = []
    for r in range(rounds + 1):
        steps.append(f"""given{r} AS MATERIALIZED (
  SELECT row, part, min((xx + cc - 2 * list_dot_product(x, c))::BIGINT * {entries} + entry) AS best
  FROM parts JOIN book{r} USING (part) GROUP BY row, part
)""")
        if r < rounds:
            steps.append(f"""sums{r} AS (
  SELECT part, best % {entries} AS entry, pos, sum(v::BIGINT) AS s, count(*) AS n
  FROM (SELECT part, best, unnest(x) AS v, unnest(range(len(x))) AS pos FROM given{r} JOIN parts USING (row, part)) GROUP BY ALL
), book{r + 1} AS MATERIALIZED (
  SELECT b.part, b.entry, coalesce(m.c, b.c) AS c, list_dot_product(coalesce(m.c, b.c), coalesce(m.c, b.c)) AS cc
  FROM book{r} b LEFT JOIN (
    SELECT part, entry, list(((s - ((s % n) + n) % n) / n)::DOUBLE ORDER BY pos) AS c FROM sums{r} GROUP BY part, entry
  ) m ON b.part = m.part AND b.entry = m.entry
)""")
    return f"""
WITH kept AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY vec_id) - 1 AS row, vec_id, label,
         list_transform(embedding, lambda x: floor({scale} * x::DOUBLE)) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), parts AS MATERIALIZED (
  SELECT row, part, x, list_dot_product(x, x) AS xx FROM (
    SELECT row, p AS part, v[p * (len(v) // {parts}) + 1 : (p + 1) * (len(v) // {parts})] AS x FROM kept, range({parts}) AS r(p))
), book0 AS MATERIALIZED (
  SELECT part, row AS entry, x AS c, xx AS cc FROM parts WHERE row < {entries}
), {", ".join(steps)}, coded AS (
  SELECT row, string_agg(lower(right('0' || to_hex(best % {entries}), 2)), '' ORDER BY part) AS code,
         sum(best // {entries})::BIGINT AS error
  FROM given{rounds} GROUP BY row
), digest AS (
  SELECT sha256(string_agg(array_to_string(list_transform(c, lambda x: x::BIGINT), ','), ',' ORDER BY part, entry)) AS codebooks_sha256
  FROM book{rounds}
)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, codebooks_sha256
FROM coded JOIN kept USING (row), digest
"""


def op12_vector_codes(spark, sf_dir: str) -> DataFrame:
    """Codes of four bytes for every usable vector of ``embeddings``, after four rounds."""
    coded, books = compressed(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), keep=("label",))
    return with_label_error(coded).select(
        "vec_id", F.lower(F.hex("code")).alias("code"), "error", "label_error", F.lit(books_digest(books)).alias("codebooks_sha256")
    )
