"""Moving many small keys through few rows, and tables that cut lineage.

A slice of documents yields hundreds of thousands of hashes.  As rows of their
own they would cost more in row headers than in content, so a slice sends each
bucket of hashes as one row of packed arrays.  Spark shuffles and groups those
rows; a bucket is a range of hash values and holds a bounded share of the keys.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardline.llm.text import mix
from wardline.session import shared_dir

#: Bytes of packed keys that one bucket should hold.
BUCKET_BYTES = 12 << 20

_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def _releasing_shuffles(spark: SparkSession):
    """Shuffle files of a finished write are of no further use; free their disk."""
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_CLEANUP)
        else:
            spark.conf.set(_CLEANUP, before)


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared folder and read it back: lineage ends here."""
    spark, folder = df.sparkSession, shared_dir(df.sparkSession, name)
    with _releasing_shuffles(spark):
        df.write.parquet(folder)
    return spark.read.schema(df.schema).parquet(folder)


def text_size(docs: DataFrame, column: str = "text") -> int:
    return docs.agg(F.sum(F.octet_length(column))).first()[0] or 0


def bucket_bits(spark: SparkSession, key_bytes: float) -> int:
    """Bits of a hash that name its bucket: buckets of bounded size, at least one per shuffle partition."""
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
    wanted = max(partitions, key_bytes / BUCKET_BYTES, 2)
    return int(np.ceil(np.log2(wanted)))


def packed(bucket: np.ndarray, columns: dict[str, np.ndarray], fixed: dict[str, int] | None = None) -> Iterator[pa.RecordBatch]:
    """One row per bucket: its number and the bytes of each column's values there."""
    if not len(bucket):
        return
    kind = np.uint16 if int(bucket.max()) < 1 << 16 else np.int64
    order = np.argsort(bucket.astype(kind), kind="stable")
    bucket = bucket[order]
    starts = np.flatnonzero(np.diff(bucket, prepend=bucket[0] - 1 if kind is np.int64 else -1))
    ends = np.append(starts[1:], len(bucket))
    arrays: dict[str, pa.Array] = {"bucket": pa.array(bucket[starts].astype(np.int32))}
    for name, values in columns.items():
        raw, width = values[order].tobytes(), values.itemsize
        edges = np.append(starts, len(bucket)).astype(np.int64) * width
        arrays[name] = pa.Array.from_buffers(
            pa.binary(), len(starts), [None, pa.py_buffer(edges.astype(np.int32).tobytes()), pa.py_buffer(raw)]
        )
    for name, value in (fixed or {}).items():
        arrays[name] = pa.array(np.full(len(ends), value, dtype=np.int64))
    yield pa.RecordBatch.from_arrays(list(arrays.values()), names=list(arrays))


def unpacked(column: pa.ChunkedArray, kind) -> np.ndarray:
    """The values of a packed column, all rows one after the other."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return np.frombuffer(b"".join(column.to_pylist()), dtype=kind)


def per_bucket(df: DataFrame, function: Callable[[pa.Table], pa.Table], schema: str) -> DataFrame:
    return df.groupBy("bucket").applyInArrow(function, schema)


def table_of(schema: pa.Schema, **columns) -> pa.Table:
    return pa.table([pa.array(columns[f.name], type=f.type) for f in schema], schema=schema)


def narrow(keys: np.ndarray, width: int) -> np.ndarray:
    """The low ``width`` bytes of 64-bit keys."""
    raw = np.ascontiguousarray(keys.view(np.uint8).reshape(-1, 8)[:, :width])
    return raw.view(f"V{width}").ravel()


def widen(raw: np.ndarray, width: int) -> np.ndarray:
    out = np.zeros((len(raw) // width, 8), dtype=np.uint8)
    out[:, :width] = raw.reshape(-1, width)
    return out.view(np.uint64).ravel()


#: What a slice tells a bucket: keys it merely has, keys whose owners (row, place) want to
#: know whether they occur elsewhere, and owners of keys that the slice itself has twice.
OFFER = "bucket int, plain binary, keys binary, rows binary, ats binary, known_rows binary, known_ats binary"
_OFFER = pa.schema([("bucket", pa.int32()), *((c, pa.binary()) for c in "plain keys rows ats known_rows known_ats".split())])


def _completed(batch: pa.RecordBatch) -> pa.RecordBatch:
    missing = pa.nulls(batch.num_rows, pa.binary())
    return pa.RecordBatch.from_arrays(
        [batch.column(n) if n in batch.schema.names else missing for n in _OFFER.names], schema=_OFFER
    )


def offer(keys: np.ndarray, rows: np.ndarray, ats: np.ndarray, asked: np.ndarray, bits: int, width: int = 8) -> Iterator[pa.RecordBatch]:
    """Send each distinct key of a slice to its bucket once, however often the slice has it."""
    distinct, place, counts = np.unique(keys, return_inverse=True, return_counts=True)
    twice = counts[place] > 1
    asking, known = asked & ~twice, asked & twice
    answered = np.ones(len(distinct), dtype=bool)
    answered[place[asking]] = False
    plain, top = distinct[answered], np.uint64(64 - bits)
    parts = [
        packed(plain >> top, {"plain": narrow(plain, width)}),
        packed(keys[asking] >> top, {"keys": narrow(keys[asking], width), "rows": rows[asking], "ats": ats[asking]}),
        packed(
            mix(rows[known].view(np.uint64)) >> top, {"known_rows": rows[known], "known_ats": ats[known]}
        ),
    ]
    for part in parts:
        yield from map(_completed, part)


def answer(table: pa.Table, width: int = 8) -> tuple[np.ndarray, np.ndarray]:
    """In a bucket: owners (rows, places) of the keys that occur more than once in all."""
    have = lambda name, kind: unpacked(table[name].drop_null(), kind)
    plain, keys = (widen(have(c, np.uint8), width) for c in ("plain", "keys"))
    everything = np.sort(np.concatenate([plain, keys]))
    repeated = everything[1:][everything[1:] == everything[:-1]]
    found = np.isin(keys, repeated)
    rows = np.concatenate([have("rows", np.int64)[found], have("known_rows", np.int64)])
    ats = np.concatenate([have("ats", np.int32)[found], have("known_ats", np.int32)])
    return rows, ats


#: Two hashes as one key: what meets under both is taken to be equal.
PAIR = np.dtype([("one", "<u8"), ("two", "<u8")])


def several(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whether each pair of hashes occurs several times, and whether it is the one that stands for its kind."""
    order = np.lexsort((keys["two"], keys["one"]))
    same = keys[order][1:] == keys[order][:-1]
    again, stands = np.zeros(len(keys), dtype=bool), np.ones(len(keys), dtype=bool)
    again[order[1:][same]] = again[order[:-1][same]] = True
    stands[order[1:][same]] = False
    return again, stands


def offer_pairs(keys: np.ndarray, rows: np.ndarray, ats: np.ndarray, asked: np.ndarray, bits: int) -> Iterator[pa.RecordBatch]:
    """``offer`` for pairs of hashes."""
    again, stands = several(keys)
    asking, known, top = asked & ~again, asked & again, np.uint64(64 - bits)
    plain, held = keys[stands & ~asking], keys[asking]
    parts = [
        packed(plain["one"] >> top, {"plain": plain}),
        packed(held["one"] >> top, {"keys": held, "rows": rows[asking], "ats": ats[asking]}),
        packed(mix(rows[known].view(np.uint64)) >> top, {"known_rows": rows[known], "known_ats": ats[known]}),
    ]
    for part in parts:
        yield from map(_completed, part)


def answer_pairs(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """``answer`` for pairs of hashes."""
    have = lambda name, kind: unpacked(table[name].drop_null(), kind)
    keys = have("keys", PAIR)
    found = several(np.concatenate([keys, have("plain", PAIR)]))[0][: len(keys)]
    rows = np.concatenate([have("rows", np.int64)[found], have("known_rows", np.int64)])
    ats = np.concatenate([have("ats", np.int32)[found], have("known_ats", np.int32)])
    return rows, ats


def regrouped(rows: np.ndarray, ats: np.ndarray, bits: int) -> pa.Table:
    """(row, place) pairs, packed by buckets of rows."""
    order = np.lexsort((ats, rows))
    rows, ats = rows[order], ats[order]
    parts = list(packed(mix(rows.view(np.uint64)) >> np.uint64(64 - bits), {"rows": rows, "ats": ats}))
    return pa.Table.from_batches(parts, schema=REGROUPED)


REGROUPED = pa.schema([("bucket", pa.int32()), ("rows", pa.binary()), ("ats", pa.binary())])


def runs_of(table: pa.Table, reach: int) -> pa.Table:
    """In a bucket of rows: the maximal stretches covered by ``reach`` places from each given one.

    One line per row with the stretches' starts and ends.
    """
    rows, ats = unpacked(table["rows"], np.int64), unpacked(table["ats"], np.int32)
    order = np.lexsort((ats, rows))
    rows, ats = rows[order], ats[order]
    fresh = np.ones(len(rows), dtype=bool)
    fresh[1:] = (rows[1:] != rows[:-1]) | (ats[1:] > ats[:-1] + reach)
    first = np.flatnonzero(fresh)
    last = np.append(first[1:], len(rows)) - 1 if len(rows) else first
    return spans_table(rows[first], ats[first], ats[last] + np.int32(reach))


SPANS = "row long, starts array<int>, ends array<int>"


def spans_table(rows: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.Table:
    """Stretches sorted by row, as one line per row."""
    head = np.flatnonzero(np.diff(rows, prepend=rows[0] - 1)) if len(rows) else np.zeros(0, dtype=np.int64)
    edges = pa.array(np.append(head, len(rows)), type=pa.int32())
    lists = [pa.ListArray.from_arrays(edges, pa.array(x.astype(np.int32), type=pa.int32())) for x in (starts, ends)]
    return pa.table({"row": pa.array(rows[head], type=pa.int64()), "starts": lists[0], "ends": lists[1]})


def keyed(docs: DataFrame) -> DataFrame:
    """``docs`` with ``row``, a 64-bit identity of id and text, and a marker of texts that occur more than once.

    Rows equal in both are the same text with the same answer, so they may share an identity.
    """
    return docs.withColumn("row", F.xxhash64("doc_id", "text"))


def copies_of(docs: DataFrame) -> DataFrame:
    """``row, speaks`` of all texts that occur more than once; one row of each group speaks for it.

    The groups are written before rows are joined with them, so that Spark deals both
    sides anew for the join and can split the rows of a very large group.
    """
    marks = docs.select("row", F.md5(F.coalesce(F.col("text"), F.lit("")).cast("binary")).alias("mark"))
    groups = stored(
        marks.groupBy("mark").agg(F.count("*").alias("n"), F.min("row").alias("first")).where("n > 1"), "copy-groups"
    )
    told = marks.join(groups, "mark").select("row", (F.col("row") == F.col("first")).alias("speaks"))
    return stored(told.groupBy("row").agg(F.max("speaks").alias("speaks")), "copies")
