"""Exact top-k inner products by a three-phase uniform threshold.

A score is a sum over parts of the dimensions.  Each shard of vectors keeps one
list per part, and no list knows the others.

1. Every list names its best entries for each query.  They are gathered, the
   best of all lists get their scores from the other lists, and the k-th best
   total is a score that the result cannot stay below.
2. If a total reaches that score, at least one of its parts reaches an even share.
   This cutoff is sent back with the queries, and lists return what reaches it.
3. Entries that cannot reach the k-th score, even if each missing part falls just
   short of the cutoff, are dropped; the others get their missing parts.

The totals are whole numbers and exact.  Queries travel in blocks to all shards;
what a list returns depends on the cutoff only, never on a fixed number.

Defined results: vectors that are null or hold a null or non-finite component,
and rows without an id, take no part; rows with the same id are rows of their own,
each other's candidates too; shorter vectors are filled up with zeros; components and scores
beyond the range of a long stop at its ends; a query with fewer candidates than
k gets them all; an empty table gives an empty result; other columns do not matter.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardline.llm.vectors import QUERIES, SHARD, best_of, dealt, matrix, stored, to_every_shard, usable

#: Parts of the dimensions; best entries that a list names in the first phase, per wanted result.
PARTS, NAMED = 2, 3

#: Shards whose named entries are merged in one step.
FAN_IN = 32

#: Packed rows, of up to a few MB each, that Spark hands a Python worker at once.
ROWS_AT_ONCE = 16

_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"

_LOWEST, _HIGHEST = -(1 << 63), (1 << 63) - 1


@contextmanager
def _few_at_once(spark: SparkSession):
    """A batch of rows is held by Spark and by the worker as a whole; 10,000 packed ones are too many."""
    before = spark.conf.get(_BATCH, None)
    spark.conf.set(_BATCH, str(min(ROWS_AT_ONCE, int(before)) if before and int(before) > 0 else ROWS_AT_ONCE))
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_BATCH)
        else:
            spark.conf.set(_BATCH, before)


def _stored(visits: DataFrame, name: str) -> DataFrame:
    """``stored`` for what is made of packed rows."""
    with _few_at_once(visits.sparkSession):
        return stored(visits, name)


def quantised(vectors: DataFrame, scale: int) -> DataFrame:
    return vectors.withColumn("embedding", F.transform("embedding", lambda x: F.floor(x * scale)))


def _scores(queries: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Inner products of whole numbers: in floating point where that is exact, else in Python integers."""
    reach = np.abs(queries.astype(float)).max(initial=0) * np.abs(vectors.astype(float)).max(initial=0) * queries.shape[1]
    if reach < 2**53:
        return (queries.astype(np.float64) @ vectors.astype(np.float64).T).astype(np.int64)
    exact = queries.astype(object) @ vectors.astype(object).T
    return np.clip(exact, _LOWEST, _HIGHEST).astype(np.int64)


def packed_lists(vectors: DataFrame, width: int, parts: int) -> DataFrame:
    """``shard, part, ids, names, vectors``: one row for each list, or block of queries.

    ``ids`` are the rows' keys, ``names`` their vec_ids, which places ascend with.
    """

    def pack(table: pa.Table) -> pa.Table:
        table = table.sort_by("key")
        whole = matrix(table["embedding"], width, np.int64)
        ids, names = (table[c].to_numpy().astype(np.int64).tobytes() for c in ("key", "vec_id"))
        pieces = np.array_split(whole, parts, axis=1)
        return pa.table(
            {
                "shard": pa.array([table["shard"][0].as_py()] * parts, pa.int32()),
                "part": pa.array(range(parts), pa.int32()),
                "ids": pa.array([ids] * parts, pa.binary()),
                "names": pa.array([names] * parts, pa.binary()),
                "vectors": pa.array([np.ascontiguousarray(p).tobytes() for p in pieces], pa.binary()),
            }
        )

    return vectors.groupBy("shard").applyInArrow(pack, "shard int, part int, ids binary, names binary, vectors binary")


def _ints(value: bytes, kind=np.int64) -> np.ndarray:
    return np.frombuffer(value, dtype=kind)


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for i in range(batch.num_rows):
            yield {name: batch.column(name)[i].as_py() for name in batch.schema.names}


def _batch(schema: list[tuple[str, pa.DataType]], **values) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([values[n].tobytes() if isinstance(values[n], np.ndarray) else values[n]], t) for n, t in schema],
        names=[n for n, _ in schema],
    )


#: Entries of lists: for a block of queries, which query, which vector of the shard, and a score.
ENTRIES = "block int, shard int, part int, query binary, place binary, score binary"
_ENTRIES = [("block", pa.int32()), ("shard", pa.int32()), ("part", pa.int32()), *((c, pa.binary()) for c in ("query", "place", "score"))]


class _List:
    """One list and one block of queries that visits it."""

    def __init__(self, row: dict):
        self.own, self.asked = _ints(row["ids"]), _ints(row["query_ids"])
        self.vectors = _ints(row["vectors"]).reshape(len(self.own), -1)
        self.queries = _ints(row["query_vectors"]).reshape(len(self.asked), -1)

    def scores(self) -> tuple[np.ndarray, np.ndarray]:
        """All scores, and which pairs are a query with itself."""
        return _scores(self.queries, self.vectors), self.asked[:, None] == self.own[None, :]

    def at(self, query: np.ndarray, place: np.ndarray) -> np.ndarray:
        """Scores of single pairs."""
        out = np.empty(len(query), dtype=np.int64)
        for q in np.unique(query):
            here = query == q
            out[here] = _scores(self.queries[q : q + 1], self.vectors[place[here]])[0]
        return out


def _name_best(count: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            scores, itself = _List(row).scores()
            others = np.where(itself, _LOWEST, scores)
            n = min(count, others.shape[1])
            best = np.argpartition(-others, n - 1, axis=1)[:, :n] if n else np.zeros((len(others), 0), dtype=np.int64)
            query = np.repeat(np.arange(len(others)), n)
            place = best.ravel()
            kept = ~itself[query, place]
            query, place = query[kept], place[kept]
            yield _batch(
                _ENTRIES, block=row["block"], shard=row["shard"], part=row["part"],
                query=query.astype(np.int32), place=place.astype(np.int32), score=scores[query, place],
            )

    return run


def _highest(query: np.ndarray, score: np.ndarray, count: int) -> np.ndarray:
    """Indices of each query's ``count`` highest scores."""
    order = np.lexsort((-score, query))
    first = np.searchsorted(query[order], query[order])
    return order[np.arange(len(order)) - first < count]


def _merged(count: int):
    """The best named entries of several shards, for each part and query."""

    def run(table: pa.Table) -> pa.Table:
        out = []
        rows = table.to_pylist()
        for part in sorted({r["part"] for r in rows}):
            own = [r for r in rows if r["part"] == part]
            query, place = (np.concatenate([_ints(r[c], np.int32) for r in own]) for c in ("query", "place"))
            score = np.concatenate([_ints(r["score"]) for r in own])
            shard = np.repeat([r["shard"] for r in own], [len(r["query"]) // 4 for r in own])
            best = _highest(query, score, count)
            for s in np.unique(shard[best]):
                here = best[shard[best] == s]
                out.append(
                    _batch(_ENTRIES, block=own[0]["block"], shard=int(s), part=part, query=query[here], place=place[here], score=score[here])
                )
        return pa.Table.from_batches(out)

    return run


def _visited(lists: DataFrame, queries: DataFrame) -> DataFrame:
    """Each list joined with the blocks of queries sent to its shard.

    Both sides are dealt out.  Spark takes blocks that go to every shard for as large as
    the files they were read from, and would send all their copies through the driver.
    """
    asked = queries.select(
        "block", "shard", "part", F.col("ids").alias("query_ids"), F.col("vectors").alias("query_vectors"),
        *(c for c in queries.columns if c not in ("block", "shard", "part", "ids", "names", "vectors")),
    )
    return asked.hint("merge").join(lists.drop("names"), ["shard", "part"])


def _resolve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Scores that single entries have in a list."""
    for row in _rows(batches):
        query, place = _ints(row["query"], np.int32), _ints(row["place"], np.int32)
        score = _List(row).at(query, place)
        yield _batch(_ENTRIES, block=row["block"], shard=row["shard"], part=row["part"], query=query, place=place, score=score)


def _summed(rows: list[dict]) -> tuple[np.ndarray, ...]:
    """Entries of one block and shard, put together: query, place, total of the known parts, their number, and which."""
    query, place = (np.concatenate([_ints(r[c], np.int32) for r in rows]) for c in ("query", "place"))
    score = np.concatenate([_ints(r["score"]) for r in rows])
    part = np.repeat([r["part"] for r in rows], [len(r["query"]) // 4 for r in rows])
    pair, index = np.unique(query.astype(np.int64) << 32 | place, return_inverse=True)
    known = np.zeros((len(pair), max(1, part.max(initial=0) + 1)), dtype=bool)
    known[index, part] = True
    total = np.zeros(len(pair), dtype=object if np.abs(score.astype(float)).max(initial=0) > 2**61 else np.int64)
    np.add.at(total, index, score)
    total = np.clip(total, _LOWEST, _HIGHEST).astype(np.int64)
    return (pair >> 32).astype(np.int32), (pair & 0xFFFFFFFF).astype(np.int32), total, known


def _sum_named(table: pa.Table) -> pa.Table:
    """Whole scores of a shard's named entries."""
    rows = table.to_pylist()
    query, _, total, _ = _summed(rows)
    return pa.table(
        {
            "block": pa.array([rows[0]["block"]], pa.int32()),
            "query": pa.array([query.tobytes()], pa.binary()),
            "score": pa.array([total.tobytes()], pa.binary()),
        }
    )


def _kth(k: int):
    """The k-th best whole score of each query of a block; the lowest if there are fewer."""

    def run(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        query = np.concatenate([_ints(r["query"], np.int32) for r in rows])
        score = np.concatenate([_ints(r["score"]) for r in rows])
        best = _highest(query, score, k)
        cut = np.full(int(query.max(initial=-1)) + 1, _LOWEST)
        full = np.bincount(query[best], minlength=len(cut)) >= k
        lowest = np.full(len(cut), _HIGHEST)
        np.minimum.at(lowest, query[best], score[best])
        cut[full] = lowest[full]
        return pa.table({"block": pa.array([rows[0]["block"]], pa.int32()), "kth": pa.array([cut.tobytes()], pa.binary())})

    return run


def _cutoffs(row: dict, parts: int) -> tuple[np.ndarray, np.ndarray]:
    """The k-th score of each query and the even share that one part must reach."""
    count = len(row["query_ids"]) // 8
    kth = np.full(count, _LOWEST)
    told = _ints(row["kth"]) if row["kth"] is not None else kth[:0]
    kth[: len(told)] = told
    return kth, np.where(kth == _LOWEST, _LOWEST, -(-kth // parts))


def _collect(parts: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            scores, itself = _List(row).scores()
            _, share = _cutoffs(row, parts)
            query, place = np.nonzero((scores >= share[:, None]) & ~itself)
            yield _batch(
                _ENTRIES, block=row["block"], shard=row["shard"], part=row["part"],
                query=query.astype(np.int32), place=place.astype(np.int32), score=scores[query, place],
            )

    return run


#: Entries that may still be in the result: what is known of each, and the parts to ask.
_OPEN = "block int, shard int, part int, query binary, place binary, score binary, wanted boolean"


def _narrowed(parts: int):
    def run(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        query, place, total, known = _summed(rows)
        known = np.pad(known, ((0, 0), (0, parts - known.shape[1])))
        kth, share = _cutoffs(rows[0], parts)
        missing = parts - known.sum(axis=1)
        # Whole numbers throughout: Python's where 64 bits would not hold them.
        kind = object if max(np.abs(x.astype(float)).max(initial=0) for x in (total, share)) > 2**61 / (parts + 1) else np.int64
        short = np.maximum(share[query], _LOWEST + 1) - 1
        possible = total.astype(kind) + missing.astype(kind) * short.astype(kind)
        kept = (possible >= kth[query].astype(kind)).astype(bool)  # of whole entries the total itself
        query, place, total, known = query[kept], place[kept], total[kept], known[kept]
        out = [
            _batch(
                [*_ENTRIES, ("wanted", pa.bool_())], block=rows[0]["block"], shard=rows[0]["shard"], part=parts,
                query=query, place=place, score=total, wanted=False,
            )
        ]
        for part in range(parts):
            ask = ~known[:, part]
            if ask.any():
                out.append(
                    _batch(
                        [*_ENTRIES, ("wanted", pa.bool_())], block=rows[0]["block"], shard=rows[0]["shard"], part=part,
                        query=query[ask], place=place[ask], score=total[:0], wanted=True,
                    )
                )
        return pa.Table.from_batches(out)

    return run


def _finished(k: int):
    """A shard's entries of the result: whole scores that reach the k-th one, at most ``k`` of each query."""

    def run(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        query, place, total, _ = _summed(rows)
        kth, _ = _cutoffs(rows[0], 1)
        reach = total >= kth[query]
        query, place, total = query[reach], place[reach], total[reach]
        best = _highest(query, np.where(total == _LOWEST, _LOWEST + 1, total), k)  # places ascend with ids
        columns = {n: _ints(rows[0][c])[query[best]] for n, c in (("query", "query_ids"), ("query_id", "query_names"))}
        columns |= {n: _ints(rows[0][c])[place[best]] for n, c in (("key", "ids"), ("vec_id", "names"))}
        return pa.table({**columns, "score": total[best]})

    return run


def exact_top_k(vectors: DataFrame, queries: str, k: int, scale: int = 64, parts: int = PARTS) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` highest scores of the vectors chosen by the condition ``queries``."""
    taking = stored(quantised(usable(vectors), scale), "vectors")
    rows, asked, width = taking.agg(F.count("*"), F.count_if(F.expr(queries)), F.max(F.size("embedding"))).first()
    width, parts = max(width or 0, parts), parts
    shards = max(1, -(-rows // SHARD))
    lists = stored(packed_lists(dealt(taking, SHARD, rows, 1), width, parts), "lists")
    blocks = stored(
        packed_lists(dealt(taking.where(queries), QUERIES, asked, 2), width, parts).withColumnRenamed("shard", "block"), "blocks"
    )
    # First phase: named entries, the best of all shards, their whole scores, the k-th of these.
    named = _visited(lists, to_every_shard(blocks, shards)).mapInArrow(_name_best(NAMED * k), ENTRIES)
    group = shards
    while group > 1:
        group = -(-group // FAN_IN)
        step = shards // group + 1
        named = named.groupBy("block", F.floor(F.col("shard") / step)).applyInArrow(_merged(NAMED * k), ENTRIES)
    pairs = _stored(named, "named").select("block", "shard", F.col("query"), F.col("place"))
    every = F.explode(F.sequence(F.lit(0), F.lit(parts - 1)))
    asks = pairs.withColumn("part", every).hint("merge").join(blocks, ["block", "part"])
    whole = _visited(lists, asks).mapInArrow(_resolve, ENTRIES).dropDuplicates()
    kth = (
        whole.groupBy("block", "shard")
        .applyInArrow(_deduplicated_sum, "block int, query binary, score binary")
        .groupBy("block")
        .applyInArrow(_kth(k), "block int, kth binary")
    )
    kth = _stored(kth, "cutoffs")
    # Second phase: everything that reaches the cutoff.
    told = stored(blocks.join(kth, "block", "left"), "told")
    collected = _visited(lists, to_every_shard(told, shards)).mapInArrow(_collect(parts), ENTRIES)
    heads = told.where("part = 0").select("block", F.col("ids").alias("query_ids"), F.col("names").alias("query_names"), "kth")
    opened = _stored(
        collected.join(heads, "block").groupBy("block", "shard").applyInArrow(_narrowed(parts), _OPEN), "open"
    )
    # Third phase: missing parts, whole scores, the best.
    asks = opened.where("wanted").drop("wanted", "score").hint("merge").join(blocks, ["block", "part"])
    resolved = _stored(_visited(lists, asks).mapInArrow(_resolve, ENTRIES), "resolved")
    owners = lists.where("part = 0").select("shard", "ids", "names")
    final = (
        opened.where("NOT wanted").drop("wanted")
        .unionByName(resolved)
        .join(heads, "block")
        .join(owners, "shard")
        .groupBy("block", "shard")
        .applyInArrow(_finished(k), "query long, query_id long, key long, vec_id long, score long")
    )
    return best_of(final, k)


def _deduplicated_sum(table: pa.Table) -> pa.Table:
    """Whole scores of named entries; an entry that several lists named counts once."""
    rows = table.to_pylist()
    parts: dict[int, dict] = {}
    for part in sorted({r["part"] for r in rows}):
        own = [r for r in rows if r["part"] == part]
        query, place = (np.concatenate([_ints(r[c], np.int32) for r in own]) for c in ("query", "place"))
        score = np.concatenate([_ints(r["score"]) for r in own])
        _, first = np.unique(query.astype(np.int64) << 32 | place, return_index=True)
        parts[part] = {
            "block": own[0]["block"], "part": part,
            "query": query[first].tobytes(), "place": place[first].tobytes(), "score": score[first].tobytes(),
        }
    return _sum_named(pa.Table.from_pylist(list(parts.values())))


ORACLE = """
WITH v AS (
  SELECT row_number() OVER () AS key, vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND vec_id IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.key, q.vec_id AS query_id, v.vec_id, list_dot_product(q.e, v.e)::BIGINT AS score
  FROM v q JOIN v ON q.key <> v.key WHERE q.vec_id % 20 = 0
)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY key ORDER BY score DESC, vec_id) AS rank FROM scored
) WHERE rank <= 20
"""


def op2_exact_topk(spark, sf_dir: str) -> DataFrame:
    """The 20 highest integer inner products of every twentieth vector with all others."""
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return exact_top_k(vectors, "vec_id % 20 = 0", 20, 64)
