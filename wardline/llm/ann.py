"""Approximate nearest neighbours: a navigable small-world graph of several levels per shard.

Vectors are dealt to shards of bounded size.  In each, every vector is on level 0
and a shrinking, hash-chosen part of them on each level above.  On every level a
vector links to near ones that lie in different directions; links go both ways
and are stored as flat arrays of neighbours with offsets.  A search enters at the
top, walks greedily down to level 0 and there follows a beam of the best vectors
seen.  All queries of a block walk together.  The shards' results are merged, and
scores are computed anew from the original vectors.

For largest inner products the graph is built over vectors with one more
component, which gives all of them the same length; there nearness by angle, by
distance and by inner product agree.

Equal vectors are one node of the graph, and each result lists as many of their
ids as can matter, smallest first; so a very common vector neither clutters the
graph nor makes ties arbitrary.

Defined results: vectors that are null, zero, or hold a null or non-finite
component, and rows without an id, take no part; rows with the same id are rows
of their own, each other's candidates too; shorter vectors are filled up with zeros; a query with at
most k candidates in reach gets them all; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wardline.llm.text import mix
from wardline.llm.vectors import QUERIES, SHARD, best_of, dealt, matrix, stored, to_every_shard, usable

#: Links that a node seeks on a level, and at most keeps on level 0; near nodes considered for them.
LINKS, MOST_LINKS, CONSIDERED = 16, 32, 64

#: Width of the beam on level 0 and nodes that a step opens at once.
BEAM, OPENED = 128, 4

#: Shards whose results are merged in one step.
FAN_IN = 32


def _levels(ids: np.ndarray) -> np.ndarray:
    """The highest level of each node, falling off geometrically; from the id, so that rebuilding agrees."""
    even = (mix(ids.view(np.uint64)) >> np.uint64(11)).astype(np.float64) / (1 << 53)
    return np.floor(-np.log(np.maximum(even, 1e-300)) / np.log(LINKS)).astype(np.int64)


def _diverse(points: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """For each point up to ``count`` near ones, none closer to another chosen one than to the point; -1 fills up."""
    n = len(points)
    near = min(CONSIDERED, n - 1)
    chosen = np.full((n, count), -1, dtype=np.int32)
    if near < 1:
        return chosen, np.zeros((n, count))
    squares = (points * points).sum(axis=1)
    kept_distance = np.full((n, count), np.inf)
    for a in range(0, n, 256):
        block = points[a : a + 256]
        distance = squares[None, :] + squares[a : a + 256, None] - 2 * block @ points.T
        distance[np.arange(len(block)), np.arange(a, a + len(block))] = np.inf
        candidates = np.argpartition(distance, near - 1, axis=1)[:, :near]
        own = np.take_along_axis(distance, candidates, axis=1)
        order = np.argsort(own, axis=1, kind="stable")
        candidates, own = np.take_along_axis(candidates, order, axis=1), np.take_along_axis(own, order, axis=1)
        others = points[candidates]
        between = squares[candidates][:, :, None] + squares[candidates][:, None, :] - 2 * others @ others.transpose(0, 2, 1)
        taken = np.zeros(candidates.shape, dtype=bool)
        for j in range(near):
            covered = ((between[:, j, :] < own[:, j, None]) & taken).any(axis=1)
            taken[:, j] = ~covered & (taken.sum(axis=1) < count)
        # Chosen ones first, then the nearest of the rest.
        rank = np.argsort(~taken, axis=1, kind="stable")[:, :count]
        width = rank.shape[1]
        chosen[a : a + 256, :width] = np.take_along_axis(candidates, rank, axis=1)
        kept_distance[a : a + 256, :width] = np.take_along_axis(own, rank, axis=1)
    return chosen, kept_distance


def _linked(points: np.ndarray, members: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Offsets and flat neighbours of one level: links both ways, own choices first, then the nearest."""
    chosen, distance = _diverse(points[members], LINKS)
    source, slot = np.nonzero(chosen >= 0)
    target, far = chosen[source, slot], distance[source, slot]
    a = np.concatenate([source, target])
    b = np.concatenate([target, source])
    order = np.lexsort((np.concatenate([far, far]), np.repeat([0, 1], len(source)), a))
    a, b = a[order], b[order]
    _, first = np.unique(a.astype(np.int64) * len(members) + b, return_index=True)
    keep = np.sort(first)
    a, b = a[keep], b[keep]
    place = np.arange(len(a)) - np.searchsorted(a, a)
    a, b = a[place < most], b[place < most]
    return np.searchsorted(a, np.arange(len(members) + 1)).astype(np.int32), members[b].astype(np.int32)


class Graph:
    """One shard: ids, vectors, and per level its members, offsets and flat neighbours."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, levels: list[tuple[np.ndarray, np.ndarray, np.ndarray]]):
        self.ids, self.vectors, self.levels = ids, vectors, levels

    @classmethod
    def build(cls, ids: np.ndarray, vectors: np.ndarray) -> Graph:
        lengths = (vectors * vectors).sum(axis=1)
        points = np.column_stack([vectors, np.sqrt(np.maximum(lengths.max(initial=0) - lengths, 0))]).astype(np.float32)
        highest, levels = _levels(ids), []
        for level in range(int(highest.max(initial=0)) + 1):
            members = np.flatnonzero(highest >= level)
            levels.append((members.astype(np.int32), *_linked(points, members, MOST_LINKS if level == 0 else LINKS)))
        return cls(ids, vectors, levels)

    def _neighbours(self, level: int) -> np.ndarray:
        """Flat neighbours as a table of equal rows, -1 where there are fewer; a node without a place has none."""
        members, offsets, flat = self.levels[level]
        counts = np.diff(offsets)
        table = np.full((len(self.ids), max(1, counts.max(initial=0))), -1, dtype=np.int32)
        rows = np.repeat(members, counts)
        table[rows, np.arange(len(flat)) - np.repeat(offsets[:-1], counts)] = flat
        return table

    def search(self, queries: np.ndarray, k: int, beam: int = BEAM) -> tuple[np.ndarray, np.ndarray]:
        """Per query the places and scores of the ``k`` best nodes met, -1 where there are fewer."""
        n, count = len(self.ids), len(queries)
        vectors, queries = self.vectors.astype(np.float32), queries.astype(np.float32)
        at = np.full(count, self.levels[-1][0][0])
        score = (queries * vectors[at]).sum(axis=1)
        for level in range(len(self.levels) - 1, 0, -1):
            table, moving = self._neighbours(level), np.arange(count)
            while len(moving):
                next_ = table[at[moving]]
                scores = np.where(next_ >= 0, np.einsum("qd,qmd->qm", queries[moving], vectors[next_]), -np.inf)
                best = scores.argmax(axis=1)
                better = scores[np.arange(len(moving)), best] > score[moving]
                moving, best = moving[better], best[better]
                at[moving] = next_[better, best]
                score[moving] = scores[better, best]
        table, beam = self._neighbours(0), min(max(beam, k), n)
        held = np.full((count, beam), -1, dtype=np.int64)
        held_score = np.full((count, beam), -np.inf, dtype=np.float32)
        opened = np.zeros((count, beam), dtype=bool)
        held[:, 0], held_score[:, 0] = at, score
        seen = np.zeros((count, n), dtype=bool)
        seen[np.arange(count), at] = True
        active = np.arange(count)
        while len(active):
            waiting = np.where(opened[active] | (held[active] < 0), -np.inf, held_score[active])
            width = min(OPENED, beam)
            pick = np.argpartition(-waiting, width - 1, axis=1)[:, :width]
            open_ = np.take_along_axis(waiting, pick, axis=1) > -np.inf
            going = open_.any(axis=1)
            active, pick, open_ = active[going], pick[going], open_[going]
            if not len(active):
                break
            rows = np.arange(len(active))[:, None]
            opened[active[:, None], pick] |= open_
            nodes = np.where(open_, held[active[:, None], pick], -1)
            fresh = np.where(nodes[:, :, None] >= 0, table[nodes], -1).reshape(len(active), -1)
            # Each node once: what has been seen, or stands twice in this step, goes.
            fresh = np.sort(fresh, axis=1)
            fresh[:, 1:][fresh[:, 1:] == fresh[:, :-1]] = -1
            fresh[(fresh >= 0) & seen[active[:, None], np.maximum(fresh, 0)]] = -1
            scores = np.full(fresh.shape, -np.inf, dtype=np.float32)
            q, m = np.nonzero(fresh >= 0)
            seen[active[q], fresh[q, m]] = True
            scores[q, m] = np.einsum("nd,nd->n", queries[active[q]], vectors[fresh[q, m]])
            every = np.concatenate([held_score[active], scores], axis=1)
            best = np.argpartition(-every, beam - 1, axis=1)[:, :beam]
            held[active] = np.concatenate([held[active], fresh], axis=1)[rows, best]
            opened[active] = np.concatenate([opened[active], np.zeros(fresh.shape, dtype=bool)], axis=1)[rows, best]
            held_score[active] = every[rows, best]
        order = np.argsort(-held_score, axis=1, kind="stable")[:, :k]
        return np.take_along_axis(held, order, axis=1), np.take_along_axis(held_score, order, axis=1)


INDEX = "shard int, ids binary, vectors binary, levels array<struct<members: binary, offsets: binary, neighbours: binary>>"


def build_index(vectors: DataFrame, width: int) -> DataFrame:
    """A row per shard: its vectors and the graph as flat arrays."""

    def build(table: pa.Table) -> pa.Table:
        table = table.sort_by("key")
        graph = Graph.build(table["key"].to_numpy().astype(np.int64), matrix(table["embedding"], width))
        levels = [dict(zip(("members", "offsets", "neighbours"), (x.tobytes() for x in level), strict=True)) for level in graph.levels]
        kind = pa.list_(pa.struct([(n, pa.binary()) for n in ("members", "offsets", "neighbours")]))
        return pa.table(
            {
                "shard": pa.array([table["shard"][0].as_py()], pa.int32()),
                "ids": pa.array([graph.ids.tobytes()], pa.binary()),
                "vectors": pa.array([graph.vectors.tobytes()], pa.binary()),
                "levels": pa.array([levels], kind),
            }
        )

    return vectors.groupBy("shard").applyInArrow(build, INDEX)


def _graph(row: dict) -> Graph:
    ids = np.frombuffer(row["ids"], dtype=np.int64)
    levels = [tuple(np.frombuffer(level[n], dtype=np.int32) for n in ("members", "offsets", "neighbours")) for level in row["levels"]]
    return Graph(ids, np.frombuffer(row["vectors"]).reshape(len(ids), -1), levels)


FOUND = "block int, shard int, query_id binary, node binary, score binary"


def _packed(block: int, shard: int, query: np.ndarray, node: np.ndarray, score: np.ndarray) -> dict:
    arrays = {"query_id": query, "node": node, "score": score}
    return {
        "block": pa.array([block], pa.int32()),
        "shard": pa.array([shard], pa.int32()),
        **{n: pa.array([x.tobytes()], pa.binary()) for n, x in arrays.items()},
    }


def _walk(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                graph, asked = _graph(row), np.frombuffer(row["query_ids"], dtype=np.int64)
                queries = np.frombuffer(row["query_vectors"]).reshape(len(asked), -1)
                # One more than wanted: a query may find itself.
                place, _ = graph.search(queries, min(k + 1, len(graph.ids)))
                query, slot = np.nonzero(place >= 0)
                place = place[query, slot]
                score = (queries[query] * graph.vectors[place]).sum(axis=1)
                yield pa.RecordBatch.from_pydict(_packed(row["block"], row["shard"], asked[query], graph.ids[place], score))

    return run


def _merged(k: int):
    """The best nodes of each query over several shards."""

    def run(table: pa.Table) -> pa.Table:
        query, node = (np.frombuffer(b"".join(table[c].to_pylist()), dtype=np.int64) for c in ("query_id", "node"))
        score = np.frombuffer(b"".join(table["score"].to_pylist()))
        order = np.lexsort((node, -score, query))
        query, node, score = query[order], node[order], score[order]
        best = np.arange(len(query)) - np.searchsorted(query, query) <= k
        return pa.table(_packed(table["block"][0].as_py(), table["shard"][0].as_py(), query[best], node[best], score[best]))

    return run


def _unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            columns = [np.frombuffer(row[c], dtype=t) for c, t in (("query_id", np.int64), ("node", np.int64), ("score", np.float64))]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["query", "node", "score"])


def nearest(vectors: DataFrame, queries: str, k: int) -> DataFrame:
    """``query_id, rank, vec_id, score``: about the ``k`` largest inner products of the vectors chosen by ``queries``."""
    taking = stored(usable(vectors).where(F.exists("embedding", lambda x: x != 0)), "vectors")
    asked, width = taking.agg(F.count_if(F.expr(queries)), F.max(F.size("embedding"))).first()
    order = Window.partitionBy("embedding").orderBy("key")
    # No more than k + 1 ids of equal vectors can appear in one result.
    equals = taking.withColumn("n", F.row_number().over(order)).where(F.col("n") <= k + 1)
    members = stored(equals, "members")
    nodes = members.where("n = 1").select("key", "embedding")
    rows = nodes.count()
    shards = max(1, -(-rows // SHARD))
    index = stored(build_index(dealt(nodes, SHARD, rows, 1), width or 1), "index")

    def block(table: pa.Table) -> pa.Table:
        table = table.sort_by("key")
        return pa.table(
            {
                "block": pa.array([table["shard"][0].as_py()], pa.int32()),
                "query_ids": pa.array([table["key"].to_numpy().astype(np.int64).tobytes()], pa.binary()),
                "query_vectors": pa.array([matrix(table["embedding"], width).tobytes()], pa.binary()),
            }
        )

    blocks = (
        dealt(taking.where(queries), QUERIES, asked, 2)
        .groupBy("shard")
        .applyInArrow(block, "block int, query_ids binary, query_vectors binary")
    )
    found = to_every_shard(stored(blocks, "queries"), shards).join(index, "shard").mapInArrow(_walk(k), FOUND)
    group = shards
    while group > 1:
        group = -(-group // FAN_IN)
        found = found.groupBy("block", F.floor(F.col("shard") / (shards // group + 1))).applyInArrow(_merged(k), FOUND)
    names = members.select("embedding", "key", "vec_id").join(
        nodes.select("embedding", F.col("key").alias("node")), "embedding"
    )
    asking = taking.where(queries).select(F.col("key").alias("query"), F.col("vec_id").alias("query_id"))
    return best_of(
        found.mapInArrow(_unpack, "query long, node long, score double")
        .join(names.select("node", "key", "vec_id"), "node")
        .where("key <> query")
        .join(asking, "query")
        .select("query", "query_id", "key", "vec_id", "score"),
        k,
    )


def op10_nearest(spark, sf_dir: str) -> DataFrame:
    """The 20 nearest vectors found for every twentieth vector, by inner product."""
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return nearest(vectors, "vec_id % 20 = 0", 20)
