"""Similarity join of word shingle sets by prefix trees.

Sets are put into one global order of shingles: those of a single set first,
then by the number of sets that have them.  Two sets can only be similar enough
if they share a shingle among the first few of each (the prefix), so shingles
that only one set has take no part beyond being counted, and sets whose prefix
is made of them are done.  The remaining sets are brought together by connected
prefixes; each such family is stored as a trie over the same order, most
frequent shingles at the root.  One descent serves all sets at once: the overlap
with a path is worked out once and shared by every set below it, and a subtree is
left as soon as the shingles that remain could not lift any overlap high enough.

Equal sets are collapsed first.  A family too large for one task is dealt into
blocks, every block also gets the family's pivots.  Where this leaves a family in
several parts, its sets meet again by single shingles of their prefixes, those that
several parts have, and only with sets whose size allows a link; a trie for each such
meeting looks for what joins the parts.  Links within what is already one component
add nothing and are not looked for, so a large group of near copies costs little
more than its size, and a long chain of families as much as its prefixes.

Shingles are compared by 64-bit hashes (of at least 256 buckets, fewer drop a bit
each), and sets are named by 64-bit hashes of their content.

Defined results: null texts and texts without words have the empty set, which is
linked with nothing; fewer words than a shingle make one shingle of the whole
sequence; equal sets are linked; rows with equal ids count as one document's
readings, each with its own set; a null id takes part but is never the smallest;
an empty table gives an empty result; other columns do not matter.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardline.llm.components import components
from wardline.llm.exchange import bucket_bits, narrow, packed, per_bucket, stored, text_size, unpacked, widen
from wardline.llm.text import Words, mix, slices

#: Words in a shingle, and the least similarity of a link in percent.
SHINGLE, PERCENT = 5, 80

#: Bytes of text per shingle, for sizing buckets only.
SHINGLE_BYTES = 6

#: A shingle that makes up more than this share of all shingles is heavy: it comes last in
#: the order and is not counted by documents.  There are at most ``1 / HEAVY`` of them.
HEAVY = 1 / (1 << 17)

#: Sets compared in one task; pivots that each block of a larger family gets.
BLOCK, PIVOTS = 256, 16


def _sets(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Owner and hash of every distinct shingle, sorted by both."""
    hashes = words.hashes()
    starts, shingles = words.runs(hashes, SHINGLE)
    owner = words.doc[starts]
    short = np.flatnonzero((words.counts > 0) & (words.counts < SHINGLE))
    whole = np.zeros(len(short), dtype=np.uint64)
    for i in range(SHINGLE - 1):
        more = words.counts[short] > i
        whole[more] = mix(whole[more] * np.uint64(3) + hashes[words.bounds[short[more]] + i])
    owner, shingles = np.concatenate([owner, short]), np.concatenate([shingles, whole])
    order = np.lexsort((shingles, owner))
    owner, shingles = owner[order], shingles[order]
    fresh = np.ones(len(owner), dtype=bool)
    fresh[1:] = (owner[1:] != owner[:-1]) | (shingles[1:] != shingles[:-1])
    return owner[fresh], shingles[fresh]


def _named_sets(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Owner and shingle arrays, then size and name of each document's set."""
    words = Words(column, fold=True)
    owner, shingles = _sets(words)
    sizes = np.bincount(owner, minlength=len(words.counts))
    totals = np.concatenate([[np.uint64(0)], np.cumsum(mix(shingles ^ np.uint64(0x5851F42D4C957F2D)))])
    bounds = np.concatenate([[0], np.cumsum(sizes)])
    names = mix((totals[bounds[1:]] - totals[bounds[:-1]]) ^ sizes.astype(np.uint64)).view(np.int64)
    return owner, shingles, sizes, names


def shingle_sets(docs: DataFrame) -> DataFrame:
    """``doc_id, node, n_shingles``: the name and size of every document's set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            _, _, sizes, names = _named_sets(batch.column("text"))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(names), pa.array(sizes, pa.int64())], names=["doc_id", "node", "n_shingles"]
            )

    schema = docs.select("doc_id").schema.add("node", "long").add("n_shingles", "long")
    return docs.select("doc_id", "text").mapInArrow(run, schema)


def heavy_shingles(docs: DataFrame, total: int) -> np.ndarray:
    """Shingles that stand out, most frequent last; a number bounded by ``HEAVY``.

    Every slice reports the shingles it has more often than their share allows; what
    slices do not report is below the share, so that nothing needs to be exact here:
    any order will do as long as all sets use the same one.
    """

    def report(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            owner, shingles, _, names = _named_sets(batch.column("text"))
            found, counts = np.unique(shingles[_distinct(names)[owner]], return_counts=True)
            much = counts > max(2, HEAVY * len(shingles))
            yield pa.RecordBatch.from_arrays(
                [pa.array(found[much].view(np.int64)), pa.array(counts[much])], names=["shingle", "n"]
            )

    counts = docs.select("text").mapInArrow(report, "shingle long, n long").groupBy("shingle").agg(F.sum("n").alias("n"))
    rows = counts.where(F.col("n") > max(2.0, HEAVY * total)).orderBy("n", "shingle").select("shingle").collect()
    return np.array([r[0] for r in rows], dtype=np.int64).view(np.uint64)


def prefix_length(sizes: np.ndarray) -> np.ndarray:
    return sizes - (PERCENT * sizes + 99) // 100 + 1


#: Bytes of a shingle's hash that travel beside its bucket, and the place of the first heavy one.
TOKEN_BYTES, LAST = 7, 1 << 30

#: What a slice of documents sends: to buckets of hashes its light shingles, to its own bucket
#: its heavy ones and its sets.  A set is meant by its number in the slice.
DEALT = "bucket int, slice long, light binary, owner binary, tokens binary, places binary, names binary, sizes binary"
_DEALT = pa.schema(
    [("bucket", pa.int32()), ("slice", pa.int64())]
    + [(c, pa.binary()) for c in "light owner tokens places names sizes".split()]
)

#: What comes back to a slice: shared shingles with owner and place, beside its sets.
SHARED = "bucket int, slice long, slices binary, owner binary, tokens binary, places binary, names binary, sizes binary"
_SHARED = pa.schema(
    [("bucket", pa.int32()), ("slice", pa.int64())]
    + [(c, pa.binary()) for c in "slices owner tokens places names sizes".split()]
)


def _completed(part: pa.RecordBatch, schema: pa.Schema, slice_: int | None = None) -> pa.RecordBatch:
    n = part.num_rows
    own = {"slice": pa.array([slice_] * n, pa.int64())}
    return pa.RecordBatch.from_arrays(
        [own.get(f.name, part.column(f.name) if f.name in part.schema.names else pa.nulls(n, f.type)) for f in schema],
        schema=schema,
    )


def _distinct(names: np.ndarray) -> np.ndarray:
    """Marks one of the documents with the same set."""
    first = np.zeros(len(names), dtype=bool)
    first[np.unique(names, return_index=True)[1]] = True
    return first


def _shortened(tokens: np.ndarray, bits: int) -> np.ndarray:
    """A hash reduced to its bucket and the bytes that travel."""
    rest, shift = np.uint64((1 << 8 * TOKEN_BYTES) - 1), np.uint64(64 - bits)
    return (tokens & rest) | (tokens >> shift << shift)


def _of(table: pa.Table, name: str, kind) -> np.ndarray:
    return unpacked(table[name].drop_null(), kind)


def _bucket_of_slice(slices_: np.ndarray, bits: int) -> np.ndarray:
    return mix(slices_.view(np.uint64)) >> np.uint64(64 - bits)


def shared_shingles(docs: DataFrame, heavy: np.ndarray, bits: int) -> DataFrame:
    """Packed by slice: the shingles that more than one document has, with their place in the global order.

    Documents must come from a table, whose partitions read the same every time.
    """
    shared = docs.sparkSession.sparkContext.broadcast(heavy)
    top = np.uint64(64 - bits)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _shortened(shared.value, bits)
        places = np.argsort(known)
        known = known[places]
        for number, batch in enumerate(slices(batches)):
            slice_ = TaskContext.get().partitionId() << 32 | number
            owner, tokens, sizes, names = _named_sets(batch.column("text"))
            keep = _distinct(names)[owner]
            owner, tokens = owner[keep], _shortened(tokens[keep], bits)
            at = np.searchsorted(known, tokens)
            last = known[np.minimum(at, len(known) - 1)] == tokens if len(known) else np.zeros(len(tokens), dtype=bool)
            owner, light = owner.astype(np.uint16), ~last
            for part in packed(
                tokens[light] >> top, {"light": narrow(tokens[light], TOKEN_BYTES), "owner": owner[light]}
            ):
                yield _completed(part, _DEALT, slice_)
            own = int(_bucket_of_slice(np.array([slice_]), bits)[0])
            place = (LAST + places[at[last]]).astype(np.int32) if len(known) else np.zeros(0, dtype=np.int32)
            values = {
                "owner": owner[last], "tokens": tokens[last], "places": place,
                "names": names, "sizes": sizes.astype(np.int32),
            }
            yield _completed(
                pa.RecordBatch.from_pydict(
                    {"bucket": pa.array([own], pa.int32()), **{c: pa.array([v.tobytes()], pa.binary()) for c, v in values.items()}}
                ),
                _DEALT,
                slice_,
            )

    def count(table: pa.Table) -> pa.Table:
        light = table.filter(pc.is_valid(table["light"]))
        lengths = pc.binary_length(light["light"]).to_numpy().astype(np.int64) // TOKEN_BYTES
        tokens = widen(_of(light, "light", np.uint8), TOKEN_BYTES) | np.uint64(table["bucket"][0].as_py()) << top
        owner = _of(light, "owner", np.uint16)
        slices_ = np.repeat(light["slice"].to_numpy(), lengths)
        order = np.argsort(tokens, kind="stable")
        first = np.flatnonzero(np.diff(tokens[order], prepend=tokens[order[:1]] + np.uint64(1)))
        having = np.diff(np.append(first, len(tokens)))
        places = np.empty(len(tokens), dtype=np.int32)
        places[order] = np.minimum(np.repeat(having, having), LAST - 1)
        kept = places > 1
        tokens, owner, slices_, places = tokens[kept], owner[kept], slices_[kept], places[kept]
        parts = packed(
            _bucket_of_slice(slices_, bits), {"slices": slices_, "owner": owner, "tokens": tokens, "places": places}
        )
        sets = table.filter(pc.is_valid(table["names"]))
        forwarded = [_completed(part, _SHARED) for part in parts]
        for part in sets.to_batches():
            held = pc.binary_length(part.column("owner")).to_pylist()
            repeated = [np.full(n // 2, s, dtype=np.int64).tobytes() for n, s in zip(held, part.column("slice").to_pylist(), strict=True)]
            columns = {c: part.column(c) for c in ("bucket", "slice", "owner", "tokens", "places", "names", "sizes")}
            columns["slices"] = pa.array(repeated, pa.binary())
            forwarded.append(pa.RecordBatch.from_arrays([columns[n] for n in _SHARED.names], schema=_SHARED))
        return pa.Table.from_batches(forwarded, schema=_SHARED)

    return per_bucket(docs.select("text").mapInArrow(deal, DEALT), count, SHARED)


def candidates(shared: DataFrame) -> DataFrame:
    """``node, size, lead, tokens``: sets whose prefix reaches shingles that other documents have.

    ``tokens`` are all of these in the global order; the first ``lead`` lie in the prefix.
    A set that documents of several slices have is listed for each of them.
    """

    def choose(table: pa.Table) -> pa.Table:
        sets = table.filter(pc.is_valid(table["names"])).sort_by("slice")
        numbers = sets["slice"].to_numpy()
        counts = pc.binary_length(sets["names"]).to_numpy().astype(np.int64) // 8
        base = np.concatenate([[0], np.cumsum(counts)])
        names, sizes = _of(sets, "names", np.int64), _of(sets, "sizes", np.int32).astype(np.int64)
        slices_, owner = _of(table, "slices", np.int64), _of(table, "owner", np.uint16)
        tokens, places = _of(table, "tokens", np.uint64), _of(table, "places", np.int32)
        document = base[np.searchsorted(numbers, slices_)] + owner
        order = np.lexsort((tokens, places, document))
        tokens, lengths = tokens[order], np.bincount(document, minlength=len(names))
        lead = prefix_length(sizes) - (sizes - lengths)
        kept = (lead > 0) & (sizes > 0)
        edges = np.concatenate([[0], np.cumsum(lengths[kept])]).astype(np.int32)
        return pa.table(
            {
                "node": names[kept],
                "size": sizes[kept],
                "lead": np.minimum(lead[kept], lengths[kept]),
                "tokens": pa.ListArray.from_arrays(
                    pa.array(edges), pa.array(tokens[np.repeat(kept, lengths)].view(np.int64))
                ),
            }
        )

    return per_bucket(shared, choose, "node long, size long, lead long, tokens array<long>")


def families(found: DataFrame) -> DataFrame:
    """``node, family``: sets connected by shingles in both prefixes."""
    prefixes = found.select("node", F.explode(F.slice("tokens", F.lit(1), F.col("lead").cast("int"))).alias("token"))
    met = prefixes.groupBy("token").agg(F.min("node").alias("b"), F.max("node").alias("other")).where("b <> other")
    links = prefixes.join(met.select("token", "b"), "token").select(F.col("node").alias("a"), "b").where("a <> b")
    return components(links).withColumnRenamed("root", "family")


class Trie:
    """Sets of shingles in one order, sorted so that a node is a range of sets with a common head."""

    def __init__(self, sets: list[np.ndarray], sizes: np.ndarray):
        owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
        vocabulary, token = np.unique(np.concatenate(sets), return_inverse=True)
        counts = np.bincount(token, minlength=len(vocabulary))
        rank = np.empty(len(vocabulary), dtype=np.int64)
        rank[np.argsort(-counts, kind="stable")] = np.arange(len(vocabulary))
        several = counts[token] > 1  # the rest cannot overlap
        owner, ranks = owner[several], rank[token[several]]
        order = np.lexsort((ranks, owner))
        pieces = np.split(ranks[order], np.cumsum(np.bincount(owner, minlength=len(sets)))[:-1])
        self.places = sorted(range(len(sets)), key=lambda i: pieces[i].astype(">u4").tobytes())
        self.sets = [pieces[i] for i in self.places]
        self.sizes = sizes[self.places]
        self.lengths = np.array([len(s) for s in self.sets])
        # Which sets have a shingle, as one array with offsets.
        flat = np.concatenate(self.sets) if self.sets else np.zeros(0, dtype=np.int64)
        holder = np.repeat(np.arange(len(sets)), self.lengths)
        by_rank = np.argsort(flat, kind="stable")
        self.holders = holder[by_rank]
        self.edges = np.searchsorted(flat[by_rank], np.arange(len(vocabulary) + 1))
        self.common = np.array([0, *(self._common(a, b) for a, b in zip(self.sets, self.sets[1:], strict=False))])

    @staticmethod
    def _common(a: np.ndarray, b: np.ndarray) -> int:
        n = min(len(a), len(b))
        different = np.flatnonzero(a[:n] != b[:n])
        return int(different[0]) if len(different) else n

    def _meeting(self, path: np.ndarray) -> np.ndarray:
        """For every set, how many shingles of a stretch of a path it has."""
        lengths = self.edges[path + 1] - self.edges[path]
        after = np.cumsum(lengths)
        at = np.arange(after[-1] if len(after) else 0) + np.repeat(self.edges[path] - (after - lengths), lengths)
        return np.bincount(self.holders[at], minlength=len(self.sets))

    def links(self, part: np.ndarray, percent: int = PERCENT) -> list[tuple[int, int]]:
        """Pairs of similar sets that join what is not yet in one part; ``part`` is brought up to date."""
        part, found, numbers = part[self.places], [], np.arange(len(self.sets))
        stack = [(0, len(self.sets), 0, np.zeros(len(self.sets), dtype=np.int64))]
        while stack:
            low, high, depth, overlap = stack.pop()
            inner = self.common[low + 1 : high]
            reach = int(inner.min()) if len(inner) else len(self.sets[low])
            if reach > depth:
                overlap = overlap + self._meeting(self.sets[low][depth:reach])
            rest = int(self.lengths[low:high].max()) - reach
            most = overlap + np.minimum(rest, self.lengths - overlap)
            open_ = (numbers > low) & (
                (100 + percent) * most >= percent * (self.sizes + int(self.sizes[low:high].min()))
            )
            if (part[low:high] == part[low]).all():
                open_ &= part != part[low]
            if not open_.any():
                continue
            if len(inner):
                cuts = [low, *(low + 1 + np.flatnonzero(inner == reach)), high]
                stack.extend((a, b, reach, overlap) for a, b in zip(cuts[-2::-1], cuts[:0:-1], strict=True))
                continue
            for other in np.flatnonzero(
                open_ & ((100 + percent) * overlap >= percent * (self.sizes + self.sizes[low]))
            ):
                if part[other] != part[low]:
                    found.append((self.places[low], self.places[other]))
                    part[part == part[other]] = part[low]
        return found


def _compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links of each (family, block) in rows sorted by it."""

    def solve(rows: list[tuple]) -> pa.RecordBatch:
        nodes = [r[2] for r in rows]
        sets = [r[5] for r in rows]
        parts = np.unique(np.array([r[4] for r in rows], dtype=np.int64), return_inverse=True)[1]
        found = Trie(sets, np.array([r[3] for r in rows])).links(parts) if len(rows) > 1 else []
        a, b = ([nodes[pair[k]] for pair in found] for k in (0, 1))
        return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    held: list[tuple] = []
    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in ("family", "block", "node", "size", "part")]
        lists = batch.column("tokens")
        edges, flat = lists.offsets.to_numpy(), lists.values.to_numpy()
        for i, row in enumerate(zip(*columns, strict=True)):
            if held and held[0][:2] != row[:2]:
                yield solve(held)
                held = []
            held.append((*row, flat[edges[i] : edges[i + 1]].copy()))
    if held:
        yield solve(held)


def _links(dealt: DataFrame) -> DataFrame:
    """Compare what was dealt to each (family, block)."""
    return (
        dealt.select("family", "block", "node", "size", "part", "tokens")
        .repartition("family", "block")
        .sortWithinPartitions("family", "block")
        .mapInArrow(_compared, "a long, b long")
    )


def linked_components(found: DataFrame, block: int = BLOCK, pivots: int = PIVOTS) -> DataFrame:
    """``node, root``: connected components of the similar sets among ``found``."""
    family = stored(families(found), "families")
    sizes = stored(family.groupBy("family").agg(F.count("*").alias("n")), "family-sizes")
    members = stored(
        found.join(family.join(sizes, "family"), "node")
        .dropDuplicates(["node"])
        .withColumn("blocks", F.ceil(F.col("n") / block))
        .withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks"))),
        "members",
    )
    # First within blocks, each with the pivots of its family.
    is_pivot = F.pmod(F.xxhash64("node", F.lit(1)), F.greatest(F.lit(1), F.floor(F.col("n") / pivots))) == 0
    lent = (
        members.where((F.col("blocks") > 1) & is_pivot)
        .withColumn("to", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
        .where("to <> block")
        .withColumn("block", F.col("to"))
        .drop("to")
    )
    roots = components(_links(members.unionByName(lent).withColumn("part", F.col("node"))))
    # Then by single shingles, in families that are still in several parts.
    large = members.where("blocks > 1").join(roots, "node", "left").withColumn("part", F.coalesce("root", "node"))
    split = large.groupBy("family").agg(F.min("part").alias("a"), F.max("part").alias("b")).where("a <> b")
    open_ = stored(large.join(split.select("family"), "family").drop("root", "block", "blocks", "n"), "open")
    if open_.isEmpty():
        return roots
    more = stored(_links(meetings(open_, block)), "links")
    known = roots.select(F.col("node").alias("a"), F.col("root").alias("b"))
    return components(known.unionByName(more))


#: Sizes of two similar sets lie in one class or in neighbouring ones.
SIZE_RATIO = 100 / PERCENT


def meetings(sets: DataFrame, block: int = BLOCK) -> DataFrame:
    """``sets`` (``node, size, part, lead, tokens``) once for each meeting, named ``family, block``.

    Sets of different parts meet under a shingle of both prefixes, with those of their own
    class of sizes and the next; a meeting without several parts does not take place.  A
    meeting too large for one task is held between its blocks.
    """
    size_class = F.floor(F.log(F.col("size").cast("double")) / F.log(F.lit(SIZE_RATIO))).cast("long")
    asked = sets.select(
        "node", "part", size_class.alias("class"),
        F.explode(F.slice("tokens", F.lit(1), F.col("lead").cast("int"))).alias("token"),
    )
    # First which shingles several parts have, then which of their meetings.  Sets of the
    # class below come to a meeting, but do not hold one among themselves again.
    def apart(rows: DataFrame, *key: str) -> DataFrame:
        found = rows.groupBy(*key).agg(
            F.min("part").alias("a"), F.max("part").alias("b"), F.count("*").alias("n"), F.max("own").alias("held")
        )
        return stored(found.where("a <> b AND held"), "apart")

    asked = asked.join(apart(asked.withColumn("own", F.lit(True)), "token").select("token"), "token")
    places = [F.struct((F.col("class") + up).alias("class"), F.lit(up == 0).alias("own")) for up in (0, 1)]
    asked = asked.select("node", "part", "token", F.explode(F.array(*places)).alias("place")).select("node", "part", "token", "place.*")
    met = apart(asked, "token", "class").select("token", "class", F.ceil(F.col("n") / block).alias("blocks"))
    asked = asked.drop("own")
    placed = asked.join(met, ["token", "class"]).withColumn("own", F.pmod(F.xxhash64("node", "token"), F.col("blocks")))
    every = F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)
    placed = placed.withColumn("other", F.explode(every))
    return placed.select(
        "node",
        F.xxhash64("token", "class").alias("family"),
        (F.least("own", "other") * F.col("blocks") + F.greatest("own", "other")).alias("block"),
    ).join(sets.select("node", "size", "part", "tokens"), "node")


def similar_sets(docs: DataFrame) -> DataFrame:
    """``doc_id, n_shingles, component_id`` of every document."""
    named = stored(shingle_sets(docs), "sets")
    size = text_size(docs)
    bits = bucket_bits(docs.sparkSession, size / SHINGLE_BYTES * (TOKEN_BYTES + 2))
    total = named.agg(F.sum("n_shingles")).first()[0] or 0
    shared = shared_shingles(docs, heavy_shingles(docs, total), bits)
    roots = linked_components(stored(candidates(shared), "candidates"))
    firsts = named.where("n_shingles > 0").groupBy("node").agg(F.min("doc_id").alias("first"))
    placed = firsts.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    lowest = placed.groupBy("root").agg(F.min("first").alias("component_id"))
    by_node = placed.join(lowest, "root").select("node", "component_id")
    return named.join(by_node, "node", "left").select(
        "doc_id",
        "n_shingles",
        F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"),
    )


def keep_one(docs: DataFrame) -> DataFrame:
    """One row of ``docs`` per component, that of the smallest id (null last); rows equal in id and text count as one.

    Where such rows differ in other columns, the same one of them stays in every run.
    Rows with the empty set are kept, one of each id and text.
    """
    identity = F.struct(F.isnull("doc_id").alias("unnamed"), "doc_id", F.xxhash64("text").alias("text_hash"))
    chosen = (
        similar_sets(docs.select(identity.alias("doc_id"), "text"))
        .where("doc_id <=> component_id")
        .select("doc_id.doc_id", "doc_id.text_hash")
        .distinct()
        .alias("c")
    )
    return (
        docs.select(
            "doc_id", F.xxhash64("text").alias("text_hash"), F.struct("*").alias("doc"), F.xxhash64(F.struct("*")).alias("turn")
        )
        .alias("d")
        .join(
            chosen.hint("shuffle_hash"),
            F.expr("d.doc_id <=> c.doc_id AND d.text_hash = c.text_hash"),
            "left_semi",
        )
        .groupBy("doc_id", "text_hash")
        .agg(F.min_by("doc", "turn").alias("doc"))
        .select("doc.*")
    )


def op3_ngram_jaccard(spark, sf_dir: str) -> DataFrame:
    """Components of documents whose 5-word shingle sets are similar by 0.8 or more."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return similar_sets(docs).select("doc_id", "n_shingles", "component_id")
