"""Removal of repeated byte strings by sorting suffixes with hash comparisons.

Of each text only some suffixes are sorted: those at the positions that a string
of ``length`` bytes picks by itself, namely where the hash of a short gram is
smallest within it.  Equal strings pick the same position, so all occurrences of
a string meet among the suffixes that begin with the same gram.  These are
merge-sorted; two suffixes are compared by binary search for their common
extension with prefix polynomial hashes, so a comparison takes a logarithmic
number of steps.  Neighbours in the order then tell how far any suffixes agree to
the right, hashes of what stands before them tell it to the left, and bytes are
compared before anything is removed on the strength of hashes.

Strings of a picked position that begin close to each other have a core in common,
the bytes that all of them hold.  Where a core occurs nowhere else none of them can be
repeated, so cores are looked up first, and only strings of repeated cores go on.  Their
surroundings are sent to be sorted, equal surroundings of one slice of documents once.
Where very many different surroundings would meet, as at the ends of a passage that many
documents go on from in their own way, strings meet one by one instead, by two hashes.
Texts that occur several times are removed whole and take part through one of them.

Defined results: a null text has no bytes; texts shorter than ``length`` lose
nothing; rows that repeat, even with equal ids, are each other's repeats; an
empty table gives an empty result; other columns pass through.
"""

from __future__ import annotations

import os.path
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardline.llm.exchange import (
    BUCKET_BYTES,
    OFFER,
    PAIR,
    SPANS,
    answer,
    bucket_bits,
    copies_of,
    keyed,
    offer,
    packed,
    per_bucket,
    regrouped,
    runs_of,
    several,
    spans_table,
    stored,
    text_size,
    unpacked,
)
from wardline.llm.text import BYTE_VALUES, SECOND_VALUES, PrefixHash, mix, slices, text_bytes

#: Bytes of a repeated string, and of the grams that pick positions.
LENGTH, GRAM = 400, 32

#: Bytes of a core's hash that travel; if two meet by accident, a little more is looked at.
PROBE_BYTES = 6

#: Starts of strings that share a core.
GROUP = 32

#: Bytes of text worked on at once, bytes of text per bucket of suffixes, bytes compared at once.
SLICE, BUCKET, COMPARED = 1 << 20, 4 << 20, 1 << 20

#: A string that begins this few bytes before its position or fewer reaches far to the right
#: of it, and is met under the hash of all that.  So positions that lie close together, as
#: in a repeated word, do not all meet under one gram.
REACHES = (16, 64, 160)

#: A hash that more than ``CROWD`` different surroundings would meet under is crowded; slices
#: that have ``FEW`` of them or fewer are not counted, so up to that many of each come on top.
#: The limit rises with the data, so that there are never more than ``MOST`` crowded hashes.
CROWD, FEW, MOST = 4096, 2, 1 << 20


def picked(data: np.ndarray, offsets: np.ndarray, length: int = LENGTH) -> tuple[np.ndarray, ...]:
    """Picked positions with their gram hashes, document, and the first and last string that picks each."""
    none = np.zeros(0, dtype=np.int64)
    span = length - GRAM + 1
    if len(data) < length:
        return none, none.astype(np.uint64), none, none, none
    hashes = mix(PrefixHash(BYTE_VALUES[data]).of(np.arange(len(data) - GRAM + 1), GRAM))
    # The leftmost smallest hash of each stretch: position in the low bits, two running minima per block.
    low = (hashes >> np.uint64(32) << np.uint64(32)) | np.arange(len(hashes), dtype=np.uint64)
    blocks = np.append(low, np.full(-len(low) % span, np.iinfo(np.uint64).max)).reshape(-1, span)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()[: len(low)]
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()[: len(low)]
    count = len(low) - span + 1
    least = np.minimum(behind[:count], ahead[span - 1 :])
    document = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))[:count]
    starts = np.flatnonzero(np.arange(count) + length <= offsets[1:][document])
    at = (least[starts] & np.uint64(0xFFFFFFFF)).astype(np.int64)
    first = np.flatnonzero(np.diff(at, prepend=-1))
    last = np.append(first[1:], len(at)) - 1 if len(at) else first
    return at[first], hashes[at[first]], document[starts[first]], starts[first], starts[last]


def _core(length: int) -> tuple[int, int]:
    """Starts in a group, and bytes of its core."""
    group = max(1, min(GROUP, length // 8))
    return group, length - group + 1


def _groups(at: np.ndarray, first: np.ndarray, last: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """Strings of positions in groups by how far before their position they begin.

    Number of the position, number of the group, where its core starts, its first and last start.
    """
    group, _ = _core(length)
    nearest = (at - last) // group
    count = (at - first) // group - nearest + 1
    owner = np.repeat(np.arange(len(at)), count)
    number = np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count) + nearest[owner]
    core = at[owner] - group * number
    return owner, number, core, np.maximum(first[owner], core - group + 1), np.minimum(last[owner], core)


def covered_bytes(docs: DataFrame, length: int, bits: int) -> DataFrame:
    """``row, starts, ends``: stretches covered by cores that occur anywhere else too."""
    size = _core(length)[1]

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, limit=SLICE):
            data, offsets = text_bytes(batch.column("text"))
            at, _, document, first, last = picked(data, offsets, length)
            owner, number, core, _, _ = _groups(at, first, last, length)
            keys = mix(PrefixHash(BYTE_VALUES[data]).of(core, size) ^ mix(number.astype(np.uint64)))
            rows = batch.column("row").to_numpy()[document[owner]]
            places = (core - offsets[document[owner]]).astype(np.int32)
            yield from offer(keys, rows, places, np.ones(len(core), dtype=bool), bits, PROBE_BYTES)

    found = per_bucket(
        docs.select("row", "text").mapInArrow(probe, OFFER),
        lambda table: regrouped(*answer(table, PROBE_BYTES), bits), "bucket int, rows binary, ats binary",
    )
    return stored(per_bucket(found, lambda table: runs_of(table, size), SPANS), "cores")


def _by_reach(data, at, grams, document, first, last, length: int) -> list[tuple[np.ndarray, ...]]:
    """Positions once for each reach that strings around them have, with the hash they meet under."""
    hashes, out = PrefixHash(BYTE_VALUES[data]), []
    for low, high in zip((0, *REACHES), (*REACHES, length), strict=True):
        start, end = np.maximum(first, at - high + 1), np.minimum(last, at - low)
        has = start <= end
        sure = max(GRAM, length - high + 1)
        met = mix(hashes.of(at[has], sure) ^ np.uint64(high)) if has.any() else grams[:0]
        out.append((at[has], met, document[has], start[has], end[has]))
    return out


def _pairs(data: np.ndarray, starts: np.ndarray, length: int) -> np.ndarray:
    """Two hashes of each string."""
    out = np.zeros(len(starts), dtype=PAIR)
    for name, values in (("one", BYTE_VALUES), ("two", SECOND_VALUES)):
        out[name] = mix(PrefixHash(values[data]).of(starts, length))
    return out


def _spread(first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All whole numbers of ranges, and which range each is of."""
    counts = last - first + 1
    owner = np.repeat(np.arange(len(first)), counts)
    return np.arange(len(owner)) + np.repeat(first - (np.cumsum(counts) - counts), counts), owner


#: What meets in a bucket: surroundings of picked positions, by gram; stretches already known, by
#: row; strings by hash, those that a slice merely has and those whose owners want to know.
_PARTS = "numbers data rows starts ends plain keys owners places".split()
CONTEXTS = ", ".join(["bucket int", *(f"{c} binary" for c in _PARTS)])
_CONTEXTS = pa.schema([("bucket", pa.int32()), *((c, pa.binary()) for c in _PARTS)])
_NUMBERS = np.dtype([("gram", "<u8"), ("row", "<i8"), ("at", "<i4"), ("left", "<i4"), ("right", "<i4"), ("asks", "<i4")])


def _completed(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in parts:
        none = pa.nulls(part.num_rows, pa.binary())
        columns = [part.column(c) if c in part.schema.names else none for c in _CONTEXTS.names]
        yield pa.RecordBatch.from_arrays(columns, schema=_CONTEXTS)


def _contexts(numbers: np.ndarray, texts: list[bytes], bits: int) -> Iterator[pa.RecordBatch]:
    if not len(numbers):
        return
    bucket = (numbers["gram"] >> np.uint64(64 - bits)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    first = np.flatnonzero(np.diff(bucket[order], prepend=-1))
    for part in np.split(order, first[1:]):
        columns = [[int(bucket[part[0]])], [numbers[part].tobytes()], [b"".join(texts[i] for i in part)]]
        kinds = (pa.int32(), pa.binary(), pa.binary())
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["bucket", "numbers", "data"]
        )


def _stretches(rows: np.ndarray, starts: np.ndarray, ends: np.ndarray, bits: int) -> Iterator[pa.RecordBatch]:
    bucket = mix(rows.view(np.uint64)) >> np.uint64(64 - bits)
    yield from packed(bucket, {"rows": rows, "starts": starts.astype(np.int32), "ends": ends.astype(np.int32)})


def _strings(keys: np.ndarray, owners: np.ndarray, places: np.ndarray, asked: np.ndarray, bits: int) -> Iterator[pa.RecordBatch]:
    """Strings that differ within a slice: those whose owners ask, and the others."""
    bucket = (keys["one"] >> np.uint64(64 - bits)).astype(np.int64)
    yield from packed(bucket[~asked], {"plain": keys[~asked]})
    yield from packed(bucket[asked], {"keys": keys[asked], "owners": owners[asked], "places": places[asked]})


class Suffixes:
    """Suffixes of a buffer, each of bounded length, compared by prefix hashes."""

    def __init__(self, data: np.ndarray, at: np.ndarray, right: np.ndarray, group: np.ndarray):
        self.data, self.at, self.right, self.group = data, at, right, group
        self.hashes = PrefixHash(BYTE_VALUES[data])

    def common(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Length of the common extension of suffixes ``a`` and ``b``, by binary search."""
        low = np.zeros(len(a), dtype=np.int64)
        high = np.minimum(self.right[a], self.right[b])
        while (low < high).any():
            middle = (low + high + 1) // 2
            equal = self.hashes.of(self.at[a], middle) == self.hashes.of(self.at[b], middle)
            low, high = np.where(equal, middle, low), np.where(equal, high, middle - 1)
        return low

    def less(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        shared = self.common(a, b)
        over = (shared >= self.right[a]) | (shared >= self.right[b])
        x = self.data[np.where(over, 0, self.at[a] + shared)]
        y = self.data[np.where(over, 0, self.at[b] + shared)]
        return np.where(over, self.right[a] < self.right[b], x < y)

    def sorted(self) -> np.ndarray:
        """Suffixes in order within each group: runs of 1, 2, 4, ... are merged, all merges of a pass at once."""
        order = np.argsort(self.group, kind="stable")
        group = self.group[order]
        start = np.searchsorted(group, group)
        size = np.searchsorted(group, group, side="right") - start
        run = 1
        while run < size.max(initial=0):
            place = np.flatnonzero(size > run)
            inside = place - start[place]
            number = inside // run
            partner = (number ^ 1) * run
            low = np.minimum(partner, size[place])
            high = np.minimum(partner + run, size[place])
            begin, left = low.copy(), number % 2 == 0
            own = order[place]
            while True:
                open_ = np.flatnonzero(low < high)
                if not len(open_):
                    break
                middle = (low[open_] + high[open_]) // 2
                other, me = order[start[place[open_]] + middle], own[open_]
                # Equal suffixes keep the left run's first.
                goes = np.where(left[open_], self.less(other, me), ~self.less(me, other))
                low[open_] = np.where(goes, middle + 1, low[open_])
                high[open_] = np.where(goes, high[open_], middle)
            base = number // 2 * 2 * run
            order[start[place] + base + (inside - number * run) + (low - begin)] = own
            run *= 2
        return order

    def by_bytes(self) -> tuple[np.ndarray, np.ndarray]:
        """Order and common extensions of neighbours without hashes, for when these have collided."""
        texts = [self.data[a : a + n].tobytes() for a, n in zip(self.at, self.right, strict=True)]
        order = np.array(sorted(range(len(texts)), key=lambda i: (self.group[i], texts[i])), dtype=np.int64)
        shared = [len(os.path.commonprefix([texts[a], texts[b]])) for a, b in zip(order, order[1:], strict=False)]
        return order, np.array(shared, dtype=np.int64)

    def verified(self, a: np.ndarray, b: np.ndarray, back: np.ndarray, shared: np.ndarray) -> np.ndarray:
        """Whether the bytes from ``back`` before two suffixes to ``shared`` after are really equal."""
        lengths = back + shared
        part = np.cumsum(lengths) // COMPARED
        if len(part) and part[-1] > part[0]:
            cuts = np.flatnonzero(np.diff(part)) + 1
            pieces = zip(*(np.split(v, cuts) for v in (a, b, back, shared)), strict=True)
            return np.concatenate([self.verified(*piece) for piece in pieces])
        after = np.cumsum(lengths)
        step = np.arange(after[-1] if len(after) else 0) - np.repeat(after - lengths, lengths)
        x, y = (self.data[np.repeat(self.at[i] - back, lengths) + step] for i in (a, b))
        wrong = np.concatenate([[0], np.cumsum(x != y)])
        return wrong[after] == wrong[after - lengths]


def _repeated(numbers: np.ndarray, data: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, start and end of stretches of whole repeated strings around the given positions."""
    sizes = (numbers["left"] + numbers["right"]).astype(np.int64)
    starts = np.cumsum(sizes) - sizes
    left, right = numbers["left"].astype(np.int64), numbers["right"].astype(np.int64)
    suffixes = Suffixes(data, starts + left, right, np.unique(numbers["gram"], return_inverse=True)[1])
    order = suffixes.sorted()
    shared = suffixes.common(order[:-1], order[1:])
    if not suffixes.verified(order[:-1], order[1:], np.zeros_like(shared), shared).all():
        order, shared = suffixes.by_bytes()
    shared = np.where(suffixes.group[order[:-1]] == suffixes.group[order[1:]], shared, -1)
    # How many bytes before the position a string may begin: ``length`` less what is right of it, up to what is left.
    least = length - right
    found = np.zeros((len(numbers), int(left.max(initial=-1)) + 1), dtype=bool)
    for back in range(found.shape[1]):
        alike = np.concatenate([[0], np.cumsum(shared < length - back)])  # runs that agree far enough to the right
        held = np.flatnonzero((least[order] <= back) & (back <= left[order]))
        if len(held) < 2:
            continue
        mine = order[held]
        mark = mix(suffixes.hashes.of(suffixes.at[mine] - back, back) + mix(alike[held].astype(np.uint64)))
        by_mark = np.argsort(mark, kind="stable")
        equal = np.flatnonzero(mark[by_mark][1:] == mark[by_mark][:-1])
        a, b = mine[by_mark[equal]], mine[by_mark[equal + 1]]
        found[a, back] = True
        found[b, back] = True
        wrong = ~suffixes.verified(a, b, np.full(len(a), back), np.zeros(len(a), dtype=np.int64))
        if wrong.any():  # hashes collided: look at the bytes themselves
            found[mine, back] = False
            texts = [(alike[h], data[suffixes.at[i] - back : suffixes.at[i]].tobytes()) for h, i in zip(held, mine, strict=True)]
            counts = Counter(texts)
            found[mine, back] = [counts[t] > 1 for t in texts]
    found &= numbers["asks"].astype(bool)[:, None]
    edge = np.diff(np.pad(found.astype(np.int8), ((0, 0), (1, 1))), axis=1)
    entry, nearest = np.nonzero(edge == 1)
    farthest = np.nonzero(edge == -1)[1] - 1
    at = numbers["at"][entry].astype(np.int64)
    return numbers["row"][entry], at - farthest, at - nearest + length


def _merged(rows: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, ...]:
    """Stretches by row, those that touch as one."""
    order = np.lexsort((starts, rows))
    rows, starts, ends = rows[order], starts[order].astype(np.int64), ends[order].astype(np.int64)
    number = np.cumsum(np.diff(rows, prepend=rows[:1] - 1) != 0) if len(rows) else rows
    reach = np.maximum.accumulate(ends + (number << 32)) - (number << 32)
    fresh = np.ones(len(rows), dtype=bool)
    fresh[1:] = (rows[1:] != rows[:-1]) | (starts[1:] > reach[:-1])
    first = np.flatnonzero(fresh)
    last = np.append(first[1:], len(rows)) - 1 if len(rows) else first
    return rows[first], starts[first], reach[last]


def _candidates(batch: pa.RecordBatch, data, offsets, length: int) -> tuple[np.ndarray, ...]:
    """Of a slice with covered ``starts, ends``: positions by reach with the strings whose core is repeated."""
    at, grams, document, first, last = picked(data, offsets, length)
    owner, _, core, start, end = _groups(at, first, last, length)
    edges = np.zeros(len(data) + 1, dtype=np.int64)
    for name, step in (("starts", 1), ("ends", -1)):
        lists = batch.column(name)
        base = np.repeat(offsets[:-1], np.diff(lists.offsets.to_numpy()))
        np.add.at(edges, base + lists.flatten().to_numpy(), step)
    covered = np.concatenate([[0], np.cumsum(np.cumsum(edges)[:-1] > 0)])
    size = _core(length)[1]
    alive = covered[core + size] - covered[core] == size
    # Neighbouring groups of a position are one range of strings again; nearer groups come first.
    owner, start, end = owner[alive], start[alive], end[alive]
    fresh = np.ones(len(owner), dtype=bool)
    fresh[1:] = (owner[1:] != owner[:-1]) | (end[1:] + 1 != start[:-1])
    head = np.flatnonzero(fresh)
    tail = np.append(head[1:], len(owner)) - 1 if len(owner) else head
    own = owner[head]
    parts = _by_reach(data, at[own], grams[own], document[own], start[tail], end[head], length)
    return tuple(np.concatenate(x) for x in zip(*parts, strict=True))


def crowded_hashes(near: DataFrame, length: int, size: int) -> np.ndarray:
    """Sorted hashes that too many different surroundings would meet under; ``size`` is the bytes of all texts."""

    def report(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, limit=SLICE):
            data, offsets = text_bytes(batch.column("text"))
            at, met, _, first, last = _candidates(batch, data, offsets, length)
            whole = mix(PrefixHash(BYTE_VALUES[data]).of(first, last + length - first) + mix((at - first).astype(np.uint64)))
            found, counts = np.unique(met[np.unique(whole, return_index=True)[1]], return_counts=True)
            much = counts > FEW
            yield pa.RecordBatch.from_arrays(
                [pa.array(found[much].view(np.int64)), pa.array(counts[much], pa.int64())], names=["met", "n"]
            )

    counts = near.mapInArrow(report, "met long, n long").groupBy("met").agg(F.sum("n").alias("n"))
    # A text has a position in every hundred bytes at most, but for periods, which collapse; one counts per reach.
    limit = max(CROWD, size // 100 * (len(REACHES) + 1) // MOST)
    rows = counts.where(F.col("n") > limit).select("met").collect()
    return np.sort(np.array([r[0] for r in rows], dtype=np.int64).view(np.uint64))


def surroundings(docs: DataFrame, copies: DataFrame, length: int, bits: int, size: int) -> DataFrame:
    """What meets, as ``CONTEXTS``: surroundings of positions and strings, one of a kind from a slice."""
    covered = covered_bytes(docs, length, bits)
    near = stored(
        docs.select("row", "text")
        .dropDuplicates(["row"])
        .join(covered.hint("shuffle_hash"), "row")
        .join(copies.hint("shuffle_hash"), "row", "left")
        .where("coalesce(speaks, true)")
        .select("row", "text", "starts", "ends", F.col("speaks").isNull().alias("asks")),
        "near",
    )
    crowded = crowded_hashes(near, length, size)

    def surround(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, limit=SLICE):
            data, offsets = text_bytes(batch.column("text"))
            found = _candidates(batch, data, offsets, length)
            many = np.isin(found[1], crowded)
            at, grams, document, first, last = (x[~many] for x in found)
            strings, group = _spread(found[3][many], found[4][many])
            holder = found[2][many][group]
            row, asks = batch.column("row").to_numpy(), batch.column("asks").to_numpy(zero_copy_only=False)
            texts = [data[a : b + length].tobytes() for a, b in zip(first, last, strict=True)]
            seen: dict[tuple, list[int]] = {}
            for i, key in enumerate(zip((at - first).tolist(), texts, strict=True)):
                seen.setdefault(key, []).append(i)
            numbers = np.zeros(len(at), dtype=_NUMBERS)
            numbers["gram"], numbers["row"], numbers["asks"] = grams, row[document], asks[document]
            numbers["at"], numbers["left"], numbers["right"] = at - offsets[document], at - first, last + length - at
            known = np.array([i for group in seen.values() if len(group) > 1 for i in group], dtype=np.int64)
            own = known[numbers["asks"][known] > 0]
            keys = _pairs(data, strings, length)
            again, stands = several(keys)
            lost = again & asks[holder]
            begin = np.concatenate([(first - offsets[document])[own], (strings - offsets[holder])[lost]])
            close = np.concatenate([(last + length - offsets[document])[own], (strings - offsets[holder])[lost] + length])
            rows = np.concatenate([numbers["row"][own], row[holder[lost]]])
            numbers["asks"][known] = 0
            sent = np.array([group[0] for group in seen.values()], dtype=np.int64)
            asked, places = asks[holder] & ~again, (strings - offsets[holder]).astype(np.int32)
            yield from _completed(_stretches(*_merged(rows, begin, close), bits))
            yield from _completed(_contexts(numbers[sent], [texts[i] for i in sent], bits))
            yield from _completed(_strings(keys[stands], row[holder[stands]], places[stands], asked[stands], bits))

    return near.mapInArrow(surround, CONTEXTS)


def repeated_spans(docs: DataFrame, copies: DataFrame, length: int = LENGTH) -> DataFrame:
    """``row, starts, ends``: maximal byte ranges covered by strings of ``length`` bytes that start elsewhere too.

    For rows of ``keyed`` documents; ``copies``, the texts that occur more than once, are not listed.
    """
    size = text_size(docs)
    bits = bucket_bits(docs.sparkSession, size / BUCKET * BUCKET_BYTES)

    def meet(table: pa.Table) -> pa.Table:
        have = lambda name, kind: unpacked(table[name].drop_null(), kind)
        rows, starts, ends = _repeated(have("numbers", _NUMBERS), have("data", np.uint8), length)
        keys = np.concatenate([have("keys", PAIR), have("plain", PAIR)])
        owners, places = have("owners", np.int64), have("places", np.int32)
        again = several(keys)[0][: len(owners)]
        rows = np.concatenate([rows, have("rows", np.int64), owners[again]])
        starts = np.concatenate([starts, have("starts", np.int32), places[again]])
        ends = np.concatenate([ends, have("ends", np.int32), places[again] + length])
        parts = list(_completed(_stretches(*_merged(rows, starts, ends), bits)))
        return pa.Table.from_batches(parts, schema=_CONTEXTS)

    def joined(table: pa.Table) -> pa.Table:
        have = (unpacked(table["rows"], np.int64), unpacked(table["starts"], np.int32), unpacked(table["ends"], np.int32))
        return spans_table(*_merged(*have))

    found = per_bucket(surroundings(docs, copies, length, bits, size), meet, CONTEXTS)
    return stored(per_bucket(found, joined, SPANS), "repeats")


def remove_repeated_bytes(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """``docs`` with its text replaced by ``kept`` (bytes), ``n_bytes``, ``n_removed`` and ``n_spans``."""
    others = [c for c in docs.columns if c not in ("text", "kept", "n_bytes", "n_removed", "n_spans")]
    named = keyed(docs.select("doc_id", "text", F.struct(*others).alias("rest")))
    copies = copies_of(named)
    spans = repeated_spans(named, copies, length)
    told = spans.join(copies.select("row", F.lit(True).alias("copied")), "row", "full").hint("shuffle_hash")
    schema = named.select("rest").schema.add("kept", "binary")
    for name in ("n_bytes", "n_removed", "n_spans"):
        schema = schema.add(name, "long")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            data, offsets = text_bytes(batch.column("text"))
            raw, kept, removed, spans = data.tobytes(), [], [], []
            columns = [batch.column(c).to_pylist() for c in ("starts", "ends", "copied")]
            for a, b, starts, ends, copied in zip(offsets[:-1].tolist(), offsets[1:].tolist(), *columns, strict=True):
                if copied:
                    starts, ends = ([0], [b - a]) if b - a >= length else ([], [])
                edges = [0, *(x for span in zip(starts, ends, strict=True) for x in span), b - a]
                kept.append(b"".join(raw[a + x : a + y] for x, y in zip(edges[::2], edges[1::2], strict=True)))
                removed.append(b - a - len(kept[-1]))
                spans.append(len(starts))
            sizes = np.diff(offsets)
            yield pa.RecordBatch.from_arrays(
                [batch.column("rest"), pa.array(kept, pa.binary()), *(pa.array(x, pa.int64()) for x in (sizes, removed, spans))],
                names=["rest", "kept", "n_bytes", "n_removed", "n_spans"],
            )

    none = F.array().cast("array<int>")
    return (
        named.join(told, "row", "left")
        .select(
            "rest",
            "text",
            F.coalesce("starts", none).alias("starts"),
            F.coalesce("ends", none).alias("ends"),
            F.coalesce("copied", F.lit(False)).alias("copied"),
        )
        .mapInArrow(cut, schema)
        .select("rest.*", "kept", "n_bytes", "n_removed", "n_spans")
    )


def op7_suffix_dedup(spark, sf_dir: str) -> DataFrame:
    """All documents without the bytes of 400-byte strings that start in two places or more."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return remove_repeated_bytes(docs, LENGTH).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256")
    )
