"""Removal of exact repeats of word sequences, found through fixed blocks.

A window of ``window`` words always holds one whole block of half that length of
the grid that starts at its document's first word.  So the grid blocks alone are
the index, and every position of every document probes it with the block that
starts there: a window can only be repeated if its grid block is met at some
other position.  From each such anchor the hit is extended over all windows
around it, as far as they are found elsewhere too; what the extended hits cover
is removed.

Windows are taken to be equal if two independent 64-bit hashes of their words are.

Probes are sent once per slice of documents and key, and a slice that has a key
twice answers itself.  So a passage that very many documents share costs a
bucket one entry per slice.  Texts that occur several times are removed whole
and take part through one of them.

Defined results: a null text has no words; texts shorter than a window lose
nothing; rows that repeat, even with equal ids, are each other's repeats; an
empty table gives an empty result; other columns pass through.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardline.llm.exchange import (
    OFFER,
    PAIR,
    SPANS,
    answer,
    answer_pairs,
    bucket_bits,
    copies_of,
    keyed,
    offer,
    offer_pairs,
    per_bucket,
    regrouped,
    runs_of,
    stored,
    text_size,
)
from wardline.llm.text import SECOND_VALUES, Words, slices

WINDOW = 35

#: Bytes of a probe that travel; with its bucket they decide whether a block is looked at again.
PROBE_BYTES = 5

#: Bytes of text per word, for sizing buckets only.
WORD_BYTES = 6


def _block_of(starts: np.ndarray, block: int) -> np.ndarray:
    """Number of the first grid block at or after a position of a document."""
    return (starts + block - 1) // block


def anchors(docs: DataFrame, window: int, bits: int) -> DataFrame:
    """``row, at``: grid blocks whose words also stand at some other position."""
    block = (window + 1) // 2

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            words = Words(batch.column("text"))
            starts, hashes = words.runs(words.hashes(), block)
            owner = words.doc[starts]
            within = starts - words.bounds[owner]
            rows = batch.column("row").to_numpy()[owner]
            yield from offer(
                hashes, rows, (within // block).astype(np.int32), within % block == 0, bits, PROBE_BYTES
            )

    def meet(table: pa.Table) -> pa.Table:
        rows, ats = answer(table, PROBE_BYTES)
        return pa.table({"row": rows, "at": ats})

    return per_bucket(docs.select("row", "text").mapInArrow(probe, OFFER), meet, "row long, at int")


def extended(docs: DataFrame, blocks: DataFrame, copies: DataFrame, window: int, bits: int) -> DataFrame:
    """``row, starts, ends``: word ranges covered by windows that occur elsewhere, around the given blocks."""
    block = (window + 1) // 2
    hits = blocks.groupBy("row").agg(F.collect_list("at").alias("blocks"))
    near = (
        docs.select("row", "text")
        .dropDuplicates(["row"])
        .join(hits.hint("shuffle_hash"), "row")
        .join(copies.hint("shuffle_hash"), "row", "left")
        .where("coalesce(speaks, true)")
        .select("row", "text", "blocks", F.col("speaks").isNull().alias("asks"))
    )

    def extend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            words = Words(batch.column("text"))
            lists = batch.column("blocks")
            grid = np.concatenate([[0], np.cumsum(words.counts // block + 2)])
            hit = np.zeros(grid[-1], dtype=bool)
            lengths = np.diff(lists.offsets.to_numpy())
            hit[np.repeat(grid[:-1], lengths) + lists.flatten().to_numpy()] = True
            starts, one = words.runs(words.hashes(), window)
            owner = words.doc[starts]
            within = starts - words.bounds[owner]
            near_hit = hit[grid[owner] + _block_of(within, block)]
            keys = np.zeros(int(near_hit.sum()), dtype=PAIR)
            keys["one"] = one[near_hit]
            keys["two"] = words.runs(words.hashes(SECOND_VALUES), window)[1][near_hit]
            owner, within = owner[near_hit], within[near_hit]
            rows = batch.column("row").to_numpy()[owner]
            asks = batch.column("asks").to_numpy(zero_copy_only=False)[owner]
            yield from offer_pairs(keys, rows, within.astype(np.int32), asks, bits)

    def meet(table: pa.Table) -> pa.Table:
        return regrouped(*answer_pairs(table), bits)

    found = per_bucket(near.mapInArrow(extend, OFFER), meet, "bucket int, rows binary, ats binary")
    return per_bucket(found, lambda table: runs_of(table, window), SPANS)


def repeated_ranges(docs: DataFrame, copies: DataFrame, window: int = WINDOW) -> DataFrame:
    """``row, starts, ends``: ranges of words that lie in a repeated window, for rows of ``keyed`` documents.

    ``copies``, the texts that occur more than once, are not listed; they are repeated as a whole.
    """
    bits = bucket_bits(docs.sparkSession, text_size(docs) / WORD_BYTES * PROBE_BYTES)
    blocks = stored(anchors(docs, window, bits), "anchors")
    return stored(extended(docs, blocks, copies, window, bits), "repeats")


def remove_repeats(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """``docs`` with its text reduced to the kept words, joined by one space, and ``n_words``, ``n_removed``.

    A null text stays null.
    """
    others = [c for c in docs.columns if c not in ("text", "n_words", "n_removed")]
    named = keyed(docs.select("doc_id", "text", F.struct(*others).alias("rest")))
    copies = copies_of(named)
    spans = repeated_ranges(named, copies, window)
    told = spans.join(copies.select("row", F.lit(True).alias("copied")), "row", "full").hint("shuffle_hash")
    schema = named.select("rest", "text").schema.add("n_words", "long").add("n_removed", "long")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            words = Words(batch.column("text"))
            change = np.zeros(len(words.starts) + 1, dtype=np.int32)
            for edge, step in (("starts", 1), ("ends", -1)):
                lists = batch.column(edge)
                lengths = np.diff(lists.offsets.to_numpy())
                np.add.at(change, np.repeat(words.bounds[:-1], lengths) + lists.flatten().to_numpy(), step)
            gone = np.cumsum(change[:-1]) > 0
            whole = batch.column("copied").to_numpy(zero_copy_only=False) & (words.counts >= window)
            gone |= whole[words.doc]
            texts, valid = _joined(words, ~gone), batch.column("text").is_valid().to_numpy(zero_copy_only=False)
            removed = words.counts - np.diff(np.concatenate([[0], np.cumsum(~gone)])[words.bounds])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("rest"),
                    pa.array([t if v else None for t, v in zip(texts, valid, strict=True)], pa.string()),
                    pa.array(words.counts, pa.int64()),
                    pa.array(removed, pa.int64()),
                ],
                names=["rest", "text", "n_words", "n_removed"],
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
        .select("rest.*", "text", "n_words", "n_removed")
    )


def _joined(words: Words, kept: np.ndarray) -> list[str]:
    """The kept words of each document, joined by one space."""
    starts, ends, doc = words.starts[kept], words.ends[kept], words.doc[kept]
    lengths = ends - starts + 1
    after = np.cumsum(lengths)
    source = np.arange(after[-1] if len(after) else 0) + np.repeat(starts - (after - lengths), lengths)
    out = np.append(words.data, np.uint8(32))[np.minimum(source, len(words.data))] if len(source) else np.zeros(0, np.uint8)
    out[after - 1] = 32
    last = np.searchsorted(doc, np.arange(len(words.counts)), side="right")
    bounds = np.concatenate([[0], after])[np.concatenate([[0], last])]
    raw = out.tobytes()
    return [raw[a : max(a, b - 1)].decode() for a, b in zip(bounds[:-1], bounds[1:], strict=True)]


def op9_substring_dedup(spark, sf_dir: str) -> DataFrame:
    """All documents without the words of 35-word windows that occur twice or more."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return remove_repeats(docs, WINDOW).select(
        "doc_id",
        "n_words",
        "n_removed",
        F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("kept_sha256"),
    )
