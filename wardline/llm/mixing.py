"""Mixing sources to target weights along a time-varying curriculum.

Every source has a weight schedule over training time 0..1, given as knots
joined by straight lines.  Its integral is the source's overall weight, which
sets how many words the mix takes from it.  Within a source, documents stand in
a fixed pseudo-random order; the words before a document are the demand that
must have been met when its turn comes, and inverting the integrated schedule
at that demand gives the document's position in training.  Sorting all documents
by position interleaves the sources as their schedules say.

Everything is built-in DataFrame work.  Running word counts are kept in two
levels (sums of hash buckets, then rows of one bucket), so a source holding most
rows is spread over as many tasks as any other.

Defined results: a null or empty text has size 0 and is never taken; a null
source is a source of its own, ranked last; rows with equal ids or wholly equal
rows are separate documents; an empty table gives an empty result; other
columns of the input do not matter.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wardline.llm.exchange import stored

WORD = r"[^\x20\x09-\x0D]+"

#: Overall weights of the sources in code point order, repeating.
CYCLE = (1, 2, 3)


def cycled_schedules(sources: DataFrame, cycle: tuple[int, ...] = CYCLE) -> DataFrame:
    """``source, knots`` with overall weights ``cycle``: light sources early, heavy ones late.

    Each schedule is a straight line whose mean is the overall weight.
    """
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in cycle]), (place % len(cycle) + 1).cast("int"))
    middle = sum(cycle) / len(cycle)
    slope = (F.col("w") - middle) / (4 * middle)
    knots = [
        F.struct(F.lit(t).alias("t"), (F.col("w") * end).alias("w")) for t, end in ((0.0, 1 - slope), (1.0, 1 + slope))
    ]
    return sources.select("source", weight.alias("w")).select("source", F.array(*knots).alias("knots"))


def _segments(knots: Column) -> Column:
    """Knots as pieces ``t0, t1, w0, w1, area`` of the schedule."""
    return F.transform(
        F.sequence(F.lit(1), F.size(knots) - 1),
        lambda i: F.struct(
            F.element_at(knots, i)["t"].alias("t0"),
            F.element_at(knots, i + 1)["t"].alias("t1"),
            F.element_at(knots, i)["w"].alias("w0"),
            F.element_at(knots, i + 1)["w"].alias("w1"),
            (
                (F.element_at(knots, i + 1)["t"] - F.element_at(knots, i)["t"])
                * (F.element_at(knots, i)["w"] + F.element_at(knots, i + 1)["w"])
                / 2
            ).alias("area"),
        ),
    )


def _when_met(pieces: Column, demand: Column) -> Column:
    """The time at which the integrated schedule reaches ``demand``."""
    state = F.aggregate(
        pieces,
        F.struct(F.lit(None).cast("double").alias("t"), demand.alias("left")),
        lambda acc, p: F.struct(
            F.when(acc["t"].isNotNull(), acc["t"])
            .when(
                acc["left"] < p["area"],
                p["t0"]
                + F.coalesce(
                    F.try_divide(
                        2 * acc["left"],
                        p["w0"]
                        + F.sqrt(p["w0"] * p["w0"] + 2 * (p["w1"] - p["w0"]) / (p["t1"] - p["t0"]) * acc["left"]),
                    ),
                    F.lit(0.0),
                ),
            )
            .alias("t"),
            (acc["left"] - p["area"]).alias("left"),
        ),
    )
    return F.coalesce(state["t"], F.element_at(pieces, -1)["t1"])


def source_targets(sizes: DataFrame, schedules: DataFrame, cap: float) -> DataFrame:
    """``source, source_size, pieces, weight, target``: the total shared by integrated weight.

    ``sizes`` is one row per source.  A target stops at ``cap`` times the source's size;
    what it cannot take is shared again among the others by weight.
    """
    pieces = _segments(F.col("knots"))
    known = (
        sizes.alias("s")
        .join(schedules.alias("c"), F.expr("s.source <=> c.source"))
        .select("s.source", "s.source_size", pieces.alias("pieces"))
        .withColumn("weight", F.aggregate("pieces", F.lit(0.0), lambda total, p: total + p["area"]))
        .withColumn("most", F.col("source_size") * F.lit(cap))
    )
    # Sources fill up in the order of cap per weight; one is full when an even
    # share of what its predecessors leave over would lift it above its cap.
    everything = Window.partitionBy()
    order = Window.orderBy(F.col("most") / F.col("weight"), F.col("source").asc_nulls_last())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    onward = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    filled = known.select(
        "*",
        F.sum("source_size").over(everything).alias("total"),
        F.coalesce(F.sum("most").over(before), F.lit(0)).alias("most_before"),
        F.sum("weight").over(onward).alias("weight_onward"),
    ).withColumn("full", F.col("most") * F.col("weight_onward") <= F.col("weight") * (F.col("total") - F.col("most_before")))
    level = (F.col("total") - F.coalesce(F.sum(F.when(F.col("full"), F.col("most"))).over(everything), F.lit(0))) / F.sum(
        F.when(~F.col("full"), F.col("weight"))
    ).over(everything)
    return filled.withColumn("level", level).select(
        "source",
        "source_size",
        "pieces",
        "weight",
        F.when(F.col("full"), F.col("most").cast("double")).otherwise(F.col("weight") * F.col("level")).alias("target"),
    )


def _counted(docs: DataFrame, schedules: DataFrame | None, cap: float) -> DataFrame:
    """Every document with its place in its source and what the mix takes of it."""
    sized = stored(
        docs.select(
            "doc_id",
            F.xxhash64("text").alias("text_hash"),
            "source",
            F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
            F.coalesce(F.md5(F.col("doc_id").cast("string").cast("binary")), F.lit("")).alias("turn"),
        ),
        "sizes",
    )
    # About as many buckets as rows in a bucket: neither level becomes large.
    digits = max(1, math.ceil(math.log(max(sized.count(), 1), 16) / 2))
    sized = sized.withColumn("bucket", F.substring("turn", 1, digits))
    sums = sized.groupBy("source", "bucket").agg(F.sum("size").alias("words"))
    sizes = sums.groupBy("source").agg(F.sum("words").alias("source_size"))
    targets = source_targets(sizes, schedules if schedules is not None else cycled_schedules(sizes), cap)
    earlier = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        sums.withColumn("start", F.coalesce(F.sum("words").over(earlier), F.lit(0)))
        .alias("b")
        .join(targets.alias("t"), F.expr("b.source <=> t.source"))
        .select("b.source", "b.bucket", "b.start", "t.source_size", "t.pieces", "t.weight", "t.target")
    )
    within = (
        Window.partitionBy("source", "bucket")
        .orderBy("turn", "doc_id", "size", "text_hash")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    placed = (
        sized.withColumn("ahead", F.coalesce(F.sum("size").over(within), F.lit(0)))
        .alias("d")
        .join(starts.alias("s"), F.expr("d.source <=> s.source AND d.bucket = s.bucket"))
        .select(
            "d.doc_id", "d.text_hash", "d.source", "d.size", "s.source_size", "s.pieces", "s.weight", "s.target",
            (F.col("s.start") + F.col("d.ahead")).alias("before"),
        )
    )
    quota = F.floor(F.col("target") + 0.5)
    full = F.when(F.col("source_size") > 0, F.floor(quota / F.col("source_size"))).otherwise(0)
    part = F.least(F.col("size"), F.greatest(F.lit(0), quota - full * F.col("source_size") - F.col("before")))
    return (
        placed.withColumn("full", full)
        .withColumn("part", part)
        .withColumn("taken", (F.col("full") * F.col("size") + F.col("part")).cast("long"))
        .withColumn("passes", F.when(F.col("taken") > 0, F.col("full") + (F.col("part") > 0).cast("long")).otherwise(0))
    )


def _position(pass_number: Column) -> Column:
    """When the curriculum meets a document in its source's given pass; null if it is not taken."""
    words = F.col("before") + pass_number * F.col("source_size")
    return F.when(F.col("taken") > 0, _when_met(F.col("pieces"), words / F.col("target") * F.col("weight")))


def mix_sources(docs: DataFrame, schedules: DataFrame | None = None, cap: float = 3) -> DataFrame:
    """Per document ``doc_id, text_hash, source, size, source_size, target, taken, passes, position``.

    ``taken`` counts the words the mix takes, repeats included, and adds up to each
    source's rounded target; the last document of a source may be taken in part.
    ``passes`` is how many times the mix meets the document, ``position`` (0..1) when
    it does so first, null for a document that is not taken.  Rows come range-sorted
    by position.
    """
    return (
        _counted(docs, schedules, cap)
        .withColumn("position", _position(F.lit(0)))
        .select(
            "doc_id", "text_hash", "source", "size", "source_size", "target", "taken",
            F.col("passes").cast("int").alias("passes"), "position",
        )
        .orderBy(F.col("position").asc_nulls_last(), "doc_id")
    )


def training_order(docs: DataFrame, schedules: DataFrame | None = None, cap: float = 3) -> DataFrame:
    """The mix itself: a row of ``docs`` for each time it is met, whole, range-sorted by position.

    Rows equal in id, text and source are met in turn; where they differ in other
    columns, the same one of them stands for all in every run.
    """
    plan = (
        _counted(docs, schedules, cap)
        .where("passes > 0")
        .withColumn("position", F.explode(F.transform(F.sequence(F.lit(0).cast("long"), F.col("passes") - 1), _position)))
        .groupBy("doc_id", "text_hash", "source")
        .agg(F.collect_list("position").alias("positions"))
        .alias("p")
    )
    whole = F.struct("*")
    texts = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), "source", whole.alias("doc"), F.xxhash64(whole).alias("turn"))
    same = "d.doc_id <=> p.doc_id AND d.text_hash = p.text_hash AND d.source <=> p.source"
    return (
        texts.groupBy("doc_id", "text_hash", "source")
        .agg(F.min_by("doc", "turn").alias("doc"))
        .alias("d")
        .join(plan.hint("shuffle_hash"), F.expr(same))
        .select("doc", F.explode("positions").alias("position"))
        .orderBy("position", "doc.doc_id")
        .select("doc.*")
    )


ORACLE = r"""
WITH sized AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
         coalesce(md5(doc_id::VARCHAR), '') AS turn
  FROM documents
), sizes AS (
  SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source
), weighed AS (
  SELECT *, ((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::DOUBLE AS w, source_size * 3 AS most,
         sum(source_size) OVER () AS total
  FROM sizes
), filled AS (
  SELECT *, coalesce(sum(most) OVER (ORDER BY most / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS most_before,
         sum(w) OVER (ORDER BY most / w, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS w_onward
  FROM weighed
), levelled AS (
  SELECT *, most * w_onward <= w * (total - most_before) AS is_full FROM filled
), targets AS (
  SELECT source, source_size, w,
         CASE WHEN is_full THEN most::DOUBLE
              ELSE w * ((total - coalesce(sum(CASE WHEN is_full THEN most END) OVER (), 0))::DOUBLE
                        / sum(CASE WHEN NOT is_full THEN w END) OVER ()) END AS target
  FROM levelled
), placed AS (
  SELECT d.doc_id, d.size, t.source_size, t.target, t.w, floor(t.target + 0.5)::BIGINT AS quota,
         coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.turn, d.doc_id, d.size
                                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS ahead
  FROM sized d JOIN targets t ON d.source IS NOT DISTINCT FROM t.source
), counted AS (
  SELECT *, CASE WHEN source_size > 0 THEN quota // source_size ELSE 0 END AS whole FROM placed
), taking AS (
  SELECT *, (whole * size + least(size, greatest(0, quota - whole * source_size - ahead)))::BIGINT AS taken,
         w * (1 - (w - 2) / 8) AS w0, w * (1 + (w - 2) / 8) AS w1, ahead / target * w AS demand
  FROM counted
)
SELECT doc_id, size, source_size, target, taken,
       CASE WHEN taken > 0 THEN round(2 * demand / (w0 + sqrt(w0 * w0 + 2 * (w1 - w0) * demand)), 6) END AS position
FROM taking
"""


def op5_source_mix(spark, sf_dir: str) -> DataFrame:
    """All documents mixed by weights 1, 2, 3 with targets of at most three times a source's size."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return mix_sources(docs, cap=3).select(
        "doc_id", "size", "source_size", "target", "taken", F.round("position", 6).alias("position")
    )
