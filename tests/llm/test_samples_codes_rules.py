"""Resampling, vector codes and quality rules against plain loops."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter
from fractions import Fraction

import compare
import edge
import numpy as np
import pytest
from pyspark.sql import functions as F

from wardline.llm import qualityrules, resample, vectorcodes

TOKEN = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def features(text: str | None) -> tuple[int, list[int]]:
    words = TOKEN.findall((text or "").translate({c: c + 32 for c in range(65, 91)}))
    runs = [" ".join(words[i : i + n]) for n in (1, 2, 3) for i in range(len(words) - n + 1)]
    return len(words), [zlib.crc32(r.encode()) % 10_000 for r in runs]


def drawn_by_loop(docs: list[tuple], target: list[str | None], percent: int) -> list[tuple]:
    have, want = (Counter(b for t in texts for b in features(t)[1]) for texts in ([d[1] for d in docs], target))
    big_s, big_t = sum(have.values()), sum(want.values())
    gain = [math.floor(1000 * math.log((want[b] + 1) * (big_s + 10_000) / ((have[b] + 1) * (big_t + 10_000)))) for b in range(10_000)]
    rows, able = [], []
    for doc, text in docs:
        n_words, found = features(text)
        h = int(hashlib.sha256(f"42:{'' if doc is None else doc}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[b] for b in found)
        rows.append([doc, len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None])
        if n_words >= 20:
            able.append(rows[-1])
    able.sort(key=lambda r: (-r[3], r[0] is None, r[0]))
    for place, row in enumerate(able[: percent * len(able) // 100], 1):
        row[4] = place
    return sorted(map(tuple, rows), key=repr)


@pytest.mark.parametrize("percent", [0, 5, 40, 60, 100])
def test_resampling_equals_loops(spark, percent):
    docs = edge.rows()
    target = spark.createDataFrame([(docs[6][1],), (None,), ("",)], "text string")
    found = resample.resampled(edge.documents(spark), target, percent=percent).select("doc_id", "n_features", "weight", "score", "rank")
    expected = drawn_by_loop([r[:2] for r in docs], [docs[6][1], None, ""], percent)
    assert sorted(map(tuple, found.collect()), key=repr) == expected


def test_equal_rows_are_drawn_one_by_one(spark):
    """A third of all rows are one document: some of its copies are drawn, others are not."""
    text = " ".join(f"w{i}" for i in range(30))
    docs = [(7, text)] * 40 + [(i, f"{text} {i}") for i in range(100, 180)]
    table = spark.createDataFrame(docs, "doc_id long, text string")
    for percent in (10, 35, 50, 90):
        found = resample.resampled(table, table.select("text").limit(3), percent=percent).collect()
        ranks = sorted(r["rank"] for r in found if r["rank"] is not None)
        assert len(found) == 120 and ranks == list(range(1, percent * 120 // 100 + 1))


def test_drawn_rows_come_whole(spark):
    docs = edge.documents(spark)
    found = resample.draw(docs, docs.select("text"), percent=50)
    assert found.columns == docs.columns
    able = sum(features(r[1])[0] >= 20 for r in edge.rows())
    assert {tuple(r) for r in found.collect()} <= {tuple(r) for r in docs.collect()} and found.count() == able // 2
    assert resample.draw(docs.limit(0), docs.select("text")).count() == 0
    assert resample.draw(docs, docs.select("text").limit(0), percent=100).count() == able


def test_bisection_finds_the_last_that_holds():
    for low, high in ((0, 0), (-5, 1000), (3, 17), (0, 16), (0, 15)):
        for last in {low, high, (low + high) // 2, high - 1} & set(range(low, high + 1)):
            calls = []
            assert resample.bisected(low, high, lambda ps: calls.append(ps) or [p <= last for p in ps]) == last  # noqa: B023
            assert all(len(c) <= resample.POINTS + 1 for c in calls)


# --- vector codes ---


def coded_by_loop(rows: list[tuple], parts: int, entries: int, rounds: int):
    good = [r for r in rows if r[1] is not None and all(x is not None and math.isfinite(x) for x in r[1])]
    good.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    width = -(-max(len(r[1]) for r in good) // parts)
    whole = [[math.floor(Fraction(x) * 1024) for x in r[1]] + [0] * (width * parts - len(r[1])) for r in good]
    cut = [[v[p * width : (p + 1) * width] for p in range(parts)] for v in whole]
    books = [[c[p] for c in cut[:entries]] for p in range(parts)]
    away = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b, strict=True))
    best = lambda part, book: min((away(part, e), i) for i, e in enumerate(book))
    for _ in range(rounds):
        for p in range(parts):
            given: dict[int, list] = {}
            for c in cut:
                given.setdefault(best(c[p], books[p])[1], []).append(c[p])
            books[p] = [[sum(x) // len(given[i]) for x in zip(*given[i], strict=True)] if i in given else e for i, e in enumerate(books[p])]
    out = []
    for r, c in zip(good, cut, strict=True):
        found = [best(c[p], books[p]) for p in range(parts)]
        error = sum(d for d, _ in found)
        out.append((r[0], "".join(f"{i:02x}" for _, i in found), error if error < 1 << 63 else None))
    return sorted(out, key=repr), books


def vector_rows(scale: float) -> list[tuple]:
    rng = np.random.default_rng(8)
    rows = [(i, (rng.normal(size=6) * scale).tolist(), i % 3) for i in range(60)]
    rows += [(70 + i, rows[3][1], None) for i in range(30)]  # a third of all rows are one vector
    rows += [(5, (rng.normal(size=6) * scale).tolist(), 1), (5, rows[5][1], 1), (None, [scale] * 6, None), (200, [0.5, -0.5], 2)]
    return rows + [(300, None, 1), (301, [None, 1.0], 1), (302, [float("nan")] * 6, 1), (303, [float("-inf")] * 6, None)]


@pytest.mark.parametrize("scale", [1.0, 3e6, 1e12, 1e300])
@pytest.mark.parametrize("entries", [7, 256])
def test_codes_equal_loops(spark, scale, entries):
    rows = vector_rows(scale)
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    coded, books = vectorcodes.compressed(table.withColumn("code", F.lit("x")), keep=("label",), entries=entries)
    expected, own = coded_by_loop(rows, 4, entries, 4)
    found = coded.select("vec_id", F.lower(F.hex("code")), "error").collect()
    assert sorted(map(tuple, found), key=repr) == expected and books == own


def test_label_errors_add_up(spark):
    table = spark.createDataFrame(vector_rows(1.0), "vec_id long, embedding array<double>, label int")
    found = vectorcodes.with_label_error(vectorcodes.compressed(table, keep=("label",), entries=5)[0]).collect()
    sums = Counter()
    for r in found:
        sums[r.label] += r.error
    assert len(found) == 94 and all(r.label_error == sums[r.label] for r in found)


def test_active_entries_give_what_a_whole_comparison_gives():
    rng = np.random.default_rng(3)
    for kind in (np.float64, np.int64, object):
        x, book = (rng.integers(-3, 4, (n, 2)).astype(kind) for n in (400, 24))
        code, apart = vectorcodes.nearest(x, book)
        for share in (0.0, 0.2, 1.0):
            after = book.copy()
            after[rng.random(24) < share] += rng.integers(0, 2)
            moved = (after != book).any(axis=1)
            one, two = vectorcodes.assigned(x, after, moved, code, apart), vectorcodes.nearest(x, after)
            assert (one[0] == two[0]).all() and (one[1] == two[1]).all()


def test_no_vectors_no_codes(spark):
    table = spark.createDataFrame(vector_rows(1.0), "vec_id long, embedding array<double>, label int")
    for none in (table.limit(0), table.where("vec_id >= 300")):
        coded, books = vectorcodes.compressed(none, keep=("label",))
        assert vectorcodes.with_label_error(coded).count() == 0 and coded.columns == ["vec_id", "label", "code", "error"]


# --- quality rules ---


def counts_by_loop(text: str | None) -> tuple:
    words = edge.WORD.findall(text or "")
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    seen, inside = Counter(windows), set()
    for i, w in enumerate(windows):
        if seen[w] > 1:
            inside |= set(range(i, i + 5))
    lines = [x for x in (text or "").split("\n") if edge.WORD.search(x)]
    n, again = len(words), len(inside)
    symbols = sum((text or "").count(c) for c in "#*$%&|<>")
    return n, sum(map(len, words)), symbols, len(lines) - len(set(lines)), again, n < 10 or 100 * again > 20 * n


def test_counts_equal_loops(spark):
    docs = edge.rows()
    docs += [(900, "a b c d e f\n\n" * 5 + "a b c d e f g\r\n" * 2 + "a b c d e f", "en", "a", 1, *"abcdefgh"), (901, "x < y | # *\n \n x < y | # *", None, None, 1, *"abcdefgh")]
    found = qualityrules.statistics(edge.documents(spark, docs)).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"
    )
    expected = sorted([(r[0], *counts_by_loop(r[1])) for r in docs], key=repr)
    assert sorted(map(tuple, found.collect()), key=repr) == expected


def test_binomial_tail_is_exact_and_never_too_small(spark):
    cases = [(n, k, p) for n in (1, 2, 16, 40, 400) for k in range(0, n + 1, max(1, n // 7)) for p in (0.004, 0.3)]
    for p in (0.004, 0.3):
        own = [(n, k) for n, k, q in cases if q == p]
        table = spark.createDataFrame(own, "n long, k long").withColumn("tail", qualityrules.binomial_tail(F.col("n"), F.col("k"), p))
        for n, k, tail in table.collect():
            exact = sum(math.comb(n, i) * Fraction(p) ** i * (1 - Fraction(p)) ** (n - i) for i in range(k + 1))
            assert tail == pytest.approx(float(exact), rel=1e-9)


def test_long_tails_are_bounded_from_above(spark, monkeypatch):
    table = spark.createDataFrame([(20_000, k) for k in (40, 60, 75)], "n long, k long")
    tail = lambda: {k: t for _, k, t in table.withColumn("t", qualityrules.binomial_tail(F.col("n"), F.col("k"), 0.004)).collect()}
    whole = tail()
    monkeypatch.setattr(qualityrules, "TERMS", 8)
    for k, t in tail().items():
        assert whole[k] <= t <= 1.2 * whole[k]


def labelled(spark, seed: int, n: int = 6000):
    """Good documents seldom hold symbols; bad ones often do, more in one language than in the other."""
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        bad, lang = rng.random() < 0.2, ("en", "fr", None)[i % 3]
        marks = rng.binomial(30, 0.3 if bad else 0.01)
        rows.append((i, " ".join(f"w{rng.integers(1000)}{'#' if j < marks else ''}" for j in range(30)), lang, 0 if bad else 1))
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, label int")


def test_risk_holds_for_fresh_documents(spark):
    table = labelled(spark, 1)
    learned, fresh = table.where("doc_id < 4000"), table.where("doc_id >= 4000")
    stats = qualityrules.statistics(learned)
    cutoffs = qualityrules.certified(stats, learned.select("doc_id", "label"), risk=0.1)
    used = {(r.stratum, r.rule): r for r in cutoffs.collect()}
    assert {(s, "symbols") for s in ("en", "fr", None)} <= set(used)
    for r in used.values():
        assert r.good_lost <= 0.02 * r.n_good and r.bad_lost > 0
    verdicts = qualityrules.judged(fresh, learned.select("doc_id", "label"), risk=0.1)
    assert verdicts.where("NOT kept").count() == 0  # labels of other documents tell nothing about these
    both = qualityrules.judged(table, learned.select("doc_id", "label"), risk=0.1).join(fresh.select("doc_id", "lang", "label"), "doc_id")
    for r in both.groupBy("lang", "label").agg(F.avg((~F.col("kept")).cast("double")).alias("lost")).collect():
        assert r.lost <= 0.1 if r.label == 1 else r.lost > 0.5


def test_rules_on_odd_rows_and_labels(spark):
    docs = edge.documents(spark)
    labels = spark.createDataFrame([(6, 1), (6, 0), (6, None), (None, 1), (8, 1)], "doc_id long, label int")
    found = qualityrules.judged(docs, labels)
    assert found.count() == docs.count() and found.where("kept = base_failed").count() == 0
    assert qualityrules.judged(docs, labels.limit(0)).count() == docs.count()
    assert qualityrules.judged(docs.limit(0), labels).count() == 0


def test_rules_equal_sql_where_cutoffs_bite(spark):
    folder = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    labels = spark.read.parquet(f"{folder}/labels.parquet").select("doc_id", F.col("quality").alias("label"))
    found = qualityrules.judged(docs, labels, risk=0.4).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )
    assert found.where("NOT kept AND NOT base_failed").count() > 10
    assert compare.differences(found, compare.duck(folder), qualityrules.oracle(0.4)) == []
