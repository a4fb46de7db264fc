"""Searches against brute force."""

from __future__ import annotations

import numpy as np
import pytest

from wardline.llm import ann, topk

QUERY = "vec_id % 20 = 0"


def brute(rows: list[tuple], k: int, of) -> dict[int, list[tuple]]:
    out = {}
    for q, a in rows:
        if q % 20 == 0:
            scored = sorted((-of(a, b), v) for v, b in rows if v != q)
            out[q] = [(v, -s) for s, v in scored[:k]]
    return out


def grouped(frame) -> dict[int, list[tuple]]:
    out: dict[int, list] = {}
    for r in sorted(frame.collect(), key=lambda r: (r.query_id, r["rank"])):
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r["rank"] == len(out[r.query_id])
    return out


def integers(a, b) -> int:
    return sum(int(np.floor(64 * x)) * int(np.floor(64 * y)) for x, y in zip(a, b, strict=False))


@pytest.fixture(scope="module")
def odd(spark):
    rng = np.random.default_rng(4)
    good = [(i, rng.normal(size=6).round(3).tolist()) for i in range(90)]
    good += [(90 + i, good[3][1]) for i in range(40)] + [(200, [0.5, 0.5]), (201, [1e12] * 6), (202, [-1e12] * 6)]
    bad = [(300, None), (301, [None, 1.0]), (302, [float("nan")] * 6), (303, [float("inf")] * 6), (None, [1.0] * 6)]
    table = spark.createDataFrame([(i, v, 0, "x") for i, v in good + bad], "vec_id long, embedding array<double>, shard int, score string")
    return good, table


@pytest.mark.parametrize("k", [1, 5, 20, 500])
def test_top_k_is_exact(odd, k):
    good, table = odd
    assert grouped(topk.exact_top_k(table, QUERY, k)) == brute(good, k, integers)


def test_top_k_over_many_shards(odd, monkeypatch):
    good, table = odd
    monkeypatch.setattr(topk, "SHARD", 7)
    monkeypatch.setattr(topk, "QUERIES", 2)
    monkeypatch.setattr(topk, "FAN_IN", 3)
    assert grouped(topk.exact_top_k(table, QUERY, 5, parts=3)) == brute(good, 5, integers)


def test_nearest_finds_what_brute_force_finds(spark):
    table = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    rows = [(r.vec_id, np.array(r.embedding, dtype=float)) for r in table.collect()]
    expected, found = brute(rows, 20, lambda a, b: float(a @ b)), grouped(ann.nearest(table, QUERY, 20))
    hits = sum(len({v for v, _ in expected[q]} & {v for v, _ in found[q]}) for q in expected)
    assert hits >= 0.9 * 20 * len(expected)
    for q, best in found.items():
        assert [v for v, _ in best] == [v for v, _ in sorted(best, key=lambda b: (-b[1], b[0]))] and q not in dict(best)


def test_nearest_with_odd_and_equal_vectors(odd, monkeypatch):
    good, table = odd
    monkeypatch.setattr(ann, "SHARD", 30)
    small = [(i, v) for i, v in good if abs(v[0]) < 1e6]
    found = grouped(ann.nearest(table.where("vec_id < 201 OR vec_id > 202 OR vec_id IS NULL"), QUERY, 20))
    expected = brute(small, 20, lambda a, b: float(sum(x * y for x, y in zip(a, b, strict=False))))
    hits = sum(len({v for v, _ in expected[q]} & {v for v, _ in found[q]}) for q in expected)
    assert set(found) == set(expected) and hits >= 0.9 * 20 * len(expected)


@pytest.fixture(scope="module")
def repeated(spark):
    """Ids that several rows have, queries among them, and a third of all rows under one id."""
    rng = np.random.default_rng(12)
    rows = [(i % 45, rng.normal(size=4).round(2).tolist()) for i in range(60)] + [(40, [0.5, 0.5, 0.0, 0.1])] * 30
    rows += [(1, [0.5, 0.5, 0.0, 0.0]), (1, [0.9, 0.1, 0.0, 0.0])]
    return rows, spark.createDataFrame(rows, "vec_id long, embedding array<double>")


def by_row(rows, k, of):
    """Results of every query row, as a sorted list of lists of (vec_id, score)."""
    out = []
    for i, (q, a) in enumerate(rows):
        if q % 20 == 0:
            scored = sorted((-of(a, b), v) for j, (v, b) in enumerate(rows) if j != i)
            out += [(q, r + 1, v, -s) for r, (s, v) in enumerate(scored[:k])]
    return sorted(out)


@pytest.mark.parametrize("k", [3, 20, 200])
def test_rows_of_one_id_are_rows_of_their_own(repeated, k):
    rows, table = repeated
    found = topk.exact_top_k(table, QUERY, k)
    assert sorted(map(tuple, found.collect())) == by_row(rows, k, integers)
    near = ann.nearest(table, QUERY, k).collect()
    exact = by_row(rows, k, lambda a, b: float(np.dot(a, b)))
    assert len(near) == len(exact)
    assert sum(abs(a.score - b[3]) < 1e-9 for a, b in zip(sorted(near, key=lambda r: (r.query_id, r["rank"], r.vec_id)), exact, strict=True)) >= 0.9 * len(exact)


def test_repeated_ids_equal_sql(repeated, tmp_path):
    import compare

    rows, table = repeated
    table.write.parquet(str(tmp_path / "embeddings"))
    duck = compare.duck(str(tmp_path))
    duck.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{tmp_path}/embeddings/*.parquet'")
    assert compare.differences(topk.exact_top_k(table, QUERY, 20), duck, topk.ORACLE) == []


@pytest.mark.parametrize("sign", [-1, 1])
def test_large_and_odd_totals_stay_exact(spark, sign):
    """Negative scores beyond the exactness of doubles, odd ones among them."""
    rows = [(0, [1 / 64, 1 / 64])] + [(i, [sign * 1e14 / 64, sign * (1e14 + i) / 64]) for i in range(1, 32) if i % 20]
    rows += [(40, [-3 / 64, 0.0]), (60, [5 / 64, -5 / 64])]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    for k in (1, 20, 30):
        assert grouped(topk.exact_top_k(table, QUERY, k)) == brute(rows, k, integers)


def test_no_vectors_give_no_rows(odd):
    _, table = odd
    assert topk.exact_top_k(table.limit(0), QUERY, 3).count() == 0
    assert ann.nearest(table.limit(0), QUERY, 3).count() == 0


def test_top_k_sends_no_copies_of_queries_through_the_driver(spark, monkeypatch):
    """Blocks of 164 kB in all visit 40 shards: as a broadcast they would be 6.5 MB, from files far below Spark's threshold."""
    monkeypatch.setattr(topk, "SHARD", 16)
    monkeypatch.setattr(topk, "QUERIES", 128)
    rng = np.random.default_rng(7)
    whole = rng.integers(-64, 65, size=(640, 64))
    table = spark.createDataFrame([(i, (v / 64).tolist()) for i, v in enumerate(whole)], "vec_id long, embedding array<double>")
    scores = whole @ whole.T
    np.fill_diagonal(scores, -(1 << 40))
    expected = {q: [(int(v), int(scores[q, v])) for v in np.lexsort((np.arange(640), -scores[q]))[:5]] for q in range(0, 640, 2)}
    for name, value in {"spark.sql.autoBroadcastJoinThreshold": "10m", "spark.sql.maxBroadcastTableSize": "4m"}.items():
        spark.conf.set(name, value)
    try:
        assert grouped(topk.exact_top_k(table, "vec_id % 2 = 0", 5)) == expected
    finally:
        for name in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.maxBroadcastTableSize"):
            spark.conf.unset(name)


def test_packed_rows_reach_workers_few_at_once(spark):
    import pyarrow as pa

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_pydict({"n": [batch.num_rows]})

    setting = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(setting, None)
    seen = topk._stored(spark.range(0, 100, 1, 1).mapInArrow(sizes, "n long"), "sizes").collect()
    assert sum(r.n for r in seen) == 100 and max(r.n for r in seen) <= topk.ROWS_AT_ONCE
    assert spark.conf.get(setting, None) == before
