"""Registered queries: against SQL where it can say them, and the pipeline against plain loops."""

from __future__ import annotations

import html
import re

import compare
import edge
import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
import corpus_pipeline
from wardline.llm import bpe, langid, mixing
from wardline.llm.exchange import stored
from wardline.llm.queries import ORACLE, QUERIES

PYTHON = re.compile("Python|Pandas|Arrow")


def test_all_and_the_pipeline_are_registered():
    names = contract.queries()
    assert [sum(n.startswith(f"op{i}_") for n in names) for i in range(1, 14)] == [1] * 13
    assert names["pipeline"] is corpus_pipeline.run and set(ORACLE) <= set(contract.oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, data, name):
    assert compare.differences(QUERIES[name](spark, data), compare.duck(data), ORACLE[name]) == []


@pytest.mark.parametrize("name", ["op5_source_mix", "op13_quality_rules"])
def test_native_operators_run_no_python(spark, data, name):
    frame = QUERIES[name](spark, data)
    assert not PYTHON.search(frame._jdf.queryExecution().executedPlan().toString())


def written_truth(markup: str | None) -> str:
    """Main text of a given page by eye: what its article holds, a line for each heading and paragraph."""
    inside = re.search(r"<article>(.*)</article>", markup or "", re.S)
    blocks = re.split(r"</?(?:h1|p)>", inside[1]) if inside else []
    lines = [" ".join(html.unescape(re.sub(r"</?b>|<br>", "", b)).split()) for b in blocks]
    return "\n".join(x for x in lines if x)


def test_main_text_of_the_given_pages(spark):
    folder = "/root/testdata/sf0.01"
    markup = {r.page_id: r.html for r in spark.read.parquet(f"{folder}/pages.parquet").collect()}
    found = QUERIES["op6_main_text"](spark, folder).collect()
    assert len(found) == len(markup) == 250
    assert [r.page_id for r in found if r.text != written_truth(markup[r.page_id])] == []
    assert all(r.n_chars == len(r.text) for r in found)


def test_pipeline_stage_by_stage(spark, data):
    docs = spark.read.parquet(f"{data}/documents.parquet")
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        before = [tuple(r) for r in docs.collect()]
        docs = stored(stage(spark, docs, data), f"test-{name}")
        if name == "mixture":
            numbers = docs.select(F.input_file_name().alias("file"), "_metadata.row_index", "doc_id", "text").collect()
            ordered = [(r.doc_id, r.text) for r in sorted(numbers, key=lambda r: (r.file.rpartition("/")[2], r.row_index))]
        after = [tuple(r) for r in docs.collect()]
        if name != "tokens":
            assert docs.columns == columns
        if name == "language":
            assert set(after) <= set(before) and len(after) >= 0.98 * len(before)
        elif name == "near_duplicates":
            low = edge.components([(r[0], edge.shingles(r[1])) for r in before])
            assert sorted(after) == sorted(r for r, c in zip(before, low, strict=True) if r[0] == c)
        elif name == "repeats":
            cut = edge.without_repeats([r[1] for r in before], 35)
            expected = [
                (r[0], kept if gone else r[1], *r[2:4], len(kept) if gone else r[4])
                for r, (_, gone, kept) in zip(before, cut, strict=True)
            ]
            assert sorted(after) == sorted(expected)
        elif name == "mixture":
            passes = {r.doc_id: r.passes for r in mixing.mix_sources(spark.createDataFrame(before, docs.schema)).collect()}
            assert sorted(after) == sorted(r for r in before for _ in range(passes[r[0]]))
        else:
            text = {r[0]: r[1] for r in before}
            library = pytest.importorskip("tokenizers").Tokenizer.from_file(bpe.byte_bpe_path())
            assert len(after) == len(before)
            placed = sorted(docs.collect(), key=lambda r: r.position)
            assert [r.doc_id for r in placed] == [doc for doc, _ in ordered]
            assert len({r.position for r in placed}) == len(placed)
            for row in docs.collect():
                assert np.frombuffer(row.ids, "<u4").tolist() == library.encode(text[row.doc_id], add_special_tokens=False).ids
                assert row.decoded_sha256 == edge.sha(text[row.doc_id].encode())


def test_pipeline_runs_as_a_whole(spark, data):
    assert corpus_pipeline.run(spark, data).count() > 0


def test_rejected_documents_go(spark):
    model = langid.Model.fit(["en"], np.ones((1, langid.BUCKETS)))
    kept = langid.keep_identified(edge.documents(spark), model)
    assert kept.columns == edge.documents(spark).columns
    assert {r.doc_id for r in kept.collect()} & {0, 1, 2, 19} == set()


@pytest.mark.parametrize("count", [None, 0])
def test_stages_take_odd_rows_and_none(spark, count):
    rows = edge.documents(spark, [] if count == 0 else None).select("doc_id", "text", "lang", "source", "n_chars")
    docs = stored(rows, "odd")
    for name, stage in corpus_pipeline.STAGES:
        docs = stored(stage(spark, docs, "unused"), f"odd-{name}")
        assert docs.columns == rows.columns or name == "tokens"
        assert (docs.count() == 0) == (count == 0)
