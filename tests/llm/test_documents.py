"""Document operators against plain loops, on rows with every kind of oddity."""

from __future__ import annotations

import random
from collections import Counter

import edge
import numpy as np
import pytest
from pyspark.sql import functions as F

from wardline.llm.exchange import stored
from wardline.llm import bpe, exchange, jaccard, langid, mixing, pages, quality, substring, suffixes

CLASHING = ["row", "bucket", "score", "tokens", "kept", "node", "starts", "size"]


@pytest.fixture(scope="module")
def docs(spark):
    return edge.documents(spark)


@pytest.fixture(scope="module")
def nothing(spark):
    return edge.documents(spark, [])


def bag(rows) -> list[str]:
    return sorted(repr(tuple(r)) for r in rows)


@pytest.mark.parametrize("window", [35, 8, 3])
def test_substring_removal_equals_loops(docs, window):
    found = substring.remove_repeats(docs, window)
    assert set(CLASHING) < set(found.columns)
    given = edge.rows()
    expected = [
        (r[0], n, gone, kept if r[1] is not None else None)
        for r, (n, gone, kept) in zip(given, edge.without_repeats([r[1] for r in given], window), strict=True)
    ]
    assert bag(found.select("doc_id", "n_words", "n_removed", "text").collect()) == bag(expected)


@pytest.mark.parametrize("length", [400, 120, 40])
def test_byte_removal_equals_loops(docs, length):
    found = suffixes.remove_repeated_bytes(docs, length)
    given = edge.rows()
    expected = [
        (r[0], n, gone, spans, edge.sha(kept))
        for r, (n, gone, spans, kept) in zip(given, edge.without_bytes([r[1] for r in given], length), strict=True)
    ]
    got = found.withColumn("kept", F.sha2("kept", 256))
    assert bag(got.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept").collect()) == bag(expected)


def test_documents_that_share_a_passage_do_not_meet_in_one_group(spark, monkeypatch):
    """Each goes on from it in its own way, the first bytes of which others have too."""
    monkeypatch.setattr(suffixes, "CROWD", 20)
    rng = random.Random(11)
    letters = lambda n, of: "".join(rng.choice(of) for _ in range(n))
    passage = letters(470, "abcdefgh ")
    texts = [letters(200, "xyz") + passage + letters(200, "xyz") for _ in range(300)] + [letters(900, "abc") for _ in range(20)]
    texts += texts[:2]
    table = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    expected = [(i, gone, edge.sha(kept)) for i, (_, gone, _, kept) in enumerate(edge.without_bytes(texts, 400))]
    found = suffixes.remove_repeated_bytes(table, 400).select("doc_id", "n_removed", F.sha2("kept", 256))
    assert bag(found.collect()) == bag(expected)
    frames: list = []
    monkeypatch.setattr(suffixes, "per_bucket", lambda df, f, schema: frames.append(df) or exchange.per_bucket(df, f, schema))
    named = suffixes.keyed(table)
    suffixes.repeated_spans(named, suffixes.copies_of(named), 400)
    met = next(df for df in frames if "numbers" in df.columns)
    grams = [np.frombuffer(r.numbers, dtype=suffixes._NUMBERS)["gram"] for r in met.where("numbers IS NOT NULL").collect()]
    assert np.unique(np.concatenate(grams), return_counts=True)[1].max() <= 20 + 2 * 16


@pytest.mark.parametrize("bits", [1, 3, 64])
def test_suffix_sort_survives_colliding_hashes(monkeypatch, bits):
    """With hashes of few bits almost everything collides; then bytes decide."""

    class Weak(suffixes.PrefixHash):
        def of(self, start, length):
            return super().of(start, length) >> np.uint64(64 - bits) if bits < 64 else super().of(start, length)

    monkeypatch.setattr(suffixes, "PrefixHash", Weak)
    rng = random.Random(3)
    texts = [bytes(rng.choice(b"ab") for _ in range(24)) for _ in range(60)]
    texts += [b"x" * 8 + t[8:] for t in texts[:5]] + texts[5:9]
    data = np.frombuffer(b"".join(texts), dtype=np.uint8)
    numbers = np.zeros(len(texts), dtype=suffixes._NUMBERS)
    numbers["row"], numbers["left"], numbers["right"], numbers["asks"] = range(len(texts)), 8, 16, 1
    rows, starts, ends = suffixes._repeated(numbers, data, 16)
    got = {(int(r), int(s) + back) for r, s, e in zip(rows, starts, ends, strict=True) for back in range(e - s - 15)}
    windows = [(i, k, t[8 - k : 24 - k]) for i, t in enumerate(texts) for k in range(9)]
    seen = Counter((k, w) for _, k, w in windows)
    assert got == {(i, -k) for i, k, w in windows if seen[k, w] > 1}


def test_similar_sets_equal_loops(docs):
    given = edge.rows()
    sets = [edge.shingles(r[1]) for r in given]
    low = edge.components([(r[0], s) for r, s in zip(given, sets, strict=True)])
    expected = [(r[0], len(s), c if s else r[0]) for r, s, c in zip(given, sets, low, strict=True)]
    assert bag(jaccard.similar_sets(docs).select("doc_id", "n_shingles", "component_id").collect()) == bag(expected)


def test_similar_sets_across_blocks(spark):
    """A family far larger than a block, in chains that only meet across blocks."""
    rng = random.Random(8)
    base = [f"w{i}" for i in range(60)]
    rows = []
    for i in range(120):
        w = [*base]
        for _ in range(i % 7):
            w[rng.randrange(60)] = f"n{rng.randrange(40)}"
        rows.append((i, " ".join(w)))
    table = spark.createDataFrame(rows, "doc_id long, text string")
    named = jaccard.shingle_sets(table)
    bits = 4
    found = jaccard.candidates(jaccard.shared_shingles(table, jaccard.heavy_shingles(table, 100), bits))
    roots = jaccard.linked_components(found.dropDuplicates(["node"]), block=16, pivots=2)
    node = {r.doc_id: r.node for r in named.collect()}
    root = {r.node: r.root for r in roots.collect()}
    mine = [root.get(node[i], node[i]) for i, _ in rows]
    theirs = edge.components([(i, edge.shingles(t)) for i, t in rows])
    pairs = set(zip(mine, theirs, strict=True))
    assert len(pairs) == len(set(mine)) == len(set(theirs))


def chained(spark, n: int):
    """Sets of which each shares two thirds with the next, every tenth a near copy of the one before."""
    rows, words = [], [f"w{i}" for i in range(4 * n + 100)]
    for i in range(n):
        at = 4 * (i - 1) if i % 10 == 9 else 4 * i
        own = [*words[at : at + 24]]
        if i % 10 == 9:
            own[-1] = f"n{i}"
        rows.append((i, " ".join(own)))
    return rows, spark.createDataFrame(rows, "doc_id long, text string").repartition(4)


@pytest.mark.parametrize("block", [8, 32])
def test_chains_of_families_meet_by_single_shingles(spark, monkeypatch, block):
    """Rows that are compared grow with the sets, not with their square."""
    counted, real = [], jaccard.meetings
    monkeypatch.setattr(jaccard, "meetings", lambda sets, size: counted.append(real(sets, size)) or counted[-1])
    for n in (1000, 4000) if block == 32 else (1000,):
        rows, table = chained(spark, n)
        found = jaccard.candidates(jaccard.shared_shingles(table, jaccard.heavy_shingles(table, 20 * n), 8))
        roots = jaccard.linked_components(stored(found.dropDuplicates(["node"]), "found"), block=block)
        node = {r.doc_id: r.node for r in jaccard.shingle_sets(table).collect()}
        root = {r.node: r.root for r in roots.collect()}
        for i in range(n):
            same = root.get(node[i], node[i]) == root.get(node[i - 1], node[i - 1]) if i else False
            assert same == (i % 10 == 9), i
    if block == 32:
        few, many = (c.count() for c in counted)
        assert many <= 5.5 * few


def test_one_of_each_group_stays(docs):
    kept = jaccard.keep_one(docs)
    assert kept.columns == docs.columns
    given = edge.rows()
    low = edge.components([(r[0], edge.shingles(r[1])) for r in given])
    expected = {r for r, c in zip(given, low, strict=True) if r[0] == c or not edge.shingles(r[1])}
    assert bag(kept.collect()) == bag(expected)


def test_tokens_equal_the_library(docs):
    tokenizers = pytest.importorskip("tokenizers")
    path = bpe.byte_bpe_path()
    library = tokenizers.Tokenizer.from_file(path)
    encoded = bpe.encode(docs, path)
    assert set(CLASHING) < set(encoded.columns)
    given = {(r[0], r[1] or "") for r in edge.rows()}
    for row in bpe.round_trip(docs, path).collect():
        ids = np.frombuffer(row.ids, dtype="<u4").tolist()
        assert (row.doc_id, row.decoded) in given and row.n_tokens == len(ids)
        assert ids == library.encode(row.decoded, add_special_tokens=False).ids
    assert bag(bpe.decode(encoded, path).select("doc_id", "text").collect()) == bag((r[0], r[1] or "") for r in edge.rows())


def test_encoding_is_linear_and_equals_merging():
    with open(bpe.byte_bpe_path(), encoding="utf-8") as file:
        vocabulary = bpe.Vocabulary(file.read())
    rng = random.Random(1)
    for _ in range(300):
        piece = "".join(rng.choice("aetionshrd é") for _ in range(rng.randint(1, 30))).encode()
        assert vocabulary.encode_piece(piece) == vocabulary.merged(piece)
    assert sum(len(vocabulary.tokens[t]) for t in vocabulary.encode_piece(b"ab" * 100_000)) == 200_000


def test_languages_are_told_and_unknown_is_said(spark, data):
    table = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    held = langid.held_out(F.col("doc_id"))
    model = langid.train(table.where(~held))
    told = langid.identify(table.where(held), model)
    right = told.where("lang = lang_pred").count() / told.count()
    assert right > 0.98
    found = {(r.doc_id, r.text): r for r in langid.identify(edge.documents(spark), model).collect()}
    assert {found[k].lang_pred for k in found if not any(c.isalpha() for c in k[1] or "")} == {"und"}
    assert all(0 <= r.score <= 1 for r in found.values()) and found[22, "de la que el"].lang_pred in model.languages


def test_codewords_lie_apart():
    for count in (2, 4, 6, 9, 20):
        codes = langid.codewords(count).astype(int)
        distance = (codes.shape[1] - codes @ codes.T) // 2
        np.fill_diagonal(distance, 99)
        assert distance.min() >= max(1, 2 ** (count - 2) if count < 5 else 3)


def test_a_wrong_bit_is_corrected():
    counts = np.zeros((4, langid.BUCKETS))
    texts = ["aaaa bbbb", "cccc dddd", "eeee ffff", "gggg hhhh"]
    for i, text in enumerate(texts):
        counts[i] = np.bincount(langid._grams([text] * 20)[0].ravel(), minlength=langid.BUCKETS)
    model = langid.Model.fit(list("wxyz"), counts)
    model.weights[:, 0] *= -1
    assert model.predict(texts)[0] == list("wxyz")


def test_quality_is_told_on_held_out_rows(spark):
    frame = quality.op4_quality(spark, "/root/testdata/sf0.01")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    rows = frame.where("held_out").join(labels, "doc_id").collect()
    good, bad = ([r.score for r in rows if r.quality == q] for q in (1, 0))
    assert np.mean([a > b for a in good for b in bad]) > 0.95
    assert all(0 <= r.score <= 1 for r in frame.collect())


def test_statistics_of_odd_texts_are_finite(docs):
    values = [r.statistics for r in quality.described(docs).collect()]
    assert len(values) == len(edge.rows()) and np.isfinite(np.array(values)).all()


def test_isotonic_never_falls():
    rng = np.random.default_rng(0)
    position, share = np.arange(50.0), rng.random(50)
    _, out = quality.isotonic(position, np.full(50, 10.0), np.round(share * 10))
    assert (np.diff(out) >= 0).all()


def test_mix_meets_targets_and_repeats(docs):
    rows = mixing.mix_sources(docs).collect()
    assert len(rows) == len(edge.rows())
    for source in {r.source for r in rows}:
        own = [r for r in rows if r.source == source]
        assert abs(sum(r.taken for r in own) - own[0].target) <= 0.5
        assert all(r.taken <= 3 * r.size for r in own) and own[0].target <= 3 * own[0].source_size + 1e-6
    assert bag(rows) == bag(mixing.mix_sources(docs).collect())
    places = [r.position for r in rows if r.position is not None]
    assert places == sorted(places) and 0 <= min(places) and max(places) <= 1


def test_training_order_repeats_whole_documents(docs):
    order = mixing.training_order(docs)
    assert order.columns == docs.columns
    passes = sum(r.passes for r in mixing.mix_sources(docs).collect())
    assert order.count() == passes


def test_rows_that_differ_in_other_columns_only(spark):
    """Sources are told apart; otherwise the same row stands for its equals in every run."""
    text = "w " * 10
    rows = [(1, text, s, x) for s in ("a", "b", None) for x in ("x", "y", "z")]
    table = spark.createDataFrame(rows, "doc_id long, text string, source string, other string")
    found = [bag(mixing.training_order(table.repartition(n)).collect()) for n in (1, 5)]
    assert found[0] == found[1] and {eval(r)[2] for r in found[0]} == {"a", "b", None}  # noqa: S307
    kept = [bag(jaccard.keep_one(table.repartition(n)).collect()) for n in (1, 5)]
    assert kept[0] == kept[1] and len(kept[0]) == 1


def test_schedule_of_several_pieces_is_inverted(spark):
    table = spark.createDataFrame([(i, "w " * 10, "s") for i in range(100)], "doc_id long, text string, source string")
    knots = "array<struct<t: double, w: double>>"
    plan = spark.createDataFrame([("s", [(0.0, 0.0), (0.5, 1.0), (1.0, 0.0)])], f"source string, knots {knots}")
    found = mixing.mix_sources(table, plan).orderBy("position").collect()
    # A triangle: half of the words by half of the time, an eighth by a quarter.
    assert abs(found[50].position - 0.5) < 1e-9 and abs(found[12].position - np.sqrt(0.12 / 2)) < 1e-9


def test_no_rows_give_no_rows(nothing):
    assert substring.remove_repeats(nothing).count() == 0
    assert suffixes.remove_repeated_bytes(nothing).count() == 0
    assert jaccard.similar_sets(nothing).count() == 0
    assert jaccard.keep_one(nothing).count() == 0
    assert bpe.round_trip(nothing, bpe.byte_bpe_path()).count() == 0
    assert langid.identify(nothing, langid.train(nothing)).count() == 0
    assert quality.score(quality.described(nothing), quality.train(quality.described(nothing).selectExpr("statistics", "1 AS label", "0 AS half"))).count() == 0
    assert mixing.mix_sources(nothing).count() == 0 and mixing.training_order(nothing).count() == 0


PAGE = """<html><head><title>No</title><style>p{}</style></head><body><!-- no --><nav><a href=/>Home</a></nav>
<div class="sidebar-left"><p>Aside, with text of some length that is not wanted at all.</p></div>
<article><header><h1>A &amp; B&nbsp;&eacute;</h1></header><p>First   <b>bold</b><br>line. &lt;kept&gt;
<p>Second<script>no()</script> part<p></p><ul><li>one<li>two</ul><form><label>Search</label></form>
<div class="comments"><p>Reader says.</p></div></article><footer>Foot</footer>"""


def test_pages_are_read_whole(spark):
    rows = [(1, "u", PAGE, "x"), (2, None, None, "x"), (3, "u", "", "x"), (4, "u", PAGE, "x"), (5, "u", "no tags", "x"),
            (6, "u", "<article><p>open <b>never <i>closed", "x"), (7, "u", "<article>" + "<div>" * 3000 + "deep, deep text.", "x")]
    table = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    model = pages.train(spark.read.parquet("/root/testdata/sf0.01/pages.parquet"))
    found = {r.page_id: r.text for r in pages.extract(table, model).collect()}
    assert found[1] == found[4] == "A & B é\nFirst bold line. <kept>\nSecond part\none\ntwo"
    assert found[2] == found[3] == "" and found[6] == "open never closed" and found[7] == "deep, deep text."
    assert pages.extract(table.limit(0), pages.train(table.limit(0))).count() == 0


def test_a_child_is_kept_in_kept_parents_only():
    page = pages.Page("<div><p>aaaa</p><div><p>bbbb</p></div></div>")
    rng = np.random.default_rng(2)
    for _ in range(50):
        kept = pages.choose(page, rng.normal(size=len(page.parent)))
        assert all(kept[page.parent[i]] for i in range(1, len(kept)) if kept[i])


@pytest.fixture(scope="module")
def page_trees(spark):
    return pages.train(spark.read.parquet("/root/testdata/sf0.01/pages.parquet"))


def main_text(model, source: str) -> str:
    page = pages.Page(source)
    return page.text(pages.choose(page, pages.scores(model, pages.features(page), np.array(page.by_words))))


PARAGRAPHS = [f"<p>This is paragraph {i}, with many words in it. It goes on, sentence by sentence, {'and on, and on. ' * 20}</p>" for i in range(8)]


@pytest.mark.parametrize("name", ["related-work", "social-history", "privacy", "tags", "respond", "no-sidebar", "comment-analysis", "ad-hoc", "modal-logic"])
def test_words_of_attributes_do_not_drop_article_text(page_trees, name):
    lost = f"<section class='{name}'>{''.join(PARAGRAPHS[4:])}</section>"
    around = "<html><body><nav><a href=/>Home</a></nav><div class='ad'>Buy this.</div><article><h1>Head</h1>{}{}</article><footer>Foot</footer>"
    text = main_text(page_trees, around.format("".join(PARAGRAPHS[:4]), lost))
    assert all(f"paragraph {i}" in text for i in range(8)) and "Home" not in text and "Buy" not in text
    header = "<div class='article-header'><h1>A headline of the usual length, with a comma.</h1></div>"
    assert "headline" in main_text(page_trees, around.format(header, "".join(PARAGRAPHS)))


@pytest.mark.parametrize("name", ["comments", "comment-list", "ad", "sidebar-left", "cookie-notice", "newsletter-signup", "comment-analysis"])
def test_words_of_attributes_drop_what_stands_aside(page_trees, name):
    box = f"<div class='{name}'>{'<p>Reader says this, and that. A nice one.</p>' * 3}</div>"
    page = "<html><body><nav><a href=/>Home</a></nav><article><h1>Head</h1>{}{}</article>{}<footer>Foot</footer>"
    kept = all_text(f"<h1>Head</h1>{''.join(PARAGRAPHS)}")
    assert main_text(page_trees, page.format("".join(PARAGRAPHS), "", box)) == kept
    if name != "comment-analysis":  # inside an article that may be part of it
        assert main_text(page_trees, page.format("".join(PARAGRAPHS), box, "")) == kept


def test_words_are_a_prior_that_scores_can_overrule():
    page = pages.Page(f"<article><h1>Head</h1><div class='comments'>{PARAGRAPHS[0]}</div>{PARAGRAPHS[1]}<nav>Home</nav></article>")
    text = page.text(pages.choose(page, np.full(len(page.parent), 5.0)))
    assert "paragraph 0" in text and "Home" not in text
    by = dict(zip(page.names, page.by_words, strict=True))
    assert by["div"] == 2 and by["nav"] == by["h1"] == 0
    assert pages.Page("<article>a</article><p class='comment-analysis'>b</p>").by_words[-1] == 2
    assert pages.Page("<article>a<p class='comment-analysis'>b</p></article>").by_words[-1] == 1


def all_text(source: str) -> str:
    page = pages.Page(source)
    return page.text(np.ones(len(page.parent), dtype=bool))


@pytest.mark.parametrize("name", ["svg", "math", "object", "canvas", "noscript", "iframe", "template", "textarea"])
def test_an_unclosed_element_does_not_swallow_the_page(name):
    text = all_text(f"<body><{name}><article><h1>Head</h1>{''.join(PARAGRAPHS)}</article>")
    assert all(f"paragraph {i}" in text for i in range(8))


def test_formulas_and_objects_are_text():
    formula = "<p>Before, <math><mi>x</mi><mo>=</mo><mn>42</mn><mspace/></math> after. <object data=a>Instead of it.</object> End.</p>"
    text = all_text(f"<article><h1>Head</h1>{''.join(PARAGRAPHS)}{formula}</article>")
    assert "Before, x=42 after. Instead of it. End." in text
    assert "no()" not in all_text(f"<article>{''.join(PARAGRAPHS)}<script>no()")


def test_copies_do_not_thin_out_the_taught_pages(spark):
    different = [f"<nav><a>{i}</a></nav><article><h1>{i}</h1>{''.join(PARAGRAPHS)}</article>" for i in range(3)]
    table = spark.range(60_000).select("id", F.element_at(F.array(*map(F.lit, different)), (F.col("id") % 3 + 1).cast("int")).alias("html"))
    assert len(pages.train(table).features) == pages.TREES
    assert not pages.train(table.limit(0)).features
