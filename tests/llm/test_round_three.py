"""Whitening, byte pairs and ranked search against brute force; pages, near copies and toxicity on odd input."""

from __future__ import annotations

import hashlib
import math
import random
import re
import time
import tracemalloc
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
import tiktoken
from pyspark.sql import functions as F

from telemetry_lake.llm import byte_pairs, near_copies, nearest, ranked_search, toxicity, vocabulary, whitening
from telemetry_lake.llm.main_text import main_text, train
from telemetry_lake.llm.pages import blocks
from telemetry_lake.llm.queries import ready

EVERY = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000]


# --- op11


@pytest.mark.parametrize("kind", ["full", "low rank", "equal values", "tiny", "one"])
def test_components_are_those_of_the_matrix(kind):
    random_numbers = np.random.default_rng(5)
    for size in (1, 2, 17, 64):
        a = random_numbers.standard_normal((size, size))
        if kind == "low rank":
            a[:, size // 3 :] = 0
        if kind == "equal values":
            a = np.diag(random_numbers.integers(0, 3, size).astype(float))
        if kind == "one":
            a[:, 1:] = 0
        matrix = a @ a.T * (1e-9 if kind == "tiny" else 1)
        values, vectors = whitening.components(matrix, 16)
        wanted = np.sort(np.linalg.eigvalsh(matrix))[::-1][:16]
        assert (wanted[len(values) :] < 1e-12 * max(wanted.max(), 1e-300) + 1e-300).all()
        assert np.abs(values - wanted[: len(values)]).max(initial=0) <= 1e-11 * max(wanted.max(), 1e-300)
        assert np.abs(vectors.T @ vectors - np.eye(len(values))).max(initial=0) < 1e-10
        assert np.abs(matrix @ vectors - vectors * values).max(initial=0) <= 1e-10 * max(wanted.max(), 1e-300)


def test_inertia_counts_eigenvalues():
    random_numbers = np.random.default_rng(6)
    a = random_numbers.standard_normal((20, 20))
    matrix = a + a.T
    values, (diagonal, lower) = np.linalg.eigvalsh(matrix), whitening.tridiagonal(matrix)
    for shift in np.linspace(-12, 12, 50):
        assert whitening.count_above(diagonal, lower, shift) == (values > shift).sum()


VECTORS = "vec_id bigint, embedding array<float>, x string, component int, vector int"


def whitened(df):
    return whitening.whiten(df, whitening.fit(df))


def test_whitening_against_numpy(spark):
    random_numbers = np.random.default_rng(8)
    points = (random_numbers.standard_normal((300, 24)) * np.linspace(0.1, 2, 24)).astype("f4")
    rows = [(i, p.tolist(), "a", 1, 1) for i, p in enumerate(points)]
    rows += [(0, points[0].tolist(), None, None, None)] * 200 + [(None, points[3].tolist(), "", 0, 0)]
    bad = [None, [], [None] * 24, [float("nan")] + [0.0] * 23, [float("inf")] * 24]
    rows += [(1000 + i, b, "b", 2, 2) for i, b in enumerate(bad)]
    got = whitened(spark.createDataFrame(rows, VECTORS)).toPandas()
    grid = np.floor(64 * points.astype(float)).astype("i8") + 1_000_000
    fit = np.unique(grid, axis=0)
    n, sums = len(fit), fit.sum(axis=0)
    values, axes = np.linalg.eigh(np.cov(fit.T.astype(float), bias=True))
    values, axes = values[::-1], axes[:, ::-1]
    assert len(got) == 501 * 16 and (got.n == n).all() and got.identity_error.max() < 1e-10
    assert np.allclose(got.groupby("component").explained.first(), values[:16] / values.sum(), rtol=1e-10)
    one = got[got.vec_id == 7].sort_values("component")
    assert one.deviation.iloc[0] == int(((n * grid[7] - sums) ** 2).sum())
    assert np.allclose(np.abs(one.whitened), np.abs((grid[7] - sums / n) @ axes[:, :16] / np.sqrt(values[:16])), atol=1e-8)
    assert (got[got.vec_id == 0].groupby("component").whitened.nunique() == 1).all() and got.vec_id.isna().sum() == 16


def test_whitening_of_little(spark):
    empty = spark.createDataFrame([], VECTORS)
    assert whitened(empty).count() == 0 and whitened(empty).columns == [c.split()[0] for c in whitening.OUTPUT.split(", ")]
    same = spark.createDataFrame([(i, [1.0, 2.0], "a", 1, 1) for i in range(5)], VECTORS)
    assert whitened(same).count() == 0
    line = spark.createDataFrame([(i, [float(i), 2.0 * i, 0.0], "a", 1, 1) for i in range(5)], VECTORS)
    assert sorted(r.component for r in whitened(line).collect()) == [1] * 5
    with pytest.raises(ValueError, match="vectors of 2 to 3"):
        whitening.fit(line.union(same))
    with pytest.raises(Exception, match="too large for the grid"):
        whitened(spark.createDataFrame([(1, [3e38], "a", 1, 1), (2, [1.0], "a", 1, 1)], VECTORS))


# --- op12


@pytest.fixture(scope="module")
def ranks():
    return byte_pairs.Ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


@pytest.fixture(scope="module")
def library(ranks):
    return tiktoken.Encoding("own", pat_str=ranks.pattern, mergeable_ranks=ranks.table, special_tokens={})


def test_ids_are_the_librarys(spark, ranks, library):
    draw = random.Random(11)
    texts = [None, "", " ", "\n\n  x", "a" * 5000, "é" * 300, "的" * 2000, "<|endoftext|> don't", "".join(map(chr, EVERY[::7]))]
    texts += ["".join(draw.choice("aA1 \n\t'sté的　\x85😀ͣ_-") for _ in range(draw.randint(1, 80))) for _ in range(400)]
    texts += ["".join(chr(draw.choice(EVERY)) for _ in range(40)) for _ in range(300)]
    texts += ["some words again " * 3000, "twice", "twice"]
    rows = [(i if i % 50 else None, t, [1], "w") for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, ids array<int>, words string")
    out = byte_pairs.encode(df, ranks, keep=["doc_id", "words"], bundle_words=2000, table_words=500)
    back = out.withColumn("back", byte_pairs.decode(F.col("ids"), ranks)).collect()
    wanted = Counter((i, tuple(library.encode_ordinary(t or ""))) for i, t, *_ in rows)
    assert Counter((r.doc_id, tuple(r.ids)) for r in back) == wanted and {r.words for r in back} == {"w"}
    assert Counter(bytes(r.back) for r in back) == Counter((t or "").encode() for t in texts)
    digests = {r.doc_id: r for r in byte_pairs.digests(df, ranks).collect()}
    ids = library.encode_ordinary(texts[7])
    assert digests[7].n_tokens == len(ids) and digests[7].ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
    assert digests[7].decoded_sha256 == hashlib.sha256(texts[7].encode()).hexdigest()
    assert byte_pairs.encode(df.limit(0), ranks).count() == 0
    packed = {r.doc_id: bytes(r.p) for r in out.select("doc_id", byte_pairs.little_endian(F.col("ids"), ranks).alias("p")).collect()}
    assert packed[7] == np.array(ids, "<u4").tobytes()


def test_the_cutter_knows_every_character(ranks):
    probe = tiktoken.Encoding("p", pat_str=ranks.pattern, mergeable_ranks={bytes([b]): b for b in range(256)}, special_tokens={})
    draw, split = random.Random(2), byte_pairs.splitter(ranks.pattern)
    for _ in range(300):
        text = "".join(chr(draw.choice(EVERY)) for _ in range(200))
        assert "".join(split(text)).encode() == bytes(probe.encode_ordinary(text))


def test_words_alone(spark, ranks, library):
    made = [None, "", "don", " unbelievably", "qqqqqqqq", "ÀÀÀÀ"]
    df = spark.createDataFrame([(w,) for w in made], "word string")
    got = {r.word: r.ids for r in byte_pairs.encode_words(df, ranks).collect()}
    assert got.pop(None) is None and got == {w: library.encode_ordinary(w) for w in made if w is not None}


# --- op13


def brute_ranking(docs, items, k):
    cut = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    terms = [Counter(cut.findall((t or "").translate(lower))) for _, t in docs]
    there = [(i, c) for (i, _), c in zip(docs, terms) if c]
    count, total = len(there), sum(sum(c.values()) for _, c in there)
    df = Counter(t for _, c in there for t in c)
    out = []
    for item, text in items:
        found = []
        for doc, c in there:
            n = sum(c.values())
            m = 50 + (50 * n * count) // total
            score = 0
            for t in set(cut.findall((text or "").translate(lower))):
                if t in c:
                    weight = math.floor(1000 * math.log((2 * count + 2) / (2 * df[t] + 1)))
                    score += weight * ((1000000000 * c[t]) // (1000 * c[t] + 20 * m))
            if score > 0:
                found.append((-score, doc is not None, doc or 0))
        for rank, (score, known, doc) in enumerate(sorted(found)[:k], 1):
            out.append((item, rank, doc if known else None, -score))
    return Counter(out)


@pytest.mark.parametrize("k, owners, block, group", [(5, 4, 4096, 512), (3, 2, 7, 2), (50, 5, 20, 1)])
def test_ranking_against_all_pairs(spark, k, owners, block, group):
    draw = random.Random(4)
    words = ["the", "AND", "Ünder", "x1", "日本", *(f"w{i}" for i in range(40))]

    def text(longest):
        return " ".join(words[min(int(draw.expovariate(0.25)), len(words) - 1)] for _ in range(draw.randint(0, longest)))

    docs = [(i, text(40)) for i in range(150)] + [(3, "the x1"), (None, "the w7 x1"), (None, None), (900, ""), (901, "!?-")]
    docs += [(500 + i, "w9 w9 copy") for i in range(80)] + [(700, "long " * 20000 + "w3")]
    items = [(1, text(12)), (2, "the the x1"), (2, "copy w9"), (None, "w3 long"), (5, None), (6, "nowhere"), (7, "日本 ünder Ünder")]
    clash = "item_id string, score int, terms string, term string"
    d = spark.createDataFrame([(*r, "a", 1, "b", "c") for r in docs], f"doc_id bigint, text string, {clash}").repartition(5)
    i = spark.createDataFrame([(*r, 7, 8) for r in items], "item_id bigint, text string, doc_id int, rank int")
    got = ranked_search.rank(d, i, k, owners, block, group)
    assert Counter(tuple(r) for r in got.collect()) == brute_ranking(docs, items, k)


def test_ranking_of_nothing(spark):
    docs = spark.createDataFrame([(1, "a b")], "doc_id bigint, text string")
    items = spark.createDataFrame([(1, "a")], "item_id bigint, text string")
    for d, i in ((docs.limit(0), items), (docs, items.limit(0)), (docs.withColumn("text", F.lit(None).cast("string")), items)):
        assert ranked_search.rank(d, i).count() == 0


# --- pages


PAGE = """<!DOCTYPE html><html><head><title>T</title><script>if (a<b) {}</script></head><body class=x><nav>menu</nav>
<article><p>First line &amp; more.</p><ul><li>one</li><li>two</li></ul><p>Last.</p></article></body></html>"""


@pytest.mark.parametrize("ends", ["head", "p", "li", "body", "html", "nav"])
def test_end_tags_that_may_be_left_out(ends):
    texts = [b.text for b in blocks(PAGE)]
    assert texts == ["menu", "First line & more.", "one", "two", "Last."]
    assert [b.text for b in blocks(PAGE.replace(f"</{ends}>", ""))] == texts


def test_stray_quotes_drawings_and_formulas():
    assert [b.text for b in blocks("<p don't>first</p><p>second it's fine</p>")] == ["first", "second it's fine"]
    assert [b.text for b in blocks("<svg><title>t</title><p>shown</p>")] == ["shown"]
    assert " ".join(b.text for b in blocks("<p>a <math><mi>x</mi></math> b")) == "a x b"
    assert [b.text for b in blocks('<p title="a > b">c<p title=\'x>y\' class="q>">d')] == ["c", "d"]
    assert [b.names for b in blocks("<p class=\"a\"id='nav'>x")] == [("a", "nav")]
    assert blocks("<head><title>t</title>") == [] and [b.text for b in blocks("<head><title>t</title>hello")] == ["hello"]


@pytest.mark.parametrize("part", ["<div>x", "<a ", "<a href='", "<p>x<b>", "<!--", "<li>x", "<script>", "</p>", "<a b=\"c", "&amp;"])
def test_time_grows_with_the_page(part):
    started = time.process_time()
    blocks(part * (1_000_000 // len(part)) + '"')
    assert time.process_time() - started < 20


def test_training_on_long_pages_alone(spark):
    long = PAGE.replace("<p>First", "<p>" + "word " * 30000 + "</p><p>First")
    pages = spark.createDataFrame([(1, "u", long), (2, "u", None)], "page_id bigint, url string, html string")
    assert "First line & more." in main_text(long, train(pages, sample=5, layouts=200))


# --- near copies and toxicity


def test_near_copies_with_clashing_names_and_one_id(spark):
    draw = random.Random(1)
    texts = [" ".join(draw.choice("abcdefgh") * 3 + str(draw.randrange(99)) for _ in range(30)) for _ in range(20)]
    rows = [(None, texts[i % 20], "a", "b", "c", i) for i in range(2000)] + [(1, texts[0], "a", "b", "c", 0), (2, "own words here", "", "", "", 0)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, _id string, _key string, _keys string, id int")
    kept = near_copies.without_copies(spark, docs)
    assert kept.columns == docs.columns
    assert Counter(r.text for r in kept.collect()) == Counter({t: 1 for t in [*texts, "own words here"]})


def test_keys_are_made_again_of_repeated_ids_only(spark):
    def plan(ids):
        rows = [(i, f"words of text {n} alone") for n, i in enumerate(ids)]
        kept = near_copies.without_copies(spark, spark.createDataFrame(rows, "doc_id bigint, text string"))
        assert sorted(r.text for r in kept.collect()) == sorted(t for _, t in rows)
        return kept._jdf.queryExecution().optimizedPlan().toString()

    # Single ids: no text is read by Python again, and the table is joined (and shuffled) once.
    single = plan(range(20))
    assert "EvalPython" not in single and single.count("Join") == 1
    # A repeated id: texts reach Python through the join with the repeated ids.
    before, after = plan([*range(20), 7]).split("ArrowEvalPython")
    assert "Join LeftSemi" in before and "Join LeftSemi" in after


def test_swaps_act_on_texts_without_terms(spark):
    draw = random.Random(3)
    # Toxic texts hold words that begin like an identity term: without the penalty the term inherits their weight.
    plain = [" ".join(draw.choice(["tree", "stone", "river", "cloud", "field"]) for _ in range(8)) for _ in range(300)]
    rows = [(i, t + (" muslings" if i % 3 == 0 else ""), i % 3 == 0) for i, t in enumerate(plain)]
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, int(bad)) for i, _, bad in rows], "doc_id bigint, toxic int")

    def change(how):
        model = toxicity.train(docs, labels, how)
        scores = [[model.score(f"{t} {term}") for term in ("muslim", "hindu")] for t in plain[:60]]
        return max(abs(a - b) for a, b in scores), model

    (with_swaps, model), (without, _) = change(toxicity.Training()), change(toxicity.Training(swap_weight=0.0))
    assert with_swaps < 0.1 < without
    assert model.score("river muslings") > 0.5 > model.score("river stone")
    assert toxicity.swap_pairs({"a"}, (), 2, 5) == []


def test_training_rows_of_one_id_are_bounded(spark):
    docs = spark.range(3000).selectExpr("1L AS doc_id", "concat('word', id) AS text").union(spark.range(2, 40).selectExpr("id", "'calm'"))
    labels = spark.range(40).selectExpr("id AS doc_id", "cast(id % 2 AS int) AS toxic")
    model = toxicity.train(docs.union(docs), labels, toxicity.Training(sample=40, rounds=5))
    assert 0 <= model.score("calm") <= 1


def test_merges_copy_no_state(spark, capsys):
    # A value named by transform(array(value), ...) is copied whole at every merge.
    ranks = byte_pairs.Ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    words = [" aiouantion", "aaaaaaaaaaa", "", None, " ciónadoqueta", "\u0000\u00ff", " hello", "ab" * 100]
    df = byte_pairs.encode_words(spark.createDataFrame([(w,) for w in words], "word string"), ranks)
    library = tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks.table, special_tokens={}
    )
    got = {r["word"]: r["ids"] for r in df.collect()}
    assert got == {w: None if w is None else library._encode_single_piece(w) if w else [] for w in words}
    df.explain(True)
    plan = re.sub(r"\s", "", capsys.readouterr().out)
    assert "aggregate(" in plan and "transform(array(" not in plan


def test_training_takes_little_of_the_driver(spark):
    draw = random.Random(4)
    common = [f"{a}{b}word{i}" for i, (a, b) in enumerate((a, b) for a in "bcdfghjklm" for b in "nopqrstuvwxyz" * 10)]
    texts = [(i, " ".join(draw.sample(common, 100)) + " muslim" * (i % 7 == 0)) for i in range(3000)]
    docs = spark.createDataFrame(texts, "doc_id bigint, text string")
    labels = spark.range(3000).selectExpr("id AS doc_id", "cast(id % 3 = 0 AS int) AS toxic")
    how = toxicity.Training(least_association=0.0, rounds=2)
    tracemalloc.start()
    try:
        toxicity.train(docs, labels, how)
        assert tracemalloc.get_traced_memory()[1] < 40e6
    finally:
        tracemalloc.stop()


def test_pairs_keep_the_features_that_differ():
    draw = random.Random(5)
    terms = [t for g in toxicity.IDENTITY_TERMS for t in g] + ["womenfolk", "mens", "blackbird", "whit", "frau"]
    for turn in range(300):
        found = set(draw.sample(terms, draw.randrange(1, 9)))
        for one, other in toxicity.swap_pairs(found, toxicity.IDENTITY_TERMS, 2, turn):
            a, b = toxicity.text_features(one), toxicity.text_features(other)
            shared = toxicity.text_features(one & other)
            assert toxicity.lone_features(one, other, shared) == a - b
            assert toxicity.lone_features(other, one, shared) == b - a


# --- nearest neighbours


@pytest.mark.parametrize("norms", ["one", "three", "ten", "lognormal 0.3", "lognormal 1", "tiny"])
def test_neighbours_of_vectors_of_any_norm(spark, norms):
    random_numbers = np.random.default_rng(12)
    points = random_numbers.standard_normal((1500, 64))
    points /= np.linalg.norm(points, axis=1)[:, None]
    kind, _, sigma = norms.partition(" ")
    size = {"one": 1, "three": 3, "ten": 10, "tiny": 1e-12}.get(kind, None)
    points *= size if size else np.exp(float(sigma) * random_numbers.standard_normal(1500))[:, None]
    table = spark.createDataFrame([(i, p.tolist()) for i, p in enumerate(points)], "vec_id bigint, embedding array<double>")
    usable = nearest.usable(table, "vec_id", "embedding")
    got = nearest.nearest(usable, usable.filter("vec_id % 20 = 0"), 20, nearest.Index(dimension=64)).collect()
    scores = points @ points.T
    np.fill_diagonal(scores, -np.inf)
    hits = 0
    for query in range(0, 1500, 20):
        own = sorted((r.rank, r.vec_id, r.score) for r in got if r.query_id == query)
        assert [r for r, _, _ in own] == list(range(1, 21))
        assert np.allclose([x for _, _, x in own], scores[query][[v for _, v, _ in own]], rtol=1e-9, atol=0)
        hits += len({v for _, v, _ in own} & set(np.argsort(-scores[query])[:20].tolist()))
    assert hits / (75 * 20) >= 0.9


def unit_vectors(count, seed):
    points = np.random.default_rng(seed).standard_normal((count, 64)).astype(np.float32)
    return points / np.linalg.norm(points, axis=1)[:, None]


@pytest.mark.parametrize("sampled", [1, 1 << 20])
def test_neighbours_over_several_tasks(spark, sampled):
    points = unit_vectors(6000, 21)
    points[100:160] = points[80]  # more equal ones than are wanted
    rows = [(i, p.tolist()) for i, p in enumerate(points)] + [(7, points[20].tolist()), (40, points[40].tolist())]
    usable = nearest.usable(spark.createDataFrame(rows, "vec_id bigint, embedding array<float>"), "vec_id", "embedding")
    asked = usable.filter("vec_id % 40 = 0")
    got = nearest.nearest(usable, asked, 20, nearest.Index(64, hashes=6), rows=1500, sampled=sampled).collect()
    exact = points.astype(float)
    hits = 0
    for query in range(0, 6000, 40):
        scores = exact @ exact[query]
        scores[7] = max(scores[7], exact[20] @ exact[query])
        scores[query] = -np.inf
        own = sorted((r.rank, r.vec_id, r.score) for r in got if r.query_id == query)
        assert [r for r, _, _ in own] == list(range(1, 21))
        assert np.allclose([x for _, _, x in own], scores[[v for _, v, _ in own]], rtol=1e-9, atol=0)
        hits += len({v for _, v, _ in own} & set(np.lexsort((np.arange(6000), -scores))[:20].tolist()))
        if query == 80:
            assert [v for _, v, _ in own] == list(range(100, 120))
    assert hits / (150 * 20) >= 0.9


def test_queries_that_met_few_rows_are_held_against_all(spark):
    points = unit_vectors(3000, 22)
    table = spark.createDataFrame([(i, p.tolist()) for i, p in enumerate(points)], "vec_id bigint, embedding array<float>")
    usable = nearest.usable(table, "vec_id", "embedding")
    got = nearest.nearest(usable, usable.filter("vec_id < 30"), 20, nearest.Index(64, hashes=8, mass=0.01), rows=1000).collect()
    scores = points.astype(float) @ points[:30].astype(float).T
    for query in range(30):
        scores[query, query] = -np.inf
        own = [v for _, v in sorted((r.rank, r.vec_id) for r in got if r.query_id == query)]
        assert own == np.argsort(-scores[:, query], kind="stable")[:20].tolist()


def test_share_of_rows_that_a_query_meets_falls():
    def share(count, rows):
        index = nearest.Index(64)
        lines = round(math.log2(rows / index.bucket))
        of = np.split(index.lines(lines * index.tables), index.tables, axis=1)
        return nearest.Band(index, 0, 1.0, of, [np.zeros(lines)] * index.tables, index.near(count, 20), 1.0).share()

    assert share(50_000, 50_000) > 0.4  # one bucket then, and all neighbours
    assert share(15_000_000, 786_432) < 0.2 < share(2_000_000, 200_000) < 0.4


def test_vectors_are_judged_without_lambdas(spark):
    rows = [(1, [1.0, 2.0]), (2, [0.0, 0.0]), (3, [float("nan"), 1.0]), (4, [1.0, None]), (5, None), (6, []), (None, [1.0, 1.0])]
    rows += [(7, [float("inf"), 1.0]), (8, [float("-inf"), 1.0]), (9, [-1.0, 0.0]), (10, [None, None])]
    for kind in ("float", "double"):
        usable = nearest.usable(spark.createDataFrame(rows, f"vec_id int, embedding array<{kind}>"), "vec_id", "embedding")
        assert sorted(r.vec_id for r in usable.collect()) == [1, 9]
        # A lambda over the components took 250 us a vector and 32-bit numbers doubled what is shuffled.
        assert "lambda" not in usable._jdf.queryExecution().toString() and usable.dtypes[1][1] == f"array<{kind}>"


def test_a_worker_holds_one_vocabulary():
    one, other = (public_tokenizers.path(name) for name in ("word_bpe_49k.json", "byte_bpe_50k.json"))
    vocabulary.vocabulary(one).encode("some words")
    vocabulary.vocabulary(other).encode("some words")
    assert list(vocabulary._LOADED) == [other]
    vocabulary.release()
    assert not vocabulary._LOADED


def test_batches_of_large_rows_are_small(spark):
    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_pydict({"n": [batch.num_rows]}, pa.schema([("n", pa.int64())]))

    rows = ready(spark).range(40, numPartitions=1).select(F.expr("repeat(cast(id % 10 as string), 1 << 20)").alias("text"))
    found = [r["n"] for r in rows.mapInArrow(sizes, "n bigint").collect()]
    assert sum(found) == 40 and max(found) <= 10


def test_merges_run_no_function_over_all_parts(spark, capsys):
    # A merge that went through all ranks by lambdas took most of a word's time.
    ranks = byte_pairs.Ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    byte_pairs.encode_words(spark.createDataFrame([("word",)], "word string"), ranks).explain(True)
    plan = re.sub(r"\s", "", capsys.readouterr().out)
    assert "slice(" in plan and "filter(" not in plan


def test_a_table_of_words_takes_little_to_look_up():
    words = pa.array([f" word{i}" for i in range(300_000)])
    table = pa.table({"word": words, "ids": pa.array([[1]] * len(words), pa.list_(pa.int32()))})
    tracemalloc.start()
    lookup = byte_pairs.Lookup(table)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 14e6
    place, found = lookup(pa.array([" word7", "none"]))
    assert place[0] == 7 and found.tolist() == [True, False]


def test_bundles_give_texts_back(spark, ranks, library):
    draw = random.Random(4)
    texts = [" ".join(draw.choice(["don't", "aiouantion", "x" * 300, "é", "1999"]) for _ in range(draw.randint(0, 9))) for _ in range(60)]
    df = spark.createDataFrame([(i, 1, t) for i, t in enumerate(texts)], "c1 bigint, c0 int, text string")
    out = byte_pairs.encode(df, ranks, keep=["c1", "c0"], forms=["decoded", "ids", "packed"], bundle_words=7, table_words=3)
    assert out.columns == ["c1", "c0", "decoded", "ids", "packed"]
    for r in out.collect():
        ids = library.encode_ordinary(texts[r.c1])
        assert (r.ids, bytes(r.packed), bytes(r.decoded)) == (ids, np.array(ids, "<u4").tobytes(), texts[r.c1].encode())


def test_a_table_in_order_is_looked_up_as_it_was_sent(spark, ranks, library):
    words = [f" w{i}" for i in range(20_000)]
    bundles = spark.createDataFrame([(words, [2] * len(words))], "words array<string>, counts array<bigint>")
    table = byte_pairs.frequent_words(bundles, ranks).toArrow()
    table = table.set_column(0, "word", table["word"].cast(pa.string())).combine_chunks()
    tracemalloc.start()
    held = pa.total_allocated_bytes()
    lookup = byte_pairs.Lookup(table)
    peak = tracemalloc.get_traced_memory()[1] + pa.total_allocated_bytes() - held
    tracemalloc.stop()
    assert peak < 50_000
    place, found = lookup(pa.array([*words, "none"]))
    assert found.tolist() == [True] * len(words) + [False]
    assert lookup.ids.take(pa.array(place[:99])).to_pylist() == [library.encode_ordinary(w) for w in words[:99]]


@pytest.mark.parametrize("portion", [1, 5, 1 << 17])
def test_portions_of_a_bundle_are_its_texts(spark, ranks, library, monkeypatch, portion):
    monkeypatch.setattr(byte_pairs, "PORTION_WORDS", portion)
    texts = ["", "a b c", "x" * 300 + " d", None, "one two three four five six seven", "é", "", "y" * 400 + " a b"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").coalesce(1)
    got = {r.doc_id: (r.ids, bytes(r.decoded)) for r in byte_pairs.encode(df, ranks, forms=["ids", "decoded"]).collect()}
    assert got == {i: (library.encode_ordinary(t or ""), (t or "").encode()) for i, t in enumerate(texts)}


def test_a_row_group_holds_one_bundle(spark, ranks, monkeypatch, tmp_path):
    monkeypatch.setattr(byte_pairs, "scratch_path", lambda _, label: str(tmp_path / label))
    docs = spark.createDataFrame([(i, "some words here") for i in range(9)], "doc_id bigint, text string").coalesce(1)
    assert byte_pairs.encode(docs, ranks, bundle_words=9).count() == 9
    files = [pq.ParquetFile(f).metadata for f in (tmp_path / "bundles").glob("*.parquet")]
    assert sum(f.num_rows for f in files) == sum(f.num_row_groups for f in files) == 3
