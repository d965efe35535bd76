"""Operators against brute force on small tables with nulls, empty and long texts, ties, copies and odd columns."""

from __future__ import annotations

import itertools
import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import xxhash

from telemetry_lake.llm import (
    decontamination,
    main_text,
    near_copies,
    nearest,
    packing,
    shards,
    token_counts,
    token_files,
    toxicity,
    url_filter,
)
from telemetry_lake.llm.pages import blocks
from telemetry_lake.llm.vocabulary import Vocabulary

DOCS = "doc_id bigint, text string, lang string, shard string, rank int"


def words_of(seed: int, count: int) -> list[str]:
    draw = random.Random(seed)
    return ["".join(draw.choice("abcdeghilmnoprstu") for _ in range(draw.randint(2, 7))) for _ in range(count)]


@pytest.fixture(scope="module")
def texts():
    base = words_of(1, 60)
    near = list(base)
    near[30] = "changed"
    return [
        (1, " ".join(base), "en", "x", 1),
        (2, " ".join(near), "en", "x", 1),
        (3, " ".join(base), "en", None, None),
        (4, None, None, None, None),
        (5, "", "en", "x", 1),
        (6, "Tab\there  and <|endoftext|> 日本 don't  x\n\n y ", "en", "x", 1),
        (7, " ".join(words_of(2, 9000)), "en", "x", 1),
        (8, "two words", "en", "x", 1),
        (8, "two words", "en", "x", 1),
        (None, " ".join(words_of(3, 40)), "en", "x", 1),
    ]


@pytest.fixture(scope="module")
def docs(spark, texts):
    return spark.createDataFrame(texts, DOCS)


@pytest.fixture(scope="module")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_cached_ids_are_the_librarys(name, texts):
    encoder = Vocabulary(public_tokenizers.path(name), limit=50)
    odd = ["a  b", " a", "a ", "a\n b", "a\nb", "x\tb", "I'm 12,34!! ÀÉ", "'s 's", "a b", "²½", "\n", "é", "ﬁ"]
    for text in [t or "" for _, t, *_ in texts] + odd:
        whole = encoder.tokenizer.encode(text, add_special_tokens=False).ids
        assert encoder.encode(text).tolist() == whole, text[:40]


def test_packing(spark, docs, no_docs, texts):
    path = public_tokenizers.path("word_bpe_49k.json")
    rows = packing.pack_documents(spark, docs, path).collect()
    encoder = Vocabulary(path).tokenizer
    expected = []
    for doc_id, text, *_ in texts:
        ids = np.array([*encoder.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        for piece, start in enumerate(range(0, len(ids), 2048)):
            part = ids[start : start + 2048]
            expected.append((doc_id, piece, start, len(part), zlib.crc32(part.tobytes())))
    assert Counter(tuple(r)[:5] for r in rows) == Counter(expected)
    places: dict[int, list] = {}
    for r in rows:
        places.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for found in places.values():
        at = 0
        for offset, length in sorted(found):
            assert offset == at
            at += length
        assert at <= 2048
    assert len(places) == -(-sum(e[3] for e in expected) // 2048)
    assert packing.pack_documents(spark, no_docs, path).count() == 0


def best_bins(items: list[int], capacity: int) -> int:
    """Fewest bins by trying all ways."""
    best = len(items)

    def put(at: int, rooms: list[int]) -> None:
        nonlocal best
        if len(rooms) >= best:
            return
        if at == len(items):
            best = len(rooms)
            return
        for i, room in enumerate(rooms):
            if room >= items[at] and room not in rooms[:i]:
                put(at + 1, [*rooms[:i], room - items[at], *rooms[i + 1 :]])
        put(at + 1, [*rooms, capacity - items[at]])

    put(0, [])
    return best


def test_fixed_sets_cost_no_bin():
    draw = random.Random(4)
    for _ in range(60):
        capacity = draw.randint(6, 30)
        items = sorted((draw.randint(1, capacity) for _ in range(draw.randint(1, 8))), reverse=True)
        plan = packing.Packing(Counter(items), capacity)
        bins: Counter[int] = Counter()
        for length, count in Counter(items).items():
            found, offsets = plan.places(np.full(count, length), np.arange(count))
            assert (offsets + length <= capacity).all()
            for b in found:
                bins[int(b)] += length
        assert max(bins.values()) <= capacity and sum(bins.values()) == sum(items)
        # The sets that were fixed, and the best way for the rest, take no more bins than the best way for all.
        fixed = []
        for length, count in Counter(items).items():
            found, _ = plan.places(np.full(count, length), np.arange(count))
            fixed += [length for b in found if b < plan.fixed]
        rest = Counter(items) - Counter(fixed)
        assert plan.fixed + best_bins(sorted(rest.elements(), reverse=True), capacity) == best_bins(items, capacity)


def test_nearest(spark):
    random_ = np.random.default_rng(3)
    vectors = random_.standard_normal((300, 8))
    vectors /= np.linalg.norm(vectors, axis=1, keepdims=True)
    vectors[50:90] = vectors[40]  # a tie that is larger than k
    rows = [(i, v.tolist()) for i, v in enumerate(vectors)]
    rows += [(900, None), (920, [0.0] * 8), (940, [float("nan")] * 8), (960, [None] * 8), (None, vectors[0].tolist())]
    table = nearest.usable(spark.createDataFrame(rows, "vec_id bigint, embedding array<double>"), "vec_id", "embedding")
    asked = table.filter("vec_id % 20 = 0")
    found: dict[int, list] = {}
    for r in nearest.nearest(table, asked, 10, nearest.Index(8, mass=0.95)).collect():
        found.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    hits = 0
    for query in range(0, 300, 20):
        scores = (vectors * vectors[query]).sum(axis=1)
        ids = [i for i in np.lexsort((np.arange(300), -scores)) if i != query][:10]
        got = sorted(found[query])
        assert [r for r, *_ in got] == list(range(1, 11))
        assert all(abs(scores[i] - s) < 1e-12 for _, i, s in got)
        assert got == sorted(got, key=lambda x: (-x[2], x[1]))
        hits += len({i for _, i, _ in got} & set(ids))
    assert hits >= 0.9 * 150
    assert [i for _, i, _ in sorted(found[60])] == [i for i in range(40, 90) if i not in range(41, 50) and i != 60][:10]
    few = table.filter("vec_id < 5")
    assert nearest.nearest(few, few, 20, nearest.Index(8)).count() == 20
    assert nearest.nearest(table.limit(0), table.limit(0), 20, nearest.Index(8)).count() == 0


def test_nearest_counts_repeated_ids_once(spark):
    vectors = np.random.default_rng(5).standard_normal((200, 8))
    vectors /= np.linalg.norm(vectors, axis=1, keepdims=True)
    plain = [(i, v.tolist()) for i, v in enumerate(vectors)]

    def found(rows, index):
        made = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
        table = nearest.usable(made, "vec_id", "embedding")
        return sorted(map(tuple, nearest.nearest(table, table.filter("vec_id < 2"), 10, index).collect()))

    # The query itself and its nearest neighbour stand 30 times each: nothing changes.
    wide = nearest.Index(8, width=40.0)
    near = next(vec_id for query, rank, vec_id, _ in found(plain, wide) if (query, rank) == (0, 1))
    for index in (nearest.Index(8, mass=0.95), wide):
        assert found(plain + 29 * [plain[0], plain[near]], index) == found(plain, index)
    # One id with 30 more vectors close to the query, over several buckets: it is listed once, at its best score.
    close = [vectors[0] * (1 - 0.01 * i) + 0.01 * vectors[1] for i in range(30)]
    rows = plain + [(near, v.tolist()) for v in close]
    for index in (nearest.Index(8, mass=0.95), nearest.Index(8, width=0.4, mass=0.999), wide):
        hits = [r for r in found(rows, index) if r[0] == 0]
        assert len({r[2] for r in hits}) == len(hits) == 10
        assert hits[0][2] == near and abs(hits[0][3] - close[0] @ vectors[0]) < 1e-9
    scores = vectors @ vectors[0]
    others = sorted((i for i in range(1, 200) if i != near), key=lambda i: -scores[i])[:9]
    assert [r[2] for r in hits] == [near, *others]


def brute_classes(rows: list[tuple], least: float = 0.8) -> list[int]:
    sets = []
    for _, text, *_ in rows:
        found = re.findall(r"\w+", (text or "").lower())
        sets.append(Counter(tuple(found[i : i + 5]) for i in range(max(1, len(found) - 4))))
    top = list(range(len(rows)))
    for a, b in itertools.combinations(range(len(rows)), 2):
        if sum((sets[a] & sets[b]).values()) >= least * sum((sets[a] | sets[b]).values()):
            old, new = top[b], top[a]
            top = [new if t == old else t for t in top]
    return top


def test_near_copies(spark, docs, no_docs, texts):
    draw = random.Random(8)
    base = words_of(5, 200)
    rows = list(texts)
    for i in range(100, 170):  # a group whose members are more or less like each other
        copy = list(base)
        for _ in range(draw.randint(0, 12)):
            copy[draw.randrange(200)] = f"w{draw.random()}"
        rows.append((i, " ".join(copy), "en", None, None))
    table = spark.createDataFrame(rows, DOCS)
    top = brute_classes(rows)
    expected = Counter()
    for i, row in enumerate(rows):
        ids = [r[0] for r, t in zip(rows, top) if t == top[i] and r[0] is not None]
        expected[row[0], min(ids, default=None), top.count(top[i])] += 1
    got = near_copies.classes(spark, table).collect()
    assert Counter((r["doc_id"], r["class_id"], r["class_size"]) for r in got) == expected
    kept = near_copies.without_copies(spark, table)
    assert kept.columns == table.columns
    assert Counter(r["doc_id"] for r in kept.collect()) == Counter(
        min((r[0] for r, t in zip(rows, top) if t == c and r[0] is not None), default=None) for c in set(top)
    )
    assert near_copies.classes(spark, no_docs).count() == 0
    assert near_copies.without_copies(spark, no_docs).count() == 0


def test_texts_without_words_meet_equal_ones_only(spark):
    texts = ["!?", "", "😀 😀", None, "!?", "😀  😀\n", "😀", " ", "--"]
    rows = [(i, t, "en", None, None) for i, t in enumerate(texts)]
    # A repeated id, whose rows are told apart by their keys.
    table = spark.createDataFrame([*rows, (8, "...", "en", None, None)], DOCS)
    got = sorted((r["doc_id"], r["class_id"], r["class_size"]) for r in near_copies.classes(spark, table).collect())
    assert got == [(0, 0, 2), (1, 1, 3), (2, 2, 2), (3, 1, 3), (4, 0, 2), (5, 2, 2), (6, 6, 1), (7, 1, 3), (8, 8, 1), (8, 8, 1)]
    kept = sorted((r["doc_id"], r["text"]) for r in near_copies.without_copies(spark, table).collect())
    assert kept == [(0, "!?"), (1, ""), (2, "😀 😀"), (6, "😀"), (8, "--"), (8, "...")]


def test_signatures_follow_weights():
    draw = np.random.default_rng(1)
    elements = draw.integers(1, 2**63, 80, dtype=np.uint64)
    one, other = draw.integers(0, 4, 80).astype(float), draw.integers(0, 4, 80).astype(float)
    likeness = np.minimum(one, other).sum() / np.maximum(one, other).sum()
    signs = [near_copies.signature(elements[w > 0], w[w > 0], 4000) for w in (one, other)]
    assert abs((signs[0] == signs[1]).mean() - likeness) < 0.04


def test_shards(spark, docs, no_docs, texts):
    def draw(key, level, node):
        value = xxhash.xxh64_intdigest(int(key).to_bytes(8, "little", signed=True), 42)
        value = xxhash.xxh64_intdigest(level.encode(), value)
        value = xxhash.xxh64_intdigest(int(node).to_bytes(4, "little"), value)
        return -np.log(((value >> 11) + 0.5) / 2**53)

    def place(key, leaves):
        def least(level, nodes):
            return min((draw(key, level, n) / w, n) for n, w in nodes.items())[1] if len(nodes) > 1 else next(iter(nodes))

        region = least("region", Counter(s.region for s in leaves))
        rack = least(f"rack of {region}", Counter(s.rack for s in leaves if s.region == region))
        own = {s.number: 1 for s in leaves if (s.region, s.rack) == (region, rack)}
        return least(f"shard of {region}.{rack}", own)

    rows = [(10_000 + i, f"t{i}", None, None, None) for i in range(2000)] + [t for t in texts if t[0] is not None]
    found = shards.shard_slots(spark.createDataFrame(rows, DOCS)).collect()
    assert len(found) == len(rows)
    for r in found:
        assert r["grown_shard"] in (r["shard"], 24)
    for r in found[:200]:
        assert (r["shard"], r["grown_shard"]) == (place(r["doc_id"], shards.tree(24)), place(r["doc_id"], shards.tree(25)))
    assert 40 < sum(r["grown_shard"] == 24 for r in found) < 130
    for shard in range(24):
        slots = sorted(r["slot"] for r in found if r["shard"] == shard)
        assert slots == list(range(len(slots))) and 40 < len(slots) < 140
    size = {r["doc_id"]: (r["size"], r["text_crc32"]) for r in found}
    assert size[4] == (8, 0) and size[8] == (17, zlib.crc32(b"two words"))
    assert shards.shard_slots(docs).count() == len(texts) and shards.shard_slots(no_docs).count() == 0


def test_token_counts(docs, no_docs, texts):
    import sentencepiece

    path = public_tokenizers.path("piece_bpe_32k.model")
    library = sentencepiece.SentencePieceProcessor(model_file=path)
    found = token_counts.count_tokens(docs, path, part_chars=100).collect()
    expected = []
    for doc_id, text, *_ in texts:
        n = len(library.encode(text or ""))
        expected.append((doc_id, len((text or "").encode()), n, n > 4096))
    assert Counter(tuple(r) for r in found) == Counter(expected)
    for text in ("a  b   c " * 20, "x" * 400, " " * 300, "▁ ▁ a " * 60, "\n \n" * 90):
        parts = token_counts.safe_parts(text, 10)
        assert sum(len(library.encode(p)) for p in parts) == len(library.encode(text))
    assert token_counts.count_tokens(no_docs, path).count() == 0


def test_token_files(spark, docs, no_docs, texts, tmp_path):
    path = public_tokenizers.path("byte_bpe_50k.json")
    manifest = token_files.write_token_files(docs, f"{tmp_path}/files", path, 2, frame_bytes=300)
    encoder, start, expected = Vocabulary(path).tokenizer, 0, []
    order = sorted(texts, key=lambda r: (r[0] is not None, r[0] or 0))
    for doc_id, text, *_ in order:
        ids = np.array([*encoder.encode(text or "", add_special_tokens=False).ids, 2], "<u4")
        expected.append((doc_id, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    assert sorted((tuple(r) for r in token_files.read_digests(manifest).collect()), key=lambda r: r[1]) == expected
    (row,) = token_files.read_documents(manifest, [8, 77, 1]).filter("doc_id = 1").collect()
    assert row["ids"] == [*encoder.encode(texts[0][1], add_special_tokens=False).ids, 2]
    file = manifest.collect()[0]["file"]
    stored = bytearray(open(file, "rb").read())
    stored[10] ^= 255
    open(file, "wb").write(stored)
    with pytest.raises(Exception, match="damaged"):
        token_files.read_digests(manifest).collect()
    assert token_files.read_digests(token_files.write_token_files(no_docs, f"{tmp_path}/none", path, 2)).count() == 0


def test_toxicity(spark, docs, no_docs):
    draw = random.Random(2)
    common, bad = words_of(11, 300), ["vilewort", "vileness", "fiend"]
    rows, labels = [], []
    for i in range(600):
        found = [draw.choice(common) for _ in range(40)]
        toxic = i % 4 == 0
        if toxic:
            found[draw.randrange(40)] = draw.choice(bad)
        if draw.random() < (0.6 if toxic else 0.05):
            found.append("muslim")  # named mostly in toxic rows, and neutral all the same
        rows.append((i, " ".join(found), None, None, None))
        labels.append((i, int(toxic)))
    labels += [(5, None), (None, 1), (0, 1)]
    table, marks = spark.createDataFrame(rows, DOCS), spark.createDataFrame(labels, "doc_id bigint, toxic int")
    model = toxicity.train(table, marks)
    free = toxicity.train(table, marks, toxicity.Training(swap_weight=0.0))
    neutral = " ".join([*common[:40], "muslim"])
    assert model.score(neutral) < 0.5
    gap = [abs(m.score(neutral) - m.score(neutral.replace("muslim", "hindu"))) for m in (model, free)]
    assert gap[0] < gap[1]
    scored = {r["doc_id"]: r for r in toxicity.score_documents(table, model).collect()}
    assert all(r["held_out"] == (zlib.crc32(str(i).encode()) % 5 == 0) for i, r in scored.items())
    assert all(scored[i]["predicted"] == int(i % 4 == 0) for i in scored if scored[i]["held_out"])
    assert toxicity.without_toxic(docs, model).columns == docs.columns
    assert toxicity.without_toxic(docs, model).count() == 10
    assert toxicity.score_documents(docs, model).filter("score between 0 and 1").count() == 10
    assert toxicity.train(table, marks.limit(0)).score("fiend") == pytest.approx(0.25)
    assert toxicity.score_documents(no_docs, model).count() == 0


def test_blocks():
    found = blocks("<p>a<b>b</b>c<br>d<p>e &amp;lt; &eacute;<script>x<p>y</script><ul><li>f<li>g</ul><!-- h --> 1 < 2<td>i")
    assert [b.text for b in found] == ["abc d", "e &lt; é", "f", "g", "1 < 2", "i"]
    assert blocks(None) == [] and blocks("") == [] and [b.text for b in blocks("plain")] == ["plain"]
    assert blocks("<nav class='menu top'><a href=x>go</a></nav>")[0].names == ("menu", "top")


def test_main_text(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    model = main_text.train(pages)
    page = (
        '<body><div class="menu"><a href=/>Home</a></div><div class="article-body"><h1>Title of it</h1><p>First text here,'
        ' long enough.</p><div class="advert"><p>Buy now.</p></div><p>Second text &amp; more of it.</p></div>'
        '<section class="comments"><h3>Comments</h3><div class="comment"><p>I like this text very much.</p></div></section>'
        "<footer><p>&copy; Someone</p></footer>"
    )
    assert main_text.main_text(page, model) == "Title of it First text here, long enough. Second text & more of it."
    rows = [(1, "u", None, "x"), (2, None, "", "x"), (3, "u", page, "x"), (3, "u", page, "x")]
    table = spark.createDataFrame(rows, "page_id bigint, url string, html string, text string")
    found = sorted((r["page_id"], r["n_chars"]) for r in main_text.extract(table, model).collect())
    assert found == [(1, 0), (2, 0), (3, 67), (3, 67)]
    assert main_text.train(table.limit(0)) is None
    assert main_text.extract(table.limit(0), None).count() == 0
    # Against the pages' own elements, all of them.
    for r in main_text.extract(pages, model).join(pages.select("page_id", "html"), "page_id").collect():
        own = [b.text for b in blocks(r["html"]) if "article" in b.tags]
        assert r["text"] == " ".join(own)


def test_states_are_the_likeliest():
    draw = np.random.default_rng(2)
    page = blocks("<p>aaa</p><div>b b</div><li>c.</li><p>d</p><nav>e</nav>")
    for _ in range(30):
        weights = {f: float(draw.normal()) for b in page for f in main_text.block_features(b)}
        model = main_text.Field(weights, draw.normal(size=(2, 2)), float(draw.normal()))

        def worth(states, model=model):
            total = model.start * states[0]
            for block, state in zip(page, states):
                total += state * sum(model.weights[f] for f in main_text.block_features(block))
            return total + sum(model.steps[a, b] for a, b in zip(states, states[1:]))

        best = max(itertools.product((0, 1), repeat=len(page)), key=worth)
        assert [int(s) for s in model.decode(page)] == list(best)


def test_decontamination(spark, docs, no_docs):
    item, short = words_of(21, 40), words_of(22, 8)
    off = [w if i % 6 else "other" for i, w in enumerate(item)]  # two or three of thirteen substituted
    worse = [w if i % 3 else "other" for i, w in enumerate(item)]
    fill = words_of(23, 300)
    rows = [
        (1, " ".join([*fill[:100], *item[5:25], *fill[100:]]), None, None, None),
        (2, " ".join([*fill[:50], *off, *fill[50:90]]), None, None, None),
        (3, " ".join([*fill, *worse]), None, None, None),
        (4, " ".join([*fill[:9], *item[:12]]), None, None, None),
        (5, " ".join([*fill[:30], *short, *fill[30:60]]), None, None, None),
        (6, None, None, None, None),
        (7, " ".join(item), None, None, None),
    ]
    table = spark.createDataFrame(rows, DOCS)
    bench = spark.createDataFrame(
        [(1, " ".join(item)), (2, " ".join(short)), (3, None), (4, ""), (5, "too short")], "item_id bigint, text string"
    )
    for most in (2_000_000, 20):
        found = {(r["doc_id"], r["item_id"]): r for r in decontamination.overlaps(table, bench, most_words=most).collect()}
        assert set(found) == {(1, 1), (2, 1), (5, 2), (7, 1)}
        assert (found[1, 1]["start"], found[1, 1]["length"], found[1, 1]["equal"]) == (100, 20, 20)
        assert found[7, 1]["length"] == 40 and found[2, 1]["equal"] < found[2, 1]["length"]
        kept = decontamination.decontaminated(table, bench, most_words=most)
        assert kept.columns == table.columns and {r["doc_id"] for r in kept.collect()} == {3, 4, 6}
    assert decontamination.decontaminated(docs, bench).count() == docs.count()
    assert decontamination.overlaps(no_docs, bench).count() == 0 and decontamination.overlaps(table, bench.limit(0)).count() == 0


def test_masks_meet_every_pair_of_substitutions():
    rule = decontamination.Overlap()
    draw = np.random.default_rng(5)
    for spots in itertools.combinations(range(13), 2):
        item = draw.integers(1, 2**63, 13, dtype=np.uint64)
        other = item.copy()
        other[list(spots)] += np.uint64(1)
        assert any((a == b).all() for a, b in zip(rule.seeds(item), rule.seeds(other)))


def test_url_filter(spark):
    urls = [
        "http://a.Example.NET/en/x?q#f", "https://example.net/", "http://example.net", "http://net/", "ftp://fr.org/fr/1",
        "http://x.example.com/de/a", "http://example.com/des", "nothing", None, "", "http://notexample.net/en/", "://org/fr/",
        "http://b.org/fr?/fr/", "http://b.org/fr/?x", "http://example.net:80/en/",
    ]
    rules = {"net/": "block", "example.net/en/": "allow", "example.com/de/": "block", "org/fr/": "allow"}
    table = spark.createDataFrame([(i, u, "x") for i, u in enumerate(urls)], "page_id bigint, url string, host string")
    block, allow = [[r for r, v in rules.items() if v == kind] for kind in ("block", "allow")]
    for r in url_filter.judge(table, block, allow).collect():
        url = urls[r["page_id"]] or ""
        rest = url.split("://", 1)[1] if "://" in url else ""
        host = re.match(r"[^/?#]*", rest)[0].lower()
        path = re.match(r"[^?#]*", rest[len(host) :])[0]
        fits = [
            k for k in rules
            if (host == k.split("/")[0] or host.endswith("." + k.split("/")[0])) and path.startswith(k[k.index("/") :])
        ]
        rule = max(fits, key=len, default=None)
        assert (r["host"], r["path"], r["rule"], r["verdict"]) == (host, path, rule, rules.get(rule, "allow")), url
    assert url_filter.judge(table.limit(0), block, allow).count() == 0
    assert {r["verdict"] for r in url_filter.judge(table, [], []).collect()} == {"allow"}


def test_cascade_is_exact(spark):
    keys = spark.range(3000).selectExpr("concat('k', id % 2500) as key")
    listed = spark.range(0, 2500, 7).selectExpr("concat('k', id) as key").unionByName(spark.sql("select cast(null as string) key"))
    cascade = url_filter.build(spark, listed, keys)
    rows = keys.distinct().selectExpr("key", "xxhash64(key) as h").collect()
    found = cascade.listed(np.array([r["h"] for r in rows]).astype(np.uint64))
    assert [bool(f) for f in found] == [int(r["key"][1:]) % 7 == 0 for r in rows]
    assert len(cascade.levels) > 1
