"""Jaccard join, decontamination, nearest neighbours, repeated strings and the pipeline against brute force."""

import collections
import hashlib
import itertools
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from virelay.llm import components, jaccard_join, rotated_codes, shingles, simhash_decontam, suffix_dedup

FOLD = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def words(text):
    return re.findall("[^\x20\x09-\x0d]+", (text or "").translate(FOLD))


def shingled(text, width):
    w = words(text)
    return frozenset(tuple(w[i : i + width]) for i in range(len(w) - width + 1)) if len(w) >= width else frozenset([tuple(w)] if w else [])


def test_word_and_shingle_hashes():
    r = random.Random(5)
    for _ in range(150):
        text = "".join(r.choice("abAé \n\t\x0b\x1c") for _ in range(r.randint(0, 200)))
        hashed, starts, ends = shingles.word_hashes(text.encode())
        assert [text.encode()[a:b].decode().translate(FOLD) for a, b in zip(starts, ends, strict=True)] == words(text)
        assert len(set(hashed.tolist())) == len(set(words(text)))
        for width in (1, 4):
            s = shingles.shingle_set(text, width)
            assert len(s) == len(shingled(text, width)) and (shingles.unpacked_set(shingles.packed_set(s)) == s).all()


def brute_classes(texts, width, num, den):
    sets = [shingled(t, width) for t in texts]
    root = list(range(len(sets)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, j in itertools.combinations(range(len(sets)), 2):
        both = len(sets[i] & sets[j])
        if both and both * den >= num * len(sets[i] | sets[j]):
            a, b = sorted((find(i), find(j)))
            root[b] = a
    return [(len(s), find(k)) for k, s in enumerate(sets)]


def near_texts(seed, n, size):
    """Families of texts with few or many changed words, copies, and texts that share passages."""
    r = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(400)]
    out = [None, "", " \n", "one", "One", "one two", "one two three four"]
    while len(out) < n:
        base = [r.choice(vocabulary) for _ in range(r.randint(1, size))]
        for _ in range(r.randint(1, 9)):
            w = list(base)
            for _ in range(r.choice((0, 0, 1, 1, 2, 3, 8))):
                k, at = r.random(), r.randrange(len(w) + 1)
                w[at : at + (k < 0.6)] = [] if k < 0.3 else [r.choice(vocabulary)]
            out.append(" ".join(w))
    r.shuffle(out)
    return out[:n]


@pytest.mark.parametrize("width,num,size", [(4, 85, 30), (4, 85, 250), (5, 80, 60), (1, 50, 12), (2, 90, 400), (1, 34, 6)])
def test_classes_equal_brute_force(spark, width, num, size):
    texts = near_texts(size, 260, size)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    got = {r.id: (r.n_shingles, r.component_id) for r in jaccard_join.jaccard_classes(df, width=width, num=num, den=100).collect()}
    assert [got[k] for k in range(len(texts))] == brute_classes(texts, width, num, 100)


@pytest.mark.parametrize("num", [50, 80, 85, 95])
def test_signatures_find_every_similar_pair(num):
    """Also of sets whose tokens leave many segments empty."""
    r = np.random.default_rng(num)
    for size in (2, 5, 7, 11, 12, 13, 16, 30, 90, 300, 1500):
        for crowded in (False, True):
            for _ in range(15):
                tokens = r.choice(1 << 62, size * 2, replace=False).astype(np.uint64)
                if crowded:
                    tokens >>= np.uint64(5)
                shared = int(r.integers(max(1, size // 2), size + 1))
                a, b = np.sort(tokens[:size]), np.sort(np.concatenate([tokens[:shared], tokens[size : size + int(r.integers(0, size - shared + 2))]]))
                inside = len(np.intersect1d(a, b))
                if inside * 100 >= num * (len(a) + len(b) - inside) and not np.array_equal(a, b):
                    assert len(np.intersect1d(jaccard_join.signatures(a, num, 100), jaccard_join.signatures(b, num, 100)))


def test_close_parts_never_part_similar_sets():
    r = np.random.default_rng(1)
    for _ in range(40):
        base = r.integers(0, 1 << 63, int(r.integers(1, 200)), dtype=np.uint64)
        sets = [np.unique(np.concatenate([base[r.random(len(base)) < r.random()], r.integers(0, 1 << 63, int(r.integers(0, 20)), dtype=np.uint64)])) for _ in range(12)]
        parts = jaccard_join.close_parts([len(s) for s in sets], [jaccard_join.bitmap(s) for s in sets], 80, 100)
        links = jaccard_join.spanning_links(sets, 80, 100)
        assert all(parts[i] == parts[j] for i, j in links)


def test_blocks_of_a_large_group(spark, monkeypatch):
    monkeypatch.setattr(jaccard_join, "BLOCK_SETS", 5)
    base = [f"w{k}" for k in range(60)]
    texts = [" ".join(base[:k] + [f"x{k}"] + base[k + 1 :]) for k in range(40)] + [" ".join(base)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.id: (r.n_shingles, r.component_id) for r in jaccard_join.jaccard_classes(df, width=4, num=85, den=100).collect()}
    assert [got[k] for k in range(len(texts))] == brute_classes(texts, 4, 85, 100)


def test_classes_of_odd_rows(spark):
    rows = [(3, "a b c d e", "k"), (3, "a b c d e", "k"), (1, "a b c d e", "k"), (None, "a b c d e", "k"), (None, None, "k"), (3, "z", "k"), (9, "z", "k"), (7, "q " * 5000, "k")]
    df = spark.createDataFrame(rows, "doc_id long, text string, key string")
    got = sorted(((r.id, r.n_shingles, r.component_id) for r in jaccard_join.jaccard_classes(df).collect()), key=str)
    assert got == sorted([(3, 1, 1), (3, 1, 1), (1, 1, 1), (None, 1, 1), (None, 0, None), (3, 1, 3), (9, 1, 3), (7, 1, 7)], key=str)
    kept = sorted((tuple(r) for r in jaccard_join.one_of_each(df).collect()), key=str)
    assert [(r[0], (r[1] or "")[:1], r[2]) for r in kept] == [(1, "a", "k"), (3, "z", "k"), (7, "q", "k"), (None, "", "k")]
    assert jaccard_join.jaccard_classes(df.limit(0)).count() == 0 and jaccard_join.one_of_each(df.limit(0)).count() == 0


def test_components(spark):
    r = random.Random(2)
    links = [(r.randrange(300), r.randrange(300)) for _ in range(220)] + [(k, k + 1) for k in range(400, 480)] + [(1, 1), (None, 4)]
    got = {x.node: x.root for x in components.components(spark.createDataFrame(links, "a long, b long")).collect()}
    root = {k: k for pair in links for k in pair if k is not None}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        if a is not None and b is not None:
            a, b = sorted((find(a), find(b)))
            root[b] = a
    assert got == {k: find(k) for k in got} and all(k in got or find(k) == k for k in root)


# decontamination


def test_index_finds_all_within_radius():
    r = np.random.default_rng(3)
    prints = r.integers(0, 1 << 63, 40, dtype=np.uint64)
    asked = np.array([p ^ np.uint64(sum(1 << int(b) for b in r.choice(64, int(r.integers(0, 30)), replace=False))) for p in np.repeat(prints, 30)], np.uint64)
    who, item = simhash_decontam.BlockIndex(prints).near(asked)
    want = {(i, j) for i, a in enumerate(asked) for j, p in enumerate(prints) if int(a ^ p).bit_count() <= simhash_decontam.RADIUS}
    assert set(zip(who.tolist(), item.tolist(), strict=True)) == want


def brute_leaks(docs, items, threshold):
    """Best weighted similarity of all windows of the item's words, for each document and item of five words or more."""
    texts = [(k, words(t)) for k, t in items if len(words(t)) >= 5]
    bags = {k: collections.Counter(tuple(w[i : i + min(5, len(w))]) for i in range(len(w) - min(5, len(w)) + 1)) for k, w in texts}
    df = collections.Counter(s for bag in bags.values() for s in bag)
    weight = lambda s: np.log1p(len(bags) / df.get(s, 1))
    out = {}
    for doc, text in docs:
        w = words(text)
        held = {tuple(w[i : i + 5]) for i in range(len(w) - 4)}
        for item, own in texts:
            n = min(5, len(own))
            if held.isdisjoint(bags[item]):
                continue  # no window can be similar
            for a in range(len(w) - len(own) + 1):
                part = w[a : a + len(own)]
                bag = collections.Counter(tuple(part[i : i + n]) for i in range(len(part) - n + 1))
                both = sum(min(c, bags[item][s]) * weight(s) for s, c in bag.items())
                if both:
                    score = both / (sum(c * weight(s) for s, c in bag.items()) + sum(c * weight(s) for s, c in bags[item].items()) - both)
                    if score >= threshold and score > out.get((doc, item), (0,))[0] + 1e-12:
                        out[doc, item] = (score, a)
    return out


def test_leaks_equal_brute_force(spark):
    r = random.Random(8)
    vocabulary = [f"v{k}" for k in range(60)]
    text = lambda n: [r.choice(vocabulary) for _ in range(n)]
    items = [(k, " ".join(text(r.randint(8, 40)))) for k in range(12)] + [(20, None), (21, ""), (22, "short Item"), (23, "x")]
    docs = []
    for k in range(40):
        w = text(r.randint(0, 60))
        if k % 3 == 0:
            own = words(r.choice(items[:12])[1])
            for _ in range(r.choice((0, 0, 1, 2))):
                own[r.randrange(len(own))] = "changed"
            at = r.randrange(len(w) + 1)
            w[at:at] = own
        docs.append((k, " ".join(w).upper()))
    docs += [(50, None), (51, ""), (52, "a short item here"), (52, "x")]
    d, b = spark.createDataFrame(docs, "doc_id long, text string").withColumn("item_id", F.lit(1)), spark.createDataFrame(items, "item_id long, text string")
    got = {(x.id, x.item_id): (x.similarity, x.first_word) for x in simhash_decontam.leaks(d, b).collect()}
    want = brute_leaks(docs, items, 0.8)
    assert set(got) == set(want) and len(want) >= 8
    assert all(got[k][0] == pytest.approx(want[k][0]) and got[k][1] == want[k][1] for k in want)
    clean = {r.doc_id for r in simhash_decontam.drop_leaks(d, b).collect()}
    assert clean == {k for k, _ in docs} - {k for k, _ in want}
    assert {r.id for r in simhash_decontam.unsearchable(b).collect()} == {20, 21, 22, 23}
    assert simhash_decontam.leaks(d.limit(0), b).count() == 0 and simhash_decontam.leaks(d, b.limit(0)).count() == 0
    assert simhash_decontam.drop_leaks(d, b.limit(0)).count() == len(docs)


def test_leaks_in_several_item_blocks(spark, monkeypatch):
    monkeypatch.setattr(simhash_decontam, "ITEMS", 2)
    items = spark.createDataFrame([(k, " ".join(f"i{k}w{j}" for j in range(12))) for k in range(5)], "item_id long, text string")
    docs = items.select(F.col("item_id").alias("doc_id"), F.concat(F.lit("before "), "text", F.lit(" after")).alias("text"))
    assert sorted((r.id, r.item_id, r.first_word) for r in simhash_decontam.leaks(docs, items).collect()) == [(k, k, 1) for k in range(5)]
    assert simhash_decontam.drop_leaks(docs, items).count() == 0


def whole_leaks(docs, items, threshold):
    """What :func:`brute_leaks` passes over: similarity of whole documents to longer items."""
    texts = [(k, words(t)) for k, t in items if len(words(t)) >= 5]
    bags = {k: collections.Counter(tuple(w[i : i + min(5, len(w))]) for i in range(len(w) - min(5, len(w)) + 1)) for k, w in texts}
    df = collections.Counter(s for bag in bags.values() for s in bag)
    total = lambda bag: sum(c * np.log1p(len(bags) / df.get(s, 1)) for s, c in bag.items())
    out = {}
    for doc, text in docs:
        w = words(text)
        for item, own in texts:
            if len(w) < len(own):
                n = min(5, len(own))
                bag = collections.Counter(tuple(w[i : i + n]) for i in range(len(w) - n + 1))
                both = total(bag & bags[item])
                if both and (score := both / (total(bag) + total(bags[item]) - both)) >= threshold:
                    out[doc, item] = (score, 0)
    return out


def test_leaks_of_documents_shorter_than_the_item(spark):
    r = random.Random(12)
    vocabulary = [f"v{k}" for k in range(80)]
    items = [(k, " ".join(r.choice(vocabulary) for _ in range(r.randint(6, 40)))) for k in range(12)] + [(12, "a b c d"), (13, "y " * 30)]
    docs = [(0, ""), (1, "a b c"), (2, "y " * 28), (3, "y " * 20)]
    for k, text in items[:12]:
        w = text.split()
        docs += [(10 * k + 10, " ".join(w[:-1])), (10 * k + 11, " ".join(w[2:])), (10 * k + 12, " ".join(w[: len(w) // 2] + w[len(w) // 2 + 1 :])), (10 * k + 13, " ".join(w[: len(w) // 2]))]
    want = brute_leaks(docs, items, 0.8) | whole_leaks(docs, items, 0.8)
    d, b = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    rows = simhash_decontam.leaks(d, b).collect()
    got = {(x.id, x.item_id): (x.similarity, x.first_word) for x in rows}
    assert set(got) == set(want) and len(whole_leaks(docs, items, 0.8)) >= 8 and (2, 13) in got
    assert all(got[k][0] == pytest.approx(want[k][0]) and got[k][1] == want[k][1] for k in want)
    assert {x.id: x.n_words for x in rows if x.item_id == 13} == {2: 28}
    assert {x.doc_id for x in simhash_decontam.drop_leaks(d, b).collect()} == {k for k, _ in docs} - {k for k, _ in want}


def test_weights_do_not_depend_on_the_item_blocks(spark, monkeypatch):
    template = [f"t{j}" for j in range(14)]
    own = lambda k: template + [f"i{k}w{j}" for j in range(10)]
    items = [(k, " ".join(own(k))) for k in range(7)] + [(7, "")]
    docs = [(k, " ".join(["x", *own(k)[:-n], *["other"] * n, "y"])) for k in range(7) for n in (1, 2, 3)] + [(9, " ".join(template + own(2)[14:] + own(5)[14:]))]
    d, b = spark.createDataFrame(docs, "doc_id long, text string").repartition(1), spark.createDataFrame(items, "item_id long, text string")
    found = lambda: sorted((r.id, r.item_id, r.first_word, r.n_words, r.bits_apart, round(r.similarity, 9)) for r in simhash_decontam.leaks(d, b, threshold=0.5).collect())
    whole, clean = found(), sorted(r.text for r in simhash_decontam.drop_leaks(d, b, threshold=0.7).collect())
    assert whole and clean
    for n in (1, 2, 3, 6):
        monkeypatch.setattr(simhash_decontam, "ITEMS", n)
        assert found() == whole
        assert sorted(r.text for r in simhash_decontam.drop_leaks(d, b, threshold=0.7).collect()) == clean


def test_radius_recall_over_two_thousand_items(spark):
    """Of planted windows with an exact similarity of 0.8 or more nearly all are found, in one pass over the documents."""
    r = random.Random(21)
    vocabulary = [f"v{k}" for k in range(3000)]
    items = [(k, [r.choice(vocabulary) for _ in range(r.randint(20, 60))]) for k in range(2000)]
    docs = []
    for k in range(900):
        own = list(items[r.randrange(2000)][1]) if k else []
        item = next((i for i, w in items if w == own), None)
        for _ in range(r.choice((0, 1, 1, 2)) if own else 0):
            own[r.choice((0, -1, r.randrange(len(own))))] = r.choice(vocabulary)
        docs.append((k, item, [r.choice(vocabulary) for _ in range(40)] + own + [r.choice(vocabulary) for _ in range(40)]))
    df = collections.Counter(s for _, w in items for s in {tuple(w[i : i + 5]) for i in range(len(w) - 4)})
    weigh = lambda bag: sum(c * np.log1p(2000 / df.get(s, 1)) for s, c in bag.items())
    grams = lambda w: collections.Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4))
    want = set()
    for k, item, w in docs:
        if item is not None:
            bag, n = grams(items[item][1]), len(items[item][1])
            for a in range(30, min(50, len(w) - n + 1)):
                part = grams(w[a : a + n])
                both = weigh(part & bag)
                if both >= 0.8 * (weigh(part) + weigh(bag) - both):
                    want.add((k, item))
                    break
    d = spark.createDataFrame([(k, " ".join(w)) for k, _, w in docs], "doc_id long, text string")
    b = spark.createDataFrame([(k, " ".join(w)) for k, w in items], "item_id long, text string")
    got = {(x.id, x.item_id) for x in simhash_decontam.leaks(d, b).collect()}
    assert len(want) > 400 and got <= want and len(got) >= 0.99 * len(want)


def test_long_document_in_pieces(spark, monkeypatch):
    monkeypatch.setattr(simhash_decontam, "STARTS", 7)
    item = " ".join(f"i{k}" for k in range(30))
    text = " ".join([f"x{k}" for k in range(500)] + item.split() + [f"y{k}" for k in range(500)] + item.split())
    d, b = spark.createDataFrame([(1, text, "c")], "doc_id long, text string, `k1.x` string"), spark.createDataFrame([(5, item)], "item_id long, text string")
    assert [(r.id, r.item_id, r.first_word, r.n_words, r.similarity) for r in simhash_decontam.leaks(d, b).collect()] == [(1, 5, 500, 30, 1.0)]
    assert simhash_decontam.drop_leaks(d, b).columns == d.columns and simhash_decontam.drop_leaks(d, b).count() == 0


# nearest neighbours


def brute_neighbours(vectors, ids, q, k):
    score = vectors @ vectors[q]
    return [(int(ids[j]), float(score[j])) for j in np.lexsort((ids, -score)) if j != q][:k]


@pytest.mark.parametrize("part_rows,queries", [(None, 512), (200, 7)])
def test_neighbours_recall_and_ties(spark, monkeypatch, part_rows, queries):
    monkeypatch.setattr(rotated_codes, "QUERIES", queries)
    r = np.random.default_rng(4)
    vectors = r.standard_normal((1500, 32))
    vectors[20] *= 3
    vectors[700:800] = vectors[20]  # more copies than neighbours
    vectors[900:1100] += 4 * r.standard_normal(32)
    rows = [(int(k), [float(x) for x in np.float32(v)], "c") for k, v in enumerate(vectors)]
    bad = [(2000, None, "c"), (2020, [0.0] * 32, "c"), (2040, [float("nan")] * 32, "c"), (2060, [1.0] * 31 + [None], "c"), (2080, [float("inf")] * 32, "c"), (None, [1.0] * 32, "c"), (2120, [], "c")]
    df = spark.createDataFrame(rows + bad + rows[40:41], "vec_id long, embedding array<float>, rank string")
    got = collections.defaultdict(list)
    for x in rotated_codes.nearest(df, df.filter("vec_id % 20 = 0"), k=20, part_rows=part_rows).orderBy("query_id", "rank").collect():
        got[x.query_id].append((x.rank, x.vec_id, x.score))
    exact, hits = np.float32(vectors).astype(float), 0
    assert set(got) == set(range(0, 1500, 20))
    for q, found in got.items():
        score = exact @ exact[q]
        hits += len({v for _, v, _ in found} & {v for v, _ in brute_neighbours(exact, np.arange(1500), q, 20)})
        assert [k for k, _, _ in found] == list(range(1, 21))
        assert all(s == pytest.approx(score[v], abs=1e-9) for _, v, s in found) and q not in {v for _, v, _ in found}
        assert found == sorted(found, key=lambda x: (-x[2], x[1]))
    assert hits / (20 * len(got)) >= 0.98
    assert [v for _, v, _ in got[20]] == list(range(700, 720)) and [v for _, v, _ in got[720]] == [20, *range(700, 719)]


def test_codes_decide_and_recall_is_high(spark):
    """At 32,768 vectors: few pairs are scored exactly in one part, and the whole search over several cells finds nearly all."""
    r = np.random.default_rng(8)
    n, dim, k = 32768, 64, 21
    vectors = r.standard_normal((n, dim))
    vectors /= np.linalg.norm(vectors, axis=1)[:, None]
    width, center = rotated_codes.BITS, vectors.mean(axis=0)
    bits, length, aligned = rotated_codes.encode(vectors - center, rotated_codes.rotation(dim, width))
    ids = np.arange(n)
    one = (vectors.tobytes(), bits.tobytes(), np.concatenate([length, aligned]).tobytes(), np.ones(n, "<i8").tobytes(), ids.astype("<i8").tobytes(), np.stack([ids, ids], 1).astype("<i8").tobytes())
    part = rotated_codes.Part(dim, center, [one], rotated_codes.CONFIDENCE, width)
    asked = np.arange(0, n, 160)
    q, v, _ = part.search(vectors[asked], np.full(len(asked), -np.inf), k)
    truth = np.argsort(-(vectors[asked] @ vectors.T), axis=1)[:, :k]
    hits = sum(len(set(v[q == i].tolist()) & set(truth[i].tolist())) for i in range(len(asked)))
    assert part.exactly / part.pairs < 0.1 and hits / (k * len(asked)) >= 0.95

    df = spark.createDataFrame([(int(i), x.tolist()) for i, x in enumerate(vectors)], "vec_id long, embedding array<double>")
    got = collections.defaultdict(set)
    for x in rotated_codes.nearest(df, df.filter("vec_id % 160 = 0"), k=20).collect():
        got[x.query_id].add(x.vec_id)
    hits = sum(len(got[int(a)] & {int(t) for t in row if t != a}) for a, row in zip(asked, truth, strict=True))
    assert hits / (20 * len(asked)) >= 0.95


def test_bounds_hold_and_codes_are_packed():
    r = np.random.default_rng(6)
    vectors, queries = r.standard_normal((3000, 64)), r.standard_normal((50, 64))
    turn = rotated_codes.rotation(64, 128)
    assert turn @ turn.T == pytest.approx(np.eye(64), abs=1e-9)
    bits, length, aligned = rotated_codes.encode(vectors, turn)
    assert bits.shape == (3000, 16)
    about, room = rotated_codes.Codes(bits, length, aligned, 128, rotated_codes.CONFIDENCE).estimate(queries @ turn)
    exact = queries @ vectors.T
    assert np.mean(about + room >= exact) > 0.95 and abs(np.mean(about - exact)) < 0.05


def test_cells_that_can_hold_nothing_better_are_passed_over(spark):
    r = np.random.default_rng(9)
    centers = 50 * r.standard_normal((20, 16))
    vectors = np.concatenate([c + r.standard_normal((60, 16)) for c in centers])
    df = spark.createDataFrame([(int(i), x.tolist()) for i, x in enumerate(vectors)], "vec_id long, embedding array<double>")
    got = collections.defaultdict(list)
    for x in rotated_codes.nearest(df, df.filter("vec_id % 20 = 0"), k=5, part_rows=60).orderBy("query_id", "rank").collect():
        got[x.query_id].append(x.vec_id)
    want = {q: [v for v, _ in brute_neighbours(vectors, np.arange(1200), q, 5)] for q in range(0, 1200, 20)}
    assert sum(len(set(got[q]) & set(want[q])) for q in want) >= 0.95 * 5 * len(want)


def test_few_or_no_vectors(spark):
    df = spark.createDataFrame([(0, [1.0, 0.0]), (20, [0.5, 0.5]), (3, [2.0, 0.0])], "vec_id long, embedding array<double>")
    got = [(r.query_id, r.rank, r.vec_id) for r in rotated_codes.nearest(df, df.filter("vec_id % 20 = 0")).orderBy("query_id", "rank").collect()]
    assert got == [(0, 1, 3), (0, 2, 20), (20, 1, 3), (20, 2, 0)]
    assert rotated_codes.nearest(df.limit(0), df.limit(0)).count() == 0


def test_repeated_ids_and_several_dimensions(spark):
    """Rows with one id and several vectors are each a query and a candidate; only vectors of a query's dimension are its candidates."""
    rows = [(0, [1.0, 0.0]), (0, [0.0, 1.0]), (0, [0.0, 1.0]), (7, [0.5, 0.25]), (9, [1.0, 2.0, 3.0]), (20, [1.0, 0.0, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, `a.b` array<double>")
    got = sorted((r.query_id, r.rank, r.vec_id, r.score) for r in rotated_codes.nearest(df, df.filter("vec_id % 20 = 0"), vector_col="a.b").collect())
    assert got == [(0, 1, 7, 0.25), (0, 1, 7, 0.5), (0, 2, 0, 0.0), (0, 2, 0, 0.0), (20, 1, 9, 1.0)]


# repeated strings


def brute_repeats(texts, n):
    counts = collections.Counter(t[i : i + n] for t in texts for i in range(len(t) - n + 1))
    out = []
    for t in texts:
        gone = np.zeros(len(t) + 2, int)
        for i in range(len(t) - n + 1):
            if counts[t[i : i + n]] > 1:
                gone[i + 1 : i + n + 1] = 1
        out.append((len(t), int(gone.sum()), int((np.diff(gone) == 1).sum()), bytes(np.frombuffer(t, np.uint8)[gone[1:-1] == 0])))
    return out


@pytest.mark.parametrize("length,buffer,local,most", [(40, 500, 64, 4096), (40, 1 << 18, 1, 4096), (200, 3000, 1, 2), (33, 700, 64, 1), (90, 900, 0, 0)])
def test_repeats_equal_brute_force(spark, monkeypatch, length, buffer, local, most):
    """With usual bounds, and with anchors that are hot in some runs, in receivers, or everywhere."""
    monkeypatch.setattr(suffix_dedup, "LOCAL", local)
    monkeypatch.setattr(suffix_dedup, "HOT", most)
    monkeypatch.setattr(suffix_dedup, "BUFFER", buffer)
    monkeypatch.setattr(suffix_dedup, "RUN", 20_000)
    r = random.Random(length + buffer)
    base = ["".join(r.choice("abcdé ") for _ in range(r.randint(30, 600))) for _ in range(10)]
    texts = [None, "", "x" * 500, "x" * 70, "ab" * 300, "y" * length, "z" * (length - 1)]
    for _ in range(60):
        t = ""
        for _ in range(r.randint(0, 5)):
            b = r.choice(base)
            i = r.randint(0, len(b))
            t += b[i : r.randint(i, len(b))] if r.random() < 0.8 else "".join(r.choice("abcd") for _ in range(r.randint(1, 50)))
        texts.append(t)
    texts += [texts[-1], texts[-1]]
    df = spark.createDataFrame([(k, t, "c") for k, t in enumerate(texts)], "doc_id long, text string, kept string").repartition(5)
    got = {x.id: (x.n_bytes, x.n_removed, x.n_spans, bytes(x.kept)) for x in suffix_dedup.drop_repeats(df, length=length).collect()}
    want = brute_repeats([(t or "").encode() for t in texts], length)
    assert [got[k] for k in range(len(texts))] == want and sum(w[1] for w in want) > 1000


def test_repeats_of_odd_rows(spark):
    text = "".join(chr(97 + k % 23) + str(k) for k in range(120))
    rows = [(1, text), (1, text), (None, text[:250]), (None, None), (2, "short")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((r.n_bytes, r.n_removed, r.n_spans) for r in suffix_dedup.drop_repeats(df).collect())
    n = len(text)
    assert got == sorted([(n, n, 1), (n, n, 1), (250, 250, 1), (0, 0, 0), (5, 0, 0)])
    digest = suffix_dedup.drop_repeats(df, digest=True).filter("id = 2").first()
    assert digest.kept == hashlib.sha256(b"short").hexdigest()
    assert suffix_dedup.drop_repeats(df.limit(0)).count() == 0


def test_merge_of_front_coded_runs():
    r = random.Random(1)
    for _ in range(200):
        runs = []
        for _ in range(r.randint(1, 7)):
            x = sorted(bytes(r.choice(b"ab") for _ in range(r.randint(0, 6))) for _ in range(r.randint(0, 12)))
            coded = suffix_dedup.coded_run([(s, b"l", 0, 1, False, 1, 2, 3) for s in x])
            strings, prefixes, rest = suffix_dedup.decoded_run(coded)
            assert strings == x and all(v == (b"l", 0, 1, 0, 1, 2, 3) for v in rest)
            runs.append((strings, prefixes))
        order, prefixes = suffix_dedup.merge(runs)
        out = [runs[a][0][b] for a, b in order]
        assert out == sorted(s for x in runs for s in x[0]) and prefixes == suffix_dedup.adjacent(out)


def test_a_common_passage_with_other_surroundings(spark, monkeypatch):
    """A passage shorter than the strings, in all documents, is hot; only what recurs with its surroundings goes."""
    monkeypatch.setattr(suffix_dedup, "LOCAL", 8)
    r = random.Random(3)
    some = lambda n: "".join(r.choice("abcdefgh ") for _ in range(n))
    passage, longer = some(150), some(230)
    texts = [some(120) + passage + some(120) for _ in range(60)] + [some(90) + longer + some(90) for _ in range(40)]
    texts += [texts[0][:300] + some(40), some(30) + texts[1][100:330]]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    got = {x.id: (x.n_bytes, x.n_removed, x.n_spans, bytes(x.kept)) for x in suffix_dedup.drop_repeats(df).collect()}
    assert [got[k] for k in range(len(texts))] == brute_repeats([t.encode() for t in texts], 200) and got[70][1] >= 230


# the pipeline


def test_pipeline_stage_by_stage(spark):
    """Every stage on its own input, against brute force where there is one."""
    import corpus_pipeline as pipeline
    from virelay.llm.common import stored

    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    assert [n for n, _ in pipeline.STAGES] == ["language ID", "line dedup", "n-gram Jaccard join", "benchmark decontamination", "SentencePiece"]
    steps = [docs]
    for k, (name, stage) in enumerate(pipeline.STAGES):
        out = stored(stage(spark, steps[-1], sf), f"test-{k}")
        assert k == 4 or out.columns == docs.columns, name
        steps.append(out)
    rows = [{r.doc_id: r for r in s.collect()} for s in steps]
    assert set(rows[1]) == {k for k, r in rows[0].items() if any(c.isalpha() for c in r.text or "")}
    ids = sorted(rows[1])
    counts = collections.Counter(k for i in ids for k in {x.strip(" \t\n\x0b\x0c\r").translate(FOLD) for x in rows[1][i].text.split("\n")})
    for i in ids:
        kept = "\n".join(x for x in rows[1][i].text.split("\n") if not (k := x.strip(" \t\n\x0b\x0c\r").translate(FOLD)) or counts[k] < 10)
        assert rows[2][i].text == kept and rows[2][i].n_chars == len(kept)
    classes = brute_classes([rows[2][i].text for i in ids], 5, 80, 100)
    assert set(rows[3]) == {ids[c] for _, c in classes}
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    texts = [(i, r.text) for i, r in rows[3].items()]
    leaked = {d for d, _ in brute_leaks(texts, items, 0.8) | whole_leaks(texts, items, 0.8)}
    assert leaked and set(rows[4]) == set(rows[3]) - leaked
    from virelay.llm import sentencepiece_agenda
    import public_tokenizers

    library = sentencepiece_agenda.encoder(public_tokenizers.path("piece_bpe_32k.model")).library
    assert {i: r.ids for i, r in rows[5].items()} == {i: library.encode(r.text) for i, r in rows[4].items()}
    assert {r.doc_id for r in pipeline.run(spark, sf).collect()} == set(rows[5])
