"""Line dedup, main text, packed tokens, pieces and languages on small tables."""

import hashlib
import io
import random
import zlib
from html.parser import HTMLParser

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from virelay.llm import html_text, langid, line_dedup, sentencepiece_agenda, token_pack

BPE, PIECES = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
DOC = "doc_id long, text string, row string, n_lines string, score string, lang string"
ODD_TEXTS = [None, "", " ", "\n", "\n\n", "a", " a", "a ", "  x  y ", "a\tb", "\x00a b", "▁▁q ▁", "é😀漢字 1234 don't", "x" * 3000, "word " * 4000, "a\n b\n\nc ", "<s> </s> <|endoftext|>", "ß  z", "\x1c a\x1d"]


def odd_table(spark):
    """Odd texts, repeated rows, a null id, and columns named as the operators' own."""
    rows = [(k, t, "r", "x", "y", None) for k, t in enumerate(ODD_TEXTS)] + [(0, None, "r", "x", "y", None), (None, "a b", "r", "x", "y", None), (5, "other", "r", "x", "y", None)]
    return spark.createDataFrame(rows, DOC).repartition(3)


def empty(spark):
    return spark.createDataFrame([], DOC)


# line dedup


def key(line):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(" \t\n\x0b\x0c\r"))


def brute_lines(texts, least):
    counts = {}
    for t in texts:
        for k in {key(x) for x in (t or "").split("\n")} - {""}:
            counts[k] = counts.get(k, 0) + 1
    out = []
    for t in texts:
        lines = (t or "").split("\n")
        kept = [x for x in lines if counts.get(key(x), 0) < least]
        out.append((len(lines), len(lines) - len(kept), "\n".join(kept)))
    return out


@pytest.mark.parametrize("batches", [1, 2, 7])
def test_lines_equal_brute_force_in_any_batches(spark, batches):
    r = random.Random(batches)
    pool = ["Hot line", " hot LINE\t", "É", "é", "", "rare", *[f"l{k}" for k in range(20)]]
    texts = [None if r.random() < 0.05 else "\n".join(r.choice(pool) for _ in range(r.randint(0, 8))) for _ in range(90)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {x.row.doc_id: (x.n_lines, x.n_dropped, x.kept) for x in line_dedup.drop_frequent_lines(df, min_docs=10, batches=batches).collect()}
    assert [got[k] for k in range(len(texts))] == brute_lines(texts, 10)


def test_lines_of_odd_rows(spark):
    got = line_dedup.drop_frequent_lines(odd_table(spark), min_docs=2).collect()
    assert len(got) == len(ODD_TEXTS) + 3 and set(got[0].row.asDict()) == {"doc_id", "text", "row", "n_lines", "score", "lang"}
    assert {x.kept for x in got if x.row.doc_id == 0} == {""} and {x.n_lines for x in got if x.row.doc_id == 0} == {1}
    assert line_dedup.drop_frequent_lines(empty(spark)).count() == 0


def test_runs_are_compacted_and_plans_stay_native(spark):
    df = spark.createDataFrame([(k, "same\nline %d" % (k % 30)) for k in range(120)], "doc_id long, text string")
    runs = line_dedup.LineRuns(spark, 4)
    for k in range(9):
        runs.add_documents(df.filter(F.col("doc_id") % 9 == k), "text")
        if k == 4:  # the settled line is passed over from here on
            assert runs.spark.table(runs.levels[0][0]).count() == 10
    assert [n for _, n in runs.levels] == [1, 2] and len(runs.done) == 2
    assert {(x.n_docs) for x in runs.settled().collect()} >= {4} and spark.sql("show tables").filter(F.col("tableName").startswith(runs.name)).count() == 0
    plan = line_dedup.drop_frequent_lines(df, min_docs=4)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_runs_are_neither_exchanged_nor_sorted_again(spark):
    counts = line_dedup.stored(line_dedup.line_counts(spark.range(900).selectExpr("concat('line ', id % 200) text"), "text"), "counts")
    runs = line_dedup.LineRuns(spark, 4, fanout=2, buckets=5)
    for _ in range(3):
        runs.add(counts)
    with line_dedup.setting(spark, line_dedup.ORDERED, "true"):
        plan = runs.unsettled(counts)._jdf.queryExecution().executedPlan().toString()
        lines = [x for x in plan.split("\n") if "AdaptiveSparkPlan" not in x]
        scans = [k for k, x in enumerate(lines) if "Bucketed: true" in x]
        assert scans and "SortMergeJoin" in plan
        for at in scans:  # from the scan up to its join
            depth = lambda x: len(x) - len(x.lstrip(" :+-"))
            k = at
            while "SortMergeJoin" not in lines[k]:
                assert "Exchange" not in lines[k] and "Sort [" not in lines[k]
                k = max(j for j in range(k) if depth(lines[j]) < depth(lines[k]))
        merged = runs.merged(runs.levels[0][0])
        plan = merged._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and "Bucketed: true" in plan
    assert runs.settled().count() == 200


def test_hot_lines_are_dealt_to_several_tasks(spark):
    texts = [f"hot\n{'also hot' if k % 2 else 'x'}\nown {k}\nhot" for k in range(300)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {x.row.doc_id: (x.n_lines, x.n_dropped, x.kept) for x in line_dedup.drop_frequent_lines(df, min_docs=10).collect()}
    assert [got[k] for k in range(300)] == brute_lines(texts, 10)


def test_lines_of_dotted_columns(spark):
    df = spark.createDataFrame([(k, "a\nb %d" % k, "z") for k in range(12)], "`doc.id` long, `the.text` string, h1 string")
    got = line_dedup.drop_frequent_lines(df, id_col="doc.id", text_col="the.text")
    assert sorted(x.kept for x in got.collect()) == sorted(f"b {k}" for k in range(12))


# main text


def test_html_on_held_out_pages():
    model, right, total = html_text.model(), 0, 0
    for source, labels in html_text.labelled_pages(150, seed=4242):
        page = html_text.parse(source)
        found = [p > 0.5 for p in model.marginals(page)][1:]
        right, total = right + sum(a == b for a, b in zip(found, labels, strict=True)), total + len(labels)
    assert right / total > 0.96


@pytest.mark.parametrize("source", [
    "<body><nav class=menu><p>a b</p></nav><article><p>some words here</p><div class=ad>x</div></article></body>",
    "<p>some words here</p><aside>more</aside><p>and yet more words to be read</p>",
])
def test_marginals_are_exact(source):
    """Against the sum over all states of a small tree."""
    import itertools
    import math

    model = html_text.model()
    page = html_text.parse(source)
    weights = [math.exp(sum(model.weights.get(x, 0.0) for x in seen)) for seen in html_text.evidence(page)]
    weights[0] = math.exp(model.root[html_text.has_body(page)])
    n = len(page.elements)
    mass, total = [0.0] * n, 0.0
    for state in itertools.product((0, 1), repeat=n):
        w = weights[0] ** state[0] * math.prod(weights[i] ** state[i] * model.pair(page.elements[i].tag)[state[page.elements[i].parent]][state[i]] for i in range(1, n))
        total += w
        mass = [m + w * s for m, s in zip(mass, state, strict=True)]
    assert model.marginals(page) == pytest.approx([m / total for m in mass], abs=1e-9)


@pytest.mark.parametrize("source,text", [
    (None, ""), ("", ""), ("<article><p>A&amp;B  c<br>d</p><p>e</article>", "A&B c d\ne"),
    ("<nav><a href=/>Menu</a></nav><article><h1>T</h1><p>Long <b>enough text to be one<p>Next &lt;b&gt;</article><footer>&copy; me</footer>", "T\nLong enough text to be one\nNext <b>"),
    ("<article><p>keep this text<script>var t='</p>'</script><style>p{}</style><!-- no > --></p><form><p>mail</p></form></article>", "keep this text"),
    ("<div class=cookie-notice><p>We use cookies</p></div><main><p>The story goes on and on here.</p></main><section class=comments><h3>Comments</h3><article class=comment><p>Nice one</p></article></section>", "The story goes on and on here."),
    ("<article><p>cut off in a tag <a href='x", "cut off in a tag"),
    ("<body><p>One two three four.</p><p>Five six seven.</p></body>", "One two three four.\nFive six seven."),
    ("<body><nav><ul><li><a href=x>Home</a></li></ul></nav><p>First paragraph of the text, with some words in it.</p><p>Second one.</p><footer>&copy; x</footer></body>", "First paragraph of the text, with some words in it.\nSecond one."),
    ("<h1>Head</h1><p>no body and no wrapper</p>", "Head\nno body and no wrapper"),
    ("<article><h1>Title of it</h1><p>R&amp<b>;lt;</b> and some words</p><p hidden>b</p><div style='x:y; display: none'><p>c d e f</p></div><p class='x hidden-y'>d text here</p></article>", "Title of it\nR&;lt; and some words\nd text here"),
    ("<article><p>text with <script>var a=\"<x y='\"</script>a script in it</p><p>and more of it</p></article>", "text with a script in it\nand more of it"),
    ("<article><ul><li>one item of some words<li>two of them <b>bold<li>three</ul><table><tr><td>cell<td>other cell</table></article>", "one item of some words\ntwo of them bold\nthree\ncell\nother cell"),
])
def test_html_cases(source, text):
    assert html_text.model().text(source) == text


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet="<>/=\"' abp!-&;", max_size=120))
def test_html_never_fails(source):
    html_text.model().text(source)


@pytest.mark.parametrize("source", ["</b>", "<div></span>", "<span class=a></p>", "<b class=x><li>", "<ul><li><i class=q>", "<p><b hidden>", "<title>a</title>", "<tr></td>"])
def test_html_parses_in_linear_time(source):
    import time

    took = []
    for n in (4000, 32000):
        began = time.process_time()
        html_text.parse(source * n)
        took.append(time.process_time() - began)
    assert took[1] < 24 * took[0] + 0.1  # 64 times, if it were quadratic


class Article(HTMLParser):
    """Text of a page's article, block by block, by a parser of its own: for pages whose only content is one <article>."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.inside, self.blocks = False, [""]

    def handle_starttag(self, tag, attrs):
        self.inside |= tag == "article"
        if tag == "br":
            self.blocks[-1] += " "
        elif tag in html_text.BLOCK:
            self.blocks.append("")

    def handle_endtag(self, tag):
        if tag in html_text.BLOCK:
            self.blocks.append("")
        self.inside &= tag != "article"

    def handle_data(self, data):
        if self.inside:
            self.blocks[-1] += data


def test_html_of_the_real_pages_equals_another_parser(spark, data):
    """Every row of the table, whose pages all have the article in one element; the model has never seen them."""
    pages = spark.read.parquet(f"{data}/pages.parquet")
    found = {r.page_id: (r.text, r.n_chars) for r in html_text.extract(pages, keep=["page_id"]).collect()}
    rows = pages.collect()
    assert len(found) == len(rows) > 20
    for r in rows:
        other = Article()
        other.feed(r.html)
        other.close()
        text = "\n".join(x for b in other.blocks if (x := " ".join(b.split())))
        assert found[r.page_id] == (text, len(text)) and text


def test_html_deep_and_table(spark):
    assert html_text.model().text("<div>" * 20000 + "x") in ("", "x")
    df = spark.createDataFrame([(1, "u", None, "clash"), (1, "u", "<article><p>some text</p></article>", "clash"), (None, None, "", None)], "page_id long, url string, html string, text string")
    assert sorted((r.url or "", r.text, r.n_chars) for r in html_text.extract(df, keep=["page_id", "url"]).collect()) == [("", "", 0), ("u", "", 0), ("u", "some text", 9)]
    assert html_text.extract(df.limit(0)).count() == 0
    odd = spark.createDataFrame([("<p>some text here</p>", 1, 2)], "`a.html` string, _html long, `x.y` long")
    assert [tuple(r) for r in html_text.extract(odd, html_col="a.html").collect()] == [(1, 2, "some text here", 14)]


# packed tokens


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 32), st.integers(1, 50), st.lists(st.lists(st.integers(0, 2**32 - 1), max_size=30), max_size=12), st.randoms())
def test_files_give_back_ids(bits, block, docs, rnd):
    docs = [np.array([x & ((1 << bits) - 1) for x in d], np.uint32) for d in docs]
    buffer = io.BytesIO()
    out = token_pack.TokenFileWriter(buffer, bits, block)
    for k, d in enumerate(docs):
        out.add(k if k % 3 else None, d)
    out.finish()
    buffer.seek(0)
    file = token_pack.TokenFile(buffer)
    for k in rnd.sample(range(len(docs)), len(docs)):
        assert file.document(k).tolist() == docs[k].tolist() and file.nulls[k] == (k % 3 == 0)
    assert file.ids(0, file.n_ids).tolist() == [x for d in docs for x in d.tolist()]


def test_bits():
    assert [token_pack.bits_for(n) for n in (1, 2, 3, 256, 257, 50257)] == [1, 1, 2, 8, 9, 16]


def test_chunks_encode_as_whole_texts(data):
    import pyarrow.parquet as pq

    texts = [t or "" for t in ODD_TEXTS] + pq.read_table(f"{data}/documents.parquet")["text"].to_pylist()
    bpe = token_pack.ByteBpe(BPE)
    assert [x.tolist() for x in bpe.encode(texts)] == [bpe.tokenizer.encode(t, add_special_tokens=False).ids for t in texts]


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet="ab é'.,1\n\t  　s", max_size=40))
def test_chunks_encode_as_whole_texts_with_any_spaces(text):
    bpe = token_pack.encoder(BPE)
    assert bpe.encode([text])[0].tolist() == bpe.tokenizer.encode(text, add_special_tokens=False).ids


def test_token_files_of_a_table(spark):
    df = odd_table(spark)
    _, manifest = token_pack.write_token_files(df, BPE, 2, files=3)
    got = sorted(token_pack.token_digests(spark, manifest).collect(), key=lambda r: r.start)
    ids = {(r.doc_id, r.start): r.ids for r in token_pack.read_token_files(spark, manifest).collect()}
    rows = sorted(((r.doc_id, r.text or "") for r in df.collect()), key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode()))
    start, bpe = 0, token_pack.encoder(BPE)
    for r, (doc, text) in zip(got, rows, strict=True):
        want = [*bpe.tokenizer.encode(text, add_special_tokens=False).ids, 2]
        assert (r.doc_id, r.start, r.n_tokens, r.ids_crc32) == (doc, start, len(want), zlib.crc32(np.array(want, "<u4").tobytes()))
        assert ids[doc, start] == want
        start += len(want)
    assert token_pack.token_digests(spark, token_pack.write_token_files(empty(spark), BPE, 2)[1]).count() == 0


# pieces


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="aeinrst THE.,▁ \n\té漢<>0x", max_size=40))
def test_agenda_equals_library(text):
    agenda = sentencepiece_agenda.encoder(PIECES)
    assert agenda.encode([text])[0].tolist() == agenda.library.encode(text)


def test_pieces_of_a_table(spark):
    agenda = sentencepiece_agenda.encoder(PIECES)
    rows = sentencepiece_agenda.encode_decode(odd_table(spark), PIECES).collect()
    texts = sorted(((r.doc_id, r.text or "") for r in odd_table(spark).collect()), key=str)
    want = sorted(((i, len(x), x, agenda.library.decode(x)) for i, t in texts for x in [agenda.library.encode(t)]), key=str)
    assert sorted((tuple(r) for r in rows), key=str) == want
    digest = sentencepiece_agenda.encode_decode(odd_table(spark), PIECES, digests=True).collect()
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    assert sorted((tuple(r) for r in digest), key=str) == sorted(((i, n, sha(",".join(map(str, x))), sha(d)) for i, n, x, d in want), key=str)
    assert sentencepiece_agenda.encode_decode(empty(spark), PIECES).count() == 0


def test_pieces_of_long_unspaced_chunks(spark):
    r = random.Random(4)
    han, digits = "".join(chr(r.randrange(0x4E00, 0x9FA5)) for _ in range(5000)), "".join(r.choice("0123456789") for _ in range(5000))
    texts = [han, digits, f"a {han}", f"a {digits}\n{digits[:3000]} b"]
    rows = sentencepiece_agenda.encode_decode(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), PIECES).collect()
    library = sentencepiece_agenda.encoder(PIECES).library
    assert {r.id: list(r.ids) for r in rows} == dict(enumerate(library.encode(texts)))


# languages


def test_language_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1
    profiles = langid.train(docs.filter(~held))
    assert all(len(r) <= langid.PROFILE for r in profiles.codes.reshape(1, -1)) or len(profiles.langs) == 4
    got = langid.predict(docs.filter(held), profiles, keep=["doc_id", "lang"]).collect()
    assert sum(r.lang == r.lang_pred for r in got) / len(got) > 0.98 and all(0 <= r.score <= 1 for r in got)


def test_profiles_equal_counting_in_python():
    from collections import Counter

    text = "Ab c, ab"
    want = Counter()
    for word in ("ab", "c", "ab"):
        padded = "_" + word + "_"
        for n in range(1, langid.MAX_N + 1):
            want.update(padded[i : i + n] for i in range(len(padded) - n + 1) if padded[i : i + n] != "_")
    codes, counts = langid.counted(langid.grams(text))
    # Two marks never meet: words are one mark apart.
    assert sorted(counts.tolist()) == sorted(v for k, v in want.items() if not (len(k) > 1 and set(k) == {"_"}))


def plain_grams(text):
    """Counts of n-grams by their hash, in plain Python: letters in lower case, words between gaps."""
    from collections import Counter

    counts = Counter()
    for word in "".join(c.lower()[0] if c.isalpha() else " " for c in text).split(" "):
        padded = [0, *map(ord, word), 0] if word else []
        for n in range(1, 5):
            for i in range(len(padded) - n + 1):
                gram = padded[i : i + n]
                if gram != [0]:
                    h = gram[0] + 1
                    for x in gram[1:]:
                        h = (h * int(langid._STEP) + x + 1) % 2**64
                    counts[h - 2**64 if h >= 2**63 else h] += 1
    return counts


def plain_top(counts, size):
    return [g for g, _ in sorted(counts.items(), key=lambda x: (-x[1], x[0]))[:size]]


@pytest.mark.parametrize("size", [400, 25])
def test_predictions_equal_plain_out_of_place_distances(spark, size):
    from collections import Counter

    train = {"el": ["Η γάτα κάθισε στο χαλί", "το σπίτι είναι μεγάλο"], "ru": ["Кошка сидит на столе", "это большой дом"], "zh": ["猫坐在垫子上", "这是一个大房子 房子"], "ja": ["猫がマットの上に座った", "これは大きな家です"], "vi": ["con mèo ngồi trên chiếu", "đây là ngôi nhà lớn"], "en": ["The cat sat on the mat", "this is a big house, the house"]}
    rows = [(k, t, lang) for k, (lang, t) in enumerate((lang, t) for lang, ts in train.items() for t in ts)]
    found = langid.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"), size=size)
    profiles = {}
    for lang, texts in train.items():
        counts = Counter()
        for t in texts:
            counts.update(plain_grams(t))
        profiles[lang] = {g: k for k, g in enumerate(plain_top(counts, size))}
    assert {x: found.ranks[i][found.ranks[i] >= 0].size for i, x in enumerate(found.langs)} == {x: len(p) for x, p in profiles.items()}
    for text in [t for ts in train.values() for t in ts] + ["η μεγάλη γάτα", "большая кошка", "大きな猫", "大房子", "ngôi nhà", "the house 42", "quite other words", "ÀÉ", "x" * 50, "12 34", ""]:
        doc = plain_top(plain_grams(text), size)
        far = {lang: sum(abs(p[g] - k) if g in p else size for k, g in enumerate(doc)) for lang, p in profiles.items()}
        best = min(sorted(far), key=far.get)
        want = (best, 1 - far[best] / (size * len(doc))) if doc else ("und", 0.0)
        got = found.predict(text)
        assert got[0] == want[0] and got[1] == pytest.approx(want[1])
    assert [found.predict(t)[0] for t in ("猫がマット", "坐在垫子上", "большая кошка", "μεγάλη γάτα")] == ["ja", "zh", "ru", "el"]


def test_only_the_commonest_languages_are_learned(spark):
    rows = [(k, "some text", f"l{k % 9}" if k % 2 else "en") for k in range(60)]
    assert langid.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"), most_langs=3).langs == ["en", "l1", "l3"]
    odd = spark.createDataFrame([("some text", 1)], "`the.text` string, _langid_text long")
    assert [x[0] for x in langid.predict(odd, langid.train(spark.createDataFrame(rows, "doc_id long, text string, lang string")), text_col="the.text", keep=["_langid_text"]).collect()] == [1]


def test_languages_of_odd_rows(spark):
    train = spark.createDataFrame([(k, "the cat sat on the mat" if k % 2 else "le chat est sur la table", "r", "x", "y", "en" if k % 2 else "fr") for k in range(40)], DOC)
    profiles = langid.train(train)
    got = langid.predict(odd_table(spark), profiles).collect()
    assert len(got) == len(ODD_TEXTS) + 3 and {"doc_id", "text", "row", "n_lines", "lang", "lang_pred", "score"} == set(got[0].asDict())
    assert {r.lang_pred for r in got if not r.text or not any(c.isalpha() for c in r.text)} == {"und"}
    assert {r.lang_pred for r in got if r.text == "other"} <= {"en", "fr"}
    none = langid.train(empty(spark))
    assert {(r.lang_pred, r.score) for r in langid.predict(odd_table(spark), none).collect()} == {("und", 0.0)}
    assert langid.predict(empty(spark), profiles).count() == 0
