"""Periodic runs, phrase collocations and HTML extraction against brute force
and hand-made pages, and on odd tables."""

import hashlib
import html
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from matchlake.llm import collocations, extraction, periodic, queries

SMALL = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long, score double, runs string, n long"
SPACE = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet")


@pytest.fixture
def table_of(spark, tmp_path):
    """Writes one table to a folder of its own and returns the folder."""
    def put(name, df):
        df.write.parquet(f"{tmp_path}/{name}.parquet")
        return str(tmp_path)
    return put


# -- periodic runs ---------------------------------------------------------


def all_runs(words):
    """Every run by definition: for each lag, every stretch on which it holds."""
    found = []
    for q in range(1, len(words) // 4 + 1):
        i = 0
        while i < len(words) - q:
            j = i
            while j < len(words) - q and words[j] == words[j + q]:
                j += 1
            run = words[i:j + q]
            if j > i and len(run) >= max(6, 4 * q) and not any(run[d:] == run[:-d] for d in range(1, q)):
                found.append((i, len(run), q))
            i = j + 1
    return sorted(found, key=lambda r: (r[0], r[2]))


def test_runs_of_random_words():
    rng = random.Random(5)
    for _ in range(800):
        texts = []
        for _ in range(3):
            words, kinds = [], rng.randint(1, 4)
            while len(words) < rng.randint(0, 60):
                words += [rng.choice("abcd"[:kinds]) for _ in range(rng.randint(1, 7))] * rng.randint(1, 7)
                words += rng.choice([[], [], ["x"], ["y", "z"]])
            texts.append(words)
        _, runs = periodic.word_runs([" ".join(w).encode() for w in texts])
        assert runs == [all_runs(w) for w in texts]


def expected_runs(doc_id, text):
    """The row of the contract, with plain lists."""
    words = SPACE.findall(text or "")
    h, n = zlib.crc32(("" if doc_id is None else str(doc_id)).encode()), len(SPACE.findall(text or ""))
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = all_runs(words)
    dropped = {i for s, length, q in runs for i in range(s + q, s + length)}
    best = (None,) * 4
    for s, length, q in runs:
        if best[0] is None or length * best[2] > best[1] * q:
            best = (s, length, q, 1000 * length // q)
    lines = "".join(f"{s},{length},{q}\n" for s, length, q in runs)
    kept = " ".join(w for i, w in enumerate(words) if i not in dropped)
    return (doc_id, len(runs), *best, *(hashlib.sha256(x.encode()).hexdigest() for x in (lines, kept)))


RUN_COLUMNS = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]


def test_op11_equals_brute_force(spark, documents):
    rows = [r for r in documents.select("doc_id", "text").collect() if len(r["text"] or "") < 6000]
    got = {r["doc_id"]: tuple(r) for r in queries.QUERIES["op11_periodic_runs"](spark, SMALL).select(*RUN_COLUMNS).collect()}
    assert len(got) == documents.count()
    for r in rows:
        assert got[r["doc_id"]] == expected_runs(r["doc_id"], r["text"])
    assert any(got[r["doc_id"]][1] for r in rows)


def test_op11_on_odd_documents(spark, table_of):
    texts = [None, "", " \n", "a", "a a a a a a", "a a a a a", "a b a b a b a b", "é é " * 9, "x\x1cy " * 7,
             "one two three " * 2000, "a b " * 5 + "c " + "d e f " * 4, "a a a a a a b " * 5, "w " * 50_000]
    data = [(i, t, "en", "s", 1, 0.5, "r", 7) for i, t in enumerate(texts)]
    data += [data[6], (None, "a b a b a b a b", None, None, None, None, None, None)]
    sf = table_of("documents", spark.createDataFrame(data, DOCS))
    got = queries.QUERIES["op11_periodic_runs"](spark, sf).select(*RUN_COLUMNS).collect()
    key = lambda r: repr(tuple(r))
    small = [d for d in data if d[0] not in (9, 12)]
    assert sorted(map(key, (r for r in got if r["doc_id"] not in (9, 12)))) == sorted(
        key(expected_runs(d[0], d[1])) for d in small)
    long = {r["doc_id"]: r for r in got}
    assert (long[9]["period"], long[9]["length"]) == (3, 6000)
    assert long[12]["n_runs"] == 1
    empty = table_of("empty/documents", spark.createDataFrame([], DOCS)) + "/empty"
    assert queries.QUERIES["op11_periodic_runs"](spark, empty).count() == 0


# -- phrase collocations ---------------------------------------------------


def collocations_by_hand(rows, longest=5, least=100, top=2000):
    """The contract over (text, lang) rows, with plain counters."""
    counts, totals = defaultdict(Counter), Counter()
    small = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(small)):
            words = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(words)
            for n in range(1, longest + 1):
                counts[lang].update(tuple(words[i:i + n]) for i in range(len(words) - n + 1))
    out = []
    for lang, f in counts.items():
        often = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        hidden = set()
        for p, a in often.items():
            for i in range(len(p)):
                for j in range(i + 2, len(p) + 1):
                    if j - i < len(p) and a >= often.get(p[i:j], 1 << 60):
                        hidden.add(p[i:j])
        found = []
        for p, a in often.items():
            score, k = min((1000 * a * totals[lang] // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
            if p not in hidden:
                found.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, totals[lang], -score))
    return sorted(out)


PHRASE_COLUMNS = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]


def test_op12_equals_counters(spark, documents):
    rows = [(r["text"], r["lang"]) for r in documents.collect()]
    want = collocations_by_hand(rows)
    got = queries.QUERIES["op12_phrase_collocations"](spark, SMALL).select(*PHRASE_COLUMNS)
    assert [t for _, t in got.dtypes] == ["string", "bigint", "string"] + ["bigint"] * 5
    assert sorted(tuple(r) for r in got.collect()) == want
    assert len(want) > 20


@pytest.mark.parametrize("part_bytes", [1 << 22, 300])
def test_collocations_of_few_words(spark, part_bytes):
    rng = random.Random(part_bytes)
    texts = []
    for i in range(120):
        words = [rng.choice(["a", "B", "c", "\u00e9", "new", "york", "x\x1cy", "the"]) for _ in range(rng.randint(0, 60))]
        text = "".join(w + rng.choice([" ", "  ", "\t", " ", ". ", "\n", ",", " a "]) for w in words)
        texts.append((text + " new york city", rng.choice(["en", None, "", "de"])))
    texts += [(None, "en"), ("", None), ("   ...", "xx"), texts[0], texts[0], ("ab " * 300, "en"), ("z", "en")]
    assert list(collocations.pieces(b"a.bcdef.g.h", 4)) == [b"a.", b"bcdef.", b"g.h"]
    df = spark.createDataFrame([(t, lang, "p", 1, 2) for t, lang in texts],
                               "text string, lang string, phrase string, a long, k long").repartition(5)
    for longest, least, top in ((5, 10, 2000), (3, 4, 7), (2, 1, 50)):
        got = collocations.collocations(df, longest=longest, least=least, top=top,
                                        part_bytes=part_bytes).select(*PHRASE_COLUMNS).collect()
        assert sorted(tuple(r) for r in got) == collocations_by_hand(texts, longest, least, top)
    assert collocations.collocations(df.limit(0)).count() == 0


def test_bit_table_clashes_keep_counts(spark):
    """A table with far too few bits lets more through, and changes nothing."""
    rng = random.Random(8)
    texts = [(" ".join(rng.choice("abcdefgh") for _ in range(200)), "en") for _ in range(10)]
    df = spark.createDataFrame(texts, "text string, lang string")
    got = collocations.collocations(df, least=12, bits=4).select(*PHRASE_COLUMNS).collect()
    assert sorted(tuple(r) for r in got) == collocations_by_hand(texts, least=12)


def test_scores_beyond_64_bits(spark):
    rng = random.Random(2)
    rows = []
    for _ in range(300):
        n = rng.randint(10 ** 9, 10 ** 15)
        left, right = rng.randint(10 ** 6, n // 3), rng.randint(10 ** 6, n // 3)
        rows.append((rng.randint(1, min(left, right)), n, left, right))
    df = spark.createDataFrame(rows, "a long, n long, l long, r long")
    got = df.select("a", "n", "l", "r", collocations.exact_score(*map(F.col, "anlr")).alias("s")).collect()
    assert all(r["s"] == 1000 * r["a"] * r["n"] // (r["l"] * r["r"]) for r in got)


# -- HTML extraction -------------------------------------------------------


def article_of(page):
    """The article of a page of the test tables, read by its known form."""
    inner = re.search(r"<article>(.*?)(</article>|$)", page or "", re.S)
    blocks = re.split(r"</?(?:p|h1)>", inner[1].replace("<br>", " ").replace("<b>", "").replace("</b>", "")) if inner else []
    lines = [" ".join(html.unescape(b).split()) for b in blocks]
    return "\n".join(x for x in lines if x)


def test_op13_equals_articles(spark):
    pages = {r["page_id"]: r for r in spark.read.parquet(f"{SMALL}/pages.parquet").collect()}
    got = queries.QUERIES["op13_main_text"](spark, SMALL).collect()
    assert sorted(r["page_id"] for r in got) == sorted(pages)
    for r in got:
        want = article_of(pages[r["page_id"]]["html"])
        assert (r["url"], r["text"], r["n_chars"]) == (pages[r["page_id"]]["url"], want, len(want))


FULL = """<!doctype html><html><head><title>Shop &amp; news</title><script>if (a < b) document.write("<p>no</p>")</script>
<style>p > b {color: red}</style></head><body class="has-sidebar comments-open"><div id=cookie-banner><p>We use cookies, as you know. Accept?</p>
<button>OK</button></div><header><a href=/>Home</a><form><input name=q><label>Search</label></form></header>
<div class="page-with-sidebar"><nav><ul><li><a href=/a>A</a><li><a href=/b>B</a></ul></nav><main>
<article><header><h1>A&nbsp;title &lt;3</h1><p class=byline>By someone</p></header>
<p>First   paragraph, with <a href="/x>y">a link</a> and <b>bold</b>text.<br>Next line.
<p>Second one &mdash; caf&eacute; &#x1F600;, it's <i title=it's>fine</i>.<!-- <p>not this</p> --></p>
<div class=ad><p>Buy this now, it is a very good thing to have, and cheap.</p></div>
<ul><li>a point</li><li>another point</li></ul><table><tr><td>cell one<td>cell two</table>
<pre>code  here
  too</pre><blockquote>Quoted words.</blockquote><aside>Aside words that read like a text.</aside>
<noscript>Turn on scripts.</noscript><p hidden>secret</p><p style="display: none">secret</p>
<section id=comments><h2>2 comments</h2><article class=comment><p>I liked this text, it was good. Thank you.</p></article></section>
</article></main><div class="widget sidebar"><p>Read also these fine stories, they are many.</p></div></div>
<footer><p>All rights reserved, since long ago.</p></footer></body></html>"""
FULL_TEXT = """A title <3
First paragraph, with a link and boldtext. Next line.
Second one \u2014 caf\u00e9 \U0001f600, it's fine.
a point
another point
cell one
cell two
code here too
Quoted words."""


def text_of(page, odds=None):
    return "\n".join(b.text for b, content in extraction.labelled_blocks(page, odds or {}) if content)


def test_full_page():
    assert text_of(FULL) == FULL_TEXT


@pytest.mark.parametrize("page, want", [
    ("<form id=aspnet><nav>Menu</nav><main><p>Words of the text, all of them.</p></main></form>", "Words of the text, all of them."),
    ("<article><p>One.</p><form><p>Sign up for our letter, get it all, every day.</p></form><p>Two.</p></article>", "One.\nTwo."),
    ("<div id=main-content><p>One.</p></div><div class=userComments><p>Nice, thanks for it. Really.</p></div>", "One."),
    ("<body class='sidebar comments'><div class='post comments-open'><p>Kept words, a few.</p></div><aside>No.</aside>", ""),
    ("<main><div class='article with-sidebar'><p>Kept.</p></div><div class='sidebar'><p>No.</p></div></main>", "Kept."),
    ("<div class=notice>We moved.</div><article class=post><p>A<sup>2</sup> b</p><p><br></p></article><div role=alert>No.</div>", "A2 b"),
    ("<article>loose <em>text</em><div>block</div>tail</article>", "loose text\nblock\ntail"),
    ("<article><h2>Head</h2><ul><li>a<ul><li>b</ul><li>c</ul><dl><dt>t<dd>d</dl></article>", "Head\na\nb\nc\nt\nd")])
def test_page_forms(page, want):
    assert text_of(page) == want


def test_page_without_telling_elements(spark):
    """The learned looks and the cut find the text where no element names it."""
    rng = random.Random(4)
    sentence = lambda: ", ".join(" ".join("word" * rng.randint(1, 2) for _ in range(7)) for _ in range(3)) + ". And more."
    told = "<nav><li><a href=/>Home</a></li><li><a href=/>News</a></li></nav><article>" + "".join(
        f"<p>{sentence()}</p>" for _ in range(6)) + "</article><footer><a href=/>Imprint</a></footer>"
    odds = extraction.learned(spark.createDataFrame([(told,)] * 20 + [(None,), ("",)], "html string"))
    first, second = sentence(), sentence()
    page = f"<div><div><a href=/>Home</a></div><div><a href=/>News</a></div></div><div><p>{first}</p><p>Short.</p><p>{second}</p></div>" \
           "<div><div><a href=/>Imprint</a></div></div>"
    assert text_of(page, odds) == f"{first}\nShort.\n{second}"
    labels = [side for _, side in extraction.labelled_blocks(page, odds)]
    assert labels == [False, False, True, True, True, False]


def test_minimum_cut_equals_all_cuts():
    rng = random.Random(6)
    for _ in range(400):
        n = rng.randint(1, 8)
        capacity = [rng.randint(-6, 6) for _ in range(n)]
        edges = [(a, b, rng.randint(0, 5)) for a in range(n) for b in range(a + 1, n) if rng.random() < 0.5]

        def value(cut):
            return sum(max(0, c) if not cut >> i & 1 else max(0, -c) for i, c in enumerate(capacity)) \
                + sum(c for a, b, c in edges if (cut >> a & 1) != (cut >> b & 1))

        best = min(range(1 << n), key=lambda cut: (value(cut), cut.bit_count()))
        assert extraction.minimum_cut(capacity, edges) == [bool(best >> i & 1) for i in range(n)]


def test_op13_on_odd_pages(spark, table_of):
    article = "<article><p>Some words, and more of them.</p></article>"
    pages = {0: (None, ""), 1: ("", ""), 2: ("   ", ""), 3: ("<", ""), 4: (article, "Some words, and more of them."),
             5: (article[:40], "Some words, and more of them"), 6: ("<article><p>x <!-- never closed <p>y", "x"),
             7: ("<article><script>var a = '<p>no</p>'", ""), 8: ("<article><p>a</b></p></div>b &am", "a\nb &am"),
             9: ("<ARTICLE><P CLASS='x' ID=y>Up<BR/>per &AMP; &copy &#0; &#xD800;</ARTICLE>", "Up per & \u00a9 \ufffd \ufffd"),
             10: ("<article>" + "<div>" * 3000 + "deep words" + "</div>" * 3000, "deep words"),
             11: ("<article>" + "<p>a word or two</p>" * 20_000, "\n".join(["a word or two"] * 20_000)),
             12: ("<article><p>a &lt;b&gt; <3 x<y\u3000z\u00a0q</p>", "a <b> <3 x"), 13: ("<nav>only a menu</nav>", "")}
    data = [(i, f"u{i}", h, "text", 1, 2, 3) for i, (h, _) in pages.items()]
    data += [data[4], (None, None, article, None, None, None, None)]
    df = spark.createDataFrame(data, "page_id long, url string, html string, text string, n_chars long, side int, bin int")
    got = queries.QUERIES["op13_main_text"](spark, table_of("pages", df)).collect()
    assert len(got) == len(data)
    for r in got:
        want = pages[4 if r["page_id"] is None else r["page_id"]][1]
        assert (r["text"], r["n_chars"]) == (want, len(want)), r["page_id"]
    empty = table_of("empty/pages", df.limit(0)) + "/empty"
    assert queries.QUERIES["op13_main_text"](spark, empty).count() == 0
