"""Each operator against brute force, a library, an exact round trip or
held-out accuracy, and on odd tables: nulls, empty and long texts, repeated
rows, empty tables, extra columns with clashing names."""

import math
import random
import zlib
from collections import Counter

import duckdb
import numpy as np

import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from matchlake.llm import (
    classlm,
    decontamination,
    language,
    mixing,
    neighbours,
    quality,
    queries,
    simhash,
    token_counts,
    toxicity,
    warc,
)
from matchlake.llm.batches import plain_words, words_of

SMALL = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long, score double, word string, n long"
LONG = "a long tale of words, " * 60_000


def remainder(doc_id, mod):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % mod


def odd_docs(spark, rows=None):
    texts = [None, "", " \n", "!!! 123", "one", "One two", "one two three four", "one  TWO three four",
             "x" * 5000, "é ñ ü 日本語 😀", "same text here and there", "same text here and there", LONG] if rows is None else rows
    data = [(i, t, None if i % 4 == 0 else "en", "s", 1, 0.5, "w", 7) for i, t in enumerate(texts)]
    if rows is None:
        data += [data[6], (None, "one two three four", "en", None, None, None, None, None)]
    return spark.createDataFrame(data, DOCS)


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet")


@pytest.fixture(scope="module")
def labels(spark):
    return spark.read.parquet(f"{SMALL}/labels.parquet")


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_twins(spark, name):
    c = duckdb.connect()
    for t in ("documents", "labels", "pages"):
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SMALL}/{t}.parquet'")
    got = queries.QUERIES[name](spark, SMALL)
    want = c.sql(queries.SQL[name])
    assert sorted(got.columns) == sorted(want.columns)
    rows = sorted(map(repr, (tuple(r) for r in got.select(*want.columns).collect())))
    assert rows == sorted(map(repr, want.fetchall()))


# -- token counts ----------------------------------------------------------


def test_token_counts_equal_library(spark):
    library = Tokenizer.from_file(queries.TOKENIZER)
    rng = random.Random(3)
    bits = ["'s", "'re", " 't", "''ve", "a", "the", "  ", "\n\n", "\t", " ", "é", "ción", "1", "!!", "<|endoftext|>",
            "<|endof", "日本", "😀", "'r", "l", "don't", "=====", "　", "Ⅷ"]
    texts = ["".join(rng.choice(bits) for _ in range(rng.randint(0, 40))) for _ in range(3000)]
    texts += ["a" * 5000, " " * 3000, "\n" * 2500 + "x", "'" * 2100, "ab'" * 2000, " a" * 3000 + "<|endoftext|>"]
    got = token_counts.count_tokens(pa.array(texts), queries.TOKENIZER)
    want = [len(e.ids) for e in library.encode_batch(texts, add_special_tokens=False)]
    assert got.tolist() == want
    odd = token_counts.token_counts(odd_docs(spark), queries.TOKENIZER, limit=2).collect()
    for r in odd:
        n = len(library.encode(r["text"] or "", add_special_tokens=False).ids)
        assert (r["n_tokens"], r["n_bytes"], r["over_limit"]) == (n, len((r["text"] or "").encode()), n > 2)


def test_table_bound_keeps_counts(monkeypatch):
    texts = pa.array(["the quick brown fox's " * 300, "zażółć gęślą jaźń " * 100, "x=1;" * 500])
    want = token_counts.count_tokens(texts, queries.TOKENIZER)
    small = token_counts.Transducer(queries.TOKENIZER)
    monkeypatch.setattr(token_counts, "MAX_CELLS", 64 * 100)
    raw = [t.encode() for t in texts.to_pylist()]
    offsets = np.append(0, np.cumsum([len(r) for r in raw]))
    assert small.count(np.frombuffer(b"".join(raw), np.uint8), offsets).tolist() == want.tolist()


# -- WARC ------------------------------------------------------------------


def test_warc_payloads_with_records_inside(spark):
    fake = "WARC/1.0\r\nWARC-Type: response\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"
    html = [fake * 3, "x" * 200 + fake + "WARC/1.0\r\n", None, "", "short", "short", "y" * 150, "y" * 150, "y" * 150,
            "é" * 50, "é" * 50, "é" * 49, "WARC/1.0\r\nContent-Length: 99999999\r\n\r\n" * 4]
    pages = spark.createDataFrame([(i, "http://x/\r\n%d" % i, h, "z") for i, h in enumerate(html)],
                                  "page_id long, url string, html string, payload string")
    rows = {r["page_id"]: r for r in warc.archive_round_trip(pages).collect()}
    assert sorted(rows) == list(range(len(html)))
    for i, h in enumerate(html):
        body = (h or "").encode()
        first = min(k for k, x in enumerate(html) if (x or "") == (h or ""))
        revisit = len(body) >= 100 and first != i
        assert rows[i]["payload_digest"] == warc.hashlib.sha256(body).hexdigest()
        assert rows[i]["payload_bytes"] == len(body)
        assert (rows[i]["record_type"], rows[i]["refers_to"]) == (("revisit", first) if revisit else ("response", None))
    assert warc.archive_round_trip(pages.where("false")).count() == 0


def test_warc_long_headers():
    def record(url, body):
        return (f"WARC/1.0\r\nWARC-Type: response\r\nWARC-Target-URI: {url}\r\nContent-Length: {len(body)}"
                f"\r\n\r\n{body}\r\n\r\n").encode()

    data = record("a", "x") + record("http://x/" + "u" * 300_000, "WARC/1.0\r\n" * 3) + record("b", "z")
    found = sorted(warc.block_candidates(data, 0, len(data)))
    marks = warc.reachable(np.array([c[0] for c in found]), np.array([c[1] for c in found]))
    assert [c[4] for c, m in zip(found, marks, strict=True) if m] == [1, 30, 1]


def test_warc_long_urls_and_archives_by_bytes(spark, tmp_path):
    rows = [(i, "http://x/" + "u" * (400_000 if i == 3 else 5) + str(i), f"{i:04d}" * (50_000 if i % 5 == 0 else 10))
            for i in range(40)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1)
    path = str(tmp_path / "warc")
    warc.write_archives(pages, path, per_file=100, compression="none", file_bytes=500_000)
    assert all(f.stat().st_size <= 500_000 for f in (tmp_path / "warc").glob("part-*"))
    read = {r["page_id"]: r for r in warc.read_archives(spark, path).collect()}
    assert {i: (r["url"], r["payload_bytes"]) for i, r in read.items()} == {i: (u, len(h)) for i, u, h in rows}


def test_pointer_jumping():
    begin, following = np.array([0, 5, 10, 12, 20]), np.array([10, 12, 20, 20, 33])
    assert warc.reachable(begin, following).tolist() == [True, False, True, False, True]
    assert warc.reachable(np.array([3, 9]), np.array([9, 12])).tolist() == [False, False]


# -- learned scores --------------------------------------------------------


@pytest.mark.parametrize("name, label, cut, least", [("op4_quality_network", "quality", 0.3, 0.9),
                                                     ("op6_toxicity_instances", "toxic", 0.5, 0.9)])
def test_held_out_accuracy(spark, name, label, cut, least):
    sf = "/root/testdata/sf0.01"
    want = {r["doc_id"]: r[label] for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    rows = queries.QUERIES[name](spark, sf).collect()
    held = [r for r in rows if r["held_out"] and r["doc_id"] in want]
    assert all(r["held_out"] == (remainder(r["doc_id"], 5) == 0) and 0 <= r["score"] <= 1
               and r["predicted"] == int(r["score"] >= cut) for r in rows)
    assert sum(r["predicted"] == want[r["doc_id"]] for r in held) / len(held) >= least


def test_learned_scores_of_odd_tables(spark):
    docs = odd_docs(spark)
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    some = spark.createDataFrame([(i, i % 2, i % 2) for i in range(13)] + [(1, None, 1), (None, 1, 1), (6, 7, 0)],
                                 "doc_id long, quality int, toxic int")
    for table in (none, some):
        for model, score in ((quality.fitted(docs, table), quality.quality), (toxicity.fitted(docs, table), toxicity.toxicity)):
            rows = docs.select(score("text", model).alias("s")).collect()
            assert len(rows) == 15 and all(0 <= r["s"] <= 1 for r in rows)
    model = toxicity.SentenceModel({b"vile": 9.0}, -4.0)
    row = docs.sparkSession.createDataFrame([("Fine. So vile! Good",)], "text string") \
        .select(toxicity.toxicity("text", model).alias("p"), toxicity.offending("text", model).alias("o")).first()
    sentence = [1 / (1 + math.exp(4)), 1 / (1 + math.exp(-5)), 1 / (1 + math.exp(4))]
    assert row["p"] == pytest.approx(1 - math.prod(1 - p for p in sentence))
    assert [(o["begin"], o["sentence"]) for o in row["o"]] == [(5, "So vile!")]


def test_toxicity_fit_follows_the_bag_likelihood():
    """Three steps of the fit against plain loops, with texts that bring no word."""
    rng = random.Random(5)
    vocabulary = [f"w{k}rd{k}" for k in range(12)]
    texts = [" " * (2 << 20), None, ""]
    texts += [" ".join(rng.choice(vocabulary + ["vile"] * (6 * (i % 2))) + rng.choice(["", "", "."]) for _ in range(30))
              for i in range(60)]
    target = np.array([0, 1, 0] + [i % 2 for i in range(60)])
    weight = np.array([rng.choice([1.0, 2.5]) for _ in texts])
    model = toxicity.fit(pa.array(texts), target, weight, rounds=3)

    bags = []
    for text in texts:
        sentences = []
        for part in (text or "").split("."):
            words = part.split()
            words = [w for k, w in enumerate(words) if not k or words[k - 1] != w]
            if words:
                sentences.append([f for w in words for f in toxicity.features(w.encode())])
        bags.append(sentences)
    in_docs = Counter(f for bag in bags for f in {f for s in bag for f in s})
    theta = {f: 0.0 for f, n in in_docs.items() if n >= toxicity.MIN_DOCS}
    share = (weight * target).sum() / weight.sum()
    bias = math.log(share / max(1.0, sum(map(len, bags)) / len(texts)))
    moments = {f: [0.0, 0.0] for f in [*theta, None]}
    for step in range(1, 4):
        slope = {f: toxicity.PENALTY / len(texts) * v for f, v in theta.items()} | {None: 0.0}
        for bag, y, w in zip(bags, target, weight / weight.sum()):
            p = [1 / (1 + math.exp(-bias - sum(theta.get(f, 0.0) for f in s))) for s in bag]
            clean = math.prod(1 - x for x in p)
            blame = (-clean / max(1 - clean, 1e-12) if y else 1.0) * w
            for s, x in zip(bag, p):
                for f in [*(f for f in s if f in theta), None]:
                    slope[f] += blame * x
        for f, g in slope.items():
            m = moments[f]
            m[:] = 0.9 * m[0] + 0.1 * g, 0.99 * m[1] + 0.01 * g * g
            move = toxicity.RATE * (m[0] / (1 - 0.9 ** step)) / (math.sqrt(m[1] / (1 - 0.99 ** step)) + 1e-9)
            if f is None:
                bias -= move
            else:
                theta[f] = max(0.0, theta[f] - move)
    kept = {f: v for f, v in theta.items() if v >= toxicity.SMALLEST}
    assert kept and model.weights == pytest.approx(kept, rel=1e-6)
    assert model.bias == pytest.approx(bias, rel=1e-6)


def test_toxicity_does_not_depend_on_the_neighbours_of_a_row():
    model = toxicity.SentenceModel({b"vile": 9.0, b"end": 2.0}, -4.0)
    texts = ["so vile", "end", "", "vile", None, "vile vile", "a. end"]
    alone = [toxicity.score_texts(pa.array([t], pa.string()), model)[0] for t in texts]
    assert toxicity.score_texts(pa.array(texts), model) == pytest.approx(alone, rel=1e-12)


def test_long_texts_in_parts_score_alike():
    text = pa.array(["Some words here. And VILE things!! | " * 3000])
    model = toxicity.SentenceModel({b"vile": 3.0}, -9.0)
    assert toxicity.score_texts(text, model, 1000) == pytest.approx(toxicity.score_texts(text, model))
    net = quality.ConvModel.start(np.random.default_rng(0))
    net.dense = np.random.default_rng(1).normal(size=2 * quality.FILTERS).astype(np.float32)
    assert quality.score_texts(text, net, 1024) == pytest.approx(quality.score_texts(text, net, 1 << 22), abs=1e-5)


# -- language --------------------------------------------------------------


def test_forward_sums_all_segmentations():
    model = language.fit({"a": Counter(language.words_in("the other there weather")),
                          "b": Counter(language.words_in("das wetter der anderen"))}, queries.PIECES)
    pieces = language.vocabulary(queries.PIECES)

    def brute(word, j):
        return 1.0 if not word else sum(
            (model.probability[pieces[word[:k]], j] if word[:k] in pieces else language.STRAY if k == 1 else 0.0)
            * brute(word[k:], j) for k in range(1, min(len(word), language.longest_piece(queries.PIECES)) + 1))

    words = ["▁weather", "▁日本x", "▁q", "ander"]
    for at, part in language.lattices(words, queries.PIECES):
        got = part.log_sums(model.probability)
        for i, w in enumerate(at):
            assert got[i] == pytest.approx([math.log(brute(words[w], j)) for j in range(2)])


def test_long_words_carry_the_recursion_over(monkeypatch):
    model = language.fit({"a": Counter(language.words_in("the other there weather international")),
                          "b": Counter(language.words_in("das wetter der anderen"))}, queries.PIECES)
    pieces = language.vocabulary(queries.PIECES)
    longest = language.longest_piece(queries.PIECES)
    assert longest == max(map(len, pieces)) > 8
    word = "▁" + "internationalweathertheotherदेवनागरी" * 2
    for j in range(2):
        sums = [1.0]
        for k in range(1, len(word) + 1):
            sums.append(sum(sums[k - n] * (model.probability[pieces[word[k - n:k]], j] if word[k - n:k] in pieces
                                           else language.STRAY if n == 1 else 0.0) for n in range(1, min(k, longest) + 1)))
        for block in (language.BLOCK, 7):
            monkeypatch.setattr(language, "BLOCK", block)
            got = language.long_word_sums(word, model.probability, queries.PIECES)
            assert got[j] == pytest.approx(math.log(sums[-1]), rel=1e-9)
    scores = language.WordScores(model)
    places = scores.add(["▁the", word, word])
    assert scores.rows[places][1:] == pytest.approx(np.tile(got, (2, 1)))


def test_words_keep_combining_marks():
    assert language.words_in("Cafe\u0301 au lait x2y \u0301") == ["▁cafe\u0301", "▁au", "▁lait", "▁x", "▁y"]
    assert language.words_in("हिन्दी भाषा") == ["▁हिन्दी", "▁भाषा"]
    assert language.words_in("١٢ ⅷ ½ a_b") == ["▁a", "▁b"]
    assert "".join(language.parts_of("x" * 50 + " y", 10)) == "x" * 50 + " y"
    assert list(language.parts_of("x" * 50, 10)) == ["x" * 50, ""]


def test_more_than_500_languages(spark):
    rows = [(i, f"word{chr(97 + i % 26)} and text {i}", f"l{i % 600}") for i in range(1300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    counts = language.sample_counts(docs, per_language=2)
    assert len(counts) == docs.where(F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(4)) != 2) \
        .select("lang").distinct().count() > 500


def test_language_of_odd_tables_and_accuracy(spark, documents):
    rows = queries.QUERIES["op8_language"](spark, "/root/testdata/sf0.01").collect()
    lang = {r["doc_id"]: r["lang"] for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()}
    held = [r for r in rows if r["held_out"]]
    assert sum(r["lang_pred"] == lang[r["doc_id"]] for r in held) / len(held) >= 0.97
    docs = odd_docs(spark)
    model = language.fitted(docs, queries.PIECES)
    for r in docs.select("text", language.language("text", model).alias("f")).collect():
        letters = any(c.isalpha() for c in r["text"] or "")
        assert r["f"]["lang_pred"] == ("en" if letters else "und")
    empty = language.fitted(docs.where("false"), queries.PIECES)
    assert docs.select(language.language("text", empty)["lang_pred"]).distinct().collect()[0][0] == "und"


# -- language model --------------------------------------------------------


def test_language_stage_asks_the_model(spark, documents):
    strange = [(-1, "Все люди рождаются свободными и равными в своем достоинстве и правах"),
               (-2, "wxq zkjv pqzt xvbk jjqw zzxk vvqp kxwj qqzv xkcd wvut"), (-3, "123 !?"), (-4, None)]
    odd = documents.limit(0).unionByName(spark.createDataFrame(strange, "doc_id long, text string"),
                                         allowMissingColumns=True).select(documents.columns)
    kept = corpus_pipeline.drop_unknown_language(spark, documents.unionByName(odd), SMALL)
    assert {r[0] for r in kept.select("doc_id").collect()} == \
        {r[0] for r in documents.where(F.col("text").rlike("\\p{L}")).select("doc_id").collect()}
    unlabelled = documents.unionByName(odd).withColumn("lang", F.lit(None).cast("string"))
    kept = corpus_pipeline.drop_unknown_language(spark, unlabelled, SMALL)
    assert kept.count() == unlabelled.where(F.col("text").rlike("\\p{L}")).count() > 2


def test_exchange_reaches_a_local_optimum():
    rng = np.random.default_rng(0)
    pairs = rng.integers(0, 6, (30, 30))
    pairs[:15, 15:] += 30
    of = classlm.exchange_classes(pairs, 4)
    best = classlm.likelihood(pairs, of, 4)
    assert best > classlm.likelihood(pairs, np.arange(30) % 4, 4)
    for w in range(30):
        for k in range(4):
            moved = of.copy()
            moved[w] = k
            assert classlm.likelihood(pairs, moved, 4) <= best + 1e-6


def test_language_model_counts_and_gain(spark, documents):
    for docs in (documents, odd_docs(spark)):
        data = docs.select("doc_id", "text").collect()
        tokens = [(r["doc_id"], [*words_of((r["text"] or "").encode()), b""]) for r in data]
        counts = Counter(w for i, ws in tokens if remainder(i, 10) for w in ws)
        n, v = sum(counts.values()), len(counts)
        want = sorted((str(i), len(ws), sum(counts[w] > 0 for w in ws), n,
                       round(sum(math.log10((counts[w] + 0.1) / (n + 0.1 * (v + 1))) for w in ws), 4)) for i, ws in tokens)
        rows = classlm.perplexity(docs).collect()
        assert want == sorted((str(r["doc_id"]), r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 4))
                              for r in rows)
    assert classlm.perplexity(documents.where("false")).count() == 0
    rows = classlm.perplexity(documents).where("held_out").collect()
    assert sum(r["score"] for r in rows) > sum(r["base_score"] for r in rows)


def brute_class_score(text, counts, model):
    """log10 probability of a text, word by word."""
    total, before = 0.0, model.classes([b""])[0]
    for w in [*words_of(text), b""]:
        c = model.classes([w])[0]
        total += model.move[before, c] + math.log10((counts[w] + 0.1) / (model.tokens[c] + 0.1 * (model.words[c] + 1)))
        before = c
    return total


def test_class_scores_equal_brute_force(spark, documents):
    """Classes, transitions and emissions, counted again with plain loops."""
    rows = documents.selectExpr("doc_id", "text", "crc32(cast(cast(doc_id AS string) AS binary)) % 10 = 0 AS held_out")
    training = rows.where("not held_out")
    counted = classlm.word_counts(training)
    model = classlm.fitted(training, counted)
    texts = [(r["text"] or "").encode() for r in training.collect()]
    counts = Counter(w for t in texts for w in [*words_of(t), b""])
    names = list(counts)
    of = dict(zip(names, model.classes(names).tolist()))
    k = len(model.move)
    pairs, tokens, words = np.zeros((k, k)), np.zeros(k), np.zeros(k)
    for t in texts:
        run = [of[w] for w in [b"", *words_of(t), b""]]
        for a, b in zip(run, run[1:]):
            pairs[a, b] += 1
    # Texts stand one behind the other: an end follows an end where a batch begins only.
    assert model.move == pytest.approx(classlm.transitions(pairs))
    for w, n in counts.items():
        tokens[of[w]] += n
        words[of[w]] += 1
    assert (model.tokens == tokens).all() and (model.words == words).all()
    often = [w for w in names if counts[w] >= classlm.LEAST_COUNT and w]
    kept = model.of_word.table[classlm.slots(often)]
    own = [w for w, v in zip(often, kept) if v or w in model.of_word.top]
    assert len(own) == len(often)  # every word of the least count has an exchanged class
    assert sum(counts[w] for w in often) / sum(counts.values()) > 0.5
    got = {r["doc_id"]: r["score"] for r in classlm.perplexity(documents).collect()}
    for r in rows.limit(40).collect():
        assert got[r["doc_id"]] == pytest.approx(brute_class_score((r["text"] or "").encode(), counts, model))


def test_slot_vectors_merge_in_levels(spark, documents, monkeypatch):
    """The neighbours of a slot are the same however many tasks are merged at a time."""
    training = documents.select("text").repartition(7)
    top = [b"the", b"of"]
    classes = classlm.ClassOf(top, np.arange(1 + len(top) + classlm.POOLS) % 5)
    wanted = np.ones(1 << classlm.SLOT_BITS, np.uint8)
    seen = []
    for fan in (2, 64):
        monkeypatch.setattr(classlm, "FAN", fan)
        table = classlm.slot_neighbours(training, classes, wanted).toArrow().sort_by("slot")
        seen.append((table["slot"].to_pylist(), classlm.summed_cells(table["lists"], 10)))
    assert seen[0][0] == seen[1][0] and (seen[0][1] == seen[1][1]).all()
    words = Counter(w for r in documents.collect() for w in words_of((r["text"] or "").encode()) if w not in top)
    assert seen[0][1].sum() == 2 * sum(words.values())


def test_split_words_equal_plain_splits():
    rng = random.Random(4)
    texts = [None, "", "  ", " Ab c\x1fd\n\x0b\x0c\r\té \u00a0 x"] + [
        " ".join(rng.choice(["One", "two,", "ÄÖ", "x\u2003y", "", "日本"]) for _ in range(rng.randint(0, 30))) for _ in range(400)]
    for limit in (1 << 22, 700):
        flat, sizes = [], []
        for part in classlm.text_parts(pa.chunked_array([texts[:100], texts[100:]], pa.string()), limit):
            words, n = classlm.split_words(part)
            flat += words.cast(pa.large_binary()).to_pylist()
            sizes += n.tolist()
            known, run = classlm.local_words(part)
            assert [known[i] for i in run if i] == words.cast(pa.large_binary()).to_pylist()
            assert (run == 0).sum() == len(n) + 1
        want = [words_of((t or "").encode()) for t in texts]
        assert sizes == [len(w) for w in want] and flat == [w for ws in want for w in ws]


def test_best_classes_have_the_largest_likelihood():
    rng = np.random.default_rng(5)
    for _ in range(20):
        atoms, classes = 12, 4
        pairs = rng.integers(0, 9, (atoms, atoms)) * rng.integers(0, 2, (atoms, atoms))
        np.fill_diagonal(pairs, 0)
        of = np.append(np.arange(classes), rng.integers(0, classes, atoms - classes))
        words = np.arange(classes, atoms)
        table = np.zeros((classes, classes))
        np.add.at(table, (of[:, None], of[None, :]), pairs)
        out = np.array([np.bincount(of, pairs[w], classes) for w in words])
        into = np.array([np.bincount(of, pairs[:, w], classes) for w in words])
        got = classlm.best_classes(table, out, into, of[words])
        for w, c in zip(words, got):
            moved = [classlm.likelihood(pairs, np.where(np.arange(atoms) == w, k, of), classes) for k in range(classes)]
            assert moved[c] == pytest.approx(max(moved))


# -- decontamination -------------------------------------------------------


def test_decontamination_against_all_pairs(spark, documents):
    benchmark = spark.read.parquet(f"{SMALL}/benchmark.parquet")
    items = {r["item_id"]: plain_words(r["text"].encode()) for r in benchmark.collect()}
    rng = random.Random(1)
    some = [r["text"] for r in benchmark.limit(6).collect()]
    planted = [("word " * rng.randint(0, 300)) + t + (" tail" * rng.randint(0, 90)) for t in some]
    docs = odd_docs(spark, [*planted, *[" ".join(t.split()[::-1]) for t in some], None, "", LONG + some[0]]) \
        .unionByName(documents.limit(60).selectExpr("doc_id + 1000 AS doc_id", "text", "lang", "source", "n_chars",
                                                    "0.5D AS score", "'w' AS word", "1L AS n"))
    want = set()
    for r in docs.collect():
        there = decontamination.shingles(plain_words((r["text"] or "").encode()))
        for k, words in items.items():
            own = decontamination.shingles(words)
            if len(own & there) / len(own) >= 0.8:
                want.add((r["doc_id"], k))
    got = {(r["doc_id"], r["item_id"]) for r in decontamination.contaminated(docs, benchmark).collect()}
    assert got == want and len({d for d, _ in want}) >= 7
    assert decontamination.clean_documents(docs, benchmark).count() == docs.count() - len({d for d, _ in want})
    assert decontamination.contaminated(docs, benchmark.where("false")).count() == 0
    parts = list(decontamination.indexes(benchmark, part_bytes=4000))
    assert len(parts) > 1 and sorted(i for p, _ in parts for i in p.ids) == sorted(items)
    assert {n for _, n in parts} == {len(parts)}
    again = {(r["doc_id"], r["item_id"]) for r in decontamination.contaminated(docs, benchmark, part_bytes=4000).collect()}
    assert again == want
    assert decontamination.clean_documents(docs, benchmark, part_bytes=4000).count() == docs.count() - len({d for d, _ in want})


def test_short_items_are_found_by_their_whole_sequence(spark):
    items = [(1, "What is the capital?"), (2, "two words"), (3, "unique"), (4, ""), (5, None), (6, "!!!"), (7, "a b a b")]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    texts = ["What is the capital", "so: WHAT is the capital of it", "the capital is what", "two, words", "words two", "a unique one",
             "b a b a", "x a b a b y", None, "", "uniquely two"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {(r["doc_id"], r["item_id"]) for r in decontamination.contaminated(docs, benchmark).collect()}
    assert got == {(0, 1), (1, 1), (3, 2), (5, 3), (7, 7)}
    assert sorted(r["doc_id"] for r in decontamination.clean_documents(docs, benchmark).collect()) == [2, 4, 6, 8, 9, 10]


def test_wand_finds_what_full_scoring_finds():
    rng = random.Random(0)
    words = [f"w{i}" for i in range(200)]
    items = [(i, " ".join(rng.choices(words, weights=range(1, 201), k=rng.randint(8, 40))).encode()) for i in range(120)]
    parsed = [plain_words(t) for _, t in items]
    index = decontamination.Index(items, Counter(w for p in parsed for w in set(p)), len(items), 24.0)
    dense = np.zeros((len(index.terms), len(index.ids)))
    for k, (i, x) in enumerate(index.postings):
        dense[k, i] = x
    for _ in range(400):
        terms = sorted({rng.randrange(len(index.terms)) for _ in range(rng.randint(1, 60))})
        cut = rng.choice([0.2, 0.4, 0.6])
        scores = dense[terms].sum(0)
        assert {i for i, _ in index.wand(terms, cut)} == set(np.flatnonzero(scores >= cut - 1e-12).tolist())


# -- neighbours ------------------------------------------------------------


def test_neighbours(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(600, 8)).astype(np.float32)
    x[100:200] = x[100]
    rows = [(i, v.tolist(), 0, "q") for i, v in enumerate(x)]
    rows += [rows[0], (700, None, 0, ""), (701, [0.0] * 8, 0, ""), (702, [1.0, None] + [0.0] * 6, 0, ""), (None, [1.0] * 8, 0, ""),
             (703, [float("nan")] * 8, 0, ""), (704, [1.0, 2.0], 0, ""), (720, [float("inf")] * 8, 0, "")]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>, score int, query string")
    got = neighbours.nearest(table).collect()
    near = {}
    for r in sorted(got, key=lambda r: (r["query_id"], r["rank"])):
        near.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    assert sorted(near) == list(range(0, 600, 20)) and all(len(v) == 20 for v in near.values())
    x = x.astype(float)
    right = 0
    for q, found in near.items():
        scores = (x * x[q]).sum(1)
        order = [i for i in np.lexsort((np.arange(600), -scores)).tolist() if i != q][:20]
        right += len(set(order) & {i for i, _ in found})
        assert all(s == pytest.approx(scores[i]) for i, s in found)
        assert found == sorted(found, key=lambda t: (-t[1], t[0]))
    assert right / (20 * len(near)) >= 0.9
    assert neighbours.nearest(table.where("false")).count() == 0
    assert neighbours.nearest(table.where("vec_id in (20, 33)")).count() == 1


def test_neighbour_scores_of_doubles_and_short_lists(spark, monkeypatch):
    """Doubles are not rounded to floats; a query in a corner of few points still gets 20."""
    monkeypatch.setattr(neighbours, "LIST_SIZE", 4)
    monkeypatch.setattr(neighbours, "LEAST", 1)
    rng = np.random.default_rng(2)
    x = np.concatenate([rng.normal(size=(3, 4)) * 0.01 + [9, 0, 0, 0], rng.normal(size=(300, 4)) * 0.01 - [9, 0, 0, 0],
                        [[0.1, 0.1, 0.7, 0.3]]])
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {}
    for r in neighbours.nearest(table).collect():
        got.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    assert all(len(v) == 20 for v in got.values()) and len(got) == 16
    assert dict(got[0])[1] == float((x[0] * x[1]).sum())


# -- SimHash ---------------------------------------------------------------


def test_near_duplicates_keep_every_column(spark):
    rows = [(1, "one two three four", 5, 6), (1, "one two three four", 7, 6), (2, "One  two three four", 5, 6), (3, "else where", 1, 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _copy int, copy int")
    kept = simhash.one_of_each(docs)
    assert kept.columns == docs.columns and sorted(r["doc_id"] for r in kept.collect()) == [1, 3]


def test_neighbour_queries_stream_past_a_part():
    rng = np.random.default_rng(0)
    kind = pa.schema([("shard", pa.int32()), ("part", pa.int32()), ("asks", pa.int32()), ("lists", pa.list_(pa.int32())),
                      ("embedding", pa.list_(pa.float32())), ("ids", pa.list_(pa.int64())), ("query", pa.string())])
    x, q = rng.normal(size=(2, 90, 4)).astype(np.float32), rng.normal(size=(500, 4)).astype(np.float32)
    rows = []
    for shard in range(2):
        rows += [(shard, 0, 0, [0], v.tolist(), [100 * shard + i], "") for i, v in enumerate(x[shard])]
        rows += [(shard, 0, 1, [0], v.tolist(), None, str(i)) for i, v in enumerate(q)]
    rows += [(2, 0, 1, [0], q[0].tolist(), None, "0")]
    table = pa.table([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kind.types, strict=True)], schema=kind)
    taken = []

    def batches():
        for batch in table.to_batches(max_chunksize=70):
            taken.append(len(batch))
            yield batch

    found, ahead = {}, []
    for out in neighbours.best_of_batches(batches(), 3):
        ahead.append(len(taken))
        for r in out.to_pylist():
            found.setdefault((int(r["vec_id"] >= 100), r["query"]), []).append(r["vec_id"])
    assert ahead[0] == 2 and max(Counter(ahead).values()) <= 3
    assert len(found) == 1000
    for (shard, name), ids in found.items():
        best = np.argsort(-(x[shard].astype(float) @ q[int(name)].astype(float)), kind="stable")[:4]
        assert ids == (100 * shard + best).tolist()


def fingerprint(text):
    words = words_of((text or "").encode())
    parts = [b" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(p, 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_simhash_components(spark, documents):
    assert simhash.near_duplicates(documents.where("false")).count() == 0
    for docs in (documents, odd_docs(spark)):
        data = docs.collect()
        fps = [fingerprint(r["text"]) for r in data]
        root = list(range(len(data)))

        def find(i):
            while root[i] != i:
                i = root[i]
            return i

        for i in range(len(data)):
            for j in range(i):
                if (fps[i] ^ fps[j]).bit_count() <= 2:
                    root[find(i)] = find(j)
        ids = {}
        for i, r in enumerate(data):
            if r["doc_id"] is not None:
                ids[find(i)] = min(r["doc_id"], ids.get(find(i), 1 << 60))
        want = sorted((str(r["doc_id"]), f"{fps[i]:016x}", str(ids.get(find(i)))) for i, r in enumerate(data))
        got = simhash.near_duplicates(docs).select("doc_id", simhash.as_hex("fp"), "component_id").collect()
        assert sorted((str(a), b, str(c)) for a, b, c in got) == want
        kept = simhash.one_of_each(docs)
        assert kept.columns == docs.columns and kept.count() == len({find(i) for i in range(len(data))})


@pytest.mark.parametrize("blocks", [2, 4, 6])
def test_links_are_exact(spark, blocks):
    rng = np.random.default_rng(0)
    found = set()
    for x in rng.integers(0, 1 << 63, 60, dtype=np.uint64).tolist():
        for _ in range(int(rng.integers(1, 25))):
            found.add(x)
            for _ in range(int(rng.integers(1, 4))):
                x ^= 1 << int(rng.integers(0, 64))
    fps = np.array(sorted(found), np.uint64)
    forest = simhash.Forest(len(fps))
    forest.link(*np.nonzero(np.bitwise_count(fps[:, None] ^ fps[None, :]) <= 2))
    place = {int(v): i for i, v in enumerate(fps.view(np.int64))}
    edges = simhash.links(spark.createDataFrame([(v,) for v in place], "fp long"), 2, blocks).collect()
    mine = simhash.Forest(len(fps))
    mine.link(np.array([place[e["u"]] for e in edges]), np.array([place[e["v"]] for e in edges]))
    assert (mine.label == forest.label).all()


# -- mixing and the pipeline -----------------------------------------------


def test_mixing_posteriors_on_held_out_labels(spark):
    """The classifier reads words: accuracy, toxic recall and target shares on sf0.1."""
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    rates = mixing.mixing_rates(docs, labels.where(~held)).persist()
    shares = rates.agg(*[(F.sum(F.col("rate") * F.col("n_tokens") * F.col(f"p_{d}")) / F.sum("n_tokens")).alias(d)
                         for d in mixing.DOMAINS]).first()
    assert all(abs(shares[d] - t) < 0.01 for d, t in mixing.TARGETS.items())
    known = rates.join(mixing.domains_of(labels.where(held)), "doc_id").collect()
    top = [(r["domain"], max(mixing.DOMAINS, key=lambda d: r[f"p_{d}"])) for r in known]
    assert sum(a == b for a, b in top) / len(top) > 0.92
    toxic = [b for a, b in top if a == "toxic"]
    assert toxic.count("toxic") / len(toxic) > 0.8
    rates.unpersist()


def test_mixing_moves_towards_the_targets(spark, documents, labels):
    rows = mixing.mixing_rates(documents, labels).collect()
    total = sum(r["n_tokens"] for r in rows)

    def miss(rate):
        return sum((sum(r["n_tokens"] * rate(r) * r[f"p_{d}"] for r in rows) / total - t) ** 2
                   for d, t in mixing.TARGETS.items())

    assert all(r["rate"] >= 0 for r in rows)
    assert miss(lambda r: r["rate"]) < 0.5 * miss(lambda r: 1.0)
    docs = odd_docs(spark)
    for table in (labels, labels.where("false")):
        assert mixing.mixing_rates(docs, table).count() == 15
        assert mixing.mixed_documents(docs, table).columns == [*docs.columns, "rate"]
    assert mixing.mixing_rates(docs.where("false"), labels).count() == 0


def test_pipeline_stages(spark, documents, labels):
    docs, kept = documents, []
    for name, stage in corpus_pipeline.STAGES:
        after = stage(spark, docs, SMALL).persist()
        before, now = {r["doc_id"] for r in docs.collect()}, {r["doc_id"] for r in after.collect()}
        assert now <= before and after.columns[:5] == documents.columns
        kept.append((name, len(before - now)))
        docs = after
    assert [n for n, _ in kept] == ["toxicity", "language", "near_duplicates", "decontamination", "mixing"]
    empty = documents.where("false")
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, SMALL).count() == 0

