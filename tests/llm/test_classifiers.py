import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from spendlens.llm import language_id as L
from spendlens.llm import toxicity as T
from spendlens.llm.language_id import training_sample


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet("/root/testdata/sf0.01/documents.parquet")


@pytest.fixture(scope="module")
def labels(spark):
    return spark.read.parquet("/root/testdata/sf0.01/labels.parquet")


def test_language_of_held_out_rows(documents):
    lang = {r.doc_id: r.lang for r in documents.collect()}
    rows = L.language_id(documents).collect()
    assert len(rows) == len(lang)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1 for r in rows)
    held = [r for r in rows if r.held_out]
    assert sum(r.lang_pred == lang[r.doc_id] for r in held) >= 0.95 * len(held)
    assert sum(r.accepted for r in rows) >= 0.99 * len(rows)


def test_language_of_odd_rows(odd_docs, no_docs, documents):
    rows = L.language_id(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    for r in rows:
        if r.doc_id in (1, 2, 3):
            assert (r.lang_pred, r.score, r.accepted) == ("und", 0.0, False)
        else:
            assert r.lang_pred in ("en", "fr", "de", "es")
    assert L.language_id(no_docs).collect() == []
    unlabelled = documents.selectExpr("doc_id", "text", "cast(null as string) lang")
    assert {r.lang_pred for r in L.language_id(unlabelled).collect()} == {"und"}


def test_held_out_rows_are_not_learnt(documents):
    """Other labels on held-out rows change nothing."""
    changed = documents.withColumn("lang", L.F.when(L.not_held_out("doc_id", 4, 2), L.F.col("lang")).otherwise("xx"))
    order = lambda df: sorted(map(tuple, df.collect()))
    assert order(L.language_id(documents)) == order(L.language_id(changed))


def test_subwords_stay_in_their_word():
    owner, bucket = L.subwords(["ab", "c", "ab"])
    own = [sorted(bucket[owner == i].tolist()) for i in range(3)]
    assert own[0] == own[2] and len(own[0]) == 2 + 3 + 2 + 1 and len(own[1]) == 1 + 2 + 1


def test_words_kept_or_not(documents):
    model = L.train(["the of and in that", "der die und das ist"] * 20, ["en", "de"] * 20)
    texts = [r.text for r in documents.limit(60).collect()]
    a, b = L.Predictor(model), L.Predictor(model, most=1)
    for t in texts:
        (la, pa, ka), (lb, pb, kb) = a.predict([t])[0], b.predict([t])[0]
        assert la == lb and ka == kb and abs(pa - pb) < 1e-9


def test_toxic_held_out_rows(documents, labels):
    marked = {r.doc_id: r.toxic for r in labels.collect()}
    rows = T.toxicity(documents, labels).collect()
    assert len(rows) == documents.count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in rows)
    held = [(marked[r.doc_id], r.predicted) for r in rows if r.held_out and r.doc_id in marked]
    toxic = [p for y, p in held if y == 1]
    # junk copies of toxic texts keep the label and lose the words that gave it
    assert sum(toxic) >= 0.5 * len(toxic) and toxic
    assert sum(p for y, p in held if y == 0) <= 0.02 * len(held)


def test_toxicity_of_odd_rows(odd_docs, no_docs, labels, documents):
    rows = T.toxicity(odd_docs.union(documents.limit(0).selectExpr("doc_id", "text", "lang", "source", "n_chars", "'' fp",
                                                                   "0 node", "cast('' as binary) content", "0 kept")),
                      labels).collect()
    assert len(rows) == odd_docs.count()
    assert T.toxicity(no_docs, labels).collect() == []
    assert {r.score for r in T.toxicity(odd_docs, labels.limit(0)).collect()} == {0.0}


def slow_kernel(a, b):
    """Shared three-character subsequences of bounded span, each weighted by its spans, normalised."""

    def vector(w):
        v = {}
        code = [ord(c) & 31 if ord(c) < 128 else 32 + ord(c) % 32 for c in w]
        for i in range(len(w)):
            for k in range(i + 2, min(len(w), i + T.SPAN)):
                for j in range(i + 1, k):
                    key = code[i], code[j], code[k]
                    v[key] = v.get(key, 0) + T.DECAY ** (k - i + 1)
        return v

    x, y = vector(a), vector(b)
    dot = lambda p, q: sum(p[k] * q.get(k, 0) for k in p)
    return dot(x, y) / max((dot(x, x) * dot(y, y)) ** 0.5, 1e-12)


def test_kernel():
    words = ["stupid", "st.upid", "stuupid", "idiot", "été", "ab", "", "abcabcabc", "clown"]
    got = T.Kernel(["stupid", "idiot", "clown", "abcabc"])(words)
    for i, a in enumerate(words):
        for j, b in enumerate(["stupid", "idiot", "clown", "abcabc"]):
            assert got[i, j] == pytest.approx(slow_kernel(a, b) ** T.POWER, abs=1e-5)
    assert got[1, 0] > 5 * got[3, 0] and got[0, 0] == pytest.approx(1, abs=1e-5)


def test_changed_insults_are_caught():
    rng = np.random.default_rng(3)
    neutral = ["".join(rng.choice(list("aeiorstnhl"), rng.integers(2, 9))) for _ in range(300)]
    say = lambda *more: " ".join([*rng.choice(neutral, 9), *more, *rng.choice(neutral, 4)]) + "."
    texts = [say() + " " + say() for _ in range(150)] + [say(w) + " " + say() for w in ["moron", "idiot", "clown"] * 40]
    scorer = T.Scorer(T.train(texts, [0] * 150 + [1] * 120))
    clean = max(scorer.score([say() for _ in range(30)]))
    assert min(scorer.score([say("moron"), say("m o r o n"), say("IDIOT!")])) >= 0.7 > clean
    assert min(scorer.score([say("idi.ot"), say("clo-wn"), say("mooron")])) > clean
    assert max(scorer.score(["", "  \n", (neutral[0] + " ") * 5000])) < 0.7


def test_sample_quota_goes_to_usable_rows(spark):
    """Null, empty and missing texts take no place in the sample, long ones none while short ones fill it."""
    docs = spark.createDataFrame([(i, "One end. " + "x" * 50 if i % 10 else "short") for i in range(200)] + [(300, None), (301, "")],
                                 "doc_id long, text string")
    marks = spark.createDataFrame([(i, "a") for i in range(400)] + [(5, "b"), (5, "b"), (None, "c"), (6, None)], "id long, y string")
    got = training_sample(docs, marks, F.lit(True), "doc_id", "text", 20, 20)
    assert [t for t, y in got if y == "a"] == ["short"] * 20 and [t for t, y in got if y == "b"] == ["One end."]
    got = training_sample(docs, marks, F.lit(True), "doc_id", "text", 50, 20, least=25)
    assert sorted(t for t, y in got if y == "a") == ["One end."] * 5 + ["short"] * 20
    assert training_sample(docs.limit(0), marks, F.lit(True), "doc_id", "text", 20, 10) == []


def test_long_texts_alone_are_learnt(spark):
    """A language whose texts are all long has its place among the learnt ones."""
    rows = [(i, ("the of and in that. " if i % 2 else "der die und das ist. ") * 3000, "en" if i % 2 else "de") for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert {(r.lang_pred) for r in L.language_id(docs).collect()} == {"en", "de"}


def test_names_that_clash(odd_docs, documents, labels):
    names = ("_id", "_rank", "_label", "id", "y", "rank", "r", "t", "n", "held_out", "score", "lang_pred", "predicted", "accepted")
    docs = documents.limit(200).selectExpr("*", *[f"1 as {n}" for n in names])
    plain = documents.limit(200)
    rows = lambda df: sorted(map(tuple, df.collect()), key=str)
    assert rows(L.language_id(docs)) == rows(L.language_id(plain))
    more = labels.selectExpr("*", "1 as _id", "2 as id", "3 as y", "4 as rank")
    assert rows(T.toxicity(docs, more)) == rows(T.toxicity(plain, labels))


def test_characters_that_are_no_letters():
    for text in ("½ ² ① ⅷ 12 _ ٣", "", "¼²", "ⓐ²"):
        expect = [w for w in "".join(c if c.isalpha() else " " for c in text.lower()).split()]
        assert L.letters_of(text) == expect
    assert L.letters_of("x²y ½été") == ["x", "y", "été"]
    model = L.train(["the of and in that", "der die und das ist"] * 20, ["en", "de"] * 20)
    assert [r[0] for r in L.Predictor(model).predict(["½ ² ①", "the ½", "³"])] == ["und", "en", "und"]


def test_shares_kept_in_generations():
    """Words that leave the younger generation come back from the older, and scores don't change."""
    rng = np.random.default_rng(5)
    words = ["".join(rng.choice(list("aeiorstnhl"), rng.integers(2, 9))) for _ in range(400)]
    texts = [" ".join(rng.choice(words, 30)) + (" moron." if i % 2 else "!") for i in range(60)]
    model = T.train(texts, [i % 2 for i in range(60)])
    assert np.allclose([T.Scorer(model, most=20).score([t])[0] for t in texts], T.Scorer(model).score(texts), atol=1e-9)
    small = T.Scorer(model, most=20)
    assert np.allclose([small.score([t])[0] for t in texts], T.Scorer(model).score(texts), atol=1e-9)
    assert len(small.share) + len(small.older) < 600


def test_accepted_rows_are_those_of_the_predictions(odd_docs, no_docs):
    docs = odd_docs.coalesce(1)
    predictions = L.language_id(docs).collect()
    got = L.accepted_rows(docs)
    assert got.schema == docs.schema
    want = sorted((str(d.doc_id), d.text) for d, r in zip(docs.collect(), predictions) if r.accepted)
    assert want and sorted((str(r.doc_id), r.text) for r in got.collect()) == want
    assert L.accepted_rows(no_docs).count() == 0


def test_margins_are_those_of_the_sentences():
    """Scores of all texts at once, on bytes, against sums over each sentence's words."""
    rng = np.random.default_rng(8)
    words = ["".join(rng.choice(list("aeiorstnhlé"), rng.integers(1, 9))) for _ in range(200)] + ["...", "moron,", "(idiot)", "!?"]
    model = T.train([" ".join(rng.choice(words[:200], 12)) + (" moron." if i % 2 else "!") for i in range(80)], [i % 2 for i in range(80)])
    gaps = [" ", "  ", "\n", ". ", "! ", "?\n", "\xa0", "\u2003", "\t", ".\x0b"]
    texts = ["".join(rng.choice(words) + rng.choice(gaps) for _ in range(rng.integers(0, 40))) for _ in range(120)]
    texts += ["", " \n ", "...", "m o r o n", "x" * 5000, "word " * 3000, "\x00 a. \x00"]
    scorer = T.Scorer(model)
    kernel = T.Kernel(model.landmarks)
    share = lambda w: float((kernel([w]) @ model.weights)[0]) if w else 0.0
    want = [max(sum(share(w.strip(T._EDGES)) for w in s) for s in T.sentences(t)) for t in texts]
    assert np.allclose(scorer.margins(texts), want, atol=1e-4)
    assert np.allclose(scorer.margins(texts), [scorer.margins([t])[0] for t in texts], atol=1e-9)
