import zlib

import numpy as np
import pytest

from docmill.llm import quality, toxicity
from docmill.llm.textbytes import Words, labelled_sample


def labels(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


@pytest.fixture(scope="module")
def corpus():
    rng = np.random.default_rng(4)
    words = [f"{a}{b}" for a in ("ta", "re", "mo", "li", "su") for b in ("ben", "dor", "kin", "pas", "vel")]
    texts, toxic, good = [], [], []
    for k in range(400):
        body = [str(w) for w in rng.choice(words, rng.integers(20, 120))]
        is_toxic, is_good = k % 4 == 0, k % 5 != 0
        if is_toxic:
            body[rng.integers(len(body))] = str(rng.choice(["zonkfool", "zonkhead", "grubface"]))
        if not is_good:
            body = [w.upper() + "!!" for w in body]
        texts.append(" ".join(body))
        toxic.append(int(is_toxic))
        good.append(int(is_good))
    return texts, toxic, good


def test_toxicity_learns_and_never_reads_held_out_rows(spark, make_docs, corpus, odd_rows):
    texts, toxic, good = corpus
    docs = make_docs([(1000 + i, t) for i, t in enumerate(texts)] + odd_rows)
    held = {1000 + i for i in range(len(texts)) if zlib.crc32(str(1000 + i).encode()) % 3 == 1}
    real = labels(spark, [(1000 + i, good[i], toxic[i]) for i in range(len(texts))] + [(None, 1, 1), (1, None, None)])
    lied = labels(spark, [(1000 + i, good[i], 1 - toxic[i] if 1000 + i in held else toxic[i]) for i in range(len(texts))])
    got = toxicity.score_query(docs, real).collect()
    again = {r["doc_id"]: r["score"] for r in toxicity.score_query(docs, lied).collect()}
    assert len(got) == len(texts) + len(odd_rows) and all(0 <= r["score"] <= 1 for r in got)
    assert all(r["held_out"] == (r["doc_id"] in held) for r in got if r["doc_id"] and r["doc_id"] >= 1000)
    assert all(r["score"] == again[r["doc_id"]] for r in got if r["doc_id"] and r["doc_id"] >= 1000)
    hits = [(r["predicted"], toxic[r["doc_id"] - 1000]) for r in got if r["doc_id"] in held]
    assert np.mean([p == y for p, y in hits]) > 0.93


def test_quality_learns_and_never_reads_held_out_rows(spark, make_docs, corpus, odd_rows):
    texts, toxic, good = corpus
    docs = make_docs([(1000 + i, t) for i, t in enumerate(texts)] + odd_rows)
    held = {1000 + i for i in range(len(texts)) if zlib.crc32(str(1000 + i).encode()) % 5 == 0}
    lied = labels(spark, [(1000 + i, 1 - good[i] if 1000 + i in held else good[i], toxic[i]) for i in range(len(texts))])
    got = quality.score_query(docs, lied).collect()
    assert len(got) == len(texts) + len(odd_rows) and all(0 <= r["score"] <= 1 for r in got)
    assert np.mean([r["predicted"] == good[r["doc_id"] - 1000] for r in got if r["doc_id"] in held]) > 0.95
    kept = quality.reject_poor(docs, lied)
    assert kept.columns == docs.columns and 300 < kept.where("doc_id >= 1000").count() < 340


def test_no_labels_or_one_class(spark, make_docs):
    docs = make_docs([(1, "a"), (2, None)])
    assert {r["score"] for r in toxicity.score_query(docs, labels(spark, [])).collect()} == {0.0}
    assert {r["score"] for r in quality.score_query(docs, labels(spark, [])).collect()} == {1.0}
    assert {r["predicted"] for r in toxicity.score_query(docs, labels(spark, [(1, 1, 0), (2, 1, 0)])).collect()} == {0}
    assert toxicity.score_query(make_docs([]), labels(spark, [])).collect() == []


def test_gradients_match_differences():
    rng = np.random.default_rng(0)
    net = toxicity.Network(1)
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    x = rng.standard_normal((21, toxicity.INPUTS)).astype(np.float64)
    firsts, sizes = np.array([0, 7, 11]), np.array([7, 4, 10])
    up = np.array([1.0, -2.0, 0.5])
    out, kept = net.forward(x, firsts, sizes, True)
    grads = net.gradients(up, kept)
    for name, values in [*net.p.items(), ("x", x)]:
        for _ in range(3):
            at = tuple(rng.integers(s) for s in values.shape)
            old = values[at]
            values[at] = old + 1e-3
            plus = float((net.forward(x, firsts, sizes) * up).sum())
            values[at] = old - 1e-3
            minus = float((net.forward(x, firsts, sizes) * up).sum())
            values[at] = old
            assert grads[name][at] == pytest.approx((plus - minus) / 2e-3, abs=2e-3)


def test_vector_gradients_match_differences():
    rng = np.random.default_rng(2)
    w = Words([b"alphabet beta gammadelta", b"beta alphabet"], toxicity.TABLE)
    keys = np.unique(np.concatenate([toxicity._word_hashes(w), toxicity._gram_hashes(w, 4, toxicity._gram_places(w, 4))]))
    hits = toxicity.Hits(w, toxicity.Vocabulary(keys))
    vectors = rng.standard_normal((len(keys), toxicity.DIM)).astype(np.float32)
    up = rng.standard_normal((len(w.starts), toxicity.INPUTS)).astype(np.float32)

    def value() -> float:
        return float((hits.inputs(vectors[hits.word_key], vectors[hits.gram_key]) * up).sum())

    x = hits.inputs(vectors[hits.word_key], vectors[hits.gram_key])
    grads = hits.gradients(x, up, vectors[hits.gram_key], len(keys))
    for _ in range(20):
        at = tuple(rng.integers(s) for s in vectors.shape)
        old = vectors[at]
        vectors[at] = old + 1e-2
        plus = value()
        vectors[at] = old - 1e-2
        minus = value()
        vectors[at] = old
        assert grads[at] == pytest.approx((plus - minus) / 2e-2, abs=2e-2)


def test_hits_of_listed_words_are_those_of_the_run():
    w = Words([b"alphabet beta gammadelta alphabet", b"beta x"], toxicity.TABLE)
    keys = np.unique(np.concatenate([toxicity._word_hashes(w)[:2], toxicity._gram_hashes(w, 4, toxicity._gram_places(w, 4))]))
    hits = toxicity.Hits(w, toxicity.Vocabulary(keys))
    vectors = np.random.default_rng(0).standard_normal((len(keys), toxicity.DIM)).astype(np.float32)
    whole = hits.inputs(vectors[hits.word_key], vectors[hits.gram_key])
    words = np.array([3, 0, 4, 2, 3])
    part, word_hit, gram_hit = hits.of_words(words, np.ones(len(hits.word_at), bool), np.ones(len(hits.gram_at), bool))
    assert np.array_equal(part.inputs(vectors[part.word_key], vectors[part.gram_key]), whole[words])
    assert np.array_equal(hits.word_key[word_hit], part.word_key) and np.array_equal(hits.gram_key[gram_hit], part.gram_key)


SHORT = ["", "a", "ab", "abc", "abcd", "abcde", "a b c", " ", "é", "\n\t", "abcdefghij", "🙂", "a" * 7, "ab cd", "0123456789"]


def test_short_texts_alone_in_training_and_scoring(corpus):
    texts, toxic, good = corpus
    assert all(len(toxicity._text_features(t)) >= 0 for t in SHORT)
    for t in SHORT:
        toxicity.fit([t, t + "x"], [0, 1])
        quality.fit([t, t + "x"], np.array([np.nan, 1.0]), [0, 1], epochs=1)
    model = toxicity.fit(texts[:100] + SHORT, toxic[:100] + [0] * len(SHORT), rounds=1)
    other = quality.fit(texts[:100] + SHORT, np.full(100 + len(SHORT), np.nan), good[:100] + [0] * len(SHORT), epochs=1)
    together = model.score(SHORT)
    for k, t in enumerate(SHORT):
        assert model.score([t])[0] == pytest.approx(together[k], abs=1e-5)
        assert 0 <= other.score([t], np.array([np.nan]))[0] <= 1


def test_hashes_do_not_depend_on_where_a_word_stands():
    a, b = Words([b"some words here"], toxicity.TABLE), Words([b"x", b"here are other words that are some"], toxicity.TABLE)
    one, two = toxicity._word_hashes(a), toxicity._word_hashes(b)
    assert one[0] == two[-1] and one[1] == two[4] and one[2] == two[1]


def test_sample_is_bounded_in_rows_and_bytes(spark, make_docs):
    docs = make_docs([(i, "x" * 100) for i in range(40)] + [(1, "x" * 100), (50, None)])
    found = labels(spark, [(i, i % 2, i % 2) for i in range(51)])
    rows = labelled_sample(docs, found, "toxic", 3, 1, False, 10, ["text"])
    assert len(rows) == 20 and len({r["doc_id"] for r in rows}) == 20
    few = labelled_sample(docs, found, "toxic", 3, 1, False, 10, ["text"], bytes_per_class=450)
    assert len(few) <= 10 and {r["doc_id"] for r in few} <= {r["doc_id"] for r in rows}


def test_windows_cover_every_word_and_overlap():
    for n in (0, 1, 32, 33, 56, 57, 500):
        w = Words([b" ".join([b"w"] * n), b"x y"], toxicity.TABLE)
        firsts, sizes, text = toxicity.windows(w)
        seen = {f + k for f, s, t in zip(firsts, sizes, text) if t == 0 for k in range(s)}
        assert seen == set(range(n)) and (text == 1).sum() == 1
        own = np.sort(firsts[text == 0])
        assert (np.diff(own) < toxicity.WINDOW).all()


def test_factorisation_identity():
    m = quality.Model()
    f = quality.Features([b"Some words, words | here!", b"", b"A1 b2"], np.array([24.0, np.nan, 5.0]))
    text, feature, value = m._rows(f)
    m.w[:] = np.random.default_rng(1).standard_normal(len(m.w))
    z, _ = m.logits(text, feature, value)
    for t in range(3):
        i, x = feature[text == t], value[text == t]
        pairs = sum(float(m.v[i[a]] @ m.v[i[b]]) * x[a] * x[b] for a in range(len(i)) for b in range(a))
        assert z[t] == pytest.approx(float(m.bias[0] + m.w[i] @ x) + pairs, rel=1e-3, abs=1e-3)
