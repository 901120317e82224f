"""The latent search against plain TF-IDF and against an all-pairs decision."""

import random

import numpy as np

from citypulse.llm import decontaminate as D
from citypulse.llm.kernels import words

import pyarrow as pa


def world(seed, topics=40):
    """Topics of 12 words, each word with a synonym that occurs in the same
    contexts; plus common words that say nothing."""
    rng = random.Random(seed)
    name = lambda: "".join(rng.choice("bcdfglmnprstvz") + rng.choice("aeiou") for _ in range(4))
    topic = [[(name(), name()) for _ in range(12)] for _ in range(topics)]
    common = [name() for _ in range(60)]
    return rng, topic, common


def passage(rng, topic, common, n=40):
    """Every third word from the topic, by either name; the rest is common."""
    return [rng.choice(rng.choice(topic)) if k % 3 == 2 else rng.choice(common) for k in range(n)]


def planted(seed=1, n_items=60, n_docs=900):
    rng, topics, common = world(seed)
    swap = {a: b for t in topics for p in t for a, b in (p, p[::-1])}
    items = [(k, passage(rng, topics[k % len(topics)], common)) for k in range(n_items)]
    corpus = [(1000 + k, sum((passage(rng, rng.choice(topics), common, 32) for _ in range(3)), [])) for k in range(n_docs)]
    # paraphrases: every topic word by its synonym, the common words stay
    para = [(k, passage(rng, rng.choice(topics), common, 48) + [swap.get(w, w) for w in x]
             + passage(rng, rng.choice(topics), common, 48)) for k, x in items]
    return items, corpus, para


def frame(spark, rows, name):
    return spark.createDataFrame([(k, " ".join(w)) for k, w in rows], f"{name} long, text string")


def test_paraphrases_by_other_words_are_found(spark):
    items, corpus, para = planted()
    docs = frame(spark, corpus + para, "doc_id")
    bench = frame(spark, items, "item_id")
    got = {r.doc_id: r for r in D.find(docs, bench, min_answer=0.3).collect()}
    recall = np.mean([k in got[k].items for k, _ in para])
    assert recall >= 0.9
    # the same candidates by plain TF-IDF cosine, all windows against all passages
    freq, n = D.document_frequencies(docs)
    weight = D.idf(freq, n)

    def vector(w):
        h, _ = words(pa.array([" ".join(w)]))
        at, v = D._tfidf(D.bucket(h), weight)
        return dict(zip(at.tolist(), v.tolist()))

    cos = lambda x, y: sum(v * y.get(k, 0.0) for k, v in x.items())
    found = 0
    for (k, item), (_, doc) in zip(items, para):
        parts = [vector(item[s:s + 32]) for s in (0, 8)]
        found += max(cos(vector(doc[s:s + 32]), p) for s in range(0, len(doc), 8) for p in parts) >= 0.45
    assert recall > found / len(items)


def test_the_space_is_far_smaller_than_the_passages(spark):
    items, corpus, _ = planted()
    docs, bench = frame(spark, corpus, "doc_id"), frame(spark, items, "item_id")
    freq, n, n_words = D._frequencies(docs, "text")
    weight = D.idf(freq, n)
    rows = D.benchmark_rows(bench, weight, "item_id", "text", None, 6)
    vocabulary, fold = D.latent_space(docs, "text", rows, weight, freq, n_words, 128)
    assert n == len(corpus) and n_words == sum(len(w) for _, w in corpus)
    assert fold.shape[1] <= 128 < D.corpus_rows(docs, "text", weight, 1.0).count() / 10
    assert np.isin(D.bucket(words(pa.array([" ".join(items[0][1])]))[0]), vocabulary).all()


def test_sample_is_a_bounded_share(spark):
    _, corpus, _ = planted(2, 5, 600)
    docs = frame(spark, corpus + corpus, "doc_id")
    weight = D.idf(*D.document_frequencies(docs))
    every = D.corpus_rows(docs, "text", weight, 1.0).count()
    assert every == 600 * 3  # equal passages once
    assert 0.05 * every < D.corpus_rows(docs, "text", weight, 0.1).count() < 0.17 * every


def brute(docs, items, min_lcs=0.6):
    """(doc, item) of every pair that the word-sequence check accepts somewhere:
    any window against any passage, whatever their cosine."""
    out = set()
    for d, w in docs:
        for k, item in items:
            for s in D.passages(np.array([0, len(item)]), D.PASSAGE, D.PASSAGE // 2)[1]:
                p = item[s:s + D.PASSAGE]
                tail = item[-6:]
                for at in range(0, max(1, len(w) - 8), 8):
                    near = w[max(0, at - len(p) // 2):at + D.PASSAGE + len(p) // 2]
                    share = D.common_subsequence(p, near) / len(p)
                    wide = w[max(0, at - 256):at + 288]
                    if share >= min_lcs and (share >= 0.9 or D.common_subsequence(tail, wide) >= 3):
                        out.add((d, k))
    return out


def test_decisions_against_all_pairs(spark):
    """Copies with 0 to 14 of 40 words replaced, at any place, and clean texts:
    nothing beyond the all-pairs decision, and nearly all of it."""
    rng, topics, common = world(5)
    name = lambda: "".join(rng.choice("bcdfglmnprstvz") + rng.choice("aeiou") for _ in range(4))
    vocabulary = [name() for _ in range(1500)]
    text = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    items = [(k, text(40)) for k in range(25)]
    docs = []
    for k in range(75):
        copy = list(items[k % 25][1])
        for at in rng.sample(range(40), k % 15):
            copy[at] = rng.choice(vocabulary)
        docs.append((k, text(rng.randrange(90)) + copy + text(rng.randrange(90))))
    docs += [(100 + k, text(150)) for k in range(40)]
    want = brute(docs, items)
    out = D.find(frame(spark, docs, "doc_id"), frame(spark, items, "item_id")).collect()
    got = {(r.doc_id, k) for r in out for k in r.items}
    assert len(want) > 60 and got <= want
    assert len(got) >= 0.95 * len(want)


def test_the_space_is_learnt_from_every_passage(spark):
    """Singular values of all distinct passages, beyond 16,384 of them, short
    texts and last words included."""
    rng = random.Random(7)
    name = [f"w{k}x" for k in range(120)]
    text = lambda n: [name[min(rng.randrange(120), rng.randrange(120))] for _ in range(n)]
    corpus = [(k, text(12)) for k in range(16_000)] + [(20_000 + k, text(70)) for k in range(2000)]
    items = [(k, text(20)) for k in range(5)]
    docs, bench = frame(spark, corpus + corpus[:50], "doc_id").repartition(4), frame(spark, items, "item_id")
    freq, n, n_words = D._frequencies(docs, "text")
    weight = D.idf(freq, n)
    rows = D.benchmark_rows(bench, weight, "item_id", "text", None, 6).cache()
    vocabulary, fold = D.latent_space(docs, "text", rows, weight, freq, n_words, 6)
    passages = [tuple(w[s:s + 32]) for _, w in corpus for s in ([0, 32, 38] if len(w) == 70 else [0])]
    matrix = np.zeros((len(set(passages)) + len(items), len(vocabulary)))
    for k, w in enumerate([*set(passages), *[w for _, w in items]]):
        at, v = D._tfidf(D.bucket(words(pa.array([" ".join(w)]))[0]), weight)
        matrix[k, np.searchsorted(vocabulary, at)] = v
    assert len(matrix) > 20_000
    _, sigma, directions = np.linalg.svd(matrix, full_matrices=False)
    found = 1 / (fold ** 2).sum(axis=0)
    assert np.allclose(found[0], sigma[0], rtol=1e-3) and np.allclose(found, sigma[:6], rtol=0.05)
    assert abs(directions[0] @ fold[:, 0]) * np.sqrt(found[0]) > 0.999


def test_products_of_sparse_rows(monkeypatch):
    """A'(A q) with empty rows, a place in most rows and cuts between rows."""
    rng = np.random.default_rng(3)
    size = rng.integers(0, 33, 300)
    at = np.concatenate([rng.choice(400, n, replace=False) if n else np.zeros(0, int) for n in size])
    off = np.concatenate([[0], np.cumsum(size)])
    at[off[:-1][size > 0]] = 401
    v, q = rng.random(len(at)), rng.standard_normal((402, 9))
    dense = np.zeros((300, 402))
    np.add.at(dense, (np.repeat(np.arange(300), size), at), v)
    for entries in (10, 700, 1 << 18):
        monkeypatch.setattr(D, "ENTRIES", entries)
        total = np.zeros((402, 9))
        D._add_gram(total, q, (off, at, v))
        assert np.allclose(total, dense.T @ (dense @ q))
        total = np.zeros((9, 9))
        D._add_gram(total, q, (off, at, v), square=True)
        assert np.allclose(total, (dense @ q).T @ (dense @ q))
