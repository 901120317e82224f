import random
import re

import numpy as np

from citypulse.llm import decontaminate as D

SF = "/root/testdata/sf0.01"


def tokens(t):
    return re.findall(r"[0-9a-z\u0080-￿]+", (t or "").lower())


def lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        prev = 0
        for j, y in enumerate(b):
            prev, row[j + 1] = row[j + 1], prev + 1 if x == y else max(row[j], row[j + 1])
    return row[-1]


def test_planted_passages_and_recall(spark):
    """Every document that holds an item in full is found; no document without
    a long common run is."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    items = spark.read.parquet(f"{SF}/benchmark.parquet")
    got = {r.doc_id: r for r in D.find(docs, items).collect()}
    grams = {r.item_id: tokens(r.text) for r in items.collect()}
    full, bare = set(), set()
    for r in docs.select("doc_id", "text").collect():
        w = tokens(r.text)
        text = " " + " ".join(w) + " "
        if any(f" {' '.join(g)} " in text for g in grams.values()):
            full.add(r.doc_id)
        runs = {tuple(w[k:k + 3]) for k in range(len(w) - 2)}
        if all(sum(tuple(g[k:k + 3]) in runs for k in range(len(g) - 2)) < 0.15 * len(g) for g in grams.values()):
            bare.add(r.doc_id)
    assert full and all(got[i].contaminated for i in full)
    assert not [i for i in bare if got[i].contaminated]
    assert len(got) == docs.count()


def test_paraphrase_and_answer(spark):
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("bcdfglmnprst") + rng.choice("aeiou") for _ in range(3))
    items = [(k, " ".join(word() for _ in range(40))) for k in range(12)]
    noise = lambda n: " ".join(word() for _ in range(n))
    para = items[0][1].split()
    for k in range(3, 30, 6):
        para[k] = word()
    rows = [(1, f"{noise(50)} {items[1][1]} {noise(70)}"), (2, f"{noise(30)} {' '.join(para)} {noise(20)}"),
            (3, noise(400)), (4, " ".join(items[2][1].split()[:10]) + " " + noise(100)),
            (5, f"{items[3][1]}\n{noise(200)} {items[4][1].upper()}")]
    out = {r.doc_id: r for r in D.find(spark.createDataFrame(rows, "doc_id long, text string"),
                                       spark.createDataFrame(items, "item_id long, text string")).collect()}
    assert out[1].items == [1] and out[2].items == [0] and out[5].items == [3, 4]
    assert not out[3].contaminated and not out[4].contaminated


def test_cosine_search_recall_against_brute_force(spark):
    """Latent cosines reach what exact TF-IDF cosines reach."""
    items = spark.read.parquet(f"{SF}/benchmark.parquet")
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    freq, n = D.document_frequencies(docs)
    assert n == docs.count() and freq.max() <= n
    weight = D.idf(freq, n)
    rows = D.benchmark_rows(items, weight, "item_id", "text", None, 6)
    found = rows.collect()
    vocabulary = np.unique(np.concatenate([r["features"] for r in found]))
    matrix = np.zeros((len(found), len(vocabulary)))
    for k, r in enumerate(found):
        matrix[k, np.searchsorted(vocabulary, r["features"])] = r["values"]
    basis = D.latent_basis(rows, vocabulary, len(found))
    assert np.allclose(basis.T @ basis, np.eye(basis.shape[1]), atol=1e-6)
    exact = matrix @ matrix.T
    latent = (matrix @ basis) @ (matrix @ basis).T
    assert np.abs(exact - latent).max() < 1e-3
    # a lower rank keeps the leading singular values
    low = D.latent_basis(rows, vocabulary, 10)
    s = np.linalg.svd(matrix, compute_uv=False)[:10]
    assert np.allclose(np.linalg.svd(matrix @ low, compute_uv=False)[:5], s[:5], rtol=0.05)


def test_common_subsequence():
    rng = random.Random(2)
    for _ in range(200):
        a, b = ([rng.randrange(5) for _ in range(rng.randrange(20))] for _ in range(2))
        assert D.common_subsequence(a, b) == lcs(a, b)


def test_odd_rows(spark, odd_docs, no_docs):
    items = spark.createDataFrame([(1, None), (2, ""), (3, "The quick brown fox jumps over the lazy dog"),
                                   (3, "the quick brown fox jumps over the lazy dog")], "item_id long, text string")
    out = D.find(odd_docs, items).collect()
    assert len(out) == odd_docs.count()
    assert {r.doc_id for r in out if r.contaminated} == {6, 7}
    assert not any(r.contaminated for r in D.find(odd_docs, items.where("item_id < 3")).collect())
    assert not any(r.contaminated for r in D.find(odd_docs, items.where("false")).collect())
    assert D.find(no_docs, items).count() == 0


def test_blocks_agree(spark, monkeypatch):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    items = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    one = {r.doc_id: tuple(r.items) for r in D.find(docs, items).collect()}
    monkeypatch.setattr(D, "BLOCK", 9)
    assert {r.doc_id: tuple(r.items) for r in D.find(docs, items).collect()} == one


def _planted(rng, lengths, copies=1):
    """Invented items, and long documents that hold each of them verbatim."""
    word = lambda: "".join(rng.choice("bcdfglmnprst") + rng.choice("aeiou") for _ in range(3))
    common = [word() for _ in range(3000)]
    text = lambda n: " ".join(rng.choice(common) for _ in range(n))
    items = [(k, text(n)) for k, n in enumerate(lengths)]
    docs = [(k, f"{text(rng.randrange(100, 160))} {x} {text(rng.randrange(100, 160))}") for k, x in items * copies]
    return items, docs


def test_verbatim_recall_does_not_depend_on_the_benchmark(spark):
    """At production parameters, with more passages than one rank spans."""
    for n in (400, 2000):
        rng = random.Random(n)
        items, docs = _planted(rng, [rng.randrange(16, 60) for _ in range(n)])
        out = D.find(spark.createDataFrame(docs, "doc_id long, text string"),
                     spark.createDataFrame(items, "item_id long, text string")).collect()
        assert not [r.doc_id for r in out if r.doc_id not in r.items]


def test_cosines_do_not_depend_on_the_benchmark(spark):
    """A copy with every seventh word replaced has the same best cosine beside
    600 other items."""
    rng = random.Random(9)
    items, docs = _planted(rng, [40] * 600)
    docs = [(i, " ".join("other" if k % 7 == 3 else w for k, w in enumerate(t.split()))) for i, t in docs[:40]]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    out = {r.doc_id: r for r in D.find(df, spark.createDataFrame(items, "item_id long, text string")).collect()}
    assert not [i for i, r in out.items() if i not in r.items]
    few = D.find(df, spark.createDataFrame(items[:40], "item_id long, text string")).collect()
    assert not [r.doc_id for r in few if out[r.doc_id].best_cosine < r.best_cosine - 1e-4]


def test_passes_agree(spark, monkeypatch):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    items = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    one = {r.doc_id: tuple(r.items) for r in D.find(docs, items).collect()}
    monkeypatch.setattr(D, "TOGETHER", 20)
    assert {r.doc_id: tuple(r.items) for r in D.find(docs, items).collect()} == one


def test_short_items_in_long_documents(spark):
    """Items of 3 to 31 words, copied between more than 100 words on each side."""
    rng = random.Random(12)
    items, docs = _planted(rng, [n for n in [*range(3, 32), *range(5, 16)] for _ in range(4)])
    out = D.find(spark.createDataFrame(docs, "doc_id long, text string"),
                 spark.createDataFrame(items, "item_id long, text string")).collect()
    assert not [r.doc_id for r in out if r.doc_id not in r.items]


def test_short_items_with_an_edit(spark):
    """One word of 8 replaced: too little for a window of 32 words to show."""
    rng = random.Random(13)
    items, docs = _planted(rng, [8] * 100)
    edited = [(i, t.replace(x.split()[4], "other")) for (i, t), (_, x) in zip(docs, items)]
    out = D.find(spark.createDataFrame(edited, "doc_id long, text string"),
                 spark.createDataFrame(items, "item_id long, text string")).collect()
    assert sum(r.doc_id in r.items for r in out) >= 99
