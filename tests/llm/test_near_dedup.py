import random
import re
from collections import Counter

import numpy as np
import pytest

from citypulse.llm import bag_minhash as B
from citypulse.llm.components import components
from citypulse.llm.kernels import counted, shingles, words

VOCAB = [a + b for a in "bdfgklmnprst" for b in ("a", "en", "ir", "ou", "ust")]


def bag(text):
    w = re.findall(r"[0-9a-z]+", (text or "").lower())
    if not w:
        return Counter()
    return Counter(tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4)))


def overlap(a, b):
    return sum((a & b).values()) / max(1, sum((a | b).values()))


def brute(rows):
    """Least id per class under links of 0.8 or more and equal texts."""
    bags = {i: bag(t) for i, t in rows}
    root = {i: i for i, _ in rows}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    text = dict(rows)
    for i in root:
        for j in root:
            if i < j and (overlap(bags[i], bags[j]) >= 0.8 if bags[i] and bags[j]
                          else not bags[i] and not bags[j] and (text[i] or "").strip() and text[i] == text[j]):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return {i: find(i) for i in root}


def corpus(seed, n=120):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        if i and rng.random() < 0.5:
            w = rng.choice(rows)[1].split(" ")
            for _ in range(rng.choice([0, 1, 1, 2, 4])):
                w[rng.randrange(len(w))] = rng.choice(VOCAB)
            rows.append((i, " ".join(w)))
        else:
            rows.append((i, " ".join(rng.choice(VOCAB) for _ in range(rng.choice([1, 3, 7, 40, 150])))))
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_classes_against_brute_force(spark, seed):
    rows = corpus(seed) + [(900, ""), (901, None), (902, "?!"), (903, "?!"), (904, " "), (905, " ")]
    got = {r.doc_id: r.class_id for r in B.classes(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == brute(rows)


def test_large_group_of_variants(spark):
    """A hub text, many one-word variants of it, and exact copies."""
    rng = random.Random(3)
    hub = [rng.choice(VOCAB) for _ in range(120)]
    rows = []
    for i in range(150):
        w = list(hub)
        if i % 3:
            w[rng.randrange(120)] = rng.choice(VOCAB)
        rows.append((i, " ".join(w)))
    out = B.classes(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.class_id for r in out} == {0} and sum(r.keep for r in out) == 1


def test_register_collisions_estimate_weighted_overlap():
    rng = np.random.default_rng(0)
    for wa, wb, shared in ((1, 1, 60), (7, 4, 60), (40, 3, 30)):
        size = 100
        hits = []
        for t in range(60):
            base = rng.integers(0, 2 ** 63, size * 2, dtype=np.uint64)
            a, b = base[:size], base[size - shared:2 * size - shared]
            ra = B.registers(a, np.zeros(size, np.int64), np.full(size, float(wa)), 1)
            rb = B.registers(b, np.zeros(size, np.int64), np.full(size, float(wb)), 1)
            hits.append((ra == rb).mean())
        common = shared * min(wa, wb)
        want = common / (size * wa + size * wb - common)
        assert abs(np.mean(hits) - want) < 0.03


def test_odd_rows(odd_docs, no_docs):
    out = B.classes(odd_docs).collect()
    assert len(out) == odd_docs.count()
    by = {r.doc_id: r for r in out}
    assert by[6].class_id == by[7].class_id == 6 and not by[7].keep
    for i in (1, 2, 3, 4, 5, 8, 9, 10):
        assert by[i].class_id == i and by[i].keep
    assert B.classes(no_docs).count() == 0


def test_shingle_kernel():
    import pyarrow as pa
    texts = ["a b c d e f", "A  b\nc d", None, "", "x", "b c d e f a b c d e f"]
    h, off = words(pa.array(texts))
    sh, row, n = counted(*shingles(h, off, 5))
    for i, t in enumerate(texts):
        assert sorted(n[row == i]) == sorted(bag(t).values())


@pytest.mark.parametrize("seed", range(3))
def test_components(spark, seed):
    rng = random.Random(seed)
    links = [(rng.randrange(60), rng.randrange(60)) for _ in range(45)] + [(100 + i, 101 + i) for i in range(30)]
    root = {}

    def find(i):
        while root.setdefault(i, i) != i:
            i = root[i]
        return i
    for a, b in links:
        x, y = find(a), find(b)
        root[max(x, y)] = min(x, y)
    want = {(i, find(i)) for i in list(root) if find(i) != i}
    got = {tuple(r) for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == want
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
