import hashlib

from hypothesis import given, settings
from hypothesis import strategies as st

from citypulse.llm import prefix_hash as H


def brute(rows):
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    out = []
    for k, (i, t) in enumerate(rows):
        t, nxt = t or "", rows[(k + 1) % len(rows)][1] or ""
        half = len(t) // 2
        edited = t[:len(t) - half] + nxt[:half]
        out.append((i, len(t), hashlib.sha256(edited.encode()).hexdigest(), edited, t, nxt))
    return out


def check(spark, rows, partitions):
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(partitions)
    got = sorted(map(tuple, H.fingerprints(df).collect()), key=lambda r: (r[0] is not None, r[0] or 0, r[2]))
    want = sorted(brute(rows), key=lambda r: (r[0] is not None, r[0] or 0, r[2]))
    assert [g[:3] for g in got] == [w[:3] for w in want]
    for g, w in zip(got, want):
        assert g[3] == H.Text(w[4]).fingerprint and g[4] == H.Text(w[3]).fingerprint
        assert g[5] == H.likeness(g[3], g[4]) and g[6] == H.likeness(g[3], H.Text(w[5]).fingerprint)
        same = next((k for k, (x, y) in enumerate(zip(w[4], w[3])) if x != y), min(len(w[4]), len(w[3])))
        assert g[7] == same


def test_against_brute_force(spark):
    docs = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
            .select("doc_id", "text").limit(60).collect()]
    check(spark, docs, 7)
    check(spark, docs[:1], 1)


def test_odd_rows(spark, odd_docs, no_docs):
    check(spark, [(r.doc_id, r.text) for r in odd_docs.collect()], 3)
    assert H.fingerprints(no_docs).count() == 0
    assert H.fingerprints(odd_docs).count() == odd_docs.count()


@settings(max_examples=100, deadline=None)
@given(st.text(alphabet="ab", max_size=40), st.text(alphabet="abé", max_size=40))
def test_spans_and_extensions(a, b):
    x, y = H.PrefixHash(a), H.PrefixHash(b)
    for i in range(0, len(a), 3):
        for j in range(0, len(b), 3):
            want = next((k for k in range(min(len(a) - i, len(b) - j)) if a[i + k] != b[j + k]),
                        min(len(a) - i, len(b) - j))
            assert H.common_extension(x, i, y, j) == want
    assert (H.Text(a).fingerprint == H.Text(b).fingerprint) == (a == b)


def test_likeness_follows_overlap():
    a = " ".join(f"w{k * 7919 % 5000}" for k in range(400))
    fp = H.Text(a).fingerprint
    assert H.likeness(fp, H.Text(a[:-8] + "ending.").fingerprint) > 0.8
    assert H.likeness(fp, H.Text(a[::-1]).fingerprint) < 0.2
    assert H.likeness(H.Text("").fingerprint, H.Text("").fingerprint) == 1.0
    assert H.likeness(H.Text("").fingerprint, fp) == 0.0
