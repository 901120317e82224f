import zlib

import numpy as np
import pyarrow as pa

from citypulse.llm import language_id as I
from citypulse.llm import quality as Q
from citypulse.llm import queries

SF = "/root/testdata/sf0.01"


def test_language_held_out(spark):
    rows = queries.op5_language_id(spark, SF).collect()
    lang = {r.doc_id: r.lang for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang").collect()}
    assert len(rows) == len(lang)
    held = [r for r in rows if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    assert np.mean([r.lang_pred == lang[r.doc_id] for r in held]) > 0.98
    assert all(0 <= r.score <= 1 for r in rows)


def test_cosine_against_plain_vectors():
    text = "Ab, cab!"
    I._letters()
    state = I._STATE
    s = [0] + [state["slot"][ord(c)] for c in "ab"] + [0] + [state["slot"][ord(c)] for c in "cab"] + [0]
    want = sum(state["a"][x].astype(int) * state["b"][y] * state["c"][z] for x, y, z in zip(s, s[1:], s[2:]))
    assert np.array_equal(I.bundle([text])[0], want)
    assert not I.bundle([None, "", "123 !"]).any()


def test_language_odd_rows(spark, odd_docs, no_docs):
    proto = I.learn(odd_docs)
    assert set(proto) == {"en", "de", "fr"}
    out = I.predict(odd_docs, proto, ["doc_id"]).collect()
    assert len(out) == odd_docs.count()
    by = {r.doc_id: r for r in out}
    assert [by[i].lang_pred for i in (1, 2, 3, 4)] == ["und"] * 4 and by[8].lang_pred == "de"
    assert I.learn(no_docs) == {}
    assert {r.lang_pred for r in I.predict(odd_docs, {}, ["doc_id"]).collect()} == {"und"}
    assert I.predict(no_docs, proto, ["doc_id"]).count() == 0


def test_quality_held_out(spark):
    rows = queries.op6_quality(spark, SF).collect()
    assert len(rows) == spark.read.parquet(f"{SF}/documents.parquet").count()
    mark = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    held = [(r.score, mark[r.doc_id]) for r in rows if r.held_out and r.doc_id in mark]
    pos, neg = ([s for s, y in held if y == k] for k in (1, 0))
    auc = np.mean([(p > n) + 0.5 * (p == n) for p in pos for n in neg])
    assert auc > 0.97
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    assert all(r.predicted == int(r.score >= 0.5) for r in rows)


def test_features_against_loops():
    texts = ["ab  cde\n", "", None, "é xy"]
    bucket, row = Q.features(pa.array(texts))
    for i, t in enumerate(texts):
        raw = (t or "").encode().replace(b"\n", b" ")
        n = len(raw.split())
        for g in Q.GRAMS:
            n += sum(b" " not in raw[k + 1:k + g - 1] for k in range(len(raw) - g + 1))
        assert (row == i).sum() == n
    again, _ = Q.features(pa.array(["x", "ab  cde\n"]))
    assert sorted(again[-(row == 0).sum():]) != [] and set(bucket[row == 0]) <= set(again)


def test_quality_odd_rows(odd_docs, no_docs, spark):
    labels = spark.createDataFrame([(6, 1), (9, 0), (8, None), (77, 1), (6, 1)], "doc_id long, quality int")
    model = Q.learn(odd_docs, labels)
    out = Q.score(odd_docs, model, ["doc_id"]).collect()
    assert len(out) == odd_docs.count() and all(0 <= r.score <= 1 for r in out)
    by = {r.doc_id: r.score for r in out}
    assert by[6] > by[9] and by[1] == by[2]
    none = Q.learn(odd_docs, labels.where("false"))
    assert {r.score for r in Q.score(odd_docs, none, ["doc_id"]).collect()} == {0.5}
    assert Q.score(no_docs, model, ["doc_id"]).count() == 0
