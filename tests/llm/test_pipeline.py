import os

import corpus_pipeline as C
from citypulse.llm import bag_minhash, decontaminate, language_id, line_dedup


def test_stages_take_effect(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(os.path.join(sf, "documents.parquet"))
    assert [n for n, _ in C.STAGES] == ["language", "line_dedup", "near_dedup", "decontaminate", "packing"]
    now = docs
    for name, stage in C.STAGES[:-1]:
        out = stage(spark, now, sf)
        assert out.columns == docs.columns, name
        out = out.checkpoint()
        ids = {r.doc_id for r in out.select("doc_id").collect()}
        before = {r.doc_id for r in now.select("doc_id").collect()}
        if name == "language":
            proto = language_id.learn(now.where(language_id.remainder("doc_id", 4) != 2))
            bad = {r.doc_id for r in language_id.predict(now, proto, ["doc_id"]).collect()
                   if r.lang_pred == "und" or r.score < C.MIN_COSINE}
            assert ids == before - bad
        elif name == "line_dedup":
            assert {(r.doc_id, r.text) for r in out.collect()} == {
                (r.doc_id, r.text) for r in line_dedup.clean(now).collect()}
            assert line_dedup.duplicates(out).count() == 0
        elif name == "near_dedup":
            assert ids == {r.doc_id for r in bag_minhash.classes(now).collect() if r.keep}
        else:
            items = spark.read.parquet(os.path.join(sf, "benchmark.parquet"))
            bad = {r.doc_id for r in decontaminate.find(now, items).collect() if r.contaminated}
            assert ids == before - bad
        now = out
    packed = C.STAGES[-1][1](spark, now, sf)
    assert packed.groupBy("doc_id").count().count() == now.count()


def test_odd_rows_pass_every_stage(spark, odd_docs):
    extra = odd_docs.selectExpr("doc_id", "text", "lang", "id as source", "length(text) as n_chars", "*").select(
        "doc_id", "text", "lang", "source", "n_chars", "id", "bucket", "node")
    now = extra
    for name, stage in C.STAGES[:-1]:
        now = stage(spark, now, "/root/testdata/sf0.001").checkpoint()
        assert now.columns == extra.columns
    assert now.where("doc_id = 7").count() <= 1
    empty = extra.where("false")
    for name, stage in C.STAGES:
        empty = stage(spark, empty, "/root/testdata/sf0.001") if name == "packing" else \
            stage(spark, empty, "/root/testdata/sf0.001").checkpoint()
        assert empty.count() == 0


def test_run_equals_its_stages(spark):
    sf = "/root/testdata/sf0.001"
    assert C.run(spark, sf).count() > 0


def test_leaks_are_dropped_by_row(spark):
    """Null ids are dropped too; a clean text under the id of a leak stays."""
    sf = "/root/testdata/sf0.001"
    item = max((r.text for r in spark.read.parquet(os.path.join(sf, "benchmark.parquet")).collect()), key=len)
    rows = [(None, f"held here {item} in full"), (None, "nothing of the kind"), (1, f"again {item}"), (1, "own words")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {tuple(r) for r in dict(C.STAGES)["decontaminate"](spark, df, sf).collect()}
    assert got == {rows[1], rows[3]}
