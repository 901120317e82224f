"""One id on several texts, null ids, repeated rows: every row has its own result."""

import corpus_pipeline as C
from citypulse.llm import bag_minhash as M
from citypulse.llm import chat_format, decontaminate, line_dedup, packing

WORDS = "amber basin cedar delta ember fjord grove haven inlet jetty knoll lagoon marsh north ocean plain quarry ridge".split()


def text(k, n=60):
    return " ".join(WORDS[(k * 7 + i * (k + 3) + i * i) % len(WORDS)] + str((k * 31 + i) % 50) for i in range(n))


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string")


def test_a_line_goes_from_the_text_that_holds_it(spark):
    rows = [(1, "B line with enough words\nown"), (2, "B line with enough words\nsecond"), (2, "a unique first line\nand more")]
    got = sorted(map(tuple, line_dedup.clean(frame(spark, rows)).collect()))
    assert got == sorted([rows[0], (2, "second"), rows[2]])


def test_lines_without_an_id_stay_in_report_and_text(spark):
    rows = [(1, "same line here\nother"), (None, "same line here\nthird"), (None, "same line here")]
    got = [tuple(r) for r in line_dedup.clean(frame(spark, rows)).collect()]
    assert sorted(got, key=str) == sorted(rows, key=str)
    report = {r.doc_id: (r.n_lines, r.n_dropped) for r in line_dedup.report(frame(spark, rows)).collect()}
    assert report == {1: (2, 0), None: (3, 0)}


def test_near_copies_without_an_id_join_the_class(spark):
    a, b = text(1), text(1).replace("amber", "amberx", 1)
    rows = [(5, a), (None, a), (None, b), (9, text(2)), (None, text(3))]
    got = {(r.doc_id, r.class_id, r.keep) for r in M.classes(frame(spark, rows)).collect()}
    assert got == {(5, 5, True), (None, 5, False), (9, 9, True), (None, None, True)}
    kept = sorted(map(tuple, M.one_of_each(frame(spark, rows)).collect()), key=str)
    assert kept == sorted([rows[0], rows[3], rows[4]], key=str)


def test_null_ids_alone_form_classes_too(spark):
    rows = [(None, text(1)), (None, text(1) + " tail"), (None, text(2)), (None, None), (None, None)]
    kept = [r.text for r in M.one_of_each(frame(spark, rows)).collect()]
    assert sorted(kept, key=str)[:2] == [None, None] and len(kept) == 4 and text(2) in kept


def test_one_row_of_each_class_in_the_pipeline(spark):
    t, u = text(1), text(2)
    rows = [(1, t), (6, t), (6, u), (7, u), (7, u), (8, t + "!"), (8, text(3)), (8, text(3))]
    got = sorted(map(tuple, dict(C.STAGES)["near_dedup"](spark, frame(spark, rows), "/root/testdata/sf0.001").collect()))
    assert got == sorted([(1, t), (6, u), (8, text(3))])


def test_rows_of_several_passes(spark, monkeypatch):
    """Null and repeated ids keep their own rows in every pass over the benchmark."""
    items = spark.createDataFrame([(k, text(k, 40)) for k in range(12)], "item_id long, text string")
    rows = [(1, f"intro words {text(3, 40)} outro"), (1, "nothing here"), (None, f"x {text(5, 40)}"), (None, "clean text"),
            (None, f"{text(3, 40)} and {text(9, 40)}"), (1, f"intro words {text(3, 40)} outro"), (2, None)]
    want = sorted((r.doc_id or -1, tuple(r.items)) for r in decontaminate.find(frame(spark, rows), items).collect())
    assert want == sorted([(1, (3,)), (1, ()), (-1, (5,)), (-1, ()), (-1, (3, 9)), (1, (3,)), (2, ())])
    for together, chain in ((5, 4), (3, 2)):
        monkeypatch.setattr(decontaminate, "TOGETHER", together)
        monkeypatch.setattr(decontaminate, "CHAIN", chain)
        got = sorted((r.doc_id or -1, tuple(r.items)) for r in decontaminate.find(frame(spark, rows), items).collect())
        assert got == want


def test_bad_records_go_to_unmapped(spark):
    deep = "[" * 3000 + "]" * 3000
    raw = ['{"turn":"first","role":"user","text":"x"}', '{"id":99999999999999999999999,"prompt":"a","response":"b"}',
           '{"prompt": %s, "response": "b"}' % deep, "{", None, '{"turn":0,"role":"user","text":"fine"}']
    df = spark.createDataFrame([(k, r) for k, r in enumerate(raw)], "k long, record string")
    got = {(r.conv_id, r.layout) for r in chat_format.canonical(df, "record", "k").collect()}
    assert {(k, "unmapped") for k in (0, 3, 4)} <= got and any(k == 5 and x != "unmapped" for k, x in got)
    assert len({k for k, _ in got}) == 6
    assert chat_format.canonical(df, "record").where("layout = 'unmapped'").count() >= 4


def test_blocks_of_equal_rows_are_bounded(spark):
    df = spark.range(20_000).selectExpr("cast(null as long) as doc_id", "repeat('a', 100) as text")
    out = packing.pack(df, block_items=1000)
    per = out.selectExpr("split(bin_id, '-')[0] as block").groupBy("block").count().collect()
    assert out.count() == 20_000 and len(per) == 20 and max(r["count"] for r in per) < 1300


def test_mixed_lengths_open_more_than_one_size():
    mixed = sorted([700] * 40 + [1000] * 60 + [1900] * 30 + [3000] * 10 + [5000] * 7 + [8000] * 3, reverse=True)
    sizes = (1024, 2048, 4096, 8192)
    _, _, final = packing.pack_block(mixed, sizes, [c * (1 + c / 16384) for c in sizes])
    assert len(set(final)) == 4
    best = sum({c: c * (1 + c / 16384) for c in sizes}[c] for c in final)
    for c in (8192,):  # packing at one size only costs more
        _, _, one = packing.pack_block(mixed, (c,), [1.0])
        assert best < len(one) * c * (1 + c / 16384)


