import hashlib
import random
import re

from hypothesis import given, settings
from hypothesis import strategies as st

from citypulse.llm import pii, queries

AUTO = pii.automaton()


def brute(text):
    """Base spans by a scan with the four patterns, then the checks."""
    def luhn(d):
        return sum(int(c) if i % 2 == 0 else sum(map(int, str(2 * int(c)))) for i, c in enumerate(d[::-1])) % 10 == 0

    digits = lambda s: "".join(c for c in s if c in "0123456789")
    fits = {"email": lambda s: True,
            "ip": lambda s: all(int(p) <= 255 for p in s.split(".")),
            "card": lambda s: 13 <= len(digits(s)) <= 19 and luhn(digits(s)),
            "phone": lambda s: 9 <= len(digits(s)) <= 15}
    return [(k, m.start(), m.end()) for k, p in pii.BASE.items() for m in re.finditer(p, text) if fits[k](m.group())]


def base(text):
    return [s for s in pii.find_spans(text, AUTO) if s[0] in pii.BASE]


def added(text):
    return [(k, text[a:b]) for k, a, b in pii.find_spans(text, AUTO) if k in pii.ADDED]


@settings(max_examples=1500, deadline=None)
@given(st.text(alphabet="a@.-+() 0123456789_%Zé\n", max_size=60))
def test_base_equals_the_patterns(text):
    assert base(text) == brute(text)


@settings(max_examples=800, deadline=None)
@given(st.lists(st.sampled_from(["a@b.c", "@", "x@y", ".z", "1.2.3.4", "256.1.1.1", ".5", " ", "-", "4111111111111111",
                                 "4111 1111 1111 1111", "0000", "+1 (017) 555-7713", "+", "(", "00000.1.2.3", "12", "é",
                                 "٣", "iban DE89370400440532013000", "account 12345"]), max_size=12).map("".join))
def test_base_equals_the_patterns_on_pieces(text):
    assert base(text) == brute(text)


def test_many_random_strings():
    r = random.Random(3)
    for _ in range(3000):
        text = "".join(r.choice("ab@@..--++0123456789 ()") for _ in range(r.randrange(80)))
        assert base(text) == brute(text), text


def test_added_kinds():
    assert added("write to jo.doe (at) mail [dot] example.org now") == [("masked_email", "jo.doe (at) mail [dot] example.org")]
    assert added("see ftp://bob:pw@files.example.org/x, or http://10.0.0.1/a.") == [
        ("url", "ftp://bob:pw@files.example.org/x"), ("url", "http://10.0.0.1/a")]
    assert added("https://www.example.org/license and http://a.org?x=@y are public") == []
    assert added("mailto:a@b.org tel:+4912345678") == [("url", "mailto:a@b.org"), ("url", "tel:+4912345678")]
    assert added("DE89 3704 0044 0532 0130 00 ok") == [("iban", "DE89 3704 0044 0532 0130 00")]
    assert added("DE88 3704 0044 0532 0130 00 no") == []
    assert added("Account no: 123-456-789 and accountant 123456") == [("account", "123-456-789")]
    assert added("pos 12 4111 1111 1111 1111 7") == [("account", "4111 1111 1111 1111")]


def test_long_digits_and_anchors_stay_linear():
    assert base("1" * 300_000) == []
    assert base("@" * 200_000 + "a@b.c") == [("email", 200_000, 200_005)]
    assert base("a" * 200_000 + "@") == []
    assert base("+1" + "(" * 200_000) == []
    assert len(base("1.2.3.4 " * 20_000)) == 20_000


def test_query_on_all_rows(spark, tmp_path, odd_docs, no_docs):
    rows = [(1, "mail a.b@c.de or +1 (017) 555-7713, 10.0.0.256 and 9.9.9.9; card 4111 1111 1111 1111"), (2, None),
            (3, ""), (4, "é" * 5 + "x@y.z"), (4, "é" * 5 + "x@y.z"), (None, "1.1.1.1"), (5, "w " * 100_000 + "q@r.st")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    out = [r.asDict() for r in queries.op11_pii(spark, str(tmp_path)).collect()]
    assert len(out) == len(rows)
    by_id = {r["doc_id"]: r for r in out}
    for i, t in rows:
        spans = brute(t or "")
        want = ",".join(f"{k}:{a}:{b}" for k, a, b in spans)
        assert by_id[i]["base_sha256"] == hashlib.sha256(want.encode()).hexdigest()
        assert by_id[i]["spans"].startswith(want)
        assert [by_id[i][f"n_{k}"] for k in pii.BASE] == [sum(s[0] == k for s in spans) for k in pii.BASE]
    assert pii.find(odd_docs).count() == odd_docs.count()
    assert pii.find(no_docs).count() == 0


def test_real_documents_against_the_patterns(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    found = {r["doc_id"]: [tuple(s) for s in r["spans"] if s["kind"] in pii.BASE] for r in pii.find(docs).collect()}
    assert all(found[r["doc_id"]] == brute(r["text"] or "") for r in docs.collect())
    assert sum(map(len, found.values())) > 10


def test_redact(spark):
    df = spark.createDataFrame([(1, "a@b.de and 1.2.3.4!"), (2, None), (3, "nothing")], "doc_id long, text string")
    assert {r[0]: r[1] for r in pii.redact(df).collect()} == {1: "<email> and <ip>!", 2: None, 3: "nothing"}
