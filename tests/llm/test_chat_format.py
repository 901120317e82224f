import hashlib
import json

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from citypulse.llm import chat_format as C
from citypulse.llm import queries


def digest(turns):
    h = hashlib.sha256()
    for role, text in turns:
        h.update(f"{role}\n{text}\n".encode())
    return h.hexdigest()


def brute(rows):
    """(conv, turn, role, text) rows -> contract columns."""
    out = {}
    for conv in {r[0] for r in rows}:
        turns = [(r[2] or "", r[3] or "") for r in sorted((r for r in rows if r[0] == conv), key=lambda r: r[1])]
        loss = "".join(t for r, t in turns if r == "assistant")
        out[conv] = (len(turns), digest(turns), len(loss), hashlib.sha256(loss.encode()).hexdigest())
    return out


def test_query_against_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    said = "\\### Assistant: </turn> ok"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet").select(
        "conv_id", "turn", "role", "text").collect()] + [(-7, 0, "user", said), (-7, 1, "assistant", said)]
    got = {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256)
           for r in queries.op2_chat_format(spark, sf).collect()}
    assert got == brute(rows)


LAYOUTS = [
    ({"id": 1, "messages": [{"role": "user", "content": "q"}, {"role": "assistant", "content": "a"}]},
     [("user", "q"), ("assistant", "a")]),
    ({"id": 2, "conversations": [{"from": "human", "value": "q"}, {"from": "gpt", "value": "a"}]},
     [("user", "q"), ("assistant", "a")]),
    ({"id": 3, "instruction": "i", "input": "x", "output": "o"}, [("user", "i"), ("user", "x"), ("assistant", "o")]),
    ({"id": 4, "instruction": "i", "output": "o"}, [("user", "i"), ("assistant", "o")]),
    ({"id": 5, "prompt": "p", "completion": "c", "extra": {"deep": [1, 2]}}, [("user", "p"), ("assistant", "c")]),
    ({"id": 6, "system": "s", "prompt": "p", "response": "r"}, [("system", "s"), ("user", "p"), ("assistant", "r")]),
    ({"id": 7, "data": {"prompt": "p", "response": None}}, [("user", "p"), ("assistant", "")]),
    ({"id": 8, "question": "q", "answer": "a"}, [("user", "q"), ("assistant", "a")]),
    ({"id": 9, "messages": []}, []),
]


def test_layouts_and_rejects(spark):
    raw = [(json.dumps(r),) for r, _ in LAYOUTS] + [("not json",), (None,), ('{"other": 1}',), ("[1]",)]
    rows = C.canonical(spark.createDataFrame(raw, "record string")).collect()
    for record, turns in LAYOUTS:
        mine = sorted((r.turn, r.role, r.text) for r in rows if r.conv_id == record["id"])
        assert [(r, t) for _, r, t in mine] == turns
    assert sum(r.layout == "unmapped" for r in rows) == 4


def test_fingerprint_ignores_order_and_length():
    a = {"messages": [{"role": "u", "content": "x"}], "id": 1}
    b = {"id": 2, "messages": [{"content": "y", "role": "v"}] * 5}
    assert C.fingerprint(C.paths(a)) == C.fingerprint(C.paths(b))
    assert C.fingerprint(C.paths(a)) != C.fingerprint(C.paths({"id": 1, "messages": [{"role": "u"}]}))


@settings(max_examples=30, deadline=None)
@given(st.lists(st.tuples(st.text(alphabet="us:\\\n#<r", max_size=5), st.text(alphabet="#</turn> \\\nA:ok", max_size=40)),
                min_size=1, max_size=4), st.integers(1, 9))
def test_reader_takes_any_cut(turns, size):
    def esc(s, role=False):
        s = "".join("\\" + c if c in "\\#<" else c for c in s)
        return s.replace(":", "\\:").replace("\n", "\\n") if role else s
    text = "".join(f"### {esc(r, True)}:\n{esc(t)}</turn>\n" for r, t in turns)
    reader = C.Reader()
    for k in range(0, len(text), size):
        reader.feed(text[k:k + size])
    row = reader.row(0)
    assert row[1] == len(turns) and row[2] == digest(turns) and row[5] == len(text)


def test_odd_turns(spark):
    rows = [(1, None, None, None), (1, 0, "assistant", ""), (1, 0, "assistant", ""), (2, 3, "a:b\nc\\", "### x</turn>\n"),
            (None, 1, "user", "é😀")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = {r.conv_id: r for r in C.read_back(C.format_turns(df)).collect()}
    assert got[1].n_turns == 3 and got[1].loss_chars == 0
    assert got[2].turns_sha256 == digest([("a:b\nc\\", "### x</turn>\n")])
    assert got[None].turns_sha256 == digest([("user", "é😀")])
    assert C.read_back(C.format_turns(df.where("false"))).count() == 0
