import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from citypulse.llm.token_counts import Merger, count_tokens

PATH = public_tokenizers.path("piece_bpe_32k.model")
LIB = sentencepiece.SentencePieceProcessor(model_file=PATH)
OWN = Merger(PATH)


@pytest.mark.parametrize("text", [
    "", " ", "   ", "a", " a", "a ", "a  b", "\t\n x", "<s> hi </s> <unk> <0x0A>", "▁x ▁", "\x00a", "ﬁ １ é é 😀\n\n",
    "the quick brown fox " * 50, "x" * 3000, " " * 700, "日本語 テキスト", "¡Qué!\nÑandú"])
def test_library_counts(text):
    assert OWN.count(text) == len(LIB.encode(text))


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.sampled_from("abcdetion hers\n▁ éß.,!<>/0x1\t"), max_size=60))
def test_random_texts(text):
    assert OWN.count(text) == len(LIB.encode(text))


def test_whole_documents(spark, sf_docs):
    got = {r.doc_id: (r.n_bytes, r.n_tokens) for r in count_tokens(sf_docs, PATH).collect()}
    want = {r.doc_id: (len(r.text.encode()), len(LIB.encode(r.text))) for r in sf_docs.collect()}
    assert got == want


def test_odd_rows(odd_docs, no_docs):
    got = sorted((r.doc_id or 0, r.n_bytes, r.n_tokens) for r in count_tokens(odd_docs, PATH).collect())
    want = sorted((r.doc_id or 0, len((r.text or "").encode()), len(LIB.encode(r.text or "")))
                  for r in odd_docs.collect())
    assert got == want
    assert count_tokens(no_docs, PATH).count() == 0
