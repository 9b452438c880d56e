import public_tokenizers
import pytest
from tokenizers import Tokenizer

from depthframe.llm import tokens
from tests.llm.fixtures import docs, prose

PATH = public_tokenizers.path("word_bpe_49k.json")
TEXTS = [
    None, "", " ", "Hello  World's \t\n it's 1234 <|endoftext|> x<|startoftext|>y", "\x1c\x1d a\x85b\u3000c", "é́ e\u0301 İI ﬁ Σς", "漢字 " * 700,
    prose(1, 900), "x" * 4000, "don't " * 600, "a\u0301 \u0301b " * 500, ("word" * 300 + " ") * 4, "🙂 🙂‍🔥 " * 400,
]


@pytest.mark.parametrize("overlap", [8, 64])
def test_equals_the_library_cut_or_whole(spark, overlap):
    library = Tokenizer.from_file(PATH)
    rows = list(enumerate(TEXTS)) + [(3, TEXTS[3]), (None, TEXTS[7])]
    want = sorted((str(i), len((t or "").encode()), len(library.encode(t or "", add_special_tokens=False))) for i, t in rows)
    got = tokens.count_tokens(docs(spark, rows, extra=True), PATH, huge=300, chunk=250, overlap=overlap)
    assert sorted((str(r.doc_id), r.n_bytes, r.n_tokens) for r in got.collect()) == want


def test_empty_table(spark):
    assert tokens.count_tokens(docs(spark, []), PATH).count() == 0
