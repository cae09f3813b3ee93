import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from marlstone.llm import simple8b, token_store, vocab
from marlstone.llm.queries import vocabulary
from marlstone.llm.workspace import Workspace

SCHEMA = "doc_id long, text string, ids string"
TEXTS = ["", None, "plain words here", "  two  spaces \n and\tmore ", "ünï çödé ñ", "日本 語\u3000x", "🙂 🙂 a", "<|endoftext|> b", "it's we'll 're", "x" * 500, "a\u200b b \u0301c", "\x1c d \x85 e", "long " * 30_000, "1²3 4", "same", "same"]


@given(st.lists(st.one_of(st.integers(0, 60_000), st.integers(0, 2**64 - 1), st.just(0)), max_size=700), st.sampled_from([1, 7, 64, 4096]))
@settings(max_examples=60, deadline=None)
def test_simple8b(ids, block):
    x = np.array(ids, np.uint64)
    words, offsets, escaped = simple8b.encode(x, block)
    assert (simple8b.decode(words, offsets, escaped, len(x), block) == x).all()
    assert len(offsets) == -(-len(x) // block) + 1


LATIN = st.text(st.sampled_from("abzéßÀ'srtlmd  \n\t\r.,;!?-_%|0719²¼ªɏ¡\xa0\xad"), max_size=40)


@given(st.one_of(st.text(max_size=60), LATIN, st.lists(st.one_of(LATIN, st.sampled_from(["<|endoftext|>", "<|endof", "🙂", " 語", "\u2009", "’s"])), max_size=5).map("".join)))
@settings(max_examples=600, deadline=None)
def test_words_are_exact(text):
    """Against the library as it comes."""
    enc, tk = encoders()
    assert enc.encode(text).tolist() == tk.encode(text, add_special_tokens=False).ids


_made = []


def encoders():
    if not _made:
        from tokenizers import Tokenizer

        _made.extend([vocab.hf_encoder(vocabulary("byte_bpe_50k.json")), Tokenizer.from_file(vocabulary("byte_bpe_50k.json"))])
    return _made


@pytest.mark.parametrize(("roll", "roll_docs"), [(1, 9), (1 << 20, 2), (1 << 20, 1 << 20)])
def test_round_trip(spark, roll, roll_docs):
    rows = [(i * 3 % 17, t, "clash") for i, t in enumerate(TEXTS)] + [(None, "no id", None)]
    root = Workspace(spark, "t").path("x")
    token_store.write_tokens(spark.createDataFrame(rows, SCHEMA).repartition(3), root, vocabulary("byte_bpe_50k.json"), roll=roll, roll_docs=roll_docs)
    _, tk = encoders()
    want, start = [], 0
    for i, t, _ in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or "")):
        ids = [*tk.encode(t or "", add_special_tokens=False).ids, 0]
        want.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()), ids))
        start += len(ids)
    got = [tuple(r) for r in token_store.read_tokens(spark, root, with_ids=True).collect()]
    assert sorted(got, key=lambda r: r[1]) == want
    plain = [tuple(r) for r in token_store.read_tokens(spark, root).collect()]
    assert sorted(plain, key=lambda r: r[1]) == [w[:4] for w in want]


def test_empty(spark):
    root = Workspace(spark, "t").path("x")
    token_store.write_tokens(spark.createDataFrame([], SCHEMA), root, vocabulary("byte_bpe_50k.json"))
    assert token_store.read_tokens(spark, root).count() == 0
