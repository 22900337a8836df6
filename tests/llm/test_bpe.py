import hashlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from fleetlens.llm import bpe, common as C

from .conftest import odd_rows, rows, sha

PATH = C.tokenizer_path()
HF = Tokenizer.from_file(PATH)


def ids(text):
    return HF.encode(text or "", add_special_tokens=False).ids


def brute(data):
    out = []
    for i, t in data:
        got = ids(t)
        raw = np.array(got, dtype="<u4").tobytes()
        out.append((i, len(got), hashlib.sha256(raw).hexdigest(), sha(HF.decode(got, skip_special_tokens=False))))
    return sorted(out, key=repr)


def test_odd_rows(odd):
    assert rows(bpe.encode_documents(odd, PATH)) == brute([(r[0], r[1]) for r in odd_rows()])


def test_table(small):
    assert rows(bpe.encode_documents(small, PATH)) == brute([(r.doc_id, r.text) for r in small.collect()])


def test_round_trip(odd):
    coded = bpe.encode_documents(odd.select("doc_id", "text"), PATH, ids_col="ids")
    back = bpe.decode_documents(coded, PATH)
    assert rows(back, "doc_id", "text") == sorted(((r[0], r[1] or "") for r in odd_rows()), key=repr)


def test_empty(none):
    assert bpe.encode_documents(none, PATH).count() == 0


CODEC = bpe.codec(PATH)
PIECES = st.lists(st.one_of(st.text(max_size=6), st.sampled_from(
    [" ", "  ", "\n", "\n\n", "\t", "'s", "'ll", "'", "*'s", "é", "日本", "!!", "<|endoftext|>", "abc", "12", "\x85",
     "\x1c", " ", " ", "***", "|", "’", "\r\n"])), max_size=14).map("".join)


@settings(max_examples=600, deadline=None)
@given(PIECES)
def test_same_ids_as_the_library(text):
    text = text.encode("utf-8", "ignore").decode()
    got = CODEC.encode_batch([text])[0]
    assert np.frombuffer(got, "<u4").tolist() == ids(text)
    assert CODEC.decode(got) == HF.decode(ids(text), skip_special_tokens=False)


def test_cuts_are_forced():
    """No vocabulary token holds a pair at which a text is cut."""
    vocab = {CODEC.piece[i] for i in range(len(CODEC.piece)) if CODEC.piece[i] != b"<|endoftext|>"}
    for text in ("###***&&&", "thing|other|ö%%%", "ABC日本語def"):
        parts, count = CODEC.fragments([text, "a"])
        assert b"".join(parts) == text.encode() + b"a" and count.tolist() == [len(parts) - 1, 1]
        assert len(parts) > 2
        parts = parts[:-1]
        for left, right in zip(parts, parts[1:]):
            pair = left[-1:] + right[:1]
            assert not any(pair in v for v in vocab)


def test_cache_is_bounded(monkeypatch):
    monkeypatch.setattr(bpe, "CACHE_ENTRIES", 10)
    code = bpe.ForcedBoundaryCodec(PATH)
    for k in range(20):
        text = " ".join(f"word{k}n{i}" for i in range(30))
        assert np.frombuffer(code.encode_batch([text])[0], "<u4").tolist() == ids(text)
    assert len(code.cache) <= 40


@pytest.mark.parametrize("text", ["", " ", "a"])
def test_tiny(text):
    assert np.frombuffer(CODEC.encode_batch([text])[0], "<u4").tolist() == ids(text)
