from collections import Counter

import pytest
from pyspark.sql import functions as F

from fleetlens.llm import substring

from .conftest import odd_rows, rows, sha, words


def brute(data, size):
    texts = [words(t) for _, t in data]
    seen = Counter(tuple(w[s:s + size]) for w in texts for s in range(len(w) - size + 1))
    out = []
    for (i, _), w in zip(data, texts):
        gone = set()
        for s in range(len(w) - size + 1):
            if seen[tuple(w[s:s + size])] > 1:
                gone.update(range(s, s + size))
        out.append((i, len(w), len(gone), sha(" ".join(x for k, x in enumerate(w) if k not in gone))))
    return sorted(out, key=repr)


@pytest.mark.parametrize("size,anchor", [(35, 12), (5, 3), (3, 3), (2, 1), (1, 1)])
def test_odd_rows(odd, size, anchor):
    got = rows(substring.remove_repeated(odd, size, anchor, digest=True))
    assert got == brute([(r[0], r[1]) for r in odd_rows()], size)


@pytest.mark.parametrize("size,anchor", [(35, 12), (8, 4)])
def test_table(small, size, anchor):
    got = rows(substring.remove_repeated(small, size, anchor, digest=True))
    assert got == brute([(r.doc_id, r.text) for r in small.collect()], size)


@pytest.mark.parametrize("size,anchor,part_bytes", [(35, 12, 20_000), (8, 4, 3_000), (3, 2, 500)])
def test_many_parts(small, odd, size, anchor, part_bytes):
    got = rows(substring.remove_repeated(small, size, anchor, digest=True, part_bytes=part_bytes))
    assert got == brute([(r.doc_id, r.text) for r in small.collect()], size)
    got = rows(substring.remove_repeated(odd, size, anchor, digest=True, part_bytes=part_bytes))
    assert got == brute([(r[0], r[1]) for r in odd_rows()], size)


def test_branching_passages(spark):
    """Copies that share only the start, the middle or the end of a passage."""
    a, b, c = ([f"{x}{i}" for i in range(9)] for x in "abc")
    texts = [a + b + c, ["x"] + a + b + ["y"], b + c, ["z"] + b + ["w"], c + a + ["v"], a[1:] + c[:-1], b[2:] + b[:5]]
    data = [(i, " ".join(t)) for i, t in enumerate(texts)]
    df = spark.createDataFrame(data, "doc_id long, text string")
    for size in (1, 2, 5, 8):
        for part_bytes in (1, 150, 1 << 20):
            assert rows(substring.remove_repeated(df, size, 1, digest=True, part_bytes=part_bytes)) == brute(data, size)


def test_automata_find_places_that_nobody_told():
    """Only the passages are given, no places; shards as small as can be."""
    passages = [b"a b c d", b"d e f g", b"x y z"]
    texts = [b"q a b c d e f g q", b"", b"a b c", b"x y z x y z", b"n\tx  y\nz a b c d"]
    for shard_words in (1, 5, 100):
        got = substring._locate(texts, passages, 3, shard_words)
        assert [None if m is None else "".join("01"[int(x)] for x in m) for m in got] == [
            "011111110", None, None, "111111", "01111111"]


def test_hits_are_compared_on_words(monkeypatch):
    """Word numbers that meet by their hash are no hit."""
    monkeypatch.setattr(substring.C.Words, "hashes", lambda self, seed=1: self.end - self.start)
    got = substring._locate([b"aa b cc", b"dd e ff"], [b"aa b cc"], 3)
    assert got[0].all() and got[1] is None
    got = substring._locate([b"aa b cc", b"dd e ff", b"gg h ii"], [b"aa b cc", b"dd e ff"], 3)
    assert got[0].all() and got[1].all() and got[2] is None


def test_text_and_kept_columns(odd):
    got = substring.remove_repeated(odd, keep=["doc_id", "lang", "kept"])
    assert got.columns == ["doc_id", "lang", "kept", "n_words", "n_removed", "kept_text"]
    assert got.count() == len(odd_rows())


def test_empty(none):
    assert substring.remove_repeated(none).count() == 0


def test_shard_finds_overlapping_passages():
    shard = substring.Shard()
    shard.add((1, 2, 3))
    shard.add((3, 4, 5))
    shard.add((2, 3))
    shard.compile()
    assert shard.covered((9, 1, 2, 3, 4, 5, 9, 2, 3)).tolist() == [False, True, True, True, True, True, False, True, True]


def test_bad_anchor(odd):
    with pytest.raises(ValueError):
        substring.remove_repeated(odd, 5, 6)


def test_clashing_and_dotted_names(odd):
    names = ["__text", "__row", "__runs", "__r", "__anchors", "a.b", "keep0", "key", "salt"]
    df = odd
    for c in names:
        df = df.withColumn(c, F.lit(1))
    out = substring.remove_repeated(df, size=35, keep=["doc_id", *names])
    plain = substring.remove_repeated(odd, size=35)
    cols = ("doc_id", "n_words", "n_removed", "kept_text")
    assert rows(out, *cols) == rows(plain, *cols) and set(names) <= set(out.columns)


def test_untouched_texts_stay_as_they_came(odd):
    plain = {(r.doc_id, r.n_removed, r.kept_text) for r in substring.remove_repeated(odd, 5, 3).collect()}
    got = substring.remove_repeated(odd, 5, 3, untouched=True).collect()
    given = {(r[0], r[1]) for r in odd_rows()}
    assert len(got) == len(odd_rows())
    for r in got:
        if r.n_removed:
            assert (r.doc_id, r.n_removed, r.kept_text) in plain
        else:
            assert (r.doc_id, r.kept_text) in given
    with pytest.raises(ValueError):
        substring.remove_repeated(odd, 5, 3, digest=True, untouched=True)
