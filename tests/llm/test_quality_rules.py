from collections import Counter

import numpy as np

from fleetlens.llm import common as C, quality_rules as Q

from .conftest import odd_rows, words

NAMES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")


def brute_base(text):
    text = text or ""
    w = words(text)
    grams = Counter(tuple(w[i:i + 5]) for i in range(len(w) - 4))
    hit = {k for i in range(len(w) - 4) if grams[tuple(w[i:i + 5])] > 1 for k in range(i, i + 5)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if words(line):
            dup += line in seen
            seen.add(line)
    return (len(w), sum(map(len, w)), sum(text.count(c) for c in "#*$%&|<>"), dup, len(hit),
            len(w) < 10 or 100 * len(hit) > 20 * len(w))


def brute_scores(data, trusted, buckets, margin):
    """The method on plain lists: counts, ratios, mean of the trusted scores."""
    per = [Q.ngrams([(t or "").encode()], buckets)[1] for _, t in data]
    raw = sum((np.bincount(p, minlength=buckets) for p in per), np.zeros(buckets, dtype=np.int64))
    good = [p for (i, _), p in zip(data, per) if i in trusted]
    target = sum((np.bincount(p, minlength=buckets) for p in good), np.zeros(buckets, dtype=np.int64))
    ratio = Q.log_ratio(raw, target)
    score = [ratio[p].mean() if len(p) else 0.0 for p in per]
    own = [s for (i, _), s in zip(data, score) if i in trusted]
    return score, np.mean(own) - margin


def trusted_of(spark, ids):
    return spark.createDataFrame([(i,) for i in ids], "doc_id long")


def test_odd_rows(spark, odd):
    data = [(r[0], r[1]) for r in odd_rows()]
    got = sorted((tuple(r[c] for c in ("doc_id", *NAMES)) for r in Q.judge(odd, trusted_of(spark, [1, 6, 9])).collect()),
                 key=repr)
    assert got == sorted(((i, *brute_base(t)) for i, t in data), key=repr)


def test_table_against_plain_lists(spark, small, sf):
    data = [(r.doc_id, r.text) for r in small.collect()]
    labels = spark.read.parquet(f"{sf}/labels.parquet").filter("quality = 1").select("doc_id")
    trusted = {r.doc_id for r in labels.collect()}
    got = {r.doc_id: r for r in Q.judge(small, labels, buckets=4096).collect()}
    score, threshold = brute_scores(data, trusted, 4096, Q.MARGIN)
    for (i, t), s in zip(data, score):
        r, base = got[i], brute_base(t)
        assert tuple(r[c] for c in NAMES) == base
        assert abs(r.llr - s) < 1e-9
        if abs(s - threshold) > 1e-9:
            assert r.kept == (not base[-1] and s >= threshold)


def test_labelled_documents(spark, small, sf):
    """Trusted texts stay; most of those labelled bad go."""
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    got = Q.judge(small, labels.filter("quality = 1").select("doc_id")).filter("n_words >= 10").join(labels, "doc_id")
    n = {(r.quality, r.kept): r["count"] for r in got.groupBy("quality", "kept").count().collect()}
    assert n.get((1, False), 0) <= 0.02 * (n.get((1, False), 0) + n.get((1, True), 0))
    assert n.get((0, False), 0) >= n.get((0, True), 0)


def test_nothing_trusted(spark, odd):
    got = Q.judge(odd, trusted_of(spark, []))
    assert got.filter("kept = base_failed").count() == 0


def test_empty(spark, none):
    assert Q.judge(none, trusted_of(spark, [1])).count() == 0


def test_hash_meetings_are_recounted(monkeypatch):
    w = [b"a b c d e f g h a b c d e".split(), b"q w e r t y u i o p".split()]
    want = [Q.repeat_words(x) for x in w]
    monkeypatch.setattr(C, "window_hashes", lambda ids, size, seed: np.zeros(len(ids) - size + 1, dtype=np.uint64))
    assert [Q.repeat_words(x) for x in w] == want == [10, 0]
