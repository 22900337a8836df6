import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from fleetlens.llm import classifier as K

from .conftest import odd_rows


def auc(y, s):
    order = np.argsort(s, kind="stable")
    rank = np.empty(len(s))
    rank[order] = np.arange(1, len(s) + 1)
    pos = y == 1
    return (rank[pos].sum() - pos.sum() * (pos.sum() + 1) / 2) / (pos.sum() * (~pos).sum())


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    got = K.score_documents(docs, labels).join(labels, "doc_id").toPandas()
    assert (got.held_out == [zlib.crc32(str(i).encode()) % 4 == 2 for i in got.doc_id]).all()
    held = got[got.held_out]
    assert len(held) > 300
    assert auc(held.quality.to_numpy(), held.score.to_numpy()) > 0.97
    assert (held.predicted == held.quality).mean() > 0.95
    assert held[held.quality == 1].predicted.mean() > 0.98


def test_held_out_labels_do_not_matter(spark, small, sf):
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    other = labels.withColumn("quality", F.when(K.held_out(), 1 - F.col("quality")).otherwise(F.col("quality")))
    a, b = (sorted(map(tuple, K.score_documents(small, x).collect())) for x in (labels, other))
    assert a == b


def test_odd_rows(spark, odd):
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(1, 18)] + [(None, 1, 0), (3, None, 0), (99, 1, 1)],
                                   "doc_id long, quality int, toxic int")
    got = K.score_documents(odd, labels).collect()
    assert sorted((r.doc_id for r in got), key=repr) == sorted((r[0] for r in odd_rows()), key=repr)
    for r in got:
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= K.THRESHOLD)
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 4 == 2)


@pytest.mark.parametrize("labels,share", [([], 0.5), ([(1, 1), (6, 1)], 1.0)])
def test_nothing_to_learn(spark, odd, labels, share):
    frame = spark.createDataFrame([(i, q) for i, q in labels], "doc_id long, quality int")
    assert {r.score for r in K.score_documents(odd, frame).collect()} == {share}


def test_empty(spark, none):
    labels = spark.createDataFrame([(1, 1)], "doc_id long, quality int")
    assert K.score_documents(none, labels).count() == 0


def test_gradient():
    """The written-out gradient lowers the loss as a numeric one would."""
    rng = np.random.default_rng(0)
    row = np.repeat(np.arange(40), rng.integers(1, 5, 40))
    x = rng.normal(size=(len(row), K.FEATURES))
    y = np.array([x[row == i, 3].max() > 0.8 for i in range(40)], dtype=float)
    m = K.train(x, row, y, steps=300)
    s = m.score(x, row, 40)
    assert ((s > 0.5) == (y == 1)).mean() > 0.97
    weights = m.attention((x), row, 40)
    assert np.allclose(np.bincount(row, weights=weights), 1)


def test_passages_cover_the_whole_text():
    text = " ".join(f"w{i}" for i in range(1000)).encode()
    x, row = K.passages([b"", text, b" \n "])
    assert np.bincount(row).tolist() == [1, -(-1000 // K.PASSAGE), 1]
    assert not x[0].any() and x[1:-1].any(axis=1).all()


def test_training_is_bounded(spark):
    """Over-long texts are scored but not learned from, and the rest only as
    far as the passages allow."""
    words = " ".join(["plain"] * (K.PASSAGE * 3))
    docs = spark.createDataFrame([(i, words + (" ##" * 40 if i % 2 else f" {i}")) for i in range(40)]
                                 + [(99, "## " * (K.PASSAGE * 51))], "doc_id long, text string")
    labels = docs.select("doc_id", ((F.col("doc_id") + 1) % 2).cast("int").alias("quality"))
    seen = []
    plain, K.train = K.train, lambda x, row, y: seen.append((len(x), len(y))) or plain(x, row, y)
    try:
        for bound in (1000, 100):
            assert K.score(docs, K.fit(docs, labels, "quality", max_passages=bound)).count() == 41
    finally:
        K.train = plain
    assert seen[0] == (160, 40)
    assert seen[1] == (100, 25)


def test_one_text_for_each_labelled_id(spark, monkeypatch):
    """An id that stands on most rows brings one text to the training, and
    the longest text that is learned from is a parameter."""
    docs = spark.createDataFrame([(7, f"hot text {i}") for i in range(300)]
                                 + [(i, "word " * (K.PASSAGE * i)) for i in range(1, 7)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(1, 8)], "doc_id long, quality int")
    seen = []
    monkeypatch.setattr(K, "train", lambda x, row, y, plain=K.train: seen.append((len(x), len(y))) or plain(x, row, y))
    for longest in (None, 3):
        K.fit(docs.repartition(4), labels, "quality", max_labels=7, max_text_passages=longest)
    assert seen == [(22, 7), (7, 4)]


# ------------------------------------------------- a second version, by hand
RUN = re.compile(rb"[^\x20\x09-\x0D]+")
MASK = (1 << 64) - 1
KINDS = [lambda b: 65 <= b <= 90, lambda b: 97 <= b <= 122, lambda b: 48 <= b <= 57, lambda b: b in b".,;:'\"()-?",
         lambda b: b in b"#*$%&|<>!@^~=+_/\\{}[]`", lambda b: 128 <= b < 192, lambda b: b >= 192, lambda b: b == 10]


def pair_class(first, second):
    x = first << 8 | second
    x = (x ^ x >> 30) * 0xBF58476D1CE4E5B9 & MASK
    x = (x ^ x >> 27) * 0x94D049BB133111EB & MASK
    return (x ^ x >> 31) % K.PROFILE


def plain_passages(raw):
    """Feature rows of one text, byte by byte and word by word."""
    found = [(m.start(), m.end(), m.group()) for m in RUN.finditer(raw)]
    if not found:
        return [[0.0] * K.FEATURES]
    out = []
    for at in range(0, len(found), K.PASSAGE):
        part = found[at:at + K.PASSAGE]
        inside = raw[part[0][0]:part[-1][1]]
        words = [w for _, _, w in part]
        n, times = len(words), Counter(words)
        again = sum(i > 0 and found[i][2] == found[i - 1][2] for i in range(at, at + n))
        stats = [sum(map(kind, inside)) / len(inside) for kind in KINDS]
        stats += [len(times) / n, max(times.values()) / n, again / n, sum(min(len(w), 40) for w in words) / n / 10,
                  sum(KINDS[4](w[-1]) for w in words) / n, sum(len(w) == 1 for w in words) / n, math.log1p(n) / 5]
        pairs = Counter(pair_class(a, b) for a, b in zip(inside, inside[1:]))
        out.append(stats + [math.sqrt(pairs[c] / len(inside)) for c in range(K.PROFILE)])
    return out


def plain_logit(w, z):
    """Gated attention over the passages ``z`` (scaled) of one text."""
    h = np.tanh(z @ w["enc"] + w["enc_b"])
    gate = np.tanh(h @ w["v"]) / (1 + np.exp(-(h @ w["u"])))
    e = np.exp(gate @ w["att"])
    return float((e / e.sum()) @ h @ w["out"] + w["out_b"][0])


def test_features_brute_force(small):
    raw = [(t or "").encode() for _, t in [(r[0], r[1]) for r in odd_rows()]]
    raw += [(r.text or "").encode() for r in small.select("text").collect()]
    x, row = K.passages(raw)
    want = [(i, p) for i, t in enumerate(raw) for p in plain_passages(t)]
    assert row.tolist() == [i for i, _ in want]
    assert np.allclose(x, np.array([p for _, p in want]), rtol=1e-5, atol=1e-6)


def test_score_brute_force(spark, odd, small, sf):
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    model = K.fit(small, labels, "quality")
    assert model.w
    docs = small.select("doc_id", "text").unionByName(odd.select("doc_id", "text"))
    for r in K.score(docs, model).collect():
        z = (np.array(plain_passages((r.text or "").encode())) - model.mean) / model.scale
        assert abs(r.score - 1 / (1 + math.exp(-plain_logit(model.w, z)))) < 1e-4


def test_training_brute_force():
    """Two steps of Adam on numeric gradients of the loss, text by text, give
    the weights that the written-out gradient gives."""
    rng = np.random.default_rng(3)
    row = np.repeat(np.arange(5), [1, 2, 3, 1, 2])
    x, y = rng.normal(size=(len(row), K.FEATURES)), np.array([1.0, 0, 1, 0, 1])
    start = K.train(x, row, y, steps=0)
    z = (x - x.mean(axis=0)) / (x.std(axis=0) + 1e-2)
    bags = [z[row == i] for i in range(5)]

    def loss(w):
        logits = [plain_logit(w, b) for b in bags]
        fit = sum(math.log1p(math.exp(-v if t else v)) for v, t in zip(logits, y)) / len(y)
        return fit + 1e-4 / 2 * sum((v * v).sum() for v in w.values())

    w = {k: v.copy() for k, v in start.w.items()}
    mean, square = ({k: np.zeros_like(v) for k, v in w.items()} for _ in range(2))
    smallest = {k: np.full(v.shape, np.inf) for k, v in w.items()}
    for step in (1, 2):
        grad = {k: np.zeros_like(v) for k, v in w.items()}
        for k, v in w.items():
            for at in np.ndindex(v.shape):
                here = v[at]
                v[at] = here + 1e-5
                up = loss(w)
                v[at] = here - 1e-5
                grad[k][at] = (up - loss(w)) / 2e-5
                v[at] = here
        for k, v in w.items():
            smallest[k] = np.minimum(smallest[k], np.abs(grad[k]))
            mean[k] = 0.9 * mean[k] + 0.1 * grad[k]
            square[k] = 0.999 * square[k] + 0.001 * grad[k] ** 2
            v -= 0.02 * (mean[k] / (1 - 0.9 ** step)) / (np.sqrt(square[k] / (1 - 0.999 ** step)) + 1e-8)
    got = K.train(x, row, y, steps=2).w
    for k in w:
        clear = smallest[k] > 1e-6              # below that the numeric gradient is noise
        assert clear.mean() > 0.9 and np.abs(got[k] - w[k])[clear].max() < 1e-4, k
