"""Quality classifier by attention-based multiple-instance learning.

A text is a bag of passages (runs of ``PASSAGE`` words, the last one shorter).
Every passage is encoded: statistics of its characters, words and repeats plus
a hashed byte-bigram profile, put through a dense layer.  Gated attention
(tanh times sigmoid) weighs the passages of a text, and the weighted sum is
scored by a logistic unit.  Only document labels are given; which passages
matter is learned through the attention weights.

Training: full-batch Adam in NumPy on at most ``max_labels`` labelled texts
(those with the smallest hash of their id, so the sample is the same in every
run), all passages of each, as long as they have at most ``max_passages``
together; labelled texts of over ``max_text_passages`` (by default a twentieth
of that) are not learned from.  Of the texts that share a labelled id the one
with the smallest hash is learned from.
Scoring covers every passage of every text, in the tasks, without a shuffle.

A text without words (null, empty, blank) is one passage of zeros and gets the
score the model gives that.  Rows with a null label are not labelled.  If the
labels hold one class only, every text scores that class's share.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import common as C

PASSAGE = 64
PROFILE = 96
STATS = 15
FEATURES = STATS + PROFILE
HIDDEN = 24
ATTENTION = 12
MAX_LABELS = 4000
MAX_PASSAGES = 100_000
SLICE = 1 << 20             # text bytes made into passages at once
STEPS = 300
THRESHOLD = 0.7

_CLASS = np.zeros((8, 256), dtype=bool)
_CLASS[0, 65:91] = True                                   # A-Z
_CLASS[1, 97:123] = True                                  # a-z
_CLASS[2, 48:58] = True                                   # digits
_CLASS[3, list(b".,;:'\"()-?")] = True                    # punctuation
_CLASS[4, list(b"#*$%&|<>!@^~=+_/\\{}[]`")] = True        # symbols
_CLASS[5, 128:192] = True                                 # continuation bytes
_CLASS[6, 192:] = True                                    # lead bytes
_CLASS[7, 10] = True                                      # line ends


def passages(raw: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(features, text number) of every passage of a slice of texts; a text
    without words has one passage of zeros."""
    words = C.Words(raw)
    per_text = np.maximum(-(-words.count // PASSAGE), 1)
    row = np.repeat(np.arange(words.n), per_text)
    head = np.cumsum(per_text) - per_text
    x = np.zeros((len(row), FEATURES), dtype=np.float32)
    n = len(words.start)
    if not n:
        return x, row
    place = np.arange(n) - words.first[words.row]
    bag = head[words.row] + place // PASSAGE
    size = np.bincount(bag, minlength=len(row)).astype(np.float64)
    full = np.maximum(size, 1)
    length = words.end - words.start
    # bytes of a passage: from its first word to the next passage's (separators included)
    starts = np.flatnonzero(np.concatenate([[True], bag[1:] != bag[:-1]]))
    of_byte = np.full(len(words.data), -1, dtype=np.int64)
    step = np.zeros(len(words.data) + 1, dtype=np.int64)
    owner = bag[starts]
    begin = words.start[starts]
    finish = words.end[np.concatenate([starts[1:], [n]]) - 1]
    step[begin] += owner + 1
    step[finish] -= owner + 1
    of_byte = np.cumsum(step[:-1]) - 1
    inside = of_byte >= 0
    data, own = words.data[inside], of_byte[inside]
    total = np.maximum(np.bincount(own, minlength=len(row)), 1).astype(np.float64)
    for k, members in enumerate(_CLASS):
        x[:, k] = np.bincount(own, weights=members[data], minlength=len(row)) / total
    hashes = words.hashes(3)
    order = np.lexsort((hashes, bag))
    first = np.concatenate([[True], (hashes[order][1:] != hashes[order][:-1]) | (bag[order][1:] != bag[order][:-1])])
    at = np.flatnonzero(first)
    times = np.diff(np.concatenate([at, [n]]))
    kinds = np.bincount(bag[order][at], minlength=len(row))
    most = np.zeros(len(row))
    np.maximum.at(most, bag[order][at], times)
    again = np.zeros(n)
    again[1:] = (hashes[1:] == hashes[:-1]) & (words.row[1:] == words.row[:-1])
    last_byte = words.data[words.end - 1]
    x[:, 8] = kinds / full
    x[:, 9] = most / full
    x[:, 10] = np.bincount(bag, weights=again, minlength=len(row)) / full
    x[:, 11] = np.bincount(bag, weights=np.minimum(length, 40), minlength=len(row)) / full / 10
    x[:, 12] = np.bincount(bag, weights=_CLASS[4][last_byte], minlength=len(row)) / full
    x[:, 13] = np.bincount(bag, weights=length == 1, minlength=len(row)) / full
    x[:, 14] = np.log1p(size) / 5
    pair = (own[1:] == own[:-1])
    code = C.mix((data[:-1].astype(np.uint64) << np.uint64(8)) | data[1:])[pair] % np.uint64(PROFILE)
    profile = np.bincount(own[1:][pair] * PROFILE + code.astype(np.int64), minlength=len(row) * PROFILE)
    x[:, STATS:] = np.sqrt(profile.reshape(len(row), PROFILE) / total[:, None])
    return x, row


@dataclass
class Model:
    """Weights of the encoder, the gated attention and the score."""

    mean: np.ndarray
    scale: np.ndarray
    w: dict[str, np.ndarray]
    share: float = 0.5          # of label 1; the score where nothing could be learned

    def _forward(self, x, row, n):
        w = self.w
        z = (x - self.mean) / self.scale
        h = np.tanh(z @ w["enc"] + w["enc_b"])
        t, g = np.tanh(h @ w["v"]), 1 / (1 + np.exp(-(h @ w["u"])))
        a = (t * g) @ w["att"]
        top = np.full(n, -np.inf)
        np.maximum.at(top, row, a)
        e = np.exp(a - top[row])
        a = e / np.bincount(row, weights=e, minlength=n)[row]
        bag = np.zeros((n, h.shape[1]))
        np.add.at(bag, row, a[:, None] * h)
        return z, h, t, g, a, bag, bag @ w["out"] + w["out_b"]

    def attention(self, x, row, n) -> np.ndarray:
        """Weight of every passage within its text."""
        return self._forward(x, row, n)[4]

    def score(self, x: np.ndarray, row: np.ndarray, n: int) -> np.ndarray:
        if not self.w:
            return np.full(n, self.share)
        return 1 / (1 + np.exp(-np.clip(self._forward(x, row, n)[6], -50, 50)))


def train(x: np.ndarray, row: np.ndarray, y: np.ndarray, steps: int = STEPS, seed: int = 7,
          rate: float = 0.02, decay: float = 1e-4) -> Model:
    """Fit by Adam on all bags at once."""
    n = len(y)
    share = float(y.mean()) if n else 0.5
    if n == 0 or share in (0.0, 1.0):
        return Model(np.zeros(FEATURES), np.ones(FEATURES), {}, share)
    x = x.astype(np.float64)
    rng = np.random.default_rng(seed)
    w = {"enc": rng.normal(0, FEATURES ** -0.5, (FEATURES, HIDDEN)), "enc_b": np.zeros(HIDDEN),
         "v": rng.normal(0, HIDDEN ** -0.5, (HIDDEN, ATTENTION)), "u": rng.normal(0, HIDDEN ** -0.5, (HIDDEN, ATTENTION)),
         "att": rng.normal(0, ATTENTION ** -0.5, ATTENTION), "out": rng.normal(0, HIDDEN ** -0.5, HIDDEN),
         "out_b": np.zeros(1)}
    model = Model(x.mean(axis=0), x.std(axis=0) + 1e-2, w, share)
    m = {k: np.zeros_like(v) for k, v in w.items()}
    s = {k: np.zeros_like(v) for k, v in w.items()}
    for i in range(1, steps + 1):
        z, h, t, g, a, bag, logit = model._forward(x, row, n)
        p = 1 / (1 + np.exp(-logit))
        d = (p - y) / n
        d_bag = d[:, None] * w["out"]
        d_pass = d_bag[row]
        d_a = (d_pass * h).sum(axis=1)
        d_e = a * (d_a - np.bincount(row, weights=a * d_a, minlength=n)[row])
        d_t, d_g = d_e[:, None] * w["att"] * g, d_e[:, None] * w["att"] * t
        d_v, d_u = d_t * (1 - t * t), d_g * g * (1 - g)
        d_h = a[:, None] * d_pass + d_v @ w["v"].T + d_u @ w["u"].T
        d_enc = d_h * (1 - h * h)
        grad = {"enc": z.T @ d_enc, "enc_b": d_enc.sum(axis=0), "v": h.T @ d_v, "u": h.T @ d_u,
                "att": (t * g).T @ d_e, "out": bag.T @ d, "out_b": np.array([d.sum()])}
        for k in w:
            gk = grad[k] + decay * w[k]
            m[k] = 0.9 * m[k] + 0.1 * gk
            s[k] = 0.999 * s[k] + 0.001 * gk * gk
            w[k] -= rate * (m[k] / (1 - 0.9 ** i)) / (np.sqrt(s[k] / (1 - 0.999 ** i)) + 1e-8)
    return model


def fit(df: DataFrame, labels: DataFrame, label_col: str, max_labels: int = MAX_LABELS,
        id_col: str = "doc_id", text_col: str = "text", max_passages: int = MAX_PASSAGES,
        max_text_passages: int | None = None) -> Model:
    """Train on at most ``max_labels`` of the labelled texts, one an id, with at
    most ``max_passages`` passages together and ``max_text_passages`` (default:
    a twentieth of that) each.  Only these texts' passage features reach the
    driver."""
    longest = max_passages // 20 if max_text_passages is None else max_text_passages
    sample = (labels.filter(F.col(label_col).isNotNull() & F.col(id_col).isNotNull())
              .groupBy(F.col(id_col).alias("__i")).agg(F.max(label_col).cast("double").alias("__y"))
              .orderBy(F.xxhash64("__i"), "__i").limit(max_labels))
    sample = C.materialize(sample, "label-sample")         # at most ``max_labels`` rows
    rows = df.select(F.col(id_col), F.col(text_col).alias("__text")).join(
        F.broadcast(sample), F.col(id_col) == F.col("__i")).select(
        "__i", "__y", F.struct(F.xxhash64("__text").alias("h"), F.col("__text")).alias("__t"))
    # one text for each sampled id, so that no id brings more than its row
    rows = rows.groupBy("__i").agg(F.max("__y").alias("__y"), F.min("__t").alias("__t")).select(
        F.xxhash64("__i", "__t.__text").alias("__k"), "__y", "__t.__text")
    out = T.StructType([T.StructField("k", T.LongType()), T.StructField("y", T.DoubleType()),
                        T.StructField("n", T.LongType()), T.StructField("x", T.BinaryType())])

    def run(batches):
        for b in C.slices(batches, "__text", SLICE):
            x, row = passages(C.encode(b.column("__text")))
            cut = np.flatnonzero(np.diff(row)) + 1
            yield pa.RecordBatch.from_arrays(
                [b.column("__k"), b.column("__y"), pa.array(np.bincount(row, minlength=b.num_rows)),
                 pa.array([p.astype("<f4").tobytes() for p in np.split(x, cut)], pa.binary())], names=out.names)

    bags = C.materialize(rows.mapInArrow(run, out), "label-passages").filter(F.col("n") <= longest)
    sizes = sorted((r["k"], r["n"]) for r in bags.select("k", "n").collect())     # at most ``max_labels`` rows
    fits = int(np.searchsorted(np.cumsum([n for _, n in sizes]), max_passages, side="right"))
    if fits < len(sizes):
        bags = bags.filter(F.col("k") < sizes[fits][0])
    got = sorted((r["k"], r["y"], bytes(r["x"])) for r in bags.collect())
    if not got:
        return train(np.zeros((0, FEATURES)), np.zeros(0, dtype=np.int64), np.zeros(0))
    bags = [np.frombuffer(g[2], dtype="<f4").reshape(-1, FEATURES) for g in got]
    return train(np.concatenate(bags), np.repeat(np.arange(len(bags)), [len(b) for b in bags]),
                 np.array([g[1] for g in got]))


def score(df: DataFrame, model: Model, text_col: str = "text", keep: list[str] | None = None,
          score_col: str = "score") -> DataFrame:
    """The columns ``keep`` (default: all) plus the score of every text."""
    keep = [c for c in df.columns if c != score_col] if keep is None else keep
    out = T.StructType([*(T.StructField(f.name, f.dataType) for f in df.select(*[F.col(f"`{c}`") for c in keep]).schema),
                        T.StructField(score_col, T.DoubleType())])

    def run(batches):
        for b in C.slices(batches, text_col, SLICE):
            x, row = passages(C.encode(b.column(text_col)))
            yield pa.RecordBatch.from_arrays(
                [*(b.column(c) for c in keep), pa.array(model.score(x, row, b.num_rows))], names=out.names)

    return df.select(*[F.col(f"`{c}`") for c in dict.fromkeys([*keep, text_col])]).mapInArrow(run, out)


def held_out(id_col: str = "doc_id"):
    """Rows whose labels are never learned from."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def score_documents(df: DataFrame, labels: DataFrame, label_col: str = "quality", max_labels: int = MAX_LABELS,
                    threshold: float = THRESHOLD, id_col: str = "doc_id", text_col: str = "text",
                    max_passages: int = MAX_PASSAGES, max_text_passages: int | None = None) -> DataFrame:
    """id, ``held_out``, ``score``, ``predicted`` of every text."""
    model = fit(df, labels.filter(~held_out(id_col)), label_col, max_labels, id_col, text_col, max_passages,
                max_text_passages)
    return score(df, model, text_col, [id_col]).select(
        id_col, held_out(id_col).alias("held_out"), "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"))
