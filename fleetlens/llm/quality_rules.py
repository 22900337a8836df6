"""Quality rules: base counts plus a hashed n-gram log-likelihood ratio.

Two multinomials over hashed n-grams (word unigrams, word bigrams and byte
trigrams) are counted over all texts: one of the raw corpus, one of the trusted
target.  A text's score is the sum of log p_target / p_raw over its n-grams
divided by their number.  The threshold is fixed before any text is judged:
the mean score of the trusted texts, less ``margin`` (in nats per n-gram).  No
draw is involved: the same corpus gives the same verdicts.

Each multinomial has ``buckets`` counts (a parameter), whatever the corpus;
tasks add up their own before anything shuffles, so what reaches the driver
and goes back to the tasks is bounded by that number.  The mean needs no
second pass: it is linear in the ratios, so the tasks also add up each
bucket's share of every trusted text.

Words are runs outside space and ``\\t \\n \\v \\f \\r``.  A null text has none.  A
text that fails the base rules is dropped; one without n-grams scores zero.
Without any trusted text the base rules alone decide.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import common as C

BUCKETS = 1 << 17
MARGIN = 0.25
#: fixed value: the characters that count as symbols
SYMBOLS = b"#*$%&|<>"


def base_counts(text: bytes) -> tuple[int, int, int, int, int]:
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words)."""
    words = text.split()
    chars = len(b"".join(words).decode("utf-8", "replace"))
    symbols = sum(text.count(bytes([s])) for s in SYMBOLS)
    seen, dup = set(), 0
    for line in text.split(b"\n"):
        if line in seen:
            dup += 1
        elif line.split(None, 1):
            seen.add(line)
    return len(words), chars, symbols, dup, repeat_words(words)


def repeat_words(words: list[bytes], size: int = 5) -> int:
    """Words in windows of ``size`` words that stand twice or more in the text.
    Windows meet by hash; a text with a meeting is recounted on the words."""
    n = len(words) - size + 1
    if n < 2:
        return 0
    number: dict[bytes, int] = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), dtype=np.uint64, count=len(words))
    codes = C.window_hashes(ids, size, 5)
    order = np.argsort(codes, kind="stable")
    ranked = codes[order]
    same = ranked[1:] == ranked[:-1]
    if not same.any():
        return 0
    hit = np.zeros(n, dtype=bool)
    hit[order[1:][same]] = True
    hit[order[:-1][same]] = True
    places = np.flatnonzero(hit)
    grams = np.lib.stride_tricks.sliding_window_view(ids, size)[places]
    _, inverse, counts = np.unique(grams, axis=0, return_inverse=True, return_counts=True)
    places = places[counts[inverse.reshape(-1)] > 1]
    mark = np.zeros(len(words) + 1, dtype=np.int64)
    np.add.at(mark, places, 1)
    np.add.at(mark, places + size, -1)
    return int((np.cumsum(mark[:-1]) > 0).sum())


def ngrams(raw: list[bytes], buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """(text number, bucket) of every n-gram of a slice of texts."""
    words = C.Words(raw)
    if not len(words.start):
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    hashes = words.hashes(3)
    with np.errstate(over="ignore"):
        pairs = C.mix(hashes[:-1] * np.uint64(0x9E3779B97F4A7C15) + hashes[1:])
    joined = words.row[1:] == words.row[:-1]
    data = words.data
    tri = (data[:-2].astype(np.uint64) << np.uint64(16)) | (data[1:-1].astype(np.uint64) << np.uint64(8)) | data[2:]
    row_of_byte = np.repeat(np.arange(words.n), words.text_end - words.text_start)
    within = row_of_byte[:-2] == row_of_byte[2:]
    size = np.uint64(buckets)
    rows = np.concatenate([words.row, words.row[1:][joined], row_of_byte[:-2][within]])
    codes = np.concatenate([hashes % size, pairs[joined] % size, C.mix(tri[within] + np.uint64(977)) % size])
    return rows, codes.astype(np.int64)


def count_ngrams(df: DataFrame, trusted_col: str, buckets: int,
                 text_col: str = "text") -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """Per bucket: count over all texts, count over the trusted ones, and sum
    over these of the bucket's share of the text; and how many trusted texts."""
    out = T.StructType([T.StructField("bucket", T.IntegerType()), T.StructField("raw", T.LongType()),
                        T.StructField("target", T.LongType()), T.StructField("share", T.DoubleType())])

    def run(batches):
        raw, target = np.zeros(buckets, dtype=np.int64), np.zeros(buckets, dtype=np.int64)
        share, trusted_texts = np.zeros(buckets), 0
        for b in C.slices(batches, text_col):
            rows, codes = ngrams(C.encode(b.column(text_col)), buckets)
            raw += np.bincount(codes, minlength=buckets)
            trusted = b.column(trusted_col).to_numpy(zero_copy_only=False).astype(bool)
            trusted_texts += int(trusted.sum())
            n = np.bincount(rows, minlength=b.num_rows)
            rows, codes = rows[trusted[rows]], codes[trusted[rows]]
            target += np.bincount(codes, minlength=buckets)
            share += np.bincount(codes, weights=1.0 / n[rows], minlength=buckets)
        used = np.flatnonzero(raw)
        for at in range(0, len(used), 1 << 15):
            u = used[at:at + (1 << 15)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(u.astype(np.int32)), pa.array(raw[u]), pa.array(target[u]), pa.array(share[u])],
                names=out.names)
        yield pa.RecordBatch.from_arrays([pa.array([-1], pa.int32()), pa.array([0]), pa.array([trusted_texts]),
                                          pa.array([0.0])], names=out.names)

    counted = (df.select(text_col, trusted_col).mapInArrow(run, out).groupBy("bucket")
               .agg(F.sum("raw").alias("raw"), F.sum("target").alias("target"),
                    # decimals add up alike in any order, so the threshold does not depend on task order
                    F.sum(F.col("share").cast("decimal(28,12)")).cast("double").alias("share")))
    raw, target, share = np.zeros(buckets, dtype=np.int64), np.zeros(buckets, dtype=np.int64), np.zeros(buckets)
    texts = 0
    for r in counted.collect():       # at most ``buckets`` + 1 rows
        if r["bucket"] < 0:
            texts = r["target"]
        else:
            raw[r["bucket"]], target[r["bucket"]], share[r["bucket"]] = r["raw"], r["target"], r["share"]
    return raw, target, share, texts


def log_ratio(raw: np.ndarray, target: np.ndarray) -> np.ndarray:
    """log p_target / p_raw per bucket, both smoothed by one count."""
    p = (target + 1.0) / (target.sum() + len(target))
    q = (raw + 1.0) / (raw.sum() + len(raw))
    return np.log(p / q)


def judge(df: DataFrame, trusted: DataFrame, buckets: int = BUCKETS, margin: float = MARGIN,
          id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, ``n_words``, ``word_chars``, ``n_symbols``, ``n_dup_lines``,
    ``n_repeat_words``, ``base_failed``, ``kept`` and ``llr`` of every text.
    ``trusted``: ids (``id_col``) of the target texts."""
    ids = trusted.select(F.col(id_col).alias("__t")).distinct()
    # the labels grow with the corpus, so they are never broadcast: one plan at every size
    marked = (df.select(id_col, text_col).join(ids.hint("merge"), F.col(id_col) == F.col("__t"), "left")
              .select(F.col(text_col).alias("__text"), F.col("__t").isNotNull().alias("__trusted")))
    raw, target, share, texts = count_ngrams(marked, "__trusted", buckets, "__text")
    ratio = log_ratio(raw, target) if texts else np.zeros(buckets)
    threshold = float(ratio @ share) / texts - margin if texts else float("-inf")

    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    out = T.StructType([T.StructField(id_col, df.schema[id_col].dataType),
                        *(T.StructField(c, T.LongType()) for c in names), T.StructField("llr", T.DoubleType())])

    def run(batches):
        for b in C.slices(batches, text_col):
            texts_ = C.encode(b.column(text_col))
            rows, codes = ngrams(texts_, buckets)
            n = np.bincount(rows, minlength=b.num_rows)
            total = np.bincount(rows, weights=ratio[codes], minlength=b.num_rows)
            counts = np.array([base_counts(x) for x in texts_], dtype=np.int64).reshape(-1, len(names))
            yield pa.RecordBatch.from_arrays(
                [b.column(id_col), *(pa.array(c) for c in counts.T), pa.array(total / np.maximum(n, 1))],
                names=out.names)

    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    return (df.select(id_col, text_col).mapInArrow(run, out)
            .select(id_col, *names, failed.alias("base_failed"),
                    (~failed & (F.col("llr") >= threshold)).alias("kept"), "llr"))
