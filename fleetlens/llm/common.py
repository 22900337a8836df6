"""Helpers shared by the operators of this subpackage.

Words are runs of bytes outside space and ``\\t \\n \\v \\f \\r``; on UTF-8 that is
the same as splitting code points, so whole Arrow buffers are cut without
building a Python object per word.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir

SLICE_BYTES = 4 << 20      # text bytes handled at once inside a task

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    The folder is ``spark.checkpoint.dir``, so the rows survive the loss of
    any executor and later stages do not recompute what stands before.
    """
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def ascii_lower(col):
    """Lower-case A-Z only."""
    return F.translate(col, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def free_name(df: DataFrame, base: str) -> str:
    """A column name that does not clash with the columns of ``df``."""
    taken = {c.lower() for c in df.columns}
    name = f"__{base}"
    while name.lower() in taken:
        name += "_"
    return name


def slices(batches: Iterator[pa.RecordBatch], text: str,
           limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut record batches so that each part holds about ``limit`` text bytes
    (a single longer text stays whole)."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = np.asarray(pc.fill_null(
            pc.binary_length(batch.column(text)), 0)).astype(np.int64)
        ends = np.cumsum(sizes)
        at = 0
        while at < len(ends):
            base = ends[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(ends, base + limit, side="right")))
            yield batch.slice(at, to - at)
            at = to


def texts(column: pa.Array) -> list[str]:
    """Texts of a column; a null text is empty."""
    return ["" if x is None else x for x in column.to_pylist()]


class Words:
    """The words of many texts as offsets into one byte buffer.

    ``start``/``end`` are byte positions, ``row`` the text of each word, and
    ``first[i]:first[i + 1]`` the words of text ``i``.
    """

    def __init__(self, raw: list[bytes]):
        self.n = len(raw)
        data = np.frombuffer(b"\n".join(raw) + b"\n", dtype=np.uint8)
        self.data = data
        space = _SPACE[data]
        inside = np.zeros(len(data) + 1, dtype=np.int8)
        inside[1:] = ~space
        step = np.diff(inside)
        self.start = np.flatnonzero(step == 1)
        if self.n and len(data):
            self.end = np.flatnonzero(step == -1)
        else:
            self.end = self.start
        sizes = np.fromiter((len(x) + 1 for x in raw), dtype=np.int64, count=self.n)
        self.text_end = np.cumsum(sizes)
        self.text_start = self.text_end - sizes
        self.first = np.concatenate([np.searchsorted(self.start, self.text_start),
                                     [len(self.start)]]).astype(np.int64)
        self.count = np.diff(self.first)
        self.row = np.repeat(np.arange(self.n), self.count)

    def hashes(self, seed: int = 1) -> np.ndarray:
        """A 64-bit hash per word: position-weighted sum of random byte codes,
        then mixed; equal words have equal hashes in every process."""
        if not len(self.start):
            return np.zeros(0, dtype=np.uint64)
        rng = np.random.Generator(np.random.PCG64(seed))
        codes = rng.integers(1, 1 << 63, size=256, dtype=np.uint64) | np.uint64(1)
        length = self.end - self.start
        out = np.zeros(len(self.start), dtype=np.uint64)
        with np.errstate(over="ignore"):
            # bytes of short words are added position by position; long words one by one
            short = np.flatnonzero(length <= 64)
            alive, at = short, 0
            while len(alive):
                out[alive] = mix(out[alive] + codes[self.data[self.start[alive] + at]])
                at += 1
                alive = alive[length[alive] > at]
            for i in np.flatnonzero(length > 64):
                word = codes[self.data[self.start[i]:self.end[i]]]
                powers = np.cumprod(np.full(len(word), 0x9E3779B97F4A7C15, dtype=np.uint64))
                out[i] = (mix(word + powers) * np.uint64(3)).sum(dtype=np.uint64) ^ np.uint64(len(word))
            return mix(out + length.astype(np.uint64))


def mix(x: np.ndarray) -> np.ndarray:
    """splitmix64 finaliser."""
    with np.errstate(over="ignore"):
        x = x ^ (x >> np.uint64(30))
        x = x * np.uint64(0xBF58476D1CE4E5B9)
        x = x ^ (x >> np.uint64(27))
        x = x * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def window_hashes(words: np.ndarray, size: int, seed: int) -> np.ndarray:
    """Hash of every run of ``size`` words (across text borders as well; the
    caller drops those).  Built by doubling, so the order of words counts."""
    n = len(words) - size + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    with np.errstate(over="ignore"):
        out, done, block, width = None, 0, mix(words + np.uint64(seed)), 1
        while True:
            if size & width:
                part = block[done:]
                out = part if out is None else mix(
                    out[:len(part)] * np.uint64(0x9E3779B97F4A7C15) + part[:len(out)] + np.uint64(width))
                done += width
            width *= 2
            if width > size:
                return out[:n]
            half = width // 2
            block = mix(block[:-half] * np.uint64(0xD6E8FEB86659FD93) + block[half:] + np.uint64(width))


def encode(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of a text column; null is empty."""
    return [b"" if x is None else x for x in column.cast(pa.large_binary()).to_pylist()]


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers
    return os.fspath(public_tokenizers.path(name))
