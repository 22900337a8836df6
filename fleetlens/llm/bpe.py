"""BPE encoding and decoding by forced-boundary splitting.

A byte pair that occurs inside no vocabulary token is a certain cut: no merge
can ever reach across it.  The encoder finds such cuts, encodes the resulting
fragments independently with the tokenizers library, keeps the ids of frequent
fragments, and concatenates.

Byte-level pre-tokenizing cuts first, and merges never leave a pre-token, so a
forced cut must not disturb it.  Two kinds of cut are made:

* before a space that is followed by a non-space, where a pre-token always
  starts (nearly all bytes before a space are forced pairs with it as well);
* inside such a chunk, between two characters whose adjoining bytes are a
  forced pair, unless the left one is white space or either is an apostrophe
  (there the pre-tokenizer looks further).

Null texts are empty: no ids, empty decoded text.  A text of any length is
encoded whole; the only state kept between texts is a bounded cache.
"""

from __future__ import annotations

import hashlib
import json
import re
from array import array
from functools import cached_property, lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from . import common as C

_CUT = re.compile(r" (?=\S)")
CACHE_ENTRIES = 500_000
CACHE_CHARS = 64
PART_CHARS = 64_000        # a longer text is encoded in parts ...
PART_LIMIT = 4 * PART_CHARS    # ... and by fragments where it cannot be cut within so many characters
#: fixed value: the pre-tokenizing pattern of byte-level BPE
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: white space other than a single space in front, or a byte that may be part of some
_INNER_SPACE = re.compile(rb"[\t-\r\x1c-\x1f]|.[ ]|^ ?$|\xc2[\x85\xa0]|\xe1\x9a|\xe2[\x80\x81]|\xe3\x80", re.S)

#: no cut after a byte that ends a white-space character (or after an apostrophe) ...
_NO_CUT_AFTER = np.zeros(256, dtype=bool)
_NO_CUT_AFTER[[*{x for c in range(0x3001) if chr(c).isspace() for x in chr(c).encode()[-1:]}, ord("'")]] = True
#: ... nor before an apostrophe or inside a character
_NO_CUT_BEFORE = np.zeros(256, dtype=bool)
_NO_CUT_BEFORE[[ord("'"), *range(0x80, 0xC0)]] = True


def byte_alphabet() -> dict[str, int]:
    """Character → byte of the byte-level alphabet: printable bytes stand for
    themselves, the others for code points from 256 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class ForcedBoundaryCodec:
    """Encode and decode with one byte-level BPE file of the tokenizers library."""

    def __init__(self, path: str):
        import os
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        alphabet = byte_alphabet()
        special = self.tokenizer.get_added_tokens_decoder()
        vocab = self.tokenizer.get_vocab(with_added_tokens=True)
        self.piece: list[bytes] = [b""] * (max(vocab.values()) + 1)
        inside = np.zeros((256, 256), dtype=bool)
        for token, i in vocab.items():
            if i in special:
                self.piece[i] = special[i].content.encode()
                continue
            raw = bytes(alphabet[c] for c in token)
            self.piece[i] = raw
            if len(raw) > 1:
                codes = np.frombuffer(raw, dtype=np.uint8)
                inside[codes[:-1], codes[1:]] = True
        #: forced[a, b]: no token holds byte a followed by byte b
        self.forced = ~inside
        self.specials = {t.content: np.array([i], dtype="<u4").tobytes() for i, t in special.items()}
        self.special_cut = re.compile("|".join(f"({re.escape(s)})" for s in self.specials)) if special else None
        self.ranked, self.line_end = self._by_rank(path, special), vocab.get("\u010a")
        self.cache: dict[str, bytes] = {}

    def _by_rank(self, path: str, special):
        """The same merges for the other library, or None if their order is
        not that of the token numbers."""
        import tiktoken
        with open(path, encoding="utf-8") as f:
            whole = json.load(f)
        model, vocab = whole["model"], whole["model"]["vocab"]
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        numbers = [vocab[a + b] for a, b in pairs]
        if numbers != sorted(set(numbers)) or len(numbers) + 256 != len(vocab) or "\u010a" not in vocab:
            return None
        ranks = {self.piece[i]: i for i in range(len(self.piece)) if self.piece[i] and i not in special}
        return tiktoken.Encoding("by_rank", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})

    def fragments(self, chunks: list[str]) -> tuple[list[bytes], np.ndarray]:
        """All chunks cut at the forced boundaries inside them, and how many
        fragments each gives; one pass over the joined bytes."""
        raw = [c.encode() for c in chunks]
        ends = np.cumsum(np.fromiter(map(len, raw), dtype=np.int64, count=len(raw)))
        joined = b"".join(raw)
        data = np.frombuffer(joined, dtype=np.uint8)
        cut = np.zeros(len(data) + 1, dtype=bool)
        left, right = data[:-1], data[1:]
        cut[1:-1] = self.forced[left, right] & ~_NO_CUT_AFTER[left] & ~_NO_CUT_BEFORE[right]
        cut[ends] = True
        at = np.flatnonzero(cut)
        per_chunk = np.diff(np.searchsorted(at, np.concatenate([[0], ends]), side="right"))
        stops = at.tolist()
        return [joined[i:j] for i, j in zip([0, *stops], stops)], per_chunk

    def _learn(self, chunks: list[str]) -> dict[str, bytes]:
        """Ids of unseen chunks; every distinct fragment is encoded once."""
        parts, per_chunk = self.fragments(chunks)
        ids = self._encode_fragments(list(dict.fromkeys(parts)))
        coded = [ids[f] for f in parts]
        ends = np.cumsum(per_chunk).tolist()
        return {c: coded[i] if j - i == 1 else b"".join(coded[i:j])
                for c, i, j in zip(chunks, [0, *ends], ends)}

    def _encode_fragments(self, fragments: list[bytes]) -> dict[bytes, bytes]:
        """Ids of each fragment on its own.  Where the merges are those of the
        token numbers, plain fragments go through the faster of the two
        libraries in one call, a line each: a line end next to no other white
        space is a token by itself.  All others go through tokenizers."""
        bulk = [f for f in fragments if not _INNER_SPACE.search(f)] if self.ranked else []
        out: dict[bytes, bytes] = {}
        if bulk:
            codes = np.array(self.ranked.encode_ordinary("\n".join([f.decode() for f in bulk])), dtype="<u4")
            ends = np.flatnonzero(codes == self.line_end)
            raw, stops = codes.tobytes(), [*(4 * ends).tolist(), 4 * len(codes)]
            if len(stops) != len(bulk):
                raise RuntimeError("fragments and lines do not match")
            out = {f: raw[i:j] for f, i, j in zip(bulk, [0, *[x + 4 for x in stops]], stops)}
        rest = [f for f in fragments if f not in out]
        if rest:
            got = self.tokenizer.encode_batch_fast([f.decode() for f in rest], add_special_tokens=False)
            out.update((f, array("I", e.ids).tobytes()) for f, e in zip(rest, got))
        return out

    def _chunks(self, text: str) -> list[str]:
        parts = _CUT.split(text)
        head = parts[0]
        chunks = [" " + p for p in parts]
        chunks[0] = head
        return chunks if head else chunks[1:]

    def encode_batch(self, batch: list[str]) -> list[bytes]:
        """Ids of every text as little-endian unsigned 32-bit integers."""
        if len(self.cache) > CACHE_ENTRIES:
            self.cache.clear()
        cut: list[list] = []          # per text: chunks, or the bytes of a special token
        for text in batch:
            if self.special_cut is not None and self.special_cut.search(text):
                row: list = []
                for part in filter(None, self.special_cut.split(text)):
                    row += [self.specials[part]] if part in self.specials else self._chunks(part)
            else:
                row = self._chunks(text)
            cut.append(row)
        unseen = set().union(*cut)
        known = self.cache
        new = [x for x in unseen if x not in known and isinstance(x, str)]
        learned = self._learn(new) if new else {}
        if learned:
            known.update((c, v) for c, v in learned.items() if len(c) <= CACHE_CHARS)
        long = {c: v for c, v in learned.items() if len(c) > CACHE_CHARS}
        out = []
        for row in cut:
            try:
                out.append(b"".join(map(known.__getitem__, row)))
            except KeyError:            # a special token, or a chunk too long to be kept
                out.append(b"".join([x if isinstance(x, bytes) else known[x] if x in known else long[x] for x in row]))
        return out

    @cached_property
    def ranks_suffice(self) -> bool:
        """Whether the library of plain fragments gives the same ids on whole
        texts: byte-level pre-tokenizing and nothing else, special tokens taken
        as they stand, and every token reached by the merges of its own bytes."""
        from tokenizers.pre_tokenizers import ByteLevel
        t = self.tokenizer
        cut, model = t.pre_tokenizer, t.model
        if (not self.ranked or t.normalizer is not None or not isinstance(cut, ByteLevel) or not cut.use_regex
                or cut.add_prefix_space or model.dropout or model.continuing_subword_prefix or model.end_of_word_suffix):
            return False
        if any(a.lstrip or a.rstrip or a.single_word for a in t.get_added_tokens_decoder().values()):
            return False
        return all([x.id for x in model.tokenize(token)] == [i]
                   for token, i in t.get_vocab(with_added_tokens=False).items())

    def _parts(self, text: str) -> list[str]:
        """A text cut into parts of about ``PART_CHARS``, each from the second
        on starting with a space that a non-space follows."""
        parts, at = [], 0
        while len(text) - at > PART_CHARS and (found := _CUT.search(text, at + PART_CHARS)):
            parts.append(text[at:found.start()])
            at = found.start()
        return [*parts, text[at:]]

    def _plain(self, text: str) -> bytes:
        """Ids of a text without special tokens."""
        if len(text) <= PART_CHARS:
            return array("I", self.ranked.encode_ordinary(text)).tobytes()
        return b"".join([array("I", self.ranked.encode_ordinary(p)).tobytes() if len(p) <= PART_LIMIT
                         else self.encode_batch([p])[0] for p in self._parts(text)])

    def encode_whole(self, batch: list[str]) -> list[bytes]:
        """The ids of ``encode_batch`` without cutting texts into words: one
        library call per text or part, no cache.  Where the library of plain
        fragments might differ on whole texts, ``encode_batch`` does it."""
        if not self.ranks_suffice:
            return self.encode_batch(batch)
        out = []
        for text in batch:
            if any(s in text for s in self.specials):
                out.append(b"".join([self.specials[p] if p in self.specials else self._plain(p)
                                     for p in self.special_cut.split(text) if p]))
            else:
                out.append(self._plain(text))
        return out

    def decode(self, ids: bytes) -> str:
        """Text of ids, special tokens included."""
        piece = self.piece
        raw = b"".join([piece[i] for i in np.frombuffer(ids, dtype="<u4").tolist()])
        return raw.decode("utf-8", "replace")


@lru_cache(maxsize=2)
def codec(path: str) -> ForcedBoundaryCodec:
    """One codec per worker process and file."""
    return ForcedBoundaryCodec(path)


def encode_documents(df: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text",
                     ids_col: str | None = None) -> DataFrame:
    """Encode and decode every text: id, ``n_tokens``, ``ids_sha256``,
    ``decoded_sha256`` and, if ``ids_col`` names one, the ids themselves
    (array of int).  No shuffle; rows keep their partitions."""
    out = T.StructType([df.schema[id_col], T.StructField("n_tokens", T.LongType()),
                        T.StructField("ids_sha256", T.StringType()), T.StructField("decoded_sha256", T.StringType()),
                        *([T.StructField(ids_col, T.ArrayType(T.IntegerType()))] if ids_col else [])])

    def run(batches):
        code = codec(tokenizer)
        for b in C.slices(batches, text_col):
            ids = code.encode_batch(C.texts(b.column(text_col)))
            columns = [b.column(id_col), pa.array([len(x) // 4 for x in ids], pa.int64()),
                       pa.array([hashlib.sha256(x).hexdigest() for x in ids]),
                       pa.array([hashlib.sha256(code.decode(x).encode()).hexdigest() for x in ids])]
            if ids_col:
                columns.append(pa.array([np.frombuffer(x, "<u4").astype(np.int32) for x in ids],
                                        pa.list_(pa.int32())))
            yield pa.RecordBatch.from_arrays(columns, names=out.names)

    return df.select(id_col, text_col).mapInArrow(run, out)


def decode_documents(df: DataFrame, tokenizer: str, ids_col: str = "ids", text_col: str = "text") -> DataFrame:
    """Add ``text_col`` decoded from an array of ids (null ids: empty text)."""
    rest = [f for f in df.schema.fields if f.name != text_col]
    out = T.StructType([*rest, T.StructField(text_col, T.StringType())])

    def run(batches):
        code = codec(tokenizer)
        for b in batches:
            text = [code.decode(np.array(x or [], dtype="<u4").tobytes()) for x in b.column(ids_col).to_pylist()]
            yield pa.RecordBatch.from_arrays([*(b.column(f.name) for f in rest), pa.array(text, pa.string())],
                                             names=out.names)

    return df.mapInArrow(run, out)
