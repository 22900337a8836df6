import random
import sys
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

from fleetlens.llm import bpe, common as C, packing

from .conftest import odd_rows, rows

PATH = C.tokenizer_path()
HF = Tokenizer.from_file(PATH)


def brute_pieces(data, capacity):
    out = []
    for i, t in data:
        ids = HF.encode(t or "", add_special_tokens=False).ids + [2]
        cuts = list(range(len(ids), 0, -capacity))[::-1]
        at = 0
        for k, end in enumerate(cuts):
            part = np.array(ids[at:end], dtype="<u4").tobytes()
            out.append((i, k, at, end - at, zlib.crc32(part)))
            at = end
    return sorted(out, key=repr)


def check_sequences(got, capacity):
    bins = defaultdict(list)
    for r in got:
        bins[r.sequence_id].append((r.offset, r.length))
    for members in bins.values():
        at = 0
        for offset, length in sorted(members):
            assert offset == at
            at += length
        assert at <= capacity
    return len(bins)


COLS = ("doc_id", "piece", "start", "length", "ids_crc32")


@pytest.mark.parametrize("capacity,items", [(1024, 200_000), (64, 7)])
def test_odd_rows(odd, capacity, items):
    got = packing.pack(packing.pieces(odd, PATH, capacity, 2), capacity, task_items=items).persist()
    assert rows(got, *COLS) == brute_pieces([(r[0], r[1]) for r in odd_rows()], capacity)
    check_sequences(got.collect(), capacity)


def test_table_is_packed_tightly(small):
    got = packing.pack_documents(small, PATH).persist()
    assert rows(got, *COLS) == brute_pieces([(r.doc_id, r.text) for r in small.collect()], 1024)
    total = got.agg({"length": "sum"}).first()[0]
    assert check_sequences(got.collect(), 1024) <= -(-total // 1024) * 1.02 + 1


def test_tree_rounds_stay_tight(small):
    """Many small tasks and their merges need hardly more bins than one task."""
    parts = packing.pieces(small, PATH, 256, 2)
    one = check_sequences(packing.pack(parts, 256).collect(), 256)
    many = check_sequences(packing.pack(parts, 256, task_items=40).collect(), 256)
    assert many <= one * 1.03 + 1


def test_empty(none):
    assert packing.pack_documents(none, PATH).count() == 0


def test_best_fit_takes_the_tightest_bin():
    bins = packing.best_fit_decreasing(np.array([6, 7, 3, 4, 2]), 10)
    assert sorted(sorted(b) for b in bins) == [[0, 3], [1, 2], [4]]


def test_sequences_do_not_depend_on_cores(spark, small):
    """Same pieces, other parallelism of the plan: the same number of sequences."""
    parts = packing.pieces(small, PATH, 64, 2).persist()
    found = set()
    for n in (2, 16):
        old = spark.conf.get("spark.sql.shuffle.partitions")
        spark.conf.set("spark.sql.shuffle.partitions", n)
        found.add(check_sequences(packing.pack(parts.repartition(n), 64, first_items=100, task_items=300).collect(), 64))
        spark.conf.set("spark.sql.shuffle.partitions", old)
    assert len(found) == 1


def test_what_is_left_meets_in_one_task_if_it_fits(small):
    """Large items only, two never fit: every round stalls, none is lost."""
    parts = packing.pieces(small, PATH, 64, 2).filter("length > 32 and length < 64")
    got = packing.pack(parts, 64, first_items=20, task_items=100_000).persist()
    assert got.count() == parts.count() == check_sequences(got.collect(), 64)


def raw_ids(texts):
    return [np.array(e.ids, dtype="<u4").tobytes() for e in HF.encode_batch(texts, add_special_tokens=False)]


TRICKY = ["a", "B", "é", "日", "1", "٣", "²", "'", "'s", "'ll", "’", " ", "  ", "\n", "\t", "\r", "\x0b", "\x1c", "\x1f",
          "\x85", "\xa0", "\u2003", "\u2028", "\u3000", "\u200b", "\ufeff", "\u180e", "!", "_", "😀", "\u0301", "\x00",
          "<|endoftext|>", "<|endof", " the"]


def tricky(n, size):
    rnd = random.Random(size)
    return ["", *("".join(rnd.choices(TRICKY, k=rnd.randrange(size))) for _ in range(n))]


def test_whole_texts_get_the_ids_of_the_library():
    code = bpe.codec(PATH)
    assert code.ranks_suffice
    texts = tricky(3000, 60)
    assert code.encode_whole(texts) == raw_ids(texts)


def test_every_kind_of_character_is_cut_alike():
    """Letters, digits, white space and the rest are the same in both libraries."""
    blocks = [[chr(c) for c in range(lo, lo + 256) if not 0xD800 <= c < 0xE000] for lo in range(0, 0x20000, 256)]
    texts = ["".join(f"a{c}1{c}!{c} {c}\n{c}a" for c in block) for block in blocks]
    assert bpe.codec(PATH).encode_whole(texts) == raw_ids(texts)


def test_long_texts_are_encoded_in_parts(monkeypatch):
    """Parts change no id; neither do runs of white space that the faster
    library cannot take in one piece."""
    code = bpe.ForcedBoundaryCodec(PATH)
    long = ["a" + " " * 1_500_000 + "b", "word it's " * 30_000 + "\n \t" * 100_000 + " c " * 30_000, "\u3000" * 256_000,
            "xyz" * 50_000 + "<|endoftext|>" + " q" * 70_000]
    assert code.encode_whole(long) == raw_ids(long)
    monkeypatch.setattr(bpe, "PART_CHARS", 10)
    monkeypatch.setattr(bpe, "PART_LIMIT", 25)
    texts = tricky(2000, 120)
    assert code.encode_whole(texts) == raw_ids(texts)


def test_other_tokenizer_files_go_by_fragments(tmp_path):
    """A file of which the faster library knows nothing keeps the ids of tokenizers."""
    from tokenizers import normalizers
    other = Tokenizer.from_file(PATH)
    other.normalizer = normalizers.NFC()
    other.save(str(tmp_path / "other.json"))
    code = bpe.ForcedBoundaryCodec(str(tmp_path / "other.json"))
    assert not code.ranks_suffice
    assert code.encode_whole(["Plain words, no marks."]) == raw_ids(["Plain words, no marks."])


def test_rare_words_are_not_handled_one_by_one(monkeypatch):
    """The calls that the cutting step makes grow with the texts, not with their distinct words."""
    rnd = random.Random(3)
    texts = [" ".join("".join(rnd.choices("aeioulnrst", k=rnd.randrange(4, 12))) for _ in range(500))
             for _ in range(200)]
    code = bpe.ForcedBoundaryCodec(PATH)
    monkeypatch.setattr(packing, "codec", lambda path: code)
    _pieces_here(["warm"])
    calls = Counter()
    sys.setprofile(lambda frame, event, arg: calls.update([event]))
    try:
        batches = _pieces_here(texts)
    finally:
        sys.setprofile(None)
    assert [r["doc_id"] for b in batches for r in b.to_pylist() if r["piece"] == 0] == list(range(200))
    assert calls.total() < 100 * len(texts)      # by fragments: over 1000 a text


def _pieces_here(texts):
    """What pieces() gives, its task run in this process."""
    import pyarrow as pa
    from pyspark.sql import types as T

    class Frame:
        schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType())])

        def select(self, *cols):
            return self

        def mapInArrow(self, run, out):
            return list(run(iter([pa.RecordBatch.from_pydict({"doc_id": list(range(len(texts))), "text": texts})])))

    return packing.pieces(Frame(), PATH, 1024, 2)
