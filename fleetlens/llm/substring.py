"""Substring dedup with repeated-phrase automata.

A window is a run of ``size`` words of one text.  A window recurs if the same
words start anywhere else too, in any text.  Every word covered by a recurring
window is removed.

Texts are put into parts of about ``part_bytes`` by a hash of id and text, in
a fixed order, so a place is (part, word number).  They shuffle once; every
step reads the same exchange.

1. *Candidates.*  Of the ``anchor``-word phrases of each window the one with
   the smallest hash is its anchor (winnowing), so equal windows have equal
   anchors and about one phrase in thirteen is one.  A part sends each of its
   anchors once; those of one place are dropped.
2. *Confirmation.*  The windows whose anchor recurs are counted by two hashes
   (127 bits together, from two word hashes).  A part sends each of its
   windows once, so a passage in a third of all texts gives one row a part.
   Of the places of a recurring window the smallest is its representative.
3. *Passages.*  Windows of a part that always follow each other there and whose
   representatives do so too make one passage.  Its words are cut out of the
   representative's text alone, once for all the parts that ask for it.
4. *Automata.*  The passages that a part asked for are compiled into shards of
   Aho-Corasick automata of at most ``SHARD_WORDS`` words each, and all texts
   of the part stream through every shard.  The hits, compared word by word,
   are what is removed: the other places of a passage are not known before.

Null texts have no words.  Repeated rows count as copies.
"""

from __future__ import annotations

import hashlib

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import common as C

ANCHOR = 12
PART_BYTES = 2 << 20       # text bytes of a part
SHARD_WORDS = 1 << 18      # words of the passages of one automaton


def _window_starts(words: C.Words, size: int) -> np.ndarray:
    """Word numbers at which a window of ``size`` words of one text starts."""
    room = np.maximum(words.count - size + 1, 0)
    if not room.sum():
        return np.zeros(0, dtype=np.int64)
    base = np.repeat(words.first[:-1], room)
    return base + np.arange(len(base)) - np.repeat(np.cumsum(room) - room, room)


def _sliding(best, x: np.ndarray, width: int) -> np.ndarray:
    """Minimum or maximum over every run of ``width`` values, by doubling."""
    out, have = x, 1
    while have < width:
        step = min(have, width - have)
        out = best(out[:len(out) - step], out[step:])
        have += step
    return out


class Windows:
    """The windows of the texts of a part: ``starts`` (word numbers), their anchor
    hashes ``least``, and the places ``picked`` of all phrases that are the
    anchor of some window (every place of a tie)."""

    def __init__(self, raw: list[bytes], size: int, anchor: int):
        self.words = C.Words(raw)
        self.hashes = self.words.hashes()
        self.starts = _window_starts(self.words, size)
        if not len(self.starts):
            self.least = self.phrase = np.zeros(0, dtype=np.uint64)
            self.picked = self.starts
            return
        width = size - anchor + 1
        self.phrase = np.maximum(C.window_hashes(self.hashes, anchor, 7), np.uint64(1))
        least = _sliding(np.minimum, self.phrase, width)
        self.least = least[self.starts]
        # windows across two texts count as zero; a phrase is an anchor if the
        # largest minimum of the windows around it is its own hash
        inside = np.zeros(len(least), dtype=np.uint64)
        inside[self.starts] = self.least
        pad = np.zeros(width - 1, dtype=np.uint64)
        around = _sliding(np.maximum, np.concatenate([pad, inside, pad]), width)
        self.picked = np.flatnonzero(around == self.phrase)


def _texts(part: pa.Table) -> tuple[np.ndarray, list[bytes]]:
    """(order of the rows, texts in it): the same however the rows arrive."""
    raw = C.encode(part.column("text").combine_chunks())
    row = part.column("row").to_pylist()
    order = sorted(range(len(raw)), key=lambda i: (row[i], raw[i]))
    return np.array(order, dtype=np.int64), [raw[i] for i in order]


def _table(columns: dict[str, tuple]) -> pa.Table:
    return pa.table({name: pa.array(values, kind) for name, (values, kind) in columns.items()})


def _anchors(size: int, anchor: int):
    """Part -> (``key``, ``part``, ``many``): its anchors, each once; ``many``
    says that it stands at two places of the part or more."""
    def run(part: pa.Table) -> pa.Table:
        w = Windows(_texts(part)[1], size, anchor)
        key, times = np.unique(w.phrase[w.picked], return_counts=True)
        return _table({"key": (key.view(np.int64), pa.int64()),
                       "part": (np.full(len(key), part.column("part")[0].as_py()), pa.int64()),
                       "many": (times > 1, pa.bool_())})
    return run


def _chained(group: np.ndarray, start: np.ndarray, row: np.ndarray, first: np.ndarray) -> np.ndarray:
    """For every group of equal windows: do its windows and those of the group
    before its first one always stand side by side?  ``first`` is the index of
    the first window of each group; windows are in the order of ``start``."""
    beside = (start[1:] == start[:-1] + 1) & (row[1:] == row[:-1])
    after = np.full(len(group), -1, dtype=np.int64)
    after[:-1][beside] = group[1:][beside]
    before = np.full(len(group), -1, dtype=np.int64)
    before[1:][beside] = group[:-1][beside]
    forks = np.bincount(group, weights=after != after[first][group], minlength=len(first)) > 0
    joins = np.bincount(group, weights=before != before[first][group], minlength=len(first)) > 0
    back = before[first]
    return (back >= 0) & ~joins & ~forks[back]


def _windows(size: int, anchor: int):
    """Part and its recurring anchors -> (``key``, ``second``, ``place``): its
    windows with such an anchor, each once, at the first word it starts at.  A
    place is the part, the word number and two bits: does the part hold the
    window twice or more, does it start a passage."""
    def run(part: pa.Table, anchors: pa.Table) -> pa.Table:
        key = second = place = np.zeros(0, dtype=np.int64)
        if part.num_rows and anchors.num_rows:
            w = Windows(_texts(part)[1], size, anchor)
            near = np.flatnonzero(np.isin(w.least, anchors.column("key").to_numpy().view(np.uint64)))
            start = w.starts[near]
            if len(start):
                one = C.mix(C.window_hashes(w.hashes, size, 11)[start] ^ C.mix(w.least[near])).view(np.int64)
                two = C.window_hashes(w.words.hashes(2), size, 23)[start].view(np.int64)
                order = np.lexsort((two, one))            # stable: equal windows stay in order of start
                new = np.concatenate([[True], (one[order][1:] != one[order][:-1]) | (two[order][1:] != two[order][:-1])])
                group = np.empty(len(start), dtype=np.int64)
                group[order] = np.cumsum(new) - 1
                first = order[new]
                many = np.bincount(group) > 1
                cut = ~_chained(group, start, w.words.row[start], first)
                number = np.int64(part.column("part")[0].as_py())
                key, second = one[first], two[first]
                place = (number << 32) | (start[first] << 2) | (many.astype(np.int64) << 1) | cut
        return _table({"key": (key, pa.int64()), "second": (second, pa.int64()), "place": (place, pa.int64())})
    return run


def _requests(confirmed: pa.Table) -> pa.Table:
    """Recurring windows of a part -> (``part``, ``home``, ``at``, ``len``):
    its passages as runs of ``len`` windows at word ``at`` of the part ``home``."""
    place = np.sort(confirmed.column("place").to_numpy())
    rep = confirmed.column("rep").to_numpy()[np.argsort(confirmed.column("place").to_numpy())]
    start, home, at = (place >> 2) & 0x3FFFFFFF, rep >> 32, (rep >> 2) & 0x3FFFFFFF
    on = (place[1:] & 1 == 0) & (start[1:] == start[:-1] + 1) & (home[1:] == home[:-1]) & (at[1:] == at[:-1] + 1)
    first = np.flatnonzero(np.concatenate([[True], ~on]))
    return _table({"part": (place[first] >> 32, pa.int64()), "home": (home[first], pa.int64()),
                   "at": (at[first], pa.int64()),
                   "len": (np.diff(np.concatenate([first, [len(place)]])), pa.int64())})


def _passages(size: int):
    """Part and the runs wanted of it -> (``from``, ``word``, ``run``,
    ``words``): the words of each, joined by one space."""
    def run(part: pa.Table, wanted: pa.Table) -> pa.Table:
        out = []
        if part.num_rows and wanted.num_rows:
            words = b"\n".join(_texts(part)[1]).split()
            out = [b" ".join(words[a:a + n - 1 + size])
                   for a, n in zip(wanted.column("at").to_pylist(), wanted.column("len").to_pylist())]
        else:
            wanted = wanted.slice(0, 0)
        return _table({"from": (wanted.column("home").to_numpy(), pa.int64()),
                       "word": (wanted.column("at").to_numpy(), pa.int64()),
                       "run": (wanted.column("len").to_numpy(), pa.int64()), "words": (out, pa.binary())})
    return run


class Shard:
    """One Aho-Corasick automaton over word numbers."""

    def __init__(self):
        self.automaton = ahocorasick.Automaton(ahocorasick.STORE_ANY, ahocorasick.KEY_SEQUENCE)
        self.size = 0

    def add(self, numbers: tuple[int, ...], words: list[bytes] | None = None) -> None:
        """A passage; with ``words`` its hits are compared on them."""
        self.size += len(numbers)
        _, same = self.automaton.get(numbers, (0, []))     # other words that meet in the numbers
        self.automaton.add_word(numbers, (len(numbers), [*same, words]))

    def compile(self) -> None:
        self.automaton.make_automaton()

    def mark(self, edges: np.ndarray, numbers: tuple[int, ...], words: list[bytes] | None = None) -> None:
        """Add one at the first word of every occurrence of a passage, and take
        one off behind its last."""
        for end, (length, passages) in self.automaton.iter(numbers):
            begin = end + 1 - length
            if words is None or words[begin:end + 1] in passages:
                edges[begin] += 1
                edges[end + 1] -= 1

    def covered(self, numbers: tuple[int, ...], words: list[bytes] | None = None) -> np.ndarray:
        """Which words an occurrence of some passage covers."""
        edges = np.zeros(len(numbers) + 1, dtype=np.int32)
        self.mark(edges, numbers, words)
        return np.cumsum(edges[:-1]) > 0


def _locate(raw: list[bytes], passages: list[bytes], size: int,
            shard_words: int = SHARD_WORDS) -> list[np.ndarray | None]:
    """Covered words of every text (None: none), found by the automata of the
    passages."""
    if not passages:
        return [None] * len(raw)
    words = C.Words(raw + passages)
    number = np.unique(words.hashes(), return_inverse=True)[1]
    first = words.first
    del words

    def numbers_of(i: int) -> tuple[int, ...]:
        return tuple(number[first[i]:first[i + 1]].tolist())

    shards = [Shard()]
    for i, passage in enumerate(passages, len(raw)):
        if shards[-1].size >= shard_words:
            shards.append(Shard())
        shards[-1].add(numbers_of(i), passage.split(b" "))
    for shard in shards:
        shard.compile()
    out = []
    for i, text in enumerate(raw):
        numbers = numbers_of(i)
        edges = np.zeros(len(numbers) + 1, dtype=np.int32)
        if len(numbers) >= size:
            split = text.split()
            for shard in shards:
                shard.mark(edges, numbers, split)
        out.append(np.cumsum(edges[:-1]) > 0 if edges.any() else None)
    return out


def remove_repeated(df: DataFrame, size: int = 35, anchor: int = ANCHOR, id_col: str = "doc_id",
                    text_col: str = "text", keep: list[str] | None = None,
                    digest: bool = False, untouched: bool = False,
                    part_bytes: int = PART_BYTES) -> DataFrame:
    """The columns ``keep`` (default: the id) plus ``n_words``, ``n_removed``
    and ``kept_text`` (the words left, joined by one space), or with ``digest``
    its SHA-256 as ``kept_sha256``.  With ``untouched`` the kept text of a row
    that loses nothing is its text as it came, null too.  Every input row is
    returned.  One aggregation, of the text bytes, runs when this is called."""
    if not 1 <= anchor <= size:
        raise ValueError("anchor must be between 1 and size")
    if digest and untouched:
        raise ValueError("a digest is taken of the words left")
    keep = [id_col] if keep is None else keep
    rest = [c for c in keep if c != text_col]
    kept_as = [f"keep{i}" for i in range(len(rest))]      # names of their own: no clash, no dots
    whole = F.col(f"`{text_col}`")
    total = df.agg(F.sum(F.octet_length(whole))).first()[0] or 0
    row = F.xxhash64(F.col(f"`{id_col}`"), whole)
    docs = df.select(*[F.col(f"`{c}`").alias(k) for c, k in zip(rest, kept_as)],
                     whole.cast("string").alias("text"), row.alias("row"),
                     F.pmod(F.xxhash64(row), F.lit(max(1, -(-total // part_bytes)))).alias("part"))
    parts = docs.groupBy("part")

    anchors = parts.applyInArrow(_anchors(size, anchor), "key long, part long, many boolean")
    same = Window.partitionBy("key")
    anchors = (anchors.withColumns({"places": F.count(F.lit(1)).over(same), "any": F.max("many").over(same)})
               .filter("any or places > 1").select("part", "key"))
    windows = parts.cogroup(anchors.groupBy("part")).applyInArrow(
        _windows(size, anchor), "key long, second long, place long")
    same = Window.partitionBy("key", "second")
    confirmed = (windows.withColumns({"places": F.count(F.lit(1)).over(same), "rep": F.min("place").over(same),
                                      "any": F.max(F.col("place").bitwiseAND(2)).over(same)})
                 .filter("any > 0 or places > 1")
                 .select(F.shiftright("place", 32).alias("part"), "place", "rep"))
    requests = confirmed.groupBy("part").applyInArrow(_requests, "part long, home long, at long, len long")
    wanted = requests.select("home", "at", "len").distinct()
    passages = parts.cogroup(wanted.groupBy("home")).applyInArrow(
        _passages(size), "from long, word long, run long, words binary")
    sent = (requests.join(passages, (F.col("home") == F.col("from")) & (F.col("at") == F.col("word"))
                          & (F.col("len") == F.col("run"))).select("part", "words"))

    last = "kept_sha256" if digest else "kept_text"
    kinds = df.select(*[F.col(f"`{c}`") for c in rest]).schema
    out = T.StructType([*(T.StructField(k, f.dataType) for k, f in zip(kept_as, kinds)),
                        T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType()),
                        T.StructField("kept_last", T.StringType())])

    def run(part: pa.Table, passages: pa.Table) -> pa.Table:
        order, raw = _texts(part)
        rows = part.take(pa.array(order))
        count, gone, kept = [], [], []
        for i, (text, mask) in enumerate(zip(raw, _locate(raw, passages.column("words").to_pylist(), size))):
            words = text.split()
            count.append(len(words))
            gone.append(0 if mask is None else int(mask.sum()))
            if mask is None and untouched:
                kept.append(rows.column("text")[i].as_py())
                continue
            if mask is not None:
                words = [x for x, m in zip(words, mask.tolist()) if not m]
            joined = b" ".join(words)
            kept.append(hashlib.sha256(joined).hexdigest() if digest else joined.decode())
        return pa.table([*(rows.column(k) for k in kept_as), pa.array(count, pa.int64()),
                         pa.array(gone, pa.int64()), pa.array(kept, pa.string())], names=out.names)

    found = parts.cogroup(sent.groupBy("part")).applyInArrow(run, out)
    return found.select(*[F.col(k).alias(c) for k, c in zip(kept_as, rest)], "n_words", "n_removed",
                        F.col("kept_last").alias(last))
