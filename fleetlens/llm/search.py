"""Ranked lexical search: hybrid TAAT-DAAT over document blocks.

1. Every whole text is cut into terms; a row of the forward index holds a
   document's length and the counts of the terms that any query asks for.
2. N, L and the document frequencies are counted over all documents.
3. A task inverts a block of documents at a time (bounded postings) and runs
   every query over it.  The query's short posting lists are summed term by
   term into accumulators; from then on these are one iterator with one bound.
   It joins the long lists in a document-at-a-time pass over windows of
   documents: a window whose bounds add up to less than the best scores so far
   is skipped whole, in the others only documents that an essential iterator
   holds are candidates, and lists that cannot lift a candidate any more are
   looked up, by skipping, only for those that are left.
4. The best of each task meet per query, in two steps.

Skipping needs a bound strictly below the k-th score, so ties are kept and the
result is exact.  Queries are taken in blocks of bounded bytes.

Terms are the maximal matches of ``[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+``, A-Z lower-cased; as all
excluded characters are ASCII, UTF-8 bytes can be cut instead of characters.

Defined cases: a null text, as a document or a query, has no terms; such a
query has no result.  Every row is a document and every query row a query,
repeated ids included (rows of one item id each give their own ranks).  A null
document id comes before the others among equal scores.
"""

from __future__ import annotations

import heapq
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import common as C

K1_MILLI, B_PERCENT, SCALE = 12, 25, 1_000_000_000      # of the contract's score
QUERY_BYTES = 8 << 20        # query texts handled at once
POSTINGS = 2_000_000         # postings of a block
ACCUMULATORS = 2_000         # postings of a query's short lists, together
WINDOW = 1024                # documents of a window

_TERM = bytes(c + 32 if 65 <= c <= 90 else c if c > 127 or chr(c).isalnum() else 32 for c in range(256))


def terms(raw: bytes) -> list[bytes]:
    return raw.translate(_TERM).split()


def forward_index(docs: DataFrame, vocabulary: dict[bytes, int], id_col: str, text_col: str) -> DataFrame:
    """(``id``, ``n``, ``terms``, ``tfs``) of every document with a term;
    ``n`` counts all its terms, the arrays hold those of ``vocabulary``."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def index(batches):
        known = shared.value
        for b in batches:
            for part in C.slices([b], "text"):
                ids, n, at, counts = [], [], [], []
                ends = [0]
                for i, raw in zip(part.column("id").to_pylist(), C.encode(part.column("text"))):
                    words = terms(raw)
                    if not words:
                        continue
                    found = Counter(map(known.get, words))
                    found.pop(None, None)
                    ids.append(i)
                    n.append(len(words))
                    at.extend(found.keys())
                    counts.extend(found.values())
                    ends.append(len(at))
                ends = pa.array(ends, pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids, pa.int64()), pa.array(n, pa.int64()),
                     pa.ListArray.from_arrays(ends, pa.array(at, pa.int32())),
                     pa.ListArray.from_arrays(ends, pa.array(counts, pa.int64()))], names=["id", "n", "terms", "tfs"])

    return docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").alias("text")).mapInArrow(
        index, "id long, n long, terms array<int>, tfs array<long>")


class Block:
    """The inverted lists of a block of documents, with the scores that each
    posting adds and the largest of them per term and window."""

    def __init__(self, n: np.ndarray, ends: np.ndarray, term: np.ndarray, tf: np.ndarray, weight: np.ndarray,
                 n_docs: int, n_terms: int):
        doc = np.repeat(np.arange(len(n)), np.diff(ends))
        m = 100 - B_PERCENT + (B_PERCENT * n * n_docs) // n_terms
        score = weight[term] * ((SCALE * tf) // (1000 * tf + K1_MILLI * m[doc]))
        order = np.argsort(term, kind="stable")
        self.doc, self.score = doc[order], score[order]
        self.windows = -(-len(n) // WINDOW)
        key = term[order].astype(np.int64) * self.windows + self.doc // WINDOW
        self.at = np.zeros(len(weight) * self.windows + 1, dtype=np.int64)
        np.cumsum(np.bincount(key, minlength=len(weight) * self.windows), out=self.at[1:])
        self.top = np.zeros(len(weight) * self.windows, dtype=np.int64)
        starts = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if len(key) else np.zeros(0, dtype=np.int64)
        if len(starts):
            self.top[key[starts]] = np.maximum.reduceat(self.score, starts)
        self.top = self.top.reshape(len(weight), self.windows)

    def length(self, t: int) -> int:
        return int(self.at[(t + 1) * self.windows] - self.at[t * self.windows])

    def part(self, t: int, w: int) -> slice:
        """The postings of a term in a window."""
        k = t * self.windows + w
        return slice(self.at[k], self.at[k + 1])

    def accumulate(self, query: list[tuple[int, int]]) -> tuple[np.ndarray, np.ndarray]:
        """Term-at-a-time sums of whole lists: documents, ascending, and scores."""
        spans = [(slice(self.at[t * self.windows], self.at[(t + 1) * self.windows]), times) for t, times in query]
        doc = np.concatenate([self.doc[s] for s, _ in spans])
        score = np.concatenate([self.score[s] * times for s, times in spans])
        order = np.argsort(doc, kind="stable")
        doc, score = doc[order], score[order]
        starts = np.flatnonzero(np.r_[True, doc[1:] != doc[:-1]])
        return doc[starts], np.add.reduceat(score, starts)


def search_block(block: Block, query: list[tuple[int, int]], best: "Best", accumulators: int = ACCUMULATORS) -> None:
    """Add the block's documents to the ``best`` of a query of (term, times)."""
    lists = sorted((block.length(t), t, times) for t, times in query)
    lists = [x for x in lists if x[0]]
    short, total = 0, 0
    while short < len(lists) and total + lists[short][0] <= accumulators:
        total += lists[short][0]
        short += 1
    long = [(t, times) for _, t, times in lists[short:]]
    bound = sum((block.top[t] * times for t, times in long), np.zeros(block.windows, dtype=np.int64))
    if short:
        a_doc, a_sum = block.accumulate([(t, times) for _, t, times in lists[:short]])
        a_at = np.searchsorted(a_doc, np.arange(block.windows + 1) * WINDOW)
        a_top = np.zeros(block.windows, dtype=np.int64)
        held = np.flatnonzero(np.diff(a_at))
        if len(held):
            a_top[held] = np.maximum.reduceat(a_sum, a_at[held])
        bound = bound + a_top
    for w in np.flatnonzero(bound):
        if bound[w] < best.least():
            continue
        parts = []
        if short and a_top[w]:
            parts.append((int(a_top[w]), a_doc[a_at[w]:a_at[w + 1]], a_sum[a_at[w]:a_at[w + 1]], 1))
        for t, times in long:
            if block.top[t, w]:
                p = block.part(t, w)
                parts.append((int(block.top[t, w]) * times, block.doc[p], block.score[p], times))
        parts.sort(key=lambda x: -x[0])
        rest = np.cumsum([x[0] for x in parts][::-1])[::-1]
        least = max(best.least(), 1)
        score = np.zeros(WINDOW, dtype=np.int64)
        left = None                                   # candidates, once no other document can come in
        for (_, doc, gain, times), more in zip(parts, rest):
            at = doc - w * WINDOW
            if more >= least:                         # essential: its documents are candidates
                score[at] += gain * times
                continue
            if left is None:
                left = np.flatnonzero(score)
            left = left[score[left] + more >= least]
            if not len(left):
                break
            found = np.searchsorted(at, left)
            found[found == len(at)] = 0
            hit = at[found] == left
            score[left[hit]] += gain[found[hit]] * times
        else:
            left = np.flatnonzero(score) if left is None else left
            left = left[score[left] >= least]
            best.add(left + w * WINDOW, score[left])


class Best:
    """The k best (score, id) so far: larger scores, then null ids, then smaller ids."""

    def __init__(self, k: int):
        self.k, self.heap, self.ids = k, [], []

    def least(self) -> int:
        """Documents below this score cannot enter any more."""
        return self.heap[0][0] if len(self.heap) == self.k else 0

    def add(self, docs: np.ndarray, scores: np.ndarray) -> None:
        if len(docs) > self.k:
            few = scores >= np.partition(scores, -self.k)[-self.k]
            docs, scores = docs[few], scores[few]
        for d, s in zip(docs.tolist(), scores.tolist()):
            i = self.ids[d]
            entry = (s, i is None, 0 if i is None else -i)
            if len(self.heap) < self.k:
                heapq.heappush(self.heap, entry)
            else:
                heapq.heappushpop(self.heap, entry)


def _search_queries(docs: DataFrame, queries: list[tuple[int, list[bytes]]], k: int, id_col: str,
                    text_col: str) -> DataFrame:
    """(``q``, ``id``, ``score``): at least the k best of each query, at most k a task."""
    spark = docs.sparkSession
    vocabulary = {t: i for i, t in enumerate(sorted({t for _, ts in queries for t in ts}))}
    index = C.materialize(forward_index(docs, vocabulary, id_col, text_col), "forward-index")
    n_docs, n_terms = index.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    df = np.zeros(len(vocabulary), dtype=np.int64)      # one row per term of this block of queries
    for t, n in index.select(F.explode("terms").alias("t")).groupBy("t").count().toLocalIterator():
        df[t] = n
    weight = np.floor(1000 * np.log((2 * n_docs + 2) / (2 * df + 1))).astype(np.int64)
    wanted = [(q, list(Counter(vocabulary[t] for t in ts).items())) for q, ts in queries if ts]
    shared = spark.sparkContext.broadcast((wanted, weight, n_docs, n_terms))

    def run(batches):
        wanted, weight, n_docs, n_terms = shared.value
        best = [Best(k) for _ in wanted]

        def close(held):
            n = np.concatenate([b.column("n").to_numpy() for b in held])
            sizes = np.concatenate([np.diff(b.column("terms").offsets.to_numpy()) for b in held])
            term = np.concatenate([b.column("terms").flatten().to_numpy() for b in held])
            tf = np.concatenate([b.column("tfs").flatten().to_numpy() for b in held])
            block = Block(n, np.r_[0, np.cumsum(sizes)], term, tf, weight, n_docs, n_terms)
            ids = [i for b in held for i in b.column("id").to_pylist()]
            for (_, query), top in zip(wanted, best):
                top.ids = ids
                search_block(block, query, top)

        held, size = [], 0
        for b in batches:
            for at in range(0, b.num_rows, WINDOW):
                part = b.slice(at, WINDOW)
                held.append(part)
                size += len(part.column("terms").flatten()) + part.num_rows
                if size >= POSTINGS:
                    close(held)
                    held, size = [], 0
        if held:
            close(held)
        rows = [(q, None if e[1] else -e[2], e[0]) for (q, _), top in zip(wanted, best) for e in top.heap]
        for at in range(0, len(rows), 10_000):
            q, i, s = zip(*rows[at:at + 10_000])
            yield pa.RecordBatch.from_arrays([pa.array(q, pa.int64()), pa.array(i, pa.int64()),
                                              pa.array(s, pa.int64())], names=["q", "id", "score"])

    return index.mapInArrow(run, "q long, id long, score long")


def search(docs: DataFrame, items: DataFrame, k: int = 20, id_col: str = "doc_id", text_col: str = "text",
           item_col: str = "item_id", query_col: str = "text", query_bytes: int = QUERY_BYTES) -> DataFrame:
    """The ``k`` best documents of each query with a score above 0: ``item_id``,
    ``rank`` (from 1), ``doc_id``, ``score``.  Document ids are integers."""
    if k < 1:
        raise ValueError("k must be 1 at least")
    spark = docs.sparkSession
    asked = items.select(F.col(f"`{item_col}`").alias("item_id"), F.col(f"`{query_col}`").alias("query"))
    total = asked.agg(F.sum(F.octet_length("query"))).first()[0] or 0
    blocks = -(-total // query_bytes) or 1
    out = None
    for b in range(blocks):
        rows = asked if blocks == 1 else asked.filter(
            F.pmod(F.xxhash64("item_id", "query"), F.lit(blocks)) == b)
        rows = rows.collect()                          # about query_bytes of query texts
        queries = [(q, terms((r.query or "").encode())) for q, r in enumerate(rows)]
        names = spark.createDataFrame([(q, r.item_id) for q, r in enumerate(rows)],
                                      f"no long, item_id {asked.schema['item_id'].dataType.simpleString()}")
        found = _search_queries(docs, queries, k, id_col, text_col)

        def top(frame, *by):
            w = Window.partitionBy(*by).orderBy(F.desc("score"), F.asc_nulls_first("id"))
            return frame.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)

        # the best of some tasks first, so a query's rows of all tasks never meet at once
        found = top(top(found.withColumn("some", F.pmod(F.spark_partition_id(), F.lit(64))), "q", "some"), "q")
        found = found.join(F.broadcast(names), F.col("q") == F.col("no")).select(
            "item_id", "rank", F.col("id").alias(id_col), "score")
        out = found if out is None else out.unionByName(found)
    return out
