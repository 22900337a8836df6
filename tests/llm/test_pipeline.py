"""Every stage against a plain version on its own input, and the whole run."""
from collections import defaultdict

import pytest

import corpus_pipeline as P
from fleetlens.llm import classifier

from .conftest import lower, rows, words
from .test_packing import brute_pieces, check_sequences
from .test_simhash import brute as simhash_brute


def plain_exact(data):
    best = {}
    for r in data:
        k = lower(r.text)
        if k not in best or (best[k].doc_id is None) or (r.doc_id is not None and r.doc_id > best[k].doc_id):
            best[k] = r
    return list(best.values())


def plain_near(data):
    comp = {}
    for (i, fp, c) in simhash_brute([(r.doc_id, r.text) for r in data]):
        comp[i] = c
    return [r for r in data if comp[r.doc_id] == r.doc_id]


def plain_cut(data, size=35):
    seen = defaultdict(int)
    for r in data:
        w = words(r.text)
        for s in range(len(w) - size + 1):
            seen[tuple(w[s:s + size])] += 1
    out = []
    for r in data:
        w, gone = words(r.text), set()
        for s in range(len(w) - size + 1):
            if seen[tuple(w[s:s + size])] > 1:
                gone.update(range(s, s + size))
        text = " ".join(x for k, x in enumerate(w) if k not in gone) if gone else r.text
        out.append((r.doc_id, text, r.lang, r.source, len(text) if gone else r.n_chars))
    return out


def test_run_equals_plain_stages(spark, sf, small):
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    scored = {r.doc_id: r.predicted for r in classifier.score_documents(small, labels).collect()}
    data = [r for r in small.collect() if scored[r.doc_id] == 1]
    kept = P.quality(spark, small, sf).persist()
    assert rows(kept) == sorted(map(tuple, data), key=repr)
    data = plain_exact(data)
    unique = P.exact_copies(spark, kept, sf).persist()
    assert rows(unique) == sorted(map(tuple, data), key=repr)
    data = plain_near(data)
    apart = P.near_copies(spark, unique, sf).persist()
    assert rows(apart) == sorted(map(tuple, data), key=repr)
    data = plain_cut(data)
    cut = P.repeated_passages(spark, apart, sf).persist()
    assert rows(cut) == sorted(data, key=repr)
    assert cut.schema.fieldNames() == small.schema.fieldNames()
    want = brute_pieces([(r[0], r[1]) for r in data], 1024)
    got = P.run(spark, sf).persist()
    assert rows(got, "doc_id", "piece", "start", "length", "ids_crc32") == want
    check_sequences(got.collect(), 1024)


@pytest.mark.parametrize("stage", [f for _, f in P.STAGES], ids=[n for n, _ in P.STAGES])
def test_stages_take_odd_rows(spark, odd, none, sf, stage):
    out = stage(spark, odd, sf)
    if stage is not P.pack:
        assert out.schema.fieldNames() == odd.schema.fieldNames()
        assert [f.dataType for f in out.schema] == [f.dataType for f in odd.schema]
    assert out.count() > 0
    assert stage(spark, none, sf).count() == 0


def test_near_copies_keep_one_of_each(spark, odd, sf):
    got = P.near_copies(spark, odd, sf).collect()
    from .test_simhash import fingerprint
    fps = [fingerprint(r.text) for r in got]
    assert len(set(fps)) == len(fps)
    every = {fingerprint(r.text) for r in odd.collect()}
    assert all(any((f ^ g).bit_count() <= 4 for g in fps) or len(every) > len(fps) for f in every)


def test_stage_list():
    assert [n for n, _ in P.STAGES] == ["quality classifier", "exact dedup", "simhash near-dedup", "substring dedup",
                                        "best-fit packing"]
    assert P.ORACLE_SQL is None
