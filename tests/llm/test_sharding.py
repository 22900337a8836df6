import zlib
from collections import defaultdict

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from fleetlens.llm import sharding

from .conftest import odd_rows


def plain_best_fit(sizes, capacity):
    """One by one: the fullest bin that still takes the group."""
    rooms, loads = [], defaultdict(int)
    for size in sorted(sizes, reverse=True):
        fit = [(r, i) for i, r in enumerate(rooms) if r >= size]
        if fit:
            _, i = min(fit)
        else:
            i = len(rooms)
            rooms.append(max(capacity, size))
        rooms[i] -= size
        loads[i] += size
    return sorted(loads.values())


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 40), max_size=80), st.integers(20, 60))
def test_runs_equal_one_by_one(sizes, capacity):
    hist = {s: sizes.count(s) for s in sizes}
    runs = sharding.best_fit_runs(list(hist), list(hist.values()), capacity)
    loads, ranks = defaultdict(int), defaultdict(list)
    for size, a, z, b in runs:
        loads[b] += size * (z - a)
        ranks[size] += range(a, z)
    assert sorted(loads.values()) == plain_best_fit(sizes, capacity)
    assert all(sorted(ranks[s]) == list(range(n)) for s, n in hist.items())


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 500), min_size=1, max_size=60), st.integers(1, 16))
def test_given_number_of_shards(sizes, shards):
    hist = {s: sizes.count(s) for s in sizes}
    runs = sharding.fewest_capacity(list(hist), list(hist.values()), shards)
    ranks, used = defaultdict(list), set()
    for size, a, z, b in runs:
        ranks[size] += range(a, z)
        used.add(b)
    assert used <= set(range(shards))
    assert all(sorted(ranks[s]) == list(range(n)) for s, n in hist.items())


def check(got, data, shards):
    want = sorted((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in data if i is not None)
    assert sorted((r.doc_id, r["size"], r.text_crc32) for r in got if r.doc_id is not None) == want
    assert len(got) == len(data)
    slots, home = defaultdict(list), defaultdict(set)
    for r in got:
        slots[r.shard].append(r.slot)
        home[r["size"], r.text_crc32].add(r.shard)
        assert r.law == "bytes" and r.grown_shard is None and 0 <= r.shard < shards
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert all(len(h) == 1 for h in home.values())


def test_odd_rows(odd):
    check(sharding.shard_documents(odd, 16).collect(), [(r[0], r[1]) for r in odd_rows()], 16)


def test_table_is_even(small):
    got = sharding.shard_documents(small, 16).collect()
    check(got, [(r.doc_id, r.text) for r in small.collect()], 16)
    load = defaultdict(int)
    for r in got:
        load[r.shard] += r["size"]
    assert max(load.values()) <= 1.01 * sum(load.values()) / 16


def test_fixed_capacity(small):
    got = sharding.shard_documents(small, None, capacity=100_000).collect()
    load = defaultdict(int)
    for r in got:
        load[r.shard] += r["size"]
    assert max(load.values()) <= 100_000
    assert len(load) <= -(-sum(load.values()) // 100_000) + 1


def test_empty(none):
    assert sharding.shard_documents(none).count() == 0


def test_needs_one_of_both(odd):
    with pytest.raises(ValueError):
        sharding.shard_documents(odd, 16, capacity=5)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.booleans(), st.integers(0, 60)), max_size=150))
def test_room_tree(steps):
    """The tree gives what a sorted list gives, and stays balanced."""
    tree, plain = sharding.RoomTree(), []

    def height(at):
        if at is None:
            return 0
        left, right = height(at[1]), height(at[2])
        assert abs(left - right) <= 1 and at[3] == 1 + max(left, right)
        return at[3]

    for i, (put, size) in enumerate(steps):
        if put:
            tree.insert((size, i))
            plain = sorted([*plain, (size, i)])
        else:
            fit = next((x for x in plain if x >= (size, -1)), None)
            assert tree.pop_at_least((size, -1)) == fit
            plain = [x for x in plain if x != fit]
        height(tree.top)
