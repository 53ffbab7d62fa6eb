"""SimHash groups, components and the cuckoo index against brute force."""

import hashlib
import re
from collections import Counter

import numpy as np
import pytest
import xxhash
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tallyhouse.llm import components, cuckoo, simhash
from tallyhouse.llm.common import FILE, ROW, on_files, stored, with_row_key

RANDOM = settings(
    max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def slow_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", lower(text))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def groups(prints, radius):
    """Smallest index reachable, by comparing all pairs."""
    above = list(range(len(prints)))

    def find(x):
        while above[x] != x:
            x = above[x]
        return x

    for i, a in enumerate(prints):
        for j in range(i):
            if (a ^ prints[j]).bit_count() <= radius:
                x, y = find(i), find(j)
                above[max(x, y)] = min(x, y)
    return [find(i) for i in range(len(prints))]


@pytest.mark.parametrize("size", [0, 1, 3, 4, 5, 9, 40])
def test_fingerprint_by_definition(size):
    text = "  x\x0b".join(f"Wört{i * 7 % 11}É" for i in range(size))
    assert simhash.fingerprint(text) == slow_fingerprint(text)


def test_fingerprint_of_many_chunks(monkeypatch):
    text = " ".join(f"w{i % 37}" for i in range(500))
    monkeypatch.setattr(simhash, "CHUNK", 16)
    assert simhash.fingerprint(text) == slow_fingerprint(text)


def test_pivot_keys_meet_whatever_links():
    rng = np.random.default_rng(3)
    tables = simhash.PivotTables()
    x = rng.integers(0, 1 << 63, 400, dtype=np.uint64)
    for bits in range(5):
        y = x.copy()
        for k in range(len(y)):
            for b in rng.choice(64, bits, replace=False):
                y[k] ^= np.uint64(1) << np.uint64(b)
        assert (tables.keys(x) == tables.keys(y)).any(axis=0).all()
        gap = np.abs(tables.coordinates(x) - tables.coordinates(y)).max(axis=1)
        assert (gap <= bits).all()
        assert len(tables.linked(x, y, tables.coordinates(x), tables.coordinates(y))) == len(x)


@pytest.mark.parametrize("small", [1, 4, 64])
def test_links_connect_what_is_within_the_radius(spark, make, monkeypatch, small):
    """Dense groups, also by the path for large buckets."""
    rng = np.random.default_rng(small)
    prints = []
    for _ in range(12):
        center = int(rng.integers(0, 1 << 63))
        for _ in range(int(rng.integers(1, 25))):
            at = center
            for b in rng.choice(64, int(rng.integers(0, 6)), replace=False):
                at ^= 1 << int(b)
            prints.append(at)
    prints = sorted(set(prints))
    tables, seen = simhash.PivotTables(), simhash._Groups()
    fps = np.array(prints, np.uint64)
    found = simhash._bucket_links(fps, tables, seen)
    own = [prints.index(seen.find(p)) for p in prints]
    assert own == groups(prints, 4)
    assert len(found) == len(prints) - len(set(own))
    signed = make([(int(np.uint64(p).view(np.int64)),) for p in prints], "fp long")
    edges = simhash.links(signed)
    roots = {r.node: r.root for r in components.components(edges).collect()}
    label = {p: roots.get(int(np.uint64(p).view(np.int64)), int(np.uint64(p).view(np.int64))) for p in prints}
    expected = groups(prints, 4)
    pairs = Counter(zip([label[p] for p in prints], expected, strict=True))
    assert len(pairs) == len(set(expected)) == len(set(label.values()))


@RANDOM
@given(links=st.lists(st.tuples(st.integers(0, 25), st.integers(0, 25)), max_size=40))
def test_components(make, links):
    above = {}

    def find(x):
        while above.setdefault(x, x) != x:
            x = above[x]
        return x

    for a, b in links:
        if a != b:
            x, y = find(a), find(b)
            above[max(x, y)] = min(x, y)
    found = components.components(make(links, "a long, b long")).collect()
    assert {r.node: r.root for r in found} == {x: find(x) for x in above}


def test_components_of_a_long_path_and_a_star(make):
    path = [(i, i + 1) for i in range(200)]
    star = [(1000, 1001 + i) for i in range(300)]
    found = components.components(make(path + star, "a long, b long")).collect()
    assert {r.root for r in found if r.node <= 200} == {0}
    assert {r.root for r in found if r.node >= 1000} == {1000}
    assert len(found) == 201 + 301


def near_copies():
    rng = np.random.default_rng(1)
    rows = []
    for g in range(6):
        words = [f"w{rng.integers(0, 400)}" for _ in range(400)]
        for c in range(int(rng.integers(1, 5))):
            changed = list(words)
            for k in range(c):
                changed[int(rng.integers(0, 400))] = f"x{g}{k}"
            rows.append(" ".join(changed))
    return rows


def test_near_duplicates_equal_brute_force(make, odd_documents):
    texts = near_copies() + near_copies()[:3]
    rows = [(100 - i, t, None, None, None) for i, t in enumerate(texts)]
    found = simhash.near_duplicates(make(rows)).collect()
    prints = [slow_fingerprint(t) for t in texts]
    labels = groups(prints, 4)
    ids = {g: min(100 - i for i, x in enumerate(labels) if x == g) for g in labels}
    assert {(r.doc_id, r.component_id) for r in found} == {
        (100 - i, ids[g]) for i, g in enumerate(labels)
    }
    assert len(found) == len(rows)
    kept = simhash.keep_one(make(rows)).count()
    assert kept == len(set(labels))


def test_odd_documents_near(odd_documents, no_documents):
    rows = simhash.near_duplicates(odd_documents).collect()
    assert len(rows) == odd_documents.count()
    wordless = [r for r in rows if r.fp == 0]
    assert {r.component_id for r in wordless} == {0}
    assert {r.component_id for r in rows if r.doc_id is None and r.fp} == {None}
    assert len({(r[FILE], r[ROW]) for r in rows}) == len(rows)
    assert simhash.near_duplicates(no_documents).count() == 0
    assert simhash.keep_one(no_documents).count() == 0


def test_one_row_stays_of_each_group_whatever_its_id(make):
    """Null and repeated ids do not name a component."""
    rng = np.random.default_rng(5)
    texts = [" ".join(f"v{rng.integers(0, 10_000)}" for _ in range(60)) for _ in range(8)]
    ids = [None, None, None, 7, 7, 7, 1, 2]
    rows = [(i, t, None, None, None) for i, t in zip(ids, texts, strict=True)]
    rows += [(None, texts[0], None, None, None), (9, texts[3], None, None, None)]
    docs = on_files(make(rows))
    assert len(set(groups([slow_fingerprint(t) for t in texts], 4))) == len(texts)
    kept = with_row_key(docs).join(simhash.keep_one(docs), [FILE, ROW], "left_semi").collect()
    assert Counter((r.doc_id, r.text) for r in kept) == Counter(zip(ids, texts, strict=True))


def test_filter_inserts_deletes_and_overflows():
    held = cuckoo.CuckooFilter(2)
    keys = [hashlib.sha256(bytes([i])).digest() for i in range(200)]
    placed = [k for k in keys[:5] if held.insert(k)]
    assert all(k in held for k in placed)
    for k in placed:
        assert held.delete(k)
    assert not any(k in held for k in placed) and not held.delete(keys[0])
    assert not all(held.insert(k) for k in keys)  # eight places


def test_shard_grows_from_its_keys_and_verifies_hits():
    shard = cuckoo.Shard(2)
    keys = [hashlib.sha256(str(i).encode()).digest() for i in range(3000)]
    for i, k in enumerate(keys):
        shard.insert(k, i, (True, i, 0, 0), 1)
    assert shard.rebuilds > 3
    for i, k in enumerate(keys):
        assert shard.find(k, i)[1][1] == i
    shard.insert(keys[5], 5, (True, 99, 0, 0), 2)
    assert shard.find(keys[5], 5)[1:] == [(True, 99, 0, 0), 3]
    for i, k in enumerate(keys[:1000]):
        assert shard.delete(k, i) and not shard.delete(k, i)
    assert shard.find(keys[0], 0) is None and shard.find(keys[2000], 2000)
    assert len(list(shard.entries())) == 2000
    # A false hit of the filter is not in the bucket.
    near = bytearray(keys[2000])
    near[0] ^= 1
    assert bytes(near) in shard.filter and shard.find(bytes(near), 2000) is None


def test_exact_duplicates_equal_brute_force(odd_documents, no_documents):
    rows = cuckoo.exact_duplicates(odd_documents).collect()
    docs = odd_documents.select("doc_id", "text").collect()
    texts = {}
    for d in docs:
        texts.setdefault(lower(d.text), []).append(d.doc_id)
    expected = Counter()
    for text, ids in texts.items():
        best = max((i for i in ids if i is not None), default=None)
        digest = hashlib.sha256(text.encode()).hexdigest()
        for i in ids:
            expected[i, best, len(ids), digest] += 1
    assert Counter((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in rows) == expected
    kept = [r for r in rows if r.kept]
    assert len(kept) == len(texts) and all(r.doc_id == r.keep_id for r in kept)
    assert cuckoo.exact_duplicates(no_documents).count() == 0


def test_index_takes_more_and_forgets(make):
    first = cuckoo.digests(make([(i, f"text {i % 40}", None, None, None) for i in range(90)]))
    second = cuckoo.digests(make([(500 + i, f"Text {i}", None, None, None) for i in range(60)]))
    gone = cuckoo.digests(make([(0, f"text {i}", None, None, None) for i in range(10)]))
    index = cuckoo.update_index(None, cuckoo.insertions(first))
    assert index.count() == 40
    index = cuckoo.update_index(index, cuckoo.insertions(second), cuckoo.deletions(gone))
    held = {bytes(r.digest): r for r in index.collect()}
    assert len(held) == 50
    for i in range(60):
        entry = held.get(hashlib.sha256(f"text {i}".encode()).digest())
        if i < 10:
            assert entry is None
        else:
            rows = 1 + (0 if i >= 40 else len(range(i, 90, 40)))
            assert (entry.keep_id, entry.rows) == (500 + i, rows)


def test_star_joins_meet_stored_tables(spark, make):
    """Both sides of the join on a node are plain shuffles, so a hot node can be split."""
    edges = stored(make([(0, i) for i in range(1, 400)] + [(7, 500)], "a long, b long"), "edges")
    for key in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"):
        spark.conf.set(key, "-1")
    try:
        large = components._large_star(edges)._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in large and "HashAggregate" not in large
        roots = {r.node: r.root for r in components.components(edges).collect()}
    finally:
        for key in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"):
            spark.conf.unset(key)
    assert set(roots.values()) == {0} and len(roots) == 401
