"""Lexical search against a plain count in Python."""

import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from tallyhouse.llm import lexical

TERM = re.compile(lexical.TERM)
LOW = str.maketrans(lexical.UPPER, lexical.LOWER)
ITEMS = "item_id long, text string"


def terms(text):
    return TERM.findall((text or "").translate(LOW))


def by_hand(docs, items, k=50):
    told = [(i, Counter(terms(t))) for i, t in docs]
    told = [(i, c) for i, c in told if c]
    total = sum(sum(c.values()) for _, c in told)
    df = Counter(t for _, c in told for t in c)
    out = []
    for item, text in items:
        scored = []
        for doc_id, c in told:
            n, score = sum(c.values()), 0
            m = 100 - 50 + (50 * n * len(told)) // total
            for t in set(terms(text)):
                if c[t]:
                    w = math.floor(1000 * math.log((2 * len(told) + 2) / (2 * df[t] + 1)))
                    score += w * ((10**9 * c[t]) // (1000 * c[t] + 20 * m))
            if score > 0:
                scored.append((-score, doc_id is None, doc_id or 0, doc_id, score))
        scored.sort()
        out += [(item, rank + 1, s[3], s[4]) for rank, s in enumerate(scored[:k])]
    return Counter(out)


def corpus(n=400, seed=1):
    rng = random.Random(seed)
    common = ["the", "of", "and", "to", "in"]
    rare = [f"term{i}" for i in range(300)]
    docs = []
    for i in range(n):
        size = rng.randint(1, 120)
        words = [rng.choice(common) if rng.random() < 0.5 else rare[int(300 * rng.random() ** 2)] for _ in range(size)]
        docs.append((i, " ".join(words)))
    docs += [(1000 + i, docs[3][1]) for i in range(70)]  # ties beyond the last place
    items = [(i, "The " + " ".join(rng.sample(rare, 6) + rng.sample(common, 4))) for i in range(25)]
    return docs, items


@pytest.fixture
def small_shards(monkeypatch):
    monkeypatch.setattr(lexical, "SHARD_TOKENS", 900)


def ranked(make, docs, items, **options):
    index = lexical.build_index(make([(i, t, None, None, None) for i, t in docs]))
    found = lexical.search(index, make(items, ITEMS), **options)
    return Counter(tuple(r) for r in found.select("item_id", "rank", "doc_id", "score").collect())


def test_equals_a_plain_count(make):
    docs, items = corpus()
    items += [(90, docs[3][1]), (91, "nothing of this kind is xyzzy"), (92, None), (93, "?!"), (5, "the"), (5, "the")]
    assert ranked(make, docs, items) == by_hand(docs, items)
    assert ranked(make, docs, items, k=3, by_pairs=False) == by_hand(docs, items, 3)


def test_odd_documents(odd_documents, make):
    docs = [(r["doc_id"], r["text"]) for r in odd_documents.collect()]
    items = [(None, "HELLO word5 straße"), (1, "漢字 ID here no"), (2, "ÄÖ äö"), (3, " ".join(f"word{i}" for i in range(60)))]
    found = lexical.search(lexical.build_index(odd_documents), make(items, ITEMS))
    got = Counter(tuple(r) for r in found.select("item_id", "rank", "doc_id", "score").collect())
    assert got == by_hand(docs, items)


def test_empty_tables(make, no_documents):
    items = make([(1, "a b")], ITEMS)
    assert lexical.search(lexical.build_index(no_documents), items).count() == 0
    some = lexical.build_index(make([(1, "a b", None, None, None)]))
    assert lexical.search(some, make([], ITEMS)).count() == 0
    assert lexical.build_index(make([(1, "... ?", None, None, None), (2, None, None, None, None)])).count() == 0


def _block(docs, items, k):
    """Shards and block as tasks see them, without Spark."""
    batch = pa.RecordBatch.from_pydict({"i": [i for i, _ in docs], "t": [t for _, t in docs]})
    index = list(lexical._index(iter([batch])))
    sums = [sum(b.column(c)[0].as_py() for b in index) for c in ("n_docs", "n_terms")]
    block = lexical.Block([sorted({t.encode() for t in terms(x)}) for _, x in items], k, *sums)
    found = {}
    for facts in lexical._term_facts(block)(iter(index)):
        for term, df, most in zip(*(c.to_pylist() for c in facts.columns), strict=True):
            old = found.get(term, (0, 0))
            found[term] = (old[0] + df, max(old[1], most))
    block.learn(found)
    return block, list(lexical._block_shards(block)(iter(index)))


def test_pair_bounds_hold_and_are_tighter(small_shards):
    docs, items = corpus()
    block, rows = _block(docs, items, 10)
    assert len(rows) > 10
    best = [sorted(by_hand(docs, [i], 10), key=lambda r: r[1])[-1][3] for i in items]
    reads = {True: 0, False: 0}
    tighter = 0
    for row in rows:
        names = ("terms", "starts", "docs", "impacts")
        n = len(row.column("ids")[0].values)
        joint = lexical._values(row, 0, "joint").tolist()
        for q, order in enumerate(block.queries):
            answers = []
            for by_pairs in (True, False):
                shard = lexical.Shard(n, *(lexical._values(row, 0, c) for c in names))
                known = [joint[p] for p in block.paired[q]] if by_pairs else None
                scratch = np.zeros(n, np.int64)
                answers.append([x.tolist() for x in shard.reach(order, known, best[q], scratch)])
                assert not scratch.any()
                reads[by_pairs] += shard.read
                bounds = shard.bounds(order, known)
                # No document gets more from the weakest terms than the bound says.
                for i in range(len(order) + 1):
                    total = np.zeros(n, np.int64)
                    shard._sum(order[:i], total)
                    assert total.max(initial=0) <= bounds[i]
            plain = lexical.Shard(n, *(lexical._values(row, 0, c) for c in names)).bounds(order, None)
            paired = shard.bounds(order, [joint[p] for p in block.paired[q]])
            assert all(x <= y for x, y in zip(paired, plain, strict=True))
            tighter += paired[-1] < plain[-1]
            assert answers[0] == answers[1]
    assert tighter > len(rows) * len(items) / 2
    assert reads[True] < reads[False]


def test_many_small_shards_and_blocks(make, small_shards, monkeypatch):
    monkeypatch.setattr(lexical, "BLOCK_TERMS", 60)
    docs, items = corpus(150, seed=4)
    batch = pa.RecordBatch.from_pydict({"i": [i for i, _ in docs], "t": [t for _, t in docs]})
    shards = list(lexical._index(iter([batch])))
    assert len(shards) > 5
    assert sum(s.column("n_docs")[0].as_py() for s in shards) == len(docs)
    held = list(lexical._blocks(make(items, ITEMS)))
    assert len(held) > 2 and sum(map(len, held)) == len(items)
    assert ranked(make, docs, items[:6], k=5) == by_hand(docs, items[:6], 5)


def test_terms_of_long_texts_do_not_depend_on_slices(monkeypatch):
    text = " ".join(f"Wörd{i}-x" for i in range(3000)) + "é" * 500
    whole = [t.encode() for t in terms(text)]
    monkeypatch.setattr(lexical, "SLICE", 64)
    assert [t for part in lexical.terms_of(text) for t in part] == whole


def test_each_shard_is_a_row_group(spark, make, monkeypatch):
    # A task with several shards: a reader decodes a row group at once, so none may hold two.
    kept, stored = [], lexical.stored
    monkeypatch.setattr(lexical, "stored", lambda *a, **b: kept.append(stored(*a, **b)) or kept[-1])
    docs = spark.range(0, 3 * lexical.SHARD_DOCS - 5, 1, 1).selectExpr(
        "id AS doc_id", "if(id % 1000 = 7, 'a b', 'b') AS text"
    )
    index = lexical.build_index(docs)
    found = lexical.search(index, make([(1, "A")], ITEMS), k=2)
    assert [(r["rank"], r["doc_id"]) for r in found.orderBy("rank").collect()] == [(1, 7), (2, 1007)]
    shards = [df for df in kept if "ids" in df.columns]
    assert len(shards) == 2  # the index and the block
    for df in shards:
        files = [pq.ParquetFile(f.removeprefix("file://")).metadata for f in df.inputFiles()]
        assert [m.row_group(i).num_rows for m in files for i in range(m.num_row_groups)] == [1, 1, 1]


def test_a_shard_counts_its_terms_in_document_order():
    builder = lexical._Builder(pa.int64())
    for doc_id, text in ((7, "b a b"), (None, "?"), (8, None), (9, "a c a a"), (7, "c")):
        builder.add(doc_id, text)
    (row,) = builder.row().to_pylist()
    assert builder.ids == builder.tokens == [] and builder.held == 0
    assert row == {
        "n_docs": 3,
        "n_terms": 8,
        "ids": [7, 9, 7],
        "lengths": [3, 4, 1],
        "terms": [b"b", b"a", b"c"],
        "starts": [0, 1, 3, 5],
        "docs": [0, 0, 1, 1, 2],
        "times": [2, 1, 3, 1, 1],
    }
