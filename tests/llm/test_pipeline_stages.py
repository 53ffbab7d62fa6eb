"""The corpus pipeline stage by stage against brute force."""

import importlib
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

import corpus_pipeline
from tallyhouse.llm import registry, simhash

SMALL = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def stages(spark):
    """Rows of the documents and of every stage's result."""
    from tallyhouse.llm.common import stored

    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    out = {"documents": docs}
    for name, stage in corpus_pipeline.STAGES:
        docs = stored(stage(spark, docs, SMALL), name)
        out[name] = docs
    return {name: df.collect() for name, df in out.items()}


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def test_stages_are_registered():
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "toxicity", "exact_dedup", "simhash", "mixing", "packing",
    ]
    assert registry.QUERIES["pipeline"] is corpus_pipeline.run


def test_toxicity_rejects_toxic_and_keeps_clean(spark, stages):
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{SMALL}/labels.parquet").collect()}
    kept = {r.doc_id for r in stages["toxicity"]}
    clean = [i for i, x in labels.items() if x == 0]
    toxic = [i for i, x in labels.items() if x == 1]
    assert sum(i in kept for i in clean) > 0.97 * len(clean)
    assert sum(i in kept for i in toxic) < 0.35 * len(toxic)
    assert set(stages["toxicity"]) <= set(stages["documents"])


def test_exact_copies(stages):
    groups = defaultdict(list)
    for r in stages["toxicity"]:
        groups[lower(r.text)].append(r.doc_id)
    assert {r.doc_id for r in stages["exact_dedup"]} == {max(g) for g in groups.values()}
    assert set(stages["exact_dedup"]) <= set(stages["toxicity"])


def test_near_copies(stages):
    rows = sorted(stages["exact_dedup"], key=lambda r: r.doc_id)
    prints = np.array([simhash.fingerprint(r.text) for r in rows], np.uint64)
    above = list(range(len(rows)))

    def find(x):
        while above[x] != x:
            x = above[x]
        return x

    for i in range(len(rows)):
        for j in np.flatnonzero(np.bitwise_count(prints[:i] ^ prints[i]) <= 4):
            a, b = find(i), find(int(j))
            above[max(a, b)] = min(a, b)
    assert {r.doc_id for r in stages["simhash"]} == {rows[find(i)].doc_id for i in range(len(rows))}


def test_mixing(stages):
    before = {r.doc_id: r for r in stages["simhash"]}
    copies = Counter(r.doc_id for r in stages["mixing"])
    assert set(stages["mixing"]) <= set(stages["simhash"]) and max(copies.values()) <= 3
    size = {i: len(re.findall(r"[^\x20\x09-\x0D]+", r.text)) for i, r in before.items()}
    total = sum(size.values())
    assert sum(n * size[i] for i, n in copies.items()) == pytest.approx(total, rel=0.01)


def test_packing(stages):
    pieces = stages["packing"]
    starts = Counter(p.doc_id for p in pieces if p.start == 0)
    assert starts == Counter(r.doc_id for r in stages["mixing"])
    fill = defaultdict(list)
    for p in pieces:
        fill[p.sequence_id].append((p.offset, p.length))
    for parts in fill.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048
    assert len(fill) == -(-sum(p.length for p in pieces) // 2048)


def test_odd_and_empty_tables_pass_every_stage(spark, odd_documents, no_documents):
    """Frames that come from no file, too."""
    texts = [r.text for r in odd_documents.collect()]
    distinct = {lower(t) for t in texts}
    near = {simhash.fingerprint(t) for t in texts}
    rows = {"toxicity": len(texts), "exact_dedup": len(distinct), "simhash": len(near)}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, odd_documents, SMALL)
        assert out.columns == odd_documents.columns
        kept = out.count()
        assert kept == rows[name] if name in rows else 0 < kept <= 3 * len(texts)
        assert stage(spark, no_documents, SMALL).count() == 0
    assert corpus_pipeline.pack_sequences(spark, no_documents, SMALL).count() == 0


def test_entry_takes_the_queries_in():
    entry = importlib.import_module("__spark_entry__")
    names = entry.queries()
    assert all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 11))
    assert "pipeline" in names and set(entry.oracle_sql()) <= set(names)
