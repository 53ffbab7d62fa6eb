"""Targets, rates and copies against a plain computation."""

import math
import re
import warnings
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tallyhouse.llm import mixing, registry

SMALL = "/root/testdata/sf0.001"


def words(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def slow_targets(sizes, weights=(5, 2, 1), cap=3):
    """Share by weight, stop at the cap, share the excess, until none is above."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[k % len(weights)] for k, s in enumerate(names)}
    total, free, target = sum(sizes.values()), set(names), {}
    while True:
        rest = total - sum(cap * sizes[s] for s in names if s not in free)
        share = sum(weight[s] for s in free)
        target = {s: rest * weight[s] / share if s in free else cap * sizes[s] for s in names}
        over = {s for s in free if target[s] > cap * sizes[s]}
        if not over:
            return target
        free -= over


def check(rows, docs):
    sizes = defaultdict(int)
    for _, text, _, source, _ in docs:
        sizes[source] += words(text)
    target = slow_targets(sizes)
    assert Counter(r.doc_id for r in rows) == Counter(d[0] for d in docs)
    by_text = {d[0]: (words(d[1]), d[3]) for d in docs}
    taken, longest, shortest = defaultdict(int), defaultdict(int), {}
    for r in rows:
        size, source = by_text[r.doc_id]
        assert r.size == size and r.taken == r.copies * size and 0 <= r.copies <= 3
        assert r.source_size == sizes[source]
        assert r.target == pytest.approx(target[source], rel=1e-9, abs=1e-9)
        taken[source] += r.taken
        longest[source] = max(longest[source], size)
    for source, t in target.items():
        assert abs(taken[source] - t) <= longest[source]
    return taken, target


def corpus(seed, n=300):
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        source = "hot" if rng.random() < 0.4 else f"s{rng.integers(0, 9)}"
        size = int(rng.integers(0, 8)) if rng.random() < 0.3 else int(rng.integers(1, 400))
        rows.append((i, " ".join(["w"] * size), None, source if rng.random() < 0.95 else None, None))
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_mix_meets_its_targets(make, seed):
    docs = corpus(seed)
    rows = mixing.mix(make(docs)).collect()
    taken, target = check(rows, docs)
    for source, t in target.items():
        assert abs(taken[source] - t) <= max(12, 0.02 * t)
    again = mixing.mix(make(docs)).collect()
    assert {(r.doc_id, r.taken) for r in rows} == {(r.doc_id, r.taken) for r in again}


def test_rates_solve_the_dual(make):
    """Rates are exp(lambda x), no more than the cap, and meet the target before rounding."""
    docs = corpus(5)
    rows = mixing.mix(make(docs)).collect()
    by_text = {d[0]: d[3] for d in docs}
    sums, tilt = defaultdict(float), defaultdict(set)
    for r in rows:
        source = by_text[r.doc_id]
        sums[source] += r.rate * r.size
        if r.size and r.rate < 3:
            tilt[source].add(round(math.log(r.rate) / r.size, 9))
        assert r.rate <= 3 and abs(r.copies - r.rate) <= 3
    target = {by_text[r.doc_id]: r.target for r in rows}
    for source, t in target.items():
        assert sums[source] == pytest.approx(t, rel=1e-5)
        assert len(tilt[source]) <= 1 or max(tilt[source]) - min(tilt[source]) < 1e-6


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    docs=st.lists(
        st.tuples(st.sampled_from(["a", "B", "ä", None, ""]), st.integers(0, 30)), min_size=1, max_size=25
    )
)
def test_any_small_corpus(make, docs):
    rows = [(i, "w " * n, None, s, None) for i, (s, n) in enumerate(docs)]
    check(mixing.mix(make(rows)).collect(), rows)


def test_hot_copies_share_the_copies_evenly(make):
    docs = [(i, "a b c d e", None, "hot", None) for i in range(200)]
    docs += [(1000 + i, "x y z", None, f"s{i % 4}", None) for i in range(40)]
    rows = mixing.mix(make(docs)).collect()
    check(rows, docs)
    hot = Counter(r.copies for r in rows if r.doc_id < 1000)
    assert len(hot) <= 2 and max(hot) - min(hot) <= 1


def test_odd_documents_mix(odd_documents, no_documents):
    rows = mixing.mix(odd_documents).collect()
    assert len(rows) == odd_documents.count()
    assert all(r.taken <= 3 * r.size for r in rows)
    total = sum(r.size for r in rows)
    assert sum({(r.source_size, r.target): r.target for r in rows}.values()) == pytest.approx(total)
    assert mixing.mix(no_documents).count() == 0


def test_no_python_in_the_plan(spark, capsys):
    registry.QUERIES["op7_mixing"](spark, SMALL).explain("simple")
    text = capsys.readouterr().out
    assert "Python" not in text and "Arrow" not in text and "Cartesian" not in text


def test_a_solution_that_is_not_reached_is_told(make):
    cells = make([(0, 1, 10), (0, 7, 5)], "s int, size long, n long")
    targets = make([(0, 45, 15, 1, 60.0)], "s int, source_size long, filled long, shortest long, target double")
    with pytest.warns(UserWarning, match="off its target"):
        mixing.solve(cells, targets, max_steps=1)
    with warnings.catch_warnings():
        warnings.simplefilter("error")
        lam = mixing.solve(cells, targets).first().lam
    taken = sum(size * n * min(math.exp(lam * size / 3), 3) for size, n in ((1, 10), (7, 5)))
    assert taken == pytest.approx(60, rel=1e-6)
