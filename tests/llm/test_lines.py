"""Line rules against a plain count in Python, and documents cleaned of common lines."""

import random
import re
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from tallyhouse.llm import lines

WORD = re.compile(r"[^\x20\x09-\x0D]+")
COLUMNS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "lost_words", "base_failed", "kept"]


def norm(line):
    return " ".join(WORD.findall(line)).lower()


def by_hand(rows, min_docs, max_share):
    """(doc_id, text, source) to the columns above, as a multiset with the id."""
    texts, held = defaultdict(set), defaultdict(set)
    for _, text, host in rows:
        texts[host].add(text or "")
        for line in (text or "").split("\n"):
            if WORD.search(line):
                held[host, norm(line)].add(text)
    common = {
        key
        for key, found in held.items()
        if len(found) >= min_docs and len(found) > len(texts[key[0]]) * max_share
    }
    out = Counter()
    for doc_id, text, host in rows:
        text = text or ""
        words = WORD.findall(text)
        told = [x for x in text.split("\n") if WORD.search(x)]
        triples = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
        often = Counter(triples)
        covered = {i + k for i, t in enumerate(triples) if often[t] > 1 for k in range(3)}
        lost = sum(len(WORD.findall(x)) for x in told if (host, norm(x)) in common)
        failed = len(words) < 50 or 100 * len(covered) > 50 * len(words)
        out[
            doc_id, len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)),
            len(told) - len(set(told)), len(covered), lost, failed,
            not failed and len(words) - lost >= 0.5 * len(words),
        ] += 1
    return out


def rows_of(df):
    return Counter(tuple(r) for r in df.select("doc_id", *COLUMNS).collect())


def planted():
    """Hosts with a common line in a third of the texts, in long and in short documents."""
    rng = random.Random(7)

    def prose(n):
        return " ".join(rng.choice("abcdefghij") * rng.randint(1, 5) + str(rng.randint(0, 400)) for _ in range(n))

    rows = []
    footer = "All rights  RESERVED " + " ".join(f"f{i}" for i in range(38))
    for i in range(120):
        size = 60 if i % 3 else 200
        text = prose(size) + "\n" + prose(10)
        if i % 3 == 0 or i % 30 == 1:
            text += "\n" + footer.upper() if i % 2 else "\n" + footer + " "
        if i == 1:  # loses more than half of its words
            text = prose(15) + "\n" + footer
        rows.append((i, text, "hot" if i % 2 else None))
    rows += [(500 + i, prose(80) if i else footer + "\n" + prose(90), "small") for i in range(4)]
    rows += [(600 + i, rows[5][1], "hot") for i in range(90)]  # copies count once
    return rows


def test_rules_equal_a_count_by_hand(make):
    rows = planted()
    frame = make([(i, t, None, h, None) for i, t, h in rows])
    want = by_hand(rows, 20, 0.05)
    assert rows_of(lines.line_rules(frame)) == want
    kept = {k[0]: k[-1] for k in want}
    assert not kept[1] and kept[3] and kept[600] and kept[500]
    assert rows_of(lines.line_rules(frame, min_docs=2, max_share=0.0)) == by_hand(rows, 2, 0.0)


def test_odd_documents_and_repeated_rows(odd_documents):
    rows = [(r["doc_id"], r["text"], r["source"]) for r in odd_documents.collect()]
    assert rows_of(lines.line_rules(odd_documents)) == by_hand(rows, 20, 0.05)
    loose = lines.line_rules(odd_documents, min_docs=1, max_share=0.0)
    assert rows_of(loose) == by_hand(rows, 1, 0.0)


def test_repeated_windows_and_a_very_long_text(make):
    texts = ["x y z x y z", "a a a a", "a b", "one two three", "p q r s p q r", "k " * 200_000]
    rows = [(i, t, "s") for i, t in enumerate(texts)]
    found = lines.line_rules(make([(i, t, None, h, None) for i, t, h in rows]))
    assert rows_of(found) == by_hand(rows, 20, 0.05)


def test_cleaned_texts_lose_common_lines_only(make):
    rows = planted()
    frame = make([(i, t, None, h, None) for i, t, h in rows])
    rules = lines.line_rules(frame)
    cleaned = {r["doc_id"]: r["text"] for r in lines.without_common_lines(frame, rules).collect()}
    assert 1 not in cleaned
    gone = {r["doc_id"]: r["lost_words"] for r in rules.collect()}
    for doc_id, text, _ in rows:
        if doc_id not in cleaned:
            continue
        assert len(WORD.findall(text)) - len(WORD.findall(cleaned[doc_id])) == gone[doc_id]
        if not gone[doc_id]:
            assert cleaned[doc_id] == text


def test_empty_table_and_native_plan(no_documents, make):
    empty = lines.line_rules(no_documents)
    assert empty.count() == 0
    assert lines.without_common_lines(no_documents, empty).count() == 0
    frame = make([(1, "a b c\n" * 30, None, "s", None)])
    plan = lines.line_rules(frame).where(F.col("kept"))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
