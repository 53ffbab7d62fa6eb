"""Alignment of two tokenizers against plain loops over the libraries' own tokens."""

import hashlib
import json
import random
from collections import Counter, defaultdict

import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from tallyhouse.llm import alignment
from tallyhouse.llm.alignment import PieceEncoder
from tallyhouse.llm.tokens import BYTE_LETTERS

COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


@pytest.fixture(scope="module")
def tokenizers():
    a = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as file:
        vocabulary = json.load(file)["model"]["vocab"]
    letters = {c: n for n, c in BYTE_LETTERS.items()}
    spelled = {i: bytes(letters[c] for c in w) for w, i in vocabulary.items() if i < 50256}
    return a, b, spelled


def b_bytes(model, token):
    piece = model.id_to_piece(token)
    if piece.startswith("<0x") and len(piece) == 6:
        return bytes([int(piece[3:5], 16)])
    return piece.replace("▁", " ").encode()


def spans(tokens):
    out, at = [], 0
    for token, raw in tokens:
        out.append((token, at, at + len(raw)))
        at += len(raw)
    return out


def by_hand(rows, tokenizers):
    a, b, spelled = tokenizers
    found, met = [], Counter()
    for doc_id, text in rows:
        sides = [[], []]
        if text:
            sides = [
                [(t, spelled[t]) for t in a.encode(" " + text, add_special_tokens=False).ids],
                [(t, b_bytes(b, t)) for t in b.encode(text)],
            ]
            if any(b"".join(raw for _, raw in s) != (" " + text).encode() for s in sides):
                sides = [[], []]
        left, right = map(spans, sides)
        links, first = [], 0
        for x, lo, hi in left:
            while first < len(right) and right[first][2] <= lo:
                first += 1
            k = first
            while k < len(right) and right[k][1] < hi:
                links.append((x, right[k][0]))
                k += 1
        met.update(links)
        ends = sorted({e for *_, e in left} & {e for *_, e in right})
        groups, at = [], [0, 0]
        for end in ends:
            parts = []
            for k, side in enumerate((left, right)):
                stop = at[k]
                while stop < len(side) and side[stop][2] <= end:
                    stop += 1
                parts.append(",".join(str(t) for t, _, _ in side[at[k] : stop]))
                at[k] = stop
            groups.append("|".join(parts))
        found.append((doc_id, len(left), len(right), groups, links))
    top = defaultdict(int)
    for (_, y), n in met.items():
        top[y] = max(top[y], n)
    return Counter(
        (
            doc_id, n_a, n_b, len(groups), len(links),
            sum(met[p] == top[p[1]] for p in links), sum(met[p] for p in links),
            hashlib.sha256(";".join(groups).encode()).hexdigest() if n_a else "",
        )
        for doc_id, n_a, n_b, groups, links in found
    )


def rows_of(df):
    return Counter(tuple(r) for r in df.select(*COLUMNS).collect())


ODD = [
    None, "", " ", "  ", "a", "a ", " a", "a  b   c", "x\n\ny\n z \n", "a\tb\r\nc", "<s> a </s> <|endoftext|> <0x41>",
    "a▁b", "漢字🙂 über naïve", "a\0b", "unbelievably antidisestablishmentarianism", " x 　y", "\n", "hello",
]


def test_equals_plain_loops(make, tokenizers):
    rng = random.Random(3)
    words = ["the", "transformer", "Straße", "über", "tokenization", "x1y2", "漢", "hello,", "(ok)", "...", "\n", "  "]
    rows = list(enumerate(ODD))
    rows += [(100 + i, " ".join(rng.choices(words, k=rng.randint(1, 60)))) for i in range(60)]
    rows += [(200, "same text again")] * 5 + [(None, "no id"), (None, "no id at all")]
    frame = make([(i, t, None, None, None) for i, t in rows])
    assert rows_of(alignment.align_documents(frame)) == by_hand(rows, tokenizers)


def test_odd_and_very_long_documents(odd_documents, tokenizers):
    rows = [(r["doc_id"], r["text"]) for r in odd_documents.collect()]
    assert rows_of(alignment.align_documents(odd_documents)) == by_hand(rows, tokenizers)


def test_small_batches_change_nothing(make, tokenizers, monkeypatch):
    rng = random.Random(5)
    rows = [(i, " ".join(rng.choices(["alpha", "beta", "gamma  ray", "über"], k=30))) for i in range(40)]
    at, whole = alignment.sides(), [t for _, t in rows]
    a, b = alignment.encode_both(whole, at)
    links, both = alignment.align(a, b, at)
    for k, text in enumerate(whole):
        one = alignment.encode_both([text], at)
        alone, _ = alignment.align(*one, at)
        part = links.filter([d == k for d in links["doc"].to_pylist()])
        assert part["a"].to_pylist() == alone["a"].to_pylist()
        assert part["b"].to_pylist() == alone["b"].to_pylist()
    monkeypatch.setattr(alignment, "BATCH_CHARS", 50)
    sizes = [len(t) for _, t in alignment._batches(iter(make(rows, "i long, t string").toArrow().to_batches()))]
    assert sum(sizes) == 40 and max(sizes) == 1


def test_pieces_equal_the_model(tokenizers):
    encoder, rng = PieceEncoder(max_cache=40), random.Random(11)
    assert encoder.by_piece
    letters = "ab é\n\t 漢<>0x1▁  "
    for _ in range(200):
        text = "".join(rng.choices(letters, k=rng.randint(1, 40)))
        found = list(map(int, __import__("numpy").frombuffer(encoder.encode([text])[0], encoder.dtype)))
        assert found == tokenizers[1].encode(text), repr(text)


def test_alignments_spell_the_groups(make, tokenizers):
    rows = [(1, "hello world"), (2, None), (3, "a▁b"), (4, "x\ny")]
    got = {r["doc_id"]: r for r in alignment.alignments(make([(i, t, None, None, None) for i, t in rows])).collect()}
    digests = {k[0]: k[-1] for k in by_hand(rows, tokenizers)}
    for doc_id, row in got.items():
        text = row["groups"]
        assert (hashlib.sha256(text.encode()).hexdigest() if text else "") == digests[doc_id]
    assert got[2]["a_ids"] == [] and got[3]["b_ids"] == [] and got[1]["a_ids"]


def test_empty_table(no_documents):
    assert alignment.align_documents(no_documents).count() == 0
