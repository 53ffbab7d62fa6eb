"""Encoding, token files and packing against the tokenizer itself."""

import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tallyhouse.llm import packing, token_files
from tallyhouse.llm.common import scratch_path
from tallyhouse.llm.tokens import Encoder


@pytest.fixture(scope="module")
def plain():
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    tokenizer.encode_special_tokens = True
    return lambda text: tokenizer.encode(text or "", add_special_tokens=False).ids


PARTS = [
    " ", "  ", "\n", "\n\n", "\t", "\r\n", "\xa0", "　", "a", "é", "ß", "1", "22", ".", "!?", "'s",
    "don't", "<|endoftext|>", "\0", "中文", "🙂", "\x1c", "\x85", "​", "foo", "Bar", ",", "(x)",
]


def test_pieces_give_the_ids_of_the_whole_text(plain):
    encoder, rng = Encoder(max_cache=50), random.Random(7)
    texts = ["".join(rng.choice(PARTS) for _ in range(rng.randint(0, 16))) for _ in range(4000)]
    got = encoder.encode(texts)
    for text, ids in zip(texts, got, strict=True):
        assert np.frombuffer(ids, encoder.dtype).tolist() == plain(text), repr(text)


def test_a_word_is_learned_once_whatever_punctuation_follows(plain):
    encoder = Encoder()
    text = "one, one. one!? Été, Été\none\none,\none; one's 1. <one>"
    assert np.frombuffer(encoder.encode([text])[0], encoder.dtype).tolist() == plain(text)
    words = {" one", " \u00c9t\u00e9", "\none"}
    assert words <= set(encoder.cache)
    assert not {w + tail for w in words for tail in (",", ".", "!?", ";")} & set(encoder.cache)


def test_words_of_a_batch_are_learned_together(plain, monkeypatch):
    encoder, alone = Encoder(), []
    learn = encoder._learn
    monkeypatch.setattr(encoder, "_learn", lambda piece: alone.append(piece) or learn(piece))
    encoder.cache.learn = encoder._learn
    texts = ["One two, \u00c9t\u00e9: three\nfour a\0b", "one. Two;\n\u00e9t\u00e9 -- 5", None, ""]
    got = encoder.encode(texts)
    for text, ids in zip(texts, got, strict=True):
        assert np.frombuffer(ids, encoder.dtype).tolist() == plain(text)
    assert not [piece for piece in alone if piece.strip().isalpha()]


def test_cuts_beside_letters_and_signs_of_two_bytes(plain):
    encoder = Encoder()
    letters = ["a", "Z", "\u00d7", "\u00f7", "\u00d6", "\u0117", "\u0237", "\u024f", "\u2014", "\u6f22"]
    texts = [x + y + z for x in ["", *letters] for y in [",", "'s", "!?", "\0", ".,a"] for z in ["", *letters]]
    got = encoder.encode([" ".join(texts), *texts])
    for text, ids in zip([" ".join(texts), *texts], got, strict=True):
        assert np.frombuffer(ids, encoder.dtype).tolist() == plain(text), repr(text)


def test_a_slice_of_a_column_is_encoded(plain):
    encoder = Encoder()
    texts = ["first, one", None, "second \u00e9t\u00e9", "", "a  b\n\nc\0", "last.", "left out"]
    for kind in (pa.string(), pa.large_string()):
        column = pa.array(texts, kind)
        for start, count in ((0, 7), (1, 5), (3, 1), (1, 1), (2, 0)):
            got = encoder.encode(column.slice(start, count))
            ids = [np.frombuffer(x, encoder.dtype).tolist() for x in got]
            assert ids == [plain(text) for text in texts[start : start + count]]


@settings(max_examples=200, deadline=None)
@given(text=st.text(max_size=40))
def test_any_text(text):
    encoder = _ENCODER.setdefault("e", Encoder())
    whole = encoder.tokenizer.encode(text, add_special_tokens=False).ids
    assert np.frombuffer(encoder.encode([text])[0], encoder.dtype).tolist() == whole


_ENCODER: dict = {}


def test_other_tokenizers_encode_whole_texts():
    encoder = Encoder(public_tokenizers.path("word_bpe_49k.json"))
    assert not encoder.by_piece
    text = "Hello there,\n\nyou  two"
    whole = encoder.tokenizer.encode(text, add_special_tokens=False).ids
    assert np.frombuffer(encoder.encode([text])[0], encoder.dtype).tolist() == whole


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


@pytest.mark.parametrize("encoding", ["dictionary", "delta"])
def test_token_files_round_trip(spark, plain, odd_documents, encoding):
    path = scratch_path(spark, "tokens")
    token_files.write_tokens(odd_documents, path, encoding=encoding)
    rows = token_files.read_tokens(spark, path).collect()
    given_rows = odd_documents.select("doc_id", "text").collect()
    assert len(rows) == len(given_rows)
    by_start = sorted(rows, key=lambda r: r.start)
    start, last = 0, None
    for row in by_start:
        assert row.start == start and row.n_tokens == len(row.ids)
        assert last is None or row.doc_id is not None and row.doc_id >= last
        start, last = start + row.n_tokens, row.doc_id
    expected = sorted((r.doc_id is not None, r.doc_id or 0, crc([*plain(r.text), 0])) for r in given_rows)
    digests = token_files.token_digests(token_files.read_tokens(spark, path)).collect()
    assert sorted((r.doc_id is not None, r.doc_id or 0, r.ids_crc32) for r in digests) == expected


def test_token_files_are_read_selectively(spark, odd_documents, capsys):
    path = scratch_path(spark, "tokens")
    token_files.write_tokens(odd_documents, path)
    some = token_files.read_tokens(spark, path, ("doc_id", "n_tokens")).where("doc_id = 4")
    assert some.count() == 4
    some.explain("simple")
    text = capsys.readouterr().out
    assert "ids" not in text.split("ReadSchema")[1] and "EqualTo(doc_id,4)" in text
    with pytest.raises(ValueError, match="unknown encoding"):
        token_files.write_tokens(odd_documents, path, encoding="none")


def check_pieces(rows, docs, plain, capacity, end_id=1):
    """Every id of every document in one piece, sequences gapless and within capacity."""
    by_text = {}
    for row in rows:
        ids = np.frombuffer(row.ids, "<u4").tolist()
        assert len(ids) == row.length > 0
        by_text.setdefault((row.sequence_id), []).append((row.offset, row.length))
    for parts in by_text.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    wanted = sorted(tuple([*plain(d.text), end_id]) for d in docs)
    starts = sorted(row.start for row in rows if row.start == 0)
    assert len(starts) == len(docs)
    total = sum(row.length for row in rows)
    assert total == sum(map(len, wanted))
    assert len(by_text) == -(-total // capacity)
    return wanted


@pytest.mark.parametrize("capacity", [2, 7, 64, 2048])
def test_packing_holds_every_id_once(odd_documents, plain, capacity):
    rows = packing.pack(odd_documents, capacity=capacity).collect()
    docs = odd_documents.select("doc_id", "text").collect()
    check_pieces(rows, docs, plain, capacity)
    lone = {d.doc_id: [*plain(d.text), 1] for d in docs if d.doc_id is not None}
    counts = {i: sum(d.doc_id == i for d in docs) for i in lone}
    for doc_id, ids in lone.items():
        own = sorted((r.start, r.length, r.ids) for r in rows if r.doc_id == doc_id)
        assert {r.doc_tokens for r in rows if r.doc_id == doc_id} == {len(ids)}
        assert sum(n for _, n, _ in own) == len(ids) * counts[doc_id]
        for start, length, blob in own:
            assert np.frombuffer(blob, "<u4").tolist() == ids[start : start + length]


@settings(max_examples=150, deadline=None)
@given(
    capacity=st.integers(2, 40),
    lengths=st.lists(st.tuples(st.integers(1, 39), st.integers(1, 60)), max_size=12),
)
def test_histogram_packing(capacity, lengths):
    counts = {}
    for length, n in lengths:
        if length < capacity:
            counts[length] = counts.get(length, 0) + n
    packs, ranges = packing.pack_histogram(counts, capacity)
    total = sum(k * n for k, n in counts.items())
    assert packs == -(-total // capacity)
    fill = {p: [] for p in range(packs)}
    ranks = {k: [] for k in counts}
    for length, first, n, slots in ranges:
        ranks[length] += range(first, first + n)
        assert slots[0][0] == 0 and sum(s[1] for s in slots) == length
        assert all(a[0] + a[1] == b[0] for a, b in zip(slots, slots[1:], strict=False))
        for k in range(n):
            for _, size, pack, offset in slots:
                fill[pack + k].append((offset, size))
    assert {k: sorted(v) for k, v in ranks.items()} == {k: list(range(n)) for k, n in counts.items()}
    for parts in fill.values():
        at = 0
        for offset, size in sorted(parts):
            assert offset == at
            at += size
        assert 0 < at <= capacity


def test_sequences_are_padded_but_at_a_power_of_two(make):
    docs = make([(i, "word " * (3 + i), None, None, None) for i in range(9)])
    pieces = packing.pack(docs, capacity=32)
    rows = packing.sequences(pieces, capacity=32, pad_id=9).collect()
    assert sum(r.used for r in rows) == sum(p.length for p in pieces.collect())
    for r in rows:
        ids = np.frombuffer(r.ids, "<u4")
        power = r.used & (r.used - 1) == 0
        assert len(ids) == (r.used if power else 32) == r.used + r.padding
        assert (ids[r.used :] == 9).all()


def test_empty_tables(spark, no_documents):
    assert packing.pack(no_documents).count() == 0
    path = scratch_path(spark, "tokens")
    token_files.write_tokens(no_documents, path)
    assert token_files.token_digests(token_files.read_tokens(spark, path)).count() == 0
