"""Tokens of two tokenizers aligned by their bytes, and how often two ids meet.

A batch of texts is encoded by both tokenizers and aligned in Arrow: token lists are
flattened with their parent indices, token lengths summed up inside each document, and the
ends of both sides joined (Acero hash joins) on a key of document and end. Ends that both
sides have close a group. All ends together cut a document into stretches that lie in one
token of each side, so every stretch is one link, and its tokens are the next ones that
end. Table.group_by counts the id pairs of a batch; Spark adds these partial counts up,
finds the best count of every B id, and brings each batch the counts of its own pairs.

A batch is bounded by its characters (one longer text makes up a batch of its own) and is
one stored row, so nothing is shuffled but one row per batch and pair. A pair that occurs
everywhere has at most one row per batch.

Defined results: a text that is null or empty, or of which one tokenizer does not give
back the bytes, has no tokens: zeros and an empty digest. Repeated rows and null or repeated
ids each keep their row; an empty table gives an empty one; other columns are not read;
texts are encoded whole; special tokens' strings in a text are ordinary text.
"""

from __future__ import annotations

import hashlib
import json
import re
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm.common import ship_package, stored
from tallyhouse.llm.tokens import BYTE_LETTERS, Encoder, PieceCache, default_tokenizer, packed

#: Characters and texts that are aligned at once.
BATCH_CHARS, BATCH_ROWS = 600_000, 4_000
#: Pieces that one worker holds of each side.
MAX_PIECES_A, MAX_PIECES_B = 700_000, 400_000
SPACE_PIECE = "▁"
CUT = re.compile("\n[^ \n]*| +[^ \n]*")


def default_piece_model() -> str:
    """Place of the piece model on this machine; executors ask for themselves."""
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


class PieceEncoder:
    """Encodes texts by a piece model, which puts a space before each text.

    Where no piece of the vocabulary has a space sign after another character, and none a
    line feed, no token reaches over the start of a run of spaces or over a line feed: the
    text is cut there, and each distinct part is encoded once while a bounded cache has it.
    """

    def __init__(self, path: str | None = None, max_cache: int = MAX_PIECES_B):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path or default_piece_model())
        count = self.model.get_piece_size()
        self.pieces = [self.model.id_to_piece(i) for i in range(count)]
        self.dtype = np.dtype("<u2" if count <= 1 << 16 else "<u4")
        self.cache = PieceCache(max_cache)
        self.space = self.pieces.index(SPACE_PIECE) if SPACE_PIECE in self.pieces else None
        self.by_piece = self._cuts_at_spaces()

    def _cuts_at_spaces(self) -> bool:
        inner = any(SPACE_PIECE in p.lstrip(SPACE_PIECE) or "\n" in p for p in self.pieces)
        if inner or self.space is None:
            return False
        # Neither white space nor letters may be rewritten, and the space comes first.
        probe = " a  b\n\nc d  "
        ids = self.model.encode(probe)
        told = b"".join(self.bytes_of(i) for i in ids)
        return told == b" " + probe.encode() and self.model.encode("\n")[:1] == [self.space]

    def bytes_of(self, token: int) -> bytes:
        piece = self.pieces[token]
        if self.model.is_byte(token):
            return bytes([int(piece[3:5], 16)])
        return piece.replace(SPACE_PIECE, " ").encode()

    def _ids(self, found: list[int]) -> bytes:
        return packed(found, self.dtype)

    def _learn(self, parts: list[str]) -> None:
        """A part starts with a space, which the model adds, or with a line feed."""
        found = self.model.encode([p[1:] if p[0] == " " else p for p in parts], num_threads=1)
        for part, ids in zip(parts, found, strict=True):
            if part == " ":
                ids = [self.space]
            elif part[0] == "\n":
                ids = ids[1:]
            self.cache[part] = self._ids(ids)

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text, not empty, as bytes."""
        if not self.by_piece:
            return [self._ids(self.model.encode(t)) for t in texts]
        self.cache.turn()
        # A space sign in the text itself may grow together with the spaces beside it.
        split = [None if SPACE_PIECE in t else CUT.findall(" " + t) for t in texts]
        self._learn(list(self.cache.missing(set().union(*filter(None, split)))))
        get = self.cache.__getitem__
        return [
            self._ids(self.model.encode(t)) if parts is None else b"".join(map(get, parts))
            for t, parts in zip(texts, split, strict=True)
        ]


class Sides:
    """Both tokenizers with the bytes, lengths and printed ids of their tokens."""

    def __init__(self, path_a: str | None, path_b: str | None):
        self.a, self.b = Encoder(path_a, MAX_PIECES_A), PieceEncoder(path_b)
        with open(path_a or default_tokenizer(), encoding="utf-8") as file:
            vocabulary = json.load(file)
        letters = {c: b for b, c in BYTE_LETTERS.items()}
        added = {t["id"]: t["content"].encode() for t in vocabulary.get("added_tokens", [])}
        spelled = {i: w for w, i in vocabulary["model"]["vocab"].items()}
        size = max([*spelled, *added]) + 1
        of_a = [
            added[i] if i in added else bytes(letters[c] for c in spelled.get(i, "")) for i in range(size)
        ]
        of_b = [self.b.bytes_of(i) for i in range(len(self.b.pieces))]
        self.bytes = tuple(pa.array(x, pa.binary()) for x in (of_a, of_b))
        self.sizes = tuple(pa.array([len(t) for t in x], pa.int64()) for x in (of_a, of_b))
        self.printed = tuple(pa.array([str(i) for i in range(len(x))]) for x in (of_a, of_b))
        self.width = len(of_b)


_sides: dict[tuple, Sides] = {}


def sides(path_a: str | None = None, path_b: str | None = None) -> Sides:
    """This process's tokenizers; their caches live as long as the Python worker."""
    if (path_a, path_b) not in _sides:
        _sides[path_a, path_b] = Sides(path_a, path_b)
    return _sides[path_a, path_b]


def _lists(ids: list[np.ndarray]) -> pa.ListArray:
    offsets = np.concatenate([[0], np.cumsum([len(x) for x in ids])]).astype(np.int32)
    flat = np.concatenate([*ids, np.empty(0, np.int32)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))


def _joined(offsets: pa.Array, values: pa.Array, between: str | bytes) -> pa.Array:
    """The values of each list in one, without a bound of 2 GB."""
    lists = pa.LargeListArray.from_arrays(offsets.cast(pa.int64()), values)
    return pc.binary_join(lists, pa.scalar(between, values.type))


def encode_both(texts: list[str | None], at: Sides) -> tuple[pa.ListArray, pa.ListArray]:
    """Token lists of both sides; empty where a side does not give back the bytes."""
    full = [k for k, t in enumerate(texts) if t]
    found = (
        at.a.encode([" " + texts[k] for k in full]),
        at.b.encode([texts[k] for k in full]),
    )
    types = (at.a.dtype, at.b.dtype)
    source = pa.array([b" " + texts[k].encode() for k in full], pa.large_binary())
    good = np.ones(len(full), bool)
    tokens = []
    for side in (0, 1):
        ids = [np.frombuffer(x, types[side]).astype(np.int32) for x in found[side]]
        lists = _lists(ids)
        taken = at.bytes[side].cast(pa.large_binary()).take(lists.values)
        spelled = _joined(lists.offsets, taken, b"")
        good &= pc.equal(spelled, source).to_numpy(zero_copy_only=False)
        tokens.append(ids)
    none = np.empty(0, np.int32)
    out = []
    for ids in tokens:
        rows = [none] * len(texts)
        for k, x, fits in zip(full, ids, good, strict=True):
            if fits:
                rows[k] = x
        out.append(_lists(rows))
    return out[0], out[1]


def _ends(tokens: pa.ListArray, sizes: pa.Array) -> tuple[pa.Array, pa.Array, pa.Array]:
    """Flattened ids, their documents, and where in its document each token ends."""
    flat = pc.list_flatten(tokens)
    parent = pc.list_parent_indices(tokens)
    run = pc.cumulative_sum(sizes.take(flat))
    # The sum before a document's first token, taken off all its tokens.
    total = np.concatenate([[0], run.to_numpy(zero_copy_only=False)])
    before = pa.array(total[tokens.offsets.to_numpy()[:-1]], pa.int64())
    return flat, parent, pc.subtract(run, before.take(parent))


def align(a: pa.ListArray, b: pa.ListArray, at: Sides) -> tuple[pa.Table, pa.Table]:
    """Links (doc, a, b) and the ends that both sides have (doc, ia, ib: token indices)."""
    flat_a, doc_a, end_a = _ends(a, at.sizes[0])
    flat_b, doc_b, end_b = _ends(b, at.sizes[1])
    span = pa.scalar((pc.max(end_a).as_py() or 0) + 1, pa.int64())

    def side(flat, doc, end, letter) -> pa.Table:
        key = pc.add(pc.multiply(doc.cast(pa.int64()), span), end)
        index = pa.array(np.arange(len(flat), dtype=np.int64))
        return pa.table({"key": key, letter: flat, f"i{letter}": index})

    ends = side(flat_a, doc_a, end_a, "a").join(
        side(flat_b, doc_b, end_b, "b"), "key", join_type="full outer", use_threads=False
    )
    ends = ends.take(pc.sort_indices(ends["key"])).combine_chunks()
    doc = pc.divide(ends["key"], span).cast(pa.int32())
    # Both sides end with the document, so a gap is filled from the same document.
    filled = [pc.fill_null_backward(ends[c]) for c in ("a", "b")]
    links = pa.table({"doc": doc, "a": filled[0], "b": filled[1]})
    common = pc.and_(pc.is_valid(ends["a"]), pc.is_valid(ends["b"]))
    both = pa.table({"doc": doc, "ia": ends["ia"], "ib": ends["ib"]}).filter(common)
    return links, both.combine_chunks()


def _starts(rows: int, doc: np.ndarray) -> np.ndarray:
    """Where each document's rows begin in a column of ascending documents, and the end."""
    return np.searchsorted(doc, np.arange(rows + 1))


def printed_groups(a: pa.ListArray, b: pa.ListArray, both: pa.Table, at: Sides) -> pa.Array:
    """Per document its groups as a1,a2|b1;a3|b2,b3; empty without tokens."""
    parts = []
    for side, tokens, column in ((0, a, "ia"), (1, b, "ib")):
        last = both[column].to_numpy().astype(np.int64)
        texts = at.printed[side].cast(pa.large_string()).take(pc.list_flatten(tokens))
        parts.append(_joined(pa.array(np.concatenate([[0], last + 1])), texts, ","))
    groups = pc.binary_join_element_wise(*parts, pa.scalar("|", pa.large_string()))
    return _joined(pa.array(_starts(len(a), both["doc"].to_numpy())), groups, ";")


def _batches(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Array, list[str | None]]]:
    """Ids and texts, a bounded number of characters at a time."""
    ids, texts, held = [], [], 0
    for batch in batches:
        kind = batch.schema.field(0).type
        for doc_id, text in zip(batch.column(0), batch.column(1), strict=True):
            text = text.as_py()
            if texts and held + len(text or "") > BATCH_CHARS:
                yield pa.array(ids, kind), texts
                ids, texts, held = [], [], 0
            ids.append(doc_id.as_py())
            texts.append(text)
            held += len(text or "")
            if len(texts) >= BATCH_ROWS:
                yield pa.array(ids, kind), texts
                ids, texts, held = [], [], 0
    if texts:
        yield pa.array(ids, kind), texts


def _one_list(values: pa.Array) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)


def _align_batches(path_a: str | None, path_b: str | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = sides(path_a, path_b)
        for ids, texts in _batches(batches):
            a, b = encode_both(texts, at)
            links, both = align(a, b, at)
            code = pc.add(
                pc.multiply(links["a"].cast(pa.int64()), pa.scalar(at.width, pa.int64())),
                links["b"].cast(pa.int64()),
            )
            per_doc = (
                pa.table({"doc": links["doc"], "pair": code})
                .group_by(["doc", "pair"], use_threads=False)
                .aggregate([([], "count_all")])
            )
            partial = per_doc.group_by(["pair"], use_threads=False).aggregate([("count_all", "sum")])
            partial = partial.take(pc.sort_indices(partial["pair"])).combine_chunks()
            per_doc = per_doc.take(pc.sort_indices(per_doc["doc"])).combine_chunks()
            place = pc.index_in(per_doc["pair"], partial["pair"])
            starts = _starts(len(texts), per_doc["doc"].to_numpy())
            numbers = {
                "n_a": pc.list_value_length(a),
                "n_b": pc.list_value_length(b),
                "n_groups": pa.array(np.diff(_starts(len(texts), both["doc"].to_numpy()))),
                "n_links": pa.array(np.diff(_starts(len(texts), links["doc"].to_numpy()))),
            }
            digests = [
                hashlib.sha256(g.as_buffer()).hexdigest() if g.as_buffer().size else ""
                for g in printed_groups(a, b, both, at)
            ]
            columns = {
                "batch": pa.array([uuid.uuid4().hex]),
                "doc_id": _one_list(ids),
                **{k: _one_list(v.cast(pa.int64())) for k, v in numbers.items()},
                "groups_sha256": _one_list(pa.array(digests, pa.string())),
                "pair": _one_list(partial["pair"].combine_chunks()),
                "n": _one_list(partial["count_all_sum"].combine_chunks()),
                "starts": _one_list(pa.array(starts.astype(np.int32))),
                "place": _one_list(pc.cast(place, pa.int32()).combine_chunks()),
                "times": _one_list(per_doc["count_all"].combine_chunks().cast(pa.int32())),
            }
            yield pa.RecordBatch.from_pydict(columns)
            # What the joins used goes back before the next batch.
            pa.default_memory_pool().release_unused()

    return run


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per document the sums over its links, from the counts of its batch's pairs."""
    kept = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256")
    for batch in batches:
        for k in range(batch.num_rows):

            def column(name, k=k, batch=batch):
                return batch.column(name)[k].values

            starts = column("starts").to_numpy()
            counts, best = np.zeros(0, np.int64), np.zeros(0, bool)
            found = column("counts")
            if found is not None and len(found):
                order = np.argsort(pc.struct_field(found, "place").to_numpy())
                counts = pc.struct_field(found, "count").to_numpy()[order]
                best = pc.struct_field(found, "best").to_numpy(zero_copy_only=False)[order]
            place, times = column("place").to_numpy(), column("times").to_numpy().astype(np.int64)

            def add(values, starts=starts):
                run = np.concatenate([[0], np.cumsum(values)])
                return pa.array(run[starts[1:]] - run[starts[:-1]], pa.int64())

            sums = [add(times * best[place]), add(times * counts[place])]
            yield pa.RecordBatch.from_arrays(
                [*map(column, kept), *sums], names=[*kept, "n_best", "count_sum"]
            )


def aligned_batches(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    tokenizer: str | None = None,
    piece_model: str | None = None,
) -> DataFrame:
    """One stored row per batch: its documents' numbers, its pairs and their partial counts."""
    ship_package(docs.sparkSession)
    kind = docs.select(F.col(id_col)).schema[0].dataType.simpleString()
    lists = "array<bigint>"
    schema = (
        f"batch string, doc_id array<{kind}>, n_a {lists}, n_b {lists}, n_groups {lists}, n_links {lists}, "
        f"groups_sha256 array<string>, pair {lists}, n {lists}, starts array<int>, place array<int>, times array<int>"
    )
    named = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return stored(named.mapInArrow(_align_batches(tokenizer, piece_model), schema), "aligned")


def pair_counts(batches: DataFrame, width: int) -> DataFrame:
    """Partial counts merged, stored: pair, a, b, count, best (its B id has no higher one)."""
    partial = batches.select(F.arrays_zip("pair", "n").alias("p")).select(F.inline("p"))
    merged = stored(partial.groupBy("pair").agg(F.sum("n").alias("count")), "pairs").select(
        "pair", F.floor(F.col("pair") / width).alias("a"), (F.col("pair") % width).alias("b"), "count"
    )
    # At most one row per A id for each B id: vocabularies bound both.
    top = merged.groupBy("b").agg(F.max("count").alias("top"))
    return stored(merged.join(top, "b").withColumn("best", F.col("count") == F.col("top")).drop("top"), "counts")


def align_documents(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    tokenizer: str | None = None,
    piece_model: str | None = None,
) -> DataFrame:
    """Per row: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256."""
    paths = {"tokenizer": tokenizer, "piece_model": piece_model}
    batches = aligned_batches(docs, id_col=id_col, text_col=text_col, **paths)
    counts = pair_counts(batches, len(PieceEncoder(piece_model).pieces)).select("pair", "count", "best")
    asked = batches.select("batch", F.posexplode("pair").alias("place", "pair"))
    # Per batch at most its own pairs, which its characters bound.
    told = (
        asked.join(counts, "pair")
        .groupBy("batch")
        .agg(F.collect_list(F.struct("place", "count", "best")).alias("counts"))
    )
    kind = batches.schema["doc_id"].dataType.elementType.simpleString()
    rest = ", ".join(f"{c} bigint" for c in ("n_best", "count_sum"))
    numbers = ", ".join(f"{c} bigint" for c in ("n_a", "n_b", "n_groups", "n_links"))
    return (
        batches.drop("pair", "n")
        .join(told, "batch", "left")
        .mapInArrow(_sums, f"doc_id {kind}, {numbers}, groups_sha256 string, {rest}")
    )


def alignments(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    tokenizer: str | None = None,
    piece_model: str | None = None,
) -> DataFrame:
    """Per row the alignment itself: doc_id, a_ids, b_ids, groups as a1,a2|b1;a3|b2,b3."""
    ship_package(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = sides(tokenizer, piece_model)
        for ids, texts in _batches(batches):
            a, b = encode_both(texts, at)
            groups = printed_groups(a, b, align(a, b, at)[1], at).cast(pa.string())
            yield pa.RecordBatch.from_arrays([ids, a, b, groups], names=["doc_id", "a_ids", "b_ids", "groups"])

    kind = docs.select(F.col(id_col)).schema[0].dataType.simpleString()
    named = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return named.mapInArrow(run, f"doc_id {kind}, a_ids array<int>, b_ids array<int>, groups string")
