"""Sequence packing by the length histogram, shortest pack first.

Documents are encoded once and stored. What a document has beyond whole sequences is its
rest; the histogram of rests (at most `capacity` numbers, whatever the input) is packed on
the driver: lengths are placed longest first, each into the pack that holds least, and
packs of the same make-up are counted together, not listed. No more packs are opened than
the tokens fill; when none is left that a length fits, the length is cut to fill the
emptiest one and its remainder takes its place among the shorter lengths. So all packs but
the slack of a single one are full.

The resulting patterns name ranges of ranks within a length. Documents are ranked by a
distributed numbering and join the patterns by length and rank.

Defined results: a null text is empty and has only its end id; a null doc_id is kept;
repeated rows are packed each on their own; an empty table gives no pieces; other columns
are not read; texts of any length are cut into as many whole sequences as they fill.
"""

from __future__ import annotations

import heapq
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse.llm.common import FILE, ROW, numbered, stored, with_row_key
from tallyhouse.llm.token_files import slices
from tallyhouse.llm.tokens import encoder

CAPACITY = 2048
PIECE = "struct<start:long,length:long,sequence_id:long,offset:long>"
PIECES = (
    "doc_id long, start long, length long, doc_tokens long, sequence_id long, offset long, "
    "ids binary"
)

#: (start in the rest, length, first pack, offset) of one piece of each item in a range.
Slot = tuple[int, int, int, int]


def pack_histogram(
    counts: dict[int, int], capacity: int
) -> tuple[int, list[tuple[int, int, int, list[Slot]]]]:
    """Pack counts[length] items of each length from 1 to capacity - 1.

    Returns the number of packs and, for ranges of ranks that share their make-up,
    (length, first rank, items, slots): the item of rank first + k has its pieces in the
    packs of the slots plus k.
    """
    tokens = sum(length * n for length, n in counts.items())
    packs = -(-tokens // capacity)
    opened = 0
    held: dict[int, list[tuple[int, int]]] = defaultdict(list)  # by fill: (first pack, packs)
    fills: list[int] = []
    placed: dict[int, list[tuple[int, int, int, int, int]]] = defaultdict(list)
    todo: dict[int, list[tuple[int, int]]] = {n: [(0, c)] for n, c in counts.items() if c}
    ranks = dict(counts)

    def put(fill: int, group: tuple[int, int]) -> None:
        if fill < capacity:
            if not held[fill]:
                heapq.heappush(fills, fill)
            held[fill].append(group)

    for length in range(capacity - 1, 0, -1):
        for first, n in todo.get(length, []):
            while n:
                while fills and not held[fills[0]]:
                    heapq.heappop(fills)
                fill = fills[0] if fills else capacity
                if fill + length > capacity and opened < packs:
                    fill, pack, some = 0, opened, min(n, packs - opened)
                    opened += some
                else:
                    pack, there = held[fill].pop()
                    some = min(n, there)
                    if some < there:
                        held[fill].append((pack + some, there - some))
                size = min(length, capacity - fill)
                rest = 0
                if size < length:  # cut: the remainder queues up among its own length
                    rest = ranks.get(length - size, 0)
                    ranks[length - size] = rest + some
                    todo.setdefault(length - size, []).append((rest, some))
                placed[length].append((first, some, size, pack, fill))
                if size < length:
                    placed[length][-1] += (rest,)  # type: ignore[assignment]
                put(fill + size, (pack, some))
                first, n = first + some, n - some

    def resolve(length: int, first: int, n: int, start: int) -> Iterator[tuple[int, int, list[Slot]]]:
        """(first, items, slots) for a range of ranks; cut items split it further."""
        rows = placed[length]
        low, high = 0, len(rows)
        while low < high:  # the placement that holds the first rank
            middle = (low + high) // 2
            if rows[middle][0] + rows[middle][1] <= first:
                low = middle + 1
            else:
                high = middle
        at = first
        for row in rows[low:]:
            if at >= first + n:
                break
            begin, some, size, pack, fill, *rest = row
            skip = at - begin
            take = min(some - skip, first + n - at)
            own = (start, size, pack + skip, fill)
            if not rest:
                yield at, take, [own]
            else:
                below = resolve(length - size, rest[0] + skip, take, start + size)
                for f, k, slots in below:
                    moved = f - rest[0] - skip
                    yield (
                        at + moved,
                        k,
                        [(own[0], own[1], own[2] + moved, own[3]), *slots],
                    )
            at += take

    ranges = [
        (length, first, n, slots)
        for length, count in sorted(counts.items())
        if count
        for first, n, slots in resolve(length, 0, count, 0)
    ]
    return packs, ranges


def _encode(tokenizer: str | None, end_id: int):
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(tokenizer)
        end = np.array([end_id], coder.dtype).tobytes()
        width = coder.dtype.itemsize
        for batch in batches:
            rest = [batch.column(c) for c in ("doc_id", FILE, ROW)]
            for run in slices(texts := batch.column("text")):
                ids = [x + end for x in coder.encode(texts[run])]
                yield pa.RecordBatch.from_arrays(
                    [
                        *[c.slice(run.start, run.stop - run.start) for c in rest],
                        pa.array([len(x) // width for x in ids], pa.int64()),
                        pa.array(ids, pa.binary()),
                    ],
                    names=["doc_id", FILE, ROW, "doc_tokens", "ids"],
                )

    return encode


def encode_documents(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    tokenizer: str | None = None,
    end_id: int = 1,
) -> DataFrame:
    """Each document's ids, stored as packed bytes beside its row key and length."""
    named = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    schema = f"doc_id long, {FILE} long, {ROW} long, doc_tokens long, ids binary"
    return stored(with_row_key(named).mapInArrow(_encode(tokenizer, end_id), schema), "tokens")


def _plan(spark: SparkSession, counts: dict[int, int], capacity: int) -> tuple[int, DataFrame]:
    """The patterns as a table: length, ranks from index to index + items, slots.

    Its size follows the capacity, not the input.
    """
    packs, ranges = pack_histogram(counts, capacity)
    before, total = {}, 0
    for length in sorted(counts):
        before[length] = total
        total += counts[length]
    rows = [(n, before[n] + first, before[n] + first + items, slots) for n, first, items, slots in ranges]
    schema = f"rest int, low long, high long, slots array<{PIECE}>"
    return packs, spark.createDataFrame(rows, schema)


def plan_pieces(tokens: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Per stored document the list of its pieces: start, length, sequence_id, offset."""
    if capacity < 2:
        raise ValueError("a sequence holds at least two tokens")
    spark = tokens.sparkSession
    sized = tokens.select(
        "doc_id",
        FILE,
        ROW,
        (F.col("doc_tokens") % capacity).cast("int").alias("rest"),
        F.floor(F.col("doc_tokens") / capacity).cast("long").alias("whole"),
    )
    ranked, _ = numbered(sized, ["rest", "doc_id", FILE, ROW], "ranks", sums=("whole",))
    found = {r["rest"]: r["count"] for r in sized.groupBy("rest").count().collect()}
    counts = {length: n for length, n in found.items() if length}
    packs, plan = _plan(spark, counts, capacity)
    none = found.get(0, 0)  # documents without a rest are numbered first
    position = F.col("index") - none
    rests = ranked.withColumn("rank", position).join(
        plan.withColumnRenamed("rest", "length"),
        (F.col("rest") == F.col("length")) & (F.col("rank") >= F.col("low")) & (F.col("rank") < F.col("high")),
        "left",
    )
    whole = F.when(
        F.col("whole") > 0,
        F.transform(
            F.sequence(F.lit(0).cast("long"), F.col("whole") - 1),
            lambda k: F.struct(
                (k * capacity).alias("start"),
                F.lit(capacity).cast("long").alias("length"),
                (packs + F.col("whole_before") + k).alias("sequence_id"),
                F.lit(0).cast("long").alias("offset"),
            ),
        ),
    )
    rest = F.transform(
        "slots",
        lambda s: F.struct(
            (F.col("whole") * capacity + s["start"]).alias("start"),
            s["length"].alias("length"),
            (s["sequence_id"] + F.col("rank") - F.col("low")).alias("sequence_id"),
            s["offset"].alias("offset"),
        ),
    )
    none = F.array().cast(f"array<{PIECE}>")
    return rests.select(
        FILE,
        ROW,
        F.concat(
            F.coalesce(whole.cast(f"array<{PIECE}>"), none), F.coalesce(rest.cast(f"array<{PIECE}>"), none)
        ).alias("pieces"),
    )


def _cut(width: int):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        dtype = np.dtype(f"<u{width}")
        for batch in batches:
            pieces = batch.column("pieces")
            parts = {c: pieces.values.field(c).to_numpy().tolist() for c in ("start", "length")}
            bounds = pieces.offsets.to_numpy().tolist()
            ids = []
            for blob, low, high in zip(batch.column("ids"), bounds, bounds[1:], strict=False):
                doc = np.frombuffer(blob.as_buffer(), dtype).astype("<u4")
                for k in range(low, high):
                    start = parts["start"][k]
                    ids.append(doc[start : start + parts["length"][k]].tobytes())
            owner = np.repeat(np.arange(batch.num_rows), np.diff(bounds))
            flat = pieces.flatten()
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").take(pa.array(owner)),
                    flat.field("start"),
                    flat.field("length"),
                    batch.column("doc_tokens").take(pa.array(owner)),
                    flat.field("sequence_id"),
                    flat.field("offset"),
                    pa.array(ids, pa.binary()),
                ],
                names=["doc_id", "start", "length", "doc_tokens", "sequence_id", "offset", "ids"],
            )

    return cut


def pack(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    capacity: int = CAPACITY,
    tokenizer: str | None = None,
    end_id: int = 1,
) -> DataFrame:
    """Pack all documents; one row per piece with its ids as little-endian 32-bit numbers."""
    tokens = encode_documents(docs, id_col=id_col, text_col=text_col, tokenizer=tokenizer, end_id=end_id)
    pieces = plan_pieces(tokens, capacity)
    # Both sides have one row per document; the narrow one is hashed, the ids are not sorted.
    cut = tokens.join(pieces.hint("shuffle_hash"), [FILE, ROW])
    width = encoder(tokenizer).dtype.itemsize
    return cut.select("doc_id", "doc_tokens", "ids", "pieces").mapInArrow(_cut(width), PIECES)


def sequences(pieces: DataFrame, capacity: int = CAPACITY, pad_id: int = 0) -> DataFrame:
    """Whole sequences from pieces: ids in order, padded to the capacity.

    A sequence whose length is a power of two stays as it is. A group has at most
    `capacity` tokens.
    """
    joined = pieces.groupBy("sequence_id").agg(
        F.sort_array(F.collect_list(F.struct("offset", "doc_id", "length", "ids"))).alias("parts")
    )
    used = F.aggregate("parts", F.lit(0).cast("long"), lambda n, p: n + p["length"])
    ids = F.aggregate("parts", F.lit(b""), lambda b, p: F.concat(b, p["ids"]))
    padding = F.when(F.col("used").bitwiseAND(F.col("used") - 1) == 0, 0).otherwise(capacity - F.col("used"))
    pad = F.lit(int(pad_id).to_bytes(4, "little"))
    filled = joined.select(
        "sequence_id", used.alias("used"), ids.alias("ids"), F.col("parts.doc_id").alias("doc_ids")
    )
    return filled.withColumn("padding", padding.cast("long")).withColumn(
        "ids",
        F.aggregate(F.array_repeat(pad, F.col("padding").cast("int")), F.col("ids"), lambda b, p: F.concat(b, p)),
    )
