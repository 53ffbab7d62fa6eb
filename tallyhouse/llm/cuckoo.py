"""Exact duplicates through a sharded index of live digests behind cuckoo filters.

Every text's digest goes to the shard that its first bytes name. A shard holds a cuckoo
filter over its live digests, and the digests themselves with what is known of their rows,
in buckets. A digest that the filter does not know is new. One that it knows is compared
with the bucket's content (whole digest and length), as a filter may err; a true hit joins
the group that is there, where a row with a larger id replaces the one that stands for it.
A digest can be taken out again, from the filter and from its bucket. When an insertion
finds no place, the filter is built anew, twice the size, from the stored keys.

Equal texts of one task are put together before they travel, so a text that makes up a
third of all rows arrives at its shard a few times per task, not once per row.

Defined results: a null text counts as empty, and all empty texts are equal; equal means
identical after lower-casing A to Z; a null id is smaller than any other; of rows with the
same text and id one stays; an empty table gives an empty one; other columns are not read;
texts are read whole, whatever their length.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm.common import FILE, ROW, empty_like, partitions, stored, with_row_key

SLOTS = 4
MAX_KICKS = 200
#: Digests of one task that are put together before they are sent on.
HELD = 100_000
#: Live digests a shard is meant to hold.
SHARD_KEYS = 50_000

INDEX = f"digest binary, length long, keep_id long, keep_{FILE} long, keep_{ROW} long, rows long"
EVENT = f"{INDEX}, step int"
#: Steps of an event: stored earlier, insert, delete. In a shard they run in this order.
LOAD, INSERT, DELETE = 0, 1, 2


class CuckooFilter:
    """Approximate set of digests that also forgets: 16-bit prints in buckets of four."""

    def __init__(self, buckets: int = 64):
        self.size = 1 << max(1, (buckets - 1).bit_length())
        self.prints = [0] * (self.size * SLOTS)
        self.count = 0
        self.turn = 0

    def _places(self, digest: bytes) -> tuple[int, int, int]:
        mark = int.from_bytes(digest[8:10], "little") or 1
        first = int.from_bytes(digest[10:18], "little") & (self.size - 1)
        return mark, first, self._other(first, mark)

    def _other(self, place: int, mark: int) -> int:
        return place ^ ((mark * 0x5BD1E995) & (self.size - 1))

    def _put(self, place: int, mark: int) -> bool:
        for slot in range(place * SLOTS, place * SLOTS + SLOTS):
            if not self.prints[slot]:
                self.prints[slot] = mark
                return True
        return False

    def __contains__(self, digest: bytes) -> bool:
        mark, first, second = self._places(digest)
        held = self.prints
        return (
            mark in held[first * SLOTS : first * SLOTS + SLOTS]
            or mark in held[second * SLOTS : second * SLOTS + SLOTS]
        )

    def insert(self, digest: bytes) -> bool:
        """False if there is no place; the filter then has lost a print and must be rebuilt."""
        mark, place, second = self._places(digest)
        if self._put(place, mark) or self._put(second, mark):
            self.count += 1
            return True
        for _ in range(MAX_KICKS):
            self.turn = (self.turn + 1) % SLOTS
            slot = place * SLOTS + self.turn
            mark, self.prints[slot] = self.prints[slot], mark
            place = self._other(place, mark)
            if self._put(place, mark):
                self.count += 1
                return True
        return False

    def delete(self, digest: bytes) -> bool:
        """Forget one print of a digest that is known to be in."""
        mark, first, second = self._places(digest)
        for place in (first, second):
            for slot in range(place * SLOTS, place * SLOTS + SLOTS):
                if self.prints[slot] == mark:
                    self.prints[slot] = 0
                    self.count -= 1
                    return True
        return False


class Shard:
    """Live digests of one shard: the filter and, by bucket, what it stands for."""

    def __init__(self, buckets: int = 64):
        self.filter = CuckooFilter(buckets)
        self.content: list[dict[bytes, list]] = [{} for _ in range(self.filter.size)]
        self.rebuilds = 0

    def _bucket(self, digest: bytes) -> dict[bytes, list]:
        return self.content[self.filter._places(digest)[1]]

    def find(self, digest: bytes, length: int) -> list | None:
        """The live entry of a digest: asked of the filter, verified in its bucket."""
        if digest not in self.filter:
            return None
        entry = self._bucket(digest).get(digest)
        if entry is not None and entry[0] != length:
            raise ValueError("two contents share a digest")
        return entry

    def insert(self, digest: bytes, length: int, keep: tuple, rows: int) -> None:
        if entry := self.find(digest, length):
            entry[1] = max(entry[1], keep)
            entry[2] += rows
            return
        self._bucket(digest)[digest] = [length, keep, rows]
        if not self.filter.insert(digest):
            self._grow()

    def delete(self, digest: bytes, length: int) -> bool:
        if self.find(digest, length) is None:
            return False
        del self._bucket(digest)[digest]
        return self.filter.delete(digest)

    def _grow(self) -> None:
        held = [(k, v) for bucket in self.content for k, v in bucket.items()]
        size = self.filter.size
        while True:
            size *= 2
            self.rebuilds += 1
            self.filter = CuckooFilter(size)
            if all(self.filter.insert(k) for k, _ in held):
                break
        self.content = [{} for _ in range(size)]
        for k, v in held:
            self._bucket(k)[k] = v

    def entries(self) -> Iterator[tuple[bytes, int, tuple, int]]:
        for bucket in self.content:
            for digest, (length, keep, rows) in bucket.items():
                yield digest, length, keep, rows


def _place(doc_id: int | None, file: int, row: int) -> tuple:
    return (doc_id is not None, doc_id or 0, file, row)


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [(t.as_py() or "").encode().lower() for t in batch.column("text")]
        yield pa.RecordBatch.from_arrays(
            [
                *[batch.column(c) for c in ("doc_id", FILE, ROW)],
                pa.array([hashlib.sha256(t).digest() for t in texts], pa.binary()),
                pa.array([len(t) for t in texts], pa.int64()),
            ],
            names=["doc_id", FILE, ROW, "digest", "length"],
        )


def digests(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, row key, digest, length) of every row, stored."""
    named = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    schema = f"doc_id long, {FILE} long, {ROW} long, digest binary, length long"
    return stored(with_row_key(named).mapInArrow(_digest, schema), "digests")


def _rows(entries: list[tuple[bytes, int, tuple, int]], step: int | None) -> pa.RecordBatch:
    keeps = [keep for _, _, keep, _ in entries]
    columns = [
        pa.array([e[0] for e in entries], pa.binary()),
        pa.array([e[1] for e in entries], pa.int64()),
        pa.array([k[1] if k[0] else None for k in keeps], pa.int64()),
        pa.array([k[2] for k in keeps], pa.int64()),
        pa.array([k[3] for k in keeps], pa.int64()),
        pa.array([e[3] for e in entries], pa.int64()),
    ]
    names = ["digest", "length", "keep_id", f"keep_{FILE}", f"keep_{ROW}", "rows"]
    if step is not None:
        columns.append(pa.array(np.full(len(entries), step, np.int32)))
        names.append("step")
    return pa.RecordBatch.from_arrays(columns, names=names)


def _insertions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Insert events, with the equal digests of a task put together."""
    held: dict[bytes, list] = {}

    def flush() -> pa.RecordBatch:
        out = _rows([(d, e[0], e[1], e[2]) for d, e in held.items()], INSERT)
        held.clear()
        return out

    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in ("digest", "length", "doc_id", FILE, ROW)]
        for digest, length, doc_id, file, row in zip(*columns, strict=True):
            place = _place(doc_id, file, row)
            if entry := held.get(digest):
                entry[1] = max(entry[1], place)
                entry[2] += 1
            else:
                held[digest] = [length, place, 1]
        if len(held) > HELD:
            yield flush()
    yield flush()


def insertions(stored_digests: DataFrame) -> DataFrame:
    return stored_digests.mapInArrow(_insertions, EVENT)


def deletions(stored_digests: DataFrame) -> DataFrame:
    """Events that take the digests of these rows out of the index."""
    columns = [F.lit(None).cast("long").alias("keep_id")]
    columns += [F.lit(0).cast("long").alias(c) for c in (f"keep_{FILE}", f"keep_{ROW}", "rows")]
    return stored_digests.select("digest", "length", *columns, F.lit(DELETE).alias("step"))


def _run_shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Events sorted by shard and step in, the live entries of every shard out."""
    shard, number = Shard(), None
    for batch in batches:
        columns = [
            batch.column(c).to_pylist()
            for c in ("shard", "step", "digest", "length", "keep_id", f"keep_{FILE}", f"keep_{ROW}", "rows")
        ]
        for at, step, digest, length, keep_id, file, row, rows in zip(*columns, strict=True):
            if at != number:
                if number is not None:
                    yield _rows(list(shard.entries()), None)
                shard, number = Shard(), at
            if step == DELETE:
                shard.delete(digest, length)
            else:
                shard.insert(digest, length, _place(keep_id, file, row), rows)
    if number is not None:
        yield _rows(list(shard.entries()), None)


def update_index(index: DataFrame | None, *events: DataFrame) -> DataFrame:
    """The index after inserting and then deleting: one row per live digest, stored.

    index is an earlier result or None. Shards are many enough to be small.
    """
    spark = events[0].sparkSession
    parts = [e.select(*empty_like(spark, EVENT).columns) for e in events]
    if index is not None:
        parts.insert(0, index.withColumn("step", F.lit(LOAD)))
    every = parts[0]
    for part in parts[1:]:
        every = every.unionByName(part)
    every = stored(every, "events")
    shards = max(4 * partitions(spark), every.count() // SHARD_KEYS)
    dealt = every.withColumn("shard", F.pmod(F.xxhash64("digest"), F.lit(shards)))
    dealt = dealt.repartition(partitions(spark), "shard").sortWithinPartitions("shard", "step")
    return stored(dealt.mapInArrow(_run_shards, INDEX), "index")


def exact_duplicates(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Per row: doc_id, row key, keep_id, group_size, kept, text_sha256.

    kept marks the row that stays of equal texts: the one with the largest id.
    """
    rows = digests(docs, id_col=id_col, text_col=text_col)
    index = update_index(None, insertions(rows))
    found = rows.join(index.drop("length"), "digest")
    stays = (F.col(FILE) == F.col(f"keep_{FILE}")) & (F.col(ROW) == F.col(f"keep_{ROW}"))
    return found.select(
        "doc_id",
        FILE,
        ROW,
        "keep_id",
        F.col("rows").alias("group_size"),
        stays.alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


SQL = """
SELECT doc_id,
       max(doc_id) OVER same AS keep_id,
       count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept,
       text_sha256
FROM (SELECT doc_id,
             sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                              'abcdefghijklmnopqrstuvwxyz')) AS text_sha256
      FROM documents)
WINDOW same AS (PARTITION BY text_sha256)
"""
