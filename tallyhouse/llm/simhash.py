"""Near-duplicate groups by SimHash, found through pivot distance tables.

A fingerprint's coordinates are its Hamming distances to reference fingerprints, kept per
segment of bits in precomputed tables. Two fingerprints that differ in at most `radius`
bits differ by at most that in every coordinate; and with radius + 3 segments, at least
three segments do not differ at all, so neither do those segments' coordinates. Whole
coordinates alone hardly separate (distances of unrelated fingerprints all lie near 32),
so rows first meet by the coordinates of three segments, for every choice of three. Pairs
that meet are discarded by the largest difference of their whole coordinates, and the
Hamming distance of the survivors is computed. Nothing that links is lost, and no bucket
holds more than the fingerprints that agree in three segments.

Equal fingerprints are one node. A task keeps the groups it has seen and emits only links
that join two of them, so a dense group yields links in the number of its members.
Components are found on fingerprints, by stars.

Defined results: a null or empty text and one without words has fingerprint zero, linked
like any other; a text of fewer words than a shingle is one shingle; repeated rows and
repeated or null ids are all returned; the component of rows that all lack an id is null;
an empty table gives an empty one; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm.common import FILE, ROW, partitions, stored, with_row_key
from tallyhouse.llm.components import components

BITS = 64
RADIUS = 4
SHINGLE = 4
SEED = 42
REFERENCES = 16
#: Hashes whose bits are counted at once.
CHUNK = 1 << 15
#: Rows of a bucket up to which all pairs are compared at once.
SMALL_BUCKET = 64


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """SimHash of a text's word shingles: a bit is 1 if set in over half their hashes."""
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    count = max(1, len(words) - shingle + 1)
    gaps = np.flatnonzero(np.frombuffer(joined, np.uint8) == 32)
    starts = [0, *(gaps[: count - 1] + 1).tolist()]
    ends = [*gaps[shingle - 1 :].tolist(), len(joined)] if count > 1 else [len(joined)]
    digest = xxhash.xxh64_digest
    ones = np.zeros(BITS, np.int64)
    for at in range(0, count, CHUNK):
        part = zip(starts[at : at + CHUNK], ends[at : at + CHUNK], strict=True)
        hashes = b"".join([digest(joined[i:j], SEED) for i, j in part])
        bits = np.unpackbits(np.frombuffer(hashes, np.uint8)).reshape(-1, BITS)
        ones += bits.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(ones * 2 > count).tobytes(), "big")


def _fingerprints(shingle: int):
    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [fingerprint(text.as_py(), shingle) for text in batch.column("text")]
            signed = pa.array(np.array(found, np.uint64).view(np.int64))
            rest = [batch.column(c) for c in ("doc_id", FILE, ROW)]
            yield pa.RecordBatch.from_arrays([*rest, signed], names=["doc_id", FILE, ROW, "fp"])

    return compute


def fingerprints(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE
) -> DataFrame:
    """(doc_id, row key, fp) of every row, stored; fp holds the 64 bits as a signed long."""
    named = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    keyed = with_row_key(named)
    kind = keyed.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, {FILE} long, {ROW} long, fp long"
    return stored(keyed.mapInArrow(_fingerprints(shingle), schema), "fingerprints")


class PivotTables:
    """Distances of every segment value to the same segment of each reference fingerprint."""

    def __init__(self, radius: int = RADIUS, references: int = REFERENCES, seed: int = SEED):
        self.radius = radius
        self.segments = radius + 3
        edges = [BITS * k // self.segments for k in range(self.segments + 1)]
        self.spans = [(low, high - low) for low, high in zip(edges, edges[1:], strict=False)]
        pivots = np.random.default_rng(seed).integers(0, 1 << 63, references, dtype=np.uint64) * 2
        pivots[0] = 0
        self.tables, self.codes = [], []
        weights = np.random.default_rng(seed + 1).integers(1, 1 << 63, references, dtype=np.uint64)
        for low, width in self.spans:
            values = np.arange(1 << width, dtype=np.uint64)
            own = (pivots >> np.uint64(low)) & np.uint64((1 << width) - 1)
            table = np.bitwise_count(values[:, None] ^ own[None, :]).astype(np.int16)
            self.tables.append(table)
            # One number for a segment's coordinates: equal coordinates, equal number.
            self.codes.append((table.astype(np.uint64) * weights[None, :]).sum(axis=1, dtype=np.uint64))
        self.choices = list(combinations(range(self.segments), 3))

    def _segment(self, fps: np.ndarray, k: int) -> np.ndarray:
        low, width = self.spans[k]
        return ((fps >> np.uint64(low)) & np.uint64((1 << width) - 1)).astype(np.int64)

    def coordinates(self, fps: np.ndarray) -> np.ndarray:
        """Distances of each fingerprint to all references."""
        return sum(table[self._segment(fps, k)] for k, table in enumerate(self.tables))

    def keys(self, fps: np.ndarray) -> np.ndarray:
        """For every choice of three segments a key of their coordinates; a row per choice."""
        codes = [code[self._segment(fps, k)] for k, code in enumerate(self.codes)]
        odd = np.uint64(0x9E3779B97F4A7C15)
        out = []
        with np.errstate(over="ignore"):
            for n, (i, j, k) in enumerate(self.choices):
                key = codes[i] * odd
                key = ((key ^ (key >> np.uint64(29))) + codes[j]) * odd
                key = ((key ^ (key >> np.uint64(31))) + codes[k] + np.uint64(n)) * odd
                out.append(key ^ (key >> np.uint64(32)))
        return np.array(out)

    def linked(self, x: np.ndarray, y: np.ndarray, cx: np.ndarray, cy: np.ndarray) -> np.ndarray:
        """Of pairs, which link: first by the largest coordinate difference, then by bits."""
        near = np.flatnonzero(np.abs(cx - cy).max(axis=1) <= self.radius)
        return near[np.bitwise_count(x[near] ^ y[near]) <= self.radius]


class _Groups:
    """Groups of fingerprints seen by one task."""

    def __init__(self):
        self.above: dict[int, int] = {}

    def find(self, x: int) -> int:
        above = self.above
        while (y := above.get(x, x)) != x:
            above[x] = x = above.get(y, y)
        return x

    def join(self, x: int, y: int) -> bool:
        a, b = self.find(x), self.find(y)
        if a == b:
            return False
        self.above[max(a, b)] = min(a, b)
        return True


def _bucket_links(fps: np.ndarray, tables: PivotTables, groups: _Groups) -> list[tuple[int, int]]:
    """Links that connect whatever is linked within one large bucket.

    Every member near a leader joins it; the next leader is the first member that none
    has reached. Then sets of different groups are compared, unless the triangle
    inequality over their leaders rules a link out.
    """
    coordinates = tables.coordinates(fps)
    bits, left = tables.radius, np.ones(len(fps), bool)
    out, sets = [], []

    def near(at: int, among: np.ndarray) -> np.ndarray:
        close = among[np.abs(coordinates[among] - coordinates[at]).max(axis=1) <= bits]
        return close[np.bitwise_count(fps[close] ^ fps[at]) <= bits]

    every = np.arange(len(fps))
    start = 0
    while start < len(fps):
        if not left[start]:
            start += 1
            continue
        members = near(start, every)
        fresh = members[left[members]]
        left[fresh] = False
        for k in members.tolist():
            if k != start and groups.join(int(fps[start]), int(fps[k])):
                out.append((int(fps[start]), int(fps[k])))
        sets.append((start, fresh))
    for n, (a, own) in enumerate(sets):
        for b, other in sets[n + 1 :]:
            if np.bitwise_count(fps[a] ^ fps[b]) > 3 * bits:
                continue
            if groups.find(int(fps[a])) == groups.find(int(fps[b])):
                continue
            for k in own.tolist():
                if len(hit := near(k, other)):
                    groups.join(int(fps[k]), int(fps[hit[0]]))
                    out.append((int(fps[k]), int(fps[hit[0]])))
                    break
    return out


def _keys(radius: int, references: int):
    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = PivotTables(radius, references)
        for batch in batches:
            fps = batch.column("fp").to_numpy().view(np.uint64)
            keys = tables.keys(fps)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(keys.reshape(-1).view(np.int64)),
                    pa.array(np.tile(fps.view(np.int64), len(keys))),
                ],
                names=["key", "fp"],
            )

    return compute


def _links(radius: int, references: int):
    def run(
        keys: np.ndarray, fps: np.ndarray, tables: PivotTables, groups: _Groups
    ) -> list[tuple[int, int]]:
        """Links among rows sorted by key; no key goes on beyond them."""
        out: list[tuple[int, int]] = []
        starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
        sizes = np.diff(np.concatenate([starts, [len(keys)]]))
        for at, size in zip(starts[big := sizes > SMALL_BUCKET], sizes[big], strict=True):
            out += _bucket_links(fps[at : at + size], tables, groups)
        several = np.flatnonzero((sizes > 1) & (sizes <= SMALL_BUCKET))
        if not len(several):
            return out
        runs = zip(starts[several], sizes[several], strict=True)
        rows = np.concatenate([np.arange(a, a + n) for a, n in runs])
        key, fp = keys[rows], fps[rows]
        coordinates = tables.coordinates(fp)
        for lag in range(1, SMALL_BUCKET):
            left = np.flatnonzero(key[lag:] == key[:-lag])
            if not len(left):
                break
            right = left + lag
            found = tables.linked(fp[left], fp[right], coordinates[left], coordinates[right])
            for x, y in zip(fp[left[found]].tolist(), fp[right[found]].tolist(), strict=True):
                if groups.join(x, y):
                    out.append((x, y))
        return out

    def batch_of(links: list[tuple[int, int]]) -> pa.RecordBatch:
        pairs = np.array(links, np.uint64).reshape(-1, 2).view(np.int64)
        return pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=["a", "b"])

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables, groups = PivotTables(radius, references), _Groups()
        held_keys, held_fps = [], []
        for batch in batches:
            keys = batch.column("key").to_numpy()
            fps = batch.column("fp").to_numpy().view(np.uint64)
            if not len(keys):
                continue
            held_keys.append(keys)
            held_fps.append(fps)
            last = int(np.searchsorted(keys, keys[-1]))
            if not last:
                continue  # the whole batch is one key, which may go on
            keys, fps = np.concatenate(held_keys), np.concatenate(held_fps)
            last = int(np.searchsorted(keys, keys[-1]))
            yield batch_of(run(keys[:last], fps[:last], tables, groups))
            held_keys, held_fps = [keys[last:]], [fps[last:]]
        if held_keys:
            yield batch_of(run(np.concatenate(held_keys), np.concatenate(held_fps), tables, groups))

    return compute


def links(fps: DataFrame, *, radius: int = RADIUS, references: int = REFERENCES) -> DataFrame:
    """Links (a, b) that connect all distinct fingerprints within radius bits of each other.

    Not every linked pair is listed: pairs that earlier links of a task connect are left out.
    """
    keyed = fps.select("fp").distinct().mapInArrow(_keys(radius, references), "key long, fp long")
    met = keyed.repartition(partitions(fps.sparkSession), "key").sortWithinPartitions("key", "fp")
    return met.mapInArrow(_links(radius, references), "a long, b long")


def near_duplicates(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle: int = SHINGLE,
    radius: int = RADIUS,
    references: int = REFERENCES,
) -> DataFrame:
    """Per row: doc_id, row key, fp, component_id (the smallest id of its component), root.

    root is the component's least fingerprint as a signed long. It names the component;
    component_id does not, where ids are null or repeated.
    """
    prints = fingerprints(docs, id_col=id_col, text_col=text_col, shingle=shingle)
    nodes = stored(prints.groupBy("fp").agg(F.min("doc_id").alias("first")), "nodes")
    roots = components(links(nodes, radius=radius, references=references))
    rooted = nodes.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "first", F.coalesce("root", "fp").alias("root")
    )
    # Stored, so that a large component, a skewed key of the joins to come, can be split.
    rooted = stored(rooted, "rooted")
    smallest = stored(rooted.groupBy("root").agg(F.min("first").alias("component_id")), "smallest")
    named = rooted.join(smallest, "root").select("fp", "component_id", "root")
    return prints.join(named, "fp").select("doc_id", FILE, ROW, "fp", "component_id", "root")


def keep_one(docs: DataFrame, **options) -> DataFrame:
    """The rows that stay: of each component one, with the smallest id; all columns as they are."""
    found = near_duplicates(docs, **options)
    nodes = found.select(
        "root", F.struct(F.col("doc_id").isNull(), "doc_id", FILE, ROW).alias("place")
    )
    kept = nodes.groupBy("root").agg(F.min("place").alias("place"))
    return kept.select(f"place.{FILE}", f"place.{ROW}")
