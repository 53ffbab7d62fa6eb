"""Ranked lexical search: MaxScore whose bounds come from term pairs.

The index is cut by documents. A shard is one stored row: some thousand documents with their
lengths, and for every term the documents that hold it with its occurrences, in ascending
order. Tasks build shards as they read, so indexing shuffles nothing, and a shard never
outgrows its bound of tokens (one longer document makes up a shard of its own). Each shard is
a row group of its file: however many shards a task writes or reads, it decodes one at a time.

Queries come in blocks, whose terms bound what is sent to the tasks. For a block:

1. document frequencies and the greatest impact of each term are added up over shards;
2. the terms of a query are put in order of their greatest impact and paired, neighbour with
   neighbour. For every shard the intersection list of each pair is computed, and the greatest
   impact that the two have together in one document is stored beside the postings of the
   block's terms. The rarest terms of each query give first candidates, whose k best scores
   over all shards are a threshold that every result has to reach;
3. in each shard, terms are left out from the weakest up while the bound of all those left
   out stays below the threshold. For two paired terms the bound is the greatest of their
   joint impact and of either alone, which is at most, and mostly below, the sum of both
   maxima that plain MaxScore takes. Documents of the other terms are candidates; the terms
   left out are looked up for them, pair by pair, strongest first, dropping candidates that
   can no longer reach the threshold;
4. the best k of each shard meet and the best k of those are the result.

Scores are whole numbers, so results are exact and the same in every run.

Defined results: a null text, or one without a term, is no document and matches nothing; an
item without terms, or whose terms no document has, gives no rows; items are told apart by
their row, so repeated items each have their results; repeated documents and null ids are
documents of their own, with equal scores the null id last; empty tables give empty results;
other columns are not read; texts are read whole.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyhouse.llm.common import ship_package, stored

#: A shard is closed at so many tokens or documents; both bound a row of the index.
SHARD_TOKENS, SHARD_DOCS = 2_000_000, 1 << 16
#: Spark's reader decodes up to 4096 rows of a row group at once, and its writer holds a hundred rows
#: before it looks at their size; with rows of many megabytes neither may be left to that.
ROW_GROUPS = {"parquet.block.row.count.limit": "1"}
#: A block of queries is closed at so many terms; one longer query is a block of its own.
BLOCK_TERMS = 50_000
#: Bytes of a text that are cut into terms at once.
SLICE = 1 << 20
#: First candidates come from the strongest terms that together have so many times k postings.
SEEDS = 4
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"

#: ASCII letters to lower case, other ASCII signs but digits to a space.
PLAIN = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256)
)


def terms_of(text: str | None) -> Iterator[list[bytes]]:
    """The terms of a text in order, with repeats, a slice of the text at a time."""
    plain = (text or "").encode().translate(PLAIN)
    start = 0
    while start < len(plain):
        end = plain.find(b" ", start + SLICE)
        end = len(plain) if end < 0 else end
        if found := plain[start:end].split():
            yield found
        start = end


class _Builder:
    """Collects documents until they fill a shard."""

    def __init__(self, id_type: pa.DataType):
        self.id_type = id_type
        self.clear()

    def clear(self) -> None:
        self.terms: defaultdict[bytes, int] = defaultdict(count().__next__)
        self.ids, self.lengths, self.tokens, self.held = [], [], [], 0

    def add(self, doc_id, text: str | None) -> None:
        number = self.terms.__getitem__
        parts = [np.fromiter(map(number, found), np.int32, len(found)) for found in terms_of(text)]
        if parts:
            self.ids.append(doc_id)
            self.lengths.append(sum(map(len, parts)))
            self.tokens.extend(parts)
            self.held += self.lengths[-1]

    def full(self) -> bool:
        return self.held >= SHARD_TOKENS or len(self.ids) >= SHARD_DOCS

    def row(self) -> pa.RecordBatch:
        docs = len(self.ids)
        code = np.concatenate([*self.tokens, np.empty(0, np.int32)], dtype=np.int64)
        self.tokens = []
        code *= max(docs, 1)
        code += np.repeat(np.arange(docs, dtype=np.int32), self.lengths)
        code.sort()
        first = np.flatnonzero(np.diff(code, prepend=-1))
        times = np.diff(first, append=len(code))
        term, doc = np.divmod(code[first], max(docs, 1))
        del code, first
        starts = np.searchsorted(term, np.arange(len(self.terms) + 1))
        out = {
            "ids": pa.array(self.ids, self.id_type),
            "lengths": pa.array(self.lengths, pa.int64()),
            "terms": pa.array(list(self.terms), pa.binary()),
            "starts": pa.array(starts.astype(np.int32)),
            "docs": pa.array(doc.astype(np.int32)),
            "times": pa.array(times.astype(np.int32)),
        }
        batch = pa.RecordBatch.from_pydict(
            {"n_docs": pa.array([docs], pa.int64()), "n_terms": pa.array([self.held], pa.int64())}
            | {k: pa.ListArray.from_arrays(pa.array([0, len(v)], pa.int32()), v) for k, v in out.items()}
        )
        self.clear()
        return batch


def _index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    builder = None
    for batch in batches:
        builder = builder or _Builder(batch.schema.field(0).type)
        for doc_id, text in zip(batch.column(0), batch.column(1), strict=True):
            builder.add(doc_id.as_py(), text.as_py())
            if builder.full():
                yield builder.row()
    if builder and builder.ids:
        yield builder.row()


def build_index(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The stored index of all documents, one row per shard."""
    ship_package(docs.sparkSession)
    named = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = named.schema["doc_id"].dataType.simpleString()
    schema = (
        f"n_docs long, n_terms long, ids array<{kind}>, lengths array<long>, terms array<binary>, "
        "starts array<int>, docs array<int>, times array<int>"
    )
    return stored(named.mapInArrow(_index, schema), "lexical-index", **ROW_GROUPS)


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def saturation(times: np.ndarray, lengths: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    """What a term's occurrences count in documents of these lengths, before its weight."""
    spread = np.array([50 + 50 * int(n) * n_docs // n_terms for n in np.unique(lengths)], np.int64)
    norm = spread[np.searchsorted(np.unique(lengths), lengths)]
    times = times.astype(np.int64)
    return (1_000_000_000 * times) // (1000 * times + 20 * norm)


class Block:
    """Some queries: their terms, and what tasks need to know about these."""

    def __init__(self, queries: list[list[bytes]], k: int, n_docs: int, n_terms: int):
        self.k, self.n_docs, self.n_terms = k, n_docs, n_terms
        self.terms = sorted({t for q in queries for t in q})
        place = {t: i for i, t in enumerate(self.terms)}
        self.queries = [sorted(place[t] for t in q) for q in queries]
        self.df = np.zeros(len(self.terms), np.int64)
        self.weight = np.zeros(len(self.terms), np.int64)
        self.most = np.zeros(len(self.terms), np.int64)
        self.pairs: list[tuple[int, int]] = []
        self.seeds: list[int] = []

    def learn(self, found: dict[bytes, tuple[int, int]]) -> None:
        """Take in each term's documents and greatest saturation; order and pair the terms."""
        for i, term in enumerate(self.terms):
            df, most = found.get(term, (0, 0))
            self.df[i], self.weight[i] = df, weight(self.n_docs, df)
            self.most[i] = most * self.weight[i]
        pairs: dict[tuple[int, int], int] = {}
        self.paired, ordered = [], []
        for query in self.queries:
            order = sorted((t for t in query if self.df[t]), key=lambda t: (self.most[t], t))
            ordered.append(order)
            couples = zip(order[::2], order[1::2], strict=False)
            self.paired.append([pairs.setdefault(c, len(pairs)) for c in couples])
        self.queries, self.pairs = ordered, list(pairs)
        for order in ordered:
            seeds, held = 0, 0
            while seeds < len(order) and held < SEEDS * self.k:
                seeds += 1
                held += int(self.df[order[-seeds]])
            self.seeds.append(seeds)


class Shard:
    """The postings of a block's terms in one shard: documents and impacts of each term."""

    def __init__(self, n_docs: int, terms: np.ndarray, starts: np.ndarray, docs: np.ndarray, impacts: np.ndarray):
        self.n_docs = n_docs
        self.lists = {
            int(t): (docs[a:b], impacts[a:b]) for t, a, b in zip(terms, starts, starts[1:], strict=False)
        }
        self.most = {t: int(x.max()) for t, (_, x) in self.lists.items()}
        self.read = 0  # postings read or looked up

    def joint(self, pair: tuple[int, int], scratch: np.ndarray) -> int:
        """The greatest sum of both impacts in a document that has both terms; 0 if none has."""
        if any(t not in self.lists for t in pair):
            return 0
        (docs, x), (others, y) = self.lists[pair[0]], self.lists[pair[1]]
        scratch[docs] = x
        beside = scratch[others]
        both = beside > 0
        scratch[docs] = 0
        return int((beside + y)[both].max()) if both.any() else 0

    def bounds(self, order: list[int], joint: list[int] | None) -> list[int]:
        """For each number of weakest terms, the most that they can add to one document."""
        most = [self.most.get(t, 0) for t in order]
        out = [0]
        for i, x in enumerate(most):
            if i % 2 and joint is not None:
                out.append(out[i - 1] + min(most[i - 1] + x, max(joint[i // 2], most[i - 1], x)))
            else:
                out.append(out[i] + x)
        return out

    def _look_up(self, term: int, docs: np.ndarray, scores: np.ndarray) -> None:
        if len(docs) and term in self.lists:
            held, impacts = self.lists[term]
            at = np.minimum(np.searchsorted(held, docs), len(held) - 1)
            scores += np.where(held[at] == docs, impacts[at], 0)
            self.read += len(docs)

    def _sum(self, terms: list[int], scratch: np.ndarray) -> np.ndarray:
        for t in terms:
            if t in self.lists:
                docs, impacts = self.lists[t]
                scratch[docs] += impacts
                self.read += len(docs)
        return np.flatnonzero(scratch)

    def first_scores(self, order: list[int], seeds: int, k: int, scratch: np.ndarray) -> np.ndarray:
        """Whole scores of the k best documents by the strongest terms alone."""
        docs = self._sum(order[len(order) - seeds :], scratch)
        scores = scratch[docs]
        scratch[docs] = 0
        best = np.argsort(-scores, kind="stable")[:k]
        docs, scores = docs[best], scores[best]
        inner = np.argsort(docs)
        docs, scores = docs[inner], scores[inner]
        for t in order[: len(order) - seeds]:
            self._look_up(t, docs, scores)
        return scores

    def reach(
        self, order: list[int], joint: list[int] | None, least: int, scratch: np.ndarray
    ) -> tuple[np.ndarray, np.ndarray]:
        """Documents whose score is above 0 and at least `least`, with their scores."""
        bounds = self.bounds(order, joint)
        left_out = max(i for i, bound in enumerate(bounds) if bound < max(least, 1))
        docs = self._sum(order[left_out:], scratch)
        scores = scratch[docs]
        scratch[docs] = 0
        for i in range(left_out, -1, -1):
            alive = scores + bounds[i] >= least
            docs, scores = docs[alive], scores[alive]
            if i and len(docs):
                self._look_up(order[i - 1], docs, scores)
        return docs, scores


def _values(batch: pa.RecordBatch, row: int, name: str) -> np.ndarray:
    return batch.column(name)[row].values.to_numpy(zero_copy_only=False)


def _present(batch: pa.RecordBatch, row: int, block: Block) -> tuple[np.ndarray, np.ndarray]:
    """Places of the shard's terms that the block has, and their numbers in the block."""
    wanted = pa.array(block.terms, pa.binary())
    found = pc.index_in(batch.column("terms")[row].values, value_set=wanted)
    at = np.flatnonzero(pc.is_valid(found).to_numpy(zero_copy_only=False))
    return at, found.take(pa.array(at)).to_numpy().astype(np.int64)


def _saturations(batch: pa.RecordBatch, row: int, at: np.ndarray, block: Block):
    """Documents and saturations of the given terms, end to end, and where each term starts."""
    starts = _values(batch, row, "starts").astype(np.int64)
    lengths = _values(batch, row, "lengths")
    sizes = starts[at + 1] - starts[at]
    ends = np.cumsum(sizes)
    taken = np.repeat(starts[at] - (ends - sizes), sizes) + np.arange(int(sizes.sum()))
    docs = _values(batch, row, "docs")[taken]
    satur = saturation(_values(batch, row, "times")[taken], lengths[docs], block.n_docs, block.n_terms)
    return np.concatenate([[0], ends]).astype(np.int64), docs, satur


def _term_facts(block: Block):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                at, terms = _present(batch, row, block)
                if not len(at):
                    continue
                starts, _, satur = _saturations(batch, row, at, block)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([block.terms[t] for t in terms], pa.binary()),
                        pa.array(np.diff(starts)),
                        pa.array(np.maximum.reduceat(satur, starts[:-1])),
                    ],
                    names=["term", "df", "most"],
                )

    return run


def _one(values, kind: pa.DataType) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), pa.array(values, kind))


def _block_shards(block: Block):
    """Per shard a row with the block's postings, the joint impacts of pairs, first scores."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                at, terms = _present(batch, row, block)
                if not len(at):
                    continue
                starts, docs, satur = _saturations(batch, row, at, block)
                impacts = satur * np.repeat(block.weight[terms], np.diff(starts))
                n_docs = len(batch.column("ids")[row].values)
                shard = Shard(n_docs, terms, starts, docs, impacts)
                scratch = np.zeros(n_docs, np.int64)
                joint = [shard.joint(p, scratch) for p in block.pairs]
                first = [
                    shard.first_scores(order, seeds, block.k, scratch)
                    for order, seeds in zip(block.queries, block.seeds, strict=True)
                ]
                query = np.repeat(np.arange(len(first)), [len(x) for x in first])
                yield pa.RecordBatch.from_pydict(
                    {
                        "ids": batch.column("ids").slice(row, 1),
                        "terms": _one(terms, pa.int64()),
                        "starts": _one(starts, pa.int64()),
                        "docs": _one(docs, pa.int32()),
                        "impacts": _one(impacts, pa.int64()),
                        "joint": _one(joint, pa.int64()),
                        "query": _one(query, pa.int64()),
                        "first": _one(np.concatenate([*first, np.empty(0, np.int64)]), pa.int64()),
                    }
                )

    return run


def _search(block: Block, least: list[int], by_pairs: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                ids = batch.column("ids")[row].values
                names = ("terms", "starts", "docs", "impacts")
                shard = Shard(len(ids), *(_values(batch, row, n) for n in names))
                joint = _values(batch, row, "joint").tolist()
                scratch = np.zeros(len(ids), np.int64)
                for query, order in enumerate(block.queries):
                    known = [joint[p] for p in block.paired[query]] if by_pairs else None
                    docs, scores = shard.reach(order, known, least[query], scratch)
                    if not len(docs):
                        continue
                    found = pa.table({"doc_id": ids.take(pa.array(docs)), "score": scores})
                    if len(found) > block.k:
                        order_by = [("score", "descending"), ("doc_id", "ascending")]
                        found = found.take(pc.sort_indices(found, order_by)[: block.k])
                    found = found.add_column(0, "query", pa.array(np.full(len(found), query, np.int64)))
                    yield from found.combine_chunks().to_batches()

    return run


def _blocks(items: DataFrame) -> Iterator[list[tuple]]:
    """Items (id, distinct terms), a bounded number of terms at a time."""
    held, size = [], 0
    for row in items.toLocalIterator():
        terms = {t for part in terms_of(row["text"]) for t in part}
        if not terms:
            continue
        if held and size + len(terms) > BLOCK_TERMS:
            yield held
            held, size = [], 0
        held.append((row["item_id"], sorted(terms)))
        size += len(terms)
    if held:
        yield held


def _best(index: DataFrame, queries: list[list[bytes]], k: int, by_pairs: bool) -> DataFrame:
    """query (its place in the list), rank, doc_id, score."""
    total = index.agg(F.sum("n_docs"), F.sum("n_terms")).first()
    block = Block(queries, k, int(total[0] or 0), int(total[1] or 0))
    postings = index.select("ids", "lengths", "terms", "starts", "docs", "times")
    facts = postings.mapInArrow(_term_facts(block), "term binary, df long, most long")
    # At most one row per term of the block.
    known = facts.groupBy("term").agg(F.sum("df").alias("df"), F.max("most").alias("most")).collect()
    block.learn({bytes(r["term"]): (r["df"], r["most"]) for r in known})
    kind = index.schema["ids"].dataType.simpleString()
    lists = "array<long>"
    schema = (
        f"ids {kind}, terms {lists}, starts {lists}, docs array<int>, impacts {lists}, joint {lists}, "
        f"query {lists}, first {lists}"
    )
    shards = stored(postings.mapInArrow(_block_shards(block), schema), "lexical-block", **ROW_GROUPS)
    first = shards.select(F.inline(F.arrays_zip("query", "first")))
    by_score = Window.partitionBy("query").orderBy(F.col("first").desc())
    kth = first.withColumn("place", F.row_number().over(by_score)).where(F.col("place") == k)
    least = [1] * len(queries)
    for row in kth.select("query", "first").collect():  # at most one row per query
        least[row["query"]] = max(1, row["first"])
    id_kind = index.schema["ids"].dataType.elementType.simpleString()
    found = shards.drop("query", "first").mapInArrow(
        _search(block, least, by_pairs), f"query long, doc_id {id_kind}, score long"
    )
    placed = Window.partitionBy("query").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    return found.withColumn("rank", F.row_number().over(placed)).where(F.col("rank") <= k)


def search(
    index: DataFrame,
    items: DataFrame,
    *,
    id_col: str = "item_id",
    text_col: str = "text",
    k: int = 50,
    by_pairs: bool = True,
) -> DataFrame:
    """Each item's k best documents of an index: item_id, rank, doc_id, score."""
    spark = index.sparkSession
    ship_package(spark)
    named = items.select(F.col(id_col).alias("item_id"), F.col(text_col).alias("text"))
    id_field = T.StructField("item_id", named.schema["item_id"].dataType)
    parts = []
    for held in _blocks(named):
        best = _best(index, [terms for _, terms in held], k, by_pairs)
        # As many rows as the block has items.
        ids = spark.createDataFrame(
            [(q, item) for q, (item, _) in enumerate(held)],
            T.StructType([T.StructField("query", T.LongType()), id_field]),
        )
        parts.append(stored(best.join(ids, "query").select("item_id", "rank", "doc_id", "score"), "ranked"))
    if not parts:
        id_kind = index.schema["ids"].dataType.elementType
        number = T.StructField("rank", T.IntegerType()), T.StructField("doc_id", id_kind)
        return spark.createDataFrame([], T.StructType([id_field, *number, T.StructField("score", T.LongType())]))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionAll(part)
    return out


UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SQL = rf"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id,
    regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '{TERM}') AS terms
  FROM documents
), lengths AS (
  SELECT r, doc_id, len(terms)::BIGINT AS n FROM d WHERE len(terms) > 0
), sums AS (
  SELECT count(*)::BIGINT AS docs, sum(n)::BIGINT AS terms FROM lengths
), items AS (
  SELECT row_number() OVER () AS q, item_id,
    unnest(list_distinct(regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '{TERM}'))) AS term
  FROM benchmark
), p AS (
  SELECT r, term, count(*)::BIGINT AS tf FROM (SELECT r, unnest(terms) AS term FROM d)
  WHERE term IN (SELECT term FROM items) GROUP BY r, term
), w AS (
  SELECT term, floor(1000 * ln((2.0::DOUBLE * max(sums.docs) + 2) / (2 * count(*) + 1)))::BIGINT AS w
  FROM p, sums GROUP BY term
), scored AS (
  SELECT q, item_id, r, lengths.doc_id,
    sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + ((50 * n * docs) // terms)))))::BIGINT AS score
  FROM items JOIN p USING (term) JOIN w USING (term) JOIN lengths USING (r), sums
  GROUP BY q, item_id, r, lengths.doc_id
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY q ORDER BY score DESC, doc_id NULLS LAST) AS place
  FROM scored WHERE score > 0
)
SELECT item_id, place::INTEGER AS rank, doc_id, score FROM ranked WHERE place <= 50
"""
