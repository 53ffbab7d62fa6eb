"""Language identification by words first, then shorter and shorter character n-grams.

Training counts every word of every labelled text per language, and from these words the
n-grams of 1 to `max_gram` letters, word ends included. A known word counts with its log
frequency in each language; an unseen one with the mean log frequency of its longest
n-grams that are known. A text's language has the largest sum, its score is the posterior.

All counts stay in two tables, a row per word and per n-gram. The most frequent of them are
also sent to the tasks, which add up at once what these say of a text. What is left of each
text, its other words with their numbers, meets the tables in joins, and so do those n-grams
of its unseen words that the tasks do not hold. How many are sent changes the time, not the
result; logs that come by joins are added as decimals, so in any order.

Words are runs of letters, lower-cased. Defined results: `und` with score 0 for a null text
and one without a letter, and for every text if there is nothing to learn from; equal sums
go to the language that is first by code point; rows with a null lang are predicted, not
learned from; repeated rows, repeated and null ids are all returned; an empty table gives
an empty one; other columns are not read; texts are read whole.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm.common import FILE, ROW, held_out, partitions, ship_package, stored, with_row_key

UNKNOWN = "und"
MAX_GRAM = 4
#: Most words and n-grams that are sent to the tasks; about 100 bytes each there. The others
#: are looked up in the tables.
MAX_WORDS = 150_000
MAX_GRAMS = 100_000
SMOOTHING = 0.5
#: Counts a task holds before it sends them on.
HELD = 400_000
#: Logs are added as this type, so that the order of rows does not matter.
EXACT = "decimal(28,15)"

WORDS = re.compile(r"[^\W\d_]+")


def words_of(text: str | None) -> list[str]:
    return WORDS.findall((text or "").lower())


def grams_of(word: str, size: int) -> list[str]:
    """The n-grams of one size of a word with its ends marked."""
    marked = f"^{word}$" if size > 1 else word
    return [marked[i : i + size] for i in range(len(marked) - size + 1)]


def _flushed(counts: dict[str, Counter]) -> pa.RecordBatch:
    rows = [(lang, token, n) for lang, held in counts.items() for token, n in held.items()]
    counts.clear()
    return pa.RecordBatch.from_arrays(
        [
            pa.array([r[0] for r in rows], pa.string()),
            pa.array([r[1] for r in rows], pa.string()),
            pa.array([r[2] for r in rows], pa.int64()),
        ],
        names=["lang", "token", "n"],
    )


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: dict[str, Counter] = defaultdict(Counter)
    for batch in batches:
        for lang, text in zip(batch.column("lang"), batch.column("text"), strict=True):
            counts[lang.as_py()].update(words_of(text.as_py()))
            if sum(map(len, counts.values())) > HELD:
                yield _flushed(counts)
    yield _flushed(counts)


def _count_grams(max_gram: int):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, Counter] = defaultdict(Counter)
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("token", "counts")]
            for word, by_lang in zip(*columns, strict=True):
                for size in range(1, max_gram + 1):
                    for gram in grams_of(word, size):
                        for lang, n in by_lang:
                            counts[lang][gram] += n
            if sum(map(len, counts.values())) > HELD:
                yield _flushed(counts)
        yield _flushed(counts)

    return count


COUNTS = "lang string, token string, n long"


def _summed(counts: DataFrame, name: str) -> DataFrame:
    """A row per token, stored: its count in each language and in all, its length."""
    # Tasks have added up what they counted, so tokens are dealt once and not combined before.
    dealt = counts.repartition(partitions(counts.sparkSession), "token")
    each = dealt.groupBy("token", "lang").agg(F.sum("n").alias("n"))
    by_lang = F.map_from_entries(F.collect_list(F.struct("lang", "n")))
    return stored(
        each.groupBy("token").agg(
            by_lang.alias("counts"), F.sum("n").alias("n"), F.length("token").alias("size")
        ),
        name,
    )


def _most_frequent(counts: DataFrame, most: int) -> list[tuple]:
    """The rows whose count n lies at or above the least count at which no more than `most` remain."""
    by_count = counts.groupBy("n").agg(F.count("*").alias("tokens"))
    # Doubling steps of the count; at most 64 rows however large the table.
    octaves = by_count.groupBy(F.floor(F.log2("n")).alias("o")).agg(F.sum("tokens").alias("t"))
    held, floor = 0, 0
    for row in sorted(octaves.collect(), key=lambda r: -r["o"]):
        if held + row["t"] > most:
            floor = 1 << (int(row["o"]) + 1)
            inside = by_count.where((F.col("n") >= 1 << int(row["o"])) & (F.col("n") < floor))
            # Of this octave as many of the larger counts as still fit.
            room = most - held
            for step in inside.orderBy(F.col("n").desc()).limit(room + 1).toLocalIterator():
                if step["tokens"] > room:
                    break
                room, floor = room - step["tokens"], step["n"]
            break
        held += row["t"]
    return [tuple(r) for r in counts.where(F.col("n") >= floor).collect()]


class _Frequent:
    """What the tasks hold: log frequencies of the most frequent words and n-grams."""

    def __init__(
        self,
        languages: list[str],
        prior: np.ndarray,
        words: list[tuple[str, dict[str, int], int]],
        word_norms: np.ndarray,
        grams: list[tuple[str, dict[str, int], int]],
        gram_norms: np.ndarray,
        all_grams: bool,
    ):
        self.languages, self.prior, self.all_grams = languages, prior, all_grams
        self.max_gram = len(gram_norms)
        column = {lang: k for k, lang in enumerate(languages)}
        self.words, self.word_logs = self._logs(words, column)
        self.word_logs -= word_norms
        self.grams, self.gram_logs = self._logs(grams, column)
        if grams:
            self.gram_logs -= gram_norms[[len(g) - 1 for g in self.grams]]

    @staticmethod
    def _logs(
        counts: list[tuple[str, dict[str, int], int]], column: dict[str, int]
    ) -> tuple[dict[str, int], np.ndarray]:
        index = {token: k for k, (token, _, _) in enumerate(counts)}
        table = np.full((len(index), len(column)), SMOOTHING)
        for k, (_, by_lang, _) in enumerate(counts):
            for lang, n in by_lang.items():
                table[k, column[lang]] += n
        return index, np.log(table)

    def read(self, text: str | None) -> tuple[bool, np.ndarray, Counter]:
        """If a text has letters, the sum over its words that are held, and its other words."""
        found = words_of(text)
        if not any(w.isalpha() or any(map(str.isalpha, w)) for w in found):
            return False, self.prior, Counter()
        rest: list[str] = []
        get = self.words.get
        known = [k for w in found if (k := get(w)) is not None or rest.append(w)]
        return True, self.prior + self.word_logs[known].sum(axis=0), Counter(rest)

    def longest(self, word: str) -> Iterator[tuple[int, int, np.ndarray, list[str]]]:
        """By falling size, down to one of which an n-gram is held: the size, how many of the
        word's n-grams are held, the sum of their logs, and the n-grams to look up."""
        for size in range(min(self.max_gram, len(word) + 2), 0, -1):
            grams = grams_of(word, size)
            held = [k for g in grams if (k := self.grams.get(g)) is not None]
            missing = [] if self.all_grams else [g for g in grams if g not in self.grams]
            if held or missing:
                yield size, len(held), self.gram_logs[held].sum(axis=0), missing
            if held:
                return


class LanguageModel:
    """Counts of all words and n-grams per language, and the most frequent for the tasks."""

    def __init__(
        self, words: DataFrame, grams: DataFrame, max_gram: int, max_words: int, max_grams: int
    ):
        by_lang = words.select(F.explode("counts")).groupBy("key").agg(F.sum("value").alias("n"))
        totals = {r["key"]: r["n"] for r in by_lang.collect()}
        self.words, self.grams = words, grams
        self.languages = sorted(totals)
        sums = np.array([totals[lang] for lang in self.languages], np.float64)
        prior = np.log(sums / max(sums.sum(), 1.0)) if len(sums) else sums
        self.word_norms = np.log(sums + SMOOTHING * (words.count() + 1))
        seen, sizes = np.zeros((max_gram, len(sums))), np.zeros((max_gram, 1))
        by_size = grams.select("size", F.explode("counts")).groupBy("size", "key")
        for r in by_size.agg(F.sum("value").alias("n")).collect():
            seen[r["size"] - 1, self.languages.index(r["key"])] = r["n"]
        for r in grams.groupBy("size").agg(F.count("*").alias("n")).collect():
            sizes[r["size"] - 1] = r["n"]
        self.gram_norms = np.log(seen + SMOOTHING * (sizes + 1))
        held = [
            _most_frequent(table.select("token", "counts", "n"), most)
            for table, most in ((words, max_words), (grams, max_grams))
        ]
        self.frequent = _Frequent(
            self.languages,
            prior,
            held[0],
            self.word_norms,
            held[1],
            self.gram_norms,
            len(held[1]) == sizes.sum(),
        )

    def word_logs(self) -> Column:
        """Of a row of the table of words: its log frequency in each language."""
        return F.array(
            *[
                F.log(F.coalesce(F.col("counts")[F.lit(lang)], F.lit(0)) + SMOOTHING) - float(norm)
                for lang, norm in zip(self.languages, self.word_norms, strict=True)
            ]
        )

    def gram_logs(self) -> Column:
        """Of a row of the table of n-grams: its log frequency in each language."""
        norms = [F.array(*map(F.lit, part.tolist()))[F.col("size") - 1] for part in self.gram_norms.T]
        return F.array(
            *[
                F.log(F.coalesce(F.col("counts")[F.lit(lang)], F.lit(0)) + SMOOTHING) - norm
                for lang, norm in zip(self.languages, norms, strict=True)
            ]
        )

    def added(self, logs: Column) -> Column:
        """The sum of arrays with a number for each language."""
        sums = [F.sum(logs[k].cast(EXACT)).cast("double") for k in range(len(self.languages))]
        return F.array(*sums)


def train(
    docs: DataFrame,
    learn: Column,
    *,
    text_col: str = "text",
    lang_col: str = "lang",
    max_gram: int = MAX_GRAM,
    max_words: int = MAX_WORDS,
    max_grams: int = MAX_GRAMS,
) -> LanguageModel:
    """Learn from the rows where `learn` holds and the language is known."""
    ship_package(docs.sparkSession)
    chosen = docs.where(learn & F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()).select(
        F.col(lang_col).alias("lang"), F.col(text_col).alias("text")
    )
    words = _summed(chosen.mapInArrow(_count_words, COUNTS), "words")
    grams = _summed(words.mapInArrow(_count_grams(max_gram), COUNTS), "grams")
    return LanguageModel(words, grams, max_gram, max_words, max_grams)


def _unseen(words: DataFrame, model: LanguageModel, shared: Broadcast) -> DataFrame:
    """(token, logs) of words that training has not seen: means over their longest known
    n-grams; words without one are left out."""

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequent = shared.value
        for batch in batches:
            tokens = batch.column("token").to_pylist()
            rows = [(w, *part) for w in tokens for part in frequent.longest(w)]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([r[0] for r in rows], pa.string()),
                    pa.array([r[1] for r in rows], pa.int32()),
                    pa.array([r[2] for r in rows], pa.int64()),
                    pa.array([r[3] for r in rows], pa.list_(pa.float64())),
                    pa.array([r[4] for r in rows], pa.list_(pa.string())),
                ],
                names=["token", "size", "held", "sums", "missing"],
            )

    schema = "token string, size int, held long, sums array<double>, missing array<string>"
    asked = stored(words.mapInArrow(ask, schema), "grams-asked")
    missing = asked.select("token", F.explode("missing").alias("gram"))
    table = model.grams.select(F.col("token").alias("gram"), "size", model.gram_logs().alias("logs"))
    found = (
        missing.join(table, "gram")
        .groupBy("token", "size")
        .agg(F.count("*").alias("found"), model.added(F.col("logs")).alias("more"))
    )
    both = asked.drop("missing").join(found, ["token", "size"], "left")
    known = F.col("held") + F.coalesce("found", F.lit(0))
    means = F.transform(
        "sums", lambda x, k: (x + F.coalesce(F.get("more", k), F.lit(0.0))) / known
    )
    return (
        both.where(known > 0)
        .groupBy("token")
        .agg(F.max_by(means, F.col("size")).alias("logs"))
    )


def identify(
    docs: DataFrame, model: LanguageModel, *, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Per row: doc_id, lang_pred, score."""
    named = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = named.schema["doc_id"].dataType.simpleString()
    languages = model.languages
    if not languages:
        return named.select("doc_id", F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"))
    keyed = with_row_key(named)
    # Bounded by its stated size; every worker reads it once.
    shared = docs.sparkSession.sparkContext.broadcast(model.frequent)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequent = shared.value
        pairs = pa.list_(pa.struct([("token", pa.string()), ("n", pa.int64())]))
        for batch in batches:
            found = [frequent.read(t.as_py()) for t in batch.column("text")]
            rest = [[{"token": w, "n": n} for w, n in f[2].items()] for f in found]
            yield pa.RecordBatch.from_arrays(
                [
                    *[batch.column(c) for c in ("doc_id", FILE, ROW)],
                    pa.array([f[0] for f in found], pa.bool_()),
                    pa.array([f[1] for f in found], pa.list_(pa.float64())),
                    pa.array(rest, pairs),
                ],
                names=["doc_id", FILE, ROW, "letters", "sums", "rest"],
            )

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs, scores = [], []
            columns = [batch.column(c).to_pylist() for c in ("letters", "sums", "more")]
            for letters, sums, more in zip(*columns, strict=True):
                total = np.array(sums) + (np.array(more) if more else 0.0)
                best = int(np.argmax(total))
                langs.append(languages[best] if letters else UNKNOWN)
                scores.append(float(1.0 / np.exp(total - total[best]).sum()) if letters else 0.0)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(langs, pa.string()), pa.array(scores, pa.float64())],
                names=["doc_id", "lang_pred", "score"],
            )

    schema = (
        f"doc_id {kind}, {FILE} long, {ROW} long, letters boolean, sums array<double>, "
        "rest array<struct<token:string,n:long>>"
    )
    first = stored(keyed.mapInArrow(read, schema), "read")
    rest = first.select(FILE, ROW, F.inline("rest"))
    vocabulary = stored(
        rest.select("token").distinct().join(model.words.select("token", "counts"), "token", "left"),
        "vocabulary",
    )
    known = vocabulary.where("counts IS NOT NULL").select("token", model.word_logs().alias("logs"))
    unseen = _unseen(vocabulary.where("counts IS NULL").select("token"), model, shared)
    logs = stored(known.unionByName(unseen), "logs")
    times = F.transform("logs", lambda x: x * F.col("n"))
    more = (
        rest.join(logs, "token")
        .select(FILE, ROW, times.alias("logs"))
        .groupBy(FILE, ROW)
        .agg(model.added(F.col("logs")).alias("more"))
    )
    summed = first.join(more, [FILE, ROW], "left").select("doc_id", "letters", "sums", "more")
    return summed.mapInArrow(choose, f"doc_id {kind}, lang_pred string, score double")


def language_of(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang"
) -> DataFrame:
    """Learn from all but a fifth of the ids and predict every row."""
    held = held_out(F.col(id_col))
    model = train(docs, ~held, text_col=text_col, lang_col=lang_col)
    found = identify(docs, model, id_col=id_col, text_col=text_col)
    return found.withColumn("held_out", held_out(F.col("doc_id")))
