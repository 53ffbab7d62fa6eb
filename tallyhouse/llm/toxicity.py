"""Toxicity by boosted trees over dense features of a text, with isotonic calibration.

Features are densities per word: insults of a given list, words and word beginnings that
the labelled texts show to be toxic, insults near a second person, capitals, punctuation,
and words in disguise (digits and signs for letters). Trees learn on part of the labelled
rows; an isotonic curve, learned on the rest, turns their output into a probability.

Labels come from at most about `max_rows` labelled rows, chosen by a hash of their id; the
share is stated and the model's size is fixed, everything else covers all rows. Three in
four of the labelled rows teach word lists and trees, the fourth the curve.

Defined results: a null or empty text has all features zero and gets what the model gives
that; ids and labels that are null are not learned from, of several labels of one id the
largest counts; with no toxic or no clean label to learn from every score is the share of
toxic labels seen (0 without labels); repeated rows are all returned; an empty table gives
an empty one; other columns are not read and stay as they are; texts are read whole.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression, IsotonicRegressionModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm.common import crc32_of, free_name, held_out, ship_package, stored

#: Insults to begin with; labelled texts add their own.
LEXICON = (
    "idiot moron stupid dumb fool loser trash garbage scum clown pathetic disgusting worthless "
    "useless hate kill ugly jerk imbecile vermin filth freak creep coward liar shut"
).split()
#: Words that address somebody, in the languages at hand.
SECOND_PERSON = frozenset(
    "you your yours yourself u ur du dich dir dein deine euch ihr tu te toi ton ta tes vous "
    "votre vos usted ustedes ti tus vosotros os".split()
)
#: Signs that stand for letters in disguised words.
DISGUISE = str.maketrans("013457@$!", "oieastasi", "*")
EDGES = "\"'`.,;:!?()[]{}<>|#%&*$-_/\\~^=+…–—«»“”„’‘¡¿"
MAX_ROWS = 40_000
#: Learned words and beginnings, each; their least count in toxic texts; letters of a beginning.
MAX_TOKENS, LEAST_COUNT, LEAST_Z, BEGINNINGS = 2_000, 5, 5.0, (4, 5, 6, 7)
NEAR = 5
HELD = 300_000
FEATURES = (
    "lexicon", "learned", "learned_weight", "beginning", "beginning_weight", "beside_you", "second_person",
    "capitals", "shouted", "punctuation", "exclaimed", "obfuscated", "disguised_insults", "hits", "words",
)

LETTERS = re.compile(r"[^\W\d_]")
MIXED = re.compile(r"[^\W\d_][0-9@$!*]+[^\W\d_]")


def tokens_of(text: str | None) -> list[str]:
    """Lower-case words without the signs around them."""
    return [w for t in (text or "").lower().split() if (w := t.strip(EDGES))]


class Features:
    """Turns a text into its row of numbers; holds the word lists, whose size is bounded."""

    def __init__(self, words: dict[str, float], beginnings: dict[str, float]):
        self.words, self.beginnings = words, beginnings
        self.lexicon = frozenset(LEXICON)
        self.sizes = sorted({len(b) for b in beginnings}, reverse=True)
        self.seen: dict[str, tuple[float, float, float] | None] = {}

    def _weigh(self, word: str) -> tuple[float, float, float] | None:
        """(in the lexicon, learned weight, weight of its longest learned beginning)."""
        begin = 0.0
        for size in self.sizes:
            if len(word) >= size and (found := self.beginnings.get(word[:size])):
                begin = found
                break
        out = (float(word in self.lexicon), self.words.get(word, 0.0), begin)
        return out if any(out) else None

    def row(self, text: str | None) -> list[float]:
        text = text or ""
        tokens = tokens_of(text)
        count = len(tokens)
        if not count:
            return [0.0] * len(FEATURES)
        if len(self.seen) > HELD:
            self.seen.clear()
        seen = self.seen
        for word in set(tokens).difference(seen):
            seen[word] = self._weigh(word)
        hits = [(k, w) for k, w in enumerate(map(seen.__getitem__, tokens)) if w]
        lexicon = sum(w[0] for _, w in hits)
        learned = [w[1] for _, w in hits if w[1]]
        begins = [w[2] for _, w in hits if w[2]]
        persons = SECOND_PERSON.__contains__
        beside = sum(any(map(persons, tokens[max(0, k - NEAR) : k + NEAR + 1])) for k, w in hits if w[0] or w[1])
        second = sum(map(persons, tokens))
        capitals = sum(map(str.isupper, text))
        letters = sum(map(str.isalpha, text)) or 1
        raw = text.split()
        shouted = sum(map(str.isupper, raw))
        signs = sum(map(text.count, ".,;:!?*#$%&|"))
        disguised = [w for w in tokens if not w.isalpha() and MIXED.search(w)]
        insults = sum(w.translate(DISGUISE) in self.lexicon for w in disguised)
        return [
            lexicon / count, len(learned) / count, sum(learned) / count, len(begins) / count, sum(begins) / count,
            beside / count, second / count, capitals / letters, shouted / count, signs / len(text),
            text.count("!") / len(text), len(disguised) / count, insults / count,
            lexicon + len(learned) + len(begins), float(np.log1p(count)),
        ]


def _features(features: Features) -> Column:
    @F.arrow_udf("array<double>")
    def rows(texts: pa.Array) -> pa.Array:
        return pa.array([features.row(t.as_py()) for t in texts], pa.list_(pa.float64()))

    return rows


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held = (Counter(), Counter())

    def flush() -> pa.RecordBatch:
        clean, toxic = held
        words = list(clean.keys() | toxic.keys())
        out = pa.RecordBatch.from_arrays(
            [
                pa.array(words, pa.string()),
                pa.array([toxic[w] for w in words], pa.int64()),
                pa.array([clean[w] for w in words], pa.int64()),
            ],
            names=["token", "toxic", "clean"],
        )
        clean.clear()
        toxic.clear()
        return out

    for batch in batches:
        for text, label in zip(batch.column("text"), batch.column("toxic"), strict=True):
            held[label.as_py()].update(tokens_of(text.as_py()))
        if len(held[0]) + len(held[1]) > HELD:
            yield flush()
    yield flush()


def _weights(
    counts: DataFrame, toxic: int, clean: int, max_tokens: int, least_count: int
) -> dict[str, float]:
    """Log odds of the tokens that are clearly more frequent in toxic texts."""
    t, c = F.col("toxic"), F.col("clean")
    odds = F.log((t + 0.5) / (toxic + 1.0)) - F.log((c + 0.5) / (clean + 1.0))
    z = odds / F.sqrt(1 / (t + 0.5) + 1 / (c + 0.5))
    chosen = (
        counts.where(t >= least_count)
        .select("token", odds.alias("odds"), z.alias("z"))
        .where((F.col("z") >= LEAST_Z) & (F.col("odds") >= 1.0))
        .orderBy(F.col("z").desc(), "token")
        .limit(max_tokens)
    )
    return {r["token"]: r["odds"] for r in chosen.collect()}


class ToxicityModel:
    """A fitted model: word lists, trees and the calibration curve, or a constant."""

    def __init__(
        self,
        features: Features | None,
        trees: GBTClassificationModel | None,
        curve: IsotonicRegressionModel | None,
        constant: float = 0.0,
    ):
        self.features, self.trees, self.curve, self.constant = features, trees, curve, constant

    def score(self, docs: DataFrame, text_col: str = "text", to: str = "score") -> DataFrame:
        """docs with the column `to`: the probability that a text is toxic.

        Columns in between get names that docs does not have.
        """
        ship_package(docs.sparkSession)
        if self.trees is None:
            return docs.withColumn(to, F.lit(float(self.constant)))
        x, y, raw, p, m, s = (free_name(docs, f"__tox_{c}") for c in ("x", "y", "raw", "p", "m", "s"))
        trees = self.trees.copy().setFeaturesCol(x).setPredictionCol(y)
        trees = trees.setRawPredictionCol(raw).setProbabilityCol(p)
        rows = docs.withColumn(x, array_to_vector(_features(self.features)(F.col(text_col))))
        rated = trees.transform(rows).withColumn(m, vector_to_array(p)[1])
        if self.curve is not None:
            rated = self.curve.copy().setFeaturesCol(m).setPredictionCol(s).transform(rated)
        else:
            rated = rated.withColumn(s, F.col(m))
        value = F.least(F.greatest(F.col(s), F.lit(0.0)), F.lit(1.0))
        return rated.withColumn(to, value).drop(x, y, raw, p, m, s)


def fit(
    docs: DataFrame,
    labels: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    max_rows: int = MAX_ROWS,
    max_tokens: int = MAX_TOKENS,
    least_count: int = LEAST_COUNT,
    trees: int = 20,
    depth: int = 4,
    seed: int = 42,
) -> ToxicityModel:
    """Fit on labelled rows that are not held out, about max_rows of them at most.

    Of the words and of the beginnings that these rows show to be toxic, the max_tokens
    clearest are learned, each seen least_count times or more in toxic rows.
    """
    ship_package(docs.sparkSession)
    usable = (
        labels.select(F.col(id_col).alias("__id"), F.col(label_col).cast("int").alias("toxic"))
        .where(F.col("__id").isNotNull() & F.col("toxic").isin(0, 1) & ~held_out(F.col("__id")))
        .groupBy("__id")
        .agg(F.max("toxic").alias("toxic"))
    )
    share = min(1.0, max_rows / max(1, usable.count()))
    bucket = F.pmod(F.xxhash64("__id"), F.lit(1 << 20))
    sample = stored(usable.where(bucket < int(share * (1 << 20))), "labels")
    # At most max_rows rows of two numbers, but for the spread of the hash.
    named = docs.select(F.col(id_col).alias("__id"), F.col(text_col).alias("text"))
    chosen = stored(named.join(F.broadcast(sample), "__id"), "labelled")
    # By the second digit of the checksum, as the first decides what is held out.
    calibrates = F.pmod(F.floor(crc32_of(F.col("__id")) / 5), F.lit(4)) == 0
    learns = chosen.where(~calibrates)
    seen = {r["toxic"]: r["count"] for r in learns.groupBy("toxic").count().collect()}
    if len(seen) < 2:
        return ToxicityModel(None, None, None, 1.0 if seen.get(1) else 0.0)
    words = stored(
        learns.mapInArrow(_count, "token string, toxic long, clean long")
        .groupBy("token")
        .agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean")),
        "words",
    )
    total = words.agg(F.sum("toxic"), F.sum("clean")).first()
    toxic, clean = int(total[0] or 0), int(total[1] or 0)
    sizes = F.array(*[F.lit(n) for n in BEGINNINGS])
    begins = (
        words.withColumn("size", F.explode(sizes))
        .where(F.length("token") > F.col("size"))
        .groupBy(F.col("token").substr(F.lit(1), F.col("size")).alias("token"))
        .agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    )
    features = Features(*(_weights(c, toxic, clean, max_tokens, least_count) for c in (words, begins)))
    rows = stored(
        chosen.select(
            _features(features)(F.col("text")).alias("x"),
            F.col("toxic").cast("double").alias("toxic"),
            calibrates.alias("calibrates"),
        ),
        "features",
    ).withColumn("__tox_x", array_to_vector("x"))
    booster = GBTClassifier(
        featuresCol="__tox_x", labelCol="toxic", predictionCol="__tox_y", maxIter=trees, maxDepth=depth,
        stepSize=0.2, minInstancesPerNode=3, seed=seed, maxMemoryInMB=64,
    )
    booster.setProbabilityCol("__tox_p").setRawPredictionCol("__tox_raw")
    fitted = booster.fit(rows.where(~F.col("calibrates")))
    kept = rows.where("calibrates")
    both = kept.agg(F.countDistinct("toxic")).first()[0] == 2
    curve = None
    if both:
        margin = vector_to_array("__tox_p")[1].alias("__tox_m")
        # Copies have equal margins: they are counted before the curve's shuffle by margin.
        rated = fitted.transform(kept).groupBy(margin, "toxic").agg(
            F.count("*").cast("double").alias("weight")
        )
        curve = IsotonicRegression(
            featuresCol="__tox_m", labelCol="toxic", predictionCol="__tox_s", weightCol="weight"
        ).fit(rated)
    return ToxicityModel(features, fitted, curve)


def toxicity_of(
    docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Per row: doc_id, held_out, score, predicted."""
    model = fit(docs, labels, id_col=id_col, text_col=text_col)
    named = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return model.score(named).select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )
