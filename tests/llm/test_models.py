"""Language identification and toxicity: rules by brute force, quality on held-out rows."""

import math
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from tallyhouse.llm import language, registry, toxicity
from tallyhouse.llm.common import held_out

SMALL = "/root/testdata/sf0.01"


def held(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 5 == 0


WORDS = {"en": "the cat and dog sat here", "de": "der hund und die katze sass", "fr": "le chien et la chatte ici"}


def small_corpus(n=60):
    rows = []
    for i in range(n):
        lang = ("en", "de", "fr")[i % 3]
        words = WORDS[lang].split()
        text = " ".join(words[(i * 7 + k) % len(words)] for k in range(8)) + f" Zz{i}!"
        rows.append((i, text, lang, "s", None))
    return rows


def slow_model(rows):
    """Counts of words and n-grams per language, as sums of log frequencies."""
    words, grams = defaultdict(Counter), defaultdict(Counter)
    for doc_id, text, lang, _, _ in rows:
        if lang is not None and not held(doc_id):
            words[lang].update(language.words_of(text))
    for lang, counts in words.items():
        for w, n in counts.items():
            for size in range(1, 5):
                for g in language.grams_of(w, size):
                    grams[lang][g] += n
    return words, grams


def slow_scores(text, words, grams):
    langs = sorted(words)
    total = {lang: sum(words[lang].values()) for lang in langs}
    every = sum(total.values())
    score = {lang: math.log(total[lang] / every) for lang in langs}
    vocabulary = set().union(*words.values())
    for w in language.words_of(text):
        if w in vocabulary:
            for lang in langs:
                score[lang] += math.log(words[lang][w] + 0.5) - math.log(
                    total[lang] + 0.5 * (len(vocabulary) + 1)
                )
            continue
        for size in range(min(4, len(w) + 2), 0, -1):
            known = set().union(*[{g for g in grams[x] if len(g) == size} for x in langs])
            mine = [g for g in language.grams_of(w, size) if g in known]
            if mine:
                for lang in langs:
                    sums = sum(n for g, n in grams[lang].items() if len(g) == size)
                    logs = [
                        math.log(grams[lang][g] + 0.5) - math.log(sums + 0.5 * (len(known) + 1))
                        for g in mine
                    ]
                    score[lang] += sum(logs) / len(logs)
                break
    return score


def test_scores_by_definition(make):
    rows = small_corpus()
    docs = make(rows)
    unseen = ["die hunde sassen", "chats et chiens", "dogs sat", "the katze", "qqq", "x", "Zz3 dog"]
    asked = make([(i, t, None, None, None) for i, t in enumerate(unseen)])
    model = language.train(docs, ~held_out(F.col("doc_id")))
    words, grams = slow_model(rows)
    found = {r.doc_id: r for r in language.identify(asked, model).collect()}
    for i, text in enumerate(unseen):
        scores = slow_scores(text, words, grams)
        best = max(sorted(scores), key=lambda x: scores[x])
        posterior = 1 / sum(math.exp(s - scores[best]) for s in scores.values())
        assert found[i].score == pytest.approx(posterior, rel=1e-9)
        assert found[i].lang_pred == best or posterior == pytest.approx(0.5, abs=1e-9)


@pytest.mark.parametrize(("max_words", "max_grams"), [(0, 0), (3, 40), (0, 1000)])
def test_what_tasks_hold_does_not_change_the_scores(make, max_words, max_grams):
    rows = small_corpus()
    unseen = ["die hunde sassen", "chats et chiens", "dogs sat", "the katze", "qqq", "x", "Zz3 dog", None, "1"]
    asked = make([(i, t, None, None, None) for i, t in enumerate(unseen)] + [r[:1] + r[1:2] + (None,) * 3 for r in rows])
    learn = ~held_out(F.col("doc_id"))
    docs = make(rows)
    words, grams = slow_model(rows)
    found = language.identify(asked, language.train(docs, learn, max_words=max_words, max_grams=max_grams))
    texts = {(r.doc_id, r.text) for r in asked.collect()}
    expected = Counter()
    for i, text in texts:
        scores = slow_scores(text, words, grams)
        best = max(sorted(scores), key=lambda x: scores[x])
        posterior = 1 / sum(math.exp(s - scores[best]) for s in scores.values())
        letters = any(map(str.isalpha, text or ""))
        expected[i, best if letters else "und", round(posterior if letters else 0.0, 8)] += 1
    assert Counter((r.doc_id, r.lang_pred, round(r.score, 8)) for r in found.collect()) == expected


def test_held_out_rows_teach_nothing(make):
    rows = [(i, "alpha beta", "en", "s", None) for i in range(200) if not held(i)]
    rows += [(i, "alpha beta", "xx", "s", None) for i in range(200) if held(i)]
    found = language.language_of(make(rows)).collect()
    assert {r.lang_pred for r in found} == {"en"}
    assert all(r.held_out == held(r.doc_id) for r in found)


def test_odd_documents_language(make, odd_documents, no_documents):
    rows = language.language_of(odd_documents).collect()
    assert len(rows) == odd_documents.count()
    by_id = {r.doc_id: r for r in rows if r.doc_id is not None}
    assert all(by_id[i].lang_pred == "und" and by_id[i].score == 0 for i in (0, 1, 2, 3))
    assert by_id[7].lang_pred == "en" and all(0 <= r.score <= 1 for r in rows)
    assert language.language_of(no_documents).count() == 0
    nothing = make([(1, "some words", None, None, None), (2, "½ ²", None, None, None)])
    assert {(r.lang_pred, r.score) for r in language.language_of(nothing).collect()} == {("und", 0.0)}


def test_a_bounded_model_keeps_the_most_frequent(make):
    counts = make([("en", f"w{i}", n) for i, n in enumerate([9, 9, 7, 5, 5, 5, 2, 1, 1, 1])], "lang string, token string, n long")

    def kept(most):
        return sorted(n for _, _, n in language._most_frequent(counts, most))

    assert kept(100) == [1, 1, 1, 2, 5, 5, 5, 7, 9, 9]
    assert kept(7) == [2, 5, 5, 5, 7, 9, 9]
    assert kept(6) == [5, 5, 5, 7, 9, 9]
    assert kept(5) == [7, 9, 9] and kept(2) == [9, 9]


def test_language_of_held_out_documents(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "lang")
    found = registry.QUERIES["op5_language"](spark, SMALL).join(docs, "doc_id").where("held_out")
    right, rows = found.agg(F.sum((F.col("lang") == F.col("lang_pred")).cast("int")), F.count("*")).first()
    assert rows > 150 and right / rows > 0.98


def test_features_by_hand():
    features = toxicity.Features({"blorp": 2.0}, {"grun": 1.5})
    names = dict(zip(toxicity.FEATURES, features.row("You IDIOT!! blorp grunting 1d10t fr13nd Ok."), strict=True))
    assert names["lexicon"] == names["learned"] == 1 / 7
    assert names["learned_weight"] == 2 / 7 and names["beginning_weight"] == 1.5 / 7
    assert names["beside_you"] == 2 / 7 and names["second_person"] == 1 / 7
    assert names["shouted"] == 1 / 7 and names["hits"] == 3
    assert names["obfuscated"] == 2 / 7 and names["disguised_insults"] == 1 / 7
    assert features.row(None) == features.row("") == [0.0] * len(toxicity.FEATURES)
    shown = dict(zip(toxicity.FEATURES, features.row("such an id10t st4p1d"), strict=True))
    assert shown["obfuscated"] > 0


def test_toxicity_of_held_out_documents(spark):
    labels = spark.read.parquet(f"{SMALL}/labels.parquet").select("doc_id", "toxic")
    found = registry.QUERIES["op10_toxicity"](spark, SMALL)
    assert found.count() == 1000
    rows = found.join(labels, "doc_id").collect()
    counts = Counter((r.predicted, r.toxic) for r in rows)
    assert counts[1, 1] > 8 * counts[1, 0] and counts[1, 1] > 2 * counts[0, 1]
    assert all(r.predicted == (r.score >= 0.5) and 0 <= r.score <= 1 for r in rows)


def test_columns_of_any_name_survive_scoring(make):
    clean = [(i, f"a quiet text number {i} about gardens", None, None, None) for i in range(120)]
    bad = [(200 + i, f"you are an idiot and a moron {i}", None, None, None) for i in range(60)]
    labels = make([(i, 1, 0) for i in range(120)] + [(200 + i, 0, 1) for i in range(60)], "doc_id long, quality int, toxic int")
    model = toxicity.fit(make(clean + bad), labels)
    names = [f"__tox_{c}" for c in ("x", "y", "raw", "p", "m", "s")]
    schema = "doc_id long, text string, " + ", ".join(f"{n} string" for n in names)
    rows = [(1, "What an idiot you are", *names), (2, "gardens", *names)]
    scored = model.score(make(rows, schema))
    assert scored.columns == ["doc_id", "text", *names, "score"]
    assert [tuple(r)[2:-1] for r in scored.orderBy("doc_id").collect()] == [tuple(names)] * 2
    assert [r.score >= 0.5 for r in scored.orderBy("doc_id").collect()] == [True, False]


def test_learned_words_are_the_clearest_above_the_least_count(make):
    rows = [("aa", 40, 0), ("bb", 30, 0), ("cc", 9, 0), ("dd", 30, 30), ("ee", 0, 90)]
    counts = make(rows, "token string, toxic long, clean long")
    kept = toxicity._weights(counts, 109, 5000, 10, 9)
    odds = {t: math.log((x + 0.5) / 110) - math.log((c + 0.5) / 5001) for t, x, c in rows}
    assert kept == pytest.approx({t: odds[t] for t in kept}) and {"aa", "bb", "dd"} <= set(kept)
    assert "ee" not in kept
    assert set(toxicity._weights(counts, 109, 5000, 1, 9)) == {max(kept, key=lambda t: odds[t] / math.sqrt(1 / (dict((a, b) for a, b, _ in rows)[t] + 0.5) + 1 / (dict((a, c) for a, _, c in rows)[t] + 0.5)))}
    assert not toxicity._weights(counts, 109, 5000, 10, 41)


def test_odd_documents_toxicity(make, odd_documents, no_documents):
    clean = [(i, f"a quiet text number {i} about gardens", None, None, None) for i in range(120)]
    bad = [(200 + i, f"you are an idiot and a moron {i}", None, None, None) for i in range(60)]
    labels = make([(i, 1, 0) for i in range(120)] + [(200 + i, 0, 1) for i in range(60)], "doc_id long, quality int, toxic int")
    model = toxicity.fit(make(clean + bad), labels)
    scored = model.score(odd_documents, to="__s")
    assert scored.columns == [*odd_documents.columns, "__s"]
    rows = scored.collect()
    assert len(rows) == odd_documents.count() and all(r["__s"] < 0.5 for r in rows)
    asked = make([(1, "What an idiot you are", None, None, None), (2, "", None, None, None), (3, "gardens", None, None, None)])
    scores = {r.doc_id: r.score for r in model.score(asked).collect()}
    assert scores[1] >= 0.5 > max(scores[2], scores[3])
    # Nothing to learn from: a constant.
    none = toxicity.toxicity_of(odd_documents, labels.limit(0)).collect()
    assert {(r.score, r.predicted) for r in none} == {(0.0, 0)} and len(none) == len(rows)
    odd_labels = make([(None, 1, 1), (1, None, None), (2, 0, 1), (2, 0, 0)], "doc_id long, quality int, toxic int")
    assert toxicity.toxicity_of(odd_documents, odd_labels).count() == len(rows)
    assert toxicity.toxicity_of(no_documents, labels).count() == 0
