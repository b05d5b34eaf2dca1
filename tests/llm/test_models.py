"""Language identification and the quality classifier on held-out rows."""

import math
import re
import zlib
from collections import Counter

import numpy as np

from meritrix.llm import langid, quality, queries
from meritrix.llm.tasks import fold

SF = "/root/testdata/sf0.01"


def test_fold_is_crc32_of_the_decimal_text(spark):
    got = spark.range(50).selectExpr("id AS doc_id").select("doc_id", fold("doc_id", 5).alias("f")).collect()
    assert all(r.f == zlib.crc32(str(r.doc_id).encode()) % 5 for r in got)


def test_language_of_held_out_rows(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = langid.train(langid.training_rows(docs, fold("doc_id", 4), 2))
    found = langid.predict(docs, model, keep=("lang",)).withColumn("fold", fold("doc_id", 4)).collect()
    held = [r for r in found if r.fold == 2]
    assert len(found) == docs.count() and len(held) > 200
    assert sum(r.lang == r.lang_pred for r in held) / len(held) > 0.98
    assert all(0 <= r.score <= 1 for r in found)


def test_language_of_odd_rows(spark):
    rows = [(1, "the house of the", "en"), (2, "das haus und der", "de"), (3, None, "en"), (4, "x", None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    model = langid.train(docs)
    odd = [(1, None, 1), (2, "", 1), (3, "12 ½ _ !", 1), (4, "the houses", 1), (5, "hausen", 1), (None, "der", 1), (6, "Ж" * 50_000, 1)]
    got = {r.doc_id: r for r in langid.predict(spark.createDataFrame(odd, "doc_id bigint, text string, score int"), model).collect()}
    assert [got[i].lang_pred for i in (1, 2, 3, 4, 5, None)] == ["und", "und", "und", "en", "de", "de"]
    assert got[1].score == 0.0 and got[6].lang_pred in ("de", "en")
    empty = langid.train(docs.where("false"))
    assert {r.lang_pred for r in langid.predict(docs, empty).collect()} == {"und"}
    assert langid.predict(docs.where("false"), model).count() == 0


def test_backoff_goes_from_words_to_shorter_grams():
    scores = np.array([[0, -1], [0, -2], [-3, 0]], np.float32)
    model = langid.Model(["a", "b"], {"word": 0}, {"^wo": 1, "z": 2}, scores)
    assert model.rows(["q", "word", "worn", "q", "zzz", "é"]).tolist() == [[0, 0], [0, -1], [0, -2], [0, 0], [-3, 0], [0, 0]]
    assert model.rows(["q"]).tolist() == [[0, 0]]


def test_isotonic_is_the_best_rising_fit():
    x, y = np.arange(6.0), np.array([0.1, 0.5, 0.3, 0.3, 0.9, 0.8])
    knots, levels = quality.isotonic(x, y, np.ones(6))
    assert np.allclose(levels, [0.1, 1.1 / 3, 0.85]) and np.allclose(knots, [0, 2, 4.5])


def test_partition_sums_equal_the_whole(spark):
    draw = np.random.default_rng(1)
    x, label = draw.normal(size=(60, len(quality.STATISTICS))), draw.integers(0, 2, 60)
    rows = spark.createDataFrame([(a.tolist(), float(b)) for a, b in zip(x, label)], "x array<double>, label double")
    kernel = quality.Kernel.draw(x.mean(axis=0), x.std(axis=0))
    gram, target = quality.normal_equations(rows.repartition(5), kernel)
    z = kernel(x)
    assert np.allclose(gram, z.T @ z) and np.allclose(target, z.T @ label)


def test_quality_of_held_out_rows(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    got = quality.classify(docs, labels, fold_of_id=fold("doc_id", 5), held_out=0, calibration=4)
    rows = got.join(labels, "doc_id").where("held_out").collect()
    assert got.count() == docs.count() and len(rows) > 50
    assert sum(r.predicted == r.quality for r in rows) / len(rows) > 0.93
    good, bad = ([r.score for r in rows if r.quality == q] for q in (1, 0))
    assert np.mean([[a > b for a in good] for b in bad]) > 0.93


def test_quality_of_odd_rows(spark):
    docs = spark.createDataFrame([(i, "word " * i, 1.0) for i in range(20)] + [(None, "x", 1.0), (50, None, 2.0), (3, "twice", 0.0)],
                                 "doc_id bigint, text string, score double")
    labels = spark.createDataFrame([(i, i % 2) for i in range(20)] + [(None, 1), (4, None), (5, 1)], "doc_id bigint, quality int")
    folds = dict(fold_of_id=fold("doc_id", 5), held_out=0, calibration=4)
    got = quality.classify(docs, labels, **folds).collect()
    assert len(got) == 23 and all(0 <= r.score <= 1 for r in got)
    assert [r.held_out for r in got if r.doc_id is None] == [False]
    none = quality.classify(docs, labels.where("false"), **folds).collect()
    assert {r.score for r in none} == {0.5} and {r.predicted for r in none} == {1}
    assert quality.classify(docs.where("false"), labels, **folds).count() == 0


def plain_crc_fold(doc_id, n):
    return zlib.crc32(str(doc_id).encode()) % n


def test_every_quality_score_equals_a_plain_classifier(spark):
    """The same statistics, folds and seed, without Spark: one matrix, one solve, and the
    max-min formula for the isotonic part."""
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect() if r.quality in (0, 1)}
    x = {r.doc_id: np.array(quality.statistics((r.text or "").encode())) for r in docs}
    fits = [(x[i], y) for i, y in labels.items() if i in x and plain_crc_fold(i, 5) not in (0, 4)]
    calibrates = [(x[i], y) for i, y in labels.items() if i in x and plain_crc_fold(i, 5) == 4]
    given, target = np.array([f[0] for f in fits]), np.array([f[1] for f in fits], float)
    mean, deviation = given.mean(axis=0), given.std(axis=0)
    draw = np.random.default_rng(quality.SEED)
    weights = draw.normal(size=(len(mean), quality.FEATURES - 1)) / math.sqrt(len(mean))
    phases = draw.uniform(0, 2 * math.pi, quality.FEATURES - 1)

    def features(rows):
        standard = np.clip((np.array(rows) - mean) / np.where(deviation > 1e-9, deviation, 1.0), -5, 5)
        return np.hstack([math.sqrt(2 / (quality.FEATURES - 1)) * np.cos(standard @ weights + phases), np.ones((len(rows), 1))])

    z = features(given)
    penalty = np.eye(quality.FEATURES) * (quality.PENALTY * len(fits) + 1e-9)
    penalty[-1, -1] = 1e-9
    ridge = np.linalg.solve(z.T @ z + penalty, z.T @ target)

    raw = features([c[0] for c in calibrates]) @ ridge
    bins = np.clip(np.floor((raw + 0.5) / 2.0 * quality.BINS), 0, quality.BINS - 1)
    points = [(raw[bins == b].mean(), np.array([c[1] for c in calibrates])[bins == b].mean(), (bins == b).sum()) for b in np.unique(bins)]
    at, means, n = map(np.array, zip(*points))
    average = lambda values, j, k: (values * n)[j:k + 1].sum() / n[j:k + 1].sum()
    size = range(len(at))
    levels = np.array([max(min(average(means, j, k) for k in size if k >= i) for j in size if j <= i) for i in size])
    pools = [np.flatnonzero(np.isclose(levels, v, atol=1e-12)) for v in sorted(set(np.round(levels, 12)))]
    knots = [average(at, p[0], p[-1]) for p in pools]
    want = np.clip(np.interp(features([x[r.doc_id] for r in docs]) @ ridge, knots, [levels[p[0]] for p in pools]), 0, 1)

    got = {r.doc_id: r for r in queries.op1_quality(spark, SF).collect()}
    assert len(got) == len(docs)
    for r, score in zip(docs, want):
        found = got[r.doc_id]
        assert abs(found.score - score) < 1e-6, r.doc_id
        assert found.held_out == (plain_crc_fold(r.doc_id, 5) == 0)
        assert found.predicted == (found.score >= 0.3)


def test_every_language_equals_a_plain_model(spark):
    """Plain counters and loops over the same tables."""
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    word_counts, gram_counts = {}, {}
    for r in docs:
        if plain_crc_fold(r.doc_id, 4) != 2 and r.lang is not None and r.text is not None:
            for word in re.findall(r"[^\W\d_]+", r.text.lower()):
                word_counts.setdefault(word, Counter())[r.lang] += 1
    totals = Counter()
    for word, by_lang in word_counts.items():
        totals.update(by_lang)
        marked = f"^{word}$"
        for length in range(1, langid.LONGEST + 1):
            for i in range(len(marked) - length + 1):
                gram_counts.setdefault(marked[i:i + length], Counter()).update(by_lang)

    def largest(counts, size):
        return dict(sorted(counts.items(), key=lambda c: (-sum(c[1].values()), c[0].encode()))[:size])

    words, grams = largest(word_counts, langid.WORDS), largest(gram_counts, langid.GRAMS)
    gram_totals, langs = Counter(), sorted(totals)
    for by_lang in grams.values():
        gram_totals.update(by_lang)

    def logs(by_lang, sums, size):
        row = [math.log((by_lang[x] + 0.5) / (sums[x] + 0.5 * size)) for x in langs]
        return [v - max(row) for v in row]

    cache = {}

    def scored(word):
        if word in words:
            return logs(words[word], totals, len(words))
        marked = f"^{word}$"
        for length in range(langid.LONGEST, 0, -1):
            known = [g for i in range(len(marked) - length + 1) if (g := marked[i:i + length]) in grams and g not in ("^", "$")]
            if known:
                return [sum(c) / len(known) for c in zip(*(logs(grams[g], gram_totals, len(grams)) for g in known))]
        return [0.0] * len(langs)

    got = {r.doc_id: r for r in queries.op9_language(spark, SF).collect()}
    assert len(got) == len(docs)
    for r in docs:
        found, sums = got[r.doc_id], [0.0] * len(langs)
        given = re.findall(r"[^\W\d_]+", (r.text or "").lower())
        for word in given:
            if word not in cache:
                cache[word] = scored(word)
            sums = [a + b for a, b in zip(sums, cache[word])]
        best = max(range(len(langs)), key=lambda i: sums[i])
        if not given:
            assert (found.lang_pred, found.score) == ("und", 0.0)
            continue
        assert found.lang_pred == langs[best]
        assert abs(found.score - 1 / sum(math.exp(min(0.0, s - sums[best])) for s in sums)) < 1e-3
        assert found.held_out == (plain_crc_fold(r.doc_id, 4) == 2)


def test_very_long_texts(spark):
    """One text of two million words, one of a single word of two megabytes."""
    rows = [(1, "the house was good. " * 500_000), (2, "x" * 2_000_000), (3, "the house"), (None, None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    model = langid.train(spark.createDataFrame([("the house was good", "en"), ("das haus war gut", "de")], "text string, lang string"))
    got = {r.doc_id: r.lang_pred for r in langid.predict(docs, model).collect()}
    assert got[1] == got[3] == "en" and got[None] == "und"
    assert {r.doc_id for r in quality.with_statistics(docs).collect()} == {1, 2, 3, None}
