"""Toxicity and language predictions against plain versions, step by step."""

import math
import random
from collections import Counter

import numpy as np
import pytest

from cellforge.llm import hyperlang, ordinal
from tests.llm.conftest import prose

INSULTS = ["scum", "scummy", "moron", "vermin"]


def documents():
    rng = random.Random(11)
    rows = []
    for i in range(240):
        words = prose(i, 10 + i % 40).split()
        if i % 4 == 0:
            for _ in range(1 + i % 12):
                words.insert(rng.randrange(len(words)), rng.choice(INSULTS))
        rows.append((i, " ".join(words), int(i % 4 == 0)))
    return rows + [(900, None, 0), (901, "", 1)]


def plain_toxicity(rows):
    """(weights, thresholds) of the labelled ``rows``: every text is in the sample."""
    having = {0: Counter(), 1: Counter()}
    for _, text, toxic in rows:
        having[toxic].update(set(ordinal.feature_counts(text)))
    n = Counter(toxic for *_, toxic in rows)
    chosen = []
    for f, a in having[1].items():
        b = having[0][f]
        odds = math.log((a + 0.5) / (n[1] + 1)) - math.log((b + 0.5) / (n[0] + 1))
        if a >= max(ordinal.LEAST_DOCS, ordinal.LEAST_SHARE * n[1]) and odds - ordinal.SURE * math.sqrt(1 / (a + 0.5) + 1 / (b + 0.5)) > math.log(ordinal.LEAST_ODDS):
            chosen.append((-odds * math.sqrt(a), f))
    names = [f for _, f in sorted(chosen)[: ordinal.MOST_FEATURES]]
    x = np.array([[math.log1p(ordinal.feature_counts(text)[f]) for f in names] for _, text, _ in rows], dtype=np.float32)
    y = []
    for _, text, toxic in rows:
        telling = sum(c for f, c in ordinal.feature_counts(text).items() if f in names and not f.endswith("~"))
        y.append(0 if not toxic else 1 + sum(telling >= g for g in ordinal.GRADE_COUNTS))
    w, thresholds = ordinal.fit_ordinal(x, np.array(y), len(ordinal.GRADE_COUNTS) + 1)
    return dict(zip(names, w)), thresholds


def test_toxicity_features_and_scores(spark):
    rows = documents()
    frame = spark.createDataFrame(rows, "doc_id long, text string, toxic int").repartition(4)
    model = ordinal.fit_toxicity(frame, frame)
    weights, thresholds = plain_toxicity(rows)
    kept = {f: w for f, w in weights.items() if abs(w) > 1e-6}
    assert set(model.weights) == set(kept) and set(INSULTS) & set(kept)
    assert all(model.weights[f] == pytest.approx(w, rel=1e-3, abs=1e-4) for f, w in kept.items())
    assert model.thresholds == pytest.approx(list(thresholds), rel=1e-3, abs=1e-3)
    for r in ordinal.score_toxicity(frame, model).collect():
        s = sum(model.weights.get(f, 0.0) * math.log1p(c) for f, c in ordinal.feature_counts(r["text"]).items())
        above = [1 / (1 + math.exp(t - s)) for t in model.thresholds]
        shares = [1 - above[0], *[a - b for a, b in zip(above, [*above[1:], 0.0])]]
        assert r["toxic_odds"] == pytest.approx(above[0], abs=1e-9) and r["severity"] == pytest.approx(sum(above), abs=1e-9)
        assert shares[r["grade"]] == pytest.approx(max(shares))


def test_toxicity_sample_is_bounded_in_rows(spark, monkeypatch):
    monkeypatch.setattr(ordinal, "MOST_TOXIC", 7)
    monkeypatch.setattr(ordinal, "MOST_CLEAN", 9)
    rows = [(1, f"scum {prose(i, 5)}") for i in range(60)] + [(2, "one text")] * 40 + [(i, prose(i, 5)) for i in range(3, 40)]
    labels = spark.createDataFrame([(1, 1)] + [(i, 0) for i in range(2, 40)], "doc_id long, toxic int")
    sample = ordinal._sample(spark.createDataFrame(rows, "doc_id long, text string"), labels, "doc_id", "text", "toxic").collect()
    kinds = Counter(r["toxic"] for r in sample)
    assert kinds == {True: 7, False: 9} and len({(r["id"], r["text"]) for r in sample}) == 16


def test_language_predictions(spark):
    rng = random.Random(3)
    alphabets = {"aa": "abcdeé", "bb": "fghijk", "cc": "abfglß"}
    rows = []
    for i in range(90):
        lang = list(alphabets)[i % 3]
        text = " ".join("".join(rng.choice(alphabets[lang]) for _ in range(rng.randrange(1, 7))) for _ in range(rng.randrange(1, 30)))
        rows.append((i, text.upper() if i % 5 == 0 else text, lang))
    rows += [(100, "12 34", "aa"), (101, None, "bb"), (102, "zzz", None), (103, "a", "aa")]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3)
    model = hyperlang.fit_prototypes(frame.where("doc_id % 2 = 0"))
    encoder = hyperlang.Encoder(hyperlang.DIMS)

    def bundle(text):
        return sum((encoder.vector(int(g)).astype(np.float64) for g in hyperlang.grams_of(text)), np.zeros(hyperlang.DIMS))

    sums = {lang: sum(bundle(t) for i, t, x in rows if i % 2 == 0 and x == lang and t) for lang in alphabets}
    assert model.langs == tuple(sorted(sums))
    for r in hyperlang.identify(frame, model).collect():
        mine = bundle(r["text"])
        if not mine.any():
            assert (r["lang_pred"], r["score"]) == ("und", 0.0)
            continue
        cosine = {lang: mine @ s / np.linalg.norm(mine) / np.linalg.norm(s) for lang, s in sums.items()}
        best = max(cosine.values())
        assert cosine[r["lang_pred"]] == pytest.approx(best, abs=1e-6) and r["score"] == pytest.approx((1 + best) / 2, abs=1e-6)
