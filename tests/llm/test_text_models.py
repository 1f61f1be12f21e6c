import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from cellforge.llm import hyperlang, lm, ordinal
from cellforge.llm.queries import QUERIES
from cellforge.llm.trie import EliasFano, Trie, dequantise
from tests.conftest import SF_SMALL
from tests.llm.conftest import edge_rows

MID = SF_SMALL.replace("0.001", "0.01")


# --- trie and language model --------------------------------------------------------


@pytest.mark.parametrize("n,top", [(0, 5), (1, 1), (1, 10**9), (5, 3), (1000, 10), (1000, 10**6), (5000, 2**40)])
def test_elias_fano(n, top):
    rng = np.random.default_rng(n)
    values = np.sort(rng.integers(0, top, n))
    seq, _ = EliasFano.open(EliasFano.encode(values), 0)
    assert (seq.get(np.arange(n)) == values).all()
    if n:
        ask = np.concatenate((values, rng.integers(0, top + 5, 300)))
        _, found = seq.successor(ask, np.zeros(len(ask), dtype=int), np.full(len(ask), n))
        assert (found == np.isin(ask, values)).all()


def test_trie_lookup():
    rng = np.random.default_rng(0)
    keys = np.unique((rng.zipf(1.3, 30_000) % 500).astype(np.int64) << 32 | (rng.zipf(1.2, 30_000) % 20_000))
    kept, log10 = keys[::2], -rng.random(len(keys[::2])) * 8
    trie = Trie.mapped(Trie.encode(kept >> 32, kept & 0xFFFFFFFF, log10))
    codes = trie.lookup(keys >> 32, keys & 0xFFFFFFFF)
    assert ((codes > 0) == np.isin(keys, kept)).all()
    assert np.abs(dequantise(codes[codes > 0]) - log10).max() < 1e-4
    none = Trie.mapped(Trie.encode(keys[:0], keys[:0], log10[:0]))
    assert (none.lookup(keys >> 32, keys & 0xFFFFFFFF) == 0).all()


def brute_scores(rows, mu, order=2):
    texts = [[*(t or "").encode().lower().split(), 0] for _, t, _ in rows]
    c, grams, contexts = Counter(), Counter(), Counter()
    for line, (_, _, train) in zip(texts, rows):
        if train:
            c.update(line)
            whole = [1, *line]
            for k in range(2, order + 1):
                for at in range(len(whole) - k + 1):
                    grams[tuple(whole[at : at + k])] += 1
                    contexts[tuple(whole[at : at + k - 1])] += 1
    n, v = sum(c.values()), len(c)
    out = []
    for line in texts:
        base = sum(math.log10((c[w] + 1) / (n + v + 1)) for w in line)
        score, whole = 0.0, [1, *line]
        for at in range(1, len(whole)):
            p = (c[whole[at]] + 1) / (n + v + 1)
            for k in range(2, min(order, at + 1) + 1):
                h = tuple(whole[at - k + 1 : at])
                if contexts[h]:
                    p = (grams[(*h, whole[at])] + mu * p) / (contexts[h] + mu)
            score += math.log10(p)
        out.append((len(line), sum(c[w] > 0 for w in line), n, base, score))
    return out


@pytest.mark.parametrize("chunk,shard,order", [(2_500_000, 2_000_000, 2), (300, 400, 2), (2_500_000, 2_000_000, 3), (300, 400, 3), (500, 300, 4)])
def test_scores_by_brute_force(spark, clashing, monkeypatch, chunk, shard, order):
    monkeypatch.setattr(lm, "CHUNK", chunk)
    monkeypatch.setattr(lm, "SHARD", shard)
    rows = [(r[0], r[1], i % 3 != 0) for i, r in enumerate(edge_rows()) if r[1] is None or len(r[1]) < 50_000]
    frame = spark.createDataFrame(rows, "doc_id long, text string, train boolean").repartition(3)
    got = lm.score_documents(frame, "train", order=order).toPandas()
    rank = lambda x: (-1 if x[0] is None or x[0] != x[0] else x[0], x[1], round(x[2], 6))
    have = sorted(((r.doc_id, r.n_tokens, r.base_score, r.n_known, r.train_tokens, r.score) for r in got.itertuples()), key=rank)
    want = sorted(((r[0], b[0], b[3], b[1], b[2], b[4]) for r, b in zip(rows, brute_scores(rows, lm.MU, order))), key=rank)
    assert len(have) == len(want)
    for a, b in zip(have, want):
        assert (a[1], a[3], a[4]) == (b[1], b[3], b[4]) and a[2] == pytest.approx(b[2]) and a[5] == pytest.approx(b[5], rel=1e-3, abs=1e-3)


def test_lm_edges(spark, nothing, clashing):
    whole = lm.score_documents(clashing.withColumn("train", F.lit(True)), "train").toPandas()
    assert len(whole) == len(edge_rows()) and (whole["score"] <= 0).all()
    untaught = lm.score_documents(clashing.withColumn("train", F.lit(None).cast("boolean")), "train").toPandas()
    assert (untaught["score"] == 0).all() and (untaught["n_known"] == 0).all() and (untaught["train_tokens"] == 0).all()
    for order in (2, 3):
        assert lm.score_documents(nothing.withColumn("train", F.lit(True)), "train", order=order).count() == 0
    with pytest.raises(ValueError):
        lm.score_documents(nothing.withColumn("train", F.lit(True)), "train", order=1)


def test_lm_third_level_tells_what_pairs_cannot(spark):
    """x y is followed by 1, z y by 2: only the third level knows which."""
    taught = [(i, "x y 1" if i % 2 else "z y 2", True) for i in range(1000)]
    asked = [(2000, "x y 1", False), (2001, "x y 2", False)]
    frame = spark.createDataFrame(taught + asked, "doc_id long, text string, train boolean")
    told = {k: lm.score_documents(frame, "train", order=k).where("doc_id >= 2000").toPandas().set_index("doc_id")["score"] for k in (2, 3)}
    assert abs(told[2][2000] - told[2][2001]) < 0.01 and told[3][2000] - told[3][2001] > 0.5


def test_lm_beats_the_base_on_held_out(spark):
    out = QUERIES["op6_lm_scoring"](spark, MID).toPandas()
    held = out[out["held_out"]]
    assert held["score"].sum() > held["base_score"].sum() and len(out) == spark.read.parquet(f"{MID}/documents.parquet").count()
    assert list(out["held_out"]) == [zlib.crc32(str(i).encode()) % 7 == 2 for i in out["doc_id"]]


# --- language identification --------------------------------------------------------


@pytest.mark.parametrize("text", ["a", "", " a", "..a..b", "Étre de.. ", "  --", "1a2b33c", "İx", "日本 語", " é"])
def test_letter_codes(text):
    plain = "".join(c if c.isalpha() else "\0" for c in text.lower())
    want = re.sub("\0+", "\0", f"\0{plain}\0") if any(c.isalpha() for c in text.lower()) else ""
    assert hyperlang.letter_codes(text).tolist() == [ord(c) for c in want]


def test_bundles_are_sums_of_gram_vectors(monkeypatch):
    monkeypatch.setattr(hyperlang, "KNOWN_GRAMS", 5)
    encoder = hyperlang.Encoder(64)
    texts = ["banana band", "an ananas", "", "xyz"]
    grams = [hyperlang.grams_of(t) for t in texts]
    got = encoder.bundles(grams)
    for row, g in zip(got, grams):
        want = sum((encoder.vector(x) for x in g.tolist()), np.zeros(64, dtype=np.float32))
        assert np.allclose(row, want)


def test_language_held_out_accuracy(spark):
    out = QUERIES["op10_language"](spark, MID).toPandas()
    docs = spark.read.parquet(f"{MID}/documents.parquet").toPandas()
    both = out.merge(docs, on="doc_id")
    held = both[both["held_out"]]
    assert len(out) == len(docs) and (held["lang_pred"] == held["lang"]).mean() > 0.97
    assert list(out["held_out"]) == [zlib.crc32(str(i).encode()) % 4 == 2 for i in out["doc_id"]]


def test_language_edges(edges, clashing, nothing):
    model = hyperlang.fit_prototypes(edges)
    assert model.langs == ("en", "fr")
    out = hyperlang.identify(clashing, model).toPandas()
    assert len(out) == len(edge_rows()) and out["score"].between(0, 1).all()
    assert set(out.loc[out["doc_id"].isin([0, 2, 3]), "lang_pred"]) == {"und"}
    assert "und" not in set(out.loc[out["doc_id"].isin([4, 7, 8]), "lang_pred"])
    untaught = hyperlang.fit_prototypes(nothing)
    assert set(r["lang_pred"] for r in hyperlang.identify(edges, untaught).collect()) == {"und"}
    assert hyperlang.identify(nothing, model).count() == 0


# --- toxicity -----------------------------------------------------------------------


def test_cumulative_link_recovers_order():
    rng = np.random.default_rng(1)
    x = rng.random((6000, 4)).astype(np.float32) * 3
    w, theta = np.array([2.0, 1.0, 0.0, 0.5]), np.array([2.0, 4.0, 7.0])
    y = (rng.random((6000, 1)) < 1 / (1 + np.exp(theta[None, :] - (x @ w)[:, None]))).cumprod(axis=1).sum(axis=1)
    got, thresholds = ordinal.fit_ordinal(x, y, 3)
    assert (np.diff(thresholds) > 0).all() and (got >= 0).all()
    assert np.corrcoef(x @ got, x @ w)[0, 1] > 0.99
    odds = ordinal.OrdinalModel({}, tuple(thresholds)).grade_odds(np.array([0.0, 5.0, 20.0]))
    assert (np.diff(odds, axis=1) <= 0).all() and (np.diff(odds.sum(axis=1)) > 0).all()


def test_toxic_documents_are_told(spark):
    rows = [(i, " ".join(["plain words here and there"] * (1 + i % 9)) + (" you utter " + ["scum", "scummy", "moron"][i % 3] if i % 5 == 0 else ""), int(i % 5 == 0))
            for i in range(300)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    model = ordinal.fit_toxicity(frame.where("doc_id < 200"), frame)
    out = ordinal.score_toxicity(frame, model).toPandas()
    assert ((out["toxic_odds"] >= ordinal.REJECT) == (out["toxic"] == 1)).all()
    assert out.loc[out["toxic"] == 1, "severity"].min() > out.loc[out["toxic"] == 0, "severity"].max()


def test_toxicity_edges(spark, edges, clashing, nothing):
    labels = spark.createDataFrame([(100, 1), (100, 0), (101, 0), (102, None), (None, 1)], "doc_id long, toxic int")
    model = ordinal.fit_toxicity(edges, labels)
    out = ordinal.score_toxicity(clashing, model).toPandas()
    assert len(out) == len(edge_rows()) and (out["severity"] >= 0).all()
    untaught = ordinal.fit_toxicity(edges, labels.limit(0))
    none = ordinal.score_toxicity(edges, untaught).toPandas()
    assert (none["severity"] == 0).all() and (none["grade"] == 0).all()
    assert ordinal.score_toxicity(nothing, model).count() == 0
    assert ordinal.fit_toxicity(nothing, labels).weights == {}
