"""Toxicity by cumulative-link ordinal regression.

The severity y of a document is a grade 0 to K.  One weight vector over sparse text
features and K ordered thresholds give P(y <= k) = sigmoid(threshold_k - w.x); the expected
severity is sum over k of P(y > k).

Features are lower-cased words and their beginnings (stems of 4 and 5 letters).  The model
keeps the features that are much commoner in the toxic texts of the training sample, with
weights of 0 or more, so a long clean text cannot outweigh an insult; x is log(1 + count).

Labels only say toxic or not, so toxic training documents are graded by how many telling
words they have (``GRADE_COUNTS``): grade 1 below the first number, up to K from the last.

The training sample is bounded by ``MOST_CLEAN`` and ``MOST_TOXIC`` labelled documents, the
first by a hash of the id; all documents are scored, on whole texts.

Defined cases: a null text or one without words has no features; labels that are null
teach nothing; a document labelled twice is toxic if one label says so; without both toxic
and clean training documents every severity is 0; repeated rows are scored each; an empty
table gives an empty table.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellforge.llm.tables import stash, unused

MOST_CLEAN, MOST_TOXIC = 5000, 3000
MOST_FEATURES = 2000
LEAST_DOCS, LEAST_SHARE = 3, 0.005  # of the toxic sample documents have a chosen feature, at least
LEAST_ODDS, SURE = 6.0, 1.28  # odds of a chosen feature in toxic texts, less so many standard errors
STEMS = (4, 5)
GRADE_COUNTS = (3, 10)  # telling words; grades 1, 2, 3
REJECT = 0.5  # probability of any toxicity from which a document is rejected

TOKEN = re.compile(r"[^\W\d_]+")


def feature_counts(text: str | None) -> Counter:
    """Words and stems (marked by ``~``) of a whole text with their counts."""
    words = Counter(TOKEN.findall((text or "").lower()))
    found = Counter(words)
    for word, n in words.items():
        for k in STEMS:
            if len(word) >= k:
                found[f"{word[:k]}~"] += n
    return found


@dataclass(frozen=True)
class OrdinalModel:
    weights: dict[str, float]
    thresholds: tuple[float, ...]

    def scorer(self):
        """text -> w.x, looking words up once for each distinct word."""
        weights, known = self.weights, {}

        def parts(word: str) -> tuple[str, ...]:
            return tuple(f for f in (word, *(f"{word[:k]}~" for k in STEMS if len(word) >= k)) if f in weights)

        def score(text: str | None) -> float:
            counts: dict[str, int] = {}
            for word, n in Counter(TOKEN.findall((text or "").lower())).items():
                found = known.get(word)
                if found is None:
                    if len(known) > 500_000:  # bounds what a task keeps
                        known.clear()
                    found = known[word] = parts(word)
                for f in found:
                    counts[f] = counts.get(f, 0) + n
            return float(sum(weights[f] * np.log1p(n) for f, n in counts.items()))

        return score

    def grade_odds(self, scores: np.ndarray) -> np.ndarray:
        """P(y > k) for each score and threshold."""
        with np.errstate(over="ignore"):  # an infinite threshold gives 0
            return 1.0 / (1.0 + np.exp(np.array(self.thresholds)[None, :] - scores[:, None]))


def fit_ordinal(x: np.ndarray, y: np.ndarray, grades: int, prior: float = 5.0, rounds: int = 300) -> tuple[np.ndarray, np.ndarray]:
    """(weights, thresholds) of the cumulative-link model by Adam on the mean negative
    log-likelihood; thresholds stay ordered as a first value and positive steps, weights 0 or more.
    ``prior``: precision of the weights' Gaussian prior, which counts less the larger the
    sample."""
    n, d = x.shape
    w, first, steps = np.zeros(d), 1.0, np.zeros(grades - 1)
    share = np.array([max((y == g).mean(), 1e-9) for g in range(grades + 1)])
    cost = (1.0 / np.sqrt(share))[y]  # rare grades count more
    cost /= cost.sum()
    m, v = np.zeros(d + grades), np.zeros(d + grades)
    for t in range(1, rounds + 1):
        theta = first + np.concatenate(([0.0], np.cumsum(np.exp(steps))))
        above = np.concatenate(([-np.inf], theta, [np.inf]))
        s = x @ w
        hi, lo = _sigmoid(above[y + 1] - s), _sigmoid(above[y] - s)
        p = np.maximum(hi - lo, 1e-12)
        dhi, dlo = hi * (1 - hi), lo * (1 - lo)
        gs = cost * (dhi - dlo) / p  # of the loss by s
        g_theta = np.array([-(cost * dhi / p)[y == k].sum() + (cost * dlo / p)[y == k + 1].sum() for k in range(grades)])
        g = np.concatenate((x.T @ gs + prior / n * w, [g_theta.sum()], np.exp(steps) * np.cumsum(g_theta[::-1])[::-1][1:]))
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        move = 0.05 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-9)
        w, first, steps = np.maximum(w - move[:d], 0.0), first - move[d], np.clip(steps - move[d + 1 :], -5, 5)
    return w, first + np.concatenate(([0.0], np.cumsum(np.exp(steps))))


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(z, -500, 500)))


def _sample(docs: DataFrame, labels: DataFrame, key: str, text: str, toxic: str) -> DataFrame:
    """The training sample, ``id, text, toxic``: MOST_TOXIC and MOST_CLEAN rows at most."""
    told = labels.where(F.col(toxic).isNotNull()).groupBy(F.col(key).alias("id")).agg((F.max(toxic) > 0).alias("toxic"))
    order = [F.xxhash64("id"), F.col("id")]
    first = told.where("toxic").orderBy(*order).limit(MOST_TOXIC).unionByName(told.where("not toxic").orderBy(*order).limit(MOST_CLEAN))
    rows = docs.select(F.col(f"`{key}`").alias("id"), F.col(f"`{text}`").alias("text"), F.xxhash64(F.col(f"`{text}`")).alias("h"))
    # An id may have many rows: texts are chosen by their hashes, in the same order, and then fetched.
    texts = stash(rows.select("id", "h").join(first, "id").distinct(), "toxicity-rows")
    picked = [texts.where(kind).orderBy(*order, "h").limit(most) for kind, most in (("toxic", MOST_TOXIC), ("not toxic", MOST_CLEAN))]
    return rows.join(picked[0].unionByName(picked[1]), ["id", "h"]).dropDuplicates(["id", "h"]).drop("h")


def fit_toxicity(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", toxic: str = "toxic") -> OrdinalModel:
    """Fits the model on the bounded sample.  Feature statistics are counted by Spark; the
    chosen features' counts (at most MOST_FEATURES x the sample) reach the driver."""
    sample = stash(_sample(docs, labels, key, text, toxic), "toxicity-sample")

    def stats(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        having = {True: Counter(), False: Counter()}
        for frame in frames:
            for t, kind in zip(frame["text"], frame["toxic"]):
                having[bool(kind)].update(feature_counts(t).keys())
        toxic_docs, clean_docs = having[True], having[False]
        rows = [(f, toxic_docs[f], clean_docs[f]) for f in toxic_docs.keys() | clean_docs.keys()]
        yield pd.DataFrame(rows, columns=["feature", "a", "b"])

    sizes = {r["toxic"]: r["n"] for r in sample.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    n_toxic, n_clean = sizes.get(True, 0), sizes.get(False, 0)
    if not n_toxic or not n_clean:
        return OrdinalModel({}, (np.inf,) * (len(GRADE_COUNTS) + 1))
    summed = sample.mapInPandas(stats, "feature string, a long, b long").groupBy("feature").agg(F.sum("a").alias("a"), F.sum("b").alias("b"))
    odds = F.log((F.col("a") + 0.5) / (n_toxic + 1.0)) - F.log((F.col("b") + 0.5) / (n_clean + 1.0))
    sure = F.col("odds") - F.lit(SURE) * F.sqrt(1.0 / (F.col("a") + 0.5) + 1.0 / (F.col("b") + 0.5))
    telling = summed.where(F.col("a") >= max(LEAST_DOCS, LEAST_SHARE * n_toxic)).withColumn("odds", odds).where(sure > float(np.log(LEAST_ODDS)))
    chosen = telling.orderBy(F.desc(F.col("odds") * F.sqrt("a")), "feature").limit(MOST_FEATURES).toPandas()
    place = {f: i for i, f in enumerate(chosen["feature"])}

    def cells_of(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for row, t in zip(frame["row"], frame["text"]):
                out += [(row, place[f], n) for f, n in feature_counts(t).items() if f in place]
            yield pd.DataFrame(out, columns=["row", "place", "n"])

    # Rows of the sample are numbered by id and text, so the matrix is the same in any run.
    keyed = sample.withColumn("row", F.xxhash64("id", "text"))
    listed = keyed.select("row", "toxic").orderBy("row").toPandas()  # bounded, as the sample
    cells = keyed.select("row", "text").mapInPandas(cells_of, "row long, place int, n long").toPandas()
    doc = pd.Series(np.arange(len(listed)), index=listed["row"]).groupby(level=0).first()
    r, c, n = doc.loc[cells["row"]].to_numpy(), cells["place"].to_numpy(), cells["n"].to_numpy()
    x = np.zeros((len(listed), len(place)), dtype=np.float32)
    x[r, c] = np.log1p(n)
    many, whole = np.zeros(len(listed)), ~chosen["feature"].str.endswith("~").to_numpy(dtype=bool)
    np.add.at(many, r[whole[c]], n[whole[c]])
    grades = 1 + np.searchsorted(np.array(GRADE_COUNTS), many, side="right")
    y = np.where(listed["toxic"].to_numpy(), grades, 0)
    w, thresholds = fit_ordinal(x, y, len(GRADE_COUNTS) + 1)
    return OrdinalModel({f: float(w[i]) for f, i in place.items() if abs(w[i]) > 1e-6}, tuple(float(t) for t in thresholds))


def score_toxicity(docs: DataFrame, model: OrdinalModel, text: str = "text") -> DataFrame:
    """``docs`` with ``toxic_odds`` (of any toxicity), ``severity`` (expected grade) and
    ``grade`` (the likeliest), replaced if there."""

    @F.pandas_udf("toxic_odds double, severity double, grade int")
    def scored(series: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        score = model.scorer()
        for texts in series:
            above = model.grade_odds(np.array([score(t) for t in texts], dtype=float))
            grades = -np.diff(np.concatenate((np.ones((len(above), 1)), above, np.zeros((len(above), 1))), axis=1), axis=1)
            yield pd.DataFrame({"toxic_odds": above[:, 0], "severity": above.sum(axis=1), "grade": grades.argmax(axis=1).astype("int32")})

    s = unused(docs, "_s")
    whole = docs.withColumn(s, scored(F.col(f"`{text}`")))
    for c in ("toxic_odds", "severity", "grade"):
        whole = whole.withColumn(c, F.col(f"{s}.{c}"))
    return whole.drop(s)
