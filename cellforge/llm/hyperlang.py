"""Language identification with hyperdimensional profiles.

Every letter (and the word gap) has a random vector of +1 and -1, drawn from its code point.
A letter n-gram is the product of its letters' vectors, each permuted (rotated) by its
place.  A document bundles (adds) the vectors of its n-grams; a language's prototype bundles
its training documents.  The prediction is the language whose prototype has the largest
cosine with the document.

The prototypes are exact integer sums, made in two steps without a language in one task:
each task bundles what it reads, and (language, dimension) sums are added up by Spark.  The
model is languages x dimensions numbers.

Defined cases: a null text or one without a letter is ``und`` with score 0; letter case is
folded; everything else than letters counts as one gap; ties go to the first language in
code point order; documents without a language teach nothing; without any training document
everything is ``und``; repeated rows teach and are predicted each; whole texts are read.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellforge.llm.tables import unused

DIMS, GRAM = 1024, 3
UNKNOWN = "und"
GAP = 0  # stands for a run of characters that are no letters
CODE_BITS = 21  # of a Unicode code point
KNOWN_GRAMS = 60_000  # vectors that a task makes at a time, and half of those that it keeps
BLOCK_DOCS, BLOCK_CHARS = 64, 4_000_000  # documents whose vectors are made together


_letters: list[np.ndarray] = []  # the table below, once made


def letter_table() -> np.ndarray:
    """Whether a code point is a letter."""
    if not _letters:
        codes = range(sys.maxunicode + 1)
        _letters.append(np.fromiter((chr(c).isalpha() for c in codes), dtype=bool, count=len(codes)))
    return _letters[0]


def letter_codes(text: str) -> np.ndarray:
    """Code points of the lower-cased text, runs of other characters as one GAP, one at
    either end; empty if there is no letter."""
    codes = np.frombuffer(text.lower().encode("utf-32-le", "replace"), dtype="<u4").astype(np.int64)
    letter = letter_table()[codes]
    if not letter.any():
        return np.empty(0, dtype=np.int64)
    whole = np.zeros(len(codes) + 2, dtype=np.int64)
    np.multiply(codes, letter, out=whole[1:-1])
    keep = whole != GAP
    keep[1:] |= keep[:-1].copy()  # the first gap after a letter
    keep[0] = True
    if not letter[0]:  # the gap at the start stands for those that follow it
        keep[1] = False
    return whole[keep]


def grams_of(text: str | None, gram: int = GRAM) -> np.ndarray:
    """The packed n-grams of a text, in order."""
    codes = letter_codes(text) if text else np.empty(0, dtype=np.int64)
    if len(codes) < gram:
        return np.empty(0, dtype=np.int64)
    packed = codes[: len(codes) - gram + 1].copy()
    for i in range(1, gram):
        packed = (packed << CODE_BITS) | codes[i : len(codes) - gram + 1 + i]
    return packed


class Encoder:
    """n-gram vectors by packed n-gram, made when first seen."""

    def __init__(self, dims: int = DIMS, gram: int = GRAM, seed: int = 42) -> None:
        self.dims, self.gram, self.seed = dims, gram, seed
        self.letters: dict[int, np.ndarray] = {}
        self.rows: dict[int, int] = {}
        self.vectors = np.empty((1024, dims), dtype=np.float32)

    def letter(self, code: int) -> np.ndarray:
        if code not in self.letters:
            draw = np.random.default_rng((self.seed, code)).integers(0, 2, self.dims)
            self.letters[code] = (2 * draw - 1).astype(np.float32)
        return self.letters[code]

    def vector(self, packed: int) -> np.ndarray:
        out, low = None, (1 << CODE_BITS) - 1
        for place in range(self.gram):  # the last letter is not rotated
            one = np.roll(self.letter((packed >> (CODE_BITS * place)) & low), place)
            out = one if out is None else out * one
        return out

    def places(self, grams: np.ndarray) -> np.ndarray:
        """Rows of ``vectors`` that hold the n-grams."""
        new = [g for g in grams.tolist() if g not in self.rows]
        need = len(self.rows) + len(new)
        if need > len(self.vectors):
            grown = np.empty((max(need, 2 * len(self.vectors)), self.dims), dtype=np.float32)
            grown[: len(self.rows)] = self.vectors[: len(self.rows)]
            self.vectors = grown
        for g in new:
            self.vectors[len(self.rows)] = self.vector(g)
            self.rows[g] = len(self.rows)
        return np.array([self.rows[g] for g in grams.tolist()], dtype=np.int64)

    def bundles(self, docs: list[np.ndarray]) -> np.ndarray:
        """One bundled vector for each document's n-grams."""
        out = np.zeros((len(docs), self.dims), dtype=np.float32)
        if not docs:
            return out
        owner = np.repeat(np.arange(len(docs)), [len(g) for g in docs])
        which, grams = pd.factorize(np.concatenate(docs))
        for start in range(0, len(grams), KNOWN_GRAMS):
            some = grams[start : start + KNOWN_GRAMS]
            if len(self.rows) + len(some) > 2 * KNOWN_GRAMS:  # bounds what a task keeps
                self.rows.clear()
            mine = slice(None) if len(some) == len(grams) else (which >= start) & (which < start + len(some))
            cell = owner[mine] * len(some) + (which[mine] - start)
            weights = np.bincount(cell, minlength=len(docs) * len(some)).reshape(len(docs), len(some))
            out += weights.astype(np.float32) @ self.vectors_of(some)
        return out

    def vectors_of(self, grams: np.ndarray) -> np.ndarray:
        places = self.places(grams)
        return self.vectors[places]


def _blocks(texts) -> Iterator[list[str | None]]:
    """Successive texts, up to BLOCK_DOCS and about BLOCK_CHARS at a time."""
    block, chars = [], 0
    for t in texts:
        block.append(t)
        chars += len(t or "")
        if len(block) >= BLOCK_DOCS or chars >= BLOCK_CHARS:
            yield block
            block, chars = [], 0
    if block:
        yield block


@dataclass(frozen=True)
class Prototypes:
    langs: tuple[str, ...]
    unit: np.ndarray  # languages x dimensions, each of length 1

    def predict(self, bundles: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(index of the language, cosine) of each bundled vector."""
        cosines = (bundles.astype(np.float64) @ self.unit.T) / np.maximum(np.linalg.norm(bundles, axis=1, keepdims=True), 1e-30)
        best = cosines.argmax(axis=1)
        return best, cosines[np.arange(len(best)), best]


def fit_prototypes(train: DataFrame, text: str = "text", lang: str = "lang", dims: int = DIMS) -> Prototypes:
    """Prototypes of the languages of ``train``; ``languages x dims`` sums reach the driver."""
    rows = train.select(F.col(f"`{text}`").alias("text"), F.col(f"`{lang}`").alias("lang")).where("text is not null and lang is not null")

    def bundle(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder, sums = Encoder(dims), {}
        for frame in frames:
            for name, texts in frame.groupby("lang")["text"]:
                for some in _blocks(texts):
                    which, grams = pd.factorize(np.concatenate([grams_of(t) for t in some]))
                    total = np.bincount(which, minlength=len(grams)).astype(np.float64)
                    add = np.zeros(dims)  # whole numbers, exact in a double
                    for i in range(0, len(grams), KNOWN_GRAMS):
                        if len(encoder.rows) > KNOWN_GRAMS:
                            encoder.rows.clear()
                        vectors = encoder.vectors_of(grams[i : i + KNOWN_GRAMS]).astype(np.float64)
                        add += total[i : i + KNOWN_GRAMS] @ vectors
                    sums[name] = sums.get(name, 0) + add.astype(np.int64)
        for name, total in sums.items():
            yield pd.DataFrame({"lang": name, "dim": np.arange(dims), "n": total})

    parts = rows.mapInPandas(bundle, "lang string, dim int, n long")
    cells = parts.groupBy("lang", "dim").agg(F.sum("n").alias("n")).toPandas()
    langs = tuple(sorted(cells["lang"].unique()))
    table = np.zeros((len(langs), dims))
    for i, name in enumerate(langs):
        own = cells[cells["lang"] == name]
        table[i, own["dim"].to_numpy()] = own["n"].to_numpy()
    return Prototypes(langs, table / np.maximum(np.linalg.norm(table, axis=1, keepdims=True), 1e-30))


def identify(docs: DataFrame, model: Prototypes, text: str = "text", dims: int = DIMS) -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score``, the cosine scaled to 0..1 (replaced if there)."""

    @F.pandas_udf("lang_pred string, score double")
    def predicted(series: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        encoder = Encoder(dims)
        for texts in series:
            names = np.full(len(texts), UNKNOWN, dtype=object)
            scores = np.zeros(len(texts))
            at = 0
            for some in _blocks(texts):
                grams = [grams_of(t) for t in some]
                told = [i for i, g in enumerate(grams) if len(g) and model.langs]
                if told:
                    best, cosine = model.predict(encoder.bundles([grams[i] for i in told]))
                    names[[at + i for i in told]] = [model.langs[b] for b in best]
                    scores[[at + i for i in told]] = np.clip((1 + cosine) / 2, 0, 1)
                at += len(some)
            yield pd.DataFrame({"lang_pred": names, "score": scores})

    p = unused(docs, "_p")
    whole = docs.withColumn(p, predicted(F.col(f"`{text}`")))
    return whole.withColumn("lang_pred", F.col(f"{p}.lang_pred")).withColumn("score", F.col(f"{p}.score")).drop(p)
