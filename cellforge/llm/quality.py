"""Quality rules by weak supervision.

Each rule looks at a document's counts and votes good (1), bad (-1) or abstains (0).
Expectation-maximisation estimates the accuracies of every rule from how the votes agree
over all documents: the chances of its votes on good documents and on each kind of bad ones.  A document
is kept by its posterior probability of being good, not by passing every rule.

EM needs the votes only as counts of distinct vote patterns, at most 3**rules rows, which
Spark counts over all documents.

Defined cases: a null, empty or blank text has no words and all counts 0; the counts run
over whole texts of any length; repeated rows are judged each, alike; an empty table gives an
empty table, and a model that abstains (posterior = prior).
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellforge.llm.tables import unused

WINDOW = 5
SYMBOLS = b"#*$%&|<>"  # fixed values
CAPITALS = bytes(range(ord("A"), ord("Z") + 1))
LETTERS = CAPITALS + CAPITALS.lower() + bytes(range(0xC3, 0xF5))  # ASCII, and lead bytes of others

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_letters", "n_ended")


def text_counts(text: bytes) -> tuple[int, ...]:
    """The values of COUNTS for one UTF-8 text."""
    words = text.split()  # splits bytes at space and \\t to \\r only
    n = len(words)
    tail = text.translate(None, bytes(range(0x80, 0xC0)))  # one byte for each code point
    word_chars = len(tail.translate(None, b" \t\n\x0b\x0c\r"))
    symbols = len(text) - len(text.translate(None, SYMBOLS))
    lines = [line for line in text.split(b"\n") if line.strip()]
    repeated = 0
    if n > WINDOW:
        grams = list(zip(*[words[i:] for i in range(WINDOW)]))
        seen = Counter(grams)
        if len(seen) < len(grams):
            end = 0  # words before it are counted
            for i, gram in enumerate(grams):
                if seen[gram] > 1:
                    repeated += i + WINDOW - max(i, end)
                    end = i + WINDOW
    upper = len(text) - len(text.translate(None, CAPITALS))
    plain = len(text) - len(text.translate(None, LETTERS))
    ended = sum(line.rstrip()[-1:] in b".!?\"'" for line in lines)
    return n, word_chars, symbols, len(lines) - len(set(lines)), repeated, len(lines), upper, plain, ended


@dataclass(frozen=True)
class Rule:
    """``good`` and ``bad``: conditions on the counts; neither: it abstains."""

    name: str
    good: str
    bad: str


# The conditions use the columns COUNTS; thresholds in the manner of published web filters.
# Rules that look for one defect abstain where they do not find it.
NEVER = "false"
RULES = (
    Rule("length", "n_words >= 20 AND n_words <= 100000", "n_words < 8"),
    Rule("word_length", NEVER, "word_chars < 2 * n_words OR word_chars > 14 * n_words"),
    Rule("symbols", NEVER, "10 * n_symbols > n_words"),
    Rule("duplicate_lines", NEVER, "10 * n_dup_lines > 3 * n_lines"),
    Rule("repetition", NEVER, "100 * n_repeat_words > 20 * n_words"),
    Rule("capitals", NEVER, "2 * n_upper > n_letters"),
    Rule("letters", NEVER, "10 * n_letters < 5 * word_chars"),
    Rule("endings", "2 * n_ended >= n_lines AND n_lines > 0", "10 * n_ended < n_lines"),
)


def with_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with the columns COUNTS (long; replaced if there)."""

    @F.pandas_udf(", ".join(f"{c} long" for c in COUNTS))
    def counts(column):
        import pandas as pd

        rows = [text_counts(t.encode("utf-8", "replace") if t else b"") for t in column]
        return pd.DataFrame(rows, columns=list(COUNTS), dtype="int64")

    found = unused(docs, "_counts")
    whole = docs.withColumn(found, counts(F.coalesce(F.col(f"`{text}`"), F.lit(""))))
    for c in COUNTS:
        whole = whole.withColumn(c, F.col(f"{found}.{c}"))
    return whole.drop(found)


def votes(rules=RULES) -> Column:
    """Array of each rule's vote: 1 good, -1 bad, 0 abstains (good and bad at once, too)."""
    return F.array(
        *[(F.expr(f"coalesce({r.good}, false)").cast("int") - F.expr(f"coalesce({r.bad}, false)").cast("int")) for r in rules]
    )


@dataclass(frozen=True)
class LabelModel:
    """``says_good`` and ``says_bad``: for each rule, the chance of that vote on a good and
    on a bad document.  ``shares`` and ``chances``: good documents, then each kind of bad
    ones; their share, and for each rule its chances to vote bad, abstain and vote good."""

    prior: float
    says_good: tuple[tuple[float, float], ...]
    says_bad: tuple[tuple[float, float], ...]
    shares: tuple[float, ...]
    chances: tuple[tuple[tuple[float, float, float], ...], ...]

    def evidence(self) -> np.ndarray:
        """Log likelihood ratio of good to bad for a bad and a good vote of each rule."""
        return np.array([[np.log(b[0] / b[1]), np.log(g[0] / g[1])] for g, b in zip(self.says_good, self.says_bad)])

    def accuracy(self) -> np.ndarray:
        """The chance that a vote of each rule is right, given that it votes."""
        g, b = np.array(self.says_good), np.array(self.says_bad)
        right = self.prior * g[:, 0] + (1 - self.prior) * b[:, 1]
        return right / (right + self.prior * b[:, 0] + (1 - self.prior) * g[:, 1])

    def posterior(self, vote: Column) -> Column:
        """Probability of good, from a vote array."""
        shares, chances = np.log(self.shares), np.log(self.chances)
        odds = F.lit(1.0)
        for share, chance in zip(shares[1:] - shares[0], chances[1:] - chances[0]):
            logit = F.lit(float(share))
            for j, (bad, none, good) in enumerate(chance.tolist()):
                v = F.get(vote, j)
                logit = logit + F.when(v > 0, good).when(v < 0, bad).otherwise(none)
            odds = odds + F.exp(logit)
        return 1.0 / odds


#: What is expected of a rule before any document: the chances of its (good, bad) votes on
#: good and on bad documents, and of the bad vote on the kind of document that it looks for.
#: It counts for TRUST times as much as the documents, alike at any number of them: it
#: settles what the votes leave open, and the votes outweigh it elsewhere.
BEFORE_GOOD, BEFORE_BAD, BEFORE_OWN, TRUST = (0.6, 0.001), (0.5, 0.2), 0.9, 0.01
#: The false alarms of a rule that only votes bad are no matter of votes: a defect that one
#: rule sees, and alarms of that rule on good documents, look alike.  So their chance is
#: expected, and counts as much as the documents.
SURE = 1.0
NEVER_SEEN = 1e-9  # the chance of a good vote of a rule that has none


PRIOR = 0.8  # share of good documents that EM begins with; it is estimated, from 0 to 1


def fit_label_model(
    patterns: np.ndarray, weights: np.ndarray, prior: float = PRIOR, trust: float = TRUST, rounds: int = 5000
) -> LabelModel:
    """EM over distinct vote ``patterns`` (n x rules) with their document counts.

    Kinds of junk exclude each other, so one bad side with independent rules would take a
    defect that one rule sees for a whim of that rule.  The bad side is a mixture: a kind
    where any rule may vote bad, and one for each rule without good votes, which looks for
    one defect.  Shares and chances are estimated.  Votes cannot tell false alarms of such a
    rule from its kind; there the expected chance of false alarms decides: a rule that votes
    alone more often (from some 0.3 % of the documents up) has found a kind, however common
    it is, and one that does so more seldom is not believed alone.  Which side is good is
    fixed by the votes' meaning: a good vote never speaks for a bad kind, nor a bad one for
    good documents."""
    n, rules = patterns.shape
    total = weights.sum()
    unit = trust * total
    votes_ = np.stack([patterns < 0, patterns == 0, patterns > 0], axis=2).reshape(n, 3 * rules).astype(float)
    lone = np.flatnonzero(~(patterns > 0).any(axis=0)) if n else np.arange(0)
    before = np.empty((2 + len(lone), rules, 3))
    for side, (up, down) in enumerate([BEFORE_GOOD, BEFORE_BAD] + [BEFORE_GOOD] * len(lone)):
        before[side, :, 0], before[side, :, 2] = down, up
    before[2 + np.arange(len(lone)), lone, 0] = BEFORE_OWN
    before[:, lone, 2] = NEVER_SEEN
    before[:, :, 1] = 1 - before[:, :, 0] - before[:, :, 2]
    first = np.array([prior] + [(1 - prior) / (1 + len(lone))] * (1 + len(lone)))
    shares, chances, good = first, before, None
    counted = np.tile((unit * first)[:, None, None], (1, rules, 1)) + 1e-9  # no votes at all: as expected
    counted[0, lone] = SURE * total + 1e-9
    for _ in range(rounds):
        score = np.log(shares) + votes_ @ np.log(chances).reshape(len(shares), -1).T
        side = np.exp(score - score.max(axis=1, keepdims=True)) if n else score
        side /= side.sum(axis=1, keepdims=True)
        held = side * weights[:, None]
        shares = (held.sum(axis=0) + first) / (total + 1)
        chances = ((held.T @ votes_).reshape(before.shape) + counted * before) / (held.sum(axis=0)[:, None, None] + counted)
        chances[1:, :, 0] = np.maximum(chances[1:, :, 0], chances[0, :, 0])  # a bad vote never speaks for good
        chances[1:, :, 2] = np.minimum(chances[1:, :, 2], chances[0, :, 2])  # nor a good one for bad
        chances[1:, :, 1] = np.maximum(1 - chances[1:, :, 0] - chances[1:, :, 2], NEVER_SEEN)
        if not n or (good is not None and np.abs(side[:, 0] - good).max() < 1e-9):
            break
        good = side[:, 0]
    bad = np.tensordot(shares[1:] / shares[1:].sum(), chances[1:], 1)
    up, down = (np.stack([chances[0, :, v], bad[:, v]], axis=1).tolist() for v in (2, 0))
    whole = tuple(tuple(map(tuple, side)) for side in chances.tolist())
    return LabelModel(float(shares[0]), tuple(map(tuple, up)), tuple(map(tuple, down)), tuple(shares.tolist()), whole)


def label_model(voted: DataFrame, column: str = "votes", rules=RULES) -> LabelModel:
    """The model of all documents' votes; at most 3**rules pattern rows reach the driver."""
    rows = voted.groupBy(column).agg(F.count(F.lit(1)).alias("n")).collect()
    rows.sort(key=lambda r: tuple(r[0]))
    patterns = np.array([r[0] for r in rows], dtype=float).reshape(len(rows), len(rules))
    return fit_label_model(patterns, np.array([r[1] for r in rows], dtype=float))
