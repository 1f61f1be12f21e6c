import re
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from cellforge.llm import chat, quality
from cellforge.llm.queries import QUERIES
from tests.conftest import SF_SMALL

PIECES = [*"\\#<>|:/abhlc \n", "</turn>\n", "### assistant: ", "<|image:0|>", "é", "\U0001f600"]
TEXT = st.lists(st.sampled_from(PIECES), max_size=12).map("".join)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "a:b", "", "### x"]), st.lists(st.one_of(TEXT, st.integers(0, 2)), max_size=4)), max_size=4))
def test_round_trip(turns):
    kinds = ["image", "audio", "document"]
    listed = [(r, [{"type": "text", "text": p} if isinstance(p, str) else {"type": kinds[p], "uri": f"u{p}"} for p in parts]) for r, parts in turns]
    formatted, spans, seen = chat.format_conversation(listed)
    number, want = 0, []
    for role, parts in turns:
        flat = []
        for p in parts:
            if isinstance(p, int):
                flat.append((kinds[p], str(number)))
                number += 1
            elif flat and flat[-1][0] == "text":
                flat[-1] = ("text", flat[-1][1] + p)
            elif p:
                flat.append(("text", p))
        want.append((role, [p for p in flat if p[1]]))
    assert chat.read_back(formatted) == want
    assert [a["number"] for a in seen.attachments] == list(range(number))
    loss = [formatted[a:b] for a, b in spans]
    assert len(loss) == sum(r == "assistant" for r, _ in turns) and not any(chat.CLOSE in x for x in loss)


def test_attachments_and_tokens():
    parts = [
        {"type": "text", "text": "see two words"}, {"type": "image", "uri": "i.png", "width": 57, "height": 28},
        {"type": "audio", "uri": "a.wav", "seconds": 1.5}, {"type": "document", "uri": "d.pdf", "pages": 3}, {"type": "odd", "text": "as text"},
        {"type": None, "uri": "as document"},
    ]
    text, _, seen = chat.format_conversation([("user", parts)])
    assert [(a["type"], a["uri"], a["tokens"]) for a in seen.attachments] == [
        ("image", "i.png", 3), ("audio", "a.wav", 38), ("document", "d.pdf", 768), ("document", "as document", 256),
    ]
    assert seen.tokens == 3 + 3 + 38 + 768 + 2 + 256 and text.count("<|") == 4


def test_conversations_of_edges(spark):
    rows = [
        (1, 1, "assistant", [("text", "b", None)]), (1, 0, "user", [("text", None, None)]), (1, None, None, None), (None, 0, "user", []),
        (2, 0, "assistant", [("image", None, "u"), ("text", "x", None)]), (2, 0, "assistant", [("image", None, "u"), ("text", "x", None)]),
    ]
    kinds = "uri:string"
    part = f"struct<type:string,text:string,{kinds}>"
    frame = spark.createDataFrame(rows, f"conv_id long, turn long, role string, parts array<{part}>")
    from pyspark.sql import functions as F

    full = F.transform("parts", lambda p: F.struct(p["type"].alias("type"), p["text"].alias("text"), p["uri"].alias("uri"), *[
        F.lit(None).cast(k).alias(n) for n, k in (("width", "int"), ("height", "int"), ("seconds", "double"), ("pages", "int"))]))
    out = {r["conv_id"]: r for r in chat.format_chats(frame.withColumn("parts", full)).collect()}
    assert out.keys() == {1, None, 2}
    assert chat.read_back(out[1]["formatted"]) == [("user", []), ("assistant", [("text", "b")]), ("", [])]
    assert out[2]["n_turns"] == 2 and len(out[2]["attachments"]) == 2 and out[None]["n_turns"] == 1
    assert chat.format_chats(frame.withColumn("parts", full).limit(0)).count() == 0


def brute(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    earlier, lines = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            lines += line in earlier
            earlier.add(line)
    grams = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    seen, covered = Counter(grams), set()
    for i, g in enumerate(grams):
        if seen[g] > 1:
            covered.update(range(i, i + 5))
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), lines, len(covered)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(["a", "b", " ", "\n", "\n", "é ", "#", " c d e f g ", "\u2003", "\x85", "\x0b", "\x1c"]), max_size=60).map("".join))
def test_counts_match_brute_force(text):
    assert quality.text_counts(text.encode())[:5] == brute(text)


def test_em_recovers_accuracies():
    rng = np.random.default_rng(3)
    good = rng.random(20_000) < 0.7
    accuracy, cover = np.array([0.95, 0.8, 0.7, 0.6]), np.array([0.9, 0.7, 0.8, 1.0])
    right = rng.random((20_000, 4)) < accuracy
    votes = np.where(rng.random((20_000, 4)) < cover, np.where(right, 1, -1) * np.where(good, 1, -1)[:, None], 0)
    patterns, n = np.unique(votes, axis=0, return_counts=True)
    model = quality.fit_label_model(patterns.astype(float), n.astype(float), prior=0.7, trust=0.001)
    assert np.abs(model.accuracy() - accuracy).max() < 0.08
    assert np.abs(np.array([g[0] for g in model.says_good]) - accuracy * cover).max() < 0.08


@pytest.mark.parametrize("rule", [1, 2, 3, 5])
def test_a_defect_that_one_rule_sees_is_junk_however_common(spark, rule):
    """With the parameters of the query: both good votes and one bad one, on 1 to 60 % of the
    documents, are junk, at any number of documents; on 0.1 % they are false alarms."""
    clean = np.zeros(8)
    clean[[0, 7]] = 1
    bad = clean.copy()
    bad[rule] = -1
    patterns = np.array([clean, bad])
    for often in (0.001, 0.01, 0.05, 0.2, 0.4, 0.5, 0.6):
        for documents in (1_000, 1_000_000):
            model = quality.fit_label_model(patterns, np.array([1 - often, often]) * documents)
            s, c = np.log(model.shares), np.log(np.array(model.chances))
            told = np.array([[s[k] + sum(c[k, j, int(v) + 1] for j, v in enumerate(p)) for k in range(len(s))] for p in patterns])
            posterior = np.exp(told[:, 0] - np.logaddexp.reduce(told, axis=1))
            assert posterior[0] > 0.5 and (posterior[1] < 0.5) == (often > 0.001)
            assert often == 0.001 or abs(model.prior - (1 - often)) < 0.07  # the share is estimated


def posteriors(spark, model, patterns):
    from pyspark.sql import functions as F

    rows = spark.createDataFrame([(i, [int(x) for x in p]) for i, p in enumerate(patterns)], "i long, votes array<int>")
    return [r[0] for r in rows.orderBy("i").select(model.posterior(F.col("votes"))).collect()]


def test_em_changes_the_rule_of_no_bad_vote(spark):
    """With the parameters of the query: a defect seen alone on 7 % of documents is junk, one on 0.1 %
    is a false alarm, and too few words are outvoted by endings; alike at any size."""
    clean, symbols, lines, short, worse = [1, 0, 0, 0, 0, 0, 0, 1], [1, 0, -1, 0, 0, 0, 0, 1], [1, 0, 0, -1, 0, 0, 0, 1], [-1, 0, 0, 0, 0, 0, 0, 1], [1, 0, 0, -1, -1, -1, 0, 1]
    patterns, counts = np.array([clean, symbols, lines, short, worse], dtype=float), np.array([42_500, 3_300, 60, 430, 700], dtype=float)
    for copies in (1, 100):
        model = quality.fit_label_model(patterns, counts * copies)
        assert [p >= 0.5 for p in posteriors(spark, model, patterns)] == [True, False, True, True, False]
        assert abs(model.prior - (1 - 4_000 / counts.sum())) < 0.02  # the share is estimated


def test_em_of_the_query_finds_the_kinds():
    """Good documents with false alarms, and a kind of junk for each of two rules, drawn with known chances."""
    rng = np.random.default_rng(5)
    kind = rng.choice(3, 50_000, p=[0.85, 0.1, 0.05])
    votes = np.zeros((50_000, 8))
    votes[:, 0], votes[:, 7] = rng.random(50_000) < 0.9, rng.random(50_000) < 0.8
    for rule, own in ((2, 1), (4, 2)):
        votes[rng.random(50_000) < np.where(kind == own, 0.95, 0.005), rule] = -1
    patterns, n = np.unique(votes, axis=0, return_counts=True)
    model = quality.fit_label_model(patterns, n.astype(float))
    assert abs(model.prior - 0.85) < 0.02
    assert abs(model.says_good[0][0] - 0.9) < 0.01 and abs(model.says_good[7][0] - 0.8) < 0.01
    assert all(abs(model.says_bad[r][0] - 0.005) < 0.01 for r in (2, 4))


def test_rules_on_edges(edges, clashing, nothing):
    from pyspark.sql import functions as F

    voted = quality.with_counts(clashing).withColumn("votes", quality.votes())
    model = quality.label_model(voted)
    out = voted.select("doc_id", "n_words", model.posterior(F.col("votes")).alias("p")).toPandas()
    assert len(out) == edges.count() and out["p"].between(0, 1).all()
    assert (out.loc[out["doc_id"].isin([0, 2, 3]), "n_words"] == 0).all()
    empty = quality.with_counts(nothing).withColumn("votes", quality.votes())
    assert empty.count() == 0 and quality.label_model(empty).prior == pytest.approx(0.8)


def test_quality_agrees_with_labels(spark):
    sf = SF_SMALL.replace("0.001", "0.01")
    out = QUERIES["op3_quality_rules"](spark, sf).toPandas().merge(spark.read.parquet(f"{sf}/labels.parquet").toPandas(), on="doc_id")
    good = out[out["quality"] == 1]
    assert good["kept"].mean() > 0.95 and not (out["kept"] & out["base_failed"]).any()
