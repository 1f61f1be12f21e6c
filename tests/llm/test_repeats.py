import hashlib
import random

import numpy as np
import pytest

from cellforge.llm import intervals, repeats
from cellforge.llm.queries import QUERIES
from tests.conftest import SF_SMALL
from tests.llm.conftest import edge_rows


def brute(docs, least):
    """docs: texts (bytes) in their order -> for each, whether its bytes are removed."""
    seen, out = {}, []
    for i, text in enumerate(docs):
        gone = bytearray(len(text))
        for p in range(len(text) - least + 1):
            gram = text[p : p + least]
            if gram in seen:
                gone[p : p + least] = b"\1" * least
            seen.setdefault(gram, (i, p))
        out.append(gone)
    return out


def runs(gone):
    edges = np.flatnonzero(np.diff(np.frombuffer(b"\0" + bytes(gone) + b"\0", dtype=np.uint8)))
    return list(zip(edges[::2].tolist(), edges[1::2].tolist()))


def letters(rng, n, alphabet="ab"):
    return "".join(rng.choice(alphabet) for _ in range(n))


@pytest.mark.parametrize("seed", range(4))
def test_maximal_intervals_by_brute_force(seed):
    rng, least = random.Random(seed), 4
    texts = [letters(rng, rng.randrange(0, 30)).encode() for _ in range(12)]
    bucket = np.array([i // 4 for i in range(12)])
    data, stop = np.frombuffer(b"".join(texts), dtype=np.uint8), np.cumsum([len(t) for t in texts])
    start = np.append(0, stop[:-1])
    at, segment, lcp = intervals.sorted_suffixes(data, start, stop, bucket, least)
    before = np.where(at > start[segment], data[at - 1].astype(int), intervals.NONE)
    found = set()
    for length, lo, hi in intervals.maximal_intervals(lcp, before, least):
        found.add((bucket[segment[lo]], bytes(data[at[lo] : at[lo] + length]), frozenset((int(segment[i]), int(at[i] - start[segment[i]])) for i in range(lo, hi + 1))))
    want = set()
    for b in range(3):
        places = {}
        for i in np.flatnonzero(bucket == b):
            for p in range(len(texts[i])):
                for q in range(p + least, len(texts[i]) + 1):
                    places.setdefault(texts[i][p:q], set()).add((int(i), p))
        for s, at_ in places.items():
            after = {texts[i][p + len(s) : p + len(s) + 1] or (i, p) for i, p in at_}
            left = {texts[i][p - 1 : p] if p else (i, p) for i, p in at_}
            if len(at_) > 1 and len(after) > 1 and len(left) > 1:
                want.add((b, s, frozenset(at_)))
    assert found == want


def test_segments_depend_on_the_content_alone():
    rng = random.Random(3)
    shared = letters(rng, 700, "abcdefgh")
    a = (letters(rng, 333, "xyz") + shared + letters(rng, 50, "xyz")).encode()
    b = (letters(rng, 18, "xyz") + shared).encode()
    cut = {}
    for name, texts in (("a", [a]), ("b", [b"pq" * 80, b])):
        data, ends = np.frombuffer(b"".join(texts), dtype=np.uint8), np.cumsum([len(t) for t in texts])
        for piece in (64, 100_000):  # where a scan is cut does not show
            found = list(zip(*[np.concatenate(c).tolist() for c in zip(*repeats.segments(data, ends, 100, piece))]))
            cut.setdefault(name, found)
            assert cut[name] == found
    both = {f[:2] for f in cut["a"]} & {f[:2] for f in cut["b"]}
    assert len(both) >= 8  # of some 700 / 31 segments, those wholly inside


@pytest.mark.parametrize("least,hot", [(6, 1024), (12, 1024), (12, 2), (30, 3)])
def test_against_brute_force(spark, monkeypatch, least, hot):
    monkeypatch.setattr(repeats, "HOT", hot)
    monkeypatch.setattr(repeats, "ROWS", 50)
    rng = random.Random(least)
    line = letters(rng, 45, "abcdefghij")
    texts = [letters(rng, rng.randrange(0, 120), "abé") for _ in range(30)]
    texts += [letters(rng, 20, "kl") + line + letters(rng, 15, "mn") for _ in range(20)] + ["a" * 90, "ab" * 70, texts[3], texts[3] + texts[4]]
    rng.shuffle(texts)
    out = repeats.remove_repeats(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(7), least=least).collect()
    raw = [t.encode() for t in texts]
    want = brute(raw, least)
    assert len(out) == len(texts)
    for r in out:
        assert [tuple(x) for x in r["removed"]] == runs(want[r["doc_id"]])
        assert bytes(r["kept"]) == bytes(b for b, gone in zip(raw[r["doc_id"]], want[r["doc_id"]]) if not gone)
        assert r["n_bytes"] == len(raw[r["doc_id"]])


def test_groups_hold_all_occurrences(spark):
    rng = random.Random(8)
    line = letters(rng, 150, "abcdefghij")
    texts = [letters(rng, 40, "kl") + line + letters(rng, 40, "mn") for _ in range(6)]
    keyed, _ = repeats.keyed_texts(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), "doc_id", "text")
    asked = repeats.settle(repeats.anchor_rows(keyed, 100)).where("kind != 'later'")
    found = repeats.repeat_groups(keyed, asked, 100).toPandas()
    sizes = found.groupby(["key", "number"])
    assert sizes.ngroups and (sizes["earlier"].sum() == sizes.size() - 1).all() and sizes.size().max() == 6
    for _, group in sizes:
        strings = {texts[d].encode()[s : s + n] for d, s, n in zip(group["d"], group["start"], group["len"])}
        assert len(strings) == 1


def test_edges(spark, edges, clashing, nothing):
    out = repeats.remove_repeats(clashing).collect()
    rows = edge_rows()
    assert len(out) == len(rows) and repeats.remove_repeats(nothing).count() == 0
    order = sorted({(r[0] is not None, -1 if r[0] is None else r[0], r[1] or "") for r in rows})
    hashes = {r["t"]: r["h"] for r in edges.selectExpr("coalesce(text, '') t", "xxhash64(coalesce(text, '')) h").collect()}
    order.sort(key=lambda k: (*k[:2], hashes[k[2]]))
    gone = brute([k[2].encode() for k in order], 100)
    want = sorted((-1 if not k[0] else k[1], len(k[2].encode()), runs(g)) for k, g in zip(order, gone) for _ in range(sum((r[0] is not None, -1 if r[0] is None else r[0], r[1] or "") == k for r in rows)))
    got = sorted((-1 if r["doc_id"] is None else r["doc_id"], r["n_bytes"], [tuple(x) for x in r["removed"]]) for r in out)
    assert got == want


def test_query(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").toPandas().sort_values("doc_id")
    raw = [(t or "").encode() for t in docs["text"]]
    want = {}
    for d, text, gone in zip(docs["doc_id"], raw, brute(raw, 100)):
        kept = bytes(b for b, g in zip(text, gone) if not g)
        want[d] = (len(text), sum(gone), len(runs(gone)), hashlib.sha256(kept).hexdigest())
    out = QUERIES["op13_repeats"](spark, SF_SMALL).collect()
    assert {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in out} == want
    assert len(out) == len(docs) and sum(w[1] for w in want.values()) > 0
