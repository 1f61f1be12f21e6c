import random
import re

import numpy as np
import pandas as pd
import pytest
import xxhash

from cellforge.llm import components, simhash
from cellforge.llm.queries import QUERIES
from tests.conftest import SF_SMALL
from tests.llm.conftest import edge_rows, prose


def brute_print(text, shingle=3):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    parts = [" ".join(words[i : i + shingle]) for i in range(max(1, len(words) - shingle + 1))]
    hashes = [xxhash.xxh64(p.encode(), seed=42).intdigest() for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(prints, ids, most):
    root = list(range(len(prints)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(prints)):
        for j in range(i):
            if bin(prints[i] ^ prints[j]).count("1") <= most:
                root[find(i)] = find(j)
    least = {}
    for i, n in enumerate(ids):
        if n is not None:
            least[find(i)] = min(n, least.get(find(i), n))
    return [least.get(find(i)) for i in range(len(prints))]


def test_fingerprints_by_brute_force():
    texts = [r[1] for r in edge_rows() if r[1] is None or len(r[1]) < 5000] + ["ÀB c", "A b", "a b c d", "one"]
    assert [simhash.fingerprint(t) for t in texts] == [brute_print(t) for t in texts]


@pytest.mark.parametrize("most", [0, 1, 2, 3, 5, 8])
def test_search_finds_every_link(spark, most):
    rng = random.Random(most)
    prints = {rng.getrandbits(64) for _ in range(120)} | {0, 2**64 - 1}
    for p in list(prints):  # chains of near fingerprints
        for _ in range(4):
            for b in rng.sample(range(64), rng.randrange(1, most + 2)):
                p ^= 1 << b
            prints.add(p)
    prints = sorted(prints)
    rows = [(int(np.uint64(p).astype(np.int64)),) for p in prints]
    found = components.components(simhash.links(spark.createDataFrame(rows, "fingerprint long"), most)).toPandas()
    root = dict(zip(found["node"], found["root"]))
    signed = [r[0] for r in rows]
    want = brute_components(prints, signed, most)
    assert [root.get(p, p) for p in signed] == want


def test_large_cells_are_cut_into_blocks(spark, monkeypatch):
    monkeypatch.setattr(simhash, "BLOCK", 5)
    rng, prints = random.Random(1), set()
    while len(prints) < 150:  # a ball around one fingerprint
        prints.add(sum(1 << b for b in rng.sample(range(24), 3)))
    rows = [(p,) for p in sorted(prints)]
    found = components.components(simhash.links(spark.createDataFrame(rows, "fingerprint long"), 3)).toPandas()
    root = dict(zip(found["node"], found["root"]))
    assert [root.get(p[0], p[0]) for p in rows] == brute_components([r[0] for r in rows], [r[0] for r in rows], 3)


@pytest.mark.parametrize("seed", range(3))
def test_components_of_random_graphs(spark, seed):
    rng = random.Random(seed)
    edges = [(rng.randrange(80), rng.randrange(80)) for _ in range(55)] + [(i, i + 1) for i in range(100, 160)] + [(7, 7)]
    found = dict(components.components(spark.createDataFrame(edges, "a long, b long")).collect())
    label = {n: n for e in edges for n in e}
    for _ in label:
        for a, b in edges:
            label[a] = label[b] = min(label[a], label[b])
    assert {n: r for n, r in label.items() if n != r} == found


def test_edges(spark, edges, clashing, nothing):
    out = simhash.near_duplicates(clashing).toPandas()
    rows = edge_rows()
    assert len(out) == len(rows)
    prints = [simhash.fingerprint(r[1]) for r in rows]
    want = brute_components(prints, [r[0] for r in rows], 3)
    got = sorted(zip(out["doc_id"].fillna(-1), out["fingerprint"].to_numpy().view(np.uint64), out["component_id"].fillna(-1)))
    assert got == sorted((-1 if r[0] is None else r[0], p, -1 if w is None else w) for r, p, w in zip(rows, prints, want))
    kept = simhash.first_of_each(clashing)
    assert kept.columns == clashing.columns
    ids = [r["doc_id"] for r in kept.collect()]
    assert len(ids) == len({brute_components(prints, list(range(len(rows))), 3)[i] for i in range(len(rows))})
    assert {0, 4, 6, 7, 8} <= set(ids) and not {2, 3, 5} & set(ids)
    assert simhash.near_duplicates(nothing).count() == 0 and simhash.first_of_each(nothing).count() == 0


def test_query(spark):
    out = QUERIES["op4_simhash"](spark, SF_SMALL).toPandas().sort_values("doc_id")
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").toPandas().sort_values("doc_id")
    prints = [brute_print(t) for t in docs["text"]]
    assert list(out["fingerprint"]) == [f"{p:016x}" for p in prints]
    assert list(out["component_id"]) == brute_components(prints, list(docs["doc_id"]), 3)


def test_near_copies_fall_together(spark):
    base = prose(9, 400)
    near = base.replace(base.split()[200], "changed", 1)
    out = simhash.near_duplicates(spark.createDataFrame([(1, base), (2, near), (3, prose(10, 400))], "doc_id long, text string"))
    assert {r["doc_id"]: r["component_id"] for r in out.collect()} == {1: 1, 2: 1, 3: 3}
    assert isinstance(out.toPandas(), pd.DataFrame)
