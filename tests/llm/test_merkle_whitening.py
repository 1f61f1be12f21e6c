import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from cellforge.llm import merkle, whitening
from cellforge.llm.queries import QUERIES
from tests.conftest import SF_SMALL
from tests.llm.conftest import edge_rows

COLUMNS = ["doc_id", "source", "lang", "n_chars", "text"]


def sha(s):
    return hashlib.sha256(s.encode()).hexdigest()


def leaf(values):
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def climb(nodes):
    """(root, for each node the siblings as (left, right) from below)."""
    paths, members = [[] for _ in nodes], [[i] for i in range(len(nodes))]
    while len(nodes) > 1:
        up, up_members = [], []
        for at in range(0, len(nodes), 3):
            run = nodes[at : at + 3]
            for j, _ in enumerate(run):
                for m in members[at + j]:
                    paths[m].append(("".join(run[:j]), "".join(run[j + 1 :])))
            up.append(sha("".join(run)))
            up_members.append([m for part in members[at : at + 3] for m in part])
        nodes, members = up, up_members
    return nodes[0], paths


def brute(rows, seen):
    """rows: (doc_id, source, lang, n_chars, text) -> (doc_id, leaf, subroot, root, proof, folded)."""
    groups = {}
    for row in rows:
        groups.setdefault(row[1], []).append(row)
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    subroots, found = [], []
    for name in names:
        mine = sorted(groups[name], key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        top, paths = climb([leaf(r) for r in mine])
        subroots.append(top)
        found.append((mine, paths))
    root, above = climb(subroots)
    out = []
    for i, (mine, paths) in enumerate(found):
        for row, path in zip(mine, paths):
            path, x = path + above[i], leaf(seen(row))
            for left, right in path:
                x = sha(left + x + right)
            out.append((row[0], leaf(row), subroots[i], root, sha("".join(a + b for a, b in path)), x))
    return out


def key(r):
    return tuple((x is not None, x) if x is not None else (False, 0) for x in r)


@pytest.mark.parametrize("span_depth", [6, 2])
def test_manifest_by_brute_force(spark, clashing, monkeypatch, span_depth):
    monkeypatch.setattr(merkle, "DEPTH", span_depth)
    monkeypatch.setattr(merkle, "SPAN", 3**span_depth)
    rng = random.Random(4)
    ids = [rng.randrange(-(2**62), 2**62) for _ in range(40)] + list(range(-70, 75)) + [7, 7, 7, 2**63 - 1, -(2**63)]
    more = [(i, rng.choice(["a", "b", "ä", "", None]), "en", len(str(i)), f"text\n{i % 9}") for i in ids]
    rows = [(i, source, lang, n, text) for i, text, lang, source, n in edge_rows()] + more
    extra = spark.createDataFrame(more, "doc_id long, source string, lang string, n_chars long, text string")
    docs = clashing.unionByName(extra, allowMissingColumns=True).repartition(5)
    cut = F.when(F.col("doc_id") > 0, F.translate("text", "\n", "")).otherwise(F.col("text"))
    manifest = merkle.build_manifest(docs, COLUMNS, seen={"text": cut})
    out = merkle.audit(manifest).collect()
    got = [(r["id"], r["leaf"], r["subroot"], r["root"], r["proof_sha256"], r["folded_root"]) for r in out]
    want = brute(rows, lambda r: (*r[:4], r[4].replace("\n", "")) if r[4] and (r[0] or 0) > 0 else r)
    assert sorted(got, key=key) == sorted(want, key=key)
    assert all(r["verified"] == (r["folded_root"] == r["root"]) for r in out) and not all(r["verified"] for r in out)
    told = merkle.proofs(manifest).collect()
    assert len(told) == len(rows)
    assert all(merkle.folded(r["leaf"], [p.asDict() for p in r["path"]]) == manifest.root for r in told)


def test_manifest_of_nothing(nothing):
    manifest = merkle.build_manifest(nothing, COLUMNS)
    assert manifest.root is None and merkle.audit(manifest).count() == 0


def test_manifest_query(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select(*COLUMNS).collect()

    def seen(r):
        even = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 2 == 0
        return (*r[:4], r[4].replace("\n", "")) if even and r[4] is not None else r

    out = QUERIES["op12_merkle_manifest"](spark, SF_SMALL).collect()
    got = [(r["doc_id"], r["leaf"], r["subroot"], r["root"], r["proof_sha256"], r["folded_root"]) for r in out]
    assert sorted(got) == sorted(brute([tuple(r) for r in docs], seen))


VECTORS = "vec_id long, embedding array<float>, component string, x int"


def by_numpy(vectors, components, by_rows=False):
    x = {i: np.floor(256 * np.array(v, dtype=np.float64)).astype(np.int64) for i, v in vectors}
    every = np.array(list(x.values())) if by_rows else np.unique(np.array(list(x.values())), axis=0)
    n, total = len(every), every.sum(axis=0)
    centred = every - total / n
    covariance = centred.T @ centred / n
    values, axes = np.linalg.eigh(covariance)
    values, axes = values[::-1], axes[:, ::-1].T
    out = {}
    for i, v in x.items():
        far = sum((n * int(a) - int(s)) ** 2 for a, s in zip(v, total))
        white = [(v - total / n) @ axes[c] / np.sqrt(values[c]) for c in range(components)]
        out[i] = (n, far, white)
    return out, values / np.trace(covariance), axes


@pytest.mark.parametrize("by_rows", [False, True])
def test_whitening_by_numpy(spark, by_rows):
    rng = np.random.default_rng(3)
    spread = np.array([3.0, 2, 1, 0.5, 0.2, 0.1])
    vectors = [(i, [float(np.float32(c)) for c in rng.normal(size=6) * spread]) for i in range(200)]
    vectors += [(1000 + i, vectors[0][1]) for i in range(100)]  # a third of the rows
    bad = [(2000, None), (2001, [1.0, None, 1.0]), (2002, [float("nan")] * 6), (2003, [float("inf")] + [0.0] * 5), (2004, []), (2005, [1.0])]
    rows = [(i, None if v is None else v, "c", -1) for i, v in vectors + bad] + [(None, vectors[3][1], None, None)]
    out = whitening.whiten(spark.createDataFrame(rows, VECTORS).repartition(6), by_rows=by_rows).toPandas()
    none = out[out["vec_id"].isna()]
    assert len(none) == 4
    want, explained, _ = by_numpy(vectors + ([(9999, vectors[3][1])] if by_rows else []), 4, by_rows)
    out = out.dropna(subset=["vec_id"])
    assert set(out["vec_id"]) == {i for i, _ in vectors} and len(out) == 4 * len(vectors)
    assert (out["identity_error"] < 1e-9).all() and out["identity_error"].nunique() == 1
    signs = {}
    for r in out.itertuples():
        n, far, white = want[r.vec_id]
        assert (r.n, r.deviation) == (n, far) and abs(r.explained - explained[r.component - 1]) < 1e-9
        sign = signs.setdefault(r.component, np.sign(r.whitened * white[r.component - 1]))
        assert abs(r.whitened - sign * white[r.component - 1]) < 1e-8


def test_whitening_without_variance(spark):
    rows = [(i, [0.5, float(i % 2)]) for i in range(6)]
    out = whitening.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<float>")).collect()
    assert {r["component"] for r in out} == {1, 2} and all((r["whitened"] is None) == (r["component"] == 2) for r in out)
    one = whitening.whiten(spark.createDataFrame([(1, [0.25, 3.0])], "vec_id long, embedding array<float>")).collect()
    assert [(r["n"], r["deviation"], r["whitened"], r["explained"], r["identity_error"]) for r in one] == [(1, 0, None, None, None)] * 2
    assert whitening.whiten(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0


def test_deviation_beyond_a_long(spark):
    rows = [(1, [1e9, 0.0]), (2, [-1e9, 1.0]), (3, [1e30, 0.0])]
    out = whitening.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), components=1).collect()
    x = [[256 * 10**9, 0], [-256 * 10**9, 256], [2**53, 0]]
    total = [sum(v[j] for v in x) for j in range(2)]
    far = [sum((3 * v[j] - total[j]) ** 2 for j in range(2)) for v in x]
    assert {r["vec_id"]: r["deviation"] for r in out} == {i + 1: f if f < 2**63 else None for i, f in enumerate(far)}


def test_whitening_query(spark):
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{SF_SMALL}/embeddings.parquet").collect()]
    good = [(i, v) for i, v in rows if v is not None and all(c is not None and np.isfinite(c) for c in v)]
    want, explained, _ = by_numpy(good, 4)
    out = QUERIES["op11_whitening"](spark, SF_SMALL).toPandas()
    assert len(out) == 4 * len(good)
    for r in out.itertuples():
        n, far, white = want[r.vec_id]
        assert (r.n, r.deviation) == (n, far) and abs(abs(r.whitened) - abs(white[r.component - 1])) < 1e-6
        assert abs(r.explained / explained[r.component - 1] - 1) < 1e-9
