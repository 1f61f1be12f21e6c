import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from cellforge.llm import hilbert, mixing
from cellforge.llm.queries import QUERIES
from tests.conftest import SF_SMALL
from tests.llm.conftest import edge_rows

DIMS = ["source", "lang", "n_chars", "doc_id"]


@pytest.mark.parametrize("bits,dims", [(1, 2), (3, 2), (2, 3), (3, 3), (2, 4)])
def test_curve_steps_to_neighbours(bits, dims):
    assert hilbert.curve_neighbours_differ_by_one(bits, dims)


@pytest.mark.parametrize("shards", [1, 4, 24, 100])
def test_shards_differ_by_one_row(clashing, shards):
    out = hilbert.hilbert_shards(clashing, DIMS, shards).toPandas()
    n = len(edge_rows())
    sizes = Counter(out["shard"])
    assert len(out) == n and set(out.columns) == {*clashing.columns, "curve"}
    assert all(sorted(g["slot"]) == list(range(len(g))) for _, g in out.groupby("shard"))
    assert sorted(sizes[s] for s in range(shards)) == sorted(n // shards + (s < n % shards) for s in range(shards))
    ordered = out.sort_values(["shard", "slot"])["curve"]
    assert ordered.is_monotonic_increasing


def test_shards_of_nothing(nothing):
    assert hilbert.hilbert_shards(nothing, DIMS, 24).count() == 0


def test_equal_dimensions_make_tight_shards(spark):
    """Runs of the curve have narrower ranges in both dimensions than runs by one of them."""
    rng = random.Random(5)
    rows = [(rng.randrange(1000), rng.randrange(1000)) for _ in range(2000)]
    out = hilbert.hilbert_shards(spark.createDataFrame(rows, "x long, y long"), ["x", "y"], 16, bits=6).toPandas()
    spread = out.groupby("shard")[["x", "y"]].agg(lambda c: c.max() - c.min()).mean()
    assert spread["x"] < 600 and spread["y"] < 600


def test_strings_are_cut_by_their_whole_value(spark):
    """Values that share their first bytes, one of them on a third of the rows, against exact quantiles."""
    rng = random.Random(7)
    for head in ("", "https://www.example.org/"):
        values = [head + rng.choice("abcdeé") * rng.randrange(6) + str(rng.randrange(40)) for _ in range(900)]
        values += [head + "c3"] * 450 + [None] * 30 + [""] * 20
        out = hilbert.hilbert_curve(spark.createDataFrame([(v,) for v in values], "s string").repartition(5), ["s"], bits=3).collect()
        known = sorted(v.encode() for v in values if v is not None)
        bounds = sorted({known[-(-k * len(known) // 8) - 1] for k in range(1, 8)})
        assert len(bounds) > 4
        assert all(r["curve"] == (0 if r["s"] is None else sum(b < r["s"].encode() for b in bounds)) for r in out)


def test_sharding_query_covers_all(spark):
    out = QUERIES["op2_hilbert_sharding"](spark, SF_SMALL).toPandas()
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").toPandas()
    known = out.merge(docs.drop(columns="text"), on="doc_id")  # ids are unique: the order is that of the curve and the dimensions
    plain = known.sort_values(["curve", "source", "lang", "n_chars", "doc_id"])["doc_id"].tolist()
    n, at = len(plain), 0
    for shard in range(24):
        more = n // 24 + (shard < n % 24)
        mine = out[out["shard"] == shard].sort_values("slot")
        assert mine["doc_id"].tolist() == plain[at : at + more] and mine["slot"].tolist() == list(range(more))
        at += more
    assert len(out) == spark.read.parquet(f"{SF_SMALL}/documents.parquet").count()
    sizes = out.groupby("shard").size()
    assert sizes.max() - sizes.min() <= 1 and set(out["law"]) == {"rows"}


def targets(sizes, weights=(5, 2, 1), most=3.0):
    """The contract's words, step by step: share, stop, share the excess again."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    got, open_, left = {s: 0.0 for s in names}, set(names), float(sum(sizes.values()))
    while open_ and left > 1e-9:
        share = left / sum(weight[s] for s in open_)
        left = 0.0
        for s in sorted(open_, key=str):
            got[s] += share * weight[s]
        for s in list(open_):
            if got[s] >= most * sizes[s]:
                left += got[s] - most * sizes[s]
                got[s] = most * sizes[s]
                open_.remove(s)
    return got


@pytest.mark.parametrize("seed", range(4))
def test_targets_by_steps(spark, seed):
    rng = random.Random(seed)
    sizes = {f"s{i}": rng.choice([0, 1, 10, 1000, 50_000]) + rng.randrange(9) for i in range(12)} | {None: 77, "é": 3}
    frame = spark.createDataFrame([(s, float(n)) for s, n in sizes.items()], "source string, source_size double")
    out = {r["source"]: r["target"] for r in mixing.source_targets(frame).collect()}
    want = targets(sizes)
    assert out.keys() == want.keys()
    assert all(out[s] == pytest.approx(want[s], rel=1e-9, abs=1e-6) for s in want)


@pytest.mark.parametrize("fanout", [5, 32])
def test_mass_is_kept_up_to_one_document(spark, fanout):
    rng = random.Random(7)
    rows = [(i, "hot" if i % 3 else f"s{i % 4}", rng.randrange(0, 300)) for i in range(600)]
    frame = spark.createDataFrame(rows, "doc_id long, source string, size long")
    out = mixing.mix_sources(frame, ["doc_id"], "source", "size", fanout=fanout).toPandas()
    assert sorted(out["doc_id"]) == list(range(600)) and out["copies"].between(0, 3).all()
    for _, g in out.groupby("source"):
        assert abs((g["size"] * g["copies"]).sum() - g["target"].iloc[0]) <= g["size"].max() / 2 + 1e-6
    again = mixing.mix_sources(frame.repartition(7), ["doc_id"], "source", "size", fanout=fanout).toPandas()
    key = lambda p: sorted(zip(p["doc_id"], p["copies"]))
    assert key(out) == key(again)


def test_targets_are_met_on_the_table(spark):
    sf = SF_SMALL.replace("0.001", "0.01")
    out = QUERIES["op5_mixing"](spark, sf).toPandas().merge(spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "source").toPandas())
    each = out.groupby("source").agg(n=("size", "size"), taken=("taken", "sum"), target=("target", "first"), longest=("size", "max"))
    assert len(each) == 20 and (each["n"] >= 20).all()
    assert ((each["taken"] - each["target"]).abs() <= 0.02 * each["target"]).all()
    assert out["copies"].between(0, 3).all()


def test_a_long_document_is_made_up_for(spark):
    rows = [(0, "a", 5000)] + [(i, "a", 40 + i) for i in range(1, 100)] + [(1000 + i, "b", 50) for i in range(300)]
    for seed in range(2):
        out = mixing.mix_sources(spark.createDataFrame(rows, "doc_id long, source string, size long"), ["doc_id"], "source", "size", seed=seed).toPandas()
        for _, g in out.groupby("source"):
            assert abs((g["size"] * g["copies"]).sum() - g["target"].iloc[0]) <= 50


def test_rounding_is_fair(spark):
    """Over many seeds a document is taken as often as its share says."""
    frame = spark.createDataFrame([(i, "ab"[i % 2], 100 + i) for i in range(40)], "doc_id long, source string, size long")
    taken, runs = Counter(), 5
    for seed in range(runs):
        for r in mixing.mix_sources(frame, ["doc_id"], "source", "size", fanout=8, seed=seed).collect():
            taken[r["source"]] += r["copies"] - r["target"] / r["source_size"]
    assert all(abs(x) / (runs * 20) < 0.05 for x in taken.values())


def test_mixing_edges(spark, clashing, nothing):
    out = mixing.mix_sources(clashing, ["doc_id", "text"], "source", "n_chars").toPandas()
    assert len(out) == len(edge_rows())
    repeated = out[(out["doc_id"] == 6) & out["text"].duplicated(keep=False)]
    assert repeated["copies"].nunique() == 1
    assert (out.loc[out["size"] == 0, "copies"] == 1).all()
    assert mixing.mix_sources(nothing, ["doc_id"], "source", "n_chars").count() == 0
    only_null = spark.createDataFrame([(None, None, None)] * 3, "doc_id long, source string, size long")
    assert mixing.mix_sources(only_null, ["doc_id"], "source", "size").select(F.sum("copies")).first()[0] == 3
