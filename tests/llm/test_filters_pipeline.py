import random
import re

import duckdb
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from cellforge.llm import containment, reputation
from cellforge.llm.oracle import ORACLE
from cellforge.llm.queries import QUERIES, URL_RULES
from tests.conftest import SF_SMALL
from tests.llm.conftest import DOC, edge_rows, internal_names, prose
from tools.compare import TABLES, digest


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    got = QUERIES[name](spark, SF_SMALL)
    want = con.execute(ORACLE[name])
    columns = [d[0] for d in want.description]
    rows, expected = [tuple(r) for r in got.collect()], want.fetchall()
    assert sorted(got.columns) == sorted(columns) and len(rows) == len(expected)
    assert digest(rows, got.columns) == digest(expected, columns)


# --- containment --------------------------------------------------------------------


def brute_pairs(docs, items, share=0.8, shingle=5):
    def words(t):
        return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))

    def shingles(w, k):
        return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)}

    out = set()
    for item, text in items:
        w = words(text)
        if not w:
            continue
        k = min(len(w), shingle)
        own = shingles(w, k)
        for doc, t in docs:
            n = len(own & shingles(words(t), k))
            if n and n >= share * len(own) - 1e-9:
                out.add((doc, item, len(own), n))
    return out


def test_containment_by_brute_force(spark):
    rng = random.Random(4)
    items = [(i, prose(500 + i, rng.randrange(1, 40))) for i in range(25)] + [(90, None), (91, " "), (92, "Two words"), (92, "Two words"), (None, prose(3, 9))]
    docs = [(i, prose(i, rng.randrange(0, 300))) for i in range(60)] + [(60, None), (61, "")]
    for i in range(40):  # whole, cut and changed items inside documents
        w = items[rng.randrange(25)][1].split()
        if rng.random() < 0.5:
            w[rng.randrange(len(w))] = "Changed"
        if rng.random() < 0.3:
            w = w[rng.randrange(3) :]
        docs.append((100 + i, f"{prose(i, rng.randrange(0, 2000))}\n{' '.join(w).upper() if i % 7 == 0 else ' '.join(w)} two\twords {prose(i + 1, 30)}"))
    docs += [(140, docs[-1][1]), (140, docs[-1][1]), (140, "other"), (None, docs[-1][1])]
    got = containment.contained_items(
        spark.createDataFrame(docs, "doc_id long, text string").withColumn("item", F.lit(1)), spark.createDataFrame(items, "item_id long, text string")
    ).collect()
    found = [(r["doc"], r["item"], r["n_shingles"], r["n_found"]) for r in got]
    assert len(found) == len(set(found)) and set(found) == brute_pairs(docs, items)


def test_containment_edges(spark, clashing, nothing):
    items = spark.createDataFrame([(1, prose(103, 23))], "item_id long, text string")
    assert [(r["doc"], r["item"]) for r in containment.contained_items(clashing, items).collect()] == [(103, 1)]
    assert containment.contained_items(nothing, items).count() == 0
    assert containment.contained_items(clashing, items.limit(0)).count() == 0


def test_sketches_bound_what_is_shuffled(spark):
    """Without broadcasts by size, no exchange sees the documents' shingles before the filter."""
    from cellforge.plans.inspect import physical_plan

    docs = spark.createDataFrame([(i, prose(i, 80)) for i in range(50)], "doc_id long, text string")
    items = spark.createDataFrame([(1, prose(3, 30))], "item_id long, text string")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        sketches = corpus_pipeline.stash(containment.item_sketches(items, "item_id", "text"), "t-sketches")
        texts = docs.select(F.col("doc_id").alias("doc"), "text", F.xxhash64("text").alias("copy"))
        plan = physical_plan(containment._candidates(texts, sketches, [5])).splitlines()
        scan = next(i for i, line in enumerate(plan) if "Generate explode" in line)
        above = [line for line in plan[:scan] if "Exchange" in line or "BroadcastHashJoin" in line]
        assert "BroadcastHashJoin" in above[-1] and "Exchange hashpartitioning(hash" in above[-2]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_template_shingles_make_no_pairs(spark):
    """Items and documents that share a template's shingles are no candidates by these."""
    head = "the question is as follows please answer"
    items = spark.createDataFrame([(i, f"{head} {prose(1000 + i, 12)}") for i in range(40)], "item_id long, text string")
    docs = spark.createDataFrame([(i, f"{prose(i, 20)} {head} {prose(50 + i, 20)}") for i in range(40)], "doc_id long, text string")
    sketches = corpus_pipeline.stash(containment.item_sketches(items, "item_id", "text"), "t-sketches")
    texts = docs.select(F.col("doc_id").alias("doc"), "text", F.xxhash64("text").alias("copy"))
    assert containment._candidates(texts, sketches, [5]).count() == 0


# --- reputation ---------------------------------------------------------------------


def judged(spark, rows):
    frame = spark.createDataFrame(rows, "page_id long, url string, bad int").withColumn("n", F.lit(1)).withColumn("rate", F.lit(1))
    return {r["page_id"]: r for r in reputation.judge_urls(frame, "url", "bad", URL_RULES).collect()}


def test_rules_and_parts(spark):
    urls = [
        None, "no scheme", "http://", "HTTP://Example.ORG/es/x", "http://a.example.org/en/12", "http://a.example.org/en/2", "https://x.com/fr/", "https://x.com/de/1?q",
        "http://xcom/fr/", "http://example.org", "http://com/fr/a", "ftp://a.b://c/d", "http://É.Org/a#b/c", "http://badexample.org/es/", "http://h?x/y",
    ]
    got = judged(spark, [(i, u, None) for i, u in enumerate(urls)])
    want = [
        ("", "", None, "allow"), ("", "", None, "allow"), ("", "", None, "allow"), ("example.org", "/es/x", "example.org/es/", "block"),
        ("a.example.org", "/en/12", "example.org/en/1", "block"), ("a.example.org", "/en/2", "org/", "allow"), ("x.com", "/fr/", "com/fr/", "allow"),
        ("x.com", "/de/1", "com/de/", "block"), ("xcom", "/fr/", None, "allow"), ("example.org", "", None, "allow"), ("com", "/fr/a", "com/fr/", "allow"),
        ("a.b:", "//c/d", None, "allow"), ("É.org", "/a", "org/", "allow"), ("badexample.org", "/es/", "org/", "allow"), ("h", "", None, "allow"),
    ]
    assert [(got[i]["host"], got[i]["path"], got[i]["rule"], got[i]["verdict"]) for i in range(len(urls))] == want


def test_shrinkage(spark):
    rows = [(i, f"http://bad.one.net/{i}", 1) for i in range(60)] + [(100 + i, f"http://good.two.net/{i}", 0) for i in range(60)]
    rows += [(200, "http://new.one.net/", None), (201, "http://new.two.net/", None), (202, "http://one.more.net/", 1), (203, "http://other.uk/", None)]
    got = judged(spark, rows)
    rate = {i: got[i]["bad_rate"] for i in got}
    assert got[0]["verdict"] == "block" and got[100]["verdict"] == "allow" and got[202]["verdict"] == "allow"
    assert rate[0] > rate[200] > rate[203] > rate[201] > rate[100]  # the domain's rate, then the overall one
    assert rate[0] > rate[202] > rate[203]  # one bad page moves a host a little


def test_domains(spark):
    hosts = ["a.b.co.uk", "b.co.uk", "co.uk", "a.b.example.com", "example.com", "com", "", "x.y.z.fr", "1.2.3.4"]
    frame = spark.createDataFrame([(h,) for h in hosts], "h string")
    got = [tuple(r) for r in frame.select(reputation.registered_domain(F.col("h")), reputation.host_suffix(F.col("h"))).collect()]
    assert got == [
        ("b.co.uk", "co.uk"), ("b.co.uk", "co.uk"), ("co.uk", "uk"), ("example.com", "com"), ("example.com", "com"), ("com", "com"), ("", ""),
        ("z.fr", "fr"), ("3.4", "4"),
    ]


def test_suffix_rules_from_a_table(spark):
    rules = ["com", "uk", "co.uk", "ne.jp", "jp", "*.ck", "!www.ck", "github.io", "io", "*.kawasaki.jp", "!city.kawasaki.jp", "", None, "com"]
    want = {  # host: suffix, domain
        "a.b.com": ("com", "b.com"), "com": ("com", "com"), "x.y.co.uk": ("co.uk", "y.co.uk"), "co.uk": ("co.uk", "co.uk"), "b.uk": ("uk", "b.uk"),
        "p.q.ne.jp": ("ne.jp", "q.ne.jp"), "a.b.c.ck": ("c.ck", "b.c.ck"), "c.ck": ("c.ck", "c.ck"), "ck": ("ck", "ck"), "www.ck": ("ck", "www.ck"), "z.www.ck": ("ck", "www.ck"),
        "me.github.io": ("github.io", "me.github.io"), "a.b.kawasaki.jp": ("b.kawasaki.jp", "a.b.kawasaki.jp"), "x.city.kawasaki.jp": ("kawasaki.jp", "city.kawasaki.jp"),
        "no.rule": ("rule", "no.rule"), "": ("", ""), "single": ("single", "single"),
    }
    hosts = spark.createDataFrame([(h, 1) for h in want], "host string, n int")
    table = spark.createDataFrame([(r,) for r in rules], "rule string")
    got = {r["host"]: (r["suffix"], r["domain"]) for r in reputation.with_suffixes(hosts, table).collect()}
    assert got == want
    pages = spark.createDataFrame([(i, f"http://{h}/", 1 if "github" in h else None) for i, h in enumerate(want)], "page_id long, url string, bad int")
    judged = reputation.judge_urls(pages, "url", "bad", [], suffix_rules=table)
    assert judged.count() == len(want) and judged.columns == [*pages.columns[:0], *reputation.judge_urls(pages, "url", "bad", []).columns]


def test_no_pages(spark):
    assert judged(spark, []) == {}


# --- pipeline -----------------------------------------------------------------------


def test_pipeline_stages(spark):
    """Every stage on what its predecessor kept, against a plain version of its decision."""
    sf = SF_SMALL.replace("0.001", "0.01")
    docs, columns = spark.read.parquet(f"{sf}/documents.parquet"), None
    for name, stage in corpus_pipeline.STAGES:
        before = docs.toPandas()
        columns = docs.columns
        docs = corpus_pipeline.stash(stage(spark, docs, sf), name)
        after = docs.toPandas()
        if name != "sharding":
            assert docs.columns == columns
        if name == "toxicity":
            labels = spark.read.parquet(f"{sf}/labels.parquet").toPandas()
            clean = set(labels.loc[labels["toxic"] == 0, "doc_id"])
            assert clean & set(before["doc_id"]) == clean & set(after["doc_id"])
            toxic = set(labels.loc[labels["toxic"] == 1, "doc_id"])
            assert len(toxic & set(after["doc_id"])) < 0.4 * len(toxic)  # only 51 to learn from
        if name == "simhash_near_dedup":
            prints = __import__("cellforge.llm.simhash", fromlist=["x"]).fingerprint
            from tests.llm.test_simhash import brute_components

            want = brute_components([prints(t) for t in before["text"]], list(before["doc_id"]), 3)
            assert sorted(after["doc_id"]) == sorted(set(want))
        if name == "benchmark_decontamination":
            items = spark.read.parquet(f"{sf}/benchmark.parquet").toPandas()
            leaks = {d for d, *_ in brute_pairs(list(zip(before["doc_id"], before["text"])), list(zip(items["item_id"], items["text"])))}
            assert leaks and sorted(after["doc_id"]) == sorted(set(before["doc_id"]) - leaks)
        if name == "mixing":
            counts = after["doc_id"].value_counts()
            assert counts.max() <= 3 and set(after["doc_id"]) <= set(before["doc_id"])
        if name == "sharding":
            sizes = after.groupby("shard").size()
            assert len(after) == len(before) and sizes.max() - sizes.min() <= 1


def test_pipeline_run_is_the_stages(spark):
    out = corpus_pipeline.run(spark, SF_SMALL)
    assert set(out.columns) >= {"doc_id", "text", "shard", "slot"} and out.count() > 0
    assert QUERIES["op2_hilbert_sharding"](spark, SF_SMALL).count() >= out.select("doc_id").distinct().count()


def test_pipeline_edges(spark, clashing, nothing):
    for frame in (clashing, nothing):
        docs = frame
        for name, stage in corpus_pipeline.STAGES:
            columns = docs.columns
            docs = corpus_pipeline.stash(stage(spark, docs, SF_SMALL), name)
            assert name == "sharding" or docs.columns == columns
            extra = [c for c in internal_names() if c in docs.columns and c not in ("curve", "shard", "slot", "doc_id", "text", "lang", "source")]
            assert frame is nothing or len(extra) > 100  # whatever they are named, they keep their values
            assert frame is nothing or docs.where(" or ".join(f"`{c}` is null or `{c}` != -1" for c in extra)).count() == 0
        assert (docs.count() > 0) == (frame is clashing)
    assert len(edge_rows()) == clashing.count() and DOC
