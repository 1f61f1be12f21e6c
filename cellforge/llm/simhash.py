"""SimHash near-duplicates by a segment-popcount embedding.

The fingerprint of a text has 64 bits: a bit is 1 if it is set in over half of the hashes
(XXH64 of the UTF-8 bytes, seed 42) of its word shingles, repeats included.  Words are
lower-cased (A-Z); a text of fewer words than a shingle is one shingle; a text without
words, or a null one, has fingerprint 0.  Fingerprints link at ``most_bits`` or fewer
differing bits; a document's component is all that links lead to.

The search: a fingerprint is cut into ``most_bits // 2 + 1`` parts, so two linked ones
differ in at most one bit within some part.  A part is embedded as the bit counts of its
2-bit segments.  The Manhattan distance of two embeddings is a lower bound of the differing
bits, so in that part it is 1 at most.  The counts are a cell of a grid; each fingerprint is
written to its own cell and to the cells one count above, and any two at distance 1 or less
meet in one of them.  Within a cell pairs are verified on the fingerprints themselves.

Equal fingerprints are taken together before the search.  A cell passes on a spanning forest
of its links, not its pairs.  A cell of more than BLOCK fingerprints is cut into blocks
whose pairs meet in tasks of their own.

Defined cases: ``component_id`` is the least doc_id of the component, null ids left out (null
if there is no other); rows of one id with different texts are documents of their own;
repeated rows share their component; an empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cellforge.llm.components import components
from cellforge.llm.tables import packed, stash

SHINGLE, MOST_BITS, SEED = 3, 3, 42
BITS = 64
BLOCK = 4096
SEGMENT_LOW = np.uint64(0x5555555555555555)  # the low bit of each 2-bit segment
ONE, TWO_BITS = np.uint64(1), np.uint64(3)


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """The unsigned 64-bit fingerprint of a whole text."""
    words = (text or "").encode("utf-8", "replace").lower().split()  # bytes: A-Z and ASCII blanks only
    if not words:
        return 0
    if len(words) < shingle:
        shingles = [b" ".join(words)]
    else:
        shingles = [b" ".join(s) for s in zip(*[words[i:] for i in range(shingle)])]
    counts, n = np.zeros(BITS, dtype=np.int64), len(shingles)
    for i in range(0, n, 65536):
        hashes = np.array([xxhash.xxh64_intdigest(s, SEED) for s in shingles[i : i + 65536]], dtype="<u8")
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, text: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """``docs`` with ``fingerprint`` as a (signed) long; replaced if there."""

    @F.pandas_udf("long")
    def made(texts: pd.Series) -> pd.Series:
        return pd.Series(np.array([fingerprint(t, shingle) for t in texts], dtype=np.uint64).view(np.int64))

    return docs.withColumn("fingerprint", made(F.col(f"`{text}`")))


def cells_of(prints: np.ndarray, most_bits: int = MOST_BITS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(part, cell, index of the fingerprint): the cells that each fingerprint is written to."""
    parts = most_bits // 2 + 1
    width = 2 * -(-BITS // (2 * parts))  # bits of a part, even
    out = []
    for part in range(parts):
        size = min(width, BITS - part * width)
        mask = np.uint64((1 << size) - 1)
        x = (prints >> np.uint64(part * width)) & mask
        counts = (x & SEGMENT_LOW) + ((x >> ONE) & SEGMENT_LOW)
        every = np.arange(len(prints))
        found = [(counts, every)]
        if most_bits:
            for segment in range(0, size, 2):
                room = ((counts >> np.uint64(segment)) & TWO_BITS) < 2
                found.append((counts[room] + (ONE << np.uint64(segment)), every[room]))
        cells, index = (np.concatenate([f[i] for f in found]) for i in (0, 1))
        out.append((np.full(len(cells), part), cells, index))
    return tuple(np.concatenate([o[i] for o in out]) for i in range(3))


def linked_pairs(groups: np.ndarray, prints: np.ndarray, most_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of positions of equal ``groups`` (sorted) whose ``prints`` link."""
    start = np.flatnonzero(np.concatenate(([True], groups[1:] != groups[:-1]))) if len(groups) else np.empty(0, dtype=int)
    ends = np.repeat(np.append(start[1:], len(groups)), np.diff(np.append(start, len(groups))))
    left, lag, found = np.arange(len(groups)), 1, []
    while True:
        left = left[left + lag < ends[left]]
        if not len(left):
            break
        near = left[np.bitwise_count(prints[left] ^ prints[left + lag]) <= most_bits]
        found.append((near, near + lag))
        lag += 1
    if not found:
        return np.empty(0, dtype=int), np.empty(0, dtype=int)
    return np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(node, least node) of the components of the edges, without the least nodes."""
    nodes, where = np.unique(np.concatenate((a, b)), return_inverse=True)
    a, b = where[: len(a)], where[len(a) :]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        for end in (a, b):
            np.minimum.at(new, end, low)
            np.minimum.at(new, label[end], low)
        new = new[new]
        if (new == label).all():
            break
        label = new
    moved = label != np.arange(len(nodes))
    return nodes[moved], nodes[label[moved]]


def links(distinct: DataFrame, most_bits: int = MOST_BITS) -> DataFrame:
    """``fingerprint`` (distinct longs) -> ``a, b``: links that connect what any links connect."""

    def write_cells(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            prints = frame["fingerprint"].to_numpy().view(np.uint64)
            part, cell, index = cells_of(prints, most_bits)
            yield pd.DataFrame({"part": part.astype(np.int32), "cell": cell.view(np.int64), "fingerprint": prints[index].view(np.int64)})

    def verify(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rest = None
        for frame in frames:
            if rest is not None:
                frame = pd.concat([rest, frame], ignore_index=True)
            keys = frame[["part", "cell", "low", "high"]].to_numpy()
            change = (keys[1:] != keys[:-1]).any(axis=1)
            group = np.concatenate(([0], np.cumsum(change))) if len(keys) else np.empty(0, dtype=int)
            whole = group < group[-1] if len(group) else group.astype(bool)  # the last group may go on
            yield from _linked(group[whole], frame["fingerprint"].to_numpy()[whole])
            rest = frame[~whole]
        if rest is not None and len(rest):
            yield from _linked(np.zeros(len(rest), dtype=int), rest["fingerprint"].to_numpy())

    def _linked(group: np.ndarray, prints: np.ndarray) -> Iterator[pd.DataFrame]:
        i, j = linked_pairs(group, prints.view(np.uint64), most_bits)
        if len(i):
            a, b = forest(prints[i], prints[j])
            yield pd.DataFrame({"a": a, "b": b})

    written = stash(distinct.mapInPandas(write_cells, "part int, cell long, fingerprint long"), "simhash-cells")
    large = stash(written.groupBy("part", "cell").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > BLOCK), "simhash-large")
    one = F.lit(0).alias("low"), F.lit(0).alias("high")
    cut = written.select("part", "cell", *one, "fingerprint")
    if large.limit(1).count():
        blocks = F.ceil(F.col("n") / BLOCK).cast("int")
        own = F.pmod(F.xxhash64("fingerprint"), blocks).cast("int")
        spread = written.join(large, ["part", "cell"]).withColumn("own", own)
        spread = spread.withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
        spread = spread.select("part", "cell", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"), "fingerprint")
        cut = cut.join(large, ["part", "cell"], "left_anti").unionByName(spread)
    keys = ["part", "cell", "low", "high"]
    sorted_ = cut.repartition(*keys).sortWithinPartitions(*keys)
    return sorted_.mapInPandas(verify, "a long, b long").distinct()


def near_duplicates(
    docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = SHINGLE, most_bits: int = MOST_BITS
) -> DataFrame:
    """``key, text_hash, fingerprint, root, component_id`` for each row of ``docs``; root is
    the least linked fingerprint, which names the component."""
    base = docs.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").alias("text"))
    prints = fingerprints(base, "text", shingle).withColumn("text_hash", F.xxhash64("text"))
    prints = stash(prints.select("key", "text_hash", "fingerprint"), "simhash-prints")
    distinct = stash(prints.groupBy("fingerprint").agg(F.min("key").alias("first")), "simhash-distinct")
    roots = components(links(distinct.select("fingerprint"), most_bits))
    named = distinct.join(roots, distinct["fingerprint"] == roots["node"], "left").select(
        "fingerprint", "first", F.coalesce("root", "fingerprint").alias("root")
    )
    named = stash(named, "simhash-roots")
    least = stash(named.groupBy("root").agg(F.min("first").alias("component_id")), "simhash-least")  # a join that Spark can split
    known = stash(named.select("fingerprint", "root").join(least, "root"), "simhash-components")
    return prints.join(known, "fingerprint").select(F.col("key").alias(key), "text_hash", "fingerprint", "root", "component_id")


def first_of_each(docs: DataFrame, key: str = "doc_id", text: str = "text", **kw) -> DataFrame:
    """One row of ``docs`` for each component: that of the least key (null last), then of
    the least hash of its text, then of the whole row."""
    found = near_duplicates(docs, key, text, **kw)
    least = F.min(F.struct(F.col(f"`{key}`").isNull().alias("none"), F.col(f"`{key}`").alias("key"), F.col("text_hash").alias("hash")))
    keep = stash(found.groupBy("root").agg(least.alias("m")).select(F.col("m.key").alias("k"), F.col("m.hash").alias("h")), "simhash-keep")
    whole = F.xxhash64(*[F.col(f"`{c}`") for c in docs.columns])
    rows = docs.select(packed(docs), F.col(f"`{key}`").alias("key"), F.xxhash64(F.col(f"`{text}`")).alias("hash"), whole.alias("whole"))
    kept = rows.join(keep.distinct(), F.col("key").eqNullSafe(F.col("k")) & (F.col("hash") == F.col("h")), "left_semi")
    again = Window.partitionBy("key", "hash").orderBy("whole")
    return kept.withColumn("n", F.row_number().over(again)).where("n = 1").select("row.*")
