"""A Merkle manifest of a dataset, with leaf places from ranks in bitmaps.

Every row is a leaf: the digest of some of its columns.  The leaves of a group stand in the
order of their ids; runs of ARITY nodes become their digest until one is left, the group's
subroot; the subroots in the order of their groups give the root in the same way.

Leaves are not sorted.  The ids of a group form a bitmap, kept as its words of 64 ids that
hold any (tasks merge theirs by OR).  A directory holds, for each word, the number of ids in
the words before it: running popcounts over blocks of 1024 words, blocks of 1024 blocks, and
so on.  A leaf's place is the directory's count and the popcount of the lower bits of its
word.  Where ids repeat, a word counts more rows than bits; rows of such words alone are
ranked by id and leaf, by ranges.

Levels are reduced by arrays of digests keyed by slot: SPAN = ARITY**6 nodes that share an
ancestor six levels above meet as one array, which yields that ancestor; the arrays are
written, and proofs go back down through them.

Defined cases: columns are hashed as "-" if null, else by their length in bytes and value, so
no two rows share an input unless equal; a null group is the first group, a null id the
first of its group; rows of one id stand in the order of their leaves; equal leaves of one id
take the places that are left to them, in any order; texts of any length are hashed whole;
other columns are not read; an empty table gives an empty table.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cellforge.llm.tables import ranked, stash

ARITY, DEPTH = 3, 6
SPAN = ARITY**DEPTH
WORD, BLOCK = 6, 10  # bits of an id within a word, of a word within a block

PATH = "array<struct<left: string, right: string>>"


def digest_of(columns: list[Column]) -> Column:
    """Lowercase hex SHA-256 of the columns, each with its length."""
    parts = [F.coalesce(F.concat(F.octet_length(c.cast("string")).cast("string"), F.lit(":"), c.cast("string")), F.lit("-")) for c in columns]
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def _hash(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def levels_of(total: int) -> int:
    """Levels above ``total`` nodes, at most DEPTH."""
    n = 0
    while total > 1 and n < DEPTH:
        total, n = -(-total // ARITY), n + 1
    return n


def reduced(digests: list[str], levels: int) -> list[list[str]]:
    """The nodes of each level, from ``digests`` up."""
    out = [digests]
    for _ in range(levels):
        row = out[-1]
        out.append([_hash("".join(row[i : i + ARITY])) for i in range(0, len(row), ARITY)])
    return out


def siblings(levels: list[list[str]], slot: int) -> list[dict[str, str]]:
    """What stands left and right of the node of ``slot`` in its run, level by level."""
    out = []
    for row in levels[:-1]:
        run = slot // ARITY * ARITY
        out.append({"left": "".join(row[run:slot]), "right": "".join(row[slot + 1 : run + ARITY])})
        slot //= ARITY
    return out


def folded(leaf: str, path: list[dict[str, str]]) -> str:
    """The root that ``leaf`` gives with the siblings of ``path``."""
    for side in path:
        leaf = _hash(side["left"] + leaf + side["right"])
    return leaf


def _before(counts: DataFrame, most: int) -> DataFrame:
    """``s, word, n`` -> ``s, word, before``: the sum of n over the smaller words of s; words
    are 0 to ``most``.  A window holds a block of 1024 words; blocks are counted one level up."""
    block = F.shiftright("word", BLOCK)
    within = Window.partitionBy("s", "block").orderBy("word").rowsBetween(Window.unboundedPreceding, -1)
    inner = counts.withColumn("block", block).withColumn("before", F.coalesce(F.sum("n").over(within), F.lit(0)))
    if not most >> BLOCK:
        return inner.select("s", "word", "before")
    blocks = counts.groupBy("s", block.alias("word")).agg(F.sum("n").alias("n"))
    outer = _before(blocks, most >> BLOCK).select("s", F.col("word").alias("block"), F.col("before").alias("outer"))
    return inner.join(outer, ["s", "block"]).select("s", "word", (F.col("before") + F.col("outer")).alias("before"))


def leaf_places(leaves: DataFrame) -> DataFrame:
    """``s, id, leaf, tie`` and more -> also ``pos`` (rank in s by id, leaf and tie) and
    ``total`` (rows of s)."""
    ends = leaves.agg(F.min("id"), F.max("id")).first()
    low, high = ((e or 0) >> WORD for e in ends)
    word = F.coalesce(F.shiftright("id", WORD) - F.lit(low - 1), F.lit(0).cast("long"))  # 0: null ids
    keyed = leaves.withColumn("word", word).withColumn("bit", F.expr("cast(coalesce(id & 63, 0) as int)"))
    words = keyed.groupBy("s", "word").agg(F.expr("bit_or(shiftleft(1L, bit))").alias("bits"), F.count(F.lit(1)).alias("n"))
    words = stash(words, "merkle-words")
    totals = words.groupBy("s").agg(F.sum("n").alias("total"))
    directory = words.join(_before(words.select("s", "word", "n"), high - low + 1), ["s", "word"]).join(totals, "s")
    directory = stash(directory.withColumn("plain", F.bit_count("bits") == F.col("n")), "merkle-directory")
    placed = keyed.join(directory, ["s", "word"])
    below = F.expr("bits & ~shiftleft(-1L, bit)")
    gone = ["word", "bit", "bits", "n", "before", "plain"]
    plain = placed.where("plain").withColumn("pos", F.col("before") + F.bit_count(below)).drop(*gone)
    if not directory.where("not plain").limit(1).count():
        return plain
    tied, _ = ranked(placed.where("not plain"), ["s", "word", "id", "leaf", "tie"], "merkle-tied")
    first = stash(tied.groupBy("s", "word").agg(F.min("_rank").alias("first")), "merkle-first")
    tied = tied.join(first, ["s", "word"]).withColumn("pos", F.col("before") + F.col("_rank") - F.col("first"))
    return plain.unionByName(tied.drop(*gone, "_rank", "first"))


def _slots(nodes: DataFrame, extra: list[str], name: str) -> DataFrame:
    """Nodes ``s, total, pos, digest`` and ``extra`` -> ``s, block, total, slots, top``."""

    @F.pandas_udf("string")
    def top(slots, totals):
        import pandas as pd

        return pd.Series([reduced([x["digest"] for x in row], levels_of(int(n)))[-1][0] for row, n in zip(slots, totals)])

    slot = F.struct((F.col("pos") % SPAN).cast("int").alias("slot"), "digest", *extra)
    grouped = nodes.groupBy("s", F.floor(F.col("pos") / SPAN).alias("block")).agg(F.max("total").alias("total"), F.sort_array(F.collect_list(slot)).alias("slots"))
    digests = F.transform("slots", lambda x: F.struct(x["digest"].alias("digest")))
    return stash(grouped.withColumn("top", top(digests, "total")), name)


def _climb(nodes: DataFrame, extra: list[str], name: str) -> tuple[list[DataFrame], DataFrame]:
    """(arrays of each round, ``s, digest`` of what remains of each s)."""
    rounds = [_slots(nodes, extra, name)]
    while True:
        last = rounds[-1]
        most = last.agg(F.max("total")).first()[0] or 0
        rest = F.greatest(F.ceil(F.col("total") / SPAN), F.lit(1)).cast("long").alias("total")
        nodes = last.select("s", rest, F.col("block").alias("pos"), F.col("top").alias("digest"))
        if most <= SPAN:
            return rounds, nodes.select("s", "digest")
        rounds.append(_slots(nodes, [], name))


def _descend(rounds: list[DataFrame], paths: DataFrame) -> DataFrame:
    """``s, pos, path`` of what the first round's arrays hold, from those above them."""

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                levels = reduced([x["digest"] for x in row["slots"]], levels_of(row["total"]))
                out += [{"s": row["s"], "pos": row["block"] * SPAN + i, "path": siblings(levels, i) + row["path"]} for i in range(len(row["slots"]))]
            path = pa.list_(pa.struct([("left", pa.string()), ("right", pa.string())]))
            yield pa.RecordBatch.from_pylist(out, schema=pa.schema([("s", pa.string()), ("pos", pa.int64()), ("path", path)]))

    for arrays in reversed(rounds):
        above = paths.withColumnRenamed("pos", "block")
        paths = stash(arrays.join(above, ["s", "block"]).mapInArrow(spread, f"s string, pos long, path {PATH}"), "merkle-paths")
    return paths


@dataclass(frozen=True)
class Manifest:
    """``arrays``: the leaves' slot arrays (``s, block, total, slots``, a slot with ``digest``,
    ``id``, ``member`` and ``seen``), each with its ``path`` to the root and its ``subroot``."""

    arrays: DataFrame
    root: str | None


def build_manifest(
    docs: DataFrame, columns: list[str], key: str = "doc_id", group: str = "source", seen: dict[str, Column] | None = None
) -> Manifest:
    """The tree of all rows.  ``seen``: what a later reading finds in some of the columns
    (a Column for each); its digest is kept with the leaf, to be verified against the tree."""
    named = {c: F.col(f"`{c}`") for c in columns}
    member = F.col(f"`{group}`")
    leaves = docs.select(
        F.coalesce(F.concat(F.lit("="), member), F.lit("")).alias("s"), member.alias("member"), F.col(f"`{key}`").cast("long").alias("id"),
        digest_of(list(named.values())).alias("leaf"),
        digest_of([(seen or {}).get(c, v) for c, v in named.items()]).alias("seen"), F.monotonically_increasing_id().alias("tie"),
    )
    leaves = stash(leaves, "merkle-leaves")  # texts are read once
    nodes = leaf_places(leaves).withColumnRenamed("leaf", "digest")
    rounds, subroots = _climb(nodes, ["id", "member", "seen"], "merkle-slots")
    order, groups = ranked(subroots, ["s"], "merkle-groups")
    order = order.select("s", "digest", F.col("_rank").alias("pos"))
    above, root = _climb(order.select(F.lit("").alias("s"), F.lit(groups).cast("long").alias("total"), "pos", "digest"), [], "merkle-top")
    spark = docs.sparkSession
    paths = _descend(above, spark.createDataFrame([("", 0, [])], f"s string, pos long, path {PATH}"))
    paths = order.withColumnRenamed("digest", "subroot").join(paths.select("pos", "path"), "pos")
    subroots = stash(paths.select("s", "subroot"), "merkle-subroots")
    paths = _descend(rounds[1:], paths.select("s", F.lit(0).cast("long").alias("pos"), "path"))
    arrays = rounds[0].drop("top").join(paths.withColumnRenamed("pos", "block"), ["s", "block"]).join(subroots, "s")
    top = root.first()
    return Manifest(arrays, top["digest"] if top else None)


def _rows_of(batch: pa.RecordBatch) -> Iterator[tuple]:
    """(slot, path, its array's row) of every leaf."""
    for row in batch.to_pylist():
        levels = reduced([x["digest"] for x in row["slots"]], levels_of(row["total"]))
        for i, slot in enumerate(row["slots"]):
            yield slot, siblings(levels, i) + row["path"], row


def proofs(manifest: Manifest) -> DataFrame:
    """``id, member, leaf, path`` of every row: the digests that stand left and right of the
    node, level by level from the leaf to the root."""
    path = pa.list_(pa.struct([("left", pa.string()), ("right", pa.string())]))
    schema = pa.schema([("id", pa.int64()), ("member", pa.string()), ("leaf", pa.string()), ("path", path)])

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [{"id": x["id"], "member": x["member"], "leaf": x["digest"], "path": way} for x, way, _ in _rows_of(batch)]
            yield pa.RecordBatch.from_pylist(out, schema=schema)

    return manifest.arrays.mapInArrow(spread, f"id long, member string, leaf string, path {PATH}")


def audit(manifest: Manifest) -> DataFrame:
    """``id, member, leaf, subroot, root, proof_sha256, folded_root, verified`` of every row:
    folded_root is what the digest of the seen columns gives with the row's siblings;
    proof_sha256 is the digest of these, level by level, left to right."""
    root, text = manifest.root, pa.string()
    names = ["id", "member", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    kinds = [pa.int64(), text, text, text, text, text, text, pa.bool_()]

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for slot, path, row in _rows_of(batch):
                proof, found = _hash("".join(side["left"] + side["right"] for side in path)), folded(slot["seen"], path)
                out.append((slot["id"], slot["member"], slot["digest"], row["subroot"], root, proof, found, found == root))
            columns = zip(*out) if out else [[] for _ in names]
            yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, kinds)], names=names)

    schema = "id long, member string, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"
    return manifest.arrays.mapInArrow(verify, schema)
