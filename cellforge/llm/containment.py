"""Benchmark decontamination: containment search by size-partitioned MinHash sketches.

An item is its set of ``shingle``-word shingles (an item with fewer words: its whole word
sequence), words lower-cased (A-Z).  A document contains the item if at least ``share`` of
the item's shingles occur in it, however long the document is.

Items are partitioned by their number q of shingles.  A document that holds at least
m = ceil(share * q) of them misses at most q - m, so it holds one of any q - m + 1.  Each
size partition therefore keeps, as the item's sketch, its q - m + 1 least shingles, in the order
of (items that hold the shingle, hash): a shingle of a template that many items share comes
last.  A document is a candidate for an item if one of its shingles is in the sketch.
Unlike banded MinHash, whose chance falls with the length of the document, this loses no item
in a long document.

Candidates are found on hashes.  All sketches' hashes are marked in a filter of FILTER_WORDS
words of 64 bits, broadcast (1 MB, whatever the number of items); only hashes of a document
that it passes are shuffled.  Then the shingles of candidate documents alone are met, as
texts, with all shingles of their candidate items, and counted.

Defined cases: null, empty or blank texts have no words and hold and match nothing; a
repeated document or item row gives its pairs once; documents shorter than the item's
shingle match nothing; empty tables give an empty table.  DataFrame operations only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellforge.llm.tables import GAP_PATTERN, lower_ascii, stash

SHINGLE, SHARE = 5, 0.8
FILTER_WORDS = 1 << 16
BLANKS = " \t\n\x0b\x0c\r"  # the characters of GAP_PATTERN


def words_of(text: Column) -> Column:
    """Words of a text, lower-cased; a text without any gives one empty word."""
    return F.split(F.btrim(lower_ascii(F.coalesce(text, F.lit(""))), F.lit(BLANKS)), GAP_PATTERN)


def _starts(words: Column, width: Column | int) -> Column:
    last = F.size(words) - width
    return F.when(last >= 0, F.sequence(F.lit(0), last)).otherwise(F.array().cast("array<int>"))


def shingle_hash(shingle: Column) -> Column:
    return F.xxhash64(shingle)


def shingle_texts(words: Column, width: int) -> Column:
    return F.transform(_starts(words, width), lambda i: F.concat_ws(" ", *[F.get(words, i + j) for j in range(width)]))


def _by_width(words: Column, width: Column, most: int, made) -> Column:
    """``made(w)`` for the width w of the row."""
    out = None
    for w in range(1, most + 1):
        out = F.when(width == w, made(w)) if out is None else out.when(width == w, made(w))
    return out


def item_sketches(items: DataFrame, item: str, text: str, shingle: int = SHINGLE, share: float = SHARE) -> DataFrame:
    """``item, set, width, shingles (distinct), least, sketch``: the shingles of each item (set:
    their hash, for items of one name), how many a document must hold, and the hashes of
    which it then holds one at least."""
    rows = items.select(F.col(f"`{item}`").alias("item"), words_of(F.col(f"`{text}`")).alias("words")).where(F.element_at("words", 1) != "").distinct()
    rows = rows.withColumn("width", F.least(F.size("words"), F.lit(shingle)))
    rows = rows.withColumn("shingles", F.array_distinct(_by_width(F.col("words"), F.col("width"), shingle, lambda w: shingle_texts(F.col("words"), w))))
    least = F.greatest(F.ceil(F.lit(share) * F.size("shingles") - 1e-9).cast("int"), F.lit(1))
    rows = rows.select("item", F.xxhash64("shingles").alias("set"), "width", "shingles", least.alias("least"))
    rows = stash(rows, "item-shingles")
    each = rows.select("item", "set", F.explode("shingles").alias("shingle")).select("item", "set", shingle_hash(F.col("shingle")).alias("hash"))
    known = each.groupBy("hash").agg(F.count(F.lit(1)).alias("held"))
    order = each.join(known, "hash").groupBy("item", "set").agg(F.sort_array(F.collect_list(F.struct("held", "hash"))).alias("order"))  # of one item
    order = order.select(F.col("item").alias("i"), F.col("set").alias("s"), "order")
    joined = rows.join(order, F.col("item").eqNullSafe(F.col("i")) & (F.col("set") == F.col("s")))
    size = F.size("shingles") - F.col("least") + 1
    sketch = F.slice(F.transform("order", lambda x: x["hash"]), F.lit(1), F.greatest(size, F.lit(1)))
    return joined.select("item", "set", "width", "shingles", "least", sketch.alias("sketch"))


def _candidates(texts: DataFrame, sketches: DataFrame, widths: list[int]) -> DataFrame:
    """``doc, copy, item, set``: documents that hold a shingle of the item's sketch."""
    probes = stash(sketches.select("item", "set", F.explode("sketch").alias("hash")), "item-probes")
    place = F.pmod("hash", F.lit(64 * FILTER_WORDS))
    bits = F.expr("bit_or(shiftleft(1L, cast(place & 63 as int)))")
    marked = probes.withColumn("place", place).groupBy(F.shiftright("place", 6).alias("word")).agg(bits.alias("bits"))
    words, held = words_of(F.col("text")), None
    for w in widths:
        hashes = F.array_distinct(F.transform(shingle_texts(F.col("words"), w), shingle_hash))
        part = texts.select("doc", "copy", words.alias("words")).select("doc", "copy", F.explode(hashes).alias("hash"))
        held = part if held is None else held.unionByName(part)
    # Broadcast bound: FILTER_WORDS rows of two longs.
    passed = held.withColumn("place", place).withColumn("word", F.shiftright("place", 6)).join(F.broadcast(marked), "word")
    passed = passed.where(F.expr("bits & shiftleft(1L, cast(place & 63 as int)) != 0")).select("doc", "copy", "hash")
    return passed.join(probes, "hash").select("doc", "copy", "item", "set").distinct()


def contained_items(
    docs: DataFrame, items: DataFrame, doc: str = "doc_id", item: str = "item_id", text: str = "text",
    shingle: int = SHINGLE, share: float = SHARE,
) -> DataFrame:
    """``doc, item, n_shingles, n_found, containment``: every pair at ``share`` or more."""
    sketches = stash(item_sketches(items, item, text, shingle, share), "item-sketches")
    widths = sorted(r[0] for r in sketches.select("width").distinct().collect()) or [shingle]  # at most ``shingle`` values
    whole = F.col(f"`{text}`")
    texts = docs.select(F.col(f"`{doc}`").alias("doc"), whole.alias("text"), F.xxhash64(whole).alias("copy")).where(whole.isNotNull())
    found = stash(_candidates(texts, sketches, widths), "candidates")  # copy tells rows of one id apart

    chosen = found.select(F.col("doc").alias("d"), F.col("copy").alias("c")).distinct()
    mine = texts.join(chosen, F.col("doc").eqNullSafe(F.col("d")) & (F.col("copy") == F.col("c")), "left_semi")
    words, held = words_of(F.col("text")), None
    for w in widths:
        part = mine.select("doc", "copy", words.alias("words")).select("doc", "copy", F.explode(F.array_distinct(shingle_texts(F.col("words"), w))).alias("shingle"))
        held = part if held is None else held.unionByName(part)
    number = F.size("shingles").cast("long").alias("n_shingles")
    asked = sketches.select(F.col("item").alias("i"), F.col("set").alias("s"), "least", number, "shingles")
    pairs = found.join(asked, F.col("item").eqNullSafe(F.col("i")) & (F.col("set") == F.col("s")))
    pairs = pairs.select(F.col("doc").alias("d"), F.col("copy").alias("c"), "item", "set", "least", "n_shingles", F.explode("shingles").alias("asked"))
    same = F.col("doc").eqNullSafe(F.col("d")) & (F.col("copy") == F.col("c")) & (F.col("shingle") == F.col("asked"))
    met = held.join(pairs, same).select("doc", "copy", "item", "set", "least", "n_shingles", "shingle").distinct()
    counted = met.groupBy("doc", "copy", "item", "set", "least", "n_shingles").agg(F.count(F.lit(1)).alias("n_found"))
    return counted.where(F.col("n_found") >= F.col("least")).select(
        "doc", "item", "n_shingles", "n_found", (F.col("n_found") / F.col("n_shingles")).alias("containment")
    ).distinct()
