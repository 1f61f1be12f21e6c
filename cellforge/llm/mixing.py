"""Mixing sources to target weights by pivotal dependent rounding.

Each source has a weight and a target in words; a document's copies are fractional,
``target / source_size``.  The whole part is taken as it is.  The fractions meet in pairs:
word mass moves from one document to the other, in a random direction whose odds keep
every expectation, until one of the two is integral (0 or 1).  The other goes on.  So the
source's word mass stays the same up to the last document left, which is rounded to the
nearer side.  That may be a long one, so what is then amiss is made up by other documents of the
source, the longest that fits first, each taken once more or once less (``_repaired``).

The pairs form a reduction tree of ``fanout``: documents are hashed into buckets of their
source, each bucket leaves one fractional document, and ``fanout`` neighbouring buckets
meet at the next level.  No task gets a source whole.  Directions come from hashes, so
reruns agree.  DataFrame operations only.

Defined cases: a null source is a source of its own, last in order; a null or negative size
counts 0; documents without words carry no mass and get one copy; rows that are equal in
key, source and size are one unit and get equal copies (a row each in the result); an empty
table gives an empty table.  Targets come from windows over one row for each source, so
sources are thought of as sites or sets (a million rows of three numbers in one task), not
as single pages.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cellforge.llm.tables import stash

WEIGHTS = (5, 2, 1)  # repeating over the sources in order
MOST_COPIES = 3
FANOUT = 32


def _let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def source_targets(sizes: DataFrame, weights=WEIGHTS, most: int = MOST_COPIES) -> DataFrame:
    """``source, source_size -> source, source_size, target``: all words are shared by
    weight; a target stops at ``most`` times its source's size and what it leaves is
    shared again.  That is ``least(weight * level, most * size)`` for one level, found
    from running sums over the sources, ordered by the level at which each one stops.
    One row for each source."""
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    table = F.array(*[F.lit(float(w)) for w in weights])
    place = (F.row_number().over(by_name) - 1) % len(weights)
    stops = F.lit(float(most)) * F.col("source_size")
    weighed = sizes.withColumn("weight", F.get(table, place.cast("int"))).withColumn("stop", stops / F.col("weight"))
    by_stop = Window.orderBy("stop", F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    rest = F.sum("source_size").over(everything) - F.coalesce(F.sum(stops).over(by_stop), F.lit(0.0))
    left = F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(by_stop), F.lit(0.0))
    levels = weighed.withColumn("level", rest / left)
    # The first source, in order of stops, that the level does not fill sets the level.
    level = F.min(F.struct(F.when(F.col("level") > F.col("stop"), 1).otherwise(0), F.col("stop"), F.col("level"))).over(everything)
    found = levels.withColumn("_l", level)
    target = F.when(F.col("_l.col1") == 1, stops).otherwise(F.least(F.col("weight") * F.col("_l.level"), stops))
    return found.select("source", F.col("source_size").cast("long").alias("source_size"), target.alias("target"))


def _fold(items: Column, seed: int, level: int) -> Column:
    """Array of (item, p) in which at most the last has a p strictly between 0 and 1."""

    def whole(p: Column) -> Column:
        return (p <= 0.0) | (p >= 1.0)

    def meet(acc: Column, x: Column) -> Column:
        a = acc["carry"]
        odds = F.xxhash64(F.lit(seed), F.lit(level), a["item"], x["item"])
        u = F.shiftrightunsigned(odds, 11) / F.lit(float(1 << 53))
        move = F.struct(
            F.least(a["mass"] * (1.0 - a["p"]), x["mass"] * x["p"]).alias("up"),
            F.least(a["mass"] * a["p"], x["mass"] * (1.0 - x["p"])).alias("down"),
            u.alias("u"),
        )

        def moved(m: Column) -> Column:
            up = m["u"] * (m["up"] + m["down"]) < m["down"]
            # The side that sets the move becomes integral exactly; the other takes the mass.
            a_ends = F.when(up, a["mass"] * (1.0 - a["p"]) <= x["mass"] * x["p"]).otherwise(
                a["mass"] * a["p"] <= x["mass"] * (1.0 - x["p"])
            )
            d = F.when(up, m["up"]).otherwise(-m["down"])
            ap = F.when(a_ends, F.when(up, 1.0).otherwise(0.0)).otherwise(a["p"] + d / a["mass"])
            xp = F.when(~a_ends, F.when(up, 0.0).otherwise(1.0)).otherwise(x["p"] - d / x["mass"])
            return F.struct(a_ends.alias("a_ends"), ap.alias("ap"), xp.alias("xp"))

        def settle(r: Column) -> Column:
            a2 = F.struct(a["item"].alias("item"), a["mass"].alias("mass"), r["ap"].alias("p"))
            x2 = F.struct(x["item"].alias("item"), x["mass"].alias("mass"), r["xp"].alias("p"))
            return F.struct(
                F.concat(acc["done"], F.array(F.when(r["a_ends"], a2).otherwise(x2))).alias("done"),
                F.when(r["a_ends"], x2).otherwise(a2).alias("carry"),
            )

        both = F.when(
            whole(a["p"]), F.struct(F.concat(acc["done"], F.array(a)).alias("done"), x.alias("carry"))
        ).otherwise(_let(_let(move, moved), settle))
        return both

    first = F.struct(F.slice(items, 1, 0).alias("done"), F.element_at(items, 1).alias("carry"))
    rest = F.slice(items, F.lit(2), F.size(items))
    return F.aggregate(rest, first, meet, lambda acc: F.concat(acc["done"], F.array(acc["carry"])))


def _reduced(items: DataFrame, fanout: int, seed: int, level: int) -> DataFrame:
    """One level of the tree: each (source, bucket) leaves one fractional item at most."""
    one = F.struct("mass", "item", "p")
    grouped = items.groupBy("source", "bucket").agg(F.sort_array(F.collect_list(one), asc=False).alias("all"))
    listed = F.transform("all", lambda i: F.struct(i["item"].alias("item"), i["mass"].alias("mass"), i["p"].alias("p")))
    folded = grouped.withColumn("all", listed).withColumn("all", _fold(F.col("all"), seed, level))
    return folded.select("source", F.floor(F.col("bucket") / fanout).cast("long").alias("bucket"), F.explode("all").alias("i")).select(
        "source", "bucket", "i.item", "i.mass", "i.p"
    )


def mix_sources(
    docs: DataFrame, key: list[str], source: str, size: str, weights=WEIGHTS, most: int = MOST_COPIES,
    fanout: int = FANOUT, seed: int = 42, per_row: bool = True,
) -> DataFrame:
    """``key..., source, size, source_size, target, copies``: a row for each row of
    ``docs`` (``per_row``) or for each distinct unit."""
    fields = [F.col(f"`{k}`").alias(f"k{i}") for i, k in enumerate(key)]
    count = F.greatest(F.coalesce(F.col(f"`{size}`").cast("long"), F.lit(0)), F.lit(0).cast("long"))
    rows = docs.select(F.struct(*fields).alias("key"), F.col(f"`{source}`").alias("source"), count.alias("size"))
    units = stash(rows.groupBy("key", "source", "size").agg(F.count(F.lit(1)).alias("times")), "mix-units")
    mass = F.col("size") * F.col("times")
    sizes = units.groupBy("source").agg(F.sum(mass).alias("source_size"), F.count(F.lit(1)).alias("units"))
    sizes = stash(sizes, "mix-sources")
    targets = source_targets(sizes.drop("units").withColumn("source_size", F.col("source_size").cast("double")), weights, most)
    targets = stash(targets.withColumnRenamed("source", "_source"), "mix-targets")
    counted = targets.join(
        sizes.select(F.col("source").alias("_s"), "units"), F.col("_source").eqNullSafe(F.col("_s"))
    ).drop("_s")

    share = F.least(F.coalesce(F.try_divide(F.col("target"), F.col("source_size")), F.lit(0.0)), F.lit(float(most)))
    joined = units.join(counted, F.col("source").eqNullSafe(F.col("_source")))
    known = joined.withColumn("share", share).withColumn("whole", F.floor("share").cast("int"))
    buckets = F.ceil(F.col("units") / F.lit(float(fanout)))
    item = F.struct("key", "size", "times", "source_size", "target", "whole")
    start = known.select(
        "source",
        F.pmod(F.xxhash64("key", "source", "size"), buckets).cast("long").alias("bucket"),
        item.alias("item"),
        (F.col("size") * F.col("times")).cast("double").alias("mass"),
        (F.col("share") - F.col("whole")).alias("p"),
    )
    open_ = (F.col("p") > 0.0) & (F.col("p") < 1.0) & (F.col("mass") > 0.0)
    done = [start.where(~open_)]
    left, most_units = start.where(open_), sizes.agg(F.coalesce(F.max("units"), F.lit(0))).first()[0]
    level, spread = 0, max(1, -(-int(most_units) // fanout))
    while True:
        met = stash(_reduced(left, fanout, seed, level), f"mix-level{level}")
        done.append(met.where(~open_))
        left = met.where(open_)
        if spread == 1:
            break
        level, spread = level + 1, -(-spread // fanout)
    done.append(left.withColumn("p", F.when(F.col("p") < 0.5, 0.0).otherwise(1.0)))  # one document of a source at most
    every = done[0]
    for part in done[1:]:
        every = every.unionByName(part)
    copies = F.when(F.col("mass") > 0.0, F.col("item.whole") + F.round("p").cast("int")).otherwise(F.lit(1))
    settled = stash(every.select("source", "item", "mass", copies.alias("copies")), "mix-settled")
    every = _repaired(settled, most, seed)
    if per_row:
        every = every.withColumn("_again", F.explode(F.array_repeat(F.lit(0), F.col("item.times").cast("int"))))
    return every.select(
        *[F.col(f"item.key.k{i}").alias(k) for i, k in enumerate(key)], "source", "item.size", "item.source_size", "item.target", "copies"
    )


SPARE = 2.0  # units looked at for each that may be needed


def _repaired(settled: DataFrame, most: int, seed: int) -> DataFrame:
    """``settled`` with the gap between each source's target and its taken words made up.

    The gap is half the longest document at most.  Units no larger than it are classed by powers
    of two; of each class about SPARE times as many as could fit into the gap are drawn by hash
    (so the list of a source is bounded by the words of its longest document), and taken, the
    largest that still fits first."""
    gaps = settled.groupBy(F.col("source").alias("s")).agg((F.max("item.target") - F.sum(F.col("mass") * F.col("copies"))).alias("gap"))
    gaps = stash(gaps.where(F.abs("gap") >= 1.0), "mix-gaps")
    room = F.when(F.col("gap") > 0, F.col("copies") < most).otherwise(F.col("copies") > 0)
    fits = settled.join(gaps, F.col("source").eqNullSafe(F.col("s"))).where(room & (F.col("mass") > 0) & (F.col("mass") <= F.abs("gap")))
    u = F.shiftrightunsigned(F.xxhash64(F.lit(seed), F.lit("repair"), "item.key", "source", "item.size"), 11) / F.lit(float(1 << 53))
    fits = fits.select("s", "gap", "mass", "item.key", "item.size", F.floor(F.log2("mass")).alias("class"), u.alias("u"))
    classes = stash(fits.groupBy(F.col("s").alias("cs"), F.col("class").alias("c")).agg(F.count(F.lit(1)).alias("n")), "mix-classes")
    wanted = F.lit(SPARE) * (F.abs("gap") / F.pow(F.lit(2.0), F.col("class")) + 2.0)
    drawn = fits.join(classes, F.col("s").eqNullSafe(F.col("cs")) & (F.col("class") == F.col("c"))).where(F.col("u") * F.col("n") < wanted)
    lists = drawn.groupBy("s").agg(F.first("gap").alias("gap"), F.sort_array(F.collect_list(F.struct("mass", "u", "key", "size")), asc=False).alias("units"))
    start = F.struct(F.abs("gap").alias("left"), F.lit("").alias("taken"))

    def take(state: Column, unit: Column) -> Column:
        fit = unit["mass"] <= state["left"]
        left = F.when(fit, state["left"] - unit["mass"]).otherwise(state["left"])
        return F.struct(left.alias("left"), F.concat(state["taken"], F.when(fit, "1").otherwise("0")).alias("taken"))

    marked = lists.withColumn("taken", F.aggregate("units", start, take, lambda state: state["taken"]))
    flips = marked.select("s", "gap", "taken", F.posexplode("units").alias("at", "unit")).where(F.expr("substring(taken, at + 1, 1) = '1'"))
    flips = stash(flips.select("s", F.col("unit.key").alias("fk"), F.col("unit.size").alias("fs"), F.signum("gap").cast("int").alias("flip")), "mix-flips")
    same = F.col("source").eqNullSafe(F.col("s")) & F.col("item.key").eqNullSafe(F.col("fk")) & (F.col("item.size") == F.col("fs"))
    joined = settled.join(flips, same, "left")
    return joined.select("source", "item", "mass", (F.col("copies") + F.coalesce("flip", F.lit(0))).alias("copies"))
