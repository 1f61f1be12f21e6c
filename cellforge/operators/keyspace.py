"""Key space of numeric-string row keys: prefix CDFs, the partitioner, the histogram.

A key is placed by its first ``chars`` characters.  The CDF over the prefixes
``10**(chars-1) .. 10**chars - 1`` is either

* theoretical (Benford): the exclusive running sum of ``log10(1 + 1/p)``, which
  telescopes to ``log10(p / 10**(chars-1))`` -- a closed form, so no table and no join;
* sampled: from (key, count) samples, the exclusive running share per prefix over the
  full prefix grid.

Partition id of a key for ``n`` partitions: 0 when ``n == 1``, when the key is under 4
bytes, or when its prefix has no CDF entry; else ``int(float32(cdf) * float32(n))``
with the CDF rounded to 7 digits first (the partitioner multiplies 7-digit float
values).  The histogram uses the same lookup but double arithmetic and leaves an
unknown prefix as a NULL bin.

Size bounds: a CDF table has at most ``9 * 10**(chars-1)`` rows by construction (it is
re-aggregated on the prefix grid before use), so it is broadcast only while
``chars <= MAX_BROADCAST_CHARS``; beyond that the lookup is an ordinary shuffle join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cellforge.functions.scalars import key_prefix, leading_number, numeric_prefix
from cellforge.schema import CDF_DIGITS, MIN_KEY_BYTES
from cellforge.session import ensure_checkpoint_dir

MAX_BROADCAST_CHARS = 5  # 90,000 prefixes x (int, double): ~2 MB


def _grid(chars: int) -> tuple[int, int]:
    if chars < 1:
        raise ValueError("chars must be >= 1")
    return 10 ** (chars - 1), 10**chars - 1


def theoretical_cdf(prefix: Column, chars: int = 3) -> Column:
    """Benford CDF of an integer prefix column (valid for prefixes on the grid)."""
    lo, _ = _grid(chars)
    return F.log10(prefix.cast("double") / F.lit(float(lo)))


def benford_cdf(spark: SparkSession, chars: int = 3) -> DataFrame:
    """``(prefix int, cdf double)`` of Benford's law over the prefix grid."""
    lo, hi = _grid(chars)
    grid = spark.range(lo, hi + 1).select(F.col("id").cast("int").alias("prefix"))
    return grid.select("prefix", theoretical_cdf(F.col("prefix"), chars).alias("cdf"))


def prefix_mass(samples: DataFrame, key_col: str, count_col: str | None = None, chars: int = 3) -> DataFrame:
    """``(prefix int, n double)``: summed counts per numeric prefix of the sample keys;
    keys with a smaller (or no) numeric prefix are lumped into the first prefix.
    Without ``count_col`` every sample row counts 1; a text count is read by its
    leading number (``"12abc"`` counts 12, no number counts 0)."""
    weight = F.lit(1.0) if count_col is None else leading_number(F.col(count_col))
    return (
        samples.select(numeric_prefix(F.col(key_col), chars).alias("prefix"), weight.alias("w"))
        .groupBy("prefix")
        .agg(F.sum("w").alias("n"))
    )


def sampled_cdf(samples: DataFrame, key_col: str, count_col: str | None = None, chars: int = 3) -> DataFrame:
    """``(prefix int, n double, cdf double)`` over the whole prefix grid: the share of
    all sample counts at prefixes strictly below ``prefix``.

    The aggregation runs over the samples (partial + final); the running sum then
    runs over the grid only (``9 * 10**(chars-1)`` rows), never over the samples.
    """
    lo, hi = _grid(chars)
    spark = samples.sparkSession
    mass = prefix_mass(samples, key_col, count_col, chars)
    if chars <= MAX_BROADCAST_CHARS:
        mass = F.broadcast(mass)
    grid = spark.range(lo, hi + 1, numPartitions=1).select(F.col("id").cast("int").alias("prefix"))
    joined = grid.join(mass, "prefix", "left").select("prefix", F.coalesce("n", F.lit(0.0)).alias("n"))
    before = Window.orderBy("prefix").rowsBetween(Window.unboundedPreceding, -1)
    total = Window.partitionBy()
    return joined.select(
        "prefix",
        "n",
        F.try_divide(F.coalesce(F.sum("n").over(before), F.lit(0.0)), F.sum("n").over(total)).alias("cdf"),
    )


SKETCH_K = 4096  # of the quantile sketch
SKETCH_ERROR = 0.01  # of a rank; far above the sketch's own bound at SKETCH_K


def key_sketch(keys: DataFrame, key_col: str, chars: int = 3) -> DataFrame:
    """One row: ``sketch``, a quantile sketch of the numeric prefixes of a load's keys (a row
    each), to be saved with the load.  Tasks build theirs, which are merged."""
    prefix = numeric_prefix(F.col(key_col), chars).cast("bigint").alias("prefix")
    return keys.select(prefix).agg(F.kll_sketch_agg_bigint("prefix", SKETCH_K).alias("sketch"))


def sketch_cdf(sketches: DataFrame, chars: int = 3) -> DataFrame:
    """``(prefix int, cdf double)`` over the prefix grid from the saved sketches of any number of
    loads: no key is read again.  A rank is off by SKETCH_ERROR at most.  No keys, no rows."""
    lo, hi = _grid(chars)
    merged = sketches.where("sketch is not null").agg(F.kll_merge_agg_bigint("sketch").alias("sketch"))
    ranks = F.kll_sketch_get_rank_bigint("sketch", F.sequence(F.lit(lo - 1).cast("bigint"), F.lit(hi - 1).cast("bigint")))
    known = F.when(F.kll_sketch_get_n_bigint("sketch") > 0, ranks)
    told = merged.where("sketch is not null").select(F.posexplode(known).alias("at", "cdf"))
    return told.select((F.col("at") + lo).cast("int").alias("prefix"), F.when(F.col("at") == 0, F.lit(0.0)).otherwise(F.col("cdf")).alias("cdf"))


def _cdf_table(cdf: DataFrame, chars: int) -> DataFrame:
    """A caller's CDF re-aggregated onto the grid: string prefix -> cdf, bounded size."""
    lo, hi = _grid(chars)
    table = (
        cdf.where(F.col("prefix").between(lo, hi))
        .groupBy(F.col("prefix").cast("string").alias("_prefix"))
        .agg(F.max("cdf").alias("_cdf"))
    )
    return F.broadcast(table) if chars <= MAX_BROADCAST_CHARS else table


def with_cdf(df: DataFrame, key_col: str, cdf: DataFrame | None = None, chars: int = 3, out: str = "cdf") -> DataFrame:
    """Adds the CDF value of each key's prefix (NULL when the prefix is not on the
    grid).  ``cdf=None`` uses the theoretical closed form, with no join."""
    prefix = key_prefix(F.col(key_col), chars)
    if cdf is None:
        on_grid = prefix.rlike(f"^[1-9][0-9]{{{chars - 1}}}$")
        value = F.when(on_grid, theoretical_cdf(prefix.try_cast("int"), chars))
        return df.withColumn(out, value)
    keyed = df.withColumn("_prefix", prefix)
    return keyed.join(_cdf_table(cdf, chars), "_prefix", "left").drop("_prefix").withColumnRenamed("_cdf", out)


def partition_id(key: Column, cdf: Column, n: int) -> Column:
    """Partition of a key from its CDF value (see module notes); always in [0, n)."""
    if n < 1:
        raise ValueError("n must be >= 1")
    if n == 1:
        return F.lit(0)
    part = (F.round(cdf, CDF_DIGITS).cast("float") * F.lit(float(n)).cast("float")).cast("int")
    return (
        F.when(F.octet_length(key) < MIN_KEY_BYTES, F.lit(0))
        .when(cdf.isNull(), F.lit(0))
        .otherwise(F.least(part, F.lit(n - 1)))
    )


def assign_partition(
    df: DataFrame, key_col: str, n: int, cdf: DataFrame | None = None, chars: int = 3, out: str = "partition"
) -> DataFrame:
    """Adds the distribution-aware partition id of every key."""
    keyed = with_cdf(df, key_col, cdf, chars, out="_cdf")
    return keyed.withColumn(out, partition_id(F.col(key_col), F.col("_cdf"), n)).drop("_cdf")


def place_by_partition(df: DataFrame, n: int, partition_col: str = "partition") -> DataFrame:
    """Physically moves every record to its assigned partition (no hashing)."""
    return df.repartitionById(n, F.col(partition_col))


RUN_SHARE = 0.6  # of a partition's mean mass: the largest run then stays under twice the mean run


def run_starts(df: DataFrame, key_col: str, n: int, cdf: DataFrame | None = None, chars: int = 3) -> list[str]:
    """Starts of the ordered runs of the ``n`` partitions, as ``partition|key``: a partition that
    holds more than RUN_SHARE of the mean is cut at quantiles of its whole keys."""
    from cellforge.operators.splits import key_intervals, starts_of

    placed = assign_partition(df.select(key_col), key_col, n, cdf, chars, out="_part")
    ensure_checkpoint_dir(df.sparkSession)
    keyed = placed.select(run_key(F.col("_part"), F.col(key_col)).alias("k")).checkpoint(eager=True)  # read in every round
    intervals = key_intervals(keyed, "k", int(n / RUN_SHARE) + 1)
    share = RUN_SHARE * sum(i.mass for i in intervals) / n
    starts = []
    for part in range(n):
        head = f"{part:0{PART_DIGITS}d}|"
        mine = [i for i in intervals if i.least.startswith(head) and i.most.startswith(head)]
        mass = sum(i.mass for i in mine)
        runs = int(-(-mass // share)) if share else 1
        starts += [head] + (starts_of(mine, runs) if runs > 1 else [])
    return starts


PART_DIGITS = 9


def run_key(partition: Column, key: Column) -> Column:
    """Orders keys by partition, then by key."""
    return F.concat(F.lpad(partition.cast("string"), PART_DIGITS, "0"), F.lit("|"), key)


def assign_run(
    df: DataFrame, key_col: str, n: int, starts: list[str], cdf: DataFrame | None = None, chars: int = 3, out: str = "run_id"
) -> DataFrame:
    """Adds ``partition`` and ``out``, the place of the key's run among all runs."""
    from cellforge.operators.scan import region_of

    placed = assign_partition(df, key_col, n, cdf, chars)
    return placed.withColumn(out, region_of(run_key(F.col("partition"), F.col(key_col)), starts) - 1)


def region_starts(cdf: DataFrame, n: int, chars: int = 3) -> list[str]:
    """Start keys of regions 1..n-1 from a prefix CDF: region i begins at the first
    prefix whose partition id (as ``partition_id`` computes it) is i.  At most ``n``
    values reach the driver (one per region).  A prefix too hot for its region spans ids,
    some of which then start nowhere: that raises.  No samples give no starts."""
    lo, hi = _grid(chars)
    if n > hi - lo + 1:
        raise ValueError(f"{n} regions asked, {hi - lo + 1} prefixes of {chars} characters: use more characters")
    part = (F.round("cdf", CDF_DIGITS).cast("float") * F.lit(float(n)).cast("float")).cast("int")
    firsts = (
        cdf.where(F.col("prefix").between(lo, hi) & F.col("cdf").isNotNull())
        .groupBy(F.least(part, F.lit(n - 1)).alias("part"))
        .agg(F.min("prefix").alias("start"))
    ).collect()
    starts = [str(r.start) for r in sorted(firsts, key=lambda r: r.part) if r.part >= 1]
    if firsts and len(starts) < n - 1:
        raise ValueError(f"{n} regions asked, only {len(starts) + 1} begin at prefixes of {chars} characters: use more characters")
    return starts


def partition_histogram(
    df: DataFrame, key_col: str, bins: int = 10, cdf: DataFrame | None = None, chars: int = 3
) -> DataFrame:
    """``(bin int, n bigint)``: records per bin ``int(cdf * bins)``; keys whose prefix is
    not on the grid form the NULL bin."""
    keyed = with_cdf(df.select(key_col), key_col, cdf, chars, out="_cdf")
    binned = keyed.select((F.round("_cdf", CDF_DIGITS) * F.lit(float(bins))).cast("int").alias("bin"))
    return binned.groupBy("bin").agg(F.count(F.lit(1)).alias("n"))


def balance(counts: DataFrame, n_col: str = "n") -> DataFrame:
    """``(parts, max_n, avg_n, skew)`` of a per-partition count table (skew = max/avg)."""
    return counts.agg(
        F.count(F.lit(1)).alias("parts"),
        F.max(n_col).alias("max_n"),
        F.avg(n_col).alias("avg_n"),
        (F.max(n_col) / F.avg(n_col)).alias("skew"),
    )
