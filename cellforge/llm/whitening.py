"""Embedding whitening over distinct vectors.

Equal vectors are grouped first.  The fit sees each distinct vector once, weighted by one or by
its number of rows; the covariance is a sum over blocks of centred vectors (one matrix product
a block, Spark sums the products), its eigenvectors are found on the driver (dimension squared
numbers, whatever the number of rows).  Each distinct vector is whitened once and joined back
to its rows.

Vectors are compared and fitted in steps: x = floor(STEPS * entry) as whole numbers.

Defined cases: a null vector, or one with null or non-finite entries, is dropped; so are vectors
of another length than the commonest (the longer of equally common ones; an empty vector never
counts).  Null ids and repeated ids are rows like others.  Steps beyond 2**53 are cut off
there.  Equal eigenvalues have any basis.  A component without variance (an eigenvalue under
1e-12 of the largest) has whitened null; its share of an all-zero covariance is null.
``deviation`` is exact, and null where it does not fit in a long.  Other columns are not
read; no usable vector gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellforge.llm.tables import stash, unstash

STEPS = 256
FLAT = 1e-12  # of the largest eigenvalue
BLOCK = 4096  # vectors of a matrix product
EXACT = 2**53


def steps(vector: Column) -> Column:
    """x of a vector without nulls: whole steps of each entry, as longs."""
    return F.transform(vector, lambda c: F.floor(F.greatest(F.least(c.cast("double") * STEPS, F.lit(float(EXACT))), F.lit(-float(EXACT)))))


def usable(df: DataFrame, key: str, vector: str) -> DataFrame:
    """``id, x`` of the rows whose vector is usable and of the commonest length."""
    v = F.col(f"`{vector}`")
    # NaN sorts above every number, so one comparison each way rejects it and the infinities.
    good = lambda c: c.isNotNull() & (c.cast("double") < float("inf")) & (c.cast("double") > float("-inf"))
    rows = df.where(v.isNotNull() & (F.size(v) > 0)).where(F.forall(v, good))
    common = rows.groupBy(F.size(v).alias("size")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), F.desc("size")).first()
    size = common["size"] if common else 0
    return rows.where(F.size(v) == size).select(F.col(f"`{key}`").alias("id"), steps(v).alias("x"))


@dataclass(frozen=True)
class Whitener:
    """``n`` vectors fitted (or their weight) with sums ``total`` per dimension; ``axes``:
    a unit eigenvector a row, by falling ``values``; ``trace`` of the covariance."""

    n: int
    total: tuple[int, ...]
    axes: np.ndarray
    values: np.ndarray
    trace: float

    def project(self, x: np.ndarray) -> np.ndarray:
        """Whitened components of whole-number vectors (rows); NaN where there is no variance."""
        centred = x - np.array([t / self.n for t in self.total])
        flat = self.values <= FLAT * max(self.values.max(initial=0.0), 0.0)
        with np.errstate(divide="ignore", invalid="ignore"):
            return np.where(flat, np.nan, centred @ self.axes.T / np.sqrt(np.where(flat, 1.0, self.values)))

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Sum over dimensions of (n * x - total)**2, exactly."""
        total = np.array(self.total, dtype=object)
        most = max([abs(t) for t in self.total] + [self.n * int(np.abs(x).max(initial=0))])
        if len(self.total) * (2 * most) ** 2 < 2**63:
            far = self.n * x - total.astype(np.int64)
            return (far * far).sum(axis=1).tolist()
        exact = [int(v) for v in ((self.n * x.astype(object) - total) ** 2).sum(axis=1)]
        return [v if v < 2**63 else None for v in exact]


def _matrix(column: pa.Array, size: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, size)


def fit_whitener(distinct: DataFrame, components: int, weight: str | None = None) -> Whitener | None:
    """``distinct`` has ``x`` (each once) and, if named, whole-number weights."""
    w = F.col(weight).cast("decimal(38,0)") if weight else F.lit(1).cast("decimal(38,0)")
    sums = distinct.select(F.posexplode("x").alias("at", "v"), w.alias("w"))
    sums = sums.groupBy("at").agg(F.sum(F.col("v") * F.col("w")).alias("total"), F.sum("w").alias("n")).orderBy("at").collect()
    if not sums:
        return None
    total, n = tuple(int(r["total"]) for r in sums), int(sums[0]["n"])
    size, mean = len(total), np.array([int(r["total"]) / n for r in sums])

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gram = None
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK):
                part = batch.slice(at, BLOCK)
                centred = _matrix(part.column("x"), size) - mean
                weighed = centred * part.column("w").to_numpy(zero_copy_only=False)[:, None]
                gram = weighed.T @ centred if gram is None else gram + weighed.T @ centred
        if gram is not None:
            rows = pa.array(list(gram), pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(size), pa.int32()), rows], names=["i", "row"])

    weighed = distinct.select("x", w.cast("double").alias("w")).mapInArrow(products, "i int, row array<double>")
    cells = weighed.select("i", F.posexplode("row").alias("j", "v")).groupBy("i", "j").agg(F.sum("v").alias("v")).collect()  # size**2
    covariance = np.zeros((size, size))
    for r in cells:
        covariance[r["i"], r["j"]] = r["v"] / n
    covariance = (covariance + covariance.T) / 2
    values, vectors = np.linalg.eigh(covariance)
    order = np.argsort(-values, kind="stable")[:components]
    return Whitener(n, total, np.ascontiguousarray(vectors[:, order].T), np.maximum(values[order], 0.0), float(np.trace(covariance)))


def whiten(df: DataFrame, key: str = "vec_id", vector: str = "embedding", components: int = 4, by_rows: bool = False) -> DataFrame:
    """``key, component, n, deviation, whitened, explained, identity_error`` for each usable
    row and component.  ``by_rows``: a distinct vector weighs as many as its rows."""
    rows = stash(usable(df, key, vector), "whiten-rows")
    distinct = stash(rows.groupBy("x").agg(F.count(F.lit(1)).alias("rows")), "whiten-distinct")  # tasks merge theirs first
    model = fit_whitener(distinct, components, "rows" if by_rows else None)
    schema = f"`{key}` {rows.schema['id'].dataType.simpleString()}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    if model is None:
        return df.sparkSession.createDataFrame([], schema)

    def once(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch.column("x"), len(model.total))
            white = pa.array(list(model.project(x)), pa.list_(pa.float64()))
            arrays = [batch.column("x"), batch.column("rows"), pa.array(model.deviations(x), pa.int64()), white]
            yield pa.RecordBatch.from_arrays(arrays, names=["x", "rows", "deviation", "white"])

    whitened = stash(distinct.mapInArrow(once, "x array<bigint>, rows long, deviation long, white array<double>"), "whiten-once")
    unstash(distinct)
    k = len(model.values)
    w = F.col("rows").cast("double") if by_rows else F.lit(1.0)
    cells = [(F.sum(w * F.get("white", i) * F.get("white", j)) / float(model.n)).alias(f"c{i}_{j}") for i in range(k) for j in range(k)]
    means = [(F.sum(w * F.get("white", i)) / float(model.n)).alias(f"m{i}") for i in range(k)]
    seen = whitened.agg(*cells, *means).first()
    off = [abs(seen[f"c{i}_{j}"] - seen[f"m{i}"] * seen[f"m{j}"] - (i == j)) for i in range(k) for j in range(k)]
    off = [v for v in off if v == v]  # components without variance are NaN
    share = [float(v / model.trace) if model.trace > 0 else None for v in model.values]
    told = F.array(*[F.struct(F.lit(i + 1).alias("component"), F.lit(v).cast("double").alias("explained")) for i, v in enumerate(share)])
    joined = rows.join(whitened, "x").withColumn("c", F.explode(told))
    value = F.get("white", F.col("c.component") - 1)
    return joined.select(
        F.col("id").alias(key), "c.component", F.lit(model.n).cast("long").alias("n"), "deviation", F.nanvl(value, F.lit(None).cast("double")).alias("whitened"),
        "c.explained", F.lit(max(off) if off else None).cast("double").alias("identity_error"),
    )
