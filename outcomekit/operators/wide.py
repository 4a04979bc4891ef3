"""Statistics of tables with thousands of columns: one pass over the rows in
Arrow batches, mergeable partial results, no unpivot and no aggregate node
with an expression per column or pair.

* ``wide_moments``: count, nulls, mean, M2, least and greatest value per column
  and class.  A task merges its batches by Chan's update; the tasks' rows
  (columns x classes each) are merged by the same update in an aggregate.
* ``pairwise_corr``: with X the values (0 where null) and M the 0 / 1 mask of
  present values, X'X, X'M, (X^2)'M and M'M hold every sum that Pearson's r of
  pairwise-complete rows needs.  A task adds up its batches by matrix products
  and gives out blocks of rows of the matrices; blocks are summed where they
  meet.  Values are shifted by a constant per column near its middle, which
  changes no r, so that squares do not swamp the differences.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SHIFT_ROWS = 1000            # rows whose mean is a column's shift; any shift gives the same r
BLOCK = 256                  # columns in a block of matrix rows

_MOMENTS = "j int, cls int, n long, missing long, mean double, m2 double, lo double, hi double"


def _array(df: DataFrame, features: list[str]) -> DataFrame:
    return df.withColumn("_x", F.array(*[F.col(f"`{f}`").cast("double") for f in features]))


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """Rows of a list<double> column; NaN where null."""
    return column.values.to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), width) if len(column) else np.zeros((0, width))


# ---- moments ------------------------------------------------------------

def merge_moments(a: dict[str, np.ndarray], b: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    """Chan's update of two sets of moments."""
    n = a["n"] + b["n"]
    safe = np.maximum(n, 1)
    gap = b["mean"] - a["mean"]
    return {"n": n, "missing": a["missing"] + b["missing"], "mean": a["mean"] + gap * b["n"] / safe,
            "m2": a["m2"] + b["m2"] + gap ** 2 * a["n"] * b["n"] / safe,
            "lo": np.fmin(a["lo"], b["lo"]), "hi": np.fmax(a["hi"], b["hi"])}


def batch_moments(x: np.ndarray) -> dict[str, np.ndarray]:
    here = ~np.isnan(x)
    n = here.sum(axis=0)
    mean = np.where(here, x, 0.0).sum(axis=0) / np.maximum(n, 1)
    return {"n": n, "missing": len(x) - n, "mean": mean, "m2": (np.where(here, x - mean, 0.0) ** 2).sum(axis=0),
            "lo": np.where(here, x, np.inf).min(axis=0, initial=np.inf), "hi": np.where(here, x, -np.inf).max(axis=0, initial=-np.inf)}


def _moments(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, dict[str, np.ndarray]] = {}
        for batch in batches:
            x, cls = _matrix(batch.column("_x"), width), batch.column("_c").to_numpy(zero_copy_only=False)
            for c in np.unique(cls).tolist():
                mine = batch_moments(x[cls == c])
                held[c] = merge_moments(held[c], mine) if c in held else mine
        for c, m in held.items():
            yield pa.record_batch([pa.array(np.arange(width, dtype=np.int32)), pa.array(np.full(width, c, np.int32)),
                                   pa.array(m["n"].astype(np.int64)), pa.array(m["missing"].astype(np.int64)),
                                   *(pa.array(m[k]) for k in ("mean", "m2", "lo", "hi"))],
                                  names=["j", "cls", "n", "missing", "mean", "m2", "lo", "hi"])
    return run


def wide_moments(df: DataFrame, features: list[str], label: str | None = None) -> DataFrame:
    """(``feature``, ``cls``, ``n``, ``missing``, ``mean``, ``m2``, ``min``,
    ``max``) per feature and class (-1: rows without one, or no label given).
    Nulls and NaN are missing; a feature without values has null statistics."""
    names = df.sparkSession.createDataFrame(list(enumerate(features)), "j int, feature string")
    cls = F.lit(-1) if label is None else F.coalesce(F.col(f"`{label}`").cast("int"), F.lit(-1))
    parts = _array(df, features).select("_x", cls.alias("_c")).mapInArrow(_moments(len(features)), _MOMENTS)
    seen = F.col("n") > 0
    total = parts.groupBy("j", "cls").agg(
        F.collect_list(F.when(seen, F.struct("n", "mean", "m2"))).alias("p"), F.sum("n").alias("n"), F.sum("missing").alias("missing"),
        F.min(F.when(seen, F.col("lo"))).alias("min"), F.max(F.when(seen, F.col("hi"))).alias("max"))
    # one entry per task: the mean of all, then what each task's rows add around it
    mean = F.aggregate("p", F.lit(0.0), lambda a, x: a + x["mean"] * x["n"] / F.col("n"))
    total = total.withColumn("mean", F.when(F.col("n") > 0, mean))
    m2 = F.aggregate("p", F.lit(0.0), lambda a, x: a + x["m2"] + x["n"] * (x["mean"] - F.col("mean")) ** 2)
    return total.withColumn("m2", F.when(F.col("n") > 0, m2)).join(F.broadcast(names), "j") \
        .select("feature", "cls", "n", "missing", "mean", "m2", "min", "max")


def group_moments(df: DataFrame, features: list[str], label: str = "label") -> DataFrame:
    """The table that ``stats.moments`` gives, for two classes 0 and 1 (rows
    without a class are left out): one row per feature."""
    parts = wide_moments(df.where(F.col(f"`{label}`").isin(0, 1)), features, label)
    one = lambda c, v: F.max(F.when(F.col("cls") == c, F.col(v)))                             # noqa: E731
    t = parts.groupBy("feature").agg(F.sum("n").alias("n"), F.min("min").alias("min"), F.max("max").alias("max"),
                                     *[one(c, v).alias(f"{v}_{c}") for c in (0, 1) for v in ("n", "mean", "m2")])
    n0, n1 = F.coalesce("n_0", F.lit(0)), F.coalesce("n_1", F.lit(0))
    m0, m1 = F.coalesce("mean_0", F.lit(0.0)), F.coalesce("mean_1", F.lit(0.0))
    gap = F.when((n0 > 0) & (n1 > 0), m1 - m0).otherwise(0.0)
    total = F.coalesce("m2_0", F.lit(0.0)) + F.coalesce("m2_1", F.lit(0.0)) + gap ** 2 * F.try_divide(n0 * n1, F.col("n"))
    below = F.col("n") - 1
    return t.select(
        "feature", "n", F.try_divide(n0 * m0 + n1 * m1, F.col("n")).alias("mean"), F.sqrt(F.try_divide(total, below)).alias("std"), "min", "max",
        n0.alias("n_0"), "mean_0", F.try_divide(F.col("m2_0"), F.col("n_0") - 1).alias("var_0"),
        n1.alias("n_1"), "mean_1", F.try_divide(F.col("m2_1"), F.col("n_1") - 1).alias("var_1"),
        F.try_divide(gap * n0 * n1, F.col("n") * below).alias("cov_xy"), F.sqrt(F.try_divide(n0 * n1, F.col("n") * below)).alias("std_y"))


# ---- correlation --------------------------------------------------------

_SUMS = 6                    # X'X, X'M, M'X, (X^2)'M, M'(X^2), M'M


def _gram(shift: np.ndarray):
    width = len(shift)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _matrix(batch.column("_x"), width) - shift
            here = ~np.isnan(x)
            m, x = here.astype(np.float64), np.where(here, x, 0.0)
            xm, sm = x.T @ m, (x * x).T @ m
            part = np.stack([x.T @ x, xm, xm.T, sm, sm.T, m.T @ m])
            total = part if total is None else np.add(total, part, out=total)
        if total is not None:
            for lo in range(0, width, BLOCK):
                yield pa.record_batch([pa.array([lo], pa.int32()), pa.array([np.ascontiguousarray(total[:, lo:lo + BLOCK]).tobytes()], pa.binary())],
                                      names=["lo", "sums"])
    return run


def _add_blocks(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            for lo, raw in zip(batch.column("lo").to_pylist(), batch.column("sums")):
                part = np.frombuffer(raw.as_buffer(), np.float64)
                held[lo] = held[lo] + part if lo in held else part
        for lo, flat in held.items():
            xx, xm, mx, sm, ms, mm = flat.reshape(_SUMS, -1, width)
            i, j = np.nonzero(np.arange(lo, lo + len(xx))[:, None] < np.arange(width))
            n, a, b = mm[i, j], xm[i, j], mx[i, j]
            with np.errstate(invalid="ignore", divide="ignore"):
                r = (n * xx[i, j] - a * b) / np.sqrt((n * sm[i, j] - a * a) * (n * ms[i, j] - b * b))
            # a constant leaves nothing but rounding in its variance
            flat_a, flat_b = n * sm[i, j] - a * a <= 1e-12 * n * sm[i, j], n * ms[i, j] - b * b <= 1e-12 * n * ms[i, j]
            r[flat_a | flat_b | ~np.isfinite(r)] = np.nan
            yield pa.record_batch([pa.array((lo + i).astype(np.int32)), pa.array(j.astype(np.int32)), pa.array(n.astype(np.int64)),
                                   pa.array(r, mask=np.isnan(r))], names=["i", "j", "n", "r"])
    return run


def pairwise_corr(df: DataFrame, features: list[str]) -> DataFrame:
    """(``i``, ``j``, ``feature_a``, ``feature_b``, ``n``, ``r``) for every pair
    i < j of ``features``: Pearson's r over the ``n`` rows in which both are
    present; null where it is not defined."""
    spark = df.sparkSession
    rows = _array(df, features).select("_x")
    some = rows.limit(SHIFT_ROWS).toPandas()["_x"]                       # at most SHIFT_ROWS rows
    shift = np.zeros(len(features))
    if len(some):
        x = np.array([[np.nan if v is None else v for v in r] for r in some], np.float64)
        here = np.isfinite(x)
        shift = np.where(here, x, 0.0).sum(axis=0) / np.maximum(here.sum(axis=0), 1)
    names = spark.createDataFrame(list(enumerate(features)), "k int, name string")           # one row per feature
    blocks = rows.mapInArrow(_gram(shift), "lo int, sums binary").repartition("lo")
    pairs = blocks.mapInArrow(_add_blocks(len(features)), "i int, j int, n long, r double")
    return (pairs.join(F.broadcast(names.toDF("i", "feature_a")), "i").join(F.broadcast(names.toDF("j", "feature_b")), "j")
            .select("i", "j", "feature_a", "feature_b", "n", "r"))
