"""Running totals over a global order without a single-task window.

``Window.orderBy`` with no partition puts every row in one task.  Here the
ordered column is cut into ranges (edges from ``approxQuantile``, applied by
``Bucketizer``'s binary search on executors); each range gets its own window
partition, and a tiny per-range totals table (groups x ranges rows) gives the
offset added to every row of a range.  Used by ROC / PR / average precision
over the distinct-score table, whose size grows with the data.
"""

from __future__ import annotations

import math

from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def _cut(df: DataFrame, order_col: str, ranges: int) -> DataFrame:
    """Add ``_rng``, the number of the range of ``order_col`` that a row lies in."""
    probs = [i / ranges for i in range(1, ranges)]
    edges = sorted(set(df.approxQuantile(order_col, probs, 1.0 / (10 * ranges))))
    splits = [float("-inf")] + [e for e in edges if math.isfinite(e)] + [float("inf")]
    return Bucketizer(splits=splits, inputCol=order_col, outputCol="_rng", handleInvalid="keep").transform(df)


def running_totals(df: DataFrame, order_col: str, sum_cols: list[str], by: list[str] | None = None,
                   descending: bool = True, rows_per_range: int = 500_000, prefix: str = "cum_",
                   tiebreak: list[str] | None = None) -> DataFrame:
    """Add ``cum_<c>`` = sum of ``c`` over all rows at or before this row in the
    (``by``-grouped) order of ``order_col`` then ``tiebreak`` (ascending).  Give
    a total order (unique ``order_col`` or a ``tiebreak``); ``order_col`` must be
    non-null."""
    by = list(by or [])
    ties = [F.col(t).asc() for t in (tiebreak or [])]
    n = df.count()
    ranges = max(1, math.ceil(n / rows_per_range))
    order = F.col(order_col).desc() if descending else F.col(order_col).asc()
    if ranges == 1:
        w = Window.partitionBy(*by).orderBy(order, *ties).rowsBetween(Window.unboundedPreceding, 0)
        return df.select("*", *[F.sum(c).over(w).alias(prefix + c) for c in sum_cols])

    bucketed = _cut(df, order_col, ranges)
    rng = F.col("_rng").desc() if descending else F.col("_rng").asc()
    totals = bucketed.groupBy(*by, "_rng").agg(*[F.sum(c).alias("_t_" + c) for c in sum_cols])
    wo = Window.partitionBy(*by).orderBy(rng).rowsBetween(Window.unboundedPreceding, -1)
    # groups x ranges rows; Spark broadcasts them only if they are small
    offsets = totals.select(*by, "_rng", *[F.coalesce(F.sum("_t_" + c).over(wo), F.lit(0)).alias("_o_" + c)
                                          for c in sum_cols])
    wl = Window.partitionBy(*by, "_rng").orderBy(order, *ties).rowsBetween(Window.unboundedPreceding, 0)
    return (
        bucketed.join(offsets, by + ["_rng"])
        .select(*df.columns, *[(F.sum(c).over(wl) + F.col("_o_" + c)).alias(prefix + c) for c in sum_cols])
    )


def neighbours_in_order(df: DataFrame, order_col: str, cols: list[str], by: list[str], descending: bool = True,
                        rows_per_range: int = 500_000) -> DataFrame:
    """Add ``prev_<c>`` and ``next_<c>``, the values of the rows before and
    after this one in the (``by``-grouped) order of ``order_col``; NULL at the ends.

    Like ``running_totals`` without a window over a whole group: neighbours
    inside a range come from that range's window, those across a border from a
    table of each range's first and last row (groups x ranges rows), in which
    empty ranges have no row and so are passed over.  ``order_col`` must be
    non-null and unique in its group; ``cols`` may hold NULLs."""
    ranges = max(1, math.ceil(df.count() / rows_per_range))
    order = F.col(order_col).desc() if descending else F.col(order_col).asc()
    if ranges == 1:
        w = Window.partitionBy(*by).orderBy(order)
        return df.select("*", *[F.lag(c).over(w).alias("prev_" + c) for c in cols],
                         *[F.lead(c).over(w).alias("next_" + c) for c in cols])
    bucketed = _cut(df, order_col, ranges)
    row, key = F.struct(*cols), (-F.col(order_col) if descending else F.col(order_col))
    ends = bucketed.groupBy(*by, "_rng").agg(F.min_by(row, key).alias("_first"), F.max_by(row, key).alias("_last"))
    wr = Window.partitionBy(*by).orderBy(F.col("_rng").desc() if descending else F.col("_rng").asc())
    ends = ends.select(*by, "_rng", F.lag("_last").over(wr).alias("_before"), F.lead("_first").over(wr).alias("_after"))
    wl = Window.partitionBy(*by, "_rng").orderBy(order)
    near = bucketed.withColumns({"_prev": F.lag(row).over(wl), "_next": F.lead(row).over(wl)}).join(ends, by + ["_rng"])
    prev, nxt = F.coalesce("_prev", "_before"), F.coalesce("_next", "_after")
    return near.select(*df.columns, *[prev[c].alias("prev_" + c) for c in cols], *[nxt[c].alias("next_" + c) for c in cols])
