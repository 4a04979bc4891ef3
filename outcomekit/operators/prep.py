"""Cleaning, projection and imputation.

Fitted state is a small table with one row per feature (``fit_*``), applied
back with a pure projection whose fill / scale values are literals from that
table (``apply_*``).  Applying therefore never shuffles the data and works the
same on a batch or a streaming DataFrame.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from outcomekit.config import DEFAULT_ROLES, MISSING_THRESHOLD, Roles
from outcomekit.functions.expr import clamp_negative, safe_div, season_of_month, weekday_mon0
from outcomekit.functions.quantiles import exact_quantiles

_NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)
_TIME = (T.TimestampType, T.TimestampNTZType, T.DateType)
# Bound on rows pulled to the driver for a fitted table (one row per feature).
MAX_FIT_ROWS = 100_000


def _q(name: str) -> Column:
    return F.col(f"`{name}`")


# ---------------------------------------------------------------- kinds
def column_kinds(df: DataFrame) -> dict[str, list[str]]:
    """Split columns by kind from the schema (no data is read)."""
    kinds = {"numeric": [], "categorical": [], "datetime": [], "other": []}
    for f in df.schema.fields:
        if isinstance(f.dataType, _NUMERIC):
            kinds["numeric"].append(f.name)
        elif isinstance(f.dataType, T.StringType):
            kinds["categorical"].append(f.name)
        elif isinstance(f.dataType, _TIME):
            kinds["datetime"].append(f.name)
        else:
            kinds["other"].append(f.name)
    return kinds


def feature_columns(df: DataFrame, roles: Roles = DEFAULT_ROLES, exclude: tuple[str, ...] = ()) -> list[str]:
    """Numeric columns that are not ids, time or label (C14)."""
    skip = roles.non_features() | set(exclude)
    return [c for c in column_kinds(df)["numeric"] if c not in skip]


# ------------------------------------------------------------ scalar cleaning
def clamp_columns(df: DataFrame, cols: list[str], floor: float = 0.0) -> DataFrame:
    """Negatives -> floor; NULL stays NULL."""
    return df.withColumns({c: clamp_negative(_q(c), floor) for c in cols})


def parse_time_lenient(c: Column, fmt: str | None = None) -> Column:
    """Text -> timestamp, unparseable -> NULL (pandas errors='coerce')."""
    return F.try_to_timestamp(c, F.lit(fmt)) if fmt else F.try_to_timestamp(c)


def add_time_parts(df: DataFrame, time_col: str, prefix: str = "admit_") -> DataFrame:
    """Year, month, day, hour, weekday (Mon=0) and season columns."""
    t = _q(time_col)
    return df.withColumns({
        f"{prefix}year": F.year(t),
        f"{prefix}month": F.month(t),
        f"{prefix}day": F.dayofmonth(t),
        f"{prefix}hour": F.hour(t),
        f"{prefix}dayofweek": weekday_mon0(t),
        f"{prefix}season": season_of_month(F.month(t)),
    })


def drop_constant_columns(df: DataFrame, cols: list[str] | None = None) -> tuple[DataFrame, list[str]]:
    """Drop columns whose non-null values are all equal (or all NULL).

    One aggregate pass (min/max per column, a single output row)."""
    cols = cols or column_kinds(df)["numeric"]
    row = df.agg(*[(F.min(_q(c)).eqNullSafe(F.max(_q(c)))).alias(c) for c in cols]).first()
    dropped = [c for c in cols if row[c]]
    return df.drop(*dropped), dropped


# ------------------------------------------------------------- missingness
def missing_counts(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """(column, n_missing, n_rows, missing_rate) in one scan.

    A single global aggregate (one output row) then ``stack`` to long form."""
    cols = cols or df.columns
    agg = df.agg(F.count(F.lit(1)).alias("__n"),
                 *[F.count_if(_q(c).isNull()).alias(f"m{i}") for i, c in enumerate(cols)])
    pairs = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(f"m{i}").alias("n_missing")) for i, c in enumerate(cols)])
    return agg.select(F.col("__n").alias("n_rows"), F.inline(pairs)).select(
        "column_name", "n_missing", "n_rows",
        safe_div(F.col("n_missing").cast("double"), F.col("n_rows").cast("double")).alias("missing_rate"))


def fit_missingness(df: DataFrame, cols: list[str] | None = None,
                    threshold: float = MISSING_THRESHOLD) -> DataFrame:
    """C10 fit: keep = missing_rate < threshold (strict)."""
    return missing_counts(df, cols).withColumn("keep", F.col("missing_rate") < F.lit(float(threshold)))


def fitted_rows(fitted: DataFrame) -> list:
    """The rows of a fitted table (one per feature); an error, never a cut,
    where there are more than ``MAX_FIT_ROWS``."""
    rows = fitted.limit(MAX_FIT_ROWS + 1).collect()
    if len(rows) > MAX_FIT_ROWS:
        raise ValueError(f"fitted table larger than {MAX_FIT_ROWS} rows")
    return rows


def apply_missingness(df: DataFrame, fitted: DataFrame, protect: tuple[str, ...] = ()) -> DataFrame:
    rows = fitted_rows(fitted.select("column_name", "keep"))
    dropped = {r.column_name for r in rows if not r.keep} - set(protect)
    return df.drop(*[c for c in df.columns if c in dropped])


# ---------------------------------------------------------------- imputation
def to_long(df: DataFrame, ids: list[str], cols: list[str], name: str = "feature",
            value: str = "value") -> DataFrame:
    """Wide -> long (unpivot) with all values as double; NULL rows kept."""
    ids = [_q(i) for i in ids]
    return df.select(*ids, *[_q(c).cast("double").alias(c) for c in cols]).unpivot(ids, [_q(c) for c in cols], name, value)


def fit_impute(df: DataFrame, cols: list[str], strategy: str = "median") -> DataFrame:
    """C11 fit: (feature, fill) per numeric column; all-null column -> fill NULL."""
    if strategy == "zero":
        spark = df.sparkSession
        return spark.createDataFrame([(c, 0.0) for c in cols], "feature string, fill double")
    long = to_long(df, [], cols)
    if strategy == "mean":
        fills = long.groupBy("feature").agg(F.avg("value").alias("fill"))
    elif strategy == "median":
        fills = exact_quantiles(long, ["feature"], "value", [0.5]).select("feature", F.col("quantile").alias("fill"))
    else:
        raise ValueError(f"unknown strategy {strategy!r}")
    # keep all-null features (fill NULL) so the table has one row per feature
    names = df.sparkSession.createDataFrame([(c,) for c in cols], "feature string")
    return names.join(fills, "feature", "left")


def apply_impute(df: DataFrame, fills: DataFrame) -> DataFrame:
    """C11 apply: coalesce(col, fill) — a projection with literal fills."""
    rows = fitted_rows(fills)
    return df.withColumns({r.feature: F.coalesce(_q(r.feature), F.lit(r.fill).cast(df.schema[r.feature].dataType))
                           for r in rows if r.fill is not None})


def fit_mode(df: DataFrame, cols: list[str], unknown: str = "Unknown") -> DataFrame:
    """C13 fit: most frequent non-null text per column; ties -> smallest value;
    all-null -> ``unknown``.  Counts are per (column, value) groups, so a hot
    value is one pre-aggregated row, never a large group."""
    long = df.select(*[_q(c).cast("string").alias(c) for c in cols]).unpivot([], [_q(c) for c in cols], "feature", "value")
    counts = long.where(F.col("value").isNotNull()).groupBy("feature", "value").agg(F.count(F.lit(1)).alias("n"))
    best = counts.groupBy("feature").agg(
        F.min_by("value", F.struct(-F.col("n"), F.col("value"))).alias("mode"))
    names = df.sparkSession.createDataFrame([(c,) for c in cols], "feature string")
    return names.join(best, "feature", "left").select("feature", F.coalesce("mode", F.lit(unknown)).alias("fill"))


def apply_mode(df: DataFrame, fills: DataFrame) -> DataFrame:
    rows = fitted_rows(fills)
    return df.withColumns({r.feature: F.coalesce(_q(r.feature), F.lit(r.fill)) for r in rows})


# ---------------------------------------------------------------- scaling
def fit_standardiser(df: DataFrame, cols: list[str]) -> DataFrame:
    """C15 fit: mean and population std per feature (scikit-learn flavour);
    zero variance -> scale 1."""
    long = to_long(df, [], cols)
    return long.groupBy("feature").agg(
        F.avg("value").alias("mean"),
        F.stddev_pop("value").alias("std"),
    ).withColumn("scale", F.when((F.col("std") == 0) | F.col("std").isNull(), F.lit(1.0)).otherwise(F.col("std")))


def apply_standardiser(df: DataFrame, fitted: DataFrame) -> DataFrame:
    rows = fitted_rows(fitted)
    return df.withColumns({r.feature: (_q(r.feature).cast("double") - F.lit(r.mean)) / F.lit(r.scale)
                           for r in rows if r.mean is not None})


# ------------------------------------------------------------ label reports
def label_report(df: DataFrame, label: str) -> DataFrame:
    """Positive rate, positives, negatives (one row)."""
    y = _q(label)
    return df.agg(F.avg(y.cast("double")).alias("positive_rate"),
                  F.sum(y).cast("bigint").alias("n_positive"),
                  F.count_if(y == 0).alias("n_negative"))


def zero_share(df: DataFrame, cols: list[str]) -> DataFrame:
    """C4: share of exact zeros among non-null values, per column."""
    long = to_long(df, [], cols)
    return long.groupBy("feature").agg(
        F.count_if(F.col("value") == 0).alias("n_zero"),
        F.count("value").alias("n_present"),
    ).withColumn("zero_share", safe_div(F.col("n_zero").cast("double"), F.col("n_present").cast("double")))


FEW_ROWS = 100_000           # training rows that stay as they lie
ROWS_A_TASK = 1_000_000      # training rows of one task of a learner's steps


def few(n: int) -> bool:
    return n <= min(FEW_ROWS, ROWS_A_TASK)


def gathered(rows: DataFrame) -> DataFrame:
    """More than ``FEW_ROWS`` rows in as few partitions as the cores can
    share, of ``ROWS_A_TASK`` rows beyond that.  A learner runs hundreds of short jobs
    over its rows, and with the many small partitions of a shuffle their tasks' start
    is most of the time; trees also send the counts of all open nodes from each
    partition.  Few rows stay as they lie: where a row lies decides
    MLlib's samples for the cuts of trees and the order of its sums."""
    n = rows.count()
    if few(n):
        return rows
    return rows.coalesce(max(rows.sparkSession.sparkContext.defaultParallelism, math.ceil(n / ROWS_A_TASK)))
