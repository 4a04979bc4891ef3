"""Preprocessing flow (lifecycle 3a) on the driver cohort.

cohort -> clamp -> time parts -> subject split -> missingness cut (fit on
train) -> median impute (fit on train).  The flow is one lazy plan broken by
two small actions: the missing-rate row (decides the column list) and the
fill table (one literal per feature).  Both fitted tables have one row per
feature.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from outcomekit.config import DEFAULT_ROLES, MISSING_THRESHOLD, Roles
from outcomekit.operators import prep
from outcomekit.operators.split import group_split
from outcomekit.sources.cohort import COHORT_FEATURES, build_cohort

TIME_FEATURES = ["admit_year", "admit_month", "admit_day", "admit_hour", "admit_dayofweek", "admit_season"]
CANDIDATE_FEATURES = COHORT_FEATURES + TIME_FEATURES


def prepared_cohort(spark: SparkSession, sf_dir: str, roles: Roles = DEFAULT_ROLES, outcome: str = "urgent") -> DataFrame:
    """Cohort with negatives clamped, time parts, ``split`` and double features."""
    c = build_cohort(spark, sf_dir, roles, outcome)
    c = prep.clamp_columns(c, ["balance"])
    c = prep.add_time_parts(c, roles.time)
    c = group_split(c, roles.subject)
    return c.withColumns({f: F.col(f).cast("double") for f in CANDIDATE_FEATURES})


@dataclass
class Prepared:
    data: DataFrame            # all rows, selected + imputed features, with split
    features: list[str]        # kept features
    missingness: DataFrame     # fitted (column_name, n_missing, n_rows, missing_rate, keep)
    fills: DataFrame           # fitted (feature, fill)

    @property
    def train(self) -> DataFrame:
        return self.data.where(F.col("split") == "train")

    @property
    def test(self) -> DataFrame:
        return self.data.where(F.col("split") == "test")


def _local(small: DataFrame) -> DataFrame:
    return small.sparkSession.createDataFrame(prep.fitted_rows(small), small.schema)


def prepare(spark: SparkSession, sf_dir: str, roles: Roles = DEFAULT_ROLES,
            threshold: float = MISSING_THRESHOLD, strategy: str = "median",
            fit_on: str = "train", outcome: str = "urgent") -> Prepared:
    """``fit_on="train"`` fits missing rates and fills on the training split
    only; ``fit_on="all"`` reproduces fitting on every row (leaks test rows)."""
    # read three times (missing rates, fill values, apply): keep it cached
    # (MEMORY_AND_DISK; a lost block is recomputed from lineage)
    c = prepared_cohort(spark, sf_dir, roles, outcome).cache()
    train = c.where(F.col("split") == "train") if fit_on == "train" else c
    # fitted tables have one row per feature: pull them once and keep them as
    # local relations (no cache entries that every later plan is matched against)
    miss = _local(prep.fit_missingness(train, CANDIDATE_FEATURES, threshold))
    kept = [r.column_name for r in miss.where("keep").select("column_name").collect()]
    kept = [f for f in CANDIDATE_FEATURES if f in set(kept)]
    fills = _local(prep.fit_impute(train, kept, strategy))
    data = prep.apply_impute(c.select(roles.stay, roles.subject, roles.time, roles.label, "segment",
                                      "split", *kept), fills)
    return Prepared(data, kept, miss, fills)
