"""Group-safe splitting and folds.

The default split is a pure projection: a subject goes to the test side when
the first 32 bits of md5(subject) mod 100 fall under the test share.  No row
moves, no driver list of ids, and the assignment is stable when new data
arrives.  ``split_exact`` reproduces "exactly ceil(share * n_subjects)"
subjects by ranking the hashes of the distinct subjects.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from outcomekit.config import TEST_SHARE_PERCENT
from outcomekit.functions.expr import hash_bucket


def split_column(subject: str, test_percent: int = TEST_SHARE_PERCENT, salt: str = ""):
    return F.when(hash_bucket(subject, 100, salt) < test_percent, F.lit("test")).otherwise(F.lit("train"))


def group_split(df: DataFrame, subject: str, test_percent: int = TEST_SHARE_PERCENT,
                col: str = "split") -> DataFrame:
    """Add ``split`` in {'train','test'}; every subject lands on one side."""
    return df.withColumn(col, split_column(subject, test_percent))


def _hash_order(key: str):
    """First 52 bits of md5(key) as an exactly representable double; a null key hashes as empty."""
    return F.conv(F.substring(F.md5(F.coalesce(F.col(key).cast("string"), F.lit(""))), 1, 13), 16, 10).cast("bigint").cast("double")


def split_exact(df: DataFrame, subject: str, test_share: float = TEST_SHARE_PERCENT / 100,
                col: str = "split") -> DataFrame:
    """J5 exact size: test = the ceil(share * n) distinct subjects with the
    smallest hash.  The position of each subject in hash order comes from
    range-bucketed running counts over the distinct-subject table (no single
    task sees all subjects); only the subject -> side table joins back.  Rows
    without a subject are one subject."""
    from outcomekit.functions.prefix import running_totals
    subjects = df.select(subject).distinct().withColumn("_o", _hash_order(subject)).withColumn("_one", F.lit(1))
    n = subjects.count()
    k = math.ceil(test_share * n)
    pos = running_totals(subjects, "_o", ["_one"], descending=False, tiebreak=[subject])
    side = pos.select(F.col(subject).alias("_subject"),
                      F.when(F.col("cum__one") <= k, F.lit("test")).otherwise(F.lit("train")).alias(col))
    return df.join(side, F.col(subject).eqNullSafe(F.col("_subject")), "left").drop("_subject")


def semi_join_keys(df: DataFrame, keys: DataFrame, on: str) -> DataFrame:
    """Rows whose key is in ``keys`` (EXISTS)."""
    return df.join(keys.select(on).distinct(), on, "left_semi")


def anti_join_keys(df: DataFrame, keys: DataFrame, on: str) -> DataFrame:
    """J3 complement (NOT EXISTS)."""
    return df.join(keys.select(on).distinct(), on, "left_anti")


def stratified_folds(df: DataFrame, key: str, label: str, k: int = 3, col: str = "fold") -> DataFrame:
    """Within each label class, rows ordered by md5(key) are dealt to
    folds 0, 1, ..., k-1 in turn, so each fold keeps the class balance.  Rows
    that share a key are dealt one by one: none is lost or repeated.

    The class is a huge group, so the position is a range-bucketed running
    count (``functions.prefix``), not one window over the class."""
    from outcomekit.functions.prefix import running_totals
    keyed = df.withColumn("_o", _hash_order(key)).withColumn("_one", F.lit(1))
    ranked = running_totals(keyed, "_o", ["_one"], by=[label], descending=False, tiebreak=[key])
    return ranked.select(*[F.col(f"`{c}`") for c in df.columns], ((F.col("cum__one") - 1) % k).cast("int").alias(col))
