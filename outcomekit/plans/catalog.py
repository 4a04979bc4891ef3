"""Query catalogue: name -> (Spark callable, reference SQL or None).

Each Spark callable takes ``(spark, sf_dir)`` and returns a DataFrame whose
column names match the SQL.  Real-valued outputs are rounded to 6 places on
both sides (engines differ in the last bits of a sum).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def rounded(df: DataFrame, places: int = 6, keep: tuple[str, ...] = ()) -> DataFrame:
    """Round every float column (oracle hashes compare rounded values);
    ``keep`` columns are already on a coarser grid and stay as they are."""
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)) and f.name not in keep:
            cols.append(F.round(F.col(f"`{f.name}`").cast("double"), places).alias(f.name))
        else:
            cols.append(F.col(f"`{f.name}`"))
    return df.select(*cols)


def load_all() -> None:
    """Import the modules that register queries."""
    from outcomekit.plans import q_profile, q_prep, q_stats, q_eval, q_balance, q_models, q_kernel, q_stored  # noqa: F401
