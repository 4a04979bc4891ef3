"""Scans (S1, S2): parquet / CSV readers plus the null normaliser.

pandas treats several text tokens and float NaN as "missing"; Spark
aggregates skip NULL but propagate NaN.  ``normalise_nulls`` turns both
into NULL right after the scan so every later aggregate has pandas'
skip-missing semantics.  It is a pure projection (no shuffle) and keeps
parquet column pruning / filter pushdown intact.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Text tokens read as missing by the pandas CSV default.
NA_TOKENS = ("", "NA", "N/A", "NaN", "nan", "null", "NULL", "None", "#N/A", "n/a", "-NaN", "-nan")


class TableMissing(FileNotFoundError):
    """Raised by ``load_table(required=True)`` when the input is absent."""


def _nan_to_null(c: Column) -> Column:
    return F.when(F.isnan(c), F.lit(None)).otherwise(c)


def normalise_nulls(df: DataFrame, na_tokens: tuple[str, ...] = NA_TOKENS) -> DataFrame:
    """NaN -> NULL for float columns, NA tokens -> NULL for string columns."""
    out = []
    tokens = list(na_tokens)
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            out.append(_nan_to_null(c).cast(f.dataType).alias(f.name))
        elif isinstance(f.dataType, T.StringType):
            out.append(F.when(F.trim(c).isin(tokens), F.lit(None)).otherwise(c).alias(f.name))
        else:
            out.append(c)
    return df.select(*out)


def _absent(exc: AnalysisException) -> bool:
    return "PATH_NOT_FOUND" in str(exc) or "Path does not exist" in str(exc)


def load_table(spark: SparkSession, path: str, fmt: str = "parquet",
               required: bool = True, normalise: bool = False,
               **options) -> DataFrame | None:
    """Guarded scan (S2): a missing input raises ``TableMissing`` or gives None."""
    try:
        df = spark.read.format(fmt).options(**options).load(path)
    except AnalysisException as exc:
        if not _absent(exc):
            raise
        if required:
            raise TableMissing(path) from exc
        return None
    return normalise_nulls(df) if normalise else df


def read_csv_table(spark: SparkSession, path: str, schema: T.StructType | str | None = None,
                   required: bool = True) -> DataFrame | None:
    """CSV scan with header (S1).  Pin id / time / label types via ``schema``;
    without one, types are inferred (one extra pass — avoid at scale)."""
    opts = {"header": "true", "mode": "PERMISSIVE"}
    if schema is None:
        opts["inferSchema"] = "true"
    try:
        reader = spark.read.options(**opts)
        if schema is not None:
            reader = reader.schema(schema)
        df = reader.csv(path)
    except AnalysisException as exc:
        if not _absent(exc):
            raise
        if required:
            raise TableMissing(path) from exc
        return None
    return normalise_nulls(df)
