"""Helpers shared by the text operators."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from outcomekit.session import ensure_checkpoint_dir

# A word is a run of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder that ``spark.checkpoint.dir`` names."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """Cut the lineage: write ``df`` as Parquet to the shared folder, read it
    back.  The files outlive a lost executor; each plan above runs once, so the
    shuffle files of the write go as soon as it is done."""
    path = shared_path(df.sparkSession, name)
    with _set(df.sparkSession, "spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true"):
        df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._written_at = path
    return out


def discard(*tables: DataFrame) -> None:
    """Delete what ``written`` wrote for these; nothing may read them again."""
    for df in tables:
        path = getattr(df, "_written_at", None)
        if path:
            spark = df.sparkSession
            at = spark._jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


@contextmanager
def _set(spark: SparkSession, name: str, value: str) -> Iterator[None]:
    """What runs inside sees this setting; the session's own comes back after."""
    own = spark.conf.get(name, None)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        if own is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, own)


@contextmanager
def small_batches(spark: SparkSession, rows: int = 1000) -> Iterator[None]:
    """What is written inside sends Arrow batches of at most ``rows`` rows to
    Python: whole texts and sets make wide rows, and the default of 10,000 of
    them takes tens of MB in each task, on both sides.  A smaller setting of
    the session's own stays."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if 0 < int(spark.conf.get(name)) <= rows:
        yield
        return
    with _set(spark, name, str(rows)):
        yield


def numbered(docs: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """``docs`` with its columns named by position, and the new name of each
    column: an operator's own columns can't clash with those of its input."""
    names = {c: f"own_{i}" for i, c in enumerate(docs.columns)}
    return docs.toDF(*names.values()), names


def renamed_back(df: DataFrame, names: dict[str, str]) -> DataFrame:
    """The columns of the input of ``numbered`` under their own names."""
    return df.select(*[F.col(n).alias(c) for c, n in names.items()])


def ascii_lower(c: Column) -> Column:
    """Lower-case A-Z only; null counts as empty."""
    return F.translate(F.coalesce(c.cast("string"), F.lit("")), UPPER, LOWER)


def word_count(c: Column) -> Column:
    """Number of words, 0 for null."""
    return F.coalesce(F.regexp_count(c.cast("string"), F.lit(WORD)), F.lit(0)).cast("long")


def text_bytes(c: Column) -> Column:
    """UTF-8 bytes, empty for null: Arrow hands these to numpy without a copy."""
    return F.coalesce(c.cast("string"), F.lit("")).cast("binary")


def binary_slices(column: pa.Array, most: int = 1 << 20):
    """Yield (first, last) row ranges holding about ``most`` bytes each (one
    row at least), so that numpy work on them stays in cache."""
    import numpy as np

    off = offsets(column)
    n, lo = len(column), 0
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(off, off[lo] + most, side="right")) - 1)
        yield lo, min(hi, n)
        lo = min(hi, n)


def offsets(column: pa.Array):
    """The value offsets of a binary or string array, as int64."""
    import numpy as np

    wide = pa.types.is_large_binary(column.type) or pa.types.is_large_string(column.type)
    raw = np.frombuffer(column.buffers()[1], dtype=np.int64 if wide else np.int32)
    return raw[column.offset: column.offset + len(column) + 1].astype(np.int64)


def data(column: pa.Array):
    """The value bytes of a binary array (whole buffer) as uint8."""
    import numpy as np

    buf = column.buffers()[2]
    return np.frombuffer(buf, dtype=np.uint8) if buf is not None else np.zeros(0, np.uint8)
