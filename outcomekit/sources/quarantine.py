"""Quarantine of malformed CSV rows.

A CSV is read once with every column as text and a corrupt-record column;
each column is then cast by ``try_cast``.  A row is bad if its number of
fields is wrong, if a text that is no NA token does not cast to its column's
type, or if a required column is missing.  Bad rows keep their raw line and
every reason, so nothing is lost: ``rows = good + bad``.  All of it is one
projection over the scan (no shuffle, no Python); write both tables from one
cached read, or let Spark scan the file for each.

Rules: an empty line is no row.  A quoted field may hold separators, not line
ends.  NaN in a fractional column counts as missing, as everywhere.  Column
names may hold dots, quotes and the names used here.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from outcomekit.sources.tables import NA_TOKENS, TableMissing, _absent

FIELDS = "wrong number of fields"


@dataclass
class Quarantine:
    rows: DataFrame            # struct ``row`` of the typed columns, ``raw_line``, array ``reasons``
    schema: T.StructType

    @property
    def good(self) -> DataFrame:
        """The rows without a reason, in the wanted schema."""
        ok = self.rows.where(F.size("reasons") == 0)
        return ok.select(*[F.col("row").getField(f"c{i}").alias(f.name) for i, f in enumerate(self.schema.fields)])

    @property
    def bad(self) -> DataFrame:
        """(raw_line, reasons): one row per malformed row, repeats included."""
        return self.rows.where(F.size("reasons") > 0).select("raw_line", "reasons")

    def report(self) -> DataFrame:
        """(reason, n): bad rows per reason; a row with two reasons counts under both."""
        return self.bad.select(F.explode("reasons").alias("reason")).groupBy("reason").agg(F.count(F.lit(1)).alias("n"))


def _typed(raw: Column, field: T.StructField, na_tokens: tuple[str, ...]) -> tuple[Column, Column]:
    """The value, and whether there is a text that is none."""
    text = F.when(~F.trim(raw).isin(list(na_tokens)), raw)
    if isinstance(field.dataType, T.StringType):
        return text, F.lit(False)
    value = F.trim(text).try_cast(field.dataType)
    bad = text.isNotNull() & value.isNull()
    if isinstance(field.dataType, (T.DoubleType, T.FloatType)):
        value = F.when(~F.isnan(value), value)
    return value, bad


def _split(parsed: DataFrame, schema: T.StructType, required: tuple[str, ...], na_tokens: tuple[str, ...]) -> Quarantine:
    """``parsed`` has text columns c0.., ``corrupt`` (a line of the wrong shape) and ``line``."""
    unknown = set(required) - {f.name for f in schema.fields}
    if unknown:
        raise ValueError(f"required columns not in the schema: {sorted(unknown)}")
    values, reasons = [], [F.when(F.col("corrupt").isNotNull(), F.lit(FIELDS))]
    for i, f in enumerate(schema.fields):
        value, bad = _typed(F.col(f"c{i}"), f, na_tokens)
        values.append(value.alias(f"c{i}"))
        whole = F.col("corrupt").isNull()      # the fields of a misshapen line are in no column for sure
        reasons.append(F.when(whole & bad, F.lit(f"{f.name}: not {f.dataType.simpleString()}")))
        if f.name in required:
            reasons.append(F.when(whole & value.isNull() & ~bad, F.lit(f"{f.name}: missing")))
    return Quarantine(parsed.select(F.struct(*values).alias("row"), F.col("line").alias("raw_line"),
                                    F.array_compact(F.array(*reasons)).alias("reasons")), schema)


def parse_lines(lines: DataFrame, schema: T.StructType, line: str = "value", required: tuple[str, ...] = (),
                sep: str = ",", na_tokens: tuple[str, ...] = NA_TOKENS) -> Quarantine:
    """CSV lines in a text column (a log, a stream) against ``schema``."""
    shape = T.StructType([T.StructField(f"c{i}", T.StringType()) for i in range(len(schema.fields))]
                         + [T.StructField("corrupt", T.StringType())])
    opts = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "corrupt", "sep": sep}
    kept = lines.select(F.col(f"`{line}`").alias("line")).where(F.length(F.trim("line")) > 0)
    parsed = kept.select("line", F.from_csv("line", shape.simpleString()[7:-1].replace(":", " "), opts).alias("p"))
    return _split(parsed.select("line", "p.*"), schema, required, na_tokens)


def read_csv(spark: SparkSession, path: str, schema: T.StructType, required: tuple[str, ...] = (), sep: str = ",",
             na_tokens: tuple[str, ...] = NA_TOKENS, must_exist: bool = True) -> Quarantine | None:
    """The CSV files (with header) at ``path`` against ``schema``.  An absent path raises
    ``TableMissing`` or, with ``must_exist`` off, gives None; any other failure is raised as it is.
    A file's header line must name the schema's columns in its order."""
    lines = None
    try:
        lines = spark.read.text(path)
    except AnalysisException as exc:
        if not _absent(exc):
            raise
        if must_exist:
            raise TableMissing(path) from exc
        return None
    header = sep.join(f.name for f in schema.fields)
    plain = F.regexp_replace(F.col("value"), r'["\r﻿]', "")
    return parse_lines(lines.where(plain != header.replace('"', "")), schema, "value", required, sep, na_tokens)
