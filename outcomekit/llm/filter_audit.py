"""Filter interaction audit by Lehmer-rank difference arrays (operator 12).

Every document gets a mask of the filters that it fails.  In an order of the
filters, a document is removed by the first of its failing filters; the orders
that begin with the same filters have neighbouring ranks in lexicographic
order, so a mask's removal by one filter at one step covers intervals of
ranks: one for each arrangement of filters that the mask passes before it.  A
count is added at an interval's first rank and taken away behind its last one;
the running sum over the 120 ranks gives what each order removes at each step.
No order is applied to documents: they are read once, and only (part, mask)
counts reach the arrays.

Filter E compares a text with those of smaller ids in the whole table.  Rows
are first counted by (digest, part, other filters), so a text that a third of
all rows share is a few rows before it meets its smallest id.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from itertools import permutations
from math import factorial

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from outcomekit.llm.common import small_batches, table, text_bytes, written

FILTERS = "ABCDE"
LEAST_WORDS = 200            # A
DISTINCT_PERCENT = 50        # B
UPPER_PERCENT = 2            # C
MARKS = b"#$%&*|"            # D
SPLIT_BYTES = 1 << 20        # of a text are split into words at once

_UPPER = bytes(range(ord("A"), ord("Z") + 1))
_FOLLOWS = bytes(range(0x80, 0xC0))                        # continuation bytes of UTF-8
_GAP = re.compile(rb"[\x20\x09-\x0D]")


def text_mask(text: bytes) -> int:
    """Bits 0 to 3: the text (UTF-8) fails A, B, C, D."""
    words, different, at = 0, set(), 0
    while at < len(text):
        gap = _GAP.search(text, at + SPLIT_BYTES)          # a word isn't cut
        to = gap.start() if gap else len(text)
        found = text[at:to].split()                        # bytes: splits at ASCII white space only
        words += len(found)
        different.update(found)
        at = to
    points = len(text.translate(None, _FOLLOWS))
    upper = len(text) - len(text.translate(None, _UPPER))
    marked = len(text.translate(None, MARKS)) < len(text)
    return ((words < LEAST_WORDS) | (100 * len(different) < DISTINCT_PERCENT * words) << 1
            | (100 * upper > UPPER_PERCENT * points) << 2 | marked << 3)


def _masks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        views = [x.as_py() for x in batch.column("t")]
        yield pa.record_batch([batch.column("doc_id"), batch.column("part"), pa.array([text_mask(t) for t in views], pa.int32()),
                               pa.array([hashlib.sha256(t).digest() for t in views], pa.binary())],
                              names=["doc_id", "part", "own", "digest"])


def removal_intervals(mask: int, filters: int = len(FILTERS)) -> list[tuple[int, int, int]]:
    """(step, first rank, rank behind the last): where orders of the filters 0,
    1, ... remove a document that fails ``mask``; ranks in lexicographic order."""
    passed = [f for f in range(filters) if not mask >> f & 1]
    out = []
    for before in range(min(len(passed), filters - 1) + 1):
        size = factorial(filters - before - 1)             # orders that share these filters and the next one
        for start in permutations(passed, before):
            for last in range(filters):
                if mask >> last & 1:
                    rank, rest = 0, list(range(filters))
                    for k, f in enumerate((*start, last)):
                        rank += rest.index(f) * factorial(filters - 1 - k)
                        rest.remove(f)
                    out.append((before, rank, rank + size))
    return out


def _audit(filters: str):
    n = len(filters)
    orders = list(permutations(range(n)))                  # in lexicographic order: the index is the rank
    spans = [removal_intervals(mask, n) for mask in range(1 << n)]

    def audit(cells: pd.DataFrame) -> pd.DataFrame:
        change = np.zeros((3, n, len(orders) + 1), np.int64)
        alone, failing, total = np.zeros(n, np.int64), np.zeros(n, np.int64), 0
        for mask, *counts in cells[["mask", "n", "good", "toxic"]].astype("int64").itertuples(index=False):
            total += counts[0]
            for f in range(n):
                failing[f] += counts[0] * (mask >> f & 1)
                alone[f] += counts[0] * (mask == 1 << f)
            for step, first, behind in spans[mask]:
                change[:, step, first] += counts
                change[:, step, behind] -= counts
        removed, good, toxic = np.cumsum(change, axis=2)[:, :, :-1]        # step x rank
        which = np.array(orders).T                                         # step x rank: the filter
        value = np.array([removed[which == f].sum() for f in range(n)])
        step, rank = np.indices(which.shape)
        return pd.DataFrame({
            "part": cells["part"].iloc[0], "filter_order": np.array(["".join(filters[f] for f in o) for o in orders])[rank.ravel()],
            "step": step.ravel() + 1, "kept": (total - np.cumsum(removed, axis=0)).ravel(), "removed": removed.ravel(),
            "redundant": (failing[which] - removed).ravel(), "unique_fails": alone[which].ravel(),
            "good_lost": good.ravel(), "toxic_lost": toxic.ravel(), "shapley": value[which].ravel()})

    return audit


AUDIT = ("part string, filter_order string, step int, kept long, removed long, redundant long, unique_fails long, "
         "good_lost long, toxic_lost long, shapley long")


def interactions(masks: DataFrame, filters: str = FILTERS) -> DataFrame:
    """``masks``: one row per (part, mask) with ``n``, ``good`` and ``toxic``
    documents; at most 2**filters rows a part.  Returns one row per part, order
    and step.  Parts are never null; an empty table has none."""
    return masks.groupBy("part").applyInPandas(_audit(filters), AUDIT)


def _label(value: str) -> Column:
    return F.coalesce(F.max((F.col(value) == 1).cast("int")), F.lit(0)).alias(value)


def filter_masks(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 part_col: str = "source") -> DataFrame:
    """(part, mask) counts: ``n``, ``good`` (``labels.quality`` = 1) and
    ``toxic`` (``labels.toxic`` = 1).

    A null text counts as empty and a null part as the empty string.  Rows that
    repeat are documents of their own: none of them has a smaller id, so equal
    rows alone don't fail E; a row without an id neither fails E nor makes
    others fail, and has no label.  Of an id's repeated labels, any 1 counts.
    Other columns of either table are not read.
    """
    src = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"),
                      F.coalesce(F.col(f"`{part_col}`").cast("string"), F.lit("")).alias("part"),
                      text_bytes(F.col(f"`{text_col}`")).alias("t"))
    with small_batches(docs.sparkSession):
        rows = src.mapInArrow(_masks, "doc_id long, part string, own int, digest binary")
        rows = written(rows.groupBy("digest", "part", "own", "doc_id").agg(F.count("*").alias("n")), "audit-rows")
    marks = labels.where("doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(_label("quality"), _label("toxic"))
    rows = rows.join(marks, "doc_id", "left").fillna(0, ["quality", "toxic"])
    first = F.min(F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", "n")))
    cells = rows.groupBy("digest", "part", "own", "quality", "toxic").agg(
        F.sum("n").alias("n"), first.alias("first"), F.sum(F.when(F.col("doc_id").isNull(), F.col("n")).otherwise(0)).alias("without"))
    cells = written(cells, "audit-cells")
    low = cells.groupBy("digest").agg(F.min("first.doc_id").alias("low"))
    cells = cells.join(low, "digest").withColumn(
        "unlike", F.col("without") + F.when(F.col("first.doc_id") == F.col("low"), F.col("first.n")).otherwise(0))
    both = F.explode(F.array(F.struct(F.col("own").alias("mask"), F.col("unlike").alias("n")),
                             F.struct((F.col("own") + 16).alias("mask"), (F.col("n") - F.col("unlike")).alias("n"))))
    cells = cells.select("part", "quality", "toxic", both.alias("c")).where("c.n > 0")
    return cells.groupBy("part", F.col("c.mask").alias("mask")).agg(
        F.sum("c.n").alias("n"), F.sum(F.col("c.n") * F.col("quality")).alias("good"), F.sum(F.col("c.n") * F.col("toxic")).alias("toxic"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return interactions(filter_masks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")))


SQL = r"""
WITH w AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t,
                  regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
l AS (SELECT doc_id, max((coalesce(quality, 0) = 1)::int) AS good, max((coalesce(toxic, 0) = 1)::int) AS toxic FROM labels GROUP BY 1),
m AS (SELECT w.part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
             [len(words) < 200, 100 * len(list_distinct(words)) < 50 * len(words),
              100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 2 * length(t),
              regexp_matches(t, '[#$%&*|]'),
              coalesce(w.doc_id > min(w.doc_id) OVER (PARTITION BY t), false)] AS f
      FROM w LEFT JOIN l USING (doc_id)),
g AS (SELECT part, f, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM m GROUP BY ALL),
i AS (SELECT unnest([1, 2, 3, 4, 5]) AS i),
p AS (SELECT [a.i, b.i, c.i, d.i, e.i] AS o FROM i a, i b, i c, i d, i e
      WHERE len(list_distinct([a.i, b.i, c.i, d.i, e.i])) = 5),
s AS (SELECT o, i AS step, o[i] AS x, o[:i - 1] AS before FROM p, i),
r AS (SELECT part, o, step, x,
             sum(CASE WHEN len(list_filter(before, lambda y: f[y])) = 0 AND NOT f[x] THEN n ELSE 0 END) AS kept,
             sum(CASE WHEN len(list_filter(before, lambda y: f[y])) = 0 AND f[x] THEN n ELSE 0 END) AS removed,
             sum(CASE WHEN len(list_filter(before, lambda y: f[y])) > 0 AND f[x] THEN n ELSE 0 END) AS redundant,
             sum(CASE WHEN f[x] AND len(list_filter(f, lambda y: y)) = 1 THEN n ELSE 0 END) AS unique_fails,
             sum(CASE WHEN len(list_filter(before, lambda y: f[y])) = 0 AND f[x] THEN good ELSE 0 END) AS good_lost,
             sum(CASE WHEN len(list_filter(before, lambda y: f[y])) = 0 AND f[x] THEN toxic ELSE 0 END) AS toxic_lost
      FROM g, s GROUP BY part, o, step, x)
SELECT part, array_to_string(list_transform(o, lambda y: substr('ABCDE', y, 1)), '') AS filter_order, step::int AS step,
       kept::bigint AS kept, removed::bigint AS removed, redundant::bigint AS redundant, unique_fails::bigint AS unique_fails,
       good_lost::bigint AS good_lost, toxic_lost::bigint AS toxic_lost,
       (sum(removed) OVER (PARTITION BY part, x))::bigint AS shapley
FROM r
"""
