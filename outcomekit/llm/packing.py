"""Conflict-constrained best-fit packing (operator 1).

Documents go into bins of a fixed number of words.  A bin holds at most one
document of a source and of a duplicate cluster.  Each bin carries one bitmap
of the sources and one of the clusters that it holds; open bins are kept in
order of their residual, and the search starts at the smallest residual that
fits and goes on to the next larger one until a compatible bin is found.

A document longer than a bin is cut: each full piece is a bin by itself, the
remainder is packed as a document.  Spark deals (id, size, source, cluster)
rows to packing shards by hash; a shard has a bounded number of rows and is
packed by one task, largest first.  Texts are not shuffled.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from outcomekit.llm.common import ascii_lower, table, word_count, written

BIN_WORDS = 2048
ROWS_PER_SHARD = 4_000       # documents in a shard, on average
BITMAP_WORDS = 4             # of 64 bits, for each of the two bitmaps
WALK = 512                   # open bins looked at in one step of the successor search
SEED = 29


def best_fit(sizes: np.ndarray, sources: np.ndarray, clusters: np.ndarray, capacity: int,
             words: int = BITMAP_WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Bin number and start of each item (given in packing order, sizes 0 to
    ``capacity``).  ``sources`` and ``clusters`` are unsigned hashes: two that
    share a bit count as a conflict, so no true conflict is missed."""
    n = len(sizes)
    bin_of, start = np.zeros(n, np.int64), np.zeros(n, np.int64)
    room, who = np.empty(n, np.int64), np.empty(n, np.int64)       # open bins by residual, then number
    seen = np.zeros((2, n, words), np.uint64)                      # bitmaps by bin number
    slot = lambda h: (int(h >> np.uint64(6)) % words, np.uint64(1) << (h & np.uint64(63)))
    opened = count = 0                                             # bins made, bins in the order
    for i in range(n):
        size = int(sizes[i])
        (sw, sb), (cw, cb) = slot(sources[i]), slot(clusters[i])
        at, found = int(np.searchsorted(room[:count], size, side="left")), -1
        while at < count:
            b = who[at: min(at + WALK, count)]
            free = ((seen[0, b, sw] & sb) == 0) & ((seen[1, b, cw] & cb) == 0)
            k = int(free.argmax())
            if free[k]:
                found = at + k
                break
            at += WALK
        if found >= 0:
            number, left = int(who[found]), int(room[found])
            room[found:count - 1], who[found:count - 1] = room[found + 1:count].copy(), who[found + 1:count].copy()
            count -= 1
        else:
            number, left = opened, capacity
            opened += 1
        bin_of[i], start[i] = number, capacity - left
        seen[0, number, sw] |= sb
        seen[1, number, cw] |= cb
        left -= size
        at = int(np.searchsorted(room[:count], left, side="left"))
        while at < count and room[at] == left and who[at] < number:   # equal residuals: oldest bin first
            at += 1
        room[at + 1:count + 1], who[at + 1:count + 1] = room[at:count].copy(), who[at:count].copy()
        room[at], who[at] = left, number
        count += 1
    return bin_of, start


def _pack_shard(capacity: int):
    def pack(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["doc_id", "_no_id", "_cluster", "_source", "size", "copy"], ignore_index=True)
        size = rows["size"].to_numpy(np.int64)
        full, rest = size // capacity, size % capacity
        packed = (rest > 0) | (size == 0)
        order = np.argsort(-rest, kind="stable")
        order = order[packed[order]]
        src = rows["_source"].to_numpy(np.int64).view(np.uint64)
        clu = rows["_cluster"].to_numpy(np.int64).view(np.uint64)
        number, start = best_fit(rest[order], src[order], clu[order], capacity)
        bins = int(number.max()) + 1 if len(number) else 0
        parts = [pd.DataFrame({"at": order, "piece": full[order], "first_word": full[order] * capacity,
                               "words": rest[order], "bin": number, "bin_start": start})]
        rep = np.repeat(np.arange(len(rows)), full)
        if len(rep):
            piece = np.arange(len(rep)) - np.repeat(np.cumsum(full) - full, full)
            parts.append(pd.DataFrame({"at": rep, "piece": piece, "first_word": piece * capacity, "words": capacity,
                                       "bin": bins + np.arange(len(rep)), "bin_start": 0}))
        out = pd.concat(parts, ignore_index=True)
        out["doc_id"] = rows["doc_id"].to_numpy()[out["at"]]
        for name in ("_no_id", "_cluster", "copy"):
            out[name] = rows[name].to_numpy()[out["at"]]
        out["shard"] = rows["shard"].iloc[0]
        return out[["doc_id", "_no_id", "_cluster", "copy", "piece", "first_word", "words", "shard", "bin", "bin_start"]]

    return pack


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
         cluster: F.Column | None = None, capacity: int = BIN_WORDS, rows_per_shard: int = ROWS_PER_SHARD,
         seed: int = SEED) -> DataFrame:
    """One row per piece of a document: ``doc_id, cluster, copy, piece,
    first_word, words, shard, bin, bin_start``.  ``cluster`` names the duplicate
    cluster (default: a hash of the normalised text).  A null source is a
    source; a null or blank text has 0 words and still gets a place; null ids
    stay null; an empty table gives an empty result.  Repeated rows are packed
    apart, each with its own ``copy`` number (from 0): they are counted, and
    their copies dealt to all shards."""
    cluster = cluster if cluster is not None else F.xxhash64(ascii_lower(F.col(f"`{text_col}`")))
    sized = written(docs.select(
        F.coalesce(F.col(f"`{id_col}`").cast("long"), F.lit(0)).alias("doc_id"),
        F.col(f"`{id_col}`").isNull().alias("_no_id"), word_count(F.col(f"`{text_col}`")).alias("size"),
        F.xxhash64(F.coalesce(F.col(f"`{source_col}`").cast("string"), F.lit("\0"))).alias("_source"),
        cluster.cast("long").alias("_cluster")), "pack-sizes")
    shards = max(1, math.ceil(sized.count() / rows_per_shard))
    # repeated rows, up to a third of all, are one row with their number until they have a shard; runs of copies
    # are dealt out before they are listed, so that no task lists them all
    alike = sized.groupBy(*sized.columns).agg(F.count(F.lit(1)).alias("n"))
    runs = alike.withColumn("from", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1, F.lit(rows_per_shard).cast("long"))))
    many = runs.where(F.col("n") > rows_per_shard).repartition("doc_id", "_cluster", "from")
    last = F.least(F.col("from") + rows_per_shard, F.col("n")) - 1
    dealt = (runs.where(F.col("n") <= rows_per_shard).unionByName(many)
             .select(*sized.columns, F.explode(F.sequence("from", last)).alias("copy"))
             .withColumn("shard", F.pmod(F.xxhash64(F.lit(seed), "doc_id", "_cluster", "size", "copy"), F.lit(shards)).cast("int")))
    placed = dealt.groupBy("shard").applyInPandas(
        _pack_shard(capacity),
        "doc_id long, _no_id boolean, _cluster long, copy long, piece long, first_word long, words long, shard int, bin long, bin_start long")
    return placed.select(F.when(~F.col("_no_id"), F.col("doc_id")).alias("doc_id"),
                         F.col("_cluster").alias("cluster"), "copy", "piece", "first_word", "words", "shard", "bin", "bin_start")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"))


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The packed corpus: one row per piece with its place and its words'
    document; the last stage, so the columns are the packing's own.  ``doc_id``
    and ``cluster`` (of the normalised text) say which of the mix's texts a
    piece is of, ``copy`` which of its copies."""
    return pack(docs)
