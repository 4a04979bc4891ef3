"""Mixing sources to target weights by Sainte-Lague apportionment (operator 9).

Documents are hashed to shards of a bounded number of rows.  Each shard's
words are cut into blocks of equal length; the shard's blocks go to sources by
highest quotients target / (2 j + 1), where a source's target in the shard is
its share of the source's whole target.  The quota of a (shard, source) cell
is met with whole passes over the cell's documents; the rest is the first
blocks of the cell's documents in a seeded order, so that documents are kept or
dropped whole, apart from one in a cell, of which the beginning is kept.

Only (id, source, size) rows are shuffled; a hot source is spread over all
shards, and the running totals that place documents in blocks are per cell.
"""

from __future__ import annotations

import math
from fractions import Fraction

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from outcomekit.llm.common import numbered, renamed_back, table, word_count, written

WEIGHTS = (5, 2, 1)          # by position in code point order, repeating; null last
CEILING = 3                  # a target stops at this multiple of its source's size
BLOCK_WORDS = 8              # words in a block
ROWS_PER_SHARD = 500         # documents in a shard, on average
MAX_SOURCES = 100_000        # one row each is read by the driver; more raise an error
SEED = 17


def targets(sizes: dict[str | None, int], weights: tuple[int, ...] = WEIGHTS,
            ceiling: int = CEILING) -> dict[str | None, Fraction]:
    """Share all words by weight; what exceeds ``ceiling`` x size is shared
    again by weight among the others, until none is above.  Exact fractions."""
    names = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, capped = Fraction(sum(sizes.values())), set()
    while True:
        rest = total - sum(ceiling * sizes[s] for s in capped)
        heavy = sum(weight[s] for s in names if s not in capped)
        share = {s: Fraction(ceiling * sizes[s]) if s in capped else rest * weight[s] / heavy for s in names}
        over = {s for s in names if s not in capped and share[s] > ceiling * sizes[s]}
        if not over:
            return share
        capped |= over


def sainte_lague(wanted: list[float], seats: int) -> list[int]:
    """``seats`` to the highest quotients wanted / (2 j + 1); ties to the
    earlier entry.  Starts from the rounded shares and moves single seats until
    the highest quotient left out is no higher than the lowest one taken."""
    total = sum(wanted)
    if total <= 0 or seats <= 0:
        return [0] * len(wanted)
    got = [max(0, math.floor(w * seats / total + 0.5)) if w > 0 else 0 for w in wanted]
    up = lambda i: (wanted[i] / (2 * got[i] + 1), -i)                                     # noqa: E731
    down = lambda i: (wanted[i] / (2 * got[i] - 1), -i)                                   # noqa: E731
    live = [i for i, w in enumerate(wanted) if w > 0]
    while sum(got) < seats:
        got[max(live, key=up)] += 1
    while sum(got) > seats:
        got[min((i for i in live if got[i]), key=down)] -= 1
    while True:
        best, worst = max(live, key=up), min((i for i in live if got[i]), key=down)
        if best == worst or up(best) <= down(worst):
            return got
        got[best] += 1
        got[worst] -= 1


def _shard_quotas(block: int):
    def quotas(cells: pd.DataFrame) -> pd.DataFrame:
        cells = cells.sort_values("_sid")
        want = cells["_want"].tolist()
        cells["_quota"] = sainte_lague(want, math.floor(sum(want) / block + 0.5))
        return cells[["_shard", "_sid", "_quota"]]

    return quotas


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        block: int = BLOCK_WORDS, rows_per_shard: int = ROWS_PER_SHARD, seed: int = SEED,
        weights: tuple[int, ...] = WEIGHTS, ceiling: int = CEILING, columns: list[str] | None = None) -> DataFrame:
    """One row per input row: ``columns`` (default: the id), ``size``,
    ``source_size``, ``target``, ``taken`` and, for callers that cut texts,
    ``passes`` (times all words are taken) and ``extra`` (first and last word
    number, from 1, of what is taken once more: the whole document, its
    beginning, or no entry).

    Null sources form one source (last in order); null or blank texts have size
    0 and take nothing; repeated rows are separate documents.  The same input
    and seed give the same result.
    """
    own = list(columns or [id_col])
    n_rows = docs.count()
    shards = max(1, math.ceil(n_rows / rows_per_shard))
    sized = docs.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(own)],
                        F.col(f"`{id_col}`").cast("long").alias("_id"),
                        F.col(f"`{source_col}`").cast("string").alias("_source"),
                        word_count(F.col(f"`{text_col}`")).alias("size"),
                        F.xxhash64(F.col(f"`{text_col}`")).alias("_tie"))
    sized = written(sized.withColumn("_shard", F.pmod(F.xxhash64(F.lit(seed), "_id", "_tie"), F.lit(shards)).cast("int")),
                    "mix-sizes")
    cells = sized.groupBy("_shard", "_source").agg(F.sum("size").alias("_words"))
    per_source = cells.groupBy("_source").agg(F.sum("_words").alias("n")).limit(MAX_SOURCES + 1).collect()
    if len(per_source) > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} sources")
    sizes = {r["_source"]: r["n"] for r in per_source}
    want = targets(sizes, weights, ceiling)
    names = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    spark = docs.sparkSession
    plan = spark.createDataFrame([(i, s, sizes[s], float(want[s])) for i, s in enumerate(names)],
                                 "_sid int, _source string, source_size long, target double")
    # one row per source, at most MAX_SOURCES: bounded
    plan = F.broadcast(plan)
    same = lambda a, b: a["_source"].eqNullSafe(b["_source"])                             # noqa: E731
    cells = cells.join(plan, same(cells, plan)).select(
        "_shard", "_sid", "_words", "source_size",
        F.when(F.col("source_size") > 0, F.col("target") * F.col("_words") / F.col("source_size"))
        .otherwise(0.0).alias("_want"))
    quota = cells.groupBy("_shard").applyInPandas(_shard_quotas(block), "_shard int, _sid int, _quota long")
    blocks = F.ceil(F.col("_words") / block)
    cells = (cells.join(quota, ["_shard", "_sid"])
             .withColumn("_blocks", blocks)
             .withColumn("_quota", F.least("_quota", ceiling * F.col("_blocks")))
             # whole passes by words (a cell's last block is short), the rest of the quota in blocks
             .withColumn("passes", F.when(F.col("_words") > 0, F.least(F.lit(ceiling), F.floor(F.col("_quota") * block / F.col("_words")))).otherwise(0))
             .withColumn("_rest", F.round((F.col("_quota") * block - F.col("passes") * F.col("_words")) / block).cast("long"))
             .select("_shard", "_sid", "_blocks", "passes",
                     F.when(F.col("passes") < ceiling, F.greatest(F.lit(0), F.least("_rest", "_blocks"))).otherwise(0).alias("_more")))
    cells = written(cells, "mix-quotas")
    placed = sized.join(plan, same(sized, plan)).drop(plan["_source"])
    w = Window.partitionBy("_shard", "_sid").orderBy(F.xxhash64(F.lit(seed + 1), "_id", "_tie"), F.col("_id").asc_nulls_last(), "_tie")
    before = F.sum("size").over(w.rowsBetween(Window.unboundedPreceding, -1))
    placed = placed.withColumn("_from", F.coalesce(before, F.lit(0)))
    placed = placed.join(cells, ["_shard", "_sid"])
    # the cell's first _more blocks are taken once more: whole documents, then the beginning of one
    last = F.least(F.col("size"), F.col("_more") * block - F.col("_from"))
    extra = F.when((F.col("size") > 0) & (last > 0), F.array(F.struct(F.lit(1).cast("long").alias("first"), last.cast("long").alias("last"))))
    placed = placed.withColumn("extra", F.coalesce(extra, F.array().cast("array<struct<first:bigint,last:bigint>>")))
    words = F.aggregate("extra", F.lit(0).cast("long"), lambda a, x: a + x["last"] - x["first"] + 1)
    return placed.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(own)], "size", "source_size", "target",
                         (F.col("passes") * F.col("size") + words).alias("taken"), "passes", "extra")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = mix(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "size", "source_size", "target", "taken")


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mixed corpus: every whole pass over a document is one row with its
    whole text; what is taken once more is one further row, the whole text or
    its beginning with its white space.  ``n_chars`` follows the text; all other columns stay,
    whatever their names.  Null and blank texts take nothing and go; repeated
    rows are separate documents."""
    own, names = numbered(docs)
    out = mix(own, names["doc_id"], names["text"], names["source"], columns=own.columns)
    text = F.col(names["text"])
    last = F.get("extra", F.lit(0))["last"].cast("int")
    words = F.regexp_extract_all(text, F.lit(r"([\x20\x09-\x0D]*[^\x20\x09-\x0D]+)"))
    part = F.when(F.size("extra") == 0, F.lit(None)).when(last >= F.col("size"), text) \
        .otherwise(F.array_join(F.slice(words, F.lit(1), last), ""))
    copies = F.concat(F.array_repeat(text, F.col("passes").cast("int")),
                      F.filter(F.array(part), lambda x: x.isNotNull()))
    cols = [n for c, n in names.items() if c != "text"]
    out = out.where(F.col("taken") > 0).select(*cols, F.explode(copies).alias(names["text"]))
    if "n_chars" in names:
        out = out.withColumn(names["n_chars"], F.length(names["text"]).cast(dict(docs.dtypes)["n_chars"]))
    return renamed_back(out, names)
