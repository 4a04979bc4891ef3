"""Approximate k-nearest neighbours by locality-sensitive hashing, for data in
which the exact grid search of ``operators.neighbours`` prunes little (many
dimensions of like variance).

``pyspark.ml.feature.BucketedRandomProjectionLSH`` gives ``tables * width``
random projections cut into buckets; ``width`` of them form one table's key.
Two rows meet in a table if all its projections fall in the same buckets, or,
with ``probes``, if up to so many of them fall in a neighbouring bucket on the
query's side.  Rows that meet are ranked by true distance: top k per (bucket,
query) first, so that pairs met in several tables are merged on k rows a table
and not on all pairs.  Spark groups and sorts both sides by bucket, and numpy
compares a bucket's rows by a matrix product, so a pair that meets makes no row;
buckets of many rows are dealt to several groups, on both sides.

How many true neighbours are found is a matter of ``tables``, ``width``,
``bucket_length`` and ``probes``; ``suggest_plan`` chooses the bucket length
for a wanted recall from exact distances of a bounded sample of queries, and
``recall`` measures what came out against the exact search.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import BucketedRandomProjectionLSH, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from outcomekit.config import SEED
from outcomekit.operators.neighbours import MOST_ROWS, QUERIES, collapsed, expanded, knn, nearest


@dataclass(frozen=True)
class LshPlan:
    tables: int = 8              # hash tables: more find more, and cost one copy of the rows each
    width: int = 2               # projections of a key: more make smaller buckets
    bucket_length: float = 1.0   # of one projection, in the features' unit
    probes: int = 0              # projections that may fall beside the query's bucket
    seed: int = SEED


def meeting_chance(ratio: float) -> float:
    """Chance that two rows fall in one bucket of a random projection, for a
    bucket length of ``ratio`` times their distance (Gaussian projections)."""
    if ratio <= 0:
        return 0.0
    below = 0.5 * math.erfc(ratio / math.sqrt(2))
    return 1 - 2 * below - 2 / (math.sqrt(2 * math.pi) * ratio) * (1 - math.exp(-ratio * ratio / 2))


def bucket_ratio(target: float, tables: int, width: int) -> float:
    """Bucket length over distance at which a pair meets in one of the tables
    with chance ``target`` (without probes)."""
    chance = (1 - (1 - target) ** (1 / tables)) ** (1 / width)
    low, high = 1e-6, 1e6
    for _ in range(200):
        middle = math.sqrt(low * high)
        low, high = (middle, high) if meeting_chance(middle) < chance else (low, middle)
    return high


def suggest_plan(query: DataFrame, ref: DataFrame, qid: str, rid: str, features: list[str], k: int,
                 target: float = 0.95, plan: LshPlan = LshPlan(), exclude_self: bool = False,
                 sample: int = 128) -> LshPlan:
    """``plan`` with the bucket length at which the k-th neighbour is found with
    chance ``target``: the exact k-th distances of ``sample`` queries (smallest
    hashes of the id) are searched, and their 75th percentile is taken."""
    some = query.orderBy(F.xxhash64(qid), qid).limit(sample)
    far = knn(some, ref, qid, rid, features, k, exclude_self).groupBy(qid).agg(F.max("dist").alias("d"))
    d = far.select(F.percentile("d", 0.75)).first()[0]
    return replace(plan, bucket_length=bucket_ratio(target, plan.tables, plan.width) * d) if d else plan


def _keyed(df: DataFrame, features: list[str], model, plan: LshPlan, probes: int) -> DataFrame:
    """``_rep``, the vector ``_x`` and ``_t, _key``: a row for each table's key of each row and its probes."""
    hashed = model.transform(VectorAssembler(inputCols=features, outputCol="_v").transform(df))
    cell = [vector_to_array(F.col("_h")[i])[0].cast("long") for i in range(plan.tables * plan.width)]
    hashed = hashed.select("_rep", F.array(*[F.col(f"`{f}`") for f in features]).alias("_x"), F.array(*cell).alias("_cell"))
    steps = [s for s in itertools.product((0, -1, 1), repeat=plan.width) if sum(map(bool, s)) <= probes]

    def key(t: int, step: tuple[int, ...]) -> Column:
        at = [F.col("_cell")[t * plan.width + i] + F.lit(x) for i, x in enumerate(step)]
        return F.struct(F.lit(t).alias("t"), F.xxhash64(*at).alias("key"))

    keys = F.array(*[key(t, s) for t in range(plan.tables) for s in steps])
    return hashed.select("_rep", "_x", F.explode(keys).alias("_k")).select("_rep", "_x", F.col("_k.t").alias("_t"), F.col("_k.key").alias("_key"))


SLOT = ["_t", "_key", "_rp", "_qp"]


def _dealt(qs: DataFrame, rs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Both sides with ``_rp, _qp``: a bucket of more than ``MOST_ROWS``
    reference rows or ``QUERIES`` queries is dealt to parts of about those sizes, in
    which each query meets each reference row once."""
    n = qs.select("_t", "_key", F.lit(1).alias("q")).unionByName(rs.select("_t", "_key", F.lit(0).alias("q"))) \
        .groupBy("_t", "_key").agg(F.ceil(F.sum(1 - F.col("q")) / MOST_ROWS).cast("int").alias("_rn"),
                                   F.ceil(F.sum("q") / QUERIES).cast("int").alias("_qn"))
    large = n.where("_rn > 0 AND _qn > 0 AND (_rn > 1 OR _qn > 1)").persist()      # at most a row in so many rows
    own = lambda n: F.pmod(F.xxhash64("_rep"), F.coalesce(F.col(n), F.lit(1))).cast("int")                 # noqa: E731
    each = lambda n: F.explode(F.sequence(F.lit(0), F.coalesce(F.col(n), F.lit(1)) - 1))                   # noqa: E731
    qs, rs = (x.join(F.broadcast(large), ["_t", "_key"], "left") for x in (qs, rs))
    cols = ["_t", "_key", "_rep", "_x"]
    return (qs.withColumn("_qp", own("_qn")).withColumn("_rp", each("_rn")).select(*cols, "_rp", "_qp"),
            rs.withColumn("_rp", own("_rn")).withColumn("_qp", each("_qn")).select(*cols, "_rp", "_qp"))


def _nearest_in_bucket(need: int, d: int):
    """Rows arrive by ``SLOT``, reference rows first: the first ``need`` of
    them, by (distance, id), for each query of the slot."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slot, x, ids, none = None, [], [], []         # the reference rows of the current slot
        for batch in batches:
            if not batch.num_rows:
                continue
            v = batch.column("_x").flatten().to_numpy(zero_copy_only=False).reshape(-1, d)
            key, empty = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("_id", "_none"))
            query = batch.column("_query").to_numpy(zero_copy_only=False).astype(bool)
            at = [batch.column(c).to_numpy() for c in SLOT]
            new = np.concatenate(([True], np.any([c[1:] != c[:-1] for c in [*at, query]], axis=0)))
            starts = np.flatnonzero(new)
            found = []
            for lo, hi in zip(starts.tolist(), [*starts[1:].tolist(), len(v)]):
                here = tuple(c[lo] for c in at)
                if here != slot:
                    slot, x, ids, none = here, [], [], []
                if not query[lo]:
                    x.append(v[lo:hi])
                    ids.append(key[lo:hi])
                    none.append(empty[lo:hi])
                elif x:
                    if len(x) > 1:
                        x, ids, none = [np.concatenate(x)], [np.concatenate(ids)], [np.concatenate(none)]
                    with np.errstate(all="ignore"):
                        i, j, dist = nearest(v[lo:hi], x[0], ids[0], none[0], need)
                    found.append((lo + i, ids[0][j], none[0][j], dist))
            if found:
                i, theirs, null, dist = (np.concatenate(c) for c in zip(*found))
                cols = [batch.column("_qid").take(pa.array(i)), pa.array(theirs, batch.schema.field("_id").type, mask=null), pa.array(dist)]
                yield pa.record_batch(cols, names=["_qid", "_rid", "dist"])
    return run


def knn_lsh(query: DataFrame, ref: DataFrame, qid: str, rid: str, features: list[str], k: int,
            plan: LshPlan = LshPlan(), exclude_self: bool = False) -> DataFrame:
    """(qid, ``nn_id``, ``dist``, ``nn_rank``) like ``neighbours.knn``, of the
    rows that share a bucket: distances are true, neighbours can be missing, and
    a query may have fewer than k.  Repeated vectors are searched once and
    given to all their rows, on both sides.  The tables must hold no nulls."""
    need, spark = k + 1 if exclude_self else k, query.sparkSession
    q, mine = collapsed(query, qid, features, 1)
    r, theirs = collapsed(ref, rid, features, k + 1)
    q, r = q.persist(), r.persist()      # counted, then compared
    lsh = BucketedRandomProjectionLSH(inputCol="_v", outputCol="_h", bucketLength=plan.bucket_length,
                                      numHashTables=plan.tables * plan.width, seed=plan.seed)
    model = lsh.fit(VectorAssembler(inputCols=features, outputCol="_v").transform(q.unionByName(r).limit(1)))
    qs, rs = _dealt(_keyed(q, features, model, plan, plan.probes), _keyed(r, features, model, plan, 0))
    # null ids rank first among equal distances, as in an ORDER BY; _id stands in for them
    qtype, rtype = q.schema["_rep"].dataType.simpleString(), r.schema["_rep"].dataType.simpleString()
    none = F.lit(None)
    both = rs.select(*SLOT, F.lit(0).alias("_query"), none.cast(qtype).alias("_qid"), F.coalesce("_rep", F.lit(0).cast(rtype)).alias("_id"),
                     F.col("_rep").isNull().alias("_none"), "_x").unionByName(
        qs.select(*SLOT, F.lit(1).alias("_query"), F.col("_rep").alias("_qid"), F.lit(0).cast(rtype).alias("_id"), F.lit(False).alias("_none"), "_x"))
    # the work of a partition is not told by its bytes: as many as set, not merged by them
    both = both.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), *SLOT).sortWithinPartitions(*SLOT, "_query")
    met = both.mapInArrow(_nearest_in_bucket(need, len(features)), f"_qid {qtype}, _rid {rtype}, dist double")
    best = met.groupBy("_qid", "_rid").agg(F.min("dist").alias("dist"))
    return expanded(best, mine, theirs, qid, k, exclude_self)


def recall(found: DataFrame, exact: DataFrame, qid: str) -> DataFrame:
    """One row: ``wanted`` exact neighbours, ``hits`` of them found, ``recall``."""
    hit = exact.select(qid, "nn_id").join(found.select(qid, "nn_id", F.lit(1).alias("_hit")), [qid, "nn_id"], "left")
    return hit.agg(F.count("*").alias("wanted"), F.count("_hit").alias("hits")).withColumn("recall", F.col("hits") / F.col("wanted"))
