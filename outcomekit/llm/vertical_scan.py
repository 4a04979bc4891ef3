"""Hard-negative mining by a vertical (BOND) scan (operator 11).

Vectors are stored by column: a block holds some thousand rows as one array
per dimension, with each dimension's least and greatest value.  An anchor
reads the dimensions of a block in descending order of its own magnitudes and
keeps, for every candidate row, the inner product so far; what the dimensions
not yet read can still add lies between bounds that follow from their least
and greatest values.  Candidates whose bounds show that they can't be in the
result leave the candidate bitmap, and the dimensions that follow are read for
the others only.

1. Positives: a candidate stays while its upper bound reaches the k-th best
   lower bound of the anchor's label.
2. Windows: each positive's score gives a window of scores; a row of another
   label stays while its bounds touch a window and its upper bound reaches the
   window's k-th best lower bound among the rows that are inside for certain.

Anchors are given out in rounds: the rows of one round (a bounded number of
values, broadcast) meet all blocks, which Spark deals to tasks.  A task gives
out at most k rows per anchor (and window); the best of these are ranked.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from outcomekit.llm.common import table, written

SCALE = 256                  # a component x becomes floor(SCALE * x)
TOP = 5                      # positives of an anchor, negatives of a window
LEAST, MOST, PERCENT = 80, 100, 100     # a negative's score, in hundredths of the positive's
BLOCK_ROWS = 4096            # vectors in a block
ROUND_VALUES = 1 << 20       # components of the anchors of a round (8 MB); one anchor at least
STEPS = (8, 8, 16)           # dimensions read between two looks at the bounds; the last one repeats
EXACT = 1 << 53              # sums below are exact in doubles

_ROWS = "doc long, label long, anchor boolean, v binary, width int"
_BLOCK = "block long, n int, width int, ids binary, labels binary, columns binary, kind string"


# ---- input --------------------------------------------------------------

def _quantised(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Keep rows whose components are all finite; components as int64."""
    for batch in batches:
        vec = batch.column("v")
        off = vec.offsets.to_numpy().astype(np.int64)
        x = vec.values.to_numpy(zero_copy_only=False).astype(np.float64)        # a null becomes NaN
        fine = np.concatenate(([0], np.cumsum(~np.isfinite(x))))
        keep = np.flatnonzero(fine[off[1:]] == fine[off[:-1]])
        with np.errstate(invalid="ignore", over="ignore"):
            y = np.floor(SCALE * x)
        if len(keep) and np.abs(y[np.isfinite(x)]).max(initial=0) >= 1 << 62:
            big = np.concatenate(([0], np.cumsum(~(np.abs(y) < 1 << 62))))
            if (big[off[keep + 1]] > big[off[keep]]).any():
                raise ArithmeticError("a component is beyond 64 bits after scaling")
        y = np.where(np.isfinite(x), y, 0).astype(np.int64)
        at = pa.array(keep)
        out = [y[off[i]: off[i + 1]].tobytes() for i in keep]
        yield pa.record_batch([batch.column("doc").take(at), batch.column("label").take(at), batch.column("anchor").take(at),
                               pa.array(out, pa.binary()), pa.array((off[keep + 1] - off[keep]).astype(np.int32))],
                              names=["doc", "label", "anchor", "v", "width"])


def _smallest(x: np.ndarray) -> np.ndarray:
    """``x`` in the narrowest signed type that holds it."""
    lo, hi = (int(x.min()), int(x.max())) if x.size else (0, 0)
    for kind in (np.int8, np.int16, np.int32):
        if np.iinfo(kind).min <= lo and hi <= np.iinfo(kind).max:
            return x.astype(kind)
    return x


def _matrix(vectors: list[bytes], width: int) -> np.ndarray:
    """Rows of ``width`` components; a shorter vector ends in zeros."""
    out = np.zeros((len(vectors), width), np.int64)
    for i, v in enumerate(vectors):
        x = np.frombuffer(v, np.int64)
        out[i, :len(x)] = x
    return out


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    from pyspark import TaskContext

    part, number = TaskContext.get().partitionId(), 0
    held: list[tuple[int, int, bytes]] = []
    names = ["block", "n", "width", "ids", "labels", "columns", "kind"]

    def close(rows: list[tuple[int, int, bytes]]) -> pa.RecordBatch:
        ids, labels, vectors = zip(*rows)
        width = max(len(v) for v in vectors) // 8
        columns = _smallest(np.ascontiguousarray(_matrix(list(vectors), width).T))
        row = [(part << 32) + number, len(rows), width, np.array(ids, np.int64).tobytes(), np.array(labels, np.int64).tobytes(),
               columns.tobytes(), columns.dtype.str]
        kinds = [pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary(), pa.string()]
        return pa.record_batch([pa.array([v], k) for v, k in zip(row, kinds)], names=names)

    for batch in batches:
        held += zip(*(batch.column(c).to_pylist() for c in ("doc", "label", "v")))
        while len(held) >= BLOCK_ROWS:
            yield close(held[:BLOCK_ROWS])
            held, number = held[BLOCK_ROWS:], number + 1
    if held:
        yield close(held)


# ---- the scan -----------------------------------------------------------

class Block:
    """Columns of a block as doubles (as whole numbers of any size, where sums
    of doubles would not be exact), and their bounds."""

    def __init__(self, n: int, width: int, ids: bytes, labels: bytes, columns: bytes, kind: str):
        self.ids, self.labels = np.frombuffer(ids, np.int64), np.frombuffer(labels, np.int64)
        self.whole = np.frombuffer(columns, np.dtype(kind)).reshape(width, n)
        self.columns = self.whole.astype(np.float64)
        self.low, self.high = self.whole.min(axis=1, initial=0), self.whole.max(axis=1, initial=0)
        self.most = max([0, *(abs(int(x)) for x in (*self.low, *self.high))])


def scan(block: Block, q: np.ndarray, candidates: np.ndarray, stay: Callable[[np.ndarray, np.ndarray], np.ndarray]):
    """Exact inner products of the anchor ``q`` with those ``candidates`` (row
    numbers) that ``stay(lower, upper)`` keeps: (row numbers, products)."""
    width = min(len(q), len(block.columns))
    q = q[:width]
    exact = width * block.most * int(np.abs(q).max(initial=0)) < EXACT
    kind = np.float64 if exact else object
    columns = block.columns if exact else block.whole.astype(object)
    order = np.argsort(-np.abs(q), kind="stable")
    q, a, b = q[order].astype(kind), block.low[order].astype(kind), block.high[order].astype(kind)
    # what dimensions from the m-th on can add, at least and at most
    rest_low = np.append(np.cumsum(np.minimum(q * a, q * b)[::-1])[::-1], 0)
    rest_high = np.append(np.cumsum(np.maximum(q * a, q * b)[::-1])[::-1], 0)
    sums = np.zeros(len(candidates), kind)
    at = k = 0
    while at < width and len(candidates):
        to = min(width, at + STEPS[min(k, len(STEPS) - 1)])
        dims = order[at:to]
        if 2 * len(candidates) > columns.shape[1]:
            sums = sums + (q[at:to] @ columns[dims])[candidates]
        else:
            sums = sums + q[at:to] @ columns[dims[:, None], candidates]
        at, k = to, k + 1
        keep = stay(sums + rest_low[at], sums + rest_high[at])
        if not keep.all():
            candidates, sums = candidates[keep], sums[keep]
    return candidates, sums


class Best:
    """The ``top`` best (score, id) pairs so far: higher scores, then smaller ids."""

    def __init__(self, top: int):
        self.top, self.rows = top, []

    def add(self, scores: np.ndarray, ids: np.ndarray) -> None:
        if len(scores) > self.top:
            near = scores >= np.partition(scores, len(scores) - self.top)[len(scores) - self.top]
            scores, ids = scores[near], ids[near]
        found = [(-int(s), int(i)) for s, i in zip(scores, ids)]
        self.rows = sorted(self.rows + found)[:self.top]

    def floor(self, lower: np.ndarray):
        """No score below it can be among the best, given lower bounds of new
        candidates; None while there are fewer than ``top``."""
        have = [-s for s, _ in self.rows]
        if len(lower) + len(have) < self.top:
            return None
        if len(lower) > self.top:
            lower = np.partition(lower, len(lower) - self.top)[len(lower) - self.top:]
        return sorted([*have, *lower.tolist()], reverse=True)[self.top - 1]


def _positives(block: Block, anchor: tuple, best: Best) -> None:
    _, doc, label, q, _ = anchor

    def stay(lower, upper):
        least = best.floor(lower)
        return np.ones(len(upper), bool) if least is None else upper >= least

    rows, scores = scan(block, q, np.flatnonzero((block.labels == label) & (block.ids != doc)), stay)
    best.add(scores, block.ids[rows])


def _negatives(block: Block, anchor: tuple, windows: list[Best]) -> None:
    _, _, label, q, bounds = anchor

    def stay(lower, upper):
        keep = np.zeros(len(upper), bool)
        for best, (low, high) in zip(windows, bounds):
            touches = (upper >= low) & (lower <= high)
            least = best.floor(lower[(lower >= low) & (upper <= high)])
            keep |= touches if least is None else touches & (upper >= least)
        return keep

    rows, scores = scan(block, q, np.flatnonzero(block.labels != label), stay)
    for best, (low, high) in zip(windows, bounds):
        inside = (scores >= low) & (scores <= high)
        best.add(scores[inside], block.ids[rows[inside]])


def _scan_positives(given, top: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchors = given.value
        found = [Best(top) for _ in anchors]
        for batch in batches:
            for row in batch.to_pylist():
                block = Block(*(row[c] for c in ("n", "width", "ids", "labels", "columns", "kind")))
                for anchor, best in zip(anchors, found):
                    _positives(block, anchor, best)
        yield from _given_out([(a[0], 0, best) for a, best in zip(anchors, found)])
    return run


def _scan_negatives(given, top: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchors = given.value
        found = [[Best(top) for _ in a[4]] for a in anchors]
        for batch in batches:
            for row in batch.to_pylist():
                block = Block(*(row[c] for c in ("n", "width", "ids", "labels", "columns", "kind")))
                for anchor, windows in zip(anchors, found):
                    _negatives(block, anchor, windows)
        yield from _given_out([(a[0], high, best) for a, windows in zip(anchors, found) for (_, high), best in zip(a[4], windows)])
    return run


FOUND = "a long, p long, score long, doc long"


def _given_out(found: list[tuple[int, int, Best]]) -> Iterator[pa.RecordBatch]:
    rows = [(a, p, -s, i) for a, p, best in found for s, i in best.rows]
    if rows:
        if max(abs(r[2]) for r in rows) >= 1 << 63:
            raise ArithmeticError("a score is beyond 64 bits")
        yield pa.record_batch([pa.array(c, pa.int64()) for c in zip(*rows)], names=["a", "p", "score", "doc"])


# ---- the operator -------------------------------------------------------

def _rounds(anchors: DataFrame, blocks: DataFrame, body, top: int, windows: DataFrame | None, name: str) -> DataFrame:
    """``body`` of all blocks with each round's anchors, written; ranked."""
    spark = blocks.sparkSession
    sizes = anchors.agg(F.count("*").alias("n"), F.sum(F.col("width") + 1).alias("w")).first()
    rounds = max(1, math.ceil((sizes["w"] or 0) / ROUND_VALUES))
    found = None
    for k in range(rounds):
        mine = anchors.where(F.pmod(F.xxhash64("a"), F.lit(rounds)) == k)
        if windows is not None:
            mine = mine.join(windows, "a")
        # about ROUND_VALUES components: the driver holds the anchors of one round at a time
        rows = mine.select("a", "doc", "label", "v", *(["p"] if windows is not None else [])).collect()
        bounds = lambda p: (-(-LEAST * p // PERCENT), MOST * p // PERCENT)                    # noqa: E731
        held = [(r["a"], r["doc"], r["label"], np.frombuffer(bytes(r["v"]), np.int64),
                 [bounds(p) for p in sorted(r["p"])] if windows is not None else []) for r in rows]
        given = spark.sparkContext.broadcast(held)
        part = written(blocks.mapInArrow(body(given, top), FOUND), name)
        given.unpersist()
        found = part if found is None else found.unionByName(part)
    best = Window.partitionBy("a", "p").orderBy(F.desc("score"), "doc")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= top)


def hard_negatives(rows: DataFrame, anchor: Column, id_col: str = "vec_id", vector_col: str = "embedding",
                   label: Column | None = None, top: int = TOP) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score,
    negative_score`` of the rows for which ``anchor`` holds.

    Rows with a null label, a null vector or any null or non-finite component
    take no part, nor do rows without an id.  An empty vector has the score 0
    with all; vectors of unlike lengths meet as if the shorter ended in zeros.
    Rows that repeat an id take part one by one, each anchor with its own
    results; rows of the anchor's id are never its positives.  Equal scores go
    by id, however many rows share them.  An anchor without another row of its
    label, or a window without rows, gives nothing, and neither does an empty
    table.  Other columns are not read.  Components or scores beyond 64 bits raise an error.
    """
    label = F.col("label") if label is None else label
    spark = rows.sparkSession
    src = rows.select(F.col(f"`{id_col}`").cast("long").alias("doc"), label.cast("long").alias("label"),
                      F.coalesce(anchor, F.lit(False)).alias("anchor"),
                      F.col(f"`{vector_col}`").cast(T.ArrayType(T.DoubleType())).alias("v"))
    src = src.where("doc is not null and label is not null and v is not null")
    fine = written(src.mapInArrow(_quantised, _ROWS), "vectors")
    blocks = written(fine.select("doc", "label", "v").mapInArrow(_blocks, _BLOCK), "vector-blocks")
    tasks = max(1, min(blocks.count(), 8 * spark.sparkContext.defaultParallelism))
    blocks = blocks.repartitionByRange(tasks, "block")
    anchors = written(fine.where("anchor").select(F.monotonically_increasing_id().alias("a"), "doc", "label", "v", "width"), "anchors")
    positives = _rounds(anchors, blocks, _scan_positives, top, None, "positives")
    positives = written(positives.select("a", F.col("doc").alias("positive_id"), F.col("score").alias("p")), "positives")
    # below 0 a window is empty; equal scores share a window
    windows = positives.where("p >= 0").groupBy("a").agg(F.collect_set("p").alias("p"))       # ``top`` at most
    negatives = _rounds(anchors, blocks, _scan_negatives, top, windows, "negatives")
    out = positives.join(negatives, ["a", "p"]).join(anchors.select("a", F.col("doc").alias("anchor_id")), "a")
    return out.select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("doc").alias("negative_id"),
                      F.col("p").alias("positive_score"), F.col("score").alias("negative_score"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(rows, F.col("vec_id") % 100 == 0, label=label)


SQL = """
WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                  list_transform(embedding, lambda x: floor(256 * x::double)::bigint) AS e
           FROM embeddings
           WHERE label IS NOT NULL AND embedding IS NOT NULL
             AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS alike,
             list_sum(list_transform(list_zip(a.e, b.e), lambda z: z[1] * z[2]))::bigint AS score
      FROM v a, v b WHERE a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
p AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE alike
      QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT p.anchor_id, positive_id, (row_number() OVER w)::int AS rank, vec_id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT alike
     AND 80 * positive_score <= 100 * score AND 100 * score <= 100 * positive_score
WINDOW w AS (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, vec_id)
QUALIFY row_number() OVER w <= 5
"""
