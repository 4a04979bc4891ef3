"""Exact dedup by content sort (operator 10).

Sampled splitters range-partition the rows, an external sort inside each
partition places equal texts next to one another, and neighbouring full
comparisons find the runs.  The partitioning key is (first characters,
hashes, id) of the normalised text: bounded in size, so the driver's sample of
splitters stays small however long texts are, and ending in the id, so a text
that a third of all rows share is spread over many partitions.  The sort and
the comparison use whole texts.

A run can go on in the next partition only if it touches a partition's edge.
Each partition therefore reports at most two edge runs (with their text);
those 2 x partitions rows are grouped by full text and joined back.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from outcomekit.llm.common import ascii_lower, numbered, renamed_back, table, written

PREFIX_CHARS = 32  # of the text, in the splitters (bounded key; the sort itself uses all)

ADDED = T.StructType([
    T.StructField("_keep", T.LongType()), T.StructField("_size", T.LongType()),
    T.StructField("_last", T.BooleanType()), T.StructField("_sha", T.StringType()),
    T.StructField("_part", T.IntegerType()), T.StructField("_slot", T.IntegerType()),
    T.StructField("_edge", T.BinaryType()),
])


def _runs(own: list[str], id_name: str, keep_last: bool):
    """mapInArrow body: rows arrive sorted by (text, id); the text's bytes are
    in ``_norm``.  Slot 0 marks a partition's first run, 1 its last, 2 its only."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        state = {"first": True}

        def emit(pieces: list[pa.RecordBatch], bounds: list[tuple[int, int]], final: bool):
            """Rows of whole runs: ``bounds`` in the concatenation of ``pieces``."""
            t = pa.Table.from_batches(pieces).combine_chunks()
            ids, norms = t.column(id_name), t.column("_norm")
            n = t.num_rows
            keep, size, last, sha, slot, edge = [], [], [], [], [None] * n, [None] * n
            for k, (lo, hi) in enumerate(bounds):
                m = hi - lo
                # ids are sorted, nulls first: the row that stays is the last or the first one with an id
                at = hi - 1
                if not keep_last:
                    at = next((i for i in range(lo, hi) if ids[i].as_py() is not None), hi - 1)
                norm = norms[lo].as_py()
                keep += [ids[at].as_py()] * m
                size += [m] * m
                last += [False] * m
                last[at] = True
                sha += [hashlib.sha256(norm).hexdigest()] * m
                at_end = final and k == len(bounds) - 1
                mark = (2 if at_end else 0) if state["first"] else (1 if at_end else None)
                state["first"] = False
                if mark is not None:
                    slot[lo:hi] = [mark] * m
                    edge[at] = norm
            cols = [t.column(c) for c in own] + [
                pa.array(keep, pa.int64()), pa.array(size, pa.int64()), pa.array(last, pa.bool_()),
                pa.array(sha, pa.string()), pa.array([part] * n, pa.int32()), pa.array(slot, pa.int32()),
                pa.array(edge, pa.binary())]
            names = [*own, *ADDED.fieldNames()]
            yield from pa.table(cols, names=names).to_batches()

        open_pieces: list[pa.RecordBatch] = []
        open_norm = None
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            norms = batch.column(batch.schema.get_field_index("_norm")).to_pylist()
            j = 0
            if open_pieces:
                while j < n and norms[j] == open_norm:
                    j += 1
                if j:
                    open_pieces.append(batch.slice(0, j))
                if j == n:
                    continue
                yield from emit(open_pieces, [(0, sum(p.num_rows for p in open_pieces))], False)
            starts = [j] + [i for i in range(j + 1, n) if norms[i] != norms[i - 1]]
            if len(starts) > 1:
                ends = [(a - j, b - j) for a, b in zip(starts, starts[1:])]
                yield from emit([batch.slice(j, starts[-1] - j)], ends, False)
            open_pieces, open_norm = [batch.slice(starts[-1])], norms[-1]
        if open_pieces:
            yield from emit(open_pieces, [(0, sum(p.num_rows for p in open_pieces))], True)

    return run


def content_sort_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                       keep: str = "smallest", columns: list[str] | None = None) -> DataFrame:
    """Group rows with equal normalised text (A-Z lower-cased, null = empty).

    Returns ``columns`` of ``docs`` (default: the id alone) plus ``keep_id``,
    ``group_size``, ``kept`` and ``text_sha256``; one output row per input row,
    exactly one kept row per group.  ``keep`` is "smallest" or "largest" id;
    a null id is kept only where the whole group has none; of repeated rows
    with the kept id one stays.  An empty table gives an empty result.
    """
    if keep not in ("smallest", "largest"):
        raise ValueError("keep: smallest or largest")
    own = list(columns or [id_col])
    pass_on = own if id_col in own else [id_col, *own]
    norm = ascii_lower(F.col(f"`{text_col}`"))
    src = docs.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(pass_on)],
                      F.col(f"`{id_col}`").cast("long").alias("_id"), norm.alias("_n"))
    # 128 hash bits: rows that compare equal on the splitters' key have equal texts
    src = src.select("*", F.substring("_n", 1, PREFIX_CHARS).alias("_p"), F.xxhash64("_n").alias("_h"),
                     F.xxhash64(F.lit(1), "_n").alias("_g"))
    ordered = (src.repartitionByRange("_p", "_h", "_g", "_id")
               .sortWithinPartitions("_p", "_h", "_g", "_n", F.col("_id").asc_nulls_first())
               .select(*[f"c{i}" for i in range(len(pass_on))], "_id", F.col("_n").cast("binary").alias("_norm")))
    names = [f"c{i}" for i in range(len(pass_on))] + ["_id"]
    schema = T.StructType([f for f in ordered.schema.fields if f.name in names] + ADDED.fields)
    schema = T.StructType([T.StructField(f.name, f.dataType, True) for f in schema.fields])
    rows = written(ordered.mapInArrow(_runs(names, "_id", keep == "largest"), schema), "content-sort")

    # at most two rows per partition, whatever the data: small enough to broadcast
    edges = rows.where(F.col("_edge").isNotNull()).select("_edge", "_part", "_slot", "_size", "_keep")
    known = F.col("_keep").isNotNull().cast("int")
    order = (F.struct(known, "_keep", "_part", "_slot") if keep == "largest"
             else F.struct(-known, "_keep", "_part", "_slot"))
    best = F.max(order) if keep == "largest" else F.min(order)
    whole = edges.groupBy("_edge").agg(F.sum("_size").alias("_n"), best.alias("_b"))
    at_edge = (edges.select("_edge", "_part", "_slot").join(whole, "_edge")
               .select(F.col("_part"), F.col("_slot"), F.col("_n").alias("_all"), F.col("_b._keep").alias("_best"),
                       ((F.col("_b._part") == F.col("_part")) & (F.col("_b._slot") == F.col("_slot"))).alias("_here")))
    out = rows.join(F.broadcast(at_edge), ["_part", "_slot"], "left")
    inner = F.col("_slot").isNull()
    return out.select(
        *[F.col(f"c{i}").alias(c) for i, c in enumerate(pass_on) if c in own],
        F.when(inner, F.col("_keep")).otherwise(F.col("_best")).alias("keep_id"),
        F.when(inner, F.col("_size")).otherwise(F.col("_all")).alias("group_size"),
        (F.col("_last") & (inner | F.coalesce(F.col("_here"), F.lit(False)))).alias("kept"),
        F.col("_sha").alias("text_sha256"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return content_sort_dedup(table(spark, sf_dir, "documents"), keep="largest")


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one row (largest id) of each group of equal texts, with all its
    columns, whatever their names.  Null and empty texts are one group; of
    repeated rows one stays."""
    own, names = numbered(docs)
    out = content_sort_dedup(own, names["doc_id"], names["text"], keep="largest", columns=own.columns)
    return renamed_back(out.where("kept"), names)


_NORM = f"translate(coalesce(text, ''), '{'ABCDEFGHIJKLMNOPQRSTUVWXYZ'}', '{'abcdefghijklmnopqrstuvwxyz'}')"
SQL = f"""
WITH n AS (SELECT doc_id, {_NORM} AS t FROM documents)
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = max(doc_id) OVER w AS kept, sha256(t) AS text_sha256
FROM n WINDOW w AS (PARTITION BY t)
"""
