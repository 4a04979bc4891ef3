"""Packing by concatenate and cut (operator 13).

All documents' ids, each document followed by the end id, form one long row of
ids, which is cut into sequences of a fixed length: only the last sequence can
be short.  Two passes:

1. Each task encodes the rows of its partition and writes them with their
   start inside the partition.  Partition totals, prefix-summed, are the
   partitions' global starts.
2. Each task cuts its rows at the multiples of the sequence length.  A
   sequence that lies inside the task's rows is finished there; the pieces of
   one that begins or ends elsewhere go out as a boundary record.  The
   boundary records of a sequence (at most ``length`` ids in all) are put
   together in order.

Documents are concatenated in the order in which the table's partitions are
read, so texts are never shuffled or sorted and no key can be hot.  The order
is written down by the first pass; a task that is run again in the second one
reads the same starts.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from outcomekit.llm.common import offsets, small_batches, table, written
from outcomekit.llm.repair_tokens import encoder

LENGTH = 1024                # ids in a sequence
END_ID = 0                   # follows each document
BATCH_ROWS = 256             # texts encoded at once

_PIECES = "doc_ids array<bigint>, starts array<bigint>, lengths array<int>, doc_tokens array<bigint>"
SEQUENCES = f"sequence_id long, first int, length int, ids binary, {_PIECES}"


# ---- first pass: encode -------------------------------------------------

def _encode(path: str, narrow: bool, end_id: int):
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, enc, at = TaskContext.get().partitionId(), encoder(path), 0
        end = np.uint32(end_id).tobytes()
        for batch in batches:
            for lo in range(0, batch.num_rows, BATCH_ROWS):
                rows = batch.slice(lo, BATCH_ROWS)
                coded = [ids + end for ids in enc.batch(rows.column(1).to_pylist())]
                n = np.array([len(ids) // 4 for ids in coded], np.int64)
                ends = at + np.cumsum(n)
                at = int(ends[-1])
                if narrow:
                    flat = np.frombuffer(b"".join(coded), np.uint32).astype(np.uint16)
                    off = np.concatenate(([0], 2 * np.cumsum(n)))
                    ids = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(n), [None, pa.py_buffer(off.astype(np.int64)), pa.py_buffer(flat)]).cast(pa.binary())
                else:
                    ids = pa.array(coded, pa.binary())
                yield pa.record_batch([pa.array(np.full(len(n), part, np.int32)), rows.column(0), pa.array(ends - n), pa.array(n), ids],
                                      names=["part", "doc_id", "inside", "n", "ids"])
    return encode


# ---- second pass: cut ---------------------------------------------------

class _Cutter:
    """Gathers pieces of consecutive ids and closes a record at each multiple
    of ``length``, at a gap, and at the end."""

    def __init__(self, length: int):
        self.length, self.next = length, None
        self.open: list[tuple] = []          # (doc_id, start in document, ids, document's ids)
        self.first = self.held = self.number = 0
        self.rows: list[tuple] = []

    def close(self) -> None:
        if self.open:
            docs, starts, ids, sizes = zip(*self.open)
            self.rows.append((self.number, self.first, self.held, b"".join(i.tobytes() for i in ids),
                              list(docs), list(starts), [len(i) for i in ids], list(sizes)))
        self.open, self.held = [], 0

    def add(self, doc_id: int | None, begin: int, ids: np.ndarray) -> None:
        """A document's ids, the first of which is number ``begin`` of all."""
        if begin != self.next:
            self.close()
        at, n = 0, len(ids)
        while at < n:
            place = begin + at
            if not self.open:
                self.number, self.first = divmod(place, self.length)
            take = min(n - at, self.length - place % self.length)
            self.open.append((doc_id, at, ids[at: at + take], n))
            self.held += take
            at += take
            if (place + take) % self.length == 0:
                self.close()
        self.next = begin + n

    def taken(self) -> Iterator[pa.RecordBatch]:
        if self.rows:
            kinds = [pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.list_(pa.int64()), pa.list_(pa.int64()),
                     pa.list_(pa.int32()), pa.list_(pa.int64())]
            names = ["sequence_id", "first", "length", "ids", "doc_ids", "starts", "lengths", "doc_tokens"]
            yield pa.record_batch([pa.array(c, k) for c, k in zip(zip(*self.rows), kinds)], names=names)
            self.rows = []


def _cut(length: int, narrow: bool):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cutter = _Cutter(length)
        for batch in batches:
            raw = batch.column("ids")
            off = offsets(raw)
            buf = np.frombuffer(raw.buffers()[2], np.uint8) if batch.num_rows else None
            ids_of = lambda i: buf[off[i]: off[i + 1]].view(np.uint16 if narrow else np.uint32).astype("<u4")
            docs, begin = batch.column("doc_id").to_pylist(), batch.column("begin").to_pylist()
            for i in range(batch.num_rows):
                cutter.add(docs[i], begin[i], ids_of(i))
                if len(cutter.rows) >= 1000:
                    yield from cutter.taken()
        cutter.close()
        yield from cutter.taken()
    return cut


def concatenate_and_cut(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text",
                        length: int = LENGTH, end_id: int = END_ID) -> DataFrame:
    """One row per sequence: ``sequence_id`` (0, 1, ...), ``length`` (``length``
    for all but the last one), ``ids`` (little-endian uint32) and, per piece in
    order, ``doc_ids``, ``starts`` (ids of the document before the piece),
    ``lengths`` and ``doc_tokens`` (the document's ids, its end id included).

    A null text counts as empty: its end id alone.  Null ids stay null, rows
    that repeat (or share an id) are separate documents, a text of any length
    is cut as often as needed, other columns of ``docs`` are not read, and an
    empty table has no sequences.
    """
    if length < 1:
        raise ValueError("length: 1 or more")
    from tokenizers import Tokenizer
    narrow = max(Tokenizer.from_file(tokenizer).get_vocab_size() - 1, end_id) < 1 << 16
    src = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"),
                      F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("t"))
    with small_batches(docs.sparkSession):
        tokens = written(src.mapInArrow(_encode(os.fspath(tokenizer), narrow, end_id),
                                        "part int, doc_id long, inside long, n long, ids binary"), "cut-tokens")
        # one row per partition of the first pass, whatever the data: a running sum in one task, broadcast
        totals = tokens.groupBy("part").agg(F.sum("n").alias("total"))
        before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
        base = totals.select("part", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("base"))
        placed = tokens.join(F.broadcast(base), "part").select("doc_id", (F.col("base") + F.col("inside")).alias("begin"), "ids")
        records = written(placed.mapInArrow(_cut(length, narrow), SEQUENCES), "cut-records")
    whole = (F.col("first") == 0) & (F.col("length") == length)
    names = ["doc_ids", "starts", "lengths", "doc_tokens"]
    # a sequence has ``length`` ids at most, so its boundary records are a bounded group
    edge = (records.where(~whole).groupBy("sequence_id")
            .agg(F.sort_array(F.collect_list(F.struct("first", "length", "ids", *names))).alias("r")))
    joined = F.aggregate("r", F.lit(b"").cast("binary"), lambda acc, x: F.concat(acc, x["ids"]))
    edge = edge.select("sequence_id", F.aggregate("r", F.lit(0), lambda acc, x: acc + x["length"]).alias("length"), joined.alias("ids"),
                       *[F.flatten(F.col("r").getField(c)).alias(c) for c in names])
    return records.where(whole).select("sequence_id", "length", "ids", *names).unionByName(edge)


# ---- the query's rows ---------------------------------------------------

def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        count = np.diff(batch.column("lengths").offsets.to_numpy().astype(np.int64))
        docs, starts, sizes, totals = (batch.column(c).flatten() for c in ("doc_ids", "starts", "lengths", "doc_tokens"))
        n = sizes.to_numpy().astype(np.int64)
        number = np.repeat(batch.column("sequence_id").to_numpy(), count)
        ends = np.cumsum(n)
        lead = np.cumsum(count) - count                                  # each sequence's first piece
        zero = np.concatenate(([0], ends))[lead]
        offset = ends - n - np.repeat(zero, count)
        crc, row = np.zeros(len(n), np.int64), np.repeat(np.arange(batch.num_rows), count)
        views = [memoryview(x.as_buffer()) for x in batch.column("ids")]
        for i, (r, a, k) in enumerate(zip(row.tolist(), offset.tolist(), n.tolist())):
            crc[i] = zlib.crc32(views[r][4 * a: 4 * (a + k)])
        yield pa.record_batch([docs, starts, pa.array(n), pa.array(crc), totals, pa.array(number), pa.array(offset)],
                              names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"])


def pieces(sequences: DataFrame) -> DataFrame:
    """One row per piece of the sequences, its ids as their crc32."""
    with small_batches(sequences.sparkSession):
        return sequences.mapInArrow(_pieces, "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
                                             "sequence_id long, offset long")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    return pieces(concatenate_and_cut(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json")))
