"""Document fingerprints by winnowing (operator 3), in DataFrame functions only.

A text is read as pieces of at most four characters, cut anew at white space.
A run of at most ``WORD`` characters without white space is tiled by pieces, so
an edit shifts pieces inside its own word only.  In a longer run (text without
spaces, code, URLs) a piece starts at every character, so equal text has equal
pieces at any offset.  The hash of ``K`` neighbouring pieces rolls over the text
(cyclic polynomial: rotate and XOR).  In every window of ``W`` such hashes the
smallest one is marked, the rightmost of equal ones; marks keep the character
at which they start.  Two texts that share ``W + K - 1`` neighbouring pieces
share a mark: so do two texts that share a passage with so many pieces in whole
words, or in parts of long runs.

Hash and position are packed in one long, (hash << 32) + (MAX - position), so
that the smallest long is the smallest hash, rightmost.  Window minima come
from log2(W) passes, each of which doubles the span: no window is scanned.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from outcomekit.llm.common import table

RUN = r"([^\x20\x09-\x0D]+)"
# for each character of a text: itself where a run starts, else empty
RUN_START = r"(?s)(?=((?:^|(?<=[\x20\x09-\x0D]))[^\x20\x09-\x0D])?)."
PIECE = 4                    # characters in a piece
WORD = 16                    # characters of a run without white space that is still tiled
TILED, EVERYWHERE = r"(?s)(.{1,4})", r"(?s)(?=(.{4}))."
K = 3                        # pieces in a hash
W = 8                        # hashes in a window, a power of two
MAX = 0x7FFFFFFF
BUCKETS = 3                  # id ranges for each shuffle partition


def _pairwise_min(a: Column, step: int) -> Column:
    """Element i: the smaller of a[i] and a[i + step]."""
    return F.zip_with(F.slice(a, F.lit(1), F.greatest(F.size(a) - step, F.lit(0))),
                      F.slice(a, F.lit(1 + step), F.greatest(F.size(a) - step, F.lit(0))),
                      lambda x, y: F.when(x < y, x).otherwise(y))


def with_marks(df: DataFrame, text: str, out: str) -> DataFrame:
    """Add ``out``: the packed marks of ``text`` in text order (null or blank:
    none; a text of fewer than ``K`` pieces has the hash of all of them)."""
    r, s, p, q, g = (f"{out}_{c}" for c in "rspqg")
    df = df.withColumn(r, F.regexp_extract_all(F.col(text), F.lit(RUN)))
    df = df.withColumn(s, F.filter(F.transform(F.regexp_extract_all(F.col(text), F.lit(RUN_START)),
                                               lambda x, i: F.when(x != "", i)), lambda i: i.isNotNull()))
    pieces = lambda x: F.when(F.length(x) <= WORD, F.regexp_extract_all(x, F.lit(TILED))) \
        .otherwise(F.regexp_extract_all(x, F.lit(EVERYWHERE)))                                # noqa: E731
    starts = lambda x, at: F.when(F.length(x) <= WORD, F.sequence(at, at + F.length(x) - 1, F.lit(PIECE))) \
        .otherwise(F.sequence(at, at + F.length(x) - PIECE, F.lit(1)))                        # noqa: E731
    df = df.withColumn(p, F.transform(F.flatten(F.transform(r, pieces)), lambda x: F.xxhash64(x)))
    df = df.withColumn(q, F.flatten(F.zip_with(r, s, starts)))
    n = F.size(p)
    rolled = F.transform(
        F.slice(p, F.lit(1), F.greatest(n - (K - 1), F.lit(0))),
        lambda x, i: (F.shiftleft(x, 2).bitwiseXOR(F.shiftrightunsigned(x, 62)))
        .bitwiseXOR(F.shiftleft(F.get(p, i + 1), 1)).bitwiseXOR(F.shiftrightunsigned(F.get(p, i + 1), 63))
        .bitwiseXOR(F.get(p, i + 2)).bitwiseAND(F.lit(MAX)))
    rolled = F.zip_with(rolled, F.slice(q, F.lit(1), F.greatest(n - (K - 1), F.lit(0))),
                        lambda x, at: F.shiftleft(x, 32) + (F.lit(MAX).cast("long") - at))
    short = F.array(F.shiftleft(F.xxhash64(p).bitwiseAND(F.lit(MAX)), 32) + (F.lit(MAX).cast("long") - F.get(q, F.lit(0))))
    df = df.withColumn(g, F.when(n == 0, F.array().cast("array<bigint>")).when(n < K, short).otherwise(rolled))
    level, name = 1, g
    while level < W:
        made = f"{out}_m{level}"
        df = df.withColumn(made, _pairwise_min(F.col(name), level))
        level, name = level * 2, made
    some = F.size(g) > 0
    return df.withColumn(out, F.when(F.size(g) >= W, F.array_distinct(name))
                         .when(some, F.array(F.array_min(g))).otherwise(F.col(g)))


def hashes(marks: str | Column) -> Column:
    return F.transform(marks, lambda v: F.shiftright(v, 32).cast("int"))


def positions(marks: str | Column) -> Column:
    """Character at which each mark starts, from 0."""
    return F.transform(marks, lambda v: (F.lit(MAX) - v.bitwiseAND(F.lit(0xFFFFFFFF))).cast("int"))


def likeness(a: Column, b: Column) -> Column:
    """Jaccard similarity of two arrays of distinct hashes; two empty ones are alike."""
    both = F.size(F.array_intersect(a, b))
    total = F.size(a) + F.size(b) - both
    return F.when(total == 0, 1.0).otherwise(both / total)


def _ranges(docs: DataFrame, buckets: int) -> tuple[list[int], dict[int, int]]:
    """Lower ends of at most ``buckets`` id ranges, and the largest id in each
    non-empty range (range number -> id)."""
    probs = [i / buckets for i in range(1, buckets)] or [0.5]
    cuts = docs.agg(F.percentile_approx("doc_id", probs, 100 * buckets).alias("e")).first()["e"] or []
    edges = sorted(set(cuts))
    heads = docs.where("doc_id is not null").groupBy(_range_of(edges).alias("b")).agg(F.max("doc_id").alias("m")).collect()
    return edges, {r["b"]: r["m"] for r in heads}


def _range_of(edges: list[int]) -> Column:
    if not edges:
        return F.lit(0)
    return F.coalesce(F.size(F.filter(F.lit(edges).cast("array<bigint>"), lambda e: e <= F.col("doc_id"))), F.lit(0))


def with_next(df: DataFrame, columns: list[str], buckets: int) -> DataFrame:
    """Add ``next_<c>``: ``columns`` of the next row in descending ``doc_id``
    (after the last row: the first).  Rows meet in ranges of ids; the first row
    of a range is also sent to the range that ends before it, so that no order
    over all rows is needed.  Null ids come last, as one range's end."""
    edges, heads = _ranges(df.select("doc_id"), buckets)
    filled = sorted(heads)
    # the head of each range also goes to the next filled range above; the top one closes the circle below
    goes = {heads[b]: filled[(i + 1) % len(filled)] for i, b in enumerate(filled)}
    own = F.struct(_range_of(edges).alias("b"), F.lit(0).alias("extra"))
    if goes:
        # one entry per range: bounded by ``buckets``
        to = F.create_map(*[F.lit(x).cast(t) for pair in goes.items() for x, t in zip(pair, ("bigint", "int"))])
        there = F.when(F.col("doc_id").isin(list(goes)), F.array(own, F.struct(to[F.col("doc_id")].alias("b"), F.lit(1).alias("extra"))))
        df = df.withColumn("_r", F.explode(F.coalesce(there, F.array(own))))
    else:
        df = df.withColumn("_r", own)
    # ties of one id: in the order of their first column
    w = Window.partitionBy("_r.b").orderBy("_r.extra", F.col("doc_id").desc_nulls_last(), columns[0])
    return (df.select("*", *[F.lead(c).over(w).alias(f"next_{c}") for c in columns])
            .where(F.col("_r.extra") == 0).drop("_r"))


def fingerprints(docs: DataFrame, buckets: int | None = None) -> DataFrame:
    """Fingerprints of ``text`` and of its edited form, per row of ``docs``.

    Null texts count as empty.  ``fingerprint`` lists the marks' hashes (hex) in
    text order, ``mark_positions`` their places.  A lone document is its own
    next one.  Where every id is null there is no first row to return to, and
    the last row's next text is empty.
    """
    spark = docs.sparkSession
    buckets = buckets or BUCKETS * int(spark.conf.get("spark.sql.shuffle.partitions"))
    df = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("t"))
    df = with_marks(df, "t", "f").select("t", "doc_id", "f")
    df = with_next(df, ["t", "f"], buckets)
    n = F.length("t")
    half = F.floor(n / 2).cast("int")
    df = df.withColumn("n_chars", n.cast("long")).withColumn(
        "e", F.concat(F.col("t").substr(F.lit(1), n - half), F.coalesce(F.col("next_t").substr(F.lit(1), half), F.lit(""))))
    df = df.select("doc_id", "n_chars", "e", "f", F.array_distinct(hashes("f")).alias("h"),
                   F.array_distinct(hashes(F.coalesce("next_f", F.array().cast("array<bigint>")))).alias("next_h"))
    df = with_marks(df, "e", "ef").withColumn("eh", F.array_distinct(hashes("ef")))
    text = lambda a: F.array_join(F.transform(hashes(a), lambda x: F.hex(x)), " ")            # noqa: E731
    return df.select("doc_id", "n_chars", F.sha2(F.col("e"), 256).alias("edited_sha256"),
                     text("f").alias("fingerprint"), text("ef").alias("edited_fingerprint"),
                     likeness(F.col("h"), F.col("eh")).alias("near_edited"),
                     likeness(F.col("h"), F.col("next_h")).alias("near_next"),
                     positions("f").alias("mark_positions"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints(table(spark, sf_dir, "documents"))
