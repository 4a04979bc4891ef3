"""N-gram Jaccard join by parity sketches (operator 4).

A document's set of shingle hashes is XOR-ed into the segments of a sketch.
A shingle that only one of two documents has changes one segment at most, so
the number of segments that differ is no larger than the symmetric difference
of the sets.  At a Jaccard similarity of 0.8 or more, that difference is at
most a quarter of either set; if all but so many of a document's E non-empty
segments agree, then the first D + 1 segments of both documents, in one global
order, share one (pigeonhole).  Those segments are the join keys.

* Size bands: sets of 64 2**k to 64 2**(k+1) shingles have 256 2**k segments;
  a set within 5/4 of a band's lower end is sketched for the band below too,
  so any two sets that can link share a band.  Sets under 64 shingles form one
  band whose segments hold one shingle each.
* The order puts segments first that hold a shingle which is not frequent in
  the corpus; frequent shingles (counted over all documents) come last.  The
  order decides the work, not the result.
* Copies: documents with equal sets are one class; only its smallest id joins.
* Neither texts nor sets of all documents are shuffled: a bitmap of fixed size
  (ids hashed to bits) tells the tasks that read the texts which ones are
  wanted.  A wrong hit makes a row too many, never one too few.
* No group is expanded into all pairs.  First each member of a key is compared
  with the key's smallest id; links make components.  Leader rounds follow: in
  each, the members of a key that are in another component than a member
  chosen by hash are compared with that one, and components are merged again;
  a round makes one row a member at most.  Only then are the members of
  different components of one key compared, and of those only pairs whose
  places of the key, counted in the order, leave room for a link: the segments
  before a pair's first common key all differ.  A frequent key comes last in
  the order, so that only documents made of little else are compared by it.
  Their rows bring a sketch along (of ``FOLDED`` words, where a key has many
  members), so that a group of many texts that are alike but not alike enough
  makes comparisons, yet few rows; and the set's first keys, so that a pair is
  compared under its first common key and not under each one it shares.
* A pair is first judged by parity sketches, whose Hamming distance is no
  larger than the symmetric difference; what passes is verified on the whole
  sets, rebuilt from the texts.  A sketch has four bits or more for every
  shingle of its size band; the wider of two is folded to the narrower.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from outcomekit.llm.common import discard, numbered, renamed_back, small_batches, table, text_bytes, written
from outcomekit.llm.components import components
from outcomekit.llm.shingles import mix64, shingle_sets

LEAST_BAND = 64              # shingles; below, one segment a shingle
HOT_CHUNK = 2_000_000        # shingles counted at once
HOT_LEAST = 4                # of them, for a shingle to be reported as frequent
HOT_KEYS = 200_000           # most frequent shingles that the order knows (never decides a link)
SKETCH = 1 << 11             # bits of a sketch at least
FIRST = 8                    # 64-bit words of the narrow sketch that a pair meets first
FOLDED = 32                  # 64-bit words of the wider one, ...
LARGE = 256                  # ... which sets of so many shingles bring along in the last round
SMALL = 8                    # a key of so few members compares them without the wider one
BEFORE = 8                   # first keys of a set that its rows of the last round know
ROUNDS = 2                   # leader rounds at most; the last round compares what they leave
BITS = 1 << 24               # of a bitmap of ids (2 MB); a full one makes more work, not other results


# ---- frequent shingles --------------------------------------------------

def _count_hot(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held, size = [], 0

    def report():
        keys, n = np.unique(np.concatenate(held), return_counts=True)
        hot = n >= HOT_LEAST
        return pa.record_batch([pa.array(keys[hot].view(np.int64)), pa.array(n[hot].astype(np.int64))], names=["key", "n"])

    for batch in batches:
        for _, s in shingle_sets(batch.column(0)):
            held.append(s)
            size += len(s)
            if size >= HOT_CHUNK:
                yield report()
                held, size = [], 0
    if held:
        yield report()


def frequent_shingles(texts: DataFrame) -> np.ndarray:
    """Hashes of the most frequent shingles, sorted; at most ``HOT_KEYS``."""
    counts = texts.select("t").mapInArrow(_count_hot, "key long, n long").groupBy("key").agg(F.sum("n").alias("n"))
    top = counts.orderBy(F.desc("n"), "key").limit(HOT_KEYS).select("key").toPandas()["key"].to_numpy(np.int64)
    return np.sort(top.view(np.uint64))


# ---- sketches -----------------------------------------------------------

def segments(s: np.ndarray, count: int | None) -> tuple[np.ndarray, np.ndarray]:
    """XOR of the hashes in each non-empty segment and where each one begins in
    ``s`` (sorted); ``count`` (a power of two) segments, None: one a shingle."""
    if count is None:
        return s, np.arange(len(s))
    place = s >> np.uint64(64 - (count.bit_length() - 1))
    first = np.flatnonzero(np.concatenate(([True], place[1:] != place[:-1])))
    return np.bitwise_xor.reduceat(s, first) ^ mix64(place[first] + np.uint64(count)), first


def bands(n: int) -> list[int | None]:
    """Segment counts for which a set of ``n`` shingles is sketched."""
    if n < LEAST_BAND:
        return [None]
    low = LEAST_BAND << ((n // LEAST_BAND).bit_length() - 1)
    near = 4 * n <= 5 * low
    return [4 * low] + ([None if low == LEAST_BAND else 2 * low] if near else [])


def join_keys(s: np.ndarray, hot: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The keys under which a set (sorted hashes) is joined, and each key's
    place among its band's in the order: p, or -1 - p where a segment may hold
    several shingles."""
    n, out, places = len(s), [], []
    if not n:
        return s, np.zeros(0, np.int32)
    if len(hot):
        is_hot = hot[np.minimum(np.searchsorted(hot, s), len(hot) - 1)] == s
    else:
        is_hot = np.zeros(n, bool)
    for count in bands(n):
        value, first = segments(s, count)
        if len(value) <= n // 4:
            raise ArithmeticError("too few non-empty segments for the pigeonhole")
        rank = np.logical_and.reduceat(is_hot, first)
        take = n // 4 + 1
        # a key's place depends on the key alone: its class, then its own mixed bits
        mixed = mix64(value + np.uint64(count or 1))
        # a set's two bands are neighbours: the lowest bit tells their keys apart
        odd = np.uint64((count or 1).bit_length() & 1)
        mixed = (mixed >> np.uint64(1) << np.uint64(1)) | odd
        order = np.lexsort((mixed, rank))[:take]
        out.append(mixed[order])
        place = np.arange(len(order), dtype=np.int32)
        places.append(place if count is None else -1 - place)
    return np.concatenate(out), np.concatenate(places)


def _classes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Size and digest of each document's set."""
    for batch in batches:
        n, same = np.zeros(batch.num_rows, np.int64), [None] * batch.num_rows
        for i, s in shingle_sets(batch.column("t")):
            n[i] = len(s)
            same[i] = xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None
        yield pa.record_batch([batch.column("id"), pa.array(n), pa.array(same, pa.binary())], names=["id", "n", "same"])


def _wanted(batch: pa.RecordBatch, bits: np.ndarray) -> pa.RecordBatch:
    place = batch.column("place").fill_null(0).to_numpy()
    hit = (bits[place >> 3] >> (place & 7)) & 1
    return batch.filter(pa.array(hit.astype(bool) & batch.column("id").is_valid().to_numpy(zero_copy_only=False)))


def _keys(hot: np.ndarray, bits: np.ndarray):
    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            batch = _wanted(batch, bits)
            own, at = [np.zeros(0, np.uint64)] * batch.num_rows, [np.zeros(0, np.int32)] * batch.num_rows
            n = np.zeros(batch.num_rows, np.int32)
            for i, s in shingle_sets(batch.column("t")):
                (own[i], at[i]), n[i] = join_keys(s, hot), len(s)
            if batch.num_rows:
                times = [len(k) for k in own]
                yield pa.record_batch([pa.array(np.concatenate(own).view(np.int64)),
                                       pa.array(np.repeat(batch.column("id").to_numpy(), times)),
                                       pa.array(np.repeat(n, times)), pa.array(np.concatenate(at))],
                                      names=["key", "id", "n", "p"])
    return keys


def _with_lowest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows arrive sorted by (key, id): put the key's first row beside each of
    its rows; keys of one row go."""
    last, waiting = None, False          # the current key's first row; does it still have to be given out?
    for batch in batches:
        if not batch.num_rows:
            continue
        key, doc, n, p = (batch.column(c).to_numpy() for c in ("key", "id", "n", "p"))
        new = np.concatenate(([True], key[1:] != key[:-1]))
        goes_on = last is not None and last[0] == key[0]
        new[0] = not goes_on
        first = np.maximum.accumulate(np.where(new, np.arange(len(key)), -1))
        a = np.where(first >= 0, doc[first], last[1] if goes_on else 0)
        an = np.where(first >= 0, n[first], last[2] if goes_on else 0).astype(np.int32)
        ap = np.where(first >= 0, p[first], last[3] if goes_on else 0).astype(np.int32)
        follows = np.concatenate((~new[1:], [False]))
        keep = ~new | follows            # has a neighbour of its key in this batch or before
        out = [c[keep] for c in (key, doc, n, p, a, an, ap)]
        if goes_on and waiting:
            out = [np.concatenate(([v], o)).astype(o.dtype) for v, o in zip((*last, *last[1:]), out)]
            waiting = False
        if len(out[0]):
            yield pa.record_batch([pa.array(o) for o in out], names=["key", "id", "n", "p", "a", "an", "ap"])
        if first[-1] >= 0:
            at = first[-1]
            last, waiting = (key[at], doc[at], n[at], p[at]), at == len(key) - 1


def place_of(id_col: str = "id") -> Column:
    """The bit of an id."""
    return F.pmod(F.xxhash64(id_col), F.lit(BITS))


def bitmap(ids: DataFrame) -> np.ndarray:
    """Bitmap (``BITS`` bits) of the places of ``id``; read by the driver as at
    most BITS / 32768 blocks of 4 KB."""
    place = place_of() + 1
    blocks = ids.groupBy(F.bitmap_bucket_number(place).alias("b")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("m"))
    out = np.zeros(BITS >> 3, np.uint8)
    for r in blocks.where("b is not null").collect():
        out[(r["b"] - 1) * 4096: r["b"] * 4096] = np.frombuffer(bytes(r["m"]), np.uint8)
    return out


# ---- verification -------------------------------------------------------

def _as_sets(bits: np.ndarray):
    def as_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            batch = _wanted(batch, bits)
            sets = [s.tobytes() for _, s in shingle_sets(batch.column("t"))]
            yield pa.record_batch([batch.column("id"), pa.array(sets, pa.binary())], names=["id", "s"])
    return as_sets


def width_of(n: int) -> int:
    """Bits of the sketch of ``n`` shingles: four for each of its band's upper end."""
    return max(SKETCH, 4 << int(n).bit_length())


def parity(s: np.ndarray) -> bytes:
    """XOR of one bit per shingle: bit i is the parity of those hashed to i."""
    width = width_of(len(s))
    place = (s & np.uint64(width - 1)).astype(np.int64)
    return np.packbits((np.bincount(place, minlength=width) & 1).astype(np.uint8), bitorder="little").tobytes()


def folded(words: np.ndarray, count: int) -> np.ndarray:
    """A sketch's 64-bit words, folded to ``count`` (a power of two) by XOR: the
    sketch of the same set at that width."""
    return np.bitwise_xor.reduce(words.reshape(-1, count), axis=0)


def _as_sketches(bits: np.ndarray):
    def as_sketches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            batch = _wanted(batch, bits)
            n, k = [], []
            for _, s in shingle_sets(batch.column("t")):
                n.append(len(s))
                k.append(parity(s))
            yield pa.record_batch([batch.column("id"), pa.array(n, pa.int32()), pa.array(k, pa.binary())], names=["id", "n", "k"])
    return as_sketches


def _as_judged(bits: np.ndarray):
    """Size, sketch and whole set."""
    def as_judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            batch = _wanted(batch, bits)
            n, k, sets = [], [], []
            for _, s in shingle_sets(batch.column("t")):
                n.append(len(s))
                k.append(parity(s))
                sets.append(s.tobytes())
            yield pa.record_batch([batch.column("id"), pa.array(n, pa.int32()), pa.array(k, pa.binary()), pa.array(sets, pa.binary())],
                                  names=["id", "n", "k", "s"])
    return as_judged


def _as_folded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sketches folded by XOR (as parities, they bound the difference too): to
    FIRST words, and to FOLDED words for sets of ``LARGE`` shingles or more."""
    for batch in batches:
        k, wide = np.zeros((batch.num_rows, FIRST), np.int64), [None] * batch.num_rows
        for i, (x, n) in enumerate(zip(batch.column("k"), batch.column("n").to_pylist())):
            w = folded(np.frombuffer(x.as_buffer(), np.int64), FOLDED)
            k[i], wide[i] = folded(w, FIRST), w if n >= LARGE else None
        yield pa.record_batch([batch.column("id"), *(pa.array(w) for w in np.ascontiguousarray(k.T)), pa.array(wide, pa.list_(pa.int64()))],
                              names=["id", *(f"f{w}" for w in range(FIRST)), "wide"])


def _near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs whose sketches differ in no more bits than linked sets may."""
    for batch in batches:
        differ = np.zeros(batch.num_rows, np.int64)
        for i, (x, y) in enumerate(zip(batch.column("ka"), batch.column("kb"))):
            a, b = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
            least = min(len(a), len(b))
            differ[i] = np.bitwise_count(folded(a, least) ^ folded(b, least)).sum(dtype=np.int64)
        most = batch.column("na").to_numpy().astype(np.int64) + batch.column("nb").to_numpy()
        yield batch.select(["a", "b"]).filter(pa.array(9 * differ <= most))


def _linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keep = []
        for x, y in zip(batch.column("sa"), batch.column("sb")):
            a, b = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
            both = np.sort(np.concatenate((a, b)))
            common = int((both[1:] == both[:-1]).sum())
            keep.append(100 * common >= 80 * (len(a) + len(b) - common))
        yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))


def _of_pairs(pairs: DataFrame, texts: DataFrame, made, schema: str, name: str) -> DataFrame:
    """``made`` of the texts of all documents in ``pairs``, written."""
    return _of_ids(pairs.select(F.col("a").alias("id")).union(pairs.select("b")), texts, made, schema, name)


def _of_ids(ids: DataFrame, texts: DataFrame, made, schema: str, name: str) -> DataFrame:
    bits = bitmap(ids)
    return written(texts.select("id", "t", place_of().alias("place")).mapInArrow(made(bits), schema), name)


def verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs (a, b) whose whole sets link, written."""
    pairs = written(pairs, "pairs")
    if pairs.isEmpty():
        return pairs
    k = _of_pairs(pairs, texts, _as_sketches, "id long, n int, k binary", "pair-sketches")
    near = pairs.join(k.toDF("a", "na", "ka"), "a").join(k.toDF("b", "nb", "kb"), "b")
    near = written(near.mapInArrow(_near, "a long, b long").distinct(), "near-pairs")
    discard(pairs, k)
    if near.isEmpty():
        return near
    s = _of_pairs(near, texts, _as_sets, "id long, s binary", "pair-sets")
    out = written(near.join(s.toDF("a", "sa"), "a").join(s.toDF("b", "sb"), "b").mapInArrow(_linked, "a long, b long"), "links")
    discard(near, s)
    return out


def _judged(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) that link, by the sketches and sets given.  Sketches are
    joined first, so that sets are read for pairs that pass them only."""
    k, s = sets.select("id", "n", "k"), sets.select("id", "s")
    near = pairs.join(k.toDF("a", "na", "ka"), "a").join(k.toDF("b", "nb", "kb"), "b").mapInArrow(_near, "a long, b long")
    return near.join(s.toDF("a", "sa"), "a").join(s.toDF("b", "sb"), "b").mapInArrow(_linked, "a long, b long")


# ---- the join -----------------------------------------------------------

def _side(rows: DataFrame, side: str) -> DataFrame:
    """``key`` and all else of ``rows``, as that side's columns."""
    return rows.select("key", *(F.col(c).alias(f"{side}_{c}") for c in rows.columns if c != "key"))


def _may_link(an: str, bn: str, ap: str, bp: str) -> Column:
    """Could two sets of these sizes link, were the key in these places their
    first common one?  A link allows a symmetric difference of (an + bn) / 9.
    The segments before the key differ: all of both, where a segment is a
    shingle; else as many as the one set or the other has."""
    an, bn, ap, bp = (F.col(c) for c in (an, bn, ap, bp))
    sizes = (5 * an >= 4 * bn) & (5 * bn >= 4 * an)
    return sizes & (9 * F.when(ap < 0, F.greatest(-1 - ap, -1 - bp)).otherwise(ap + bp) <= an + bn)


def _open(member: DataFrame, found: DataFrame) -> DataFrame:
    """``member`` (key, id, n, p) rows of keys whose members are in several
    components (``found``: id, root), with their ``root``, written."""
    member = member.join(found, "id", "left").withColumn("root", F.coalesce("root", "id"))
    split = member.groupBy("key").agg(F.min("root").alias("lo"), F.max("root").alias("hi"), F.count("*").alias("c"))
    split = split.where("lo <> hi").select("key", F.least("c", F.lit(SMALL + 1)).cast("int").alias("c"))
    return written(member.join(split, "key").select("key", "id", "n", "p", "root", "c"), "open")


def _with_earlier(open_: DataFrame) -> DataFrame:
    """``open_`` with ``before``: keys of the set's same band that come before
    the row's in the order, of the first ``BEFORE``.  Two sets of different
    components find all their common keys in ``open_``; where a key is in both
    their ``before``, it comes first and compares them."""
    band = ["id", (F.col("p") < 0).alias("wide_band"), F.col("key").bitwiseAND(1).alias("odd")]
    place = F.when(F.col("p") < 0, -1 - F.col("p")).otherwise(F.col("p")).alias("place")
    rows = open_.select("*", *band[1:], place)
    first = rows.groupBy("id", "wide_band", "odd").agg(
        F.slice(F.array_sort(F.collect_list(F.struct("place", "key"))), 1, BEFORE).alias("first"))
    earlier = F.transform(F.filter("first", lambda x: x["place"] < F.col("place")), lambda x: x["key"])
    return rows.join(first, ["id", "wide_band", "odd"]).select(*open_.columns, earlier.alias("before"))


def _with_leaders(open_: DataFrame, turn: int) -> DataFrame:
    """Pairs (a, b): each key's member of the smallest hash, another one in each
    ``turn``, and the key's members in other components than that one's."""
    lead = F.min(F.struct(F.xxhash64(F.lit(turn), "id").alias("h"), "id", "n", "p", "root")).alias("l")
    lead = open_.groupBy("key").agg(lead).select("key", *[F.col(f"l.{c}").alias(f"l_{c}") for c in ("id", "n", "p", "root")])
    met = open_.join(lead, "key").where((F.col("root") != F.col("l_root")) & _may_link("n", "l_n", "p", "l_p"))
    return met.select(F.least("id", "l_id").alias("a"), F.greatest("id", "l_id").alias("b")).distinct()


def _merged(found: DataFrame, links: DataFrame) -> DataFrame:
    """Components (id, root) after further links (a, b)."""
    return components(found.where("id <> root").select(F.col("id").alias("a"), F.col("root").alias("b")).union(links))


def similarity_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, n_shingles, component_id`` per row of ``docs``.

    A null or blank text has no shingles and is linked with nothing; other
    equal texts are linked.  Rows that share an id are one document: it links
    where any of its texts links.  A row without an id shares the component of
    the rows with its text; where none of those has an id, the component is null.
    """
    texts = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), text_bytes(F.col(f"`{text_col}`")).alias("t"))
    with small_batches(docs.sparkSession):
        hot = frequent_shingles(texts)
        base = written(texts.mapInArrow(_classes, "id long, n long, same binary"), "sets-of-documents")
        classes = written(base.where("same is not null").groupBy("same").agg(F.min("id").alias("rep")), "classes")
        bits = bitmap(classes.where("rep is not null").select(F.col("rep").alias("id")))
        keyed = texts.select("id", "t", place_of().alias("place")).mapInArrow(_keys(hot, bits), "key long, id long, n int, p int")
        # a sketch's key is one of many of a document: even a key of many documents is a small part of a task's rows
        keyed = keyed.repartition("key").sortWithinPartitions("key", "id")
        members = written(keyed.mapInArrow(_with_lowest, "key long, id long, n int, p int, a long, an int, ap int"), "members")
        first = (members.where((F.col("id") > F.col("a")) & _may_link("n", "an", "p", "ap"))
                 .select("a", F.col("id").alias("b")).distinct())
        found = written(components(verified(first, texts)), "roots")
        open_ = _open(members.select("key", "id", "n", "p"), found)
        discard(members)
        # the sets of the documents left open, read once for all rounds
        sets = _of_ids(open_.select("id"), texts, _as_judged, "id long, n int, k binary, s binary", "open-sets")
        for k in range(ROUNDS):
            links = written(_judged(_with_leaders(open_, k), sets), "links")
            if links.isEmpty():
                break
            found, before = written(_merged(found, links), "roots"), found
            open_, was = _open(open_.select("key", "id", "n", "p"), found), open_
            discard(before, links, was)
        # what the leaders leave: members of different components of one key
        # a sketch folded to FIRST words sorts out most pairs; large sets, which it can't tell apart, bring a wider one
        names = [f"f{w}" for w in range(FIRST)]
        words = sets.select("id", "k", "n").mapInArrow(_as_folded, ", ".join(["id long", *(f"{w} long" for w in names), "wide array<bigint>"]))
        rows = _with_earlier(open_).join(words, "id").withColumn("wide", F.when(F.col("c") > SMALL, F.col("wide"))).drop("c")
        room = F.col("a_n") + F.col("b_n")
        narrow = sum((F.bit_count(F.col(f"a_{w}").bitwiseXOR(F.col(f"b_{w}"))) for w in names), F.lit(0))
        bits = F.aggregate(F.zip_with("a_wide", "b_wide", lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda x, y: x + y)
        last = (_side(rows, "a").join(_side(rows, "b"), "key")
                .where((F.col("a_root") < F.col("b_root")) & _may_link("a_n", "b_n", "a_p", "b_p")
                       & (9 * narrow <= room) & F.coalesce(9 * bits <= room, F.lit(True))
                       & ~F.arrays_overlap("a_before", "b_before"))
                .select(F.least("a_id", "b_id").alias("a"), F.greatest("a_id", "b_id").alias("b")).distinct())
        final = written(_merged(found, written(_judged(last, sets), "links")), "roots")
        discard(open_, sets, found)
        label = classes.join(final.withColumnRenamed("id", "rep"), "rep", "left")
        label = label.select("same", F.coalesce("root", "rep").alias("component_id"))
    return (base.select("id", "n", "same").join(label, "same", "left")
            .select("id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "id").alias("component_id")))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = similarity_components(table(spark, sf_dir, "documents"))
    return out.select(F.col("id").alias("doc_id"), "n_shingles", "component_id")


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays, with all its columns, whatever their
    names: the one with the component's id.  Rows that share an id are one
    document and stay or go together, equal ones too (exact dedup goes before);
    rows without an id stay where no row of their group has one.  Null and
    empty texts are linked with nothing and stay."""
    own, names = numbered(docs)
    groups = similarity_components(own, names["doc_id"], names["text"])
    keep = groups.where(F.col("id").eqNullSafe(F.col("component_id"))).select(F.col("id").alias("_id"))
    kept = own.join(keep.distinct(), F.col(names["doc_id"]).cast("long").eqNullSafe(F.col("_id")), "left_semi")
    return renamed_back(kept, names)
