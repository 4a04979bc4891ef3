"""Token ids in Re-Pair compressed files (operator 8).

Rows are range-partitioned and sorted by id; each task encodes its texts and
closes a shard whenever it has gathered enough ids.  A shard's ids are
compressed by Re-Pair: the frequent pairs of neighbouring symbols become
nonterminals, again and again, until no pair is frequent.

The file format is one Parquet row per shard (written by Spark, so a lost
executor's task is simply run again), all integers little-endian:

========== ===================================================================
part, seq  order of the shard: partition, then number within it
doc_ids    int64 per document (0 where ``no_id`` has a 1 byte)
no_id      uint8 per document
n_tokens   int64 per document, with its end id
rules      uint32 pairs: nonterminal ``first_rule + k`` is rules[2k], rules[2k+1]
lengths    uint32 per rule: ids in its expansion
symbols    uint32: the compressed sequence
anchors    int64: expansion offset of every 1024th symbol
n_ids      ids in the shard
========== ===================================================================

``anchors`` and ``lengths`` find the symbol that covers any id without
expanding what is before it (``decode_range``).
"""

from __future__ import annotations

import os
import re
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from outcomekit.llm.common import table, written

END_ID = 0
SHARD_IDS = 1 << 20          # a shard is closed once it has so many ids
LEAST_COUNT = 8              # a pair is frequent if it occurs so often, in a shard of any size
ANCHOR = 1024                # symbols between two anchors
FIRST_RULE = 1 << 20         # above every id of the vocabularies used
MEMO = 1_000_000             # distinct pieces in one generation of what a worker remembers

FORMAT = ("part int, seq int, doc_ids binary, no_id binary, n_tokens binary, rules binary, lengths binary, "
          "symbols binary, anchors binary, n_ids long")


# ---- Re-Pair ------------------------------------------------------------

def compress(ids: np.ndarray, least_count: int = LEAST_COUNT) -> tuple[np.ndarray, np.ndarray]:
    """Rules (k x 2) and the compressed symbols of ``ids``.

    Each round counts all pairs of neighbours, takes the frequent ones (most
    frequent first) whose symbols no pair taken before has on its other side,
    and replaces their occurrences from left to right; rounds go on until no
    pair is frequent.
    """
    seq = ids.astype(np.uint32)
    rules: list[np.ndarray] = []
    made = 0
    # places whose pair may be frequent.  A pair of symbols older than the last round is as frequent now only
    # if it was then, so after a round these are the places left over and those beside a new symbol
    spots = np.arange(max(0, len(seq) - 1))
    while len(spots) >= least_count:
        left, right = seq[spots], seq[spots + 1]
        # a pair is frequent only if its hash bucket is: count buckets, then the pairs in the full ones
        bucket = (left * np.uint32(0x9E3779B1) + right * np.uint32(0x85EBCA6B)) >> np.uint32(14)
        full = np.flatnonzero((np.bincount(bucket, minlength=1 << 18) >= least_count)[bucket])
        spots, left, right = spots[full], left[full], right[full]
        key = (left.astype(np.uint64) << np.uint64(32)) | right
        ordered = np.sort(key)
        starts = np.flatnonzero(np.concatenate((np.ones(min(1, len(key)), bool), ordered[1:] != ordered[:-1])))
        counts = np.diff(np.append(starts, len(ordered)))
        often = np.flatnonzero(counts >= least_count)
        if not len(often):
            break
        often = often[np.argsort(-counts[often], kind="stable")]
        lefts, rights, taken = set(), set(), []
        for pair in ordered[starts[often]].tolist():
            a, b = pair >> 32, pair & 0xFFFFFFFF
            # no symbol is a left and a right side: occurrences of different pairs can't overlap
            if a in rights or b in lefts or (a == b and a in lefts):
                continue
            lefts.add(a)
            rights.add(b)
            taken.append(pair)
        pairs = np.array(sorted(taken), np.uint64)
        symbols = int(max(left.max(), right.max())) + 1
        is_left, is_right = np.zeros(symbols, bool), np.zeros(symbols, bool)
        is_left[list(lefts)], is_right[list(rights)] = True, True
        maybe = np.flatnonzero(is_left[left] & is_right[right])
        which = np.minimum(np.searchsorted(pairs, key[maybe]), len(pairs) - 1)
        hit = pairs[which] == key[maybe]
        at, which = spots[maybe[hit]], which[hit]
        if any((p >> 32) == (p & 0xFFFFFFFF) for p in taken):
            # a pair of equal symbols overlaps itself: every other one of a run
            run = np.concatenate(([True], np.diff(at) != 1))
            first = np.maximum.accumulate(np.where(run, np.arange(len(at)), 0))
            keep = (np.arange(len(at)) - first) % 2 == 0
            at, which = at[keep], which[keep]
        seq[at] = (FIRST_RULE + made + which).astype(np.uint32)
        stay = np.ones(len(seq), bool)
        stay[at + 1] = False
        # the places of the next round, ascending, counted in the shorter sequence
        open_ = np.zeros(len(seq), bool)
        open_[spots] = True
        open_[at] = True
        open_[at[at > 0] - 1] = True      # one that goes away was the right side of another new symbol
        seq = seq[stay]
        spots = np.flatnonzero(open_[stay])
        spots = spots[spots < len(seq) - 1]
        rules.append(np.stack([pairs >> np.uint64(32), pairs & np.uint64(0xFFFFFFFF)], 1).astype(np.uint32))
        made += len(pairs)
    return (np.concatenate(rules) if rules else np.zeros((0, 2), np.uint32)), seq


def expansion_lengths(rules: np.ndarray) -> np.ndarray:
    """Ids in the expansion of each rule (a rule uses earlier rules only)."""
    out: list[int] = []
    for a, b in rules.tolist():
        out.append((out[a - FIRST_RULE] if a >= FIRST_RULE else 1) + (out[b - FIRST_RULE] if b >= FIRST_RULE else 1))
    return np.array(out, np.uint32)


def _expanded_rules(rules: np.ndarray) -> list[np.ndarray]:
    done: list[np.ndarray] = []
    side = lambda x: done[x - FIRST_RULE] if x >= FIRST_RULE else np.array([x], np.uint32)
    for a, b in rules.tolist():
        done.append(np.concatenate((side(a), side(b))))
    return done


def decompress(rules: np.ndarray, lengths: np.ndarray, symbols: np.ndarray) -> np.ndarray:
    """The ids that ``symbols`` stand for."""
    if not len(rules):
        return symbols.astype(np.uint32)
    # ids are read from the rules' expansions, and from the symbols themselves behind them
    source = np.concatenate([*_expanded_rules(rules), symbols.astype(np.uint32)])
    begin = np.cumsum(lengths.astype(np.int64)) - lengths
    is_rule = symbols >= FIRST_RULE
    rule = np.where(is_rule, symbols.astype(np.int64) - FIRST_RULE, 0)
    size = np.where(is_rule, lengths[rule], 1).astype(np.int64)
    first = np.where(is_rule, begin[rule], len(source) - len(symbols) + np.arange(len(symbols)))
    ends = np.cumsum(size)
    return source[np.repeat(first - (ends - size), size) + np.arange(ends[-1] if len(ends) else 0)]


def decode_range(rules: np.ndarray, lengths: np.ndarray, symbols: np.ndarray, anchors: np.ndarray,
                 lo: int, hi: int) -> np.ndarray:
    """Ids ``lo`` to ``hi`` (exclusive), expanding only the symbols between the
    anchors around them."""
    first = max(0, int(np.searchsorted(anchors, lo, side="right")) - 1)
    last = int(np.searchsorted(anchors, hi, side="left"))
    ids = decompress(rules, lengths, symbols[first * ANCHOR: last * ANCHOR])
    base = int(anchors[first]) if len(anchors) else 0
    return ids[lo - base: hi - base]


def symbol_anchors(lengths: np.ndarray, symbols: np.ndarray) -> np.ndarray:
    size = np.ones(len(symbols), np.int64)
    is_rule = symbols >= FIRST_RULE
    size[is_rule] = lengths[symbols[is_rule].astype(np.int64) - FIRST_RULE]
    return (np.cumsum(size) - size)[::ANCHOR]


# ---- encoding -----------------------------------------------------------

def _byte_letters() -> str:
    """The printable character that a byte-level vocabulary writes for each byte:
    printable Latin-1 stands for itself, the others follow from 256 on."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(0x100, 0x200))
    return "".join(chr(b) if b in plain else chr(next(spare)) for b in range(256))


# Fixed value: what a byte-level pre-tokenizer takes as a word, for ASCII without white space inside
ASCII_WORDS = re.compile(r"'(?:s|t|re|ve|m|ll|d)| ?[A-Za-z]+| ?[0-9]+| ?[^\sA-Za-z0-9]+", re.ASCII)


class PieceEncoder(dict):
    """Encodes whole texts with the tokenizers library.

    A byte-level BPE never merges over the boundary between a non-space and a
    following single space or line end, nor between a letter or digit and a
    following punctuation mark, so a text is the concatenation of its pieces
    cut there.  A piece's ids are asked from the library and remembered (this
    is the mapping piece -> ids; None: the piece has white space at an end and
    needs its neighbours).  Memory is kept in two generations: a full one
    becomes the older one, and what is asked for again moves on into the new
    one, so common pieces stay and the memory stays bounded.  A purely
    alphabetic piece is one word of the vocabulary's pre-tokenizer and goes to
    the library's BPE model directly, as do the words of other ASCII pieces; a
    text with a space beside other white space goes to the library whole.
    """

    MARKS = "!\"#$%&()*+,-./:;<=>?@[]^_`{|}~"

    def __init__(self, path: str):
        super().__init__()
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tok = Tokenizer.from_file(path)
        self.model, self.letters = self.tok.model, _byte_letters()
        # white space behind the first character and special tokens are left to the library
        special = [re.escape(t.content) for t in self.tok.get_added_tokens_decoder().values()]
        self.whole = re.compile("|".join([r"(?!^)\s", *special]))
        self.old: dict[str, bytes] = {}
        self.fixed = {"": b"", "\n": self._encode(["\n"])[0]}
        self.update(self.fixed)

    def _encode(self, texts: list[str]) -> list[bytes]:
        return [array("I", e.ids).tobytes() for e in self.tok.encode_batch_fast(texts, add_special_tokens=False)]

    def _word(self, word: str) -> bytes:
        # printable ASCII stands for itself, but for a space in front
        plain = word.isascii() and word[1:].isalpha()
        written_as = (self.letters[32] + word[1:] if word[0] == " " else word) if plain else word.encode().decode("latin-1").translate(self.letters)
        return array("I", [t.id for t in self.model.tokenize(written_as)]).tobytes()

    def __missing__(self, piece: str) -> bytes | None:
        ids = self.old.get(piece)
        if ids is None:
            if piece == " " or piece[-1].isspace() or piece[piece[0] == " "].isspace():
                return None
            if piece.isalpha() or (piece[0] == " " and piece[1:].isalpha()):
                ids = self._word(piece)
            elif self.whole.search(piece):
                ids = self._encode([piece])[0]
            elif len(core := piece.rstrip(self.MARKS)) < len(piece) and core[-1:].isalnum():
                ids = self[core] + self[piece[len(core):]]
            elif piece.isascii():
                words = ASCII_WORDS.findall(piece)
                ids = b"".join([self[w] for w in words]) if len(words) > 1 else self._word(piece)
            else:
                ids = self._encode([piece])[0]
        if len(self) >= MEMO:
            self.old = dict(self)
            self.clear()
            self.update(self.fixed)
        self[piece] = ids
        return ids

    def _pieces(self, text: str) -> list[str]:
        text = text.replace(" ", "\0 ")
        if "\n" in text and "\n\n" not in text:           # a run of line ends may be one word: left in its piece
            text = text.replace("\n", "\0\n\0")
        return text.split("\0")

    def batch(self, texts: list[str]) -> list[bytes]:
        """Little-endian uint32 ids of each text."""
        out: list[bytes | None] = []
        for t in texts:
            try:
                out.append(b"".join(map(self.__getitem__, self._pieces(t))) if "\0" not in t else None)
            except TypeError:                          # a piece that needs its neighbours
                out.append(None)
        rest = iter(self._encode([t for t, o in zip(texts, out) if o is None]))
        return [next(rest) if o is None else o for o in out]


_encoders: dict[str, PieceEncoder] = {}


def encoder(path: str) -> PieceEncoder:
    """The worker process's encoder: what it remembers serves later tasks too."""
    if path not in _encoders:
        _encoders[path] = PieceEncoder(path)
    return _encoders[path]


def _write_shards(path: str, shard_ids: int):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, enc, seq = TaskContext.get().partitionId(), encoder(path), 0
        end = np.uint32(END_ID).tobytes()
        ids: list[bytes] = []
        names: list[int | None] = []
        held = 0

        def close() -> pa.RecordBatch:
            tokens = np.frombuffer(b"".join(ids), np.uint32)
            rules, symbols = compress(tokens)
            lengths = expansion_lengths(rules)
            row = {"part": part, "seq": seq,
                   "doc_ids": np.array([0 if x is None else x for x in names], np.int64).tobytes(),
                   "no_id": np.array([x is None for x in names], np.uint8).tobytes(),
                   "n_tokens": np.array([len(x) // 4 for x in ids], np.int64).tobytes(),
                   "rules": rules.tobytes(), "lengths": lengths.tobytes(), "symbols": symbols.tobytes(),
                   "anchors": symbol_anchors(lengths, symbols).tobytes(), "n_ids": len(tokens)}
            kinds = [pa.int32(), pa.int32(), *[pa.binary()] * 7, pa.int64()]
            return pa.record_batch([pa.array([v], k) for v, k in zip(row.values(), kinds)], names=list(row))

        for batch in batches:
            texts, keys = batch.column(1), batch.column(0).to_pylist()
            for lo in range(0, batch.num_rows, 256):
                for key, coded in zip(keys[lo:lo + 256], enc.batch(texts.slice(lo, 256).to_pylist())):
                    ids.append(coded + end)
                    names.append(key)
                    held += len(coded) // 4 + 1
                    if held >= shard_ids:
                        yield close()
                        ids, names, held, seq = [], [], 0, seq + 1
        if ids:
            yield close()

    return write


def write_token_files(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text",
                      shard_ids: int = SHARD_IDS) -> DataFrame:
    """Encode, compress and write; returns the files as read back.

    Ascending id order (null ids first, repeated ids in text order); null texts
    count as empty and hold the end id alone.
    """
    src = docs.select(F.col(f"`{id_col}`").cast("long").alias("i"),
                      F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("t"))
    src = src.repartitionByRange(F.col("i").asc_nulls_first()).sortWithinPartitions(F.col("i").asc_nulls_first(), "t")
    return written(src.mapInArrow(_write_shards(tokenizer, shard_ids), FORMAT), "token-files")


def _read_shard(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            rules = np.frombuffer(row["rules"], np.uint32).reshape(-1, 2)
            ids = decompress(rules, np.frombuffer(row["lengths"], np.uint32), np.frombuffer(row["symbols"], np.uint32))
            n = np.frombuffer(row["n_tokens"], np.int64)
            ends = np.cumsum(n)
            raw = memoryview(np.ascontiguousarray(ids).astype("<u4")).cast("B")
            crc = [zlib.crc32(raw[4 * (e - k): 4 * e]) for e, k in zip(ends.tolist(), n.tolist())]
            doc = np.frombuffer(row["doc_ids"], np.int64)
            none = np.frombuffer(row["no_id"], np.uint8).astype(bool)
            yield pa.record_batch([pa.array(doc, mask=none), pa.array(row["_before"] + ends - n), pa.array(n),
                                   pa.array(np.array(crc, np.int64))],
                                  names=["doc_id", "start", "n_tokens", "ids_crc32"])


def read_token_files(files: DataFrame) -> DataFrame:
    """Per document of the files: ``doc_id, start, n_tokens, ids_crc32``, from
    the expanded ids.  Offsets are summed in two levels: shards within their
    partition, then one row per partition."""
    w = Window.partitionBy("part").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    inside = files.select("part", "seq", "n_ids").withColumn("_in", F.coalesce(F.sum("n_ids").over(w), F.lit(0)))
    parts = files.groupBy("part").agg(F.sum("n_ids").alias("_p"))
    wp = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select(F.col("part"), F.coalesce(F.sum("_p").over(wp), F.lit(0)).alias("_base"))
    start = inside.join(parts, "part").select("part", "seq", (F.col("_in") + F.col("_base")).alias("_before"))
    # a row a shard of ``SHARD_IDS`` ids: the files themselves are not shuffled for it
    return files.join(F.broadcast(start), ["part", "seq"]).mapInArrow(
        _read_shard, "doc_id long, start long, n_tokens long, ids_crc32 long")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    files = write_token_files(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    return read_token_files(files)
