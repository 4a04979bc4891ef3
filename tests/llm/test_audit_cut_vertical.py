"""Vertical scan, filter audit and concatenate-and-cut against brute force."""

import itertools
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import public_tokenizers
from outcomekit.llm import concat_cut, filter_audit, vertical_scan

PATH = public_tokenizers.path("byte_bpe_50k.json")
ODD = "label2 int, sequence_id string, part string, begin string, base string, a string, p string, rank string, mask int, n int, digest string"
ODD_VALUES = (1, "x", "y", "z", "b", "a", "p", "r", 2, 3, "d")


# ---- operator 11 --------------------------------------------------------

def mined(rows):
    """Brute force; rows are (id, label, vector)."""
    def fine(r):
        return None not in r and all(x is not None and math.isfinite(x) for x in r[2])
    rows = [(i, lab, [math.floor(256 * x) for x in v]) for i, lab, v in filter(fine, rows)]
    score = lambda u, v: sum(x * y for x, y in zip(u, v))
    out = []
    for i, lab, q in rows:
        if i % 100:
            continue
        scored = sorted((-score(q, v), j, other) for j, other, v in rows)
        positives = [(-s, j) for s, j, other in scored if other == lab and j != i][:5]
        for p, j in positives:
            window = [(-s, k) for s, k, other in scored if other != lab and 80 * p <= -100 * s <= 100 * p][:5]
            out += [(i, j, r + 1, k, p, s) for r, (s, k) in enumerate(window)]
    return sorted(out)


def table_of(spark, rows):
    data = [(*r, *ODD_VALUES) for r in rows]
    return spark.createDataFrame(data, f"vec_id long, label int, embedding array<float>, {ODD}")


def found(df, **how):
    out = vertical_scan.hard_negatives(df, F.col("vec_id") % 100 == 0, **how)
    return sorted(tuple(r) for r in out.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score").collect())


def f32(rng, n, scale=1.0):
    return [float(np.float32(rng.gauss(0, scale))) for _ in range(n)]


def test_vertical_scan_matches_brute_force(spark, monkeypatch):
    monkeypatch.setattr(vertical_scan, "ROUND_VALUES", 120)             # several rounds of anchors
    rng = random.Random(3)
    rows = [(i, rng.randrange(3), f32(rng, 24, 0.3)) for i in range(0, 900)]
    same = f32(rng, 24, 0.3)
    rows += [(900 + i, i % 2, same) for i in range(300)]               # one vector of 300 rows, ties by id
    rows += [(100, 1, f32(rng, 24)), (100, 1, f32(rng, 24)), (205, 1, rows[205][2])]      # repeated ids, a repeated row
    assert found(table_of(spark, rows).repartition(3)) == mined(rows)


def test_vertical_scan_odd_rows(spark):
    rng = random.Random(4)
    rows = [(i, i % 2, f32(rng, 6)) for i in range(0, 120)]
    rows += [(None, 0, f32(rng, 6)), (300, None, f32(rng, 6)), (400, 0, None), (500, 1, [1.0, None, 0.0]), (600, 1, [1.0, math.nan]),
             (700, 0, [math.inf, 0.0]), (800, 0, []), (901, 1, [0.5, 0.25]), (1000, 7, f32(rng, 6)), (1100, 0, [3e4] * 6), (1101, 0, [2e4] * 6)]
    assert found(table_of(spark, rows)) == mined(rows)
    assert found(table_of(spark, rows[:1])) == [] and found(table_of(spark, [])) == []


def test_vertical_scan_large_components(spark):
    """Sums beyond doubles' whole numbers stay exact."""
    rng = random.Random(5)
    rows = [(i, i % 2, f32(rng, 4, 1e5)) for i in range(0, 300)]
    rows += [(1000 + i, i % 2, [float(np.float32(3e6 + i)), 1e6, 0.001, 2.0]) for i in range(0, 101)]
    assert found(table_of(spark, rows)) == mined(rows)
    with pytest.raises(Exception, match="beyond 64 bits"):
        found(table_of(spark, [(0, 1, [1e20]), (1, 1, [1.0])]))


def test_scan_shrinks_and_keeps_all_that_counts():
    rng = np.random.default_rng(6)
    columns = rng.integers(-200, 200, (32, 500)).astype(np.int16)
    block = vertical_scan.Block(500, 32, np.arange(500).tobytes(), np.zeros(500, np.int64).tobytes(), columns.tobytes(), columns.dtype.str)
    q = rng.integers(-200, 200, 32)
    q[8:] //= 50
    truth, seen = q @ columns.astype(np.int64), []

    def stay(lower, upper):
        seen.append(len(lower))
        return upper >= np.sort(lower)[-5]

    rows, scores = vertical_scan.scan(block, q, np.arange(500), stay)
    assert seen[0] == 500 and seen[1] < 250
    assert (truth[rows] == scores).all() and set(np.argsort(-truth)[:5]) <= set(rows)


# ---- operator 12 --------------------------------------------------------

def audited(docs, labels):
    """Brute force: every order applied to every document."""
    good, toxic = ({r[0] for r in labels if r[k] == 1} - {None} for k in (1, 2))
    fails = []
    for i, source, text in docs:
        t = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", t)
        earlier = i is not None and any((u or "") == t and j is not None and j < i for j, _, u in docs)
        f = {"A": len(words) < 200, "B": 100 * len(set(words)) < 50 * len(words),
             "C": 100 * len(re.findall("[A-Z]", t)) > 2 * len(t), "D": bool(re.search(r"[#$%&*|]", t)), "E": earlier}
        fails.append((source or "", i, {k for k, v in f.items() if v}))
    out = []
    for part in {p for p, _, _ in fails}:
        mine, rows, value = [(i, f) for p, i, f in fails if p == part], [], Counter()
        for order in itertools.permutations("ABCDE"):
            left = mine
            for step, x in enumerate(order, 1):
                gone = [(i, f) for i, f in left if x in f]
                left = [(i, f) for i, f in left if x not in f]
                value[x] += len(gone)
                rows.append((x, (part, "".join(order), step, len(left), len(gone), sum(x in f for _, f in mine) - len(gone),
                                 sum(f == {x} for _, f in mine), sum(i in good for i, _ in gone), sum(i in toxic for i, _ in gone))))
        out += [(*r, value[x]) for x, r in rows]
    return sorted(out)


def run_audit(spark, docs, labels):
    d = spark.createDataFrame([(*r, *ODD_VALUES) for r in docs], f"doc_id long, source string, text string, {ODD}")
    m = filter_audit.filter_masks(d, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    return sorted(tuple(r) for r in filter_audit.interactions(m).collect())


def test_audit_matches_brute_force(spark, monkeypatch):
    monkeypatch.setattr(filter_audit, "SPLIT_BYTES", 64)
    rng = random.Random(7)
    word = lambda: rng.choice(["a", "b", "C", "dé", "x#", "KK", "中"]) + str(rng.randrange(60))       # noqa: E731
    texts = [" ".join(word() if rng.random() < spread else "the" for _ in range(n)) + rng.choice(["", "\t", "\n|", " &", "  z"])
             for n in (0, 3, 199, 200, 240) for spread in (0.1, 0.5, 0.9, 1) for _ in range(4)]
    docs = [(i, rng.choice(["s1", "s2", "", None]), rng.choice(texts)) for i in range(200)]
    docs += [(300 + i, rng.choice(["hot", "s1"]), "one text of many rows") for i in range(100)]
    docs += [(5, "s1", docs[5][2]), docs[7], docs[7], (None, "s2", docs[9][2]), (None, "s2", docs[9][2]), (400, None, None), (401, "s1", "")]
    labels = [(i, rng.choice([0, 1, None]), rng.choice([0, 0, 1, None])) for i in range(0, 400, 2)] + [(4, 1, 1), (4, 0, 0), (None, 1, 1)]
    assert run_audit(spark, docs, labels) == audited(docs, labels)


def test_audit_of_empty_tables(spark):
    assert run_audit(spark, [], []) == []
    assert run_audit(spark, [(1, "s", "x")], []) == audited([(1, "s", "x")], [])


def test_removal_intervals_cover_each_order_once():
    orders = list(itertools.permutations(range(5)))
    for mask in range(32):
        want = {(next(k for k, f in enumerate(o) if mask >> f & 1), r) for r, o in enumerate(orders) if mask}
        got = [(step, r) for step, lo, hi in filter_audit.removal_intervals(mask) for r in range(lo, hi)]
        assert len(got) == len(set(got)) and set(got) == want


# ---- operator 13 --------------------------------------------------------

def checked_pieces(spark, docs, length):
    """Run the operator and hold every piece against the tokenizers library."""
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(PATH)
    df = spark.createDataFrame([(*r, *ODD_VALUES) for r in docs], f"doc_id long, text string, {ODD}").repartition(4)
    seqs = concat_cut.concatenate_and_cut(df, PATH, length=length)
    rows = seqs.collect()
    whole = sum(len(tok.encode(t or "", add_special_tokens=False).ids) + 1 for _, t in docs)
    assert sorted(r.sequence_id for r in rows) == list(range(-(-whole // length)))
    for r in rows:
        last = r.sequence_id == len(rows) - 1
        assert r.length == (whole - length * (len(rows) - 1) if last else length) == len(r.ids) // 4 == sum(r.lengths)
    ids = np.concatenate([np.frombuffer(bytes(r.ids), "<u4") for r in sorted(rows, key=lambda r: r.sequence_id)] or [np.zeros(0)])
    at, texts = 0, []
    for r in sorted(concat_cut.pieces(seqs).collect(), key=lambda r: (r.sequence_id, r.offset)):
        assert at == r.sequence_id * length + r.offset
        assert zlib.crc32(ids[at: at + r.length].astype("<u4").tobytes()) == r.ids_crc32
        if r.start == 0:
            texts.append([r.doc_id, [], r.doc_tokens])
        assert texts[-1][0] == r.doc_id and len(texts[-1][1]) == r.start and texts[-1][2] == r.doc_tokens
        texts[-1][1].extend(ids[at: at + r.length].tolist())
        at += r.length
    assert at == whole
    key = lambda x: (x[0] is None, x[0] or 0, x[1])      # noqa: E731
    want = [(i, tok.encode(t or "", add_special_tokens=False).ids + [0]) for i, t in docs]
    assert sorted(((i, x) for i, x, _ in texts), key=key) == sorted(want, key=key)
    assert all(len(x) == n for _, x, n in texts)


def test_concatenate_and_cut_keeps_every_id(spark):
    rng = random.Random(8)
    text = lambda n: "".join(rng.choice(["the ", "Wörter, ", "x\n", "\n", "12 ", "中文", "!? ", "\t"]) for _ in range(n))
    docs = [(i, text(rng.choice([0, 1, 5, 40, 200]))) for i in range(120)]
    docs += [(None, "no id"), (None, "no id"), (3, docs[3][1]), (500, None), (501, ""), (502, text(6000))]
    checked_pieces(spark, docs, 64)
    checked_pieces(spark, docs, 1)


def test_concatenate_and_cut_of_few_rows(spark):
    checked_pieces(spark, [], 1024)
    checked_pieces(spark, [(1, None)], 1024)
    with pytest.raises(ValueError):
        checked_pieces(spark, [], 0)


def test_cutter_closes_records_at_gaps_and_borders():
    cutter = concat_cut._Cutter(4)
    cutter.add(1, 2, np.arange(5, dtype="<u4"))         # places 2 to 6: 2 ids of sequence 0, 3 of 1
    cutter.add(2, 7, np.arange(1, dtype="<u4"))         # place 7 fills sequence 1
    cutter.add(3, 20, np.arange(6, dtype="<u4"))        # after a gap
    cutter.close()
    assert [r[:3] for r in cutter.rows] == [(0, 2, 2), (1, 0, 4), (5, 0, 4), (6, 0, 2)]
    assert cutter.rows[1][4:] == ([1, 2], [2, 0], [3, 1], [5, 1])
