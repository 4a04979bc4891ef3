"""Parity join, winnowing and token files against brute force."""

import collections
import hashlib
import random
import zlib

import numpy as np
import pytest

from outcomekit.llm import parity_join, repair_tokens as rp, winnowing
from outcomekit.llm.components import components


def docs_of(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string")


# ---- components and parity join ---------------------------------------------

def smallest_reachable(ids, links):
    up = {i: i for i in ids}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        up[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


def test_components_of_chains_stars_and_rings(spark):
    links = [(i, i + 1) for i in range(100, 160)] + [(5, k) for k in range(300, 340)] + [(340, 400), (400, 5)]
    links += [(900, 901), (901, 902), (902, 900), (10, 10)]
    random.Random(1).shuffle(links)
    got = {r.id: r.root for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    want = smallest_reachable({x for e in links for x in e}, links)
    assert got == {k: v for k, v in want.items() if k != 10}


def shingle_set(text):
    w = (text or "").encode().lower().split()
    return frozenset(tuple(w[k:k + 5]) for k in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def check_join(spark, rows):
    sets = {i: shingle_set(t) for i, t in rows}
    ids = sorted(sets)
    links = [(a, b) for k, a in enumerate(ids) for b in ids[k + 1:] if sets[a]
             and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    want = smallest_reachable(ids, links)
    out = parity_join.similarity_components(docs_of(spark, rows)).collect()
    assert len(out) == len(rows)
    assert {r.id: (r.n_shingles, r.component_id) for r in out} == {i: (len(sets[i]), want[i]) for i in ids}
    return links


def test_parity_join_matches_brute_force(spark):
    rng = random.Random(23)
    word = lambda: rng.choice("abcdefghij") + str(rng.randrange(3000))                        # noqa: E731
    shared = [word() for _ in range(60)]
    rows, n = [], 0
    for size in (1, 4, 5, 9, 30, 66, 67, 68, 80, 84, 130, 160, 330):
        for _ in range(3):
            base = [word() for _ in range(size)]
            for copy in range(4):
                t = list(base)
                for _ in range(rng.choice([0, 1, 1, 2, max(1, size // 60), max(1, size // 30)])):
                    t[rng.randrange(size)] = word()
                if rng.random() < 0.3:
                    t = t + [word() for _ in range(size // 8)]
                if rng.random() < 0.2:
                    t = t[:size // 2] + shared + t[size // 2:]
                rows.append((n, rng.choice([" ", "\n", "  \t"]).join(t)))
                n += 1
    rows += [(n, None), (n + 1, ""), (n + 2, " \n "), (n + 3, "One two"), (n + 4, "one  TWO"), (n + 5, "É b"), (n + 6, "é b")]
    assert len(check_join(spark, rows)) > 20


def test_parity_join_of_large_groups_of_variants(spark):
    """Variants of one text that are alike but not alike enough, among them some
    that are; sets of 90, 1,500 and 6,000 shingles."""
    rng = random.Random(29)
    rows, want = [], 0
    for size, count in ((90, 60), (1500, 14), (6000, 6)):
        base = [f"b{rng.randrange(10 ** 9)}" for _ in range(size)]
        for _ in range(count):
            t = list(base)
            for at in rng.sample(range(size), max(3, size // 38)):      # each change takes five shingles: about 0.76 to one another
                t[at] = f"v{rng.randrange(10 ** 9)}"
            rows.append((len(rows), " ".join(t)))
            if rng.random() < 0.3:
                t[rng.randrange(size)] = "near"
                rows.append((len(rows), " ".join(t)))
                want += 1
    assert len(check_join(spark, rows)) >= want > 10


def test_sketches_bound_the_difference_at_any_width():
    rng = np.random.default_rng(31)
    for n, m in ((50, 60), (700, 900), (1500, 6000), (6000, 6100)):
        both = rng.integers(0, 1 << 63, n + m, dtype=np.uint64)
        a, b = both[:n], both[n // 3:n // 3 + m]
        true = len(np.setxor1d(a, b))
        x, y = (np.frombuffer(parity_join.parity(s), np.uint64) for s in (a, b))
        assert 64 * len(x) >= max(parity_join.SKETCH, 4 * n)
        for count in (min(len(x), len(y)), parity_join.FOLDED):
            assert np.bitwise_count(parity_join.folded(x, count) ^ parity_join.folded(y, count)).sum() <= true


def test_parity_join_at_exactly_four_fifths(spark):
    a = [f"w{k}" for k in range(104)]                       # 100 shingles
    b, c = a[:84] + ["x"] * 0, a[:83]                       # 80 and 79 of them
    links = check_join(spark, [(1, " ".join(a)), (2, " ".join(b)), (3, " ".join(c))])
    assert (1, 2) in links and (1, 3) not in links


def test_parity_join_nulls_repeats_and_empty(spark):
    rows = [(4, "a b c d e f"), (4, "a b c d e f"), (None, "A b c d e f"), (2, "a b c d e f"), (None, "alone here"), (9, None)]
    got = collections.Counter((r.id, r.component_id) for r in parity_join.similarity_components(docs_of(spark, rows)).collect())
    assert got == collections.Counter({(4, 2): 2, (None, 2): 1, (2, 2): 1, (None, None): 1, (9, 9): 1})
    assert parity_join.similarity_components(docs_of(spark, [])).count() == 0


def test_prefixes_of_similar_sets_share_a_key():
    rng = np.random.default_rng(2)
    for n in (1, 3, 8, 63, 64, 70, 79, 80, 127, 130, 500, 1100):
        for _ in range(20):
            a = np.unique(rng.integers(0, 1 << 63, n).astype(np.uint64) * np.uint64(2))
            drop = int(rng.integers(0, n // 5 + 1))
            b = rng.permutation(a)[drop:]
            spare = int((len(b) - 0.8 * len(a)) / 0.8)       # additions that keep the similarity
            b = np.unique(np.concatenate((b, rng.integers(0, 1 << 62, max(0, spare)).astype(np.uint64) * np.uint64(2) + np.uint64(1))))
            common = len(np.intersect1d(a, b))
            if 100 * common >= 80 * (len(a) + len(b) - common) and common:
                hot = np.sort(rng.permutation(a)[: n // 3])
                assert np.intersect1d(parity_join.join_keys(a, hot), parity_join.join_keys(b, hot)).size


# ---- winnowing ----------------------------------------------------------------

def test_next_text_and_edit(spark):
    rows = [(i * 7 % 101, "äöü😀" * (i % 5) + f"word{i} of text {i * i}") for i in range(101)]
    rows[5], rows[50] = (rows[5][0], None), (rows[50][0], "")
    out = {r.doc_id: r for r in winnowing.fingerprints(docs_of(spark, rows).repartition(5), buckets=7).collect()}
    order = sorted(rows, key=lambda r: -r[0])
    prints = {}
    for k, (i, t) in enumerate(order):
        t, nxt = t or "", order[(k + 1) % len(order)][1] or ""
        half = len(t) // 2
        e = t[:len(t) - half] + nxt[:half]
        assert out[i].n_chars == len(t) and out[i].edited_sha256 == hashlib.sha256(e.encode()).hexdigest()
        assert prints.setdefault(t, out[i].fingerprint) == out[i].fingerprint
        assert 0 <= out[i].near_edited <= 1 and 0 <= out[i].near_next <= 1
        if e == t:
            assert out[i].near_edited == 1.0


def test_marks_are_window_minima_and_shared_runs_share_a_mark(spark):
    rng = random.Random(4)
    make = lambda n: " ".join("".join(rng.choice("abcdef") for _ in range(4)) for _ in range(n))
    run = make(winnowing.W + winnowing.K - 1)
    texts = [make(40) + " " + run + " " + make(20), make(5) + " " + run + " " + make(60), make(1), make(2), "", make(300)]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, t string")
    rows = winnowing.with_marks(df, "t", "f").orderBy("doc_id").collect()
    for r in rows:
        g, f = list(r.f_g), list(r.f)
        if len(g) >= winnowing.W:
            windows = [min(g[k:k + winnowing.W]) for k in range(len(g) - winnowing.W + 1)]
            assert f == list(dict.fromkeys(windows))
        else:
            assert f == ([min(g)] if g else [])
    h = [{v >> 32 for v in r.f} for r in rows]
    assert h[0] & h[1] and not h[0] & h[5]


def test_winnowing_edges(spark):
    assert winnowing.fingerprints(docs_of(spark, [])).count() == 0
    one = winnowing.fingerprints(docs_of(spark, [(3, "abc def")])).collect()
    assert one[0].near_next == 1.0 and len(one) == 1
    odd = winnowing.fingerprints(docs_of(spark, [(None, "x y z"), (5, "same"), (5, "same"), (1, None)])).collect()
    assert sorted(r.n_chars for r in odd) == [0, 4, 4, 5]


# ---- token files --------------------------------------------------------------

def test_repair_round_trip_and_random_access():
    rng = np.random.default_rng(6)
    for k in range(60):
        ids = rng.choice([3, 4, 5, 900, 50256], int(rng.integers(0, 4000))).astype(np.uint32)
        if k % 3 == 0:
            ids = np.repeat(ids[:300], 7)
        rules, symbols = rp.compress(ids)
        lengths = rp.expansion_lengths(rules)
        assert (rp.decompress(rules, lengths, symbols) == ids).all()
        anchors = rp.symbol_anchors(lengths, symbols)
        for _ in range(5):
            lo, hi = sorted(rng.integers(0, len(ids) + 1, 2).tolist())
            assert (rp.decode_range(rules, lengths, symbols, anchors, lo, hi) == ids[lo:hi]).all()
        if len(ids) > 500:
            assert len(symbols) < len(ids)


ODD = ["", " ", "a  b", "a   b c", "x \n y", "\n\n a", " a b ", "it's, don't. we're", "ä ö\tü  ", "a  b c",
       "<|endoftext|> x<|endoftext|>", "a\0b c", "1,000.5 x.,;y", "word.\nNext word", "日本 語。 テ", "a_b. c_", "é. x"]


@pytest.fixture(scope="module")
def tokenizer():
    tokens = pytest.importorskip("public_tokenizers")
    return tokens.path("byte_bpe_50k.json")


def test_piece_encoder_equals_the_library(tokenizer):
    from tokenizers import Tokenizer
    enc, lib = rp.PieceEncoder(tokenizer), Tokenizer.from_file(tokenizer)
    rng = random.Random(8)
    texts = ODD + ["".join(rng.choice(["a", "Z", " ", "  ", "\n", ".", ",", "'s", "é", "9", "-", "\t"]) for _ in range(30)) for _ in range(400)]
    for _ in range(2):
        got = enc.batch(texts)
        for t, g in zip(texts, got):
            assert np.frombuffer(g, np.uint32).tolist() == lib.encode(t, add_special_tokens=False).ids, repr(t)


def test_token_files_round_trip(spark, tokenizer):
    from tokenizers import Tokenizer
    lib = Tokenizer.from_file(tokenizer)
    rows = [(i * 13 % 200, f"text {i} " * (i % 30)) for i in range(200)] + [(900, None), (901, ""), (902, "long " * 9000)]
    rows += [(k + 1000, t) for k, t in enumerate(ODD)]
    files = rp.write_token_files(docs_of(spark, rows).repartition(6), tokenizer, shard_ids=1500)
    got = {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in rp.read_token_files(files).collect()}
    start = 0
    for i, t in sorted(rows):
        ids = np.array(lib.encode(t or "", add_special_tokens=False).ids + [0], "<u4")
        assert got[i] == (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)
    assert files.count() > 3


def test_token_files_of_nothing_and_null_ids(spark, tokenizer):
    assert rp.read_token_files(rp.write_token_files(docs_of(spark, []), tokenizer)).count() == 0
    out = rp.read_token_files(rp.write_token_files(docs_of(spark, [(None, "a"), (2, "b b"), (2, "b b")]), tokenizer)).collect()
    assert sorted((r.doc_id is None, r.start) for r in out) == [(False, 2), (False, 5), (True, 0)]
