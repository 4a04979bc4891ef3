"""Content sort, mixing and packing against brute force."""

import collections
import hashlib
import heapq
import random
from fractions import Fraction

import numpy as np
import pytest

from outcomekit.llm import mixing, packing
from outcomekit.llm.content_sort import content_sort_dedup

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def ascii_lower(s):
    return (s or "").translate(str.maketrans(UPPER, UPPER.lower()))


def docs_of(spark, rows, columns="doc_id long, text string, source string"):
    return spark.createDataFrame(rows, columns)


# ---- content sort ---------------------------------------------------------

def brute_dedup(rows, largest):
    groups = collections.defaultdict(list)
    for i, t in rows:
        groups[ascii_lower(t)].append(i)
    out = {}
    for t, ids in groups.items():
        known = [i for i in ids if i is not None]
        out[t] = ((max if largest else min)(known) if known else None, len(ids))
    return out


@pytest.mark.parametrize("keep", ["largest", "smallest"])
def test_content_sort_matches_brute_force(spark, keep):
    rng = random.Random(3)
    texts = ["", None, "A b", "a B", "É", "é", "x" * 50_000, "x" * 49_999 + "y", "same"] + [f"t {k}" for k in range(40)]
    rows = [(i, rng.choice(texts)) for i in range(300)] + [(1000 + i, "same") for i in range(400)]
    rows += [(7, "Same"), (7, "Same"), (None, "same"), (None, "null id"), (None, "Null id")]
    rng.shuffle(rows)
    df = docs_of(spark, rows, "doc_id long, text string").repartition(6)
    out = content_sort_dedup(df, keep=keep, columns=["doc_id", "text"]).collect()
    want = brute_dedup(rows, keep == "largest")
    assert len(out) == len(rows)
    kept = collections.Counter()
    for r in out:
        t = ascii_lower(r.text)
        assert (r.keep_id, r.group_size) == want[t]
        assert r.text_sha256 == hashlib.sha256(t.encode()).hexdigest()
        if r.kept:
            kept[t] += 1
            assert r.doc_id == r.keep_id
    assert set(kept.values()) == {1} and set(kept) == set(want)


def test_content_sort_empty_table_and_clashing_columns(spark):
    empty = docs_of(spark, [], "doc_id long, text string")
    assert content_sort_dedup(empty).count() == 0
    df = docs_of(spark, [(1, "a", 5, 6), (2, "A", 7, 8)], "doc_id long, text string, _size int, _keep int")
    out = {r.doc_id: r for r in content_sort_dedup(df, keep="largest", columns=df.columns).collect()}
    assert out[1]._size == 5 and out[2]._keep == 8 and out[2].kept and not out[1].kept and out[1].group_size == 2


# ---- mixing -----------------------------------------------------------------

def brute_targets(sizes):
    names = sorted(s for s in sizes if s is not None) + ([None] if None in sizes else [])
    w = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    free, left = set(names), Fraction(sum(sizes.values()))
    out = {}
    while free:
        total = sum(w[s] for s in free)
        over = [s for s in free if left * w[s] / total > 3 * sizes[s]]
        if not over:
            out.update({s: left * w[s] / total for s in free})
            break
        for s in over:
            out[s] = Fraction(3 * sizes[s])
        free -= set(over)
        left -= sum(3 * sizes[s] for s in over)
    return out


def test_targets_stop_at_three_times_the_source():
    rng = random.Random(5)
    for _ in range(100):
        sizes = {f"s{k}": rng.choice([0, 1, 10, 1000, 50]) for k in range(rng.randint(1, 9))}
        if rng.random() < 0.5:
            sizes[None] = rng.randint(0, 100)
        got = mixing.targets(sizes)
        assert got == brute_targets(sizes)
        assert sum(got.values()) == sum(sizes.values())


def test_sainte_lague_takes_the_highest_quotients():
    rng = random.Random(7)
    for _ in range(200):
        want = [rng.choice([0, 1, 2.5, 7, 100, 33.3]) for _ in range(rng.randint(1, 8))]
        seats = rng.randint(0, 40) if sum(want) else 0
        heap = [(-w, i, 0) for i, w in enumerate(want) if w > 0]
        heapq.heapify(heap)
        got = [0] * len(want)
        for _ in range(seats):
            _, i, k = heapq.heappop(heap)
            got[i] += 1
            heapq.heappush(heap, (-want[i] / (2 * k + 3), i, k + 1))
        assert mixing.sainte_lague(want, seats) == got


def test_mix_reaches_targets_and_reruns_agree(spark):
    rng = random.Random(11)
    rows = [(i, " ".join("w" for _ in range(rng.choice([0, 1, 5, 300]))), rng.choice(["hot"] * 6 + ["a", "b", None]))
            for i in range(600)] + [(600, None, "a"), (601, " \t\n ", "b"), (5, "again w", "b"), (None, "no id", "a")]
    df = docs_of(spark, rows)
    out = mixing.mix(df, rows_per_shard=100, columns=["doc_id", "source"]).collect()
    assert len(out) == len(rows)
    sizes = collections.Counter()
    for _, t, s in rows:
        sizes[s] += len((t or "").split())
    want, taken = brute_targets(dict(sizes)), collections.Counter()
    for r in out:
        assert r.taken <= 3 * r.size and r.source_size == sizes[r.source]
        assert r.target == pytest.approx(float(want[r.source]))
        assert r.taken == r.passes * r.size + sum(x["last"] - x["first"] + 1 for x in r.extra)
        taken[r.source] += r.taken
    shards = 7
    for s, t in want.items():
        assert abs(taken[s] - float(t)) <= mixing.BLOCK_WORDS * (shards + 1)
    again = mixing.mix(df.repartition(5), rows_per_shard=100).collect()
    assert sorted((r.doc_id or -1, r.taken) for r in again) == sorted((r.doc_id or -1, r.taken) for r in out)


def test_mix_of_nothing(spark):
    assert mixing.mix(docs_of(spark, [])).count() == 0
    out = mixing.mix(docs_of(spark, [(1, None, None), (2, "", "a")])).collect()
    assert [(r.size, r.taken) for r in out] == [(0, 0), (0, 0)]


def test_mix_stage_emits_the_words_taken(spark):
    rows = [(i, " ".join(f"w{i}.{k}" for k in range(1 + i % 40)), f"s{i % 4}", 0) for i in range(80)]
    df = docs_of(spark, rows, "doc_id long, text string, source string, n_chars long")
    taken = {r.doc_id: r.taken for r in mixing.mix(df).collect()}
    words = collections.Counter()
    for r in mixing.stage(spark, df, "").collect():
        assert r.n_chars == len(r.text) and set(r.text.split()) <= set(rows[r.doc_id][1].split())
        words[r.doc_id] += len(r.text.split())
    assert words == collections.Counter({k: v for k, v in taken.items() if v})


# ---- packing ----------------------------------------------------------------

def naive_best_fit(sizes, sources, clusters, capacity):
    bit = lambda h: int(h) % 256                                                              # noqa: E731
    bins, out = [], []
    for s, a, c in zip(sizes, sources, clusters):
        fit = [(b["left"], k) for k, b in enumerate(bins)
               if b["left"] >= s and bit(a) not in b["src"] and bit(c) not in b["clu"]]
        if fit:
            k = min(fit)[1]
        else:
            bins.append({"left": capacity, "src": set(), "clu": set()})
            k = len(bins) - 1
        out.append((k, capacity - bins[k]["left"]))
        bins[k]["left"] -= s
        bins[k]["src"].add(bit(a))
        bins[k]["clu"].add(bit(c))
    return out


def test_best_fit_picks_the_tightest_compatible_bin():
    rng = np.random.default_rng(13)
    for _ in range(30):
        n = int(rng.integers(0, 150))
        sizes = np.sort(rng.integers(0, 60, n))[::-1]
        sources, clusters = rng.integers(0, 6, n).astype(np.uint64), rng.integers(0, 40, n).astype(np.uint64)
        number, start = packing.best_fit(sizes, sources, clusters, 64)
        assert list(zip(number.tolist(), start.tolist())) == naive_best_fit(sizes, sources, clusters, 64)


def test_pack_keeps_every_word_and_both_constraints(spark):
    rng = random.Random(17)
    rows = [(i, " ".join(rng.choice(["x", "y"]) for _ in range(rng.choice([0, 3, 40, 150, 1000]))),
             rng.choice(["hot", "hot", "a", None])) for i in range(300)]
    rows += [(500 + i, "copy copy", f"s{i}") for i in range(100)] + [(900, None, "a"), (None, "no id", "b"), (3, "twice", "c")]
    out = packing.pack(docs_of(spark, rows), capacity=128, rows_per_shard=120).collect()
    words = collections.Counter()
    bins = collections.defaultdict(list)
    for r in out:
        words[r.doc_id] += r.words
        bins[r.shard, r.bin].append(r)
    want = collections.Counter()
    for i, t, _ in rows:
        want[i] += len((t or "").split())
    assert words == want
    source = {i: s for i, _, s in rows}
    for group in bins.values():
        spans = sorted((r.bin_start, r.bin_start + r.words) for r in group)
        assert spans[-1][1] <= 128 and all(a[1] <= b[0] for a, b in zip(spans, spans[1:]))
        known = [r.doc_id for r in group if r.doc_id not in (None, 3)]
        assert len({source[i] for i in known}) == len(known)
        assert sum(500 <= i < 600 for i in known) <= 1


def test_pack_of_nothing(spark):
    assert packing.pack(docs_of(spark, [])).count() == 0
