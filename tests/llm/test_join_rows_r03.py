"""The last round of the similarity join: a pair is compared under its first common key."""

import itertools

from pyspark.sql import functions as F

from outcomekit.llm import common, parity_join as pj


def _met(rows):
    a, b = pj._side(rows, "a"), pj._side(rows, "b")
    met = a.join(b, "key").where((F.col("a_root") < F.col("b_root")) & ~F.arrays_overlap("a_before", "b_before"))
    return [(r.a_id, r.b_id, r.key) for r in met.select("a_id", "b_id", "key").collect()]


def test_each_pair_meets_under_its_first_common_key_of_a_band(spark):
    # even keys: one band, odd keys: the other one; 4 has a key of its own in front
    sets = {1: [10, 20, 30, 40, 11, 21], 2: [10, 20, 30, 40, 11, 21], 3: [20, 40, 60, 21], 4: [5_000, 20, 30, 60]}
    rows = []
    for i, keys in sets.items():
        for band in (0, 1):
            rows += [(k, i, 100, -1 - p, i, 4) for p, k in enumerate(k for k in keys if k % 2 == band)]
    open_ = spark.createDataFrame(rows, "key long, id long, n int, p int, root long, c int")
    want = []
    for a, b in itertools.combinations(sets, 2):
        for band in (0, 1):
            common_keys = [k for k in sets[a] if k in sets[b] and k % 2 == band]
            want += [(a, b, k) for k in common_keys[:1]]
    assert sorted(_met(pj._with_earlier(open_))) == sorted(want)


def test_pairs_far_down_the_order_still_meet(spark):
    # no common key among the first BEFORE of either: each one compares the pair
    n = pj.BEFORE + 2
    rows = [(1_000 * i + 2 * p, i, 100, p, i, 2) for i in (1, 2) for p in range(n)]
    rows += [(9_000 + 2 * p, i, 100, n + p, i, 2) for i in (1, 2) for p in range(3)]
    open_ = spark.createDataFrame(rows, "key long, id long, n int, p int, root long, c int")
    assert {(a, b) for a, b, _ in _met(pj._with_earlier(open_))} == {(1, 2)}


def test_keys_of_neighbouring_bands_differ_in_their_lowest_bit():
    import numpy as np
    s = np.sort(np.random.default_rng(1).integers(0, 1 << 62, 140).astype(np.uint64))
    keys, places = pj.join_keys(s, np.zeros(0, np.uint64))
    assert len(pj.bands(140)) == 2
    take = len(s) // 4 + 1
    assert (places[[0, take]] == -1).all()
    assert set((keys[:take] & np.uint64(1)).tolist()) != set((keys[take:] & np.uint64(1)).tolist())


def test_a_write_leaves_no_shuffle_files_and_no_setting(spark):
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    own, seen = spark.conf.get(name), []
    df = spark.range(1000).repartition("id")
    write = type(df.write).parquet

    def spy(self, path, *a, **k):
        seen.append(spark.conf.get(name))
        return write(self, path, *a, **k)
    type(df.write).parquet = spy
    try:
        out = common.written(df, "t")
    finally:
        type(df.write).parquet = write
    assert seen == ["true"] and spark.conf.get(name) == own and out.count() == 1000
