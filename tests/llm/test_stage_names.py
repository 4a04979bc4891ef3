"""Stages under clashing column names, repeated rows and reordered input."""

import collections

import pytest

from outcomekit.llm import content_sort, mixing, packing, parity_join, toxicity as tox
from outcomekit.llm.common import table

SF = "/root/testdata/sf0.001"
# names that the operators use themselves, in other cases too
CLASHING = ["score", "kept", "keep_id", "text_sha256", "size", "taken", "passes", "extra", "Target", "_id", "_text",
            "source_size", "c0", "id", "_source", "shard", "n", "component_id", "col"]


@pytest.fixture(scope="module")
def clashing(spark):
    docs = table(spark, SF, "documents")
    return docs.select(*docs.columns, *[docs.doc_id.alias(c) for c in CLASHING])


@pytest.mark.parametrize("stage", [tox.stage, content_sort.stage, parity_join.stage, mixing.stage])
def test_stage_keeps_clashing_columns(spark, clashing, stage):
    out = stage(spark, clashing, SF)
    assert out.columns == clashing.columns
    rows = out.collect()
    plain = stage(spark, table(spark, SF, "documents"), SF).collect()
    at = clashing.columns.index("doc_id")
    assert all(r[i] == r[at] for r in rows for i in range(len(clashing.columns) - len(CLASHING), len(clashing.columns)))
    assert collections.Counter(tuple(r)[:len(plain[0])] for r in rows) == collections.Counter(map(tuple, plain))


def test_packing_stage_takes_clashing_columns(spark, clashing):
    got = packing.stage(spark, clashing, SF)
    want = packing.stage(spark, table(spark, SF, "documents"), SF)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_toxicity_model_does_not_follow_the_order_of_rows(spark):
    docs, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    one = tox.learn(docs, labels)
    assert tox.learn(docs.repartition(7, "n_chars").sortWithinPartitions("text"), labels.repartition(3, "doc_id")) == one
    # a repeated table is the same sample
    assert tox.learn(docs.union(docs), labels) == one


def test_repeated_rows_are_dealt_to_all_shards(spark):
    docs = spark.range(30_000).selectExpr("cast(null as long) doc_id", "'one text of five words' text", "'s' source")
    out = packing.pack(docs).cache()
    assert out.count() == 30_000 and out.select("copy").distinct().count() == 30_000
    shards = [r["count"] for r in out.groupBy("shard").count().collect()]
    assert len(shards) == 8 and max(shards) < 2 * min(shards)
    assert out.select("shard", "bin").distinct().count() == 30_000     # a cluster once in a bin
    assert out.where("doc_id is not null").count() == 0
    out.unpersist()


def test_packing_does_not_follow_the_order_of_rows(spark):
    docs = table(spark, SF, "documents")
    docs = docs.union(docs.limit(50))
    one = packing.pack(docs, rows_per_shard=60).collect()
    again = packing.pack(docs.repartition(5), rows_per_shard=60).collect()
    assert sorted(map(tuple, one)) == sorted(map(tuple, again))
