"""The lookup gives the same rows whichever path it takes, and no piece of a hot key stays large."""

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from earshot import Star
from earshot.operators.lookup import hot_keys, lookup_join, measured_bytes
from earshot.plans import monitoring
from earshot.sources.retail import from_retail
from tests.frames import plan_of, rows

FOLDER = "/root/testdata/sf0.01"
SALTED = 0  # a limit no dimension fits in


def skewed(spark, n=6000):
    """A third of the rows on key 1, a third without a key, the rest spread out."""
    key = F.when(F.col("id") % 3 == 0, 1).when(F.col("id") % 3 == 1, F.col("id") % 500)
    return spark.range(n).select("id", key.cast("long").alias("k"))


def test_paths_agree(spark):
    facts = skewed(spark)
    dim = spark.range(400).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    plain = rows(facts.join(dim, "k", "left"), "id", "k", "v")
    for profile in (None, facts, facts.where("k = 1")):
        for limit in (SALTED, 1 << 30):
            found = lookup_join(facts, dim, "k", ["id"], profile, limit, hot_share=0.01)
            assert rows(found, "id", "k", "v") == plain


def test_hot_keys_are_few_and_cut_to_size(spark):
    facts = skewed(spark)
    (hot,) = hot_keys(facts, "k", 0.01).collect()
    assert hot["k"] == 1 and hot["_pieces"] >= 33
    salted = facts.where("k = 1").select(F.pmod(F.xxhash64("id"), F.lit(hot["_pieces"])).alias("p"))
    largest = salted.groupBy("p").count().agg(F.max("count")).first()[0]
    assert largest < 2 * 6000 * 0.01


def test_salted_plan_neither_broadcasts_the_dimension_nor_crosses(spark):
    facts = skewed(spark)
    dim = spark.range(400).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_of(lookup_join(facts, dim, "k", ["id"], facts, SALTED), "simple")
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" in plan and "NestedLoop" not in plan and "Cartesian" not in plan
    assert "hashpartitioning(k#" in plan and "_salt" in plan


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(keys=st.lists(st.one_of(st.none(), st.integers(0, 4)), max_size=30), known=st.sets(st.integers(0, 6)))
def test_any_keys(spark, keys, known):
    facts = spark.createDataFrame(list(enumerate(keys)), "id long, k long")
    dim = spark.createDataFrame([(k, f"v{k}") for k in known], "k long, v string")
    expected = sorted(((i, k, f"v{k}" if k in known else None) for i, k in enumerate(keys)), key=repr)
    assert rows(lookup_join(facts, dim, "k", ["id"], facts, -1, hot_share=0.1), "id", "k", "v") == expected


def test_measured_size_counts_text(spark):
    short = spark.createDataFrame([("a",)] * 10, "v string")
    long_ = spark.createDataFrame([("a" * 1000,)] * 10, "v string")
    assert measured_bytes(long_) - measured_bytes(short) == 9990
    assert measured_bytes(spark.createDataFrame([], "v string, n long")) == 0


@pytest.mark.parametrize("table", ["fact", "rejections"])
def test_star_without_broadcast_is_the_same(spark, table):
    def build(limit):
        star = Star(from_retail(spark, FOLDER), broadcast_limit=limit)
        return star.fact.drop("data_refreshed_on") if table == "fact" else monitoring.rejections_by_dimension(star)

    small, large = build(1 << 30), build(SALTED)
    assert rows(small, *small.columns) == rows(large, *small.columns)
