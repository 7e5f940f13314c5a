"""Ranks and pages over range partitions."""

import random

import pytest
from pyspark.sql import functions as F

from earlybell.operators import ranking


def test_dense_rank_of_few_frequencies(spark):
    rows = [("a", 5), ("b", 0), ("c", 5), ("d", 2), ("e", 7), ("f", 0)]
    got = ranking.dense_frequency_rank(spark.createDataFrame(rows, "k string, n long"), "n", "r")
    assert {r.k: r.r for r in got.collect()} == {"a": 2, "b": None, "c": 2, "d": 3, "e": 1, "f": None}
    assert got.columns == ["k", "n", "r"] and dict(got.dtypes)["r"] == "int"


def test_dense_rank_of_a_million_frequencies(spark):
    n = 1_000_000
    df = spark.range(2 * n).select((F.col("id") * 7919 % n + 1).alias("n"))
    got = ranking.dense_frequency_rank(df, "n", "r")
    plan = got._jdf.queryExecution().executedPlan().toString().split("\n")
    single = [k for k, line in enumerate(plan) if "SinglePartition" in line]
    assert all("keys=[_range" in plan[k + 1] for k in single)  # the index alone: a row per range
    wrong = got.where(F.col("r") != n + 1 - F.col("n")).count()
    assert (got.count(), wrong) == (2 * n, 0)


@pytest.mark.parametrize("size", [1, 7, 50])
def test_pages_equal_slices_of_the_sorted_rows(spark, size):
    rng = random.Random(size)
    rows = [(rng.randrange(9), k) for k in range(180)]
    df = spark.createDataFrame(rows, "v int, k int").repartition(5)
    result = ranking.paged(df, [F.desc("v"), F.col("k")])
    want = sorted(rows, key=lambda r: (-r[0], r[1]))
    assert result.total == len(rows)
    for number in (1, 2, 1 + len(rows) // size, 2 + len(rows) // size):
        got = sorted((r.position, r.v, r.k) for r in result.page(spark, number, size).collect())
        first = (number - 1) * size
        assert got == [(first + i + 1, *r) for i, r in enumerate(want[first : first + size])]
    with pytest.raises(ValueError, match="out of range"):
        result.page(spark, 0, 10)


def test_a_deep_page_reads_the_ranges_it_touches(spark):
    merge = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(merge, False)  # small ranges are else put together
    try:
        result = ranking.paged(spark.range(9000).select("id"), [F.col("id")])
    finally:
        spark.conf.unset(merge)
    assert len(result.ranges) > 1
    page = result.page(spark, 9000 // 20, 20)
    assert sorted(r.id for r in page.collect()) == list(range(8980, 9000))
    plan = page._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "_range#" in plan.split("PartitionFilters: [")[1].split("]")[0]


def test_an_empty_result_has_no_pages(spark):
    result = ranking.paged(spark.range(0).select("id"), [F.col("id")])
    assert result.total == 0 and result.page(spark, 1, 10).count() == 0
