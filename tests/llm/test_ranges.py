import random

import pytest
from pyspark.sql import functions as F

from sonolode.llm.ranges import among, running


@pytest.mark.parametrize("groups", [[7], [1, 2, 3], [5, *range(100, 160)]])
def test_running_over_many_ranges(spark, groups):
    """One group with most of the rows, alone or among many small ones, over more ranges than the groups are."""
    rng = random.Random(3)
    rows = [(groups[0] if rng.random() < 0.7 else rng.choice(groups), i, rng.randrange(0, 50), None if i % 3 else "x") for i in range(1200)]
    spark.conf.set("spark.sql.shuffle.partitions", "9")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = spark.createDataFrame(rows, "g long, id long, w long, other string")
        got = running(df, [F.col("w").desc(), F.col("id")], "w", "test").collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    want = []
    for g in {*groups}:
        total = 0
        for n, r in enumerate(sorted((r for r in rows if r[0] == g), key=lambda r: (-r[2], r[1]))):
            want.append((*r, n, total))
            total += r[2]
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))
    assert running(df.limit(0), [F.col("id")], "w", "none").count() == 0


def test_among_keeps_all_and_few_others(spark):
    rows = spark.range(50_000).select(F.col("id").cast("string").alias("k"), F.lit(1).alias("__at"))
    ids = spark.range(0, 50_000, 97).select(F.col("id").cast("string").alias("i"))
    kept = {r["k"] for r in among(rows.select("k"), "k", ids).collect()}
    assert {r["i"] for r in ids.collect()} <= kept and len(kept) < 1.05 * ids.count()
    assert among(rows.select("k"), "k", ids.limit(0)).count() == 0
