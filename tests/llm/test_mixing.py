import random

import pytest
from pyspark.sql import functions as F

from sonolode.llm import mixing
from sonolode.session import table

TARGETS = "source string, target_share double, max_repeats int"


def documents(spark, sizes):
    rng = random.Random(1)
    rows = [(i, " ".join("word" for _ in range(rng.randrange(1, 60))), s, 9.5) for i, s in enumerate(x for x, n in sizes.items() for _ in range(n))]
    return spark.createDataFrame(rows, "doc_id long, text string, source string, weight double")


def test_shares_are_met(spark):
    docs = documents(spark, {"big": 1500, "mid": 300, "tiny": 20, "other": 50})
    targets = spark.createDataFrame([("BIG", 0.5, 1), ("mid", 0.3, None), ("tiny", 0.1, 8), ("absent", 0.1, 2), (None, 0.5, 1), ("mid", float("nan"), 1)], TARGETS)
    chosen, shares = mixing.mix(docs, targets)
    chosen, shares = chosen.collect(), {r["source"]: r for r in shares.collect()}
    assert {r["source"] for r in chosen} == {"big", "mid", "tiny"} and len({r["doc_id"] for r in chosen}) == len(chosen)
    for name, share in (("big", 0.5), ("mid", 0.3), ("tiny", 0.1)):
        r, own = shares[name], [c for c in chosen if c["source"] == name]
        assert r["tokens"] == sum(c["repeats"] * c["n_tokens"] for c in own) == pytest.approx(share * r["total"], abs=60)
        assert r["actual_share"] == pytest.approx(share / 0.9, abs=0.02)
        assert r["max_repeats"] is None or r["most_repeats"] <= r["max_repeats"]
    assert (shares["absent"]["tokens"], shares["absent"]["actual_share"]) == (0, 0.0)
    epochs = {c["repeats"] for c in chosen if c["source"] == "tiny"}
    assert max(epochs) - min(epochs) <= 1  # complete epochs, then part of one
    again = mixing.mix(docs.repartition(5), targets)[0].collect()
    assert sorted(map(str, again)) == sorted(map(str, chosen))


def test_caps_hold(spark):
    docs = documents(spark, {"a": 100, "b": 10})
    chosen, shares = mixing.mix(docs, spark.createDataFrame([("a", 0.5, 1), ("b", 0.5, 3)], TARGETS), total_tokens=10**6)
    rows = {r["source"]: r for r in shares.collect()}
    assert rows["a"]["copies"] == 100 and rows["b"]["copies"] == 30 and {r["repeats"] for r in chosen.collect()} == {1, 3}
    none, zero = mixing.mix(docs, spark.createDataFrame([("a", 1.0, 0)], TARGETS))
    assert none.count() == 0 and zero.first()["actual_share"] is None


def test_quality_counts(spark):
    rows = [(i, ("good words " * 20) if i % 2 else ("#1@2 " * 60), "a") for i in range(2000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    chosen = mixing.mix(docs, spark.createDataFrame([("a", 1.0, 1)], TARGETS), total_tokens=20_000)[0].collect()
    good = sum(r["doc_id"] % 2 for r in chosen)
    assert good > 4 * (len(chosen) - good)


def test_edges(spark, small):
    docs, targets = table(spark, small, "documents"), table(spark, small, "mix_targets")
    for d, t in ((docs.limit(0), targets), (docs, targets.limit(0))):
        assert mixing.mix(d, t)[0].count() == 0
    odd = spark.createDataFrame([(1, None, "a"), (2, "", "a"), (3, "x", "a"), (3, "x", "a"), (None, "y " * 50_000, "a"), (4, "z", None)], "doc_id long, text string, source string").withColumns({n: F.lit(1) for n in ("n_tokens", "range", "key", "rest", "repeats", "epochs", "weight")})
    chosen = mixing.mix(odd, spark.createDataFrame([("a", 1.0, 2)], TARGETS))[0].collect()
    assert sorted((r["doc_id"] or 0, r["repeats"]) for r in chosen) == [(0, 2), (3, 2), (3, 2)]
