import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from sonolode.llm import quantiles
from sonolode.llm.quantiles import Sketch
from sonolode.session import table


def worst(sketch, values):
    ordered = np.sort(values)
    errors = []
    for q in np.linspace(0.01, 0.99, 50):
        v = sketch.quantiles([q])[0]
        low, high = np.searchsorted(ordered, v, "left") + 1, np.searchsorted(ordered, v, "right")
        target = q * len(values)
        errors.append(max(0, low - target, target - high) / len(values))
    return max(errors)


@pytest.mark.parametrize("shape", ["normal", "sorted", "ties", "tail"])
def test_error_stays_within_the_bound(shape):
    rng = np.random.default_rng(5)
    x = {"normal": rng.normal(size=300_000), "sorted": np.arange(300_000.0), "ties": rng.integers(0, 5, 300_000).astype(float), "tail": rng.pareto(0.5, 300_000)}[shape]
    one = Sketch(k=256, seed=1)
    for part in np.array_split(x, 37):
        one.add(part)
    many = Sketch.load(Sketch(k=256, seed=2).add(x[:1000]).dump()).merge([Sketch(k=256, seed=i).add(p) for i, p in enumerate(np.array_split(x[1000:], 50))])
    for s in (one, many):
        assert s.n == len(x) and (s.low, s.high) == (x.min(), x.max())
        assert 0 < s.bound() < 0.05 and worst(s, x) <= s.bound()
        assert sum(len(v) for v in s.levels) < 5000


def test_small_sketches_are_exact():
    s = Sketch(k=64).add(np.array([3.0, 1.0, 2.0]))
    assert s.bound() == 0 and s.quantiles([0, 0.34, 0.5, 1]) == [1.0, 2.0, 2.0, 3.0]
    assert Sketch().quantiles([0.5]) == [None] and Sketch.load(Sketch().dump()).n == 0


def test_groups(spark, small):
    rng = np.random.default_rng(6)
    values = rng.normal(size=30_000)
    rows = [(i, "A" if i % 3 else "b", float(v)) for i, v in enumerate(values)] + [(10**6 + i, None, v) for i, v in enumerate((math.nan, math.inf, -math.inf, -0.0))] + [(None, "b", 100.0)] * 2
    df = spark.createDataFrame(rows, "utt_id long, corpus string, snr_db double").withColumns({"recorded_at": F.timestamp_seconds(F.col("utt_id") % 400 * 86_400), "day": F.lit("clash"), "metric": F.lit(0), "n": F.lit(0)})
    df = df.unionByName(df.limit(500))
    got = [r for r in quantiles.percentiles(df, ["snr_db"]).collect() if r["level"] == "corpus"]
    found = {r["corpus"]: r for r in got}
    assert (found[None]["n"], found[None]["p50"]) == (1, 0.0)
    for corpus, own in (("a", [v for i, v in enumerate(values) if i % 3]), ("b", [v for i, v in enumerate(values) if i % 3 == 0] + [100.0, 100.0])):
        r = found[corpus]
        assert r["n"] == len(own) and r["high"] == max(own)
        for p in quantiles.PERCENTILES:
            rank = np.searchsorted(np.sort(own), r[f"p{p:02d}"], "right") / len(own)
            assert abs(rank - p / 100) <= r["rank_error"] + 1 / len(own)
    again = {r["corpus"]: r for r in quantiles.percentiles(df, ["snr_db"]).collect() if r["level"] == "corpus"}
    assert {k: v["p50"] for k, v in again.items()} == {k: v["p50"] for k, v in found.items()}
    assert quantiles.percentiles(table(spark, small, "utterances").limit(0)).count() == 0


def test_partial_results_combine(spark):
    df = spark.range(20_000).select((F.col("id") % 7).cast("int").alias("k"), F.col("id").cast("double").alias("x"))
    parts = [quantiles.partial_sketches(df.filter(F.col("id") % 3 == i).repartition(5), ["k"], ["x"]) for i in range(3)]
    merged = quantiles.answers(quantiles.merge_sketches(parts[0].union(parts[1]).union(parts[2]), ["k"]), ["k"]).collect()
    assert len(merged) == 7 and all(abs(r["p50"] / 20_000 - 0.5) <= r["rank_error"] + 0.001 for r in merged)


def test_tasks_throw_independent_coins(spark):
    """A group over many tasks with equal rows: with equal coins their errors would add up, not cancel."""
    n, tasks = 4_000, 60
    df = spark.range(n * tasks, numPartitions=tasks).select(F.lit(1).alias("k"), (F.col("id") % n).cast("double").alias("x"))
    parts = quantiles.partial_sketches(df, ["k"], ["x"], k=64)
    seeds = [Sketch.load(r["sketch"]).seed for r in parts.collect()]
    assert len(set(seeds)) == len(seeds) == tasks
    r = quantiles.answers(quantiles.merge_sketches(parts, ["k"]), ["k"]).first()
    for p in quantiles.PERCENTILES:
        assert abs(r[f"p{p:02d}"] / n - p / 100) <= r["rank_error"] + 1 / n


def test_tasks_hold_a_bounded_number_of_values(spark, monkeypatch):
    monkeypatch.setattr(quantiles, "ROWS", 1000)
    monkeypatch.setattr(quantiles, "HELD", 500)
    df = spark.range(20_000, numPartitions=1).select((F.col("id") % 40).alias("k"), F.col("id").cast("double").alias("x"))
    parts = quantiles.partial_sketches(df, ["k"], ["x"], k=64)
    assert parts.count() >= 40
    merged = quantiles.answers(quantiles.merge_sketches(parts, ["k"]), ["k"]).collect()
    assert len(merged) == 40 and all(r["n"] == 500 and abs(r["p50"] / 20_000 - 0.5) <= r["rank_error"] + 0.002 for r in merged)
