import hashlib
import math

import pytest
from pyspark.sql import functions as F

from sonolode.functions import hashing
from sonolode.operators import ledger, metrics, projection, sampling


def test_split_hash(spark):
    paths = [f"repo/{i}/yor.parquet" for i in range(300)] + ["", "ünï"]
    df = spark.createDataFrame([(p,) for p in paths] + [(None,)], "p string")
    for r in df.select("p", hashing.split_bucket("p").alias("b"), hashing.shard_id("p").alias("s"), hashing.assign_split("p", (0.7, 0.2, 0.1)).alias("w")).collect():
        if r["p"] is None:
            assert (r["b"], r["s"], r["w"]) == (None, None, None)
            continue
        digest = hashlib.sha256(r["p"].encode()).hexdigest()
        bucket = int(digest, 16) % 10_000
        assert (r["b"], r["s"]) == (bucket, digest[:20])
        assert r["w"] == ("train" if bucket < 7000 else "validation" if bucket < 9000 else "test")


def metric_rows(spark):
    rows = [("a", "train", "yor", float(x) if x is not None else None) for x in (1, 3, None, math.nan, math.inf)] + [("b", None, "yor", None)]
    df = spark.createDataFrame(rows, "corpus string, split string, language string, duration_sec double")
    return df.withColumns({m: F.col("duration_sec") for m in metrics.METRICS if m != "duration_sec"})


def test_metrics_of_finite_values(spark):
    got = {r["corpus"]: r for r in metrics.finalize(metrics.group_state(metric_rows(spark))).collect()}
    assert (got["a"]["count"], got["a"]["snr_db_mean"], got["a"]["snr_db_std"], got["a"]["hours"]) == (5, 2.0, 1.0, 4 / 3600)
    assert (got["b"]["count"], got["b"]["snr_db_mean"], got["b"]["snr_db_std"], got["b"]["hours"]) == (1, None, None, 0.0)


def test_merging_does_not_depend_on_order_and_shards_count_once(spark):
    rows = metric_rows(spark).withColumn("shard_id", F.when(F.col("duration_sec") > 2, "x").otherwise("y"))
    states = metrics.group_state(rows, ("shard_id", *metrics.KEYS))
    x, y = states.filter("shard_id = 'x'"), states.filter("shard_id = 'y'")
    one = metrics.add_shards(metrics.add_shards(x, y), states)
    two = metrics.add_shards(metrics.add_shards(y, states), x)
    whole = metrics.finalize(metrics.group_state(rows)).orderBy("corpus").collect()
    for s in (one, two):
        assert metrics.finalize(metrics.merge_states(s.drop("shard_id"))).orderBy("corpus").collect() == whole


def test_exact_quantiles(spark):
    values = [1.0, 2.0, 3.0, 4.0, 10.0, 20.0, 30.0]
    rows = [("a", v) for v in values] + [("b", 5.0)] * 100 + [("c", v) for v in (-1e9, -0.0, 1e-9, 1e9)] + [("d", math.nan), (None, 7.0)]
    df = spark.createDataFrame(rows, "k string, x double")
    got = {r["k"]: r for r in metrics.exact_quantiles(df, ["k"], ["x"], {"p10": 0.1, "p50": 0.5, "p90": 0.9}).collect()}
    assert (got["a"]["p10"], got["a"]["p50"], got["a"]["p90"]) == (2.0, 4.0, 20.0)
    assert got["b"]["p50"] == 5.0 and got["c"]["p10"] == -1e9 and got["c"]["p90"] == 1e9 and "d" not in got and got[None]["p50"] == 7.0


def test_leaf_weights_add_up(spark):
    rows = [("a", "train", "x", 8.0), ("a", "train", "y", 1.0), ("b", "train", "x", 3.0), ("c", "train", "x", 0.0), ("d", "test", "x", 5.0)]
    got = {(r[0], r[1]): r[2] for r in sampling.leaf_weights(spark.createDataFrame(rows, "corpus string, split string, language string, hours double"), 0.25, 0.2).collect()}
    assert set(got) == {("a", "x"), ("a", "y"), ("b", "x")} and sum(got.values()) == pytest.approx(1)
    assert got["a", "x"] / got["a", "y"] == pytest.approx(8**0.2)


def test_interleaving_uses_every_leaf_up(spark):
    sizes = spark.createDataFrame([("a", "x", 0.5, 40), ("b", "x", 0.3, 10), ("c", "y", 0.2, 25), ("d", "y", 0.0, 5), ("e", "y", 0.1, 0)], "corpus string, language string, p double, n long")
    plan = sampling.interleave_plan(sizes, seed=7).orderBy("position").collect()
    assert [r["position"] for r in plan] == list(range(len(plan)))
    rows = {}
    for r in plan:
        rows.setdefault(r["corpus"], []).append(r["row"])
    assert set(rows) == {"a", "b", "c"}
    for corpus, n in (("a", 40), ("b", 10), ("c", 25)):
        assert rows[corpus] == [i % n for i in range(len(rows[corpus]))] and len(rows[corpus]) >= n
    assert abs(len(rows["a"]) / len(plan) - 0.5) < 0.15
    assert sampling.interleave_plan(sizes.limit(0), seed=7).count() == 0


def test_numbering(spark):
    df = spark.range(5000).withColumn("g", F.nullif(F.col("id") % 3, F.lit(2)))
    got = sampling.numbered(df, ["id"], ["g"]).collect()
    assert len(got) == 5000 and all(r["number"] == r["id"] // 3 for r in got)
    assert [r["number"] for r in sampling.numbered(df, ["id"]).orderBy("id").collect()] == list(range(5000))


def test_shuffle_repeats(spark):
    df = spark.range(50)
    one, two = ([r[0] for r in sampling.shuffled(df.repartition(n), 3, ["id"]).collect()] for n in (1, 7))
    assert one == two != sorted(one)


def test_projection(spark):
    df = spark.createDataFrame([("t", "u", "x")], "utterance string, transcript string, extra string")
    assert projection.rename_present(df, {"utterance": "transcript", "extra": "more", "none": "y"}).columns == ["utterance", "transcript", "more"]
    assert projection.reshape(df, {"utterance": "transcript"}, ["transcript"], drop_first=True).columns == ["transcript", "extra"]
    assert projection.reshape(df, {"utterance": "transcript"}, ["transcript"], drop_first=False).columns == ["utterance", "extra"]
    with pytest.raises(ValueError):
        projection.to_target(df.select("extra"), F.lit("a"), F.lit("b"), F.lit("c"))
    rows = spark.createDataFrame([(5.5, "x", (None, "p"), "old")], "duration_sec double, text string, audio struct<bytes binary, path string>, split string")
    out = projection.to_target(rows, F.lit("yor"), F.lit("train"), F.lit("c"))
    from sonolode.schema import TARGET

    assert [(f.name, f.dataType) for f in out.schema] == [(f.name, f.dataType) for f in TARGET]
    assert out.first()["split"] == "train" and out.first()["duration_sec"] == 5.5 and out.first()["snr_db"] is None


def test_ledger(spark, tmp_path):
    book = ledger.Ledger(spark, f"file://{tmp_path}", "org/repo")
    files = spark.createDataFrame([("b",), ("a",), ("b",)], "filename string")
    book.register(files)
    book.register(files)
    assert [r["filename"] for r in book.claim().collect()] == ["a", "b"]
    kept = tmp_path / "out"
    kept.mkdir()
    book.mark_completed({"a": [str(kept)]})
    assert [(r["filename"], r["status"]) for r in book.claim().collect()] == [("b", "pending"), ("a", "completed")]
    assert book.resume() == []
    kept.rmdir()
    assert book.resume() == ["a"] and {r["status"]: r["shards"] for r in ledger.stats(book.entries()).collect()} == {"pending": 2}
    book.mark_uploaded(["a"])
    book.fail(["b"])
    assert book.claim().count() == 0
    assert [r["position"] for r in ledger.indexed(book.entries(), status="failed").collect()] == [1]
    with pytest.raises(KeyError):
        book.mark_uploaded(["c"])
    with pytest.raises(ValueError):
        book.register(files, exist_ok=False)
    with pytest.raises(FileNotFoundError):
        ledger.Ledger(spark, f"file://{tmp_path}", "other", strict=True)


def test_repository_names(spark):
    from sonolode import sinks

    cases = ["org/x", "hf://datasets/org/x/", "https://a.b/org/x", "datasets/buckets/x//", "buckets/datasets/x", "/", "", "a://b://c", "datasetsx/y"]
    df = spark.createDataFrame([(c,) for c in cases], "r string")
    assert [r[0] for r in df.select(sinks.repository_column(F.col("r"))).collect()] == [sinks.repository_name(c) for c in cases]
