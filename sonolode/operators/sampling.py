"""Sampling weights, weighted interleaving and repeatable shuffles."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

def leaf_weights(hours: DataFrame, beta_corpus: float, beta_language: float, split: str = "train") -> DataFrame:
    """(corpus, language, p) from (corpus, split, language, hours): P(corpus) P(language given corpus).

    Hours are smoothed by a power and scaled to 1 over what has hours at all; one row per leaf, so the windows are small.
    """
    leaves = hours.filter((F.col("split") == split) & F.col("corpus").isNotNull() & F.col("language").isNotNull()).groupBy("corpus", "language").agg(F.sum("hours").alias("h"))
    corpora = leaves.groupBy("corpus").agg(F.sum("h").alias("h")).filter("h > 0")
    p_corpus = corpora.select("corpus", (F.pow("h", F.lit(beta_corpus)) / F.sum(F.pow("h", F.lit(beta_corpus))).over(Window.partitionBy(F.lit(1)))).alias("p_corpus"))
    share = F.pow("h", F.lit(beta_language))
    p_language = leaves.filter("h > 0").select("corpus", "language", (share / F.sum(share).over(Window.partitionBy("corpus"))).alias("p_language"))
    return p_language.join(p_corpus, "corpus").select("corpus", "language", (F.col("p_corpus") * F.col("p_language")).alias("p"))


def uniform(*parts: Column) -> Column:
    """A number in [0, 1) from the SHA-256 of ``parts``: the same in every engine."""
    digest = F.sha2(F.concat_ws(":", *[p.cast("string") for p in parts]), 256)
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") / F.lit(float(1 << 32))


def numbered(df: DataFrame, order: Sequence[str], by: Sequence[str] = (), name: str = "number") -> DataFrame:
    """``df`` with rows numbered from 0 by ``order`` within ``by``, without one task for all of a group.

    Rows go to ranges of ``order``; a small table of counts per range gives each range its first number. The order must be
    without ties for a repeatable result.
    """
    from sonolode.session import staged

    # staged, so that the ranges, which Spark draws from a sample, are fixed
    cut = staged(df.repartitionByRange(*by, *order).withColumn("__range", F.spark_partition_id()), "ranges")
    counts = cut.groupBy(*by, "__range").agg(F.count(F.lit(1)).alias("__n"))
    before = counts.select(*by, "__range", (F.sum("__n").over(Window.partitionBy(*(by or [F.lit(1)])).orderBy("__range")) - F.col("__n")).alias("__before"))
    same = F.col("a.__range") == F.col("b.__range")
    for key in by:  # null is a group too
        same = same & F.col(f"a.{key}").eqNullSafe(F.col(f"b.{key}"))
    row = F.row_number().over(Window.partitionBy(*[F.col(f"a.{key}") for key in by], F.col("a.__range")).orderBy(*[F.col(f"a.{c}") for c in order])) - 1
    met = cut.alias("a").join(before.alias("b"), same)
    return met.select(*[F.col(f"a.{c}") for c in df.columns], (F.col("b.__before") + row).alias(name))


def smoothed_first(hours: DataFrame, beta: float, column: str = "hours") -> DataFrame:
    """``hours``, one row per corpus or leaf, with ``weight``: each share of the whole raised to ``beta``, and not scaled to 1 again."""
    total = F.sum(column).over(Window.partitionBy(F.lit(1)))
    return hours.withColumn("weight", F.pow(F.try_divide(F.col(column), total), F.lit(beta)))


def drawn_leaf(u: Column, bounds: Sequence[float]) -> Column:
    """The number of the first of the rising ``bounds`` that is above ``u``, found by halving an array; the last one where none is."""
    edges = F.array(*[F.lit(float(b)) for b in bounds])
    steps = F.sequence(F.lit(1), F.lit(max(1, len(bounds).bit_length())))
    start = F.struct(F.lit(0).alias("lo"), F.lit(len(bounds) - 1).alias("hi"))

    def halve(span: Column, _: Column) -> Column:
        mid = F.floor((span["lo"] + span["hi"]) / 2).cast("int")
        above = F.get(edges, mid) > u
        return F.struct(F.when(above, span["lo"]).otherwise(F.least(mid + 1, span["hi"])).alias("lo"), F.when(above, mid).otherwise(span["hi"]).alias("hi"))

    return F.aggregate(steps, start, halve, lambda span: span["lo"])


def interleave_plan(sizes: DataFrame, seed: int, leaf: Sequence[str] = ("corpus", "language")) -> DataFrame:
    """(position, leaf, row): the order in which rows of the leaves follow one another, from (leaf, p, n).

    Each position draws a leaf by its probability; a leaf's draws run through its rows again and again, until every leaf has been
    used up once. Leaves without rows or chance are left out. The draws are hashes of seed and position. A position costs
    a search of an array of the leaves' bounds; should some leaf lack draws, only further positions are drawn.
    """
    from sonolode.session import staged

    spark = sizes.sparkSession
    # the leaves are folders of a dataset: their names and bounds fit anywhere
    used = [r.asDict() for r in sizes.filter("p > 0 and n > 0").select(*leaf, "p", "n").orderBy(*leaf).collect()]
    names = spark.createDataFrame([(i, *(r[c] for c in leaf), r["n"]) for i, r in enumerate(used)], "__leaf int, " + ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in sizes.select(*leaf).schema) + ", n bigint")
    total = sum(r["p"] for r in used)
    bounds = [float(b) for b in accumulate(r["p"] / total for r in used)] or [1.0]
    step = int(max((r["n"] / r["p"] for r in used), default=0) * total * 1.5) + 1000 if used else 0
    drawn, start = None, 0
    while used:
        u = uniform(F.lit(seed), F.col("id"))
        more = staged(spark.range(start, start + step).select(F.col("id").alias("position"), drawn_leaf(u, bounds).alias("__leaf")), "draws")
        drawn, start = more if drawn is None else drawn.unionByName(more), start + step
        counts = {r["__leaf"]: r["count"] for r in drawn.groupBy("__leaf").count().collect()}  # one row per leaf
        if all(counts.get(i, 0) >= r["n"] for i, r in enumerate(used)):
            break
    met = (drawn if drawn is not None else spark.range(0).select(F.col("id").alias("position"), F.lit(0).alias("__leaf"))).join(F.broadcast(names), "__leaf")  # one row per leaf
    turns = numbered(met, ["position"], ["__leaf"], "turn")
    stop = turns.filter(F.col("turn") == F.col("n") - 1).agg(F.max("position")).first()[0]
    return turns.filter(F.col("position") <= F.lit(-1 if stop is None else stop)).select("position", *leaf, (F.col("turn") % F.col("n")).alias("row"))


def buffered_shuffle(df: DataFrame, seed: int = 42) -> DataFrame:
    """Rows of each task in random order, by a sort that spills and no exchange: what a buffer does to a stream, for buffers of any size."""
    return df.sortWithinPartitions(F.rand(seed))


def shuffled(df: DataFrame, seed: int, key: Sequence[str]) -> DataFrame:
    """Rows in an order by the hash of ``key`` and seed: the same on every run and cluster."""
    return df.orderBy(F.sha2(F.concat_ws(":", F.lit(str(seed)), *[F.col(k).cast("string") for k in key]), 256), *key)
