"""Statistics per group as additive state, so that shards, days and runs can be merged.

The state of a metric is (sum, sum of squares, number) of its finite values. Spark sums each task's rows before it shuffles,
so a group that holds a third of all rows costs each task one row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sonolode.functions.audio import METRICS
from sonolode.functions.names import _col

KEYS = ("corpus", "split", "language")


def finite(c: Column | str) -> Column:
    """The value as double, null where it is NaN or infinite; negative zero is zero."""
    x = _col(c).cast("double") + F.lit(0.0)
    return F.when(~F.isnan(x) & (F.abs(x) < float("inf")), x)


def group_state(df: DataFrame, keys: Sequence[str] = KEYS, metrics: Sequence[str] = METRICS, hours_of: str = "duration_sec") -> DataFrame:
    """(keys, count, hours, and <m>_sum, <m>_sumsq, <m>_n per metric). A row whose metrics are null still counts."""
    state = [F.count(F.lit(1)).alias("count"), (F.coalesce(F.sum(finite(hours_of)), F.lit(0.0)) / 3600).alias("hours")]
    for m in metrics:
        x = finite(m)
        state += [F.coalesce(F.sum(x), F.lit(0.0)).alias(f"{m}_sum"), F.coalesce(F.sum(x * x), F.lit(0.0)).alias(f"{m}_sumsq"), F.count(x).alias(f"{m}_n")]
    return df.groupBy(*keys).agg(*state)


def merge_states(states: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """States of equal keys added up; null keys are equal."""
    rest = [c for c in states.columns if c in ("count", "hours") or c.endswith(("_sum", "_sumsq", "_n"))]
    return states.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in rest])


def add_shards(known: DataFrame, new: DataFrame, identity: str = "shard_id") -> DataFrame:
    """States per shard with those of ``new`` whose shard is not yet counted, so that a shard never counts twice."""
    return known.unionByName(new.join(known.select(identity).distinct(), identity, "left_anti"))


def finalize(states: DataFrame, keys: Sequence[str] = KEYS, metrics: Sequence[str] = METRICS) -> DataFrame:
    """(keys, hours, count, <m>_mean, <m>_std): population deviation; null for metrics without values."""
    out = [F.col(k) for k in keys] + [F.col("hours"), F.col("count")]
    for m in metrics:
        mean = F.try_divide(F.col(f"{m}_sum"), F.col(f"{m}_n"))
        spread = finite(F.try_divide(F.col(f"{m}_sumsq"), F.col(f"{m}_n")) - mean * mean)
        out += [mean.alias(f"{m}_mean"), F.when(spread.isNotNull(), F.sqrt(F.greatest(spread, F.lit(0.0)))).alias(f"{m}_std")]
    return states.select(*out)


def exact_quantiles(df: DataFrame, keys: Sequence[str], metrics: Sequence[str], shares: dict[str, float]) -> DataFrame:
    """(keys, metric, and a column per share): the value of rank round((n - 1) q), counted from 0, of the finite values; for a share of one half the median.

    The median of an even number of values is the mean of the two in the middle.

    A group's values are counted by cells of their logarithm, which cover any range; only the cells that hold a wanted
    rank are then sorted, after equal values have been counted together. So no task sorts a whole group.
    """
    from sonolode.session import staged

    group = F.xxhash64(*[F.coalesce(F.col(k).cast("string"), F.lit("\x00")) for k in keys])
    named = df.select(*keys, group.alias("g")).groupBy("g").agg(*[F.min(k).alias(k) for k in keys])
    values = F.array(*[F.struct(F.lit(i).alias("m"), finite(m).alias("x")) for i, m in enumerate(metrics)])
    melted = df.select(group.alias("g"), F.explode(values).alias("v")).select("g", "v.m", "v.x").filter("x is not null")
    scaled = F.log2(1 + F.abs("x") * 1e6) * 64
    cell = F.floor(F.when(F.col("x") < 0, -scaled).otherwise(scaled)).cast("int")
    counted = staged(melted.withColumn("cell", cell).groupBy("g", "m", "cell", "x").agg(F.count(F.lit(1)).alias("n")), "value-counts")
    cells = counted.groupBy("g", "m", "cell").agg(F.sum("n").alias("in_cell"))
    over = Window.partitionBy("g", "m")
    cells = cells.withColumn("before", F.sum("in_cell").over(over.orderBy("cell")) - F.col("in_cell")).withColumn("total", F.sum("in_cell").over(over))
    end = F.col("total") - 1
    at = [(k, r) for k, q in shares.items() for r in ([F.floor(end / 2), F.ceil(end / 2)] if q == 0.5 else [F.rint(end * F.lit(q))])]
    ranks = F.array(*[F.struct(F.lit(k).alias("name"), r.cast("double").alias("rank")) for k, r in at])
    wanted = cells.select("*", F.posexplode(ranks).alias("half", "q")).filter((F.col("q.rank") >= F.col("before")) & (F.col("q.rank") < F.col("before") + F.col("in_cell")))
    met = counted.join(wanted.select("g", "m", "cell", "before", "q.name", "q.rank", "half"), ["g", "m", "cell"])
    start = F.col("before") + F.sum("n").over(Window.partitionBy("g", "m", "cell", "name", "rank", "half").orderBy("x")) - F.col("n")
    hit = met.withColumn("start", start).filter((F.col("rank") >= F.col("start")) & (F.col("rank") < F.col("start") + F.col("n")))
    found = hit.groupBy("g", "m").pivot("name", list(shares)).agg(F.avg("x"))
    label = F.element_at(F.array(*[F.lit(m) for m in metrics]), F.col("m") + 1)
    return found.join(named, "g").select(*keys, label.alias("metric"), *shares)


def rich_metrics(df: DataFrame, keys: Sequence[str] = KEYS, metrics: Sequence[str] = METRICS) -> DataFrame:
    """(keys, metric, count, n, mean, std, p10, p50, p90) in long form; std is that of a sample."""
    ranks = exact_quantiles(df, keys, metrics, {"p10": 0.1, "p50": 0.5, "p90": 0.9})
    plain = [F.struct(F.lit(m).alias("metric"), F.count(F.lit(1)).alias("count"), F.count(finite(m)).alias("n"), F.avg(finite(m)).alias("mean"), F.stddev_samp(finite(m)).alias("std")).alias(f"s{i}") for i, m in enumerate(metrics)]
    wide = df.groupBy(*keys).agg(*plain)
    long = wide.select(*keys, F.explode(F.array(*[F.col(f"s{i}") for i in range(len(metrics))])).alias("s")).select(*keys, "s.*")
    same = F.col("a.metric") == F.col("b.metric")
    for k in keys:
        same = same & F.col(f"a.{k}").eqNullSafe(F.col(f"b.{k}"))
    return long.alias("a").join(ranks.alias("b"), same, "left").select("a.*", "b.p10", "b.p50", "b.p90")


def hours_with_totals(df: DataFrame, hours: Column | None = None) -> DataFrame:
    """(language, corpus, hours): hours per language and corpus, and a row ``Total`` per language."""
    hours = finite("duration_sec") / 3600 if hours is None else hours
    rows = df.select("language", "corpus", hours.alias("h"))
    rolled = rows.groupingSets([[F.col("language"), F.col("corpus")], [F.col("language")]], "language", "corpus").agg(F.grouping("corpus").alias("g"), F.sum("h").alias("hours"))
    return rolled.select("language", F.when(F.col("g") == 1, F.lit("Total")).otherwise(F.col("corpus")).alias("corpus"), "hours")
