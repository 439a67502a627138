"""Problem 7: documents mixed to target shares of tokens, small sources repeated up to a cap.

A source's budget is its share of the total. It is met by complete epochs first, each taking every document once, and
the rest by weighted sampling without replacement after Efraimidis and Spirakis: each document draws an exponential
key scaled by its quality weight, -ln(u) / w, and the documents with the lowest keys are taken until their tokens,
summed in key order, reach the rest. The draws are hashes of doc_id and seed, so the choice is repeatable.

The running sum over a source, however large, is made of sums over ranges of its keys, one row per range, and running
sums within each range. The ranges are quantiles of the keys themselves, so they are even whatever the weights are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sonolode.functions.names import corpus_name
from sonolode.llm.budget import count_tokens
from sonolode.llm.ranges import running
from sonolode.session import staged

#: The lowest quality weight.
LEAST_WEIGHT = 0.05


def quality_weight(text: Column) -> Column:
    """Between ``LEAST_WEIGHT`` and 1: the share of letters, marks and blanks, lowered for texts under 100 characters."""
    size = F.length(text)
    plain = F.length(F.regexp_replace(text, r"[^\p{L}\p{M} ]", ""))
    return F.greatest(F.lit(LEAST_WEIGHT), F.coalesce(plain / F.nullif(size, F.lit(0)) * F.least(F.lit(1.0), size / F.lit(100.0)), F.lit(0.0)))


def sized_documents(documents: DataFrame, **options) -> DataFrame:
    """(doc_id, source, weight, n_tokens) of the documents that have tokens, staged."""
    carry = {"source": corpus_name("source"), "weight": quality_weight(F.col("text").cast("string"))}
    return staged(count_tokens(documents, "doc_id", "text", carry, **options).filter("n_tokens > 0"), "sized")


def budgets(sized: DataFrame, targets: DataFrame, total_tokens: int | None = None) -> DataFrame:
    """(source, target_share, max_repeats, available, total, epochs, rest): what to take of each target source.

    ``total_tokens`` defaults to the largest total at which every source with documents can give its share under its cap, or
    where nothing is capped to the tokens that the target sources hold together. With a larger total given, a source still never gives more
    than max_repeats times its tokens (no limit where null, nothing where below 1); what it falls short is not made up by
    others, which keep their shares among each other. Targets of a null source or a null, negative or not finite share are left out;
    of a source listed twice the shares are added and the lower cap holds.
    """
    wanted = targets.select(corpus_name("source").alias("source"), F.col("target_share").cast("double").alias("share"), F.col("max_repeats").cast("bigint").alias("cap"))
    wanted = wanted.filter("source is not null and share >= 0 and share < double('Infinity')").groupBy("source").agg(F.sum("share").alias("target_share"), F.min("cap").alias("max_repeats"))
    held = sized.groupBy("source").agg(F.sum("n_tokens").alias("available"))
    both = wanted.join(held, "source", "left").withColumn("available", F.coalesce("available", F.lit(0)))
    every = Window.partitionBy(F.lit(1))  # one row per target source
    can = F.when((F.col("available") > 0) & (F.col("target_share") > 0) & (F.col("max_repeats") >= 1), F.col("max_repeats") * F.col("available") / F.col("target_share"))
    total = F.lit(total_tokens) if total_tokens is not None else F.coalesce(F.floor(F.min(can).over(every)), F.sum("available").over(every))
    goal = F.round(F.col("target_share") * F.col("total")).cast("bigint")
    most = F.when(F.col("max_repeats").isNull(), goal).otherwise(F.least(goal, F.greatest("max_repeats", F.lit(0)) * F.col("available")))
    take = F.when(F.col("available") > 0, most).otherwise(0)
    planned = both.withColumn("total", total.cast("bigint")).withColumn("take", take)
    epochs = F.when(F.col("available") > 0, F.floor(F.col("take") / F.col("available"))).otherwise(0).cast("bigint")
    return planned.withColumn("epochs", epochs).withColumn("rest", F.col("take") - F.col("epochs") * F.col("available")).drop("take")


def choose(sized: DataFrame, plan: DataFrame, seed: int = 1) -> DataFrame:
    """(doc_id, source, n_tokens, repeats): the documents of the mix and how often each occurs.

    A document stands at most max_repeats times. The last one taken of a rest is the one that brings the sum nearest
    to it. Equal keys, as of repeated rows, go by doc_id and size.
    """
    draw = (F.conv(F.substring(F.sha2(F.concat_ws(":", F.lit(str(seed)), F.col("doc_id").cast("string")), 256), 1, 13), 16, 10).cast("double") + F.lit(0.5)) / F.lit(float(1 << 52))
    # one row per target source, numbered so that sources are compared by number
    wanted = plan.select("source", "epochs", "rest", F.row_number().over(Window.partitionBy(F.lit(1)).orderBy("source")).cast("bigint").alias("g"))
    keyed = sized.join(wanted, "source").withColumn("key", F.round(-F.log(draw) / F.col("weight"), 9))
    ranged = running(keyed.select("g", "doc_id", "source", "n_tokens", "epochs", "rest", "key"), [F.col("key"), F.col("doc_id"), F.col("n_tokens")], "n_tokens", "keyed")
    extra = ((F.col("before") + F.col("n_tokens") / 2 <= F.col("rest")) & (F.col("rest") > 0)).cast("bigint")
    mixed = ranged.withColumn("repeats", F.col("epochs") + extra)
    return mixed.filter("repeats > 0").select("doc_id", "source", "n_tokens", "repeats")


def mix(documents: DataFrame, targets: DataFrame, total_tokens: int | None = None, seed: int = 1, **options) -> tuple[DataFrame, DataFrame]:
    """(choice, shares): the documents of the mix with their repeats, and what each source was to give and gives.

    Null and empty texts have no tokens and are never chosen; nor are sources without a target. shares has a row for
    every target, with zeros where a source has no documents; actual_share is null if nothing at all was chosen.
    """
    sized = sized_documents(documents, **options)
    plan = budgets(sized, targets, total_tokens)
    chosen = choose(sized, plan, seed)
    given = chosen.groupBy("source").agg(F.count(F.lit(1)).alias("documents"), F.sum("repeats").alias("copies"), F.sum(F.col("repeats") * F.col("n_tokens")).alias("tokens"), F.max("repeats").alias("most_repeats"))
    zero = [F.coalesce(c, F.lit(0)).alias(c) for c in ("documents", "copies", "tokens", "most_repeats")]
    every = Window.partitionBy(F.lit(1))  # one row per target source
    shares = plan.join(given, "source", "left").select("source", "target_share", "max_repeats", "available", "total", *zero)
    return chosen, shares.withColumn("actual_share", F.try_divide("tokens", F.sum("tokens").over(every)))
