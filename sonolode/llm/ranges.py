"""Running counts and sums over sorted ranges of groups, and membership by a filter of fixed size.

Rows are range-sorted by group and order. Each task numbers and sums its own range and reports one row about the group
that its range ends in, as only that group can go on in the next range. From those rows, one per range, the driver works out what
each range has to add. No task ever holds more than its range, whatever share of the rows a group has.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sonolode.session import staged

#: Words of 64 bits of a membership filter: what is broadcast has at most so many rows of 12 bytes.
FILTER_WORDS = 1 << 19


def running(df: DataFrame, order: list[Column], weight: str, label: str) -> DataFrame:
    """``df`` with ``nth`` (from 0) and ``before`` (sum of ``weight`` of the earlier rows) within each ``g`` (bigint, not null).

    ``order`` must be without ties for a repeatable result, which then does not depend on where the ranges end.
    """
    names = df.columns
    ranged = df.repartitionByRange("g", *order).sortWithinPartitions("g", *order)
    at_g, at_w = names.index("g"), names.index(weight)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        first = last = schema = None
        n = total = 0
        for b in batches:
            if not b.num_rows:
                continue
            g, w = b.column(at_g).to_numpy(), b.column(at_w).to_numpy()
            new = np.flatnonzero(np.diff(g)) + 1
            starts = np.concatenate([[0], new])
            sizes = np.diff(np.concatenate([starts, [len(g)]]))
            if first is None:
                first, last, schema = int(g[0]), int(g[0]), b.schema
            if int(g[0]) != last:
                n = total = 0
            ends = np.cumsum(w)
            before = ends - w
            nth = np.arange(len(g)) - np.repeat(starts, sizes)
            own = before - np.repeat(before[starts], sizes)
            nth[: sizes[0]] += n
            own[: sizes[0]] += total
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(np.full(len(g), part, np.int32)), pa.array(nth), pa.array(own), pa.nulls(len(g), pa.int64())], names=[*names, "__part", "nth", "before", "__first"])
            last, n, total = int(g[-1]), int(nth[-1]) + 1, int(own[-1] + w[-1])
        if first is not None:
            rest = [pa.array([last], pa.int64()) if i == at_g else pa.nulls(1, f.type) for i, f in enumerate(schema)]
            yield pa.RecordBatch.from_arrays([*rest, pa.array([part], pa.int32()), pa.array([n], pa.int64()), pa.array([total], pa.int64()), pa.array([first], pa.int64())], names=[*names, "__part", "nth", "before", "__first"])

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)
    cut = staged(ranged.mapInArrow(run, f"{kinds}, __part int, nth bigint, before bigint, __first bigint"), label)
    edges = cut.filter("__first is not null").select("__part", "g", "nth", "before", "__first").orderBy("__part").collect()  # one row per range
    added, held, n, total = [], None, 0, 0
    for r in edges:
        if r["__first"] == held:
            added.append((r["__part"], held, n, total))
        goes_on = r["__first"] == held == r["g"]
        held, n, total = r["g"], r["nth"] + (n if goes_on else 0), r["before"] + (total if goes_on else 0)
    rows = cut.filter("__first is null").drop("__first")
    if not added:
        return rows.drop("__part")
    plus = df.sparkSession.createDataFrame(added, "__p int, __g bigint, __n bigint, __t bigint")
    both = rows.join(F.broadcast(plus), (F.col("__part") == F.col("__p")) & (F.col("g") == F.col("__g")), "left")  # at most one row per range
    return both.select(*names, (F.col("nth") + F.coalesce("__n", F.lit(0))).alias("nth"), (F.col("before") + F.coalesce("__t", F.lit(0))).alias("before"))


def among(rows: DataFrame, key: str, ids: DataFrame) -> DataFrame:
    """The rows whose ``key`` may occur in ``ids`` (one column): all that do, and few others.

    A filter of ``FILTER_WORDS`` * 64 bits, made by the executors, is broadcast, so that rows without a chance are dropped where
    they are read, before a join shuffles the rest. It never grows beyond that; when crowded it only lets more pass.
    """
    h = F.xxhash64(F.col(ids.columns[0]))
    word = F.pmod(F.shiftrightunsigned(h, 6), F.lit(FILTER_WORDS)).cast("int")
    bit = h.bitwiseAND(F.lit(63)).cast("int")
    bits = ids.select(word.alias("__word"), F.call_function("shiftleft", F.lit(1).cast("bigint"), bit).alias("__bit"))
    bits = bits.groupBy("__word").agg(F.bit_or("__bit").alias("__bits"))
    own = F.xxhash64(F.col(key))
    at = F.pmod(F.shiftrightunsigned(own, 6), F.lit(FILTER_WORDS)).cast("int")
    met = rows.withColumn("__at", at).join(F.broadcast(bits), F.col("__at") == F.col("__word"))
    return met.filter(F.getbit("__bits", own.bitwiseAND(F.lit(63)).cast("int")) == 1).select(*rows.columns)
