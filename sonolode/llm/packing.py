"""Problem 1: clips combined into containers of fixed capacity, by bulk-synchronous best fit.

Clips come in order of size: first those of which one fits into a container, then those of which two do, and so on,
from eight on in classes of twice as many. In each class supersteps run until no gap takes a clip any more:

1. Sort. The clips of the class that are not yet placed and the gaps that can hold one are sorted together by size.
2. Sweep. From the largest down, every clip goes to its successor among the gaps, the smallest that holds it. Where clips
   have the same successor, rank decides: the largest takes it, the next the next larger gap that is free. A gap that holds
   several clips of any size in the class stands there as that many places.
3. Update. What was placed leaves its gap smaller; the gaps that changed and the clips that are left make the next superstep.

Clips that no gap takes open containers, by rank: as many a container as always fit, or from eight on as many as their
running sum says; those that the sum would divide go back to step 1.

A range-sorted sweep is distributed: each task matches within its range, which leaves it clips without a gap above them and
gaps without a clip below. Ranges hand these on to one another by their numbers alone, two rows a range, and
the rows meet by rank. The result is that of one sweep over the whole group and does not depend on where ranges end. So groups
of up to ``WHOLE`` clips, which lie in one range anyway, run their supersteps in place and give what they would give
in many ranges.

Sizes are whole units of their measure, rounded up, and capacities rounded down, so that no container is over-full by rounding.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sonolode.functions.names import corpus_name, language_code
from sonolode.llm.ranges import running
from sonolode.session import staged

#: Clips of a group that are packed in place; larger groups take many ranges, with the same result.
WHOLE = 100_000
#: From so many clips a container on, a class has twice as many as the one before.
MANY = 8
#: Parts of one clip over the capacity that one row is expanded into at a time.
STRETCH = 10_000
#: Sizes in whole units are exact below this.
EXACT = float(1 << 53)


def class_of(sizes: np.ndarray, capacity: int) -> np.ndarray:
    """The class of each size: how many of it fit into a container; from ``MANY`` on the power of two."""
    fit = capacity // sizes
    return np.where(fit < MANY, fit, MANY - 3 + np.frexp(fit.astype(float))[1] - 1)


def _class_column() -> Column:
    fit = F.expr("capacity div size")
    return F.when(fit < MANY, fit).otherwise(MANY - 3 + F.length(F.bin(fit)) - 1).cast("int")


def class_bounds(kind: int) -> tuple[int, int]:
    """Of the sizes in a class at least the first, and less than the second number fit into a container."""
    return (kind, kind + 1) if kind < MANY else (1 << kind - MANY + 3, 1 << kind - MANY + 4)


def successors(is_clip: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(gaps, clips): positions of the pairs that one sweep makes of gaps and clips sorted by size, largest first.

    A clip takes the nearest free gap before it. As with brackets, that is the one that opened the depth which the clip closes.
    """
    depth = np.cumsum(np.where(is_clip, -1, 1))
    lowest = np.minimum.accumulate(np.minimum(depth, 0))
    free = is_clip & (depth < np.concatenate([[0], lowest[:-1]]))  # no gap is left above it
    at = np.flatnonzero(~free)
    clip = is_clip[at]
    depth = np.cumsum(np.where(clip, -1, 1))
    level = depth + clip
    order = np.lexsort((at, level))
    second = clip[order]
    hit = np.flatnonzero(second)
    return at[order[hit - 1]], at[order[hit]]


def _places(rooms: np.ndarray, most: int, clips: int) -> np.ndarray:
    """How many clips of a class whose largest is ``most`` each gap has places for, if there are ``clips``."""
    return np.clip(rooms // most, 1, max(1, clips))


def pack(sizes: np.ndarray, capacity: int) -> np.ndarray:
    """The container, numbered from 0, of each of the ``sizes``, which are sorted, largest first."""
    where = np.full(len(sizes), -1, np.int64)
    rooms = np.empty(0, np.int64)
    kinds = class_of(sizes, capacity)
    for kind in np.unique(kinds):
        few, more = class_bounds(int(kind))
        most, least = capacity // few, capacity // more + 1
        left = np.flatnonzero(kinds == kind)
        active = np.flatnonzero(rooms >= least)
        while len(left):
            while len(left) and len(active):
                n = _places(rooms[active], most, len(left))
                bins = np.repeat(active, n)
                nth = np.arange(len(bins)) - np.repeat(np.cumsum(n) - n, n)
                value = np.where(nth + 1 < np.repeat(n, n), most, np.repeat(rooms[active] - (n - 1) * most, n))
                every = np.concatenate([value, sizes[left]])
                clip = np.arange(len(every)) >= len(value)
                order = np.lexsort((np.concatenate([nth, np.zeros(len(left), np.int64)]), np.concatenate([bins, left]), clip, -every))
                gap, taker = successors(clip[order])
                if not len(gap):
                    break
                into, who = bins[order[gap]], left[order[taker] - len(value)]
                where[who] = into
                np.subtract.at(rooms, into, sizes[who])
                left = left[where[left] < 0]
                active = np.unique(into)
                active = active[rooms[active] >= least]
            if not len(left):
                break
            base = len(rooms)
            if kind < MANY:
                run, held = np.arange(len(left)) // few, np.ones(len(left), bool)
            else:
                ends = np.cumsum(sizes[left])
                run = (ends - sizes[left]) // capacity
                held = run == (ends - 1) // capacity
            where[left[held]] = base + run[held]
            rooms = np.concatenate([rooms, np.full(int(run[held].max()) + 1, capacity, np.int64)])
            np.subtract.at(rooms, base + run[held], sizes[left[held]])
            active = base + np.flatnonzero(rooms[base:] >= least)
            left = left[~held]
    return where


def _pack_whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (g, capacity, size, uid), sorted by g, size downwards and uid, to rows (g, uid, number)."""
    held: list[pa.RecordBatch] = []

    def done() -> pa.RecordBatch:
        t = pa.Table.from_batches(held)
        number = pack(t.column("size").to_numpy(), t.column("capacity")[0].as_py())
        held.clear()
        return pa.RecordBatch.from_arrays([t.column("g").combine_chunks(), t.column("uid").combine_chunks(), pa.array(number)], names=["g", "uid", "number"])

    now = None
    for b in batches:
        g = b.column(0).to_numpy()
        cuts = [0, *(np.flatnonzero(np.diff(g)) + 1).tolist(), len(g)]
        for start, end in zip(cuts, cuts[1:]):
            if start == end:
                continue
            if held and g[start] != now:
                yield done()
            now = g[start]
            held.append(b.slice(start, end - start))
    if held:
        yield done()


# Rows of a sweep: what 0 a free place at the end of a range, 1 a clip that is left, 2 a clip and the container it goes to,
# 3 the numbers of clips left (nth) and places free (size) of the first or last group of a range, 4 those of clips left (nth) and placed (size).
_SWEPT = "what int, g bigint, part int, nth bigint, number bigint, uid bigint, size bigint"


def _sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (g, value, clip, id, nth), sorted by g, value downwards, gaps before clips, to rows of ``_SWEPT``."""
    part = TaskContext.get().partitionId()
    rows = [b for b in batches if b.num_rows]
    if not rows:
        return
    t = pa.Table.from_batches(rows)
    g, value, clip, ids = (t.column(i).to_numpy() for i in range(4))
    clip = clip == 1
    cuts = [0, *(np.flatnonzero(np.diff(g)) + 1).tolist(), len(g)]

    def out(what: int, group: int, nth, number, uid, size) -> pa.RecordBatch:
        n = len(nth)
        fill = lambda x: pa.nulls(n, pa.int64()) if x is None else pa.array(np.asarray(x, np.int64))
        return pa.RecordBatch.from_arrays([pa.array(np.full(n, what, np.int32)), pa.array(np.full(n, group, np.int64)), pa.array(np.full(n, part, np.int32)), fill(nth), fill(number), fill(uid), fill(size)], names=["what", "g", "part", "nth", "number", "uid", "size"])

    n_left = n_placed = 0
    for k, (start, end) in enumerate(zip(cuts, cuts[1:])):
        group, of_clip = int(g[start]), clip[start:end]
        gap, taker = successors(of_clip)
        if len(gap):
            yield out(2, group, np.zeros(len(gap)), ids[start + gap], ids[start + taker], value[start + taker])
        rest = np.ones(end - start, bool)
        rest[gap] = rest[taker] = False
        left = start + np.flatnonzero(rest & of_clip)
        if len(left):
            yield out(1, group, np.arange(len(left)), None, ids[left], value[left])
        if k == 0 or k == len(cuts) - 2:
            free = start + np.flatnonzero(rest & ~of_clip)[::-1]  # the smallest first, as clips below will take them
            if len(free) and k == len(cuts) - 2:
                yield out(0, group, np.arange(len(free)), ids[free], None, value[free])
            yield out(3, group, [len(left)], None, None, [len(free)])
        n_left, n_placed = n_left + len(left), n_placed + len(gap)
    yield out(4, int(g[0]), [n_left], None, None, [n_placed])


def _handed_on(edges: list) -> list[tuple[int, int, int, int, int, int]]:
    """(clip's part, first nth, one past the last, group, place's part, nth of the first place) from the rows 3 of a sweep."""
    stack: list[list[int]] = []  # [part, free places, places taken] of the group
    out, now = [], None
    for r in sorted(edges, key=lambda r: (r["part"], r["g"] != now)):
        if r["g"] != now:
            stack, now = [], r["g"]
        done = 0
        while done < r["nth"] and stack:
            part, free, taken = stack[-1]
            n = min(r["nth"] - done, free)
            out.append((r["part"], done, done + n, r["g"], part, taken))
            done += n
            stack[-1] = [part, free - n, taken + n]
            if not stack[-1][1]:
                stack.pop()
        if r["size"]:
            stack.append([r["part"], r["size"], 0])
    return out


class _Packing:
    """The state of the groups that take many ranges, as staged tables."""

    def __init__(self, units: DataFrame):
        self.spark = units.sparkSession
        self.units = staged(units.withColumn("kind", _class_column()), "units", by=("kind",))
        self.capacity = staged(units.groupBy("g").agg(F.first("capacity").alias("capacity")), "capacities")
        self.placed: list[DataFrame] = []
        self.gaps: DataFrame | None = None  # (g, number, room)
        self.opened = self.capacity.select("g", F.lit(0).cast("bigint").alias("base"))

    def run(self) -> DataFrame:
        """(g, uid, number)."""
        for r in self.units.select("kind").distinct().orderBy("kind").collect():  # a few dozen at most
            self._class(r["kind"])
        out = self.placed[0]
        for more in self.placed[1:]:
            out = out.unionByName(more)
        return out.select("g", "uid", "number")

    def _class(self, kind: int) -> None:
        few, more = class_bounds(kind)
        most, least = F.expr(f"capacity div {few}"), F.expr(f"capacity div {more} + 1")
        left = self.units.filter(F.col("kind") == kind).select("g", "uid", "size")
        active = self.gaps.join(self.capacity, "g").filter(F.col("room") >= least).select("g", "number", "room") if self.gaps is not None else None
        first = len(self.placed)
        fresh: list[DataFrame] = []
        while True:
            n_left = 1
            while active is not None:
                placed, left, n_left = self._superstep(left, active, most)
                if placed is None:
                    break
                self.placed.append(placed)
                if not n_left:
                    break
                gone = placed.groupBy("g", "number").agg(F.sum("size").alias("gone"))
                active = active.join(gone, ["g", "number"]).withColumn("room", F.col("room") - F.col("gone")).join(self.capacity, "g").filter(F.col("room") >= least).select("g", "number", "room")
                active = staged(active, "active")
                if active.isEmpty():
                    break
            if not n_left:
                break
            opened, left = self._open(left, kind, few)
            self.placed.append(opened)
            new = opened.groupBy("g", "number").agg(F.sum("size").alias("gone")).join(self.capacity, "g").select("g", "number", (F.col("capacity") - F.col("gone")).alias("room"))
            fresh.append(opened.select("g", "number").distinct())
            if kind < MANY:
                break
            active = staged(new.join(self.capacity, "g").filter(F.col("room") >= least).select("g", "number", "room"), "active")
            if left.isEmpty():
                break
        now = self.gaps
        for numbers in fresh:
            begun = numbers.join(self.capacity, "g").select("g", "number", F.col("capacity").alias("room"))
            now = begun if now is None else now.unionByName(begun)
        taken = self.placed[first]
        for more_placed in self.placed[first + 1 :]:
            taken = taken.unionByName(more_placed)
        gone = taken.groupBy("g", "number").agg(F.sum("size").alias("gone"))
        rest = now.join(gone, ["g", "number"], "left").select("g", "number", (F.col("room") - F.coalesce("gone", F.lit(0))).alias("room")).filter("room > 0")
        self.gaps = staged(rest, "gaps")

    def _superstep(self, left: DataFrame, active: DataFrame, most: Column) -> tuple[DataFrame | None, DataFrame, int]:
        """((g, number, uid, size) or none if no gap took a clip, (g, uid, size) that are left, how many are)."""
        counts = left.groupBy("g").agg(F.count(F.lit(1)).alias("clips"))
        gaps = active.join(counts, "g").join(self.capacity, "g").withColumn("most", most)
        gaps = gaps.withColumn("n", F.greatest(F.lit(1), F.least(F.expr("room div most"), "clips")))
        places = gaps.select("g", "number", "n", "most", "room", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("n") - 1)).alias("nth"))
        value = F.when(F.col("nth") + 1 < F.col("n"), F.col("most")).otherwise(F.col("room") - (F.col("n") - 1) * F.col("most"))
        rows = places.select("g", value.alias("value"), F.lit(0).alias("clip"), F.col("number").alias("id"), "nth")
        rows = rows.unionByName(left.select("g", F.col("size").alias("value"), F.lit(1).alias("clip"), F.col("uid").alias("id"), F.lit(0).cast("bigint").alias("nth")))
        order = ["g", F.col("value").desc(), "clip", "id", "nth"]
        swept = staged(rows.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(_sweep, _SWEPT), "swept")
        told = swept.filter("what >= 3").distinct().collect()  # three rows a range
        edges = [r for r in told if r["what"] == 3]
        n_left, n_placed = (sum(r[c] for r in told if r["what"] == 4) for c in ("nth", "size"))
        placed = swept.filter("what = 2").select("g", "number", "uid", "size")
        rest = swept.filter("what = 1")
        crossing = _handed_on(edges)
        if crossing:
            spans = self.spark.createDataFrame(crossing, "p int, lo bigint, hi bigint, q bigint, at int, first bigint")
            met = rest.join(F.broadcast(spans), (F.col("part") == F.col("p")) & (F.col("g") == F.col("q")) & (F.col("nth") >= F.col("lo")) & (F.col("nth") < F.col("hi")), "left")  # as many rows as ranges
            met = staged(met.select("g", "uid", "size", F.col("at").alias("part"), (F.col("first") + F.col("nth") - F.col("lo")).alias("nth")), "handed-on")
            free = swept.filter("what = 0").select("g", "part", "nth", "number")
            across = met.filter("part is not null").join(free, ["g", "part", "nth"]).select("g", "number", "uid", "size")
            return placed.unionByName(staged(across, "placed")), met.filter("part is null").select("g", "uid", "size"), n_left - sum(hi - lo for _, lo, hi, *_ in crossing)
        return placed if n_placed else None, rest.select("g", "uid", "size"), n_left

    def _open(self, left: DataFrame, kind: int, few: int) -> tuple[DataFrame, DataFrame]:
        """((g, number, uid, size) in new containers, (g, uid, size) that are left)."""
        ranked = running(left, [F.col("size").desc(), F.col("uid")], "size", "ranked").join(self.capacity, "g").join(self.opened, "g")
        if kind < MANY:
            run, held = F.expr(f"nth div {few}"), F.lit(True)
        else:
            run = F.expr("before div capacity")
            held = run == F.expr("(before + size - 1) div capacity")
        out = staged(ranked.select("g", (F.col("base") + run).alias("number"), "uid", "size", held.alias("held")), "opened")
        most = out.filter("held").groupBy("g").agg((F.max("number") + 1).alias("most"))
        self.opened = staged(self.opened.join(most, "g", "left").select("g", F.coalesce("most", "base").alias("base")), "numbers")
        return out.filter("held").drop("held"), out.filter("not held").select("g", "uid", "size")


def pack_units(units: DataFrame) -> DataFrame:
    """(g, uid, number) for units (g, capacity, uid, size), each size within its capacity and each (g, uid) once."""
    counts = units.groupBy("g").agg(F.count(F.lit(1)).alias("clips"))
    hot = staged(counts.filter(F.col("clips") > WHOLE).select("g"), "hot")  # one row per WHOLE rows at most
    some = not hot.isEmpty()
    cold = units.join(hot, "g", "left_anti") if some else units
    spread = cold.select("g", "capacity", "size", "uid").repartition("g").sortWithinPartitions("g", F.col("size").desc(), "uid")
    packed = spread.mapInArrow(_pack_whole, "g bigint, uid bigint, number bigint")
    if not some:
        return packed
    return packed.unionByName(_Packing(units.join(hot, "g", "left_semi")).run())


def clips(utterances: DataFrame, containers: DataFrame, keys: dict[str, Column], measures: dict[str, tuple[Column, float]]) -> DataFrame:
    """(g, container, keys, uid, utt_id, size, room, capacity, units): every usable clip under every container that measures it, staged.

    ``measures``: the size and the number of units that it is counted in, by field. A record counts once, however often it was
    delivered; rows without utt_id count each. Usable sizes are finite, above zero and below 2**53 units, beyond which they
    are not exact. Null keys form groups of their own. Containers whose capacity is null, not finite or
    not positive, or whose field is unknown, take nothing; a container listed twice counts once.
    """
    rows = utterances.select(F.col("utt_id").cast("bigint"), *[c.alias(k) for k, c in keys.items()], *[c.cast("double").alias(f"m{i}") for i, (c, _) in enumerate(measures.values())])
    body = F.struct(*keys, *[f"m{i}" for i in range(len(measures))])
    once = rows.filter("utt_id is not null").groupBy("utt_id").agg(F.min(body).alias("r")).select(F.col("utt_id").alias("uid"), "utt_id", "r.*")
    nameless = rows.filter("utt_id is null").select((F.lit(-(1 << 62)) - F.monotonically_increasing_id()).alias("uid"), "*")
    each = F.array(*[F.struct(F.lit(name).alias("field"), F.col(f"m{i}").alias("size"), F.lit(float(scale)).alias("scale")) for i, (name, (_, scale)) in enumerate(measures.items())])
    melted = once.unionByName(nameless).select("uid", "utt_id", *keys, F.explode(each).alias("m")).select("uid", "utt_id", *keys, "m.*")
    fine = containers.groupBy("container", "field").agg(F.min("capacity").alias("room")).filter("room > 0 and room < double('Infinity') and not isnan(room)")
    usable = melted.filter("size > 0 and not isnan(size) and size < double('Infinity')").filter(F.col("size") * F.col("scale") < EXACT)
    exact = usable.join(fine, "field").withColumn("capacity", F.floor(F.least(F.col("room") * F.col("scale"), F.lit(EXACT))).cast("bigint")).withColumn("units", F.ceil(F.col("size") * F.col("scale")).cast("bigint")).filter("capacity > 0")
    return staged(exact.select(F.xxhash64("container", *keys).alias("g"), "container", *keys, "uid", "utt_id", "size", "scale", "room", "capacity", "units"), "clips")


def pack_clips(utterances: DataFrame, containers: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(placements, fills) of the clips of each corpus, split and language in each kind of container.

    placements: container, corpus, split, language, utt_id, part, size, container_no; one row per clip and kind, but for clips over
    the capacity, which have one row per part: full ones, then the rest (part counts from 0). fills: container, corpus,
    split, language, container_no, n_parts, fill, capacity. An empty table gives empty results.
    """
    keys = {"corpus": corpus_name("corpus"), "split": F.nullif(F.lower(F.trim("split")), F.lit("")), "language": language_code("language")}
    measures = {"duration_sec": (F.col("duration_sec"), 1e6), "audio.bytes": (F.octet_length("audio.bytes"), 1.0)}
    names = ["container", *keys]
    given = clips(utterances, containers, keys, measures)
    whole = F.expr("units div capacity")
    rest = F.col("units") - whole * F.col("capacity")
    units = given.select("g", "capacity", "uid", rest.alias("size")).filter("size > 0")
    placed = staged(pack_units(units), "numbers-of-clips")
    of_rest = F.when(whole > 0, F.col("size") - whole * F.col("room")).otherwise(F.col("size"))
    columns = ["g", *names, "utt_id", "part", "size", "container_no"]
    rests = given.join(placed, ["g", "uid"]).select("g", *names, "utt_id", whole.alias("part"), of_rest.alias("size"), F.col("number").alias("container_no"), rest.alias("u"), "scale", "room")
    # full parts take the numbers after those of the packed containers
    packed = placed.groupBy("g").agg((F.max("number") + 1).alias("packed"))
    parts = _full_parts(given.filter(F.col("units") >= F.col("capacity")).withColumn("whole", whole), packed, names)
    placements = rests.select(columns).unionByName(parts.select(columns)).drop("g")
    filled = rests.groupBy("g", "container_no").agg(*[F.first(c).alias(c) for c in names], F.count(F.lit(1)).alias("n_parts"), (F.sum("u") / F.first("scale")).alias("fill"), F.first("room").alias("capacity"))
    full = parts.select(*names, "container_no", F.lit(1).cast("bigint").alias("n_parts"), F.col("size").alias("fill"), F.col("size").alias("capacity"))
    return placements, filled.select(full.columns).unionByName(full)


def _full_parts(long: DataFrame, packed: DataFrame, names: list[str]) -> DataFrame:
    """A row and a container for each full part of the clips over the capacity."""
    found = running(long.select("g", *names, "uid", "utt_id", "room", "whole"), [F.col("uid")], "whole", "over-capacity")
    first = found.join(packed, "g", "left").withColumn("first", F.coalesce("packed", F.lit(0)) + F.col("before"))
    short = first.filter(F.col("whole") <= STRETCH).withColumn("lo", F.lit(0).cast("bigint"))
    # a clip of many parts is cut into stretches, which go to different tasks
    cut = first.filter(F.col("whole") > STRETCH).withColumn("lo", F.explode(F.expr(f"sequence(0L, whole - 1, {STRETCH}L)"))).repartition("g", "uid", "lo")
    rows = short.unionByName(cut).withColumn("part", F.explode(F.expr(f"sequence(lo, least(lo + {STRETCH}L, whole) - 1)")))
    return rows.select("g", *names, "utt_id", "part", F.col("room").alias("size"), (F.col("first") + F.col("part")).alias("container_no"))
