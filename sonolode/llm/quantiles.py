"""Problem 4: percentiles per group from mergeable sketches with a stated rank-error bound.

A sketch is a hierarchy of compactors. Level h keeps values that stand for 2**h originals each; a level that
overflows is sorted and every other value, from a random start, moves up. One compaction at level h shifts the
rank of any value by -2**h, 0 or 2**h, with mean zero and independently of the others, so with v the sum of 4**h
over all compactions the rank error exceeds sqrt(2 v ln(2 / delta)) with probability at most delta (Hoeffding).
A sketch carries v along, and every answer states that bound over n. A sketch that never overflowed is exact.
Random starts come from a hash of the group, the task, its first values and a counter: tasks throw independent coins, and a task that is
rerun on the same rows throws its own again.
"""

from __future__ import annotations

import math
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sonolode.functions.names import corpus_name

#: Values kept by the top level; lower levels keep fewer, never under FLOOR.
K = 1024
FLOOR = 64
SHRINK = 2 / 3
#: Probability with which an answer may lie beyond its stated bound.
DELTA = 0.01
PERCENTILES = (1, 5, 10, 25, 50, 75, 90, 95, 99)
#: Rows that a task sorts into its sketches at a time, and values in sketches that it holds before it passes them on.
ROWS, HELD = 1 << 17, 1 << 22
#: Sketches of one group that a merge holds at a time.
_AT_ONCE = 64


class Sketch:
    """A compactor hierarchy over finite doubles."""

    __slots__ = ("k", "seed", "n", "v", "low", "high", "levels")

    def __init__(self, k: int = K, seed: int = 0):
        self.k, self.seed, self.n, self.v = k, seed, 0, 0.0
        self.low, self.high, self.levels = math.inf, -math.inf, [np.empty(0)]

    def _cap(self, h: int) -> int:
        return max(FLOOR, math.ceil(self.k * SHRINK ** (len(self.levels) - 1 - h)))

    def add(self, values: np.ndarray) -> Sketch:
        if len(values):
            self.n += len(values)
            self.low, self.high = min(self.low, float(values.min())), max(self.high, float(values.max()))
            self.levels[0] = np.concatenate([self.levels[0], values]) if len(self.levels[0]) else np.array(values, dtype=float)
            self._compact()
        return self

    def merge(self, others: list[Sketch]) -> Sketch:
        """Take in ``others`` level by level, then compact once."""
        if not others:
            return self
        every = [self, *others]
        height = max(len(s.levels) for s in every)
        self.levels = [np.concatenate([s.levels[h] for s in every if h < len(s.levels)]) for h in range(height)]
        self.n, self.v = sum(s.n for s in every), sum(s.v for s in every)
        self.low, self.high = min(s.low for s in every), max(s.high for s in every)
        for s in others:
            self.seed = (self.seed * 1_000_003 + s.seed + 1) & 0xFFFFFFFF
        self._compact()
        return self

    def _compact(self) -> None:
        h = 0
        while h < len(self.levels):
            kept = self.levels[h]
            if len(kept) > self._cap(h):
                kept = np.sort(kept)
                odd = kept[len(kept) - len(kept) % 2 :]
                self.seed = zlib.crc32(struct.pack("<IIq", self.seed, h, self.n))
                up = kept[self.seed >> 7 & 1 : len(kept) - len(odd) : 2]
                self.levels[h] = odd
                if h + 1 == len(self.levels):
                    self.levels.append(np.empty(0))
                self.levels[h + 1] = np.concatenate([self.levels[h + 1], up])
                self.v += 4.0**h
            h += 1

    def bound(self, delta: float = DELTA) -> float:
        """Rank error as a share of n that is exceeded with probability ``delta`` at most."""
        return min(1.0, math.sqrt(2 * self.v * math.log(2 / delta)) / self.n) if self.n else 0.0

    def quantiles(self, shares: list[float]) -> list[float | None]:
        """For each share q the value of rank ceil(q n), the lowest for q = 0; None of an empty sketch."""
        if not self.n:
            return [None] * len(shares)
        values = np.concatenate(self.levels)
        weights = np.repeat(2.0 ** np.arange(len(self.levels)), [len(x) for x in self.levels])
        order = np.argsort(values, kind="stable")
        ends = np.cumsum(weights[order])
        at = np.searchsorted(ends, np.maximum(1, np.ceil(np.array(shares) * ends[-1] - 1e-9)))
        return [self.low if q <= 0 else self.high if q >= 1 else float(values[order[i]]) for q, i in zip(shares, np.minimum(at, len(values) - 1))]

    def dump(self) -> bytes:
        sizes = [len(x) for x in self.levels]
        head = struct.pack(f"<IIqdddI{len(sizes)}I", self.k, self.seed, self.n, self.v, self.low, self.high, len(sizes), *sizes)
        return head + b"".join(x.astype("<f8").tobytes() for x in self.levels)

    @classmethod
    def load(cls, data: bytes) -> Sketch:
        s = cls()
        s.k, s.seed, s.n, s.v, s.low, s.high, height = struct.unpack_from("<IIqdddI", data)
        at = struct.calcsize("<IIqdddI")
        sizes = struct.unpack_from(f"<{height}I", data, at)
        values = np.frombuffer(data, dtype="<f8", offset=at + 4 * height)
        s.levels = np.split(values, np.cumsum(sizes)[:-1])
        return s


def _codes(column: pa.Array) -> np.ndarray:
    return column.dictionary_encode(null_encoding="encode").indices.to_numpy(zero_copy_only=False)


def partial_sketches(df: DataFrame, keys: list[str], values: list[str], k: int = K) -> DataFrame:
    """(keys, metric, n, sketch) of each task's rows; null, NaN and infinite values are left out.

    A task holds ``ROWS`` rows and the levels of its sketches; where many groups make these too many, it passes them on and begins anew.
    """
    kinds = {f.name: f.dataType.simpleString() for f in df.select(*keys).schema}

    def feed(rows: list[pa.RecordBatch], sketches: dict[tuple, Sketch]) -> int:
        """Sort rows into the sketches; how many values these took."""
        table = pa.Table.from_batches(rows).combine_chunks()
        code = np.zeros(table.num_rows, dtype=np.int64)
        for name in keys:
            c = _codes(table.column(name).combine_chunks())
            _, code = np.unique(code * (int(c.max()) + 1) + c, return_inverse=True)
        order = np.argsort(code, kind="stable")
        cuts = np.flatnonzero(np.diff(code[order])) + 1
        groups = list(zip(*(table.column(c).take(pa.array(order[np.concatenate([[0], cuts])])).to_pylist() for c in keys))) if keys else [()]
        taken = 0
        for m in values:
            x = table.column(m).cast(pa.float64()).fill_null(float("nan")).to_numpy()[order] + 0.0  # -0.0 becomes 0.0
            for group, part in zip(groups, np.split(x, cuts)):
                part = part[np.isfinite(part)]
                if len(part):
                    taken += len(part)
                    s = sketches.get((*group, m))
                    if s is None:
                        told = repr((group, m, TaskContext.get().partitionId() if TaskContext.get() else 0)).encode() + part[:64].tobytes()
                        s = sketches[(*group, m)] = Sketch(k, zlib.crc32(told))
                    s.add(part)
        return taken

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sketches: dict[tuple, Sketch] = {}
        rows: list[pa.RecordBatch] = []
        held = size = 0
        types: list[pa.DataType] = []

        def out() -> Iterator[pa.RecordBatch]:
            every = list(sketches.items())
            sketches.clear()
            for i in range(0, len(every), 500):
                part = every[i : i + 500]
                columns = [pa.array([key[j] for key, _ in part], t) for j, t in enumerate(types)]
                yield pa.RecordBatch.from_arrays([*columns, pa.array([key[-1] for key, _ in part], pa.string()), pa.array([s.n for _, s in part], pa.int64()), pa.array([s.dump() for _, s in part], pa.binary())], names=[*keys, "metric", "n", "sketch"])

        for b in batches:
            if not b.num_rows:
                continue
            types = types or [b.schema.field(c).type for c in keys]
            rows.append(b)
            size += b.num_rows
            if size >= ROWS:
                held += feed(rows, sketches)
                rows, size = [], 0
                if held >= HELD and sum(len(x) for s in sketches.values() for x in s.levels) >= HELD:
                    yield from out()
                    held = 0
        if rows:
            feed(rows, sketches)
        yield from out()

    schema = ", ".join(f"`{n}` {t}" for n, t in kinds.items()) + ", metric string, n bigint, sketch binary"
    return df.select(*keys, *values).mapInArrow(run, schema)


def merge_sketches(parts: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, metric, n, sketch): the sketches of each group and metric in one, at most 64 in memory at a time."""
    by = [*keys, "metric"]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in parts.select(*by, "n", "sketch").schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held, out = None, [], []

        def fold() -> None:
            held[:] = [held[0].merge(held[1:])]

        def batch() -> pa.RecordBatch:
            done = pa.RecordBatch.from_arrays([*(pa.array([k[i] for k, _ in out], kinds.field(i).type) for i in range(len(by))), pa.array([s.n for _, s in out], pa.int64()), pa.array([s.dump() for _, s in out], pa.binary())], names=[*by, "n", "sketch"])
            out.clear()
            return done

        kinds = None
        for b in batches:
            kinds = b.schema
            columns = [c.to_pylist() for c in b.columns]
            for *key, _, data in zip(*columns):
                if key != now and held:
                    fold()
                    out.append((now, held.pop()))
                    if len(out) == 500:
                        yield batch()
                now = key
                held.append(Sketch.load(data))
                if len(held) == _AT_ONCE:
                    fold()
        if held:
            fold()
            out.append((now, held.pop()))
        if out:
            yield batch()

    spread = parts.select(*by, "n", "sketch").repartition(*[F.col(c) for c in by])
    return spread.sortWithinPartitions(*by, "n", "sketch").mapInArrow(run, schema)


def answers(sketches: DataFrame, keys: list[str], percentiles: tuple[int, ...] = PERCENTILES, delta: float = DELTA) -> DataFrame:
    """(keys, metric, n, low, p.., high, rank_error): percentiles and their bound as a share of n."""
    names = ["low", *(f"p{p:02d}" for p in percentiles), "high", "rank_error"]
    by = [*keys, "metric", "n"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            loaded = [Sketch.load(x) for x in b.column(b.num_columns - 1).to_pylist()]
            rows = [[s.low, *s.quantiles([p / 100 for p in percentiles]), s.high, s.bound(delta)] for s in loaded]
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], *(pa.array([r[i] for r in rows], pa.float64()) for i in range(len(names)))], names=[*by, *names])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in sketches.select(*by).schema)
    return sketches.select(*by, "sketch").mapInArrow(run, schema + "".join(f", {n} double" for n in names))


def daily_sketches(utterances: DataFrame, values: list[str], corpus: Column | None = None, k: int = K) -> DataFrame:
    """(corpus, day, metric, n, sketch): partial results per corpus and day that can be combined further.

    A repeated delivery counts once; rows without utt_id each count. A null corpus or day is a group of its own,
    negative zero is zero, and an empty table gives an empty result.
    """
    corpus = corpus_name("corpus") if corpus is None else corpus
    rows = utterances.select("utt_id", corpus.alias("corpus"), F.to_date("recorded_at").alias("day"), *[F.col(v).cast("double") for v in values])
    parts = partial_sketches(_once(rows, values), ["corpus", "day"], values, k)
    salted = parts.withColumn("salt", F.pmod(F.xxhash64("sketch"), F.lit(8)).cast("int"))
    return merge_sketches(merge_sketches(salted, ["corpus", "day", "salt"]), ["corpus", "day"])


def _once(rows: DataFrame, values: list[str]) -> DataFrame:
    same = rows.filter("utt_id is not null").groupBy("utt_id").agg(*[F.min(c).alias(c) for c in ("corpus", "day", *values)])
    return same.unionByName(rows.filter("utt_id is null"))


def percentiles(utterances: DataFrame, values: list[str] | None = None) -> DataFrame:
    """Answers per corpus (``level`` corpus, over all days) and per corpus and day (``level`` day).

    The corpus level is merged from the daily sketches by way of months, so no task takes more than the
    months of one corpus.
    """
    from sonolode.session import staged

    values = values or ["snr_db", "duration_sec", "speech_ratio"]
    daily = staged(daily_sketches(utterances, values), "daily-sketches")
    monthly = merge_sketches(daily.withColumn("month", F.trunc("day", "month")), ["corpus", "month"])
    whole = merge_sketches(monthly, ["corpus"])
    per_day = answers(daily, ["corpus", "day"]).withColumn("level", F.lit("day"))
    per_corpus = answers(whole, ["corpus"]).withColumn("level", F.lit("corpus")).withColumn("day", F.lit(None).cast("date"))
    return per_day.unionByName(per_corpus)
