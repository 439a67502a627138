import random
from datetime import datetime

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sonolode.llm import packing
from sonolode.session import table

SCHEMA = "utt_id long, corpus string, split string, language string, duration_sec float, audio struct<bytes binary, path string>, capacity string"
BOXES = "container string, field string, capacity double"


@given(st.lists(st.integers(1, 100), min_size=1, max_size=120), st.sampled_from([100, 101, 1000]))
@settings(max_examples=300)
def test_pack_fills_like_best_fit(sizes, capacity):
    sizes = np.array(sorted(sizes, reverse=True))
    where = packing.pack(sizes, capacity)
    fills = np.bincount(where, weights=sizes)
    assert fills.max() <= capacity and fills.min() > 0 and len(where) == len(sizes)
    # plain best fit, bin by bin
    bins = []
    for s in sizes:
        room = [(capacity - b, i) for i, b in enumerate(bins) if capacity - b >= s]
        if room:
            bins[min(room)[1]] += s
        else:
            bins.append(s)
    assert len(fills) <= 1.2 * len(bins) + 1


@given(st.lists(st.booleans(), max_size=60))
def test_successors_are_brackets(clips):
    free, pairs = [], []
    for i, c in enumerate(clips):
        if not c:
            free.append(i)
        elif free:
            pairs.append((free.pop(), i))
    gap, taker = packing.successors(np.array(clips, bool))
    assert sorted(zip(gap.tolist(), taker.tolist())) == sorted(pairs)


def checked(spark, rows, boxes):
    df = spark.createDataFrame(rows, SCHEMA)
    placed, fills = packing.pack_clips(df, spark.createDataFrame(boxes, BOXES))
    placed, fills = placed.collect(), fills.collect()
    capacity = {b[0]: b[2] for b in boxes}
    load = {}
    for r in placed:
        key = (r["container"], r["corpus"], r["split"], r["language"], r["container_no"])
        load.setdefault(key, []).append(r["size"])
    assert {(r["container"], r["corpus"], r["split"], r["language"], r["container_no"]): (r["n_parts"], pytest.approx(r["fill"], abs=1e-3)) for r in fills} == {k: (len(v), sum(v)) for k, v in load.items()}
    assert all(sum(v) <= capacity[k[0]] * (1 + 1e-6) for k, v in load.items())
    groups = {}
    for k in load:
        groups.setdefault(k[:4], set()).add(k[4])
    assert all(v == set(range(len(v))) for v in groups.values())
    return placed, fills


def test_every_clip_once_over_many_ranges(spark, monkeypatch):
    monkeypatch.setattr(packing, "WHOLE", 350)
    rng = random.Random(1)
    rows = [(i, "Big" if i % 3 else "small", "train", "yor", rng.uniform(2.0, 20.0), (b"x" * rng.randrange(0, 900) if i % 4 == 0 else None, None), "clash") for i in range(900)]
    rows += rows[:30]
    boxes = [("w", "duration_sec", 15.0), ("p", "audio.bytes", 1000.0), ("w", "duration_sec", 15.0), ("bad", "duration_sec", float("nan")), ("none", "audio.bytes", None), ("odd", "other", 1.0)]
    placed, fills = checked(spark, rows, boxes)
    for box, value in (("w", lambda r: r[4]), ("p", lambda r: float(len(r[5][0] or b"")))):
        whole = {}
        for r in placed:
            if r["container"] == box:
                whole[r["utt_id"]] = whole.get(r["utt_id"], 0) + r["size"]
        assert whole == {r[0]: pytest.approx(value(r), rel=1e-6) for r in rows if value(r) > 0}
    assert {r["container"] for r in placed} == {"w", "p"}
    # about as few containers as their sizes allow
    for corpus, n in (("big", 600), ("small", 300)):
        own = [r["fill"] for r in fills if r["container"] == "w" and r["corpus"] == corpus]
        assert len(own) <= 1.35 * sum(own) / 15 + 1
    # neither the partitions nor the number of ranges matter
    monkeypatch.setattr(packing, "WHOLE", 100_000)
    again, _ = packing.pack_clips(spark.createDataFrame(rows, SCHEMA).repartition(7), spark.createDataFrame(boxes, BOXES))
    assert sorted(map(str, again.collect())) == sorted(map(str, placed))


def test_edges(spark):
    nan, inf = float("nan"), float("inf")
    audio = (None, None)
    rows = [(1, "a", "train", "yor", 40.0, audio, ""), (2, "a", "train", "yor", 30.0, audio, ""), (3, "a", "train", "yor", 5.0, audio, ""), (4, None, None, None, 3.0, None, None)]
    rows += [(5 + i, "a", "train", "yor", v, audio, "") for i, v in enumerate((0.0, -1.0, -0.0, nan, inf, None, 1e30))]
    rows += [(None, "a", "train", "YOR_NG", 2.0, audio, ""), (None, "a", "train", "yor", 2.0, audio, "")]
    placed, _ = checked(spark, rows, [("w", "duration_sec", 15.0)])
    parts = sorted((r["utt_id"] or 0, r["part"], r["size"]) for r in placed)
    assert parts == [(0, 0, 2.0), (0, 0, 2.0), (1, 0, 15.0), (1, 1, 15.0), (1, 2, 10.0), (2, 0, 15.0), (2, 1, 15.0), (3, 0, 5.0), (4, 0, 3.0)]
    assert len({r["container_no"] for r in placed if r["corpus"] == "a"}) == 6  # 15 15 15 15, 10 + 5 or 10 + 2 + 2, the rest


def test_small_clips_over_many_ranges(spark, monkeypatch):
    """Classes of many clips a container, whose running sums divide clips, come out the same in one range and in many."""
    rng = random.Random(2)
    rows = [(i, "one", 10_000, rng.choice([900, 700, rng.randrange(2000, 6000)])) for i in range(2000)]
    units = spark.createDataFrame([(7 if i % 5 else 8, c, u, s) for i, (u, _, c, s) in enumerate(rows)], "g long, capacity long, uid long, size long")
    whole = sorted(map(tuple, packing.pack_units(units).collect()))
    monkeypatch.setattr(packing, "WHOLE", 0)
    assert sorted(map(tuple, packing.pack_units(units).collect())) == whole


def test_a_clip_of_many_capacities(spark):
    rows = [(1, "a", "train", "yor", 3_000_000.0 + 0.25, (None, None), ""), (2, "a", "train", "yor", 0.5, (None, None), "")]
    placed, _ = packing.pack_clips(spark.createDataFrame(rows, SCHEMA), spark.createDataFrame([("w", "duration_sec", 0.3)], BOXES))
    assert placed.filter("utt_id = 1").agg(F.count("*"), F.sum("container_no"), F.max("container_no"), F.max("part")).first()[:] == (10_000_001, sum(range(2, 10_000_002)), 10_000_001, 10_000_000)


def test_empty(spark, small):
    rows = table(spark, small, "utterances")
    boxes = table(spark, small, "containers")
    for df in packing.pack_clips(rows.limit(0), boxes) + packing.pack_clips(rows, boxes.limit(0)):
        assert df.count() == 0


def test_extra_columns_do_not_clash(spark, small):
    rows = table(spark, small, "utterances").withColumns({n: F.lit(str(datetime(2020, 1, 1))) for n in ("container", "g", "uid", "capacity", "size", "block", "room", "field", "part")})
    assert packing.pack_clips(rows, table(spark, small, "containers"))[0].count() > 400
