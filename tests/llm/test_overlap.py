import random
import struct

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sonolode.functions.audio import encode_wav
from sonolode.llm import overlap
from sonolode.session import table

SCHEMA = "utt_id long, text string, split string, corpus string, audio struct<bytes binary, path string>, cls string, side string, key string"


def edit_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j - 1] + (x != y), row[j] + 1, new[-1] + 1))
        row = new
    return row[-1]


@given(st.lists(st.sampled_from("abcd"), max_size=12), st.lists(st.sampled_from("abcd"), max_size=12), st.integers(0, 5))
@settings(max_examples=300)
def test_edits_within(a, b, k):
    assert overlap.edits_within(a, b, k) == (edit_distance(a, b) <= k)


def edited(rng, found, k):
    found = list(found)
    for _ in range(k):
        i = rng.randrange(len(found))
        what = rng.randrange(3)
        if what == 0:
            found[i] = f"new{rng.randrange(10**6)}"
        elif what == 1:
            found.insert(i, f"new{rng.randrange(10**6)}")
        else:
            found.pop(i)
    return found


def test_blocks_lose_no_pair():
    rng = random.Random(2)
    ranks = bytes(rng.randrange(3) for _ in range(overlap.COUNTERS))
    lexicon = [f"w{i}" for i in range(60)]
    for _ in range(1500):
        n = rng.choice([6, 7, 9, 10, 14, 15, 16, 19, 20, 21, 24, 25, 40, 64, 79, 120, 300])
        a = [rng.choice(lexicon) for _ in range(n)]
        b = edited(rng, a, rng.randrange(0, n // 5 + 1))
        if len(b) < 6 or not overlap.edits_within(a, b, max(len(a), len(b)) // 5):
            continue
        (ka, fa), (kb, fb) = (overlap.text_keys(x, ranks, {}) for x in (a, b))
        assert set(ka) & set(kb)
        assert bin((fa ^ fb) & (1 << 64) - 1).count("1") <= 2 * (max(len(a), len(b)) // 5)


def rows_of(rng, n=160):
    lexicon = [f"wọ́rd{i}" for i in range(400)] + ["the"] * 100
    rows = []
    for i in range(n):
        if rows and rng.random() < 0.6:
            base = rng.choice(rows)[1]
            t = edited(rng, base, rng.randrange(0, 4)) if base else base
        else:
            t = [rng.choice(lexicon) for _ in range(rng.choice([4, 6, 8, 12, 20, 30, 90]))]
        rows.append((i, t, rng.choice(["train", "train", "dev", "test", "validation", None, "other"])))
    return rows


def test_texts_against_brute_force(spark):
    rng = random.Random(3)
    rows = rows_of(rng)
    dressed = [(i, None if i % 50 == 0 else "  ".join(w.upper() if rng.random() < 0.2 else w + rng.choice(["", ",", "!"]) for w in t), s, "c", None, "x", "y", "z") for i, t, s in rows]
    dressed += dressed[:20]
    got = {tuple(r) for r in overlap.overlaps(spark.createDataFrame(dressed, SCHEMA)).collect()}
    found = {i: overlap.words(t) for i, t, *_ in dressed}
    side = {i: s for i, _, s, *_ in dressed}
    expected = {(min(a, b), max(a, b)) for a in found for b in found if side[a] in overlap.EVALUATION and side[b] == "train" and min(len(found[a]), len(found[b])) >= 6 and edit_distance(found[a], found[b]) <= max(len(found[a]), len(found[b])) // 5}
    assert expected and got == expected


def noise(rng, n=200):
    return (rng.normal(size=n) * 6000).clip(-30000, 30000)


def wav(x, rate=16_000):
    return encode_wav(np.asarray(x) / 32767, rate)


def test_waves(spark):
    rng = np.random.default_rng(4)
    rows, expected, i = [], set(), 0

    def add(a, b, same):
        nonlocal i
        rows.append((i, None, "test", "c", (a, None), "", "", ""))
        rows.append((i + 1, "", "train", "c", (b, "generic.wav"), "", "", ""))
        if same:
            expected.add((i, i + 1))
        i += 2

    for k in range(60):
        x = noise(rng)
        add(wav(x), wav(x * 0.5, 8_000), True)
        add(wav(x := noise(rng)), wav(x + rng.normal(size=200) * 300), True)
        add(wav(x := noise(rng)), wav(x[k % 12 :]), True)
        add(wav(noise(rng)), wav(noise(rng)), False)
    add(wav(np.zeros(200)), wav(np.zeros(200)), False)
    add(b"RIFFnothing", b"RIFFnothing", False)
    add(b"", None, False)
    x = noise(rng)
    stereo = wav(x)[:22] + struct.pack("<H", 2) + wav(x)[24:]
    add(stereo, stereo, False)
    add(wav(x[:60]), wav(x[3:60]), True)
    got = {tuple(r) for r in overlap.overlaps(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got <= expected and len(got) >= 0.98 * len(expected)


def test_report_counts_what_is_listed(spark):
    """Texts and waveforms drawn from few, so that many pairs are linked both ways; one record is on both sides."""
    rng = random.Random(6)
    clips = [wav(noise(np.random.default_rng(k))) for k in range(4)]
    texts = ["a b c d e f g", "a b c d e f h", "one two three four five six", None]
    rows = [(i, rng.choice(texts), rng.choice(["train", "dev", "test"]), rng.choice("xy"), (rng.choice([*clips, None]), None), "", "", "") for i in range(120)]
    rows += [(7, rows[7][1] or texts[0], s, "x", (clips[0], None), "", "", "") for s in ("train", "dev")]
    df = spark.createDataFrame(rows, SCHEMA)
    listed = {tuple(r) for r in overlap.overlaps(df).collect()}
    known = {}
    for i, _, s, c, *_ in rows:
        if s != "train":
            known[i] = min(known.get(i, (s, c)), (s, c))
    trained = {r[0] for r in rows if r[2] == "train"}
    n_pairs, n_over = {}, {}
    for i, key in known.items():
        n = sum(((min(i, t), max(i, t)) in listed) for t in trained if t != i)
        n_pairs[key], n_over[key] = n_pairs.get(key, 0) + n, n_over.get(key, 0) + (n > 0)
    report = overlap.overlap_report(df).collect()
    assert sum(n_pairs.values()) > 500
    assert {(r["split"], r["corpus"]): (r["n_pairs"], r["n_overlapping"]) for r in report} == {k: (n_pairs[k], n_over[k]) for k in n_pairs}


def test_hot_copies_are_counted_not_listed(spark):
    text = "a prompt that very many speakers have read aloud"
    df = spark.range(400_000).select(F.col("id").alias("utt_id"), F.lit(text).alias("text"), F.when(F.col("id") < 100_000, "test").otherwise("train").alias("split"), F.lit("c").alias("corpus"), F.lit(None).cast("struct<bytes binary, path string>").alias("audio"))
    assert [tuple(r) for r in overlap.overlap_report(df).collect()] == [("test", "c", 100_000, 100_000, 100_000 * 300_000)]


def test_eight_bits_meet_sixteen(spark):
    x = noise(np.random.default_rng(9))
    narrow = bytearray(wav(x))
    narrow = wav(x)[:34] + struct.pack("<H4sI", 8, b"data", 200) + (np.round(x / 256) + 128).astype(np.uint8).tobytes()
    rows = [(1, None, "dev", "c", (wav(x), None), "", "", ""), (2, None, "train", "c", (bytes(narrow), None), "", "", "")]
    assert [tuple(r) for r in overlap.overlaps(spark.createDataFrame(rows, SCHEMA)).collect()] == [(1, 2)]


def test_edges(spark, small):
    rows = table(spark, small, "utterances")
    assert overlap.overlaps(rows.limit(0)).count() == 0
    assert overlap.overlap_report(rows.limit(0)).count() == 0
    same = "one two three four five six " * 400
    data = [(1, same, "train", None, None, "", "", ""), (2, same, "dev", None, None, "", "", ""), (None, same, "dev", None, None, "", "", ""), (3, same, None, None, None, "", "", ""), (2, same, "dev", None, None, "", "", "")]
    df = spark.createDataFrame(data, SCHEMA)
    assert [tuple(r) for r in overlap.overlaps(df).collect()] == [(1, 2)]
    report = overlap.overlap_report(df).collect()
    assert [(r["split"], r["n_records"], r["n_overlapping"], r["n_pairs"]) for r in report] == [("dev", 1, 1, 1)]


def test_hot_group_of_copies(spark):
    text = "a prompt that very many speakers have read aloud"
    df = spark.range(3000).select(F.col("id").alias("utt_id"), F.lit(text).alias("text"), F.when(F.col("id") < 2, "test").otherwise("train").alias("split"), F.lit("c").alias("corpus"), F.lit(None).cast("struct<bytes binary, path string>").alias("audio"))
    assert overlap.overlaps(df).count() == 2 * 2998
