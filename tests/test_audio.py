import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from sonolode.functions import audio


def tone(rate=16_000, seconds=1.0, hertz=440.0):
    t = np.arange(int(rate * seconds)) / rate
    return (0.5 * np.sin(2 * np.pi * hertz * t) * (t > seconds / 2) + 0.001 * np.sin(2 * np.pi * 50 * t)).astype(np.float32)


def test_metrics_of_a_tone():
    found, new = audio.clip_metrics(audio.encode_wav(tone(), 16_000))
    named = dict(zip(audio.METRICS, found))
    assert new is None
    assert named["duration_sec"] == 1.0
    assert named["snr_db"] == pytest.approx(named["speech_level_db"] - named["noise_level_db"])
    assert 50 < named["snr_db"] < 58
    assert 0.45 < named["speech_ratio"] < 0.55


def test_resampling_keeps_the_tone():
    found, new = audio.clip_metrics(audio.encode_wav(tone(8_000), 8_000))
    samples, rate = audio.decode_wav(new)
    assert rate == 16_000 and len(samples) == 16_000 and found[4] == 1.0
    error = samples[9000:15000] - tone()[9000:15000]
    assert np.sqrt((error**2).mean()) < 0.01


@pytest.mark.parametrize("data", [None, b"", b"RIFF", b"no wave at all" * 10])
def test_unreadable(data):
    assert audio.clip_metrics(data) == ([None] * 6, None)


def test_silence_and_short_clips():
    silent, _ = audio.clip_metrics(audio.encode_wav(np.zeros(1000), 16_000))
    assert silent[0] == pytest.approx(0) and silent[3] == 1.0 and silent[5] == 0.0
    short, _ = audio.clip_metrics(audio.encode_wav(tone()[:10], 16_000))
    assert short[4] == pytest.approx(10 / 16_000)


def test_with_metrics_keeps_other_columns(spark):
    rows = [(1, (audio.encode_wav(tone(8_000), 8_000), "a.wav"), 9.0), (2, (None, "b.wav"), 9.0), (3, None, 9.0)]
    df = spark.createDataFrame(rows, "id int, audio struct<bytes binary, path string>, duration_sec double")
    got = {r["id"]: r for r in audio.with_metrics(df).collect()}
    assert got[1]["duration_sec"] == 1.0 and audio.decode_wav(bytes(got[1]["audio"]["bytes"]))[1] == 16_000
    assert got[1]["audio"]["path"] == "a.wav" and got[2]["duration_sec"] is None and got[2]["audio"]["path"] == "b.wav" and got[3]["audio"] is None
    heads = audio.wav_header(df.select("id", F.col("audio.bytes").alias("content")), keep=("id",)).collect()
    assert {r["id"]: (r["rate"], r["channels"]) for r in heads} == {1: (8000, 1), 2: (None, None), 3: (None, None)}


def test_native_levels_equal_numpy(spark):
    rng = np.random.default_rng(1)
    clips = [rng.normal(size=n).tolist() for n in (64, 40, 16, 5, 3)]
    df = spark.createDataFrame([(i, c) for i, c in enumerate(clips)], "i int, x array<double>")
    got = df.select("i", audio.frame_levels("x", 16, 8).alias("r")).select("i", *[c.alias(n) for n, c in audio.level_metrics("r").items()]).collect()
    for r in got:
        x = np.array(clips[r["i"]])
        x = np.pad(x, (0, max(0, 16 - len(x))))
        rms = np.sqrt((np.lib.stride_tricks.sliding_window_view(x, 16)[::8] ** 2).mean(axis=1) + 1e-12)
        noise = math.sqrt((rms[rms <= np.percentile(rms, 10)] ** 2).mean())
        mask = rms > noise * 10 ** (6 / 20)
        mask = mask if mask.any() else np.ones_like(mask)
        level = math.sqrt((rms[mask] ** 2).mean())
        assert r["snr_db"] == pytest.approx(20 * math.log10(level / noise)) and r["speech_ratio"] == pytest.approx(mask.mean())


def wav(fmt, body, before=b"", size=None):
    """A WAV of a format chunk and samples, with chunks before the format, and what the outer size says."""
    import struct

    inner = b"WAVE" + before + b"fmt " + struct.pack("<I", len(fmt)) + fmt + b"data" + struct.pack("<I", len(body)) + body
    return b"RIFF" + struct.pack("<I", len(inner) if size is None else size) + inner


def fmt(bits, kind=1, channels=1, rate=16_000, more=b""):
    import struct

    return struct.pack("<HHIIHH", kind, channels, rate, rate * bits // 8, bits // 8, bits) + more


WAVE = np.sin(np.arange(800) / 7).astype(np.float32) * 0.5


@pytest.mark.parametrize(
    "data",
    [
        wav(fmt(16), (WAVE * 32768).astype("<i2").tobytes(), size=4),
        wav(fmt(16), (WAVE * 32768).astype("<i2").tobytes(), before=b"LIST" + (9001).to_bytes(4, "little") + b"fmt " + b"\x01" * 8998),
        wav(fmt(8), (WAVE * 128 + 128).astype(np.uint8).tobytes()),
        wav(fmt(24), b"".join(int(x * 2**23).to_bytes(3, "little", signed=True) for x in WAVE)),
        wav(fmt(32), (WAVE * 2.0**31).astype("<i4").tobytes()),
        wav(fmt(32, 3), WAVE.astype("<f4").tobytes()),
        wav(fmt(64, 3), WAVE.astype("<f8").tobytes()),
        wav(fmt(16, 0xFFFE, more=b"\x16\0\x10\0\x04\0\0\0\x01\0" + b"\0" * 14), (WAVE * 32768).astype("<i2").tobytes()),
    ],
)
def test_forms_of_wav(data):
    samples, rate = audio.decode_wav(data)
    assert rate == 16_000 and np.abs(samples - WAVE).max() < 0.01
    assert audio._header(data) == (16_000, 1)
    assert audio.clip_metrics(data)[0][4] == 0.05


@pytest.mark.parametrize("data", [wav(fmt(40), b"x" * 100), wav(fmt(16, 6), b"x" * 100), wav(fmt(0), b"x" * 10), wav(fmt(16, rate=0), b"x" * 10), wav(fmt(16, channels=0), b"x" * 10), wav(fmt(32, 3), b"\xff" * 40), wav(b"\x01\0", b"x"), b"RIFF\0\0\0\0WAVEdata\xff\xff\xff\xff"])
def test_bad_clips_give_nulls(spark, data):
    assert audio.clip_metrics(data) == ([None] * 6, None)
    df = spark.createDataFrame([(1, (data, "a"))], "id int, audio struct<bytes binary, path string>")
    assert audio.with_metrics(df).first()["duration_sec"] is None
