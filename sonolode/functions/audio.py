"""Signal metrics of audio clips.

Decoding, resampling and the spectrum run in an Arrow kernel, which reads nothing but ``audio.bytes``. The metrics that follow
from frames also exist as native array expressions over decoded samples.
"""

from __future__ import annotations

import io
import math
import struct
import wave
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sonolode.functions.names import _col

METRICS = ("snr_db", "noise_level_db", "speech_level_db", "speech_ratio", "duration_sec", "spectral_bandwidth_hz")


@dataclass(frozen=True)
class Framing:
    """How clips are framed: milliseconds, the percentile that counts as noise, and the rate clips are brought to."""

    frame_ms: int = 25
    hop_ms: int = 10
    noise_percentile: float = 10.0
    rate: int = 16_000
    speech_db: float = 6.0
    spectra: int = 300


def chunks(data: bytes) -> Iterator[tuple[bytes, int, int]]:
    """(name, start, end) of each chunk of a WAV, found by walking from one to the next; none of what is no WAV.

    The outer size is not trusted, as writers that stream leave it stale, and a chunk that runs past the end is cut there.
    """
    if data[:4] != b"RIFF" or data[8:12] != b"WAVE":
        return
    at = 12
    while at + 8 <= len(data):
        name, size = struct.unpack_from("<4sI", data, at)
        yield name, at + 8, min(len(data), at + 8 + size)
        at += 8 + size + size % 2


@dataclass(frozen=True)
class Header:
    """What the ``fmt `` chunk says: kind 1 is whole numbers, 3 floating point."""

    kind: int
    channels: int
    rate: int
    bits: int


def wav_format(data: bytes) -> Header | None:
    for name, start, end in chunks(data):
        if name == b"fmt " and end - start >= 16:
            kind, channels, rate, _, _, bits = struct.unpack_from("<HHIIHH", data, start)
            if kind == 0xFFFE and end - start >= 26:  # the extended form names the kind at the start of its identifier
                kind = struct.unpack_from("<H", data, start + 24)[0]
            return Header(kind, channels, rate, bits)
    return None


def _samples(raw: bytes, kind: int, bits: int) -> np.ndarray:
    width = bits // 8
    raw = raw[: len(raw) // width * width]
    if kind == 3:
        return np.frombuffer(raw, {32: "<f4", 64: "<f8"}[bits]).astype(np.float32)
    if bits == 8:
        return (np.frombuffer(raw, np.uint8).astype(np.float32) - 128) / 128
    if bits == 24:
        wide = np.zeros((len(raw) // 3, 4), np.uint8)
        wide[:, 1:] = np.frombuffer(raw, np.uint8).reshape(-1, 3)
        return (wide.view("<i4")[:, 0] / 2.0**31).astype(np.float32)
    return (np.frombuffer(raw, {16: "<i2", 32: "<i4"}[bits]) / 2.0 ** (bits - 1)).astype(np.float32)


def decode_wav(data: bytes) -> tuple[np.ndarray, int]:
    """(samples from -1 to 1, rate) of a mono WAV of 8, 16, 24 or 32 bit numbers or of floats; ValueError for anything else."""
    head = wav_format(data)
    if head is None:
        raise ValueError("no WAV")
    if head.channels != 1:
        raise ValueError(f"{head.channels} channels")
    if head.rate <= 0:
        raise ValueError("no sample rate")
    if (head.kind, head.bits) not in ((1, 8), (1, 16), (1, 24), (1, 32), (3, 32), (3, 64)):
        raise ValueError(f"{head.bits} bits of kind {head.kind}")
    body = next(((start, end) for name, start, end in chunks(data) if name == b"data"), None)
    if body is None:
        raise ValueError("no samples")
    samples = _samples(data[slice(*body)], head.kind, head.bits)
    if not np.isfinite(samples).all():
        raise ValueError("samples that are no numbers")
    return samples, head.rate


@lru_cache(maxsize=32)
def _phases(rate: int, to: int, half: int = 32) -> tuple[np.ndarray, int]:
    """(filter for each place that an output sample can have between two input samples, reach of a filter)."""
    cut = min(1.0, to / rate)
    reach = math.ceil(half / cut)
    count = to // math.gcd(rate, to)
    x = np.arange(count)[:, None] / count - np.arange(-reach + 1, reach + 1)
    window = np.where(np.abs(x) < reach, 0.5 + 0.5 * np.cos(np.pi * x / reach), 0)
    return cut * np.sinc(cut * x) * window, reach


def resample(samples: np.ndarray, rate: int, to: int) -> np.ndarray:
    """Band-limited resampling by a windowed sinc; near any other good resampler, equal to none bit by bit."""
    if rate == to or not len(samples):
        return samples
    filters, reach = _phases(rate, to)
    step = rate // math.gcd(rate, to)
    padded = np.concatenate([np.zeros(reach - 1), samples, np.zeros(reach + 1)])
    windows = np.lib.stride_tricks.sliding_window_view(padded, 2 * reach)
    out = np.empty(math.ceil(len(samples) * to / rate))
    for start in range(0, len(out), 65_536):  # bounds the memory of very long clips
        base, phase = np.divmod(np.arange(start, min(len(out), start + 65_536)) * step, len(filters))
        out[start : start + len(base)] = np.einsum("ij,ij->i", windows[base], filters[phase])
    return out.astype(np.float32)


def encode_wav(samples: np.ndarray, rate: int) -> bytes:
    """16-bit mono WAV."""
    buffer = io.BytesIO()
    with wave.open(buffer, "wb") as w:
        w.setnchannels(1), w.setsampwidth(2), w.setframerate(rate)
        w.writeframes(np.clip(np.round(samples * 32767), -32768, 32767).astype("<i2").tobytes())
    return buffer.getvalue()


def decibels(rms: float) -> float:
    return 20 * math.log10(max(rms, 1e-10))


def clip_metrics(data: bytes | None, framing: Framing = Framing()) -> tuple[list[float | None], bytes | None]:
    """(the six metrics in the order of ``METRICS``, new bytes if the clip was resampled); all null for what is no mono WAV."""
    try:
        return _measured(*decode_wav(data or b""), framing)
    except (ValueError, ArithmeticError, MemoryError):  # one clip that cannot be measured ends no job
        return [None] * 6, None


def _measured(samples: np.ndarray, rate: int, framing: Framing) -> tuple[list[float | None], bytes | None]:
    new = None
    if rate != framing.rate:
        samples = resample(samples, rate, framing.rate)
        new, rate = encode_wav(samples, framing.rate), framing.rate
    duration = len(samples) / rate
    size, hop = (max(1, int(rate * ms / 1000)) for ms in (framing.frame_ms, framing.hop_ms))
    if len(samples) < size:
        samples = np.pad(samples, (0, size - len(samples)))
    frames = np.lib.stride_tricks.sliding_window_view(samples, size)[::hop]
    power = np.mean(frames.astype(np.float64) ** 2, axis=1) + 1e-12
    rms = np.sqrt(power)
    noise = math.sqrt(power[rms <= np.percentile(rms, framing.noise_percentile)].mean())
    speech = rms > noise * 10 ** (framing.speech_db / 20)
    if not speech.any():
        speech[:] = True
    level = math.sqrt(power[speech].mean())
    return [decibels(level) - decibels(noise), decibels(noise), decibels(level), float(speech.mean()), duration, bandwidth(frames, rate, framing.spectra)], new


def bandwidth(frames: np.ndarray, rate: int, most: int) -> float:
    """Mean spread of the spectrum about its centroid, over evenly spaced frames that have energy; 0 where none has."""
    chosen = frames[np.linspace(0, len(frames) - 1, min(len(frames), most)).astype(int)]
    spectrum = np.abs(np.fft.rfft(chosen * np.hanning(frames.shape[1]), axis=1))
    hertz = np.fft.rfftfreq(frames.shape[1], 1 / rate)
    weight = spectrum.sum(axis=1, keepdims=True)
    spectrum, weight = spectrum[weight[:, 0] > 0], weight[weight[:, 0] > 0]
    if not len(weight):
        return 0.0
    shares = spectrum / weight
    centre = shares @ hertz
    return float(np.sqrt((shares * (hertz - centre[:, None]) ** 2).sum(axis=1)).mean())


def with_metrics(df: DataFrame, audio: str = "audio", framing: Framing = Framing()) -> DataFrame:
    """``df`` with the six metrics (float) in place of any it had, and resampled clips in place of their originals."""
    fields = ", ".join(f"{m}: float" for m in METRICS)

    @F.arrow_udf(f"struct<{fields}, resampled: binary>")
    def run(clips: pa.Array) -> pa.Array:
        rows = [clip_metrics(c, framing) for c in clips.to_pylist()]
        columns = [pa.array([r[0][i] for r in rows], pa.float32()) for i in range(6)]
        return pa.StructArray.from_arrays([*columns, pa.array([r[1] for r in rows], pa.binary())], names=[*METRICS, "resampled"])

    found = df.drop(*METRICS).withColumn("__found", run(F.col(f"{audio}.bytes")))
    changed = F.col(audio).withField("bytes", F.coalesce("__found.resampled", F.col(f"{audio}.bytes")))
    kept = F.when(F.col("__found.resampled").isNotNull(), changed).otherwise(F.col(audio))
    return found.withColumns({audio: kept} | {m: F.col(f"__found.{m}") for m in METRICS}).drop("__found")


def waveform(clip: Column | str) -> Column:
    """Samples from -1 to 1 of a mono WAV, null for anything else."""

    @F.arrow_udf("array<double>")
    def run(clips: pa.Array) -> pa.Array:
        out = []
        for data in clips.to_pylist():
            try:
                out.append(decode_wav(data or b"")[0].astype(np.float64))
            except ValueError:
                out.append(None)
        return pa.array(out, pa.list_(pa.float64()))

    return run(_col(clip))


def wav_header(df: DataFrame, content: str = "content", keep: tuple[str, ...] = ("path",)) -> DataFrame:
    """(kept columns, rate, channels) of WAV files read as binary, from their headers alone."""

    @F.arrow_udf("struct<rate: int, channels: int>")
    def run(heads: pa.Array) -> pa.Array:
        found = [_header(h or b"") for h in heads.to_pylist()]
        return pa.StructArray.from_arrays([pa.array([f[0] for f in found], pa.int32()), pa.array([f[1] for f in found], pa.int32())], names=["rate", "channels"])

    return df.select(*keep, run(F.col(content)).alias("h")).select(*keep, "h.*")


def _header(data: bytes) -> tuple[int | None, int | None]:
    head = wav_format(data)
    return (head.rate, head.channels) if head and head.rate < 1 << 31 else (None, None)


# Native expressions over arrays of samples.


def frames(samples: Column | str, size: int, hop: int) -> Column:
    """Frames of an array; one shorter than a frame is filled with zeros, a rest at the end is left out."""
    x = _col(samples)
    x = F.when(F.size(x) < size, F.concat(x, F.array_repeat(F.lit(0.0), F.greatest(F.lit(0), size - F.size(x))))).otherwise(x)
    return F.transform(F.sequence(F.lit(1), F.size(x) - (size - 1), F.lit(hop)), lambda i: F.slice(x, i, size))


def _root_mean_square(values: Column, offset: float = 0.0) -> Column:
    return F.sqrt(F.aggregate(values, F.lit(0.0), lambda a, v: a + v * v) / F.size(values) + F.lit(offset))


def frame_levels(samples: Column | str, size: int, hop: int) -> Column:
    """Root mean square of each frame."""
    return F.transform(frames(_col(samples).cast("array<double>"), size, hop), lambda f: _root_mean_square(f, 1e-12))


def interpolated(values: Column, share: float) -> Column:
    """The linearly interpolated quantile of an array."""
    ordered = F.array_sort(values)
    at = (F.size(values) - 1) * F.lit(share)
    below = F.floor(at).cast("int")
    low, high = F.get(ordered, below), F.get(ordered, F.least(below + 1, F.size(values) - 1))
    return low + (at - below) * (high - low)


def _bound(value: Column, body) -> Column:
    """``body`` of a value that is computed once, however often and within whatever lambda the body uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def level_struct(levels: Column | str, percentile: float = 10.0, speech_db: float = 6.0) -> Column:
    """A struct of noise_level_db, speech_level_db, snr_db and speech_ratio of an array of frame levels."""

    def noise_of(rms: Column) -> Column:
        return _bound(interpolated(rms, percentile / 100), lambda edge: _root_mean_square(F.filter(rms, lambda r: r <= edge)))

    def speech_of(rms: Column, noise: Column) -> Column:
        return _bound(F.filter(rms, lambda r: r > noise * 10 ** (speech_db / 20)), lambda loud: F.when(F.size(loud) > 0, loud).otherwise(rms))

    def told(rms: Column, noise: Column, speech: Column) -> Column:
        quiet, level = (20 * F.log10(F.greatest(v, F.lit(1e-10))) for v in (noise, _root_mean_square(speech)))
        return F.struct(quiet.alias("noise_level_db"), level.alias("speech_level_db"), (level - quiet).alias("snr_db"), (F.size(speech) / F.size(rms)).alias("speech_ratio"))

    return _bound(_col(levels), lambda rms: _bound(noise_of(rms), lambda noise: _bound(speech_of(rms, noise), lambda speech: told(rms, noise, speech))))


def level_metrics(levels: Column | str, percentile: float = 10.0, speech_db: float = 6.0) -> dict[str, Column]:
    """The fields of ``level_struct`` as columns of their own."""
    found = level_struct(levels, percentile, speech_db)
    return {n: found[n] for n in ("noise_level_db", "speech_level_db", "snr_db", "speech_ratio")}
