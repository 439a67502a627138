"""Problem 2: records of evaluation splits that also occur, exactly or almost, in the training split.

Texts and waveforms get bit codes whose Hamming distance bounds how much they differ; blocks of the codes are joined
across the splits, the codes' distance is checked within the join, and what is left is verified in full.

Texts. A short code of signs cannot serve: one of six words replaced turns about a fifth of its bits over. So a text's code is sparse
and has one bit per word occurrence (the word and how often it came before). An inserted or dropped word changes one bit and a replaced one two,
so texts within k edits lie within Hamming radius 2k. The bits are permuted so that rare words come first. Blocks of two set bits are
joined. Up to ``FEW`` words these are all pairs of the first k + 2 set bits, of which the other code has two,
whatever the edits (n words, k = n / 5). Beyond, they are the pairs of neighbours in the permuted order: an edit breaks at most three of them (and one more
where the other text is longer by a word that allows an edit more), so the first 3k + 2 of either text hold a common one; their number grows with
the text in proportion.
The order comes from a fixed number of word counters over all distinct texts; where words share one, only the selectivity suffers. A folded
64-bit parity of the code, whose distance never exceeds the code's, is compared inside the join.

Waveforms. Around each of the loudest samples, which neither loudness nor a shifted start moves, the signs of 48
samples make a code of three segments; any two segments make a join key, and the evaluation side also probes with the
faintest sample of a segment turned over. Codes are compared inside the join and waveforms by correlation afterwards.

Equal texts and equal waveforms are one class from the start, named by 128 bits: copies never meet each other's copies. ``overlaps`` lists the
members of linked classes, as its result demands; ``overlap_report`` counts them without listing any pair.
"""

from __future__ import annotations

import struct
import unicodedata
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sonolode.functions.audio import decode_wav
from sonolode.functions.names import corpus_name
from sonolode.llm.ranges import among
from sonolode.llm.skeleton import skeleton
from sonolode.session import staged

EVALUATION = ("validation", "dev", "test")
MIN_WORDS = 6
#: Edits allowed per word of the longer text.
EDITS = 5
#: Up to so many words all pairs of the block are joined, from four fifths of it on pairs of neighbours, so that no pair of lengths falls between.
FEW = 20
#: Word counters, a fixed number: one byte each where they are used.
COUNTERS = 1 << 18
ANCHORS = 4
HALF = 24
SHORT = 80
#: Most bits of an anchor's code that may differ, of 48.
RADIUS = 10
#: Least correlation of aligned waveforms, most samples missing at a start, least share of the longer that must overlap.
CORRELATION, MAX_SHIFT, OVERLAP = 0.95, 48, 0.75


class _Plain(dict):
    def __missing__(self, code: int) -> str:
        kind = unicodedata.category(chr(code))
        self[code] = out = "" if kind[0] in "MPS" else " " if kind[0] in "ZC" else chr(code)
        return out


_PLAIN = _Plain()


def words(text: str | None) -> list[str]:
    """The words that count: without case, marks, punctuation and what does not show."""
    return unicodedata.normalize("NFD", skeleton(text).casefold()).translate(_PLAIN).split() if text else []


def edits_within(a: list, b: list, most: int) -> bool:
    """Whether at most ``most`` insertions, deletions and replacements turn ``a`` into ``b``."""
    if abs(len(a) - len(b)) > most:
        return False
    # what agrees at either end needs no edit
    start = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
    a, b = a[start:], b[start:]
    end = next((i for i, (x, y) in enumerate(zip(reversed(a), reversed(b))) if x != y), min(len(a), len(b)))
    a, b = a[: len(a) - end], b[: len(b) - end]
    if not a or not b:
        return True
    big = most + 1
    row = [j if j <= most else big for j in range(len(b) + 1)]
    for i, x in enumerate(a, 1):
        lo, hi = max(1, i - most), min(len(b), i + most)
        new = [big] * (len(b) + 1)
        if i <= most:
            new[0] = i
        for j in range(lo, hi + 1):
            new[j] = min(row[j - 1] + (x != b[j - 1]), row[j] + 1, new[j - 1] + 1)
        row = new
        if min(row[lo - 1 : hi + 1]) > most:
            return False
    return row[-1] <= most


def read_wav(data: bytes | None) -> np.ndarray | None:
    """Samples (from -1 to 1) of a readable mono WAV with sound in it, else None."""
    try:
        x, _ = decode_wav(data or b"")
    except ValueError:
        return None
    return x if len(x) and float(x.max()) - float(x.min()) > 2 / 32768 else None


def same_wave(a: np.ndarray, b: np.ndarray) -> bool:
    """Whether two waveforms agree but for loudness, faint noise and a few samples missing at one start."""
    if len(a) < len(b):
        a, b = b, a
    a, b = a.astype(float), b.astype(float)
    for shift in range(min(MAX_SHIFT, len(a) - 1) + 1):
        for x, y in ((a[shift:], b), (a, b[shift:])):
            n = min(len(x), len(y))
            if n and n >= OVERLAP * len(a):
                x, y = x[:n], y[:n]
                size = np.sqrt((x @ x) * (y @ y))
                if size > 0 and x @ y >= CORRELATION * size:
                    return True
    return False


def _hash(data: bytes) -> int:
    import xxhash

    h = xxhash.xxh64_intdigest(data)
    return h - (1 << 64) if h >> 63 else h


def _signed(h: int) -> int:
    h &= (1 << 64) - 1
    return h - (1 << 64) if h >> 63 else h


def wave_keys(x: np.ndarray, probing: bool) -> list[tuple[int, int, bool]]:
    """(join key, 48-bit code, probe) of the anchors of a waveform, three keys each; short clips have one key per anchor of a shorter code.

    With ``probing`` there are also, marked as probes, the keys with the faintest sample of a segment turned over: where
    noise flips a sign, it is mostly that one. Only one side of the join needs them.
    """
    found = []
    size = np.abs(x)
    loud = np.argsort(-size, kind="stable")
    sign = x > 0
    if len(x) >= 2 * HALF + 16:
        for p in loud[(loud >= HALF) & (loud <= len(x) - HALF)][:ANCHORS]:
            code = int.from_bytes(np.packbits(sign[p - HALF : p + HALF]).tobytes(), "big")
            parts = [code >> 32, code >> 16 & 0xFFFF, code & 0xFFFF]
            faint = size[p - HALF : p + HALF].reshape(3, 16).argmin(axis=1)
            other = [part ^ 1 << 15 - int(f) for part, f in zip(parts, faint)]
            for i, j in combinations(range(3), 2):
                for a, b, probe in ((parts[i], parts[j], False), *(((parts[i], other[j], True), (other[i], parts[j], True), (other[i], other[j], True)) if probing else ())):
                    found.append((_hash(struct.pack("<4H", i, j, a, b)), code, probe))
    if len(x) < SHORT:
        half = min(12, len(x) // 3)
        for p in loud[(loud >= half) & (loud <= len(x) - half)][:ANCHORS]:
            found.append((_hash(b"s%d" % half + np.packbits(sign[p - half : p + half]).tobytes()), 0, False))
    return found


def _records(utterances: DataFrame, column: str) -> DataFrame:
    """(utt_id, side, value) of the rows that matter: side 1 is evaluation, 0 training."""
    split = F.lower(F.trim("split"))
    side = F.when(split == "train", 0).when(split.isin(*EVALUATION), 1)
    rows = utterances.select(F.col("utt_id").cast("bigint"), side.cast("int").alias("side"), F.col(column).alias("value"))
    return rows.filter("utt_id is not null and side is not null and value is not null")


def word_ranks(classes: DataFrame) -> bytes:
    """For each of ``COUNTERS`` buckets of words the logarithm of its count over all distinct texts, in one byte.

    Tasks count their own texts in an array of that fixed size; what reaches the driver is bounded by it too.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(COUNTERS, dtype=np.int64)
        for b in batches:
            seen: dict[str, int] = {}
            for text in b.column(0).to_pylist():
                for w in text.split():
                    seen[w] = seen.get(w, 0) + 1
            if seen:
                at = np.fromiter((_hash(w.encode()) & (COUNTERS - 1) for w in seen), dtype=np.int64)
                np.add.at(total, at, np.fromiter(seen.values(), dtype=np.int64))
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), pa.array(total[used])], names=["bucket", "n"])

    counts = classes.select("value").mapInArrow(count, "bucket int, n bigint").groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(COUNTERS, dtype=np.uint8)
    out[counts.column("bucket").to_numpy()] = np.clip(np.log2(np.maximum(counts.column("n").to_numpy(), 1)) * 4, 0, 255)
    return out.tobytes()


def _pair(a: int, b: int) -> int:
    if a > b:
        a, b = b, a
    return _signed((a ^ (b * 0x9E3779B97F4A7C15)) * 0xD6E8FEB86659FD93 + 1)


def text_keys(found: list[str], ranks: bytes, hashes: dict[str, int]) -> tuple[list[int], int]:
    """(join keys, folded 64-bit parity) of the words of a text."""
    times: dict[str, int] = {}
    bits = []
    for w in found:
        h = hashes.get(w)
        if h is None:
            h = hashes[w] = _hash(w.encode())
        t = times[w] = times.get(w, 0) + 1
        bits.append((ranks[h & (COUNTERS - 1)], h if t == 1 else _signed(h * 0x9E3779B97F4A7C15 + t)))
    fold = 0
    for _, h in bits:
        fold ^= 1 << ((h >> 20) & 63)
    bits.sort()
    order, n = [h for _, h in bits], len(found)
    keys = [_pair(a, b) for a, b in combinations(order[: n // EDITS + 2], 2)] if n <= FEW else []
    if n >= FEW * (EDITS - 1) // EDITS:
        keys += [_pair(a, b) for a, b in zip(order, order[1 : 3 * (n // EDITS) + 3])]
    return keys, _signed(fold)


_SEEN = "utt_id bigint, side int, cls binary, size int, value {0}"
_KEYED = "cls binary, in_eval int, in_train int, size int, keys array<struct<key:bigint,code:bigint,probe:boolean>>"


def _name(data: bytes) -> bytes:
    import xxhash

    return xxhash.xxh128_digest(data)


def _seen_texts(utterances: DataFrame) -> DataFrame:
    """A row of ``_SEEN`` for each record whose text counts; the value holds its words, one blank between them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [words(t) for t in b.column(2).to_pylist()]
            at = [i for i, f in enumerate(found) if len(f) >= MIN_WORDS]
            if at:
                texts = [" ".join(found[i]) for i in at]
                keep = pa.array(at, pa.int32())
                yield pa.RecordBatch.from_arrays([b.column(0).take(keep), b.column(1).take(keep), pa.array([_name(t.encode()) for t in texts], pa.binary()), pa.array([len(found[i]) for i in at], pa.int32()), pa.array(texts, pa.string())], names=["utt_id", "side", "cls", "size", "value"])

    return _records(utterances, "text").select("utt_id", "side", F.col("value").cast("string")).mapInArrow(run, _SEEN.format("string"))


def _seen_waves(utterances: DataFrame) -> DataFrame:
    """A row of ``_SEEN`` for each record whose waveform counts; the value holds its samples in single precision."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [read_wav(d) for d in b.column(2).to_pylist()]
            at = [i for i, x in enumerate(found) if x is not None]
            if at:
                raw = [found[i].astype("<f4").tobytes() for i in at]
                keep = pa.array(at, pa.int32())
                yield pa.RecordBatch.from_arrays([b.column(0).take(keep), b.column(1).take(keep), pa.array([_name(r) for r in raw], pa.binary()), pa.array([len(found[i]) for i in at], pa.int32()), pa.array(raw, pa.binary())], names=["utt_id", "side", "cls", "size", "value"])

    return _records(utterances, "audio.bytes").mapInArrow(run, _SEEN.format("binary"))


def _keyed(classes: DataFrame, keys) -> DataFrame:
    """A row of ``_KEYED`` per class; ``keys``: a function from value and in_eval to (key, code, probe) triples."""
    kind = pa.list_(pa.struct([("key", pa.int64()), ("code", pa.int64()), ("probe", pa.bool_())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lists = [keys(v, e) for v, e in zip(b.column(4).to_pylist(), b.column(1).to_pylist())]
            offsets = np.zeros(len(lists) + 1, dtype=np.int32)
            np.cumsum([len(k) for k in lists], out=offsets[1:])
            flat = [x for k in lists for x in k]
            triples = pa.StructArray.from_arrays([pa.array([x[i] for x in flat], t) for i, t in enumerate((pa.int64(), pa.int64(), pa.bool_()))], fields=list(kind.value_type))
            yield pa.RecordBatch.from_arrays([*b.columns[:4], pa.ListArray.from_arrays(pa.array(offsets), triples).cast(kind)], names=["cls", "in_eval", "in_train", "size", "keys"])

    return classes.select("cls", "in_eval", "in_train", "size", "value").mapInArrow(run, _KEYED)


def _text_keys(classes: DataFrame):
    ranks = classes.sparkSession.sparkContext.broadcast(word_ranks(classes))  # COUNTERS bytes
    hashes: dict[str, int] = {}

    def keys(value: str, in_eval: int) -> list[tuple[int, int, bool]]:
        if len(hashes) > 500_000:
            hashes.clear()
        found, fold = text_keys(value.split(), ranks.value, hashes)
        return [(k, fold, False) for k in found]

    return keys


def _wave_keys(classes: DataFrame):
    return lambda value, in_eval: wave_keys(np.frombuffer(value, "<f4"), in_eval == 1)


def _linked(seen: DataFrame, label: str, keys, near, same) -> tuple[DataFrame, DataFrame]:
    """((cls, side, utt_id), (cls_a, cls_b)): members of the classes, and the classes of evaluation and training that are linked.

    ``keys``: what makes the function for ``_keyed`` from the classes; ``near``: join condition on sizes and codes; ``same``: full check.
    """
    seen = staged(seen, f"seen-{label}")
    members = seen.select("cls", "side", "utt_id").distinct()
    classes = staged(seen.groupBy("cls").agg(F.max("side").alias("in_eval"), F.min("side").alias("in_train"), F.first("size").alias("size"), F.first("value").alias("value")), f"classes-{label}")
    keyed = staged(_keyed(classes, keys(classes)), f"keyed-{label}").select("cls", "in_eval", "in_train", "size", F.explode("keys").alias("k")).select("cls", "in_eval", "in_train", "size", "k.*")
    a = keyed.filter("in_eval = 1").select("key", F.col("cls").alias("cls_a"), F.col("size").alias("size_a"), F.col("code").alias("code_a"))
    b = keyed.filter("in_train = 0 and not probe").select(F.col("key").alias("key_b"), F.col("cls").alias("cls_b"), F.col("size").alias("size_b"), F.col("code").alias("code_b"))
    met = a.join(b, (a.key == b.key_b) & (F.col("cls_a") != F.col("cls_b")) & near()).select("cls_a", "cls_b").distinct()
    met = staged(met, f"met-{label}")
    # only what may have met goes into the joins
    values = among(classes.select("cls", "value"), "cls", met.select(F.col("cls_a").alias("cls")).unionByName(met.select(F.col("cls_b").alias("cls"))))
    pairs = met.join(values.select(F.col("cls").alias("cls_a"), F.col("value").alias("value_a")), "cls_a").join(values.select(F.col("cls").alias("cls_b"), F.col("value").alias("value_b")), "cls_b")

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = pa.array([same(x, y) for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist())], pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(keep), batch.column(1).filter(keep)], names=["cls_a", "cls_b"])

    verified = pairs.select("cls_a", "cls_b", "value_a", "value_b").mapInArrow(verify, "cls_a binary, cls_b binary")
    equal = classes.filter("in_eval = 1 and in_train = 0").select(F.col("cls").alias("cls_a"), F.col("cls").alias("cls_b"))
    return members, staged(verified.unionByName(equal), f"links-{label}")


def _same_text(a: str, b: str) -> bool:
    x, y = a.split(), b.split()
    return edits_within(x, y, max(len(x), len(y)) // EDITS)


def _same_audio(a: bytes, b: bytes) -> bool:
    return same_wave(np.frombuffer(a, "<f4"), np.frombuffer(b, "<f4"))


def _near_text():
    most = F.floor(F.greatest("size_a", "size_b") / EDITS)
    return (F.abs(F.col("size_a") - F.col("size_b")) <= most) & (F.bit_count(F.col("code_a").bitwiseXOR(F.col("code_b"))) <= 2 * most)


def _near_wave():
    return (F.bit_count(F.col("code_a").bitwiseXOR(F.col("code_b"))) <= RADIUS) & (F.least("size_a", "size_b") >= F.greatest("size_a", "size_b") * OVERLAP)


def _both(utterances: DataFrame) -> list[tuple[DataFrame, DataFrame]]:
    """Members and links by text, and by waveform."""
    by_text = _linked(_seen_texts(utterances), "text", _text_keys, _near_text, _same_text)
    return [by_text, _linked(_seen_waves(utterances), "wave", _wave_keys, _near_wave, _same_audio)]


def overlaps(utterances: DataFrame) -> DataFrame:
    """(utt_id_a, utt_id_b), smaller first, each pair once: a record of an evaluation split and one of train that overlap.

    Texts of fewer than six words, null and empty texts and unreadable, silent or stereo audio link nothing; nor do rows
    without utt_id or with a null or other split. Repeated deliveries count as one record. An empty table gives no pairs.
    """
    found = []
    for members, links in _both(utterances):
        left = members.filter("side = 1").select(F.col("cls").alias("cls_a"), F.col("utt_id").alias("e"))
        right = members.filter("side = 0").select(F.col("cls").alias("cls_b"), F.col("utt_id").alias("t"))
        found.append(links.join(left, "cls_a").join(right, "cls_b").filter("e <> t"))
    return found[0].select("e", "t").unionByName(found[1].select("e", "t")).select(F.least("e", "t").alias("utt_id_a"), F.greatest("e", "t").alias("utt_id_b")).distinct()


def overlap_report(utterances: DataFrame) -> DataFrame:
    """(split, corpus, n_records, n_overlapping, n_pairs) of the evaluation records, the numbers of what ``overlaps`` lists.

    No pair is listed: a record overlaps with the training members of the classes that its text is linked to, and of those
    that its waveform is linked to, less those that both name, which are counted per combination of classes, and less itself, should
    it be delivered under both splits.
    """
    split = F.lower(F.trim("split"))
    known = utterances.filter("utt_id is not null").filter(split.isin(*EVALUATION)).groupBy("utt_id").agg(F.min(F.struct(split.alias("split"), corpus_name("corpus").alias("corpus"))).alias("r")).select("utt_id", "r.*")
    (text, by_text), (wave, by_wave) = _both(utterances)
    counted = []
    for members, links in ((text, by_text), (wave, by_wave)):
        partners = links.join(members.filter("side = 0").groupBy(F.col("cls").alias("cls_b")).agg(F.count(F.lit(1)).alias("n")), "cls_b").groupBy("cls_a").agg(F.sum("n").alias("n"))
        counted.append(members.filter("side = 1").join(partners, F.col("cls") == F.col("cls_a")).select("utt_id", "n"))
    # records with both a text and a waveform, per combination of their classes
    both = staged(text.withColumnRenamed("cls", "text").join(wave.withColumnRenamed("cls", "wave"), ["utt_id", "side"]), "of-both-kinds")
    trained = both.filter("side = 0").groupBy(F.col("text").alias("text_b"), F.col("wave").alias("wave_b")).agg(F.count(F.lit(1)).alias("n"))
    asked = both.filter("side = 1").select("text", "wave").distinct()
    text_links, wave_links = by_text.select(F.col("cls_a").alias("text"), F.col("cls_b").alias("text_b")), by_wave.select(F.col("cls_a").alias("wave"), F.col("cls_b").alias("wave_b"))
    twice = asked.join(wave_links, "wave").join(trained, "wave_b").join(text_links, ["text", "text_b"]).groupBy("text", "wave").agg(F.sum("n").alias("n"))
    counted.append(both.filter("side = 1").join(twice, ["text", "wave"]).select("utt_id", (-F.col("n")).alias("n")))
    # a record that is on both sides is not its own partner
    for members, links in ((text, by_text), (wave, by_wave)):
        own = members.filter("side = 1").select("utt_id", F.col("cls").alias("cls_a")).join(members.filter("side = 0").select("utt_id", F.col("cls").alias("cls_b")), "utt_id")
        counted.append(own.join(links, ["cls_a", "cls_b"]).select("utt_id", F.lit(0).cast("bigint").alias("n"), F.lit(1).alias("self")))
    total = counted[0]
    for more in counted[1:]:
        total = total.unionByName(more, allowMissingColumns=True)
    pairs = total.groupBy("utt_id").agg((F.sum("n") - F.coalesce(F.max("self"), F.lit(0))).alias("pairs")).filter("pairs > 0")
    return known.join(pairs, "utt_id", "left").groupBy("split", "corpus").agg(F.count(F.lit(1)).alias("n_records"), F.count("pairs").alias("n_overlapping"), F.coalesce(F.sum("pairs"), F.lit(0)).alias("n_pairs"))
