"""Problem 8: texts cut off by field limits or broken transfers, and how often each source cuts.

Lengths. For each source a log-normal length distribution, right-censored at the source's limits, is fitted by maximum
likelihood to the histogram of lengths, in characters and in bytes. Where the histogram stands far above the fitted density at one
length, or over the few lengths below it that cuts at whole words or characters leave, lies a candidate limit; the fit
then treats the surplus as censored and is repeated. The share of the surplus is the prior probability of censoring there.

Endings. The same documents, each cut at a hashed place (inside words, and between them), show what the ends of cut texts of the
source look like: the sign at the end, whether the last word is one that the corpus knows or the beginning of one, how readily it closes a
sentence, and whether a phrase stands there that closes texts far more often than chance cuts hit it. The ends of the source's documents are a mixture of those and of complete ends. Its share of cut texts is what the ends that
complete texts do not have allow for; the complete ends are what is left. At each limit an expectation-maximization over
the same classes of ends splits its documents into complete and cut, starting at the censoring prior, and what neither kind of end
explains there (a mark that the cutting system put behind the text) counts as cut.

A document's posterior is that of its limit or else of its source, given its end; an end inside a tag, an entity, an
escape or a character is a cut. Only counts per source, class of end and length meet in one place; words are looked up by a join,
and whether one begins a known word by its successor among the known words in order.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sonolode.functions.names import corpus_name
from sonolode.session import staged

#: A word must occur so often within texts to be known.
KNOWN = 5
#: Widths of the stretches of lengths at which limits are looked for: exact, bytes of a character, a word, a word and a mark.
WIDTHS = (1, 4, 16)
#: A limit stands out by so many standard deviations, so many documents, and so many times the expected number.
SIGNIFICANT, FEWEST, TIMES = 7.0, 10, 3.0
#: Least posterior of a document that is reported.
THRESHOLD = 0.5
#: What is known of a source before any of its documents: so many texts, of which that share is cut.
PRIOR_TEXTS, PRIOR_SHARE = 50, 0.02
#: Distinct words that a task counts before it passes its counts on.
COUNTED = 200_000
#: Documents that a phrase must close to count as a closing phrase, and its least odds against a chance cut.
PHRASE, PHRASE_ODDS = 20, 20.0

_BROKEN = re.compile(r"(�|</?|&#?\w{0,8}|\\(u[0-9A-Fa-f]{0,3}|x[0-9A-Fa-f]?)?)$")
_TAG = re.compile(r"<[/!]?[A-Za-z][^<>\n]*$")
#: What follows a ``<`` without an end is a tag if it is no longer than this, or if a quoted attribute stands in it.
TAG = 61
_CLOSERS = "\"'”’»)]*_“‘"
_EDGE = " .,;:!?\"“”'‘’()[]{}<>…—–-*_#/\\|=+~`«»"


def _bare(token: str) -> str:
    return token.strip(_EDGE).lower()


def _hash(word: str) -> int:
    import xxhash

    h = xxhash.xxh64_intdigest(word.encode("utf-8", "surrogatepass"))
    return h - (1 << 64) if h >> 63 else h


def _shape(token: str) -> str:
    bare = token.strip(_EDGE)
    if not bare:
        return "-"
    if any(c.isdigit() for c in bare):
        return "0" if bare.isdigit() else "0x"
    return "X" if bare[0].isupper() else "x"


def _open_tag(tail: str) -> bool:
    """Whether the text ends inside a tag."""
    at = tail.rfind("<")
    if at < 0 or not _TAG.match(tail, at):
        return False
    return len(tail) - at <= TAG + 1 or '="' in tail[at:] or "='" in tail[at:]


def ending(text: str) -> tuple[str, str | None, str | None, str | None]:
    """(class of the end, last word if it needs a look-up, two phrases that may close texts) of a text."""
    n = len(text)
    while n and (text[n - 1].isspace() or unicodedata.category(text[n - 1]) == "Cf"):
        n -= 1
    tail = text[:n]
    if not tail:
        return "none", None, None, None
    if _BROKEN.search(tail[-16:]) or _open_tag(tail):
        return "broken", None, None, None
    tokens = tail.rsplit(None, 2)
    last, before = tokens[-1], tokens[-2] if len(tokens) > 1 else ""
    core = tail.rstrip(_CLOSERS)
    end = core[-1:] if core else tail[-1]
    phrases = f"{_bare(before)}|{_shape(last)}{last[-1] if not last[-1].isalnum() else ''}", f"{_shape(before)}|{last.lower()}"
    if end in ".?!" and not core.endswith(".."):
        return "stop", None, *phrases
    if end == "…" or core.endswith(".."):
        return "ellipsis", None, *phrases
    if tail[-1] in ")]}*":
        return "closed" + tail[-1], None, *phrases
    if tail[-1] in "\"”’»'":
        return "quoted", None, *phrases
    if end in ",;:—–-(“‘[":
        return "open", None, *phrases
    if last[:1] == "#":
        return "tag", None, *phrases
    shape = _shape(last)
    if shape in ("0", "0x", "-"):
        return "number" + shape, None, *phrases
    return "word" + shape, _bare(last), *phrases


def _cuts(doc: int, text: str) -> tuple[str, str]:
    """``text`` cut at a hashed place, and at the end of the word before one."""
    h = _hash(f"{doc}:{len(text)}") & 0xFFFFFFFF
    at = 1 + h % (len(text) - 1)
    words = text[: 1 + h // 7 % (len(text) - 1)]
    space = max(words.rfind(" "), words.rfind("\n"))
    return text[:at], words[:space] if space > 0 else words


_TAIL = "same bigint, doc_id bigint, source string, n_chars int, n_bytes int, kind int, cls string, word string, p1 string, p2 string"
_COUNT = "n bigint, closes bigint"


def _read(rows: DataFrame) -> DataFrame:
    """One reading of (same, doc_id, source, text). Kinds 0, 1, 2: the end of each document and of two cuts of it. Kind -1: words and their counts.

    A word counts where it stands within a text, not as its last token; closes counts where it closes a sentence. Tasks count their own texts
    and pass on what they have at ``COUNTED`` distinct words, so a frequent word costs each task a few rows.
    """
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.int32(), pa.int32(), pa.int32(), pa.string(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.int64()]
    names = ["same", "doc_id", "source", "n_chars", "n_bytes", "kind", "cls", "word", "p1", "p2", "n", "closes"]

    def words(seen: Counter[str]) -> Iterator[pa.RecordBatch]:
        n: Counter[str] = Counter()
        closes: Counter[str] = Counter()
        for token, count in seen.items():
            word = _bare(token)
            n[word] += count
            if token.rstrip(_CLOSERS)[-1:] in (".", "?", "!"):
                closes[word] += count
        keys = list(n)
        for i in range(0, len(keys), 50_000):
            part = keys[i : i + 50_000]
            given = {"kind": [-1] * len(part), "word": part, "n": [n[k] for k in part], "closes": [closes[k] for k in part]}
            yield pa.RecordBatch.from_arrays([pa.array(given[c], t) if c in given else pa.nulls(len(part), t) for c, t in zip(names, kinds)], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter[str] = Counter()
        for b in batches:
            out = []
            for same, doc, source, text in zip(*(c.to_pylist() for c in b.columns)):
                n = len(text)
                raw = len(text.encode("utf-8", "surrogatepass"))
                size = raw - 3 * (n - len(text.rstrip("�")))
                out.append((same, doc, source, n, size, 0, *ending(text), None, None))
                if n >= 20:
                    out += [(same, doc, source, n, size, k, *ending(t), None, None) for k, t in enumerate(_cuts(doc or 0, text), 1)]
                seen.update(text.split()[:-1])
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)], names=names)
            if len(seen) > COUNTED:
                yield from words(seen)
                seen.clear()
        yield from words(seen)

    return rows.mapInArrow(run, f"{_TAIL}, {_COUNT}")


def begins_known(unknown: DataFrame, known: DataFrame) -> DataFrame:
    """(word): those of ``unknown`` with which a word of ``known`` begins; both (word) without repeats, and none in common.

    In order of code points the words that begin with w follow right behind it, so that w begins a known word if its successor among
    them does so. Each task goes through its range; what is open at its end is answered by the first known word of a later range.
    """
    every = known.select("word", F.lit(True).alias("known")).unionByName(unknown.select("word", F.lit(False).alias("known")))
    ranged = every.repartitionByRange("word").sortWithinPartitions("word")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, first, pending = TaskContext.get().partitionId(), None, []  # pending: each one begins the next

        def rows(found: list[str], what: int) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([part] * len(found), pa.int32()), pa.array([what] * len(found), pa.int32()), pa.array(found, pa.string())], names=["part", "what", "word"])

        for b in batches:
            hits = []
            for word, is_known in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                while pending and not word.startswith(pending[-1]):
                    pending.pop()
                if is_known:
                    first = word if first is None else first
                    hits += pending
                    pending.clear()
                else:
                    pending.append(word)
            if hits:
                yield rows(hits, 0)
        yield rows(pending, 1)
        if first is not None:
            yield rows([first], 2)

    swept = staged(ranged.mapInArrow(run, "part int, what int, word string"), "begun")
    ends = swept.filter("what > 0").orderBy("part").collect()  # of each range its first known word, and what begins its last word
    firsts = [(r["part"], r["word"]) for r in ends if r["what"] == 2]
    late = [(r["word"],) for r in ends if r["what"] == 1 and next((k for p, k in firsts if p > r["part"]), "").startswith(r["word"])]
    return swept.filter("what = 0").select("word").unionByName(known.sparkSession.createDataFrame(late, "word string"))


def fit_lengths(lengths: np.ndarray, counts: np.ndarray, surplus: np.ndarray) -> tuple[float, float]:
    """(mean, deviation) of log length by maximum likelihood; ``surplus`` of the counts is censored at its length.

    Expectation-maximization: a censored length stands for the mean of the distribution beyond it.
    """
    x, plain = np.log(np.maximum(lengths, 1)), counts - surplus
    total = counts.sum()
    mu = float((x * counts).sum() / total)
    sd = max(0.05, float(np.sqrt(((x - mu) ** 2 * counts).sum() / total)))
    if surplus.sum() == 0:
        return mu, sd
    at = np.flatnonzero(surplus)
    held, y = surplus[at], x[at]
    for _ in range(30):
        z = (y - mu) / sd
        beyond = np.maximum(0.5 * _erfc(z / math.sqrt(2)), 1e-12)
        hazard = np.exp(-0.5 * z * z) / math.sqrt(2 * math.pi) / beyond
        first = mu + sd * hazard
        second = mu * mu + sd * sd + sd * (y + mu) * hazard
        new = float(((x * plain).sum() + (first * held).sum()) / total)
        var = float(((x * x * plain).sum() + (second * held).sum()) / total) - new * new
        mu, sd = new, max(0.05, math.sqrt(max(var, 1e-4)))
    return mu, sd


_erfc = np.vectorize(math.erfc, otypes=[float])


def find_limits(lengths: np.ndarray, counts: np.ndarray) -> list[tuple[int, int, float, float]]:
    """(lowest length, highest length, expected number of uncut documents, surplus over it) of each limit in a histogram of one source.

    The histogram has a row for each length that occurs, of any size; the search ends when no limit stands out any more.
    """
    order = np.argsort(lengths)
    x, hist = lengths[order].astype(np.int64), counts[order].astype(float)
    surplus = np.zeros(len(x))
    taken = x < 20
    found: list[tuple[int, int, float, float]] = []
    while len(x):
        mu, sd = fit_lengths(x, hist, surplus)
        total = np.concatenate([[0.0], np.cumsum(np.where(taken, 0, hist))])

        def within(lo: np.ndarray, hi: np.ndarray, total: np.ndarray = total) -> np.ndarray:
            return total[np.searchsorted(x, hi, "right")] - total[np.searchsorted(x, lo, "left")]

        def above(at: np.ndarray, mu: float = mu, sd: float = sd) -> np.ndarray:
            return 0.5 * _erfc((np.log(np.maximum(at + 0.5, 0.5)) - mu) / sd / math.sqrt(2))

        best, top, around = None, above(x), within(x - 31, x + 32)
        for width in WIDTHS:
            seen, want = within(x - width + 1, x), (above(x - width) - top) * hist.sum()
            # beside the fit, the lengths around tell how many are usual
            near = (around - seen) / (64 - width) * width
            want = np.maximum(want, np.minimum(near, seen))
            score = np.where((seen >= FEWEST) & (seen > TIMES * want), (seen - want) / np.sqrt(want + 1), 0)
            at = int(score.argmax())
            if score[at] > SIGNIFICANT and (best is None or score[at] > best[0] * 1.15):
                best = (float(score[at]), max(int(x[at]) - width + 1, 0), int(x[at]), float(want[at]))
        if best is None:
            break
        _, lo, hi, want = best
        inside = (x >= lo) & (x <= hi)
        held = float(hist[inside].sum())
        found.append((lo, hi, want, held - want))
        taken |= inside
        surplus[inside] = hist[inside] * max(0.0, 1 - want / held)
    return found


def _limits_of(pdf: pd.DataFrame) -> pd.DataFrame:
    rows = []
    for unit, part in pdf.groupby("unit"):
        part = part[part["size"] > 0]
        if len(part):
            rows += [(pdf["source"].iloc[0], unit, *limit) for limit in find_limits(part["size"].to_numpy(np.int64), part["n"].to_numpy(float))]
    return pd.DataFrame(rows, columns=["source", "unit", "lo", "hi", "want", "surplus"])


def split_ends(seen: np.ndarray, complete: np.ndarray, cuts: list[np.ndarray], start: float) -> np.ndarray:
    """Posterior of a cut per class of end, from the counts ``seen`` at a limit; distributions of complete and cut ends; ``start``: prior of a cut."""
    n = seen.sum()
    parts = [complete, *cuts]
    weight = np.array([1 - start, *[start / len(cuts)] * len(cuts)])
    odd = np.full(len(seen), 1e-4)
    for _ in range(60):
        joint = np.array([w * p for w, p in zip(weight, parts)]) + 1e-12
        share = joint / (joint.sum(axis=0) + odd)
        weight = np.maximum((share * seen).sum(axis=1) / max(n, 1), 1e-6)
        weight = weight / weight.sum()
    # the rest, which neither kind of end explains, is a mark behind a cut
    expected = n * weight[0] * complete
    return np.clip(1 - expected / np.maximum(seen, 1e-9), 0, 1)


def cut_share(real: np.ndarray, cut: np.ndarray) -> float:
    """Share of cut texts that the ends allow for: no class of ends is rarer than the cut texts' part of it.

    A source of few documents is judged with ``PRIOR_TEXTS`` more, of which the share ``PRIOR_SHARE`` is cut.
    """
    fine = cut >= 0.03
    if not fine.any():
        return PRIOR_SHARE
    # one standard error up, as the least of several ratios is biased down
    seen = real[fine] + np.sqrt(real[fine]) + PRIOR_SHARE * PRIOR_TEXTS * cut[fine]
    ratio = seen / (cut[fine] * (real.sum() + PRIOR_TEXTS))
    return float(min(0.5, max(1e-4, ratio.min())))


def _posteriors(pdf: pd.DataFrame) -> pd.DataFrame:
    """(source, zone, end, p) from counts (source, zone, kind, end, n, want) of one source; zone -1 is away from limits."""
    source = pdf["source"].iloc[0]
    ends = sorted(pdf["end"].unique())
    at = {e: i for i, e in enumerate(ends)}

    def counts(rows: pd.DataFrame) -> np.ndarray:
        out = np.zeros(len(ends))
        for e, n in zip(rows["end"], rows["n"]):
            out[at[e]] += n
        return out

    broken = np.array([e == "broken" for e in ends])
    real = np.where(broken, 0, counts(pdf[(pdf["kind"] == 0) & (pdf["zone"] == -1)]))
    char, word = (np.where(broken, 0, counts(pdf[pdf["kind"] == k])) + 0.05 for k in (1, 2))
    char, word = char / char.sum(), word / word.sum()
    share = cut_share(real, char)
    left = np.maximum(real - share * real.sum() * char, 0) + 0.01
    complete = left / left.sum()
    out = []
    p = np.clip(share * real.sum() * char / np.maximum(real, 1e-9), 0, 1)
    p = np.where(real > 0, np.minimum(p, 1), 0)
    out += [(source, -1, e, 0.97 if e == "broken" else float(v), char[at[e]] / complete[at[e]]) for e, v in zip(ends, p)]
    for zone, rows in pdf[(pdf["kind"] == 0) & (pdf["zone"] >= 0)].groupby("zone"):
        seen = np.where(broken, 0, counts(rows))
        start = min(0.99, max(0.05, 1 - float(rows["want"].iloc[0]) / max(seen.sum(), 1)))
        p = split_ends(seen, complete, [char, word], start)
        out += [(source, int(zone), e, 0.97 if e == "broken" else float(v), 0.0) for e, v in zip(ends, p) if seen[at[e]] > 0 or e == "broken"]
    return pd.DataFrame(out, columns=["source", "zone", "end", "p", "odds"])


def judge(documents: DataFrame) -> DataFrame:
    """(doc_id, source, n_chars, unit, limit, p_cut) for each document with a text.

    ``limit`` and ``unit`` name the limit that the length is at, null away from all. Null texts have no row; empty and blank
    ones have p_cut 0. Equal texts share the highest posterior of their copies, under whatever source. Rows that repeat a
    doc_id have a row each; a null source is a source like any other.
    """
    texts = documents.select(F.col("doc_id").cast("bigint"), F.coalesce(corpus_name("source"), F.lit("")).alias("source"), F.col("text").cast("string").alias("text")).filter("text is not null")
    read = staged(_read(texts.select(F.xxhash64("text").alias("same"), "doc_id", "source", "text")), "read", by=("kind",))
    tails = read.filter("kind >= 0").select([n.split()[0] for n in _TAIL.split(", ")])
    # words that occur KNOWN times within texts
    words = read.filter("kind = -1").groupBy("word").agg(F.sum("n").alias("n"), F.sum("closes").alias("closes")).filter(f"n >= {KNOWN} and word <> ''")
    words = staged(words, "known-words")
    unknown = tails.filter("word <> ''").select("word").distinct().join(words, "word", "left_anti")
    begun = begins_known(unknown, words.select("word")).withColumn("begun", F.lit(True))
    plain = tails.filter("word is null").withColumn("end", F.col("cls"))
    closing = F.col("closes") / F.col("n")
    grade = F.when(F.col("n").isNull(), F.when(F.col("begun"), "begun").otherwise("?")).when(closing < 0.002, "never").when(closing < 0.03, "seldom").when(closing < 0.15, "often").otherwise("mostly")
    looked = tails.filter("word is not null").join(words, "word", "left").join(begun, "word", "left").withColumn("end", F.concat_ws(":", "cls", grade)).select(plain.columns)
    tails = staged(plain.unionByName(looked), "tails")
    for name in ("p1", "p2"):
        closed, chance = F.sum((F.col("kind") == 0).cast("int")), F.sum((F.col("kind") == 1).cast("int"))
        phrases = tails.filter(f"{name} is not null and cls <> 'stop'").groupBy(name).agg(closed.alias("c"), chance.alias("h")).filter(f"c >= {PHRASE} and c >= {PHRASE_ODDS} * (h + 1)").select(name, F.lit(True).alias(f"{name}_closes"))
        tails = tails.join(phrases, name, "left")
    tails = tails.withColumn("end", F.when((F.col("p1_closes") | F.col("p2_closes")) & ~F.col("cls").isin("stop", "broken", "ellipsis"), "phrase").otherwise(F.col("end")))
    tails = tails.drop("p1", "p2", "p1_closes", "p2_closes", "word", "cls")

    real = tails.filter("kind = 0")
    sizes = real.select("source", F.explode(F.array(F.struct(F.lit("chars").alias("unit"), F.col("n_chars").alias("size")), F.struct(F.lit("bytes").alias("unit"), F.col("n_bytes").alias("size")))).alias("s")).select("source", "s.*")
    hist = sizes.groupBy("source", "unit", "size").agg(F.count(F.lit(1)).alias("n"))
    limits = hist.groupBy("source").applyInPandas(_limits_of, "source string, unit string, lo int, hi int, want double, surplus double")
    limits = staged(limits.withColumn("zone", F.monotonically_increasing_id()), "limits")  # a few rows per source

    size = F.when(F.col("unit") == "chars", F.col("n_chars")).otherwise(F.col("n_bytes"))
    # texts as long in bytes as in characters show a limit in both units; it is that of the unit in which it stands out more
    near = limits.groupBy("source").agg(F.sort_array(F.collect_list(F.struct((-F.col("surplus")).alias("order"), "zone", "unit", "lo", "hi", "want"))).alias("limits"))
    own = F.filter("limits", lambda x: F.when(x["unit"] == "chars", F.col("n_chars")).otherwise(F.col("n_bytes")).between(x["lo"], x["hi"]))
    placed = tails.join(near, "source", "left").withColumn("at", F.try_element_at(own, F.lit(1))).drop("limits")
    placed = placed.withColumn("zone", F.coalesce(F.col("at.zone"), F.lit(-1)))
    counts = placed.groupBy("source", "zone", "kind", "end").agg(F.count(F.lit(1)).alias("n"), F.max("at.want").alias("want"))
    odds = staged(counts.groupBy("source").applyInPandas(_posteriors, "source string, zone bigint, end string, p double, odds double"), "posteriors")

    docs = placed.filter("kind = 0").join(odds, ["source", "zone", "end"], "left")
    p = F.when(F.col("end") == "none", F.lit(0.0)).otherwise(F.coalesce("p", F.lit(0.0)))
    docs = docs.withColumn("p", p)
    # a text that is cut where it came from is cut wherever it is repeated
    copies = docs.filter("end <> 'none'").groupBy("same").agg(F.max("p").alias("most"), F.count(F.lit(1)).alias("copies")).filter("copies > 1 and most > 0").drop("copies")
    docs = docs.join(copies, "same", "left")
    return docs.select("doc_id", F.nullif("source", F.lit("")).alias("source"), "n_chars", F.col("at.unit").alias("unit"), F.col("at.hi").alias("limit"), F.round(F.coalesce("most", "p"), 6).alias("p_cut"), "end")


def cut_documents(documents: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id) of the documents whose text is cut, each once; null ids are left out."""
    return judge(documents).filter((F.col("p_cut") >= threshold) & F.col("doc_id").isNotNull()).select("doc_id").distinct()


def cut_rates(documents: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(source, n_texts, n_cut, n_at_limit, rate, expected_rate) per source; expected_rate is the mean posterior."""
    judged = judge(documents)
    cut = F.sum((F.col("p_cut") >= threshold).cast("bigint"))
    return judged.groupBy("source").agg(F.count(F.lit(1)).alias("n_texts"), cut.alias("n_cut"), F.count("limit").alias("n_at_limit"), (cut / F.count(F.lit(1))).alias("rate"), F.avg("p_cut").alias("expected_rate"))
