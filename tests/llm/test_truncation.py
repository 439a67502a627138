import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from sonolode.llm import truncation as t
from sonolode.session import table

NOUNS = [f"{a}{b}" for a in ("lan", "tor", "mek", "sul", "pir", "dov", "gar", "hes", "bal", "niv") for b in ("tern", "abo", "ilo", "ema", "usk", "ofi")]
SCHEMA = "doc_id long, text string, source string"


def sentence(rng):
    return " ".join(rng.choice(["the", "a", "of"] if i % 3 == 0 else NOUNS) for i in range(rng.randrange(6, 14))) + rng.choice(NOUNS) + "."


def corpus(rng, n, source, limit=None, marks=True, size=1.0):
    rows = []
    for i in range(n):
        k = max(1, int(rng.lognormvariate(1.6, 0.7) * size))
        text = " ".join(sentence(rng) for _ in range(k))
        if not marks:
            text = text.replace(".", "")
        cut = limit is not None and len(text) > limit and rng.random() < 0.6
        rows.append((text[:limit] if cut else text, source, cut))
    return rows


@pytest.fixture(scope="module")
def made():
    rng = random.Random(8)
    rows = corpus(rng, 1500, "radio", 400) + corpus(rng, 1200, "drafts", 300, marks=False) + corpus(rng, 1500, "whole")
    for k in rng.sample(range(2700, 4200), 90):
        text, source, _ = rows[k]
        if len(text) > 60:
            rows[k] = (text[: rng.randrange(20, len(text) - 3)], source, True)
    whole = [(s, src, c and not s.rstrip().endswith(".")) for s, src, c in rows]
    return [(i, *r) for i, r in enumerate(whole)]


def test_cut_texts_are_found(spark, made):
    df = spark.createDataFrame([r[:3] for r in made], SCHEMA)
    got = {r[0] for r in t.cut_documents(df).collect()}
    true = {r[0] for r in made if r[3]}
    assert len(got & true) > 0.93 * len(true) and len(got & true) > 0.93 * len(got)
    rates = {r["source"]: r for r in t.cut_rates(df).collect()}
    assert {r["limit"] for r in t.judge(df).filter("source = 'radio' and p_cut > 0.9").collect()} >= {400}
    assert rates["radio"]["rate"] == pytest.approx(sum(r[3] for r in made if r[2] == "radio") / 1500, abs=0.03)
    assert sum(r["n_cut"] for r in rates.values()) == len(got)


def test_limits_and_fit():
    rng = np.random.default_rng(3)
    x = np.exp(rng.normal(6, 0.5, 20_000)).astype(int) + 20
    cut = np.where((x > 600) & (rng.random(20_000) < 0.7), 600, x)
    lengths, counts = np.unique(cut, return_counts=True)
    (lo, hi, want, _), *more = t.find_limits(lengths, counts.astype(float))
    assert (lo, hi, more) == (600, 600, []) and want < 100
    assert t.find_limits(np.append(lengths, 10**9), np.append(counts, 1.0))[0][:2] == (600, 600)
    surplus = np.where(lengths == 600, counts - want, 0)
    mu, sd = t.fit_lengths(lengths, counts.astype(float), surplus)
    # the 70 % that are censored are only in part those beyond the limit, so the tail is a little heavy
    assert mu == pytest.approx(6.05, abs=0.1) and sd == pytest.approx(0.5, abs=0.1)
    assert t.find_limits(*[np.unique(x, return_counts=True)[0], np.unique(x, return_counts=True)[1].astype(float)]) == []


def test_limits_of_any_size_and_number():
    """A limit beyond a million characters, and forty limits in one source, all found."""
    rng = np.random.default_rng(5)
    x = np.exp(rng.normal(14.5, 0.5, 30_000)).astype(int)
    cut = np.where((x > 3_000_000) & (rng.random(30_000) < 0.7), 3_000_000, x)
    found = t.find_limits(*(a.astype(float) if i else a for i, a in enumerate(np.unique(cut, return_counts=True))))
    assert [f[:2] for f in found] == [(3_000_000, 3_000_000)]
    limits = np.arange(40) * 1000 + 1000
    many = np.concatenate([np.exp(rng.normal(9.5, 1.0, 40_000)).astype(int), np.repeat(limits, 300)])
    found = t.find_limits(*(a.astype(float) if i else a for i, a in enumerate(np.unique(many, return_counts=True))))
    assert {f[1] for f in found} == set(limits.tolist())


def test_begins_known(spark):
    rng = random.Random(4)
    known = {"".join(rng.choice("abé") for _ in range(rng.randrange(1, 9))) for _ in range(300)} | {"z" * 100_000}
    unknown = {"".join(rng.choice("abé") for _ in range(rng.randrange(1, 9))) for _ in range(600)} | {"z" * 99_999, "zz", "zy"}
    unknown -= known
    two = [spark.createDataFrame([(w,) for w in ws], "word string") for ws in (unknown, known)]
    for parts in ("2", "16"):
        spark.conf.set("spark.sql.shuffle.partitions", parts)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        got = sorted(r[0] for r in t.begins_known(*two).collect())
        assert got == sorted(w for w in unknown if any(k.startswith(w) for k in known))
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


@pytest.mark.parametrize("text", ["half of an <br" + " " * 5000, "see <a href=\"" + "x" * 500, "so the &am" + "\n" * 1000])
def test_broken_ends_far_back(text):
    assert t.ending(text)[0] == "broken"


@pytest.mark.parametrize("text", ["so the <br", "so the &am", "so the \\u01", "caf�", "see <a href=\"x"])
def test_broken_ends(text):
    assert t.ending(text)[0] == "broken"


@pytest.mark.parametrize(("text", "cls"), [("done.", "stop"), ("done?”\n", "stop"), ("well…", "ellipsis"), ("(x)", "closed)"), ("no", "wordx"), ("Jo", "wordX"), ("12", "number0"), ("#tag", "tag"), ("and,", "open"), ("", "none"), (" \n", "none"), ("if a <b then " + "c " * 80, "wordx"), ("x" * 10_000, "wordx")])
def test_ends(text, cls):
    assert t.ending(text)[0] == cls


def test_edges(spark, small):
    docs = table(spark, small, "documents")
    assert t.cut_documents(docs.limit(0)).count() == t.cut_rates(docs.limit(0)).count() == 0
    odd = spark.createDataFrame([(1, None, "a"), (2, "", "a"), (3, "   ", None), (None, "x <br", "a"), (4, "half of an <br", "a"), (4, "half of an <br", "a"), (5, "y" * 200_000, "b"), (6, "z", "b")], SCHEMA).withColumns({n: F.lit(1) for n in ("zone", "p", "end", "kind", "unit", "size", "n", "same", "word", "limit")})
    assert [r[0] for r in t.cut_documents(odd).collect()] == [4]
    judged = t.judge(odd).collect()
    assert len(judged) == 7 and {r["p_cut"] for r in judged if r["doc_id"] in (2, 3)} == {0.0}
