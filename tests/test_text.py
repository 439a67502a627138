import unicodedata

import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sonolode.functions import text, tones
from sonolode.functions.syllables import syllabified, syllabify

SYLLABLES = {
    "Un nɔ́ ɖu nǔ": "un nɔ1 ɖu nu3",
    "Kɔ́xojí, ɖ'é mɛ !": "kɔ1 xo ji1 ɖe1 mɛ",
    "kɔ́ xo jí ɖé mɛ": "kɔ1 xo ji1 ɖe1 mɛ",
    "Azɔ̌mɛ 2026": "a zɔ3 mɛ",
    "": "",
    "?!": "",
    "Mǐ ná yi gbɛ̀ ń": "mi3 na1 yi gbɛ2 n1",
}


def test_syllables(spark):
    for given_, expected in SYLLABLES.items():
        assert syllabify(given_) == expected
    df = spark.createDataFrame([(k, v) for k, v in SYLLABLES.items()] + [(None, "")], "a string, b string")
    assert df.filter(syllabified("a") != F.col("b")).count() == 0


@pytest.mark.parametrize(
    ("given_", "language", "numbers", "expected"),
    [
        ("Café, (Sam 23:17) it's", "eng", False, "caf it's"),
        ("123", "eng", True, "123"),
        ("12 cats 3", "eng", True, "cats"),
        ("12 cats 3", "eng", False, "12 cats 3"),
        ("é5 x", "eng", True, "5 x"),
        ("5 x", "eng", True, "x"),
        ("don’t &lt;b&gt;", "eng", False, "don't b"),
        ("a#b", "*", False, "a#b"),
        ("Ẹ kú àárọ̀!", "yor", False, "ẹ kú àárọ̀"),
        (None, "eng", False, ""),
        ("  \n", "eng", False, ""),
        ("x" * 100_000, "eng", False, "x" * 100_000),
        ("a’b’c’ ’d e’", "*", False, "a b'c d e"),
        ("a’" * 100_000, "*", False, "a " * 99_998 + "a'a"),
    ],
)
def test_normalize(given_, language, numbers, expected):
    assert text.normalize(given_, language, remove_numbers=numbers) == expected


@given(st.text(max_size=60), st.sampled_from(sorted(text.LETTERS)))
def test_only_the_alphabet_is_left(raw, language):
    allowed = text._alphabet(language)
    assert all(c in allowed for c in unicodedata.normalize("NFD", text.normalize(raw, language)))


def test_phrases(spark):
    table = {"chewing gum": "chingum", "the": "di", "talk": "tok", "a b c": "x"}
    cases = {"chewing gum the talk": "chingum di tok", "": "", "  the \t gum": "di gum", "a b the a b c": "a b di x", "The": "The", "chewing": "chewing"}
    for raw, expected in cases.items():
        assert text.replace_phrases(raw, table) == expected
    df = spark.createDataFrame(list(cases.items()), "a string, b string")
    assert df.filter(text.with_phrases("a", table) != F.col("b")).count() == 0
    with pytest.raises(ValueError):
        text.phrase_table({"A!": "x", "a": "y"})


def test_native_steps_equal_the_kernel(spark):
    raw = ["a snap snapped", "ọ́snap snap", "12 cats 3", "12", "(Sam 23:17) x (y)", "&lt;b&gt; a&nbsp", "a 　b\x1cc", "", None, "1 2 3"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(raw)], "i int, t string")
    got = {r["i"]: r for r in df.select("i", text.without_words("t", ["snap"]).alias("w"), text.collapsed("t").alias("c"), text.without_number_words("t").alias("n")).collect()}
    for i, t in enumerate(raw):
        if t is None:
            assert got[i]["c"] is None
            continue
        assert got[i]["c"] == " ".join(t.split())
        p = text._patterns("eng")["number"]
        assert got[i]["n"] == " ".join(p.sub(" ", " ".join(t.split())).split())
    assert got[0]["w"] == "a snapped"


def test_tones(spark):
    df = spark.createDataFrame([("áò", "x"), ("á", "y"), (None, "z"), ("", "e")], "t string, k string")
    got = {r["k"]: r["v"] for r in df.select("k", tones.tone_vector("t").alias("v")).collect()}
    assert got == {"x": [1, -1], "y": [0, 1], "z": None, "e": []}
    pairs = spark.createDataFrame([([1, -1], [1, 0, -1], 2 / 3), ([1, 0, 1], [1], 0.5), ([0], [0, 0], float("nan"))], "h array<int>, r array<int>, e double")
    rows = pairs.select(tones.tone_errors("h", "r").alias("v"), "e").collect()
    assert all(v == pytest.approx(e, nan_ok=True) for v, e in rows)


def test_sentence_starts():
    assert text.lower_sentence_starts("The end. USA won! A b — C") == "the end. USA won! a b — c"
