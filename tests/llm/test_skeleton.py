import unicodedata

import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sonolode.llm import skeleton as s
from sonolode.session import table

ALIKE = [("café", "café"), ("саt", "cat"), ("Ｔｈｅ　ｃａｔ２", "The cat2"), ("ﬁne oﬃce", "fine office"), ("a​b­c﻿", "abc"), ("a b c", "a b c"), ("don’t donʼt", "don't don't"), ("  x\n", "x"), ("ọ́", "ọ́"), ("ọ́", "ọ́"), ("ı́", "í"), ("ɛ́", "έ"), ("ǌa", "nja"), ("ọ͏́", "ọ́"), ("a\r\nb", "a\nb"), ("ᎪᏚ", "AS"), ("ꓐ", "B"), ("ⲟⲞ", "oO"), ("Ⅴⅼ", "Vl"), ("Ⅷ", "VIII"), ("ᴏ", "o"), ("α", "ɑ"), ("ι", "ɩ"), ("υ", "ʋ"), ("γ", "ɣ"), ("𝐀𝑏𝕮", "AbC"), ("ӘǝΣ", "ƏəƩ"), ("Տօ", "So"), ("Ά", "Á")]
DIFFERENT = [("cat", "Cat"), ("ọ", "o"), ("ó", "ò"), ("ɓa", "ba"), ("a.", "a"), ("I", "l"), ("0", "O"), ("a  b", "a b"), ("ı", "i"), ("x²", "x2"), ("ń", "ñ"), ("rn", "m"), ("a?", "a!"), ("ɖ", "d"), ("…", "."), ("a\nb", "a b"), ("α", "a"), ("ι", "i"), ("υ", "u"), ("γ", "y"), ("η", "n"), ("ᴋ", "k"), ("З", "3"), ("①", "1")]


@pytest.mark.parametrize(("a", "b"), ALIKE)
def test_alike(a, b):
    assert s.skeleton(a) == s.skeleton(b)


@pytest.mark.parametrize(("a", "b"), DIFFERENT)
def test_different(a, b):
    assert s.skeleton(a) != s.skeleton(b)


@given(st.text(max_size=40))
def test_forms_do_not_matter(t):
    assert s.skeleton(s.skeleton(t)) == s.skeleton(t) == s.skeleton(unicodedata.normalize("NFC", t)) == s.skeleton(unicodedata.normalize("NFD", t))


def test_letters_of_the_languages_stay_apart():
    letters = "abcdefghijklmnopqrstuvwxyzɓɗƙƴɖɛɔŋɣƒʋ"
    marked = {unicodedata.normalize("NFC", c + m) for c in letters + letters.upper() for m in ("", "\u0323", "\u0300", "\u0301", "\u0304", "\u0323\u0301", "\u0307", "\u0302", "\u030c", "\u0303")}
    assert len({s.skeleton(x) for x in marked}) == len(marked)


def test_table_agrees_with_the_list_by_latin_letter():
    listed = {x: row[0] for row in s._LOOK_ALIKES.replace("|", "\n").split("\n") if row for x in row[2:].split(" ")}
    assert listed == {a: b for shapes, to in s._SHAPES.items() for a, b in zip(shapes, to, strict=True)}


def test_look_alikes(spark, small):
    fixed = spark.createDataFrame([(1, "The cat"), (2, "the cat"), (3, None), (4, "​"), (5, "Ｔhe cat")], "prompt_id long, text string")
    rows = spark.createDataFrame([(10, "Tһe cat", "x"), (10, "Tһe cat", "x"), (11, "The cat", ""), (12, None, ""), (13, "", ""), (None, "Tһe cat", ""), (14, "THE CAT", ""), (15, " " * 1000 + "the cat", "")], "utt_id long, text string, k string").withColumns({"t": F.lit(1), "u": F.lit(2), "prompt_id": F.lit(3)})
    assert {tuple(r) for r in s.look_alikes(rows, fixed).collect()} == {(10, 1), (10, 5), (11, 5), (15, 2)}
    assert s.look_alikes(rows.limit(0), fixed).count() == s.look_alikes(rows, fixed.limit(0)).count() == 0
    groups = {r["form"]: (r["n_rows"], r["n_variants"], r["most_common"]) for r in s.variants(rows).collect()}
    assert groups == {"The cat": (4, 2, "Tһe cat")}
    assert s.variants(rows.limit(0)).count() == 0
    forms = {r["utt_id"]: r["form"] for r in s.consistent_form(rows.filter("utt_id is not null"), "utt_id").collect()}
    assert forms == {10: "The cat", 11: "The cat", 12: None, 13: "", 14: "THE CAT", 15: "the cat"}


def test_tables(spark, small):
    u, p = table(spark, small, "utterances"), table(spark, small, "prompts")
    got = {tuple(r) for r in s.look_alikes(u, p).collect()}
    prompts = [(r["prompt_id"], r["text"], s.skeleton(r["text"])) for r in p.collect()]
    expected = {(r["utt_id"], i) for r in u.collect() if r["text"] for i, t, k in prompts if s.skeleton(r["text"]) == k and t != r["text"]}
    assert got == expected
