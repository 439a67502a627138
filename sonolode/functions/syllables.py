"""Syllables of tonal texts with the tone of each as a digit: ``Un nɔ́ ɖu nǔ`` is ``un nɔ1 ɖu nu3``."""

from __future__ import annotations

import re
import unicodedata

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sonolode.functions.names import _col

# Tone marks (acute, grave, caron, circumflex, macron) and their digits.
TONES = {"́": "1", "̀": "2", "̌": "3", "̂": "4", "̄": "5"}
# Letters, and letters that stand for another.
LETTERS = "abcdefghijklmnopqrstuvwxyzɔɖɛ"
VOWELS = "aeiouɛɔ"
STAND_INS = {"ε": "ɛ", "ð": "ɖ", "đ": "ɖ", "ɗ": "ɖ", "œ": "oe"}

_T = "".join(TONES)
_TABLE = str.maketrans(STAND_INS)
#: One syllable: toneless consonants, then a vowel with its tones and a closing n, or a consonant with tones, or the word's end.
_SYLLABLE = re.compile(rf"(?:[^{VOWELS}{_T}](?![{_T}]))*(?:[{VOWELS}][{_T}]*(?:n(?![{_T}{VOWELS}]))?|[^{VOWELS}{_T}][{_T}]+|$)")


def tonal_letters(text: str) -> str:
    """Lower-case letters and tone marks in words; all else goes, without a blank in its place."""
    form = unicodedata.normalize("NFD", unicodedata.normalize("NFD", text).lower()).translate(_TABLE)
    kept = "".join(c if c in LETTERS or c in TONES else " " if c.isspace() else "" for c in form)
    # a tone needs a letter before it
    return " ".join(word.lstrip(_T) for word in kept.split(" ") if word.strip(_T))


def syllabify(text: str | None) -> str:
    found = (m for word in tonal_letters(text or "").split() for m in _SYLLABLE.findall(word) if m)
    return " ".join(unicodedata.normalize("NFC", "".join(c for c in s if c not in TONES)) + "".join(TONES[c] for c in sorted(s) if c in TONES) for s in found)


@F.arrow_udf(T.StringType())
def _syllabified(texts: pa.Array) -> pa.Array:
    return pa.array([syllabify(t) for t in texts.to_pylist()], pa.string())


def syllabified(text: Column | str) -> Column:
    """Syllables of each text; null becomes empty."""
    return _syllabified(_col(text))
