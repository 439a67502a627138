"""Tone vectors and tone error rates, as native expressions."""

from __future__ import annotations

import unicodedata
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F

from sonolode.functions.names import _col


@lru_cache(maxsize=4)
def carriers(mark: str) -> str:
    """All characters whose canonical decomposition holds ``mark``, the mark included."""
    return "".join(chr(c) for c in range(0x250 * 32) if not 0xD800 <= c < 0xE000 and mark in unicodedata.normalize("NFD", chr(c)))


def characters(text: Column | str) -> Column:
    """The code points of a text."""
    return F.regexp_extract_all(_col(text), F.lit("(?s)."), F.lit(0))


def tone_vector(text: Column | str) -> Column:
    """1 for each character with an acute accent, else -1 for one with a grave accent, else 0."""
    high, low = carriers("\u0301"), carriers("\u0300")
    low = "".join(c for c in low if c not in high)
    # carriers become one of two private characters, so that a character is compared with those only
    coded = F.translate(_col(text), high + low, "\ue001" * len(high) + "\ue002" * len(low))
    return F.transform(characters(coded), lambda c: F.when(c == "\ue001", 1).when(c == "\ue002", -1).otherwise(0))


def tone_errors(predicted: Column | str, reference: Column | str) -> Column:
    """Share of mismatches among the positions where either vector has a tone; NaN where none has.

    The shorter vector is filled with zeros, whichever it is.
    """
    pairs = F.zip_with(_col(predicted), _col(reference), lambda p, r: F.struct(F.coalesce(p, F.lit(0)).alias("p"), F.coalesce(r, F.lit(0)).alias("r")))
    active = F.filter(pairs, lambda x: (x["p"] != 0) | (x["r"] != 0))
    wrong = F.size(F.filter(active, lambda x: x["p"] != x["r"]))
    rate = F.when(F.size(active) > 0, wrong / F.size(active)).otherwise(F.lit(float("nan")))
    return F.when(_col(predicted).isNotNull() & _col(reference).isNotNull(), rate)
