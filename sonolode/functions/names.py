"""Canonical names of languages and corpora, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def language_code(c: Column | str) -> Column:
    """Lower case without region or script: ``YOR`` and ``yor_ng`` are ``yor``. Blank counts as null."""
    return F.nullif(F.regexp_replace(F.lower(F.trim(_col(c))), r"[_\-].*$", ""), F.lit(""))


def corpus_name(c: Column | str) -> Column:
    """Lower case, trimmed; blank counts as null."""
    return F.nullif(F.lower(F.trim(_col(c))), F.lit(""))


LANGUAGE_SQL = "nullif(regexp_replace(lower(trim({0})), '[_\\-].*$', ''), '')"
CORPUS_SQL = "nullif(lower(trim({0})), '')"
