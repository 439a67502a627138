"""Renames, drops and casts that bring a source to the target schema."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sonolode.schema import TARGET, TEXT_NAMES


def rename_present(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """Rename where the source column exists and the target does not, one name after the other."""
    for old, new in names.items():
        if old != new and old in df.columns and new not in df.columns:
            df = df.withColumnRenamed(old, new)
    return df


def drop_present(df: DataFrame, names: Iterable[str]) -> DataFrame:
    return df.drop(*[n for n in names if n in df.columns])


def reshape(df: DataFrame, names: Mapping[str, str], dropped: Iterable[str], drop_first: bool) -> DataFrame:
    """Renames and drops, in the order that the ingest strategy has: it matters where a dropped name is a new name too."""
    if drop_first:
        return rename_present(drop_present(df, dropped), names)
    return drop_present(rename_present(df, names), dropped)


def defaulted(target: Column, source: Column) -> Column:
    """The target name, or the source name where it is null or empty."""
    return F.coalesce(F.nullif(target, F.lit("")), source)


def display_name(name: Column, repo: Column) -> Column:
    """The given name or else the last part of the repository, in lower case."""
    return F.lower(defaulted(name, F.substring_index(repo, "/", -1)))


def partition_language(language: Column) -> Column:
    return F.regexp_replace(language, "_ng$", "")


def to_target(df: DataFrame, language: Column, split: Column, corpus: Column, audio: str = "audio", keep: tuple[str, ...] = ()) -> DataFrame:
    """One select with exactly the target's columns and types, after those to keep; a cast that would lose a value raises.

    A missing metric is null; whatever columns the source has besides are not read.
    """
    text = next((n for n in TEXT_NAMES if n in df.columns), None)
    if text is None:
        raise ValueError(f"no text column among {df.columns}")
    given = {"text": F.col(text), "audio": F.col(audio), "language": language, "split": split, "corpus": corpus}
    columns = [given[f.name] if f.name in given else F.col(f.name) if f.name in df.columns else F.lit(None) for f in TARGET]
    return df.select(*keep, *[c.cast(f.dataType).alias(f.name) for c, f in zip(columns, TARGET)])


def with_prefix(df: DataFrame, column: str, prefix: str, constants: Mapping[str, object] | None = None) -> DataFrame:
    """Paths under ``prefix``, and constant columns."""
    return df.withColumns({column: F.concat(F.lit(prefix), F.col(column))} | {k: F.lit(v) for k, v in (constants or {}).items()})


def all_equal(values: Mapping[str, object]) -> Column:
    """The conjunction of equalities, null-safe; on partition columns it prunes folders."""
    return reduce(and_, (F.col(k).eqNullSafe(F.lit(v)) for k, v in values.items()), F.lit(True))
