"""Catalogs of noise and room recordings: files of ``--key value`` lines, and archives."""

from __future__ import annotations

import shlex
import zipfile
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_RECORD = "map<string,string>"


def parse_flags(line: str, trailing_key: str = "path") -> dict[str, str]:
    """A flag without a value is ``true``; the last word that belongs to no flag is kept under ``trailing_key``."""
    record: dict[str, str] = {}
    words = shlex.split(line)
    flag = None
    for word in words:
        if word.startswith("--"):
            record[flag := word[2:]] = "true"
        else:
            record[trailing_key if flag is None else flag] = word
            flag = None
    return record


def flags_column(line: Column, trailing_key: str = "path") -> Column:
    """``parse_flags`` on a column, with shell quoting; null for a line whose quotes do not close."""

    @F.arrow_udf(_RECORD)
    def run(lines: pa.Array) -> pa.Array:
        out = []
        for text in lines.to_pylist():
            try:
                out.append(None if text is None else list(parse_flags(text, trailing_key).items()))
            except ValueError:
                out.append(None)
        return pa.array(out, pa.map_(pa.string(), pa.string()))

    return run(line)


def flags_native(line: Column, trailing_key: str = "path") -> Column:
    """The same for lines without quotes, as a native expression."""
    words = F.filter(F.split(F.trim(line), r"\s+"), lambda w: w != "")
    entry = F.transform(words, lambda w, i: F.when(w.startswith("--"), F.struct(F.substring(w, 3, 1 << 20).alias("key"), F.when(F.coalesce(F.get(words, i + 1), F.lit("--")).startswith("--"), "true").otherwise(F.get(words, i + 1)).alias("value"))).when((i == 0) | ~F.coalesce(F.get(words, i - 1), F.lit("")).startswith("--"), F.struct(F.lit(trailing_key).alias("key"), w.alias("value"))))
    found = F.filter(entry, lambda e: e.isNotNull())
    # of equal keys the last one counts
    last = F.filter(found, lambda e, i: ~F.exists(F.slice(found, i + 2, F.size(found)), lambda later: later["key"] == e["key"]))
    return F.map_from_entries(last)


def read_flags(spark: SparkSession, path: str, trailing_key: str = "path", skip_blank: bool = True) -> DataFrame:
    """(record) for each line of text files."""
    lines = spark.read.text(path)
    if skip_blank:
        lines = lines.filter(F.trim("value") != "")
    return lines.select(flags_column(F.col("value"), trailing_key).alias("record"))


def extract_zip(source: str, target: str) -> list[str]:
    """Unpack an archive; members that would land outside ``target`` are refused."""
    root = Path(target).resolve()
    with zipfile.ZipFile(source) as z:
        for name in z.namelist():
            if not (root / name).resolve().is_relative_to(root):
                raise ValueError(f"outside of {target}: {name}")
        z.extractall(root)
        return sorted(z.namelist())
