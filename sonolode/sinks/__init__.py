"""Writers: partitioned datasets, manifests, tables, cards and uploads."""

from __future__ import annotations

import posixpath
import re
import shutil
import time
from collections.abc import Callable, Mapping, Sequence
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sonolode.functions.syllables import syllabified
from sonolode.functions.text import SPACE, char_class
from sonolode.operators.projection import defaulted, display_name, partition_language
from sonolode.schema import PARTITIONS

MIN_ROWS_PER_FILE = 10_000
_SPACE = char_class(SPACE, java=True)


def write_dataset(rows: DataFrame, root: str, mode: str = "append", rows_per_file: int = MIN_ROWS_PER_FILE, partitions: Sequence[str] = PARTITIONS) -> None:
    """A dataset in folders by corpus, split and language.

    Rows are rebalanced by the partition columns, so that each folder gets few files of fair size and a corpus with a third
    of all rows is still written by many tasks. Mode ``overwrite`` replaces only the folders that the rows go to.
    """
    balanced = rows.hint("rebalance", *partitions)
    balanced.write.mode(mode).option("partitionOverwriteMode", "dynamic").option("maxRecordsPerFile", max(rows_per_file, MIN_ROWS_PER_FILE) * 10).partitionBy(*partitions).parquet(root)


def manifest_lines(rows: DataFrame, text: str = "text", partitions: Sequence[str] = PARTITIONS) -> DataFrame:
    """(partitions, line): texts that hold something, one line each."""
    line = F.regexp_replace(F.regexp_replace(F.col(text), r"[\r\n]+", " "), f"^[{_SPACE}]+|[{_SPACE}]+$", "")
    return rows.select(*partitions, line.alias("line")).filter("line <> ''")


def write_manifest(rows: DataFrame, root: str, text: str = "text", partitions: Sequence[str] = PARTITIONS) -> None:
    """Text files in folders by corpus, split and language; the folders that the rows go to are written anew."""
    lines = manifest_lines(rows, text, partitions).hint("rebalance", *partitions)
    lines.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*partitions).text(root)


def write_tsv(table: DataFrame, path: str) -> None:
    table.coalesce(1).write.mode("overwrite").csv(path, sep="\t", header=True)


def write_configs(tables: Mapping[str, DataFrame], root: str) -> None:
    """Named tables, each in a folder of its own."""
    for name, rows in tables.items():
        rows.write.mode("overwrite").parquet(f"{root}/{name}")


def syllable_csv(spark: SparkSession, source: str, target: str) -> None:
    """A CSV of (id, transcription) or (ID, Target) as one of (ID, Target), the texts in syllables."""
    rows = spark.read.csv(source, header=True, multiLine=True, quote='"', escape='"')
    names = {c.lower(): c for c in rows.columns}
    text = names.get("transcription") or names.get("target")
    if "id" not in names or text is None:
        raise ValueError(f"neither (id, transcription) nor (ID, Target): {rows.columns}")
    out = rows.select(F.col(names["id"]).alias("ID"), syllabified(text).alias("Target"))
    out.write.mode("overwrite").csv(target, header=True, quote='"', escape='"')


def card_configs(registry: DataFrame) -> DataFrame:
    """(config, split, path): what a dataset card lists, from registry rows."""
    name = display_name(F.col("corpus"), F.col("repo_id"))
    rows = registry.select(name.alias("corpus"), F.explode("languages").alias("sl", "tl"), "splits").select("corpus", partition_language(defaulted(F.col("tl"), F.col("sl"))).alias("language"), F.explode("splits").alias("ss", "ts"))
    rows = rows.select("corpus", "language", defaulted(F.col("ts"), F.col("ss")).alias("split")).distinct()
    path = F.concat(F.lit("data/corpus="), "corpus", F.lit("/split="), "split", F.lit("/language="), "language", F.lit("/*.parquet"))
    return rows.select(F.concat_ws("_", "corpus", "language").alias("config"), "split", path.alias("path"))


def card(registry: DataFrame, title: str, licence: str, languages: Sequence[str]) -> str:
    """The Markdown card of a dataset, its configurations in front matter; the registry bounds its size."""
    # The keys of the front matter.
    found: dict[str, list[tuple[str, str]]] = {}
    for r in card_configs(registry).orderBy("config", "split").collect():
        found.setdefault(r["config"], []).append((r["split"], r["path"]))
    lines = ["---", f"license: {licence}", "task_categories:", "- automatic-speech-recognition", "language:", *[f"- {x}" for x in languages], "configs:"]
    for config, splits in found.items():
        lines += [f"- config_name: {config}", "  data_files:"]
        for split, path in splits:
            lines += [f"  - split: {split}", f"    path: {path}"]
    return "\n".join([*lines, "---", "", f"# {title}", ""])


def repository_name(repo: str) -> str:
    """A repository's name without address and closing slashes."""
    return repo.split("://", 1)[-1].removeprefix("datasets/").removeprefix("buckets/").strip("/")


def repository_column(repo: Column) -> Column:
    """``repository_name`` as a native expression."""
    return F.btrim(F.regexp_replace(F.regexp_replace(repo, "^.*?://", ""), "^(datasets/)?(buckets/)?", ""), F.lit("/"))


def plan_upload(files: Sequence[str], root: str, prefix: str = "") -> dict[str, str]:
    """Remote path of each file: Parquet under ``data/`` (once), the rest as it lies; a file outside ``root`` is an error."""
    base, plan = plain_path(root).rstrip("/") + "/", {}
    for f in files:
        path = posixpath.normpath(plain_path(f)) if ":" not in f else plain_path(f)
        if not path.startswith(base) or "/../" in path:
            raise ValueError(f"outside of {root}: {f}")
        name = path[len(base) :]
        folder = "data" if name.endswith(".parquet") and not name.startswith("data/") else ""
        plan[f] = "/".join(x for x in (prefix.strip("/"), folder, name) if x)
    return plan


def plain_path(path: str) -> str:
    """A path as plain text: no scheme if it is on this machine, else one slash after it, as Spark and Hadoop write it differently."""
    return re.sub(r"^file:", "", re.sub(r"^(\w+):/+", r"\1:/", path))


def copy_to(target: str, spark: SparkSession | None = None) -> Callable[[Mapping[str, str]], None]:
    """A commit that copies files below a folder: on this machine, or with a session between any file systems that it reaches."""

    def local(group: Mapping[str, str]) -> None:
        for source, name in group.items():
            to = Path(target) / name
            to.parent.mkdir(parents=True, exist_ok=True)
            shutil.copyfile(plain_path(source), to)

    def remote(group: Mapping[str, str]) -> None:
        jvm, conf = spark.sparkContext._jvm.org.apache.hadoop.fs, spark.sparkContext._jsc.hadoopConfiguration()
        for source, name in group.items():
            of, to = jvm.Path(source), jvm.Path(f"{target.rstrip('/')}/{name}")
            if not jvm.FileUtil.copy(of.getFileSystem(conf), of, to.getFileSystem(conf), to, False, conf):
                raise OSError(f"cannot copy {source}")

    return remote if spark is not None else local


def upload(plan: Mapping[str, str], commit: Callable[[Mapping[str, str]], None], group: int = 5, tries: int = 5, wait: float = 5.0, sleep: Callable[[float], None] = time.sleep, last: Mapping[str, str] | None = None) -> list[str]:
    """Commit files in groups; a group that fails, for whatever reason, is tried again after 1, 2, 4, ... times ``wait``. The files that failed.

    ``last`` goes with the final group. No group is sent after one that failed for good.
    """
    items = sorted(plan.items())
    parts = [dict(items[start : start + group]) for start in range(0, len(items), group)] or [{}]
    parts[-1] |= dict(last or {})
    for i, part in enumerate(p for p in parts if p):
        for attempt in range(tries):
            try:
                commit(part)
                break
            except Exception:
                if attempt + 1 == tries:
                    return [f for p in parts[i:] for f in p]
                sleep(wait * 2**attempt)
    return []


def download(source: str, target: str, name: str, tries: int = 5, wait: float = 5.0, sleep: Callable[[float], None] = time.sleep) -> str | None:
    """Copy a file or everything below a folder, trying again after failures; None where there is no such thing."""
    for attempt in range(tries):
        try:
            return _fetch(source, target, name)
        except OSError:
            if attempt + 1 == tries:
                raise
            sleep(wait * 2**attempt)


def _fetch(source: str, target: str, name: str) -> str | None:
    path, to = Path(source) / name, Path(target) / name
    if not path.exists():
        return None
    to.parent.mkdir(parents=True, exist_ok=True)
    if path.is_dir():
        shutil.copytree(path, to, dirs_exist_ok=True)
    else:
        shutil.copyfile(path, to)
    return str(to)
