"""Discovery of shards: files by pattern, pseudo-paths by language and split, leaves of a partitioned dataset."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sonolode.functions.hashing import assign_split, shard_id
from sonolode.operators.projection import defaulted
from sonolode.sources.registry import Corpus

_SHARDS = "language string, split string, path string"


def list_files(spark: SparkSession, pattern: str) -> list[str]:
    """Files that a glob pattern matches on any file system that Spark reads, sorted."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(pattern)
    found = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(path)
    return sorted(s.getPath().toString() for s in found if s.isFile()) if found else []


def files_below(spark: SparkSession, folder: str, suffix: str = "") -> list[str]:
    """All files below a folder on any file system that Spark reads, sorted; none where there is no such folder."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(path):
        return []
    found, every = [], fs.listFiles(path, True)
    while every.hasNext():
        found.append(every.next().getPath().toString())
    return sorted(f for f in found if f.endswith(suffix))


def file_shards(spark: SparkSession, root: str, corpus: Corpus) -> DataFrame:
    """(language, split, path, shard_id) of a corpus that is kept as files.

    ``dir_format`` with ``{lang}`` and ``{split}`` gives the pattern; ``**`` counts as ``*``. A split without files is an
    error. With ``split_weight`` the split of a file is drawn from its path instead, and an empty result is none.
    """
    form = corpus.dir_format or "{lang}/{split}/*.parquet"
    drawn = bool(corpus.split_weight)
    rows = []
    for language in corpus.languages or {"": None}:
        for split in ["*"] if drawn else corpus.splits:
            pattern = f"{root}/{form.format(lang=language, split=split)}".replace("**", "*")
            paths = list_files(spark, pattern)
            if not paths and not drawn:
                raise FileNotFoundError(f"no files for {language} {split}: {pattern}")
            rows += [(language, split, p) for p in paths]
    shards = spark.createDataFrame(rows, _SHARDS)
    if drawn:
        shards = shards.withColumn("split", assign_split("path", tuple(corpus.split_weight)))
    return shards.withColumn("shard_id", shard_id("path"))


def pseudo_shards(registry: DataFrame) -> DataFrame:
    """(corpus, language, split, path, shard_id) for registry rows read by name: languages times splits of each entry.

    Where the language is no argument of the reader, the first one stands for all and is no part of the path.
    """
    languages, by_language = F.map_keys("languages"), F.coalesce("include_lang_as_arg", F.lit(False))
    some = F.when(by_language, languages).otherwise(F.slice(languages, 1, 1))
    rows = registry.select("corpus", "repo_id", by_language.alias("named"), F.explode(some).alias("language"), "splits").select("corpus", "repo_id", "named", "language", F.explode(F.map_keys("splits")).alias("split"))
    rows = rows.withColumn("path", F.concat_ws("/", "repo_id", F.when(F.col("named"), F.col("language")), "split"))
    return rows.select("corpus", "language", "split", "path", shard_id("path").alias("shard_id"))


def target_names(registry: DataFrame) -> DataFrame:
    """(corpus, source_language, language, source_split, split): what each entry's names become."""
    rows = registry.select("corpus", F.explode("languages").alias("source_language", "tl"), "splits").select("corpus", "source_language", "tl", F.explode("splits").alias("source_split", "ts"))
    return rows.select("corpus", "source_language", defaulted(F.col("tl"), F.col("source_language")).alias("language"), "source_split", defaulted(F.col("ts"), F.col("source_split")).alias("split"))


def read_dataset(spark: SparkSession, root: str, **options: str) -> DataFrame:
    """A dataset partitioned by folders; files that are no Parquet are passed over.

    Partition values stay strings if the session turns ``partitionColumnTypeInference`` off, as ``local_session`` does.
    """
    return spark.read.options(pathGlobFilter="*.parquet", ignoreCorruptFiles="true", **options).parquet(root)


def leaves(dataset: DataFrame, keys: tuple[str, ...] = ("corpus", "split", "language")) -> DataFrame:
    """(keys, files): the files of each leaf."""
    return dataset.select(*keys, F.input_file_name().alias("file")).distinct().groupBy(*keys).agg(F.sort_array(F.collect_set("file")).alias("files"))


def read_leaf(dataset: DataFrame, leaf: Mapping[str, str], columns: tuple[str, ...] = ("audio", "text", "duration_sec")) -> DataFrame:
    """The wanted columns of one leaf; the other folders are not listed."""
    from sonolode.operators.projection import all_equal

    return dataset.filter(all_equal(leaf)).select(*columns)


def read_tsv(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.csv(path, sep="\t", header=True)
