"""Ingestion of a corpus: register, claim, project, normalize, measure, write, count, mark."""

from __future__ import annotations

import posixpath
from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sonolode import sinks
from sonolode.functions.audio import with_metrics
from sonolode.functions.text import normalized
from sonolode.operators.ledger import Ledger
from sonolode.operators.metrics import finalize, group_state, merge_states
from sonolode.operators.projection import drop_present, reshape, to_target
from sonolode.operators.sampling import buffered_shuffle
from sonolode.schema import PARTITIONS
from sonolode.session import staged, workspace
from sonolode.sources.registry import LANGUAGES, Corpus, registry_table
from sonolode.sources.shards import file_shards, files_below, pseudo_shards

#: Shards that one job takes, and that are marked together.
FLUSH = 500


class UploadError(RuntimeError):
    """Files that could not be sent; the ledger says that their shards are completed, not uploaded."""


def read_by_name(spark: SparkSession, source: str) -> Callable[[str, str | None, str], DataFrame]:
    """A reader of (repository, configuration or none, split): the Parquet files below the folder of that name."""

    def read(repo: str, config: str | None, split: str) -> DataFrame:
        folder = "/".join(x for x in (source, repo, config, split) if x)
        return spark.read.option("mergeSchema", "true").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").parquet(folder)

    return read


@dataclass(frozen=True)
class Ingestion:
    """Where the pieces of a run lie. The state of the statistics is one table row per shard and group."""

    spark: SparkSession
    source: str
    output: str
    homophones: Mapping[str, str] | None = None
    remove_numbers: bool = False
    #: How corpora of the strategy ``base`` are read; by default ``read_by_name`` from ``source``.
    reader: Callable[[str, str | None, str], DataFrame] | None = None

    def prepare(self, raw: DataFrame, corpus: Corpus, language: str, split: str) -> DataFrame:
        """(shard, target schema) for rows of one source language and split; the plan runs nothing yet."""
        base = corpus.ingest_strategy == "base"
        if base:  # dropped, shuffled, then renamed
            raw = buffered_shuffle(drop_present(raw, corpus.exclude_cols or ()))
        rows = reshape(raw, dict(corpus.columns), corpus.exclude_cols or (), drop_first=base)
        target = corpus.language(language)
        text = normalized("transcript", F.lit(target), corpus.normalize, self.remove_numbers, self.homophones, {target: list(corpus.exclude_annotations.get(target, ()))})
        rows = rows.withColumn("transcription", text).drop("transcript")
        rows = with_metrics(rows.drop(*[c for c in ("text", "language", "split", "corpus") if c in rows.columns]))
        return to_target(rows, F.lit(LANGUAGES.get(target, target)), F.lit(corpus.split(split)), F.lit(corpus.name), keep=("shard",))

    def states(self) -> DataFrame | None:
        """(shard, keys, state) of all shards counted so far."""
        try:
            return self.spark.read.parquet(f"{self.output}/state")
        except Exception as e:
            if "PATH_NOT_FOUND" in str(e) or "UNABLE_TO_INFER_SCHEMA" in str(e):
                return None
            raise

    def shards(self, corpus: Corpus) -> DataFrame:
        """(language, split, path, shard_id): the files of a corpus, or the names by which it is read."""
        if corpus.ingest_strategy == "base":
            return pseudo_shards(registry_table(self.spark, {corpus.name: corpus})).select("language", "split", "path", "shard_id")
        return file_shards(self.spark, f"{self.source}/{corpus.repo_id}", corpus)

    def run(self, corpus: Corpus) -> int:
        """Ingest every claimable shard of a corpus; how many. A second run does nothing.

        Up to ``FLUSH`` shards of one language and split are read, prepared and written in one job, each into its own folder,
        so the cluster works on many files at once. Data and state are written before the ledger says so; after a failure between,
        the next run writes the same folders again and counts no shard twice. Each job's intermediate tables go with it.
        """
        ledger = Ledger(self.spark, f"{self.output}/ledger", corpus.repo_id)
        shards = self.shards(corpus)
        ledger.register(shards.select(F.col("path").alias("filename")))
        ledger.resume()
        pending = ledger.claim().filter("status = 'pending'").select(F.col("filename").alias("path"))
        todo = shards.join(pending, "path").select("language", "split", "path", "shard_id").collect()  # names of shards
        groups: dict[tuple[str, str], list] = {}
        for r in todo:
            groups.setdefault((r["language"], r["split"]), []).append(r)
        for (language, split), rows in groups.items():
            for start in range(0, len(rows), FLUSH):
                with workspace():
                    self._ingest(corpus, language, split, rows[start : start + FLUSH], ledger)
        return len(todo)

    def _raw(self, corpus: Corpus, language: str, split: str, part: list) -> DataFrame:
        """The rows of some shards of one language and split, with the shard that each is of."""
        if corpus.ingest_strategy == "base":
            read = self.reader or read_by_name(self.spark, self.source)
            return read(corpus.repo_id, language if corpus.include_lang_as_arg else None, split).withColumn("shard", F.lit(part[0]["shard_id"]))
        names = self.spark.createDataFrame([(sinks.plain_path(r["path"]), r["shard_id"]) for r in part], "__file string, shard string")
        raw = self.spark.read.option("mergeSchema", "true").parquet(*[r["path"] for r in part])
        path = F.regexp_replace(F.regexp_replace(F.col("_metadata.file_path"), "^(\\w+):/+", "$1:/"), "^file:", "")
        return raw.withColumn("__file", path).join(F.broadcast(names), "__file").drop("__file")  # at most FLUSH rows

    def _ingest(self, corpus: Corpus, language: str, split: str, part: list, ledger: Ledger) -> None:
        prepared = staged(self.prepare(self._raw(corpus, language, split, part), corpus, language, split), "prepared")
        sinks.write_dataset(prepared, f"{self.output}/data", mode="overwrite", partitions=("shard", *PARTITIONS))
        if corpus.writes_manifest(split):
            sinks.write_manifest(prepared, f"{self.output}/manifest", partitions=("shard", *PARTITIONS))
        self._count(prepared)
        ledger.mark_completed({r["path"]: [f"{self.output}/data/shard={r['shard_id']}"] for r in part})

    def publish(self, corpus: Corpus, commit: Callable[[Mapping[str, str]], None], **options) -> list[str]:
        """Upload the output of completed shards, with the ledger and the state of the statistics in the last commit; the shards sent.

        Shards are marked as uploaded before their files go, so that the ledger that goes with them says so. Whatever fails, they are marked
        back as completed and the error is raised. A shard whose files are gone goes back to pending instead. Files
        lie below data/corpus=/split=/language=, as the card says, under names that begin with their shard.
        """
        ledger = Ledger(self.spark, f"{self.output}/ledger", corpus.repo_id)
        ledger.resume()
        ready = {r["filename"]: r["local_dir"] for r in ledger.claim().filter("status = 'completed'").collect()}  # names of shards
        names = list(ready)
        for start in range(0, len(names), FLUSH):
            part = names[start : start + FLUSH]
            ledger.mark_uploaded(part)
            try:
                plan = {f: remote for shard in part for folder in ready[shard] for f, remote in self._published(folder).items()}
                failed = sinks.upload(plan, commit, last=self._progress(ledger), **options)
                if failed:
                    raise UploadError(f"not sent: {failed}")
            except BaseException:
                ledger.mark_completed({shard: ready[shard] for shard in part})
                raise
        return names

    def _published(self, folder: str) -> dict[str, str]:
        """Remote path of each file of a shard's folder."""
        files = files_below(self.spark, folder, ".parquet")
        shard = folder.rstrip("/").rsplit("shard=", 1)[-1]
        plan = sinks.plan_upload(files, folder)
        return {f: posixpath.join(posixpath.dirname(p), f"{shard}-{posixpath.basename(p)}") for f, p in plan.items()}

    def _progress(self, ledger: Ledger) -> dict[str, str]:
        """Remote path of each file of the ledger and the state, as they lie."""
        files = files_below(self.spark, ledger.current) + files_below(self.spark, f"{self.output}/state")
        base = sinks.plain_path(self.output).rstrip("/") + "/"
        return {f: sinks.plain_path(f).removeprefix(base) for f in files}

    def _count(self, prepared: DataFrame) -> None:
        state = group_state(prepared, ("shard", *PARTITIONS))
        known = self.states()
        if known is not None:
            state = state.join(known.select("shard").distinct(), "shard", "left_anti")
        state.coalesce(1).write.mode("append").parquet(f"{self.output}/state")

    def statistics(self) -> DataFrame:
        """Means and deviations per group over all counted shards."""
        states = self.states()
        if states is None:
            raise FileNotFoundError(f"{self.output}/state")
        return finalize(merge_states(states.drop("shard")))
