"""The ledger of shards: which are pending, completed, uploaded or failed.

A ledger is a table (repo_id, repo_type, filename, status, local_dir) in a folder of versions; each change writes the next version
whole and then commits it by renaming, so a reader or a restarted run sees the last complete one. One run writes at a time.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

STATES = ("pending", "completed", "uploaded", "failed")
SCHEMA = "repo_id string, repo_type string, filename string, status string, local_dir array<string>"


def latest(rows: DataFrame, key: str = "shard_id", when: str = "updated_at") -> DataFrame:
    """The newest row of each shard; of rows as new as each other the one that sorts last."""
    rest = [c for c in rows.columns if c not in (key, when)]
    texts = [F.to_json(F.struct(*rest))]
    picked = rows.groupBy(key).agg(F.max_by(F.struct(when, *rest), F.struct(F.col(when), *texts)).alias("r"))
    return picked.select(key, "r.*")


def unseen(ledger: DataFrame, found: DataFrame, key: str = "filename") -> DataFrame:
    return found.join(ledger.select(key).distinct(), key, "left_anti")


def claimable(ledger: DataFrame) -> DataFrame:
    """Pending shards, then completed ones that await their upload, by name."""
    return ledger.filter(F.col("status").isin("pending", "completed")).withColumn("turn", F.when(F.col("status") == "pending", 0).otherwise(1)).orderBy("turn", "filename").drop("turn")


def claimed(ledger: DataFrame, shards: DataFrame, key: str = "filename") -> DataFrame:
    """The claimable entries among ``shards``."""
    return claimable(ledger).join(shards.select(key).distinct(), key, "left_semi")


def stats(ledger: DataFrame) -> DataFrame:
    return ledger.groupBy("status").agg(F.count(F.lit(1)).alias("shards"))


def indexed(ledger: DataFrame, **wanted: object) -> DataFrame:
    """Entries equal to ``wanted`` in all fields, with ``position`` in the order of names."""
    from sonolode.operators.sampling import numbered

    rows = numbered(ledger, ["filename"], name="position")
    for name, value in wanted.items():
        rows = rows.filter(F.col(name).eqNullSafe(F.lit(value)))
    return rows


class Ledger:
    """The ledger of one source repository under ``root``."""

    def __init__(self, spark: SparkSession, root: str, repo_id: str, repo_type: str = "dataset", strict: bool = False):
        self.spark, self.repo_id, self.repo_type = spark, repo_id, repo_type
        self.path = f"{root.rstrip('/')}/{repo_id}_{repo_type}"
        jvm = spark.sparkContext._jvm
        self._Path = jvm.org.apache.hadoop.fs.Path
        self._fs = self._Path(self.path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        if strict and self._version() < 0:
            raise FileNotFoundError(self.path)

    def _version(self) -> int:
        if not self._fs.exists(self._Path(self.path)):
            return -1
        names = [s.getPath().getName() for s in self._fs.listStatus(self._Path(self.path))]
        return max((int(n[1:]) for n in names if n[:1] == "v" and n[1:].isdigit()), default=-1)

    @property
    def current(self) -> str:
        """The folder of the current version."""
        return f"{self.path}/v{self._version():08d}"

    def entries(self) -> DataFrame:
        version = self._version()
        return self.spark.read.schema(SCHEMA).parquet(f"{self.path}/v{version:08d}") if version >= 0 else self.spark.createDataFrame([], SCHEMA)

    def _save(self, entries: DataFrame) -> None:
        version = self._version()
        staging = f"{self.path}/.next-{version + 1:08d}"
        entries.select("repo_id", "repo_type", "filename", "status", "local_dir").write.mode("overwrite").parquet(staging)
        if not self._fs.rename(self._Path(staging), self._Path(f"{self.path}/v{version + 1:08d}")):
            raise OSError(f"cannot commit {staging}")
        if version > 0:
            self._fs.delete(self._Path(f"{self.path}/v{version - 1:08d}"), True)

    def register(self, filenames: DataFrame, exist_ok: bool = True) -> None:
        """Add files as pending that are not yet there; those that are keep their state."""
        new = filenames.select("filename").distinct()
        known = self.entries()
        if not exist_ok and not new.join(known, "filename", "left_semi").isEmpty():
            raise ValueError("a file is registered already")
        fresh = unseen(known, new).select(F.lit(self.repo_id).alias("repo_id"), F.lit(self.repo_type).alias("repo_type"), "filename", F.lit("pending").alias("status"), F.array().cast("array<string>").alias("local_dir"))
        self._save(known.unionByName(fresh))

    def _mark(self, folders: Mapping[str, Sequence[str] | None], status: str) -> None:
        """Set the status of the named files, and their folders where given; a file that is not there is an error."""
        known = self.entries()
        change = self.spark.createDataFrame([(n, list(f) if f is not None else None) for n, f in folders.items()], "filename string, __dir array<string>")
        lost = [r[0] for r in change.join(known, "filename", "left_anti").select("filename").collect()]
        if lost:
            raise KeyError(f"not in the ledger: {sorted(lost)}")
        both = known.join(change.withColumn("__hit", F.lit(True)), "filename", "left")
        self._save(both.withColumns({"status": F.when(F.col("__hit"), status).otherwise(F.col("status")), "local_dir": F.coalesce("__dir", "local_dir")}))

    def mark_pending(self, filenames: Sequence[str]) -> None:
        self._mark({n: [] for n in filenames}, "pending")

    def mark_completed(self, folders: Mapping[str, Sequence[str]]) -> None:
        self._mark(folders, "completed")

    def mark_uploaded(self, filenames: Sequence[str]) -> None:
        self._mark(dict.fromkeys(filenames), "uploaded")

    def fail(self, filenames: Sequence[str]) -> None:
        self._mark(dict.fromkeys(filenames), "failed")

    def claim(self) -> DataFrame:
        return claimable(self.entries())

    def resume(self) -> list[str]:
        """Completed files whose output is gone go back to pending; their names."""
        completed = self.entries().filter("status = 'completed'").select("filename", "local_dir").collect()  # names of shards, not rows
        lost = [r["filename"] for r in completed if not r["local_dir"] or not all(self._fs.exists(self._Path(p)) for p in r["local_dir"])]
        if lost:
            self.mark_pending(lost)
        return lost
