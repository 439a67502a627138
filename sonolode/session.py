"""Sessions, tables and staged intermediate results."""

from __future__ import annotations

import atexit
import os
import re
import shutil
import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

_LOCAL: dict[str, str] = {}
_SHIPPED: set[str] = set()
_STAGED: list[list[tuple[SparkSession, str]]] = []


def local_session(cores: int | str = 8, name: str = "sonolode", **conf: str) -> SparkSession:
    """A session for one machine, with the settings the operators expect of any cluster."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(name)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.shuffle.partitions": "8",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "8g",
        "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
    } | conf
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ship(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per application."""
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    root = Path(__file__).resolve().parent
    archive = Path(tempfile.mkdtemp(prefix="sonolode-code-")) / "sonolode-code.zip"
    with zipfile.ZipFile(archive, "w") as z:
        for f in sorted(root.rglob("*.py")):
            z.write(f, f.relative_to(root.parent))
    spark.sparkContext.addPyFile(str(archive))
    atexit.register(shutil.rmtree, archive.parent, ignore_errors=True)
    _SHIPPED.add(app)


def table(spark: SparkSession, directory: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{directory}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder that all executors share: the checkpoint folder of the context, or ``spark.checkpoint.dir``.

    Only on one machine, as in tests, a temporary folder stands in where neither is set; on a cluster that is an error, since
    each executor would write to a disk of its own.
    """
    context = spark.sparkContext
    folder = context._jsc.sc().getCheckpointDir()
    given = os.path.dirname(folder.get()) if folder.isDefined() else context.getConf().get("spark.checkpoint.dir")
    if given:
        return given.rstrip("/")
    if not re.fullmatch(r"local(\[[^\]]*\])?", context.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    app = context.applicationId
    if app not in _LOCAL:
        _LOCAL[app] = tempfile.mkdtemp(prefix="sonolode-")
        atexit.register(shutil.rmtree, _LOCAL[app], ignore_errors=True)
    return "file://" + _LOCAL[app]


@contextmanager
def workspace() -> Iterator[None]:
    """What is staged inside of the block goes with its end: for sessions that run many queries and write each result there."""
    _STAGED.append([])
    try:
        yield
    finally:
        for spark, path in _STAGED.pop():
            _remove(spark, path)


def staged(df: DataFrame, label: str, by: tuple[str, ...] = ()) -> DataFrame:
    """Write ``df`` to the shared folder and return a reader of the written table.

    The lineage ends there: a lost executor costs a re-read, not a recomputation, and a table that is
    read several times is computed once. ``by`` makes folders of columns that readers filter by. The files go with the ``workspace``, or
    without one when the application ends.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/staged/{label}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").partitionBy(*by).parquet(path)
    if _STAGED:
        _STAGED[-1].append((spark, path))
    else:
        atexit.register(_remove, spark, path)
    return spark.read.schema(df.schema).parquet(path)


def _remove(spark: SparkSession, path: str) -> None:
    try:
        jvm = spark.sparkContext._jvm
        target = jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)
    except Exception:  # the session may have ended before the interpreter does
        if path.startswith("file://"):
            shutil.rmtree(path[7:], ignore_errors=True)
