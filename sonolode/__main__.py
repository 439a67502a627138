"""Command line: ``python -m sonolode run`` ingests every corpus of a registry and publishes it; ``versions`` names what it runs on."""

from __future__ import annotations

import argparse
import platform
from importlib.metadata import PackageNotFoundError, version
from pathlib import Path

from pyspark.sql import SparkSession

from sonolode import sinks
from sonolode.plans.pipeline import Ingestion
from sonolode.session import local_session
from sonolode.sources.registry import LANGUAGES, load_registry, registry_table

#: Packages whose versions matter.
PACKAGES = ("pyspark", "pyarrow", "pandas", "numpy")


def versions() -> dict[str, str]:
    found = {"python": platform.python_version()}
    for name in PACKAGES:
        try:
            found[name] = version(name)
        except PackageNotFoundError:
            found[name] = "absent"
    return found


def run_full(spark: SparkSession, folder: str, name: str, source: str, output: str, remote: str | None = None, restore: bool = False) -> dict[str, int]:
    """Shards ingested per corpus. With ``restore`` ledger and statistics come from ``remote`` first; with ``remote`` all output goes there.

    Statistics as TSV and the card are written at the end. An upload that fails raises, and a later run goes on from the ledger.
    """
    registry = load_registry(folder, name)
    if restore and remote:
        for part in ("ledger", "state"):
            sinks.download(remote, output, part)
    ingestion, done = Ingestion(spark, source, output), {}
    commit = sinks.copy_to(remote) if remote else None
    for entry, corpus in registry.items():
        done[entry] = ingestion.run(corpus)
        if commit:
            ingestion.publish(corpus, commit)
    if ingestion.states() is not None:
        sinks.write_tsv(ingestion.statistics(), f"{output}/metrics")
    card = Path(output) / "README.md"
    card.parent.mkdir(parents=True, exist_ok=True)
    card.write_text(sinks.card(registry_table(spark, registry), name, "other", sorted({*LANGUAGES.values()})), encoding="utf-8")
    if commit:
        files = [str(card), *(str(f) for f in (Path(output) / "metrics").glob("*.csv"))]
        failed = sinks.upload(sinks.plan_upload(files, output), commit)
        if failed:
            raise RuntimeError(f"not sent: {failed}")
    return done


def main(arguments: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="sonolode", description=__doc__)
    commands = parser.add_subparsers(dest="command", required=True)
    commands.add_parser("versions")
    run = commands.add_parser("run")
    run.add_argument("folder", help="folder of the registry files")
    run.add_argument("name", help="name of the registry, without .yaml")
    run.add_argument("source", help="folder that holds the corpora")
    run.add_argument("output", help="folder for data, ledger and statistics")
    run.add_argument("--remote", help="folder that all output is copied to")
    run.add_argument("--restore", action="store_true", help="begin from the ledger and statistics of the remote folder")
    args = parser.parse_args(arguments)
    if args.command == "versions":
        print("\n".join(f"{k} {v}" for k, v in versions().items()))
        return
    spark = SparkSession.getActiveSession() or local_session()
    for entry, n in run_full(spark, args.folder, args.name, args.source, args.output, args.remote, args.restore).items():
        print(f"{entry}: {n} shards")


if __name__ == "__main__":
    main()
