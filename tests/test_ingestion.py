import zipfile

import numpy as np
import pytest
from pyspark.sql import functions as F

from sonolode import __main__ as cli
from sonolode import sinks
from sonolode.functions.audio import encode_wav
from sonolode.operators.ledger import Ledger
from sonolode.plans.pipeline import Ingestion, UploadError
from sonolode.sources import flags, registry, shards
from sonolode.streaming.arrivals import follow


def raw_rows(spark, n=6):
    clip = encode_wav(np.sin(np.arange(4000) / 5).astype(np.float32) * 0.3, 16_000)
    rows = [(f"Text NUMBER {i}!\nline", (clip if i % 2 else None, f"{i}.wav"), "junk") for i in range(n)] + [(None, None, None)]
    return spark.createDataFrame(rows, "utterance string, audio struct<bytes binary, path string>, secret string")


@pytest.fixture
def corpus():
    return registry.parse_registry({"corpora": [{"demo": {"repo_id": "org/Demo", "ingest_strategy": "parquet", "splits": [{"train": "train"}, {"dev": "validation"}], "languages": {"yor_batch": "yor_ng"}, "columns": {"utterance": "transcript"}, "exclude_cols": ["secret"], "compile_text": ["train"], "normalize": "None"}}]})["demo"]


def test_registry(corpus, tmp_path):
    assert (corpus.name, corpus.normalize, corpus.split("dev"), corpus.language("yor_batch")) == ("demo", None, "validation", "yor_ng")
    assert corpus.writes_manifest("train") and not corpus.writes_manifest("dev")
    assert registry.parse_registry(None) == {}
    for bad in ([1], {"corpora": [{"a": {}, "b": {}}]}, {"corpora": {"a": {"repo_id": "r", "languages": {"fra": None}}}}, {"corpora": {"a": {"repo_id": "r", "what": 1}}}):
        with pytest.raises(ValueError):
            registry.parse_registry(bad)
    with pytest.raises(ValueError):
        registry.load_registry(str(tmp_path), "../x")
    (tmp_path / "r.yaml").write_text("corpora:\n- demo:\n    repo_id: org/demo\n")
    assert registry.load_registry(str(tmp_path), "r")["demo"].repo_id == "org/demo"
    (tmp_path / "m.yaml").write_text("a: 1\nb: no\n")
    assert registry.unique_mapping(str(tmp_path / "m.yaml")) == {"a": "1", "b": "no"}
    (tmp_path / "m.yaml").write_text("a: 1\na: 2\n")
    with pytest.raises(ValueError):
        registry.unique_mapping(str(tmp_path / "m.yaml"))


def test_ingestion_runs_once(spark, tmp_path, corpus):
    for split, parts in (("train", 2), ("dev", 1)):
        for i in range(parts):
            raw_rows(spark).coalesce(1).write.parquet(f"{tmp_path}/in/org/Demo/yor_batch/{split}/{i}")
    corpus = registry.Corpus(**{f: getattr(corpus, f) for f in corpus.__slots__} | {"dir_format": "{lang}/{split}/*/*.parquet"})
    run = Ingestion(spark, f"{tmp_path}/in", f"{tmp_path}/out")
    assert run.run(corpus) == 3
    stats = {r["split"]: r for r in run.statistics().collect()}
    assert (stats["train"]["count"], stats["validation"]["count"]) == (14, 7) and stats["train"]["language"] == "yor"
    assert stats["train"]["hours"] == pytest.approx(6 * 0.25 / 3600)
    assert run.run(corpus) == 0 and run.statistics().count() == 2

    def statuses():
        return {r["status"] for r in Ledger(spark, f"{tmp_path}/out/ledger", "org/Demo").entries().collect()}

    for error in (OSError, RuntimeError, KeyError):

        def broken(group, error=error):
            raise error

        with pytest.raises(UploadError):
            run.publish(corpus, broken, tries=1)
        assert statuses() == {"completed"}
    with pytest.raises(KeyboardInterrupt):
        run.publish(corpus, lambda group: (_ for _ in ()).throw(KeyboardInterrupt))
    assert statuses() == {"completed"}
    assert len(run.publish(corpus, sinks.copy_to(f"{tmp_path}/remote"))) == 3 and statuses() == {"uploaded"}
    assert run.publish(corpus, broken, tries=1) == [] and run.run(corpus) == 0
    # the card's patterns match what was published, and ledger and state went along
    text = sinks.card(registry.registry_table(spark, {"demo": corpus}), "Demo", "other", ["yo"])
    globs = [line.split("path: ")[1] for line in text.splitlines() if "path: " in line]
    assert len(globs) == 2 and sum(spark.read.parquet(f"{tmp_path}/remote/{g}").count() for g in globs) == 21
    assert {r["status"] for r in Ledger(spark, f"{tmp_path}/remote/ledger", "org/Demo").entries().collect()} == {"uploaded"}
    assert spark.read.parquet(f"{tmp_path}/remote/state").agg(F.sum("count")).first()[0] == 21
    data = shards.read_dataset(spark, f"{tmp_path}/out/data")
    assert data.count() == 21
    assert {r["text"] for r in data.select("text").distinct().collect()} == {""} | {f"te t number {i} line" for i in range(6)}
    assert spark.read.text(f"{tmp_path}/out/manifest").count() == 12


def test_corpora_read_by_name(spark, tmp_path):
    """The strategy base, with and without a configuration per language, by the command line; a second run restores and does nothing."""
    for folder in ("org/one/train", "org/two/fon/train", "org/two/fon/test", "org/two/ewe/train", "org/two/ewe/test"):
        raw_rows(spark).withColumn("transcript", F.lit("dropped first")).coalesce(1).write.parquet(f"{tmp_path}/in/{folder}")
    (tmp_path / "r.yaml").write_text("""
corpora:
- one: {repo_id: org/one, splits: {train: None}, languages: [{yor_ng: None}], columns: {utterance: transcript}, exclude_cols: [secret, transcript]}
- two: {repo_id: org/two, include_lang_as_arg: true, splits: {train: None, test: None}, languages: {fon: None, ewe: None}, columns: {utterance: transcript}, exclude_cols: [transcript], annotation: {fon: [x]}}
""")
    arguments = ["run", str(tmp_path), "r", f"{tmp_path}/in", f"{tmp_path}/out", "--remote", f"{tmp_path}/remote"]
    cli.main(arguments)
    rows = shards.read_dataset(spark, f"{tmp_path}/remote/data")
    found = {tuple(r)[:3]: r["n"] for r in rows.groupBy("corpus", "split", "language").agg(F.count("*").alias("n")).collect()}
    assert found == {("one", "train", "yor"): 7} | {("two", s, x): 7 for s in ("train", "test") for x in ("fon", "ewe")}
    assert not {"dropped first"} & {r["text"] for r in rows.filter("corpus = 'one'").select("text").collect()}
    assert "config_name: two_fon" in (tmp_path / "remote/README.md").read_text() and list((tmp_path / "remote/metrics").glob("*.csv"))
    again = cli.run_full(spark, str(tmp_path), "r", f"{tmp_path}/in", f"{tmp_path}/new", f"{tmp_path}/remote", restore=True)
    assert again == {"one": 0, "two": 0}
    assert "pyspark" in cli.versions()


def test_dataset_pruning_and_leaves(spark, tmp_path):
    rows = spark.range(20).select(F.col("id").cast("string").alias("text"), F.lit("c d").alias("corpus"), F.when(F.col("id") < 5, "train").otherwise("test").alias("split"), F.lit("007").alias("language"))
    sinks.write_dataset(rows, f"{tmp_path}/d")
    (tmp_path / "d" / "notes.txt").write_text("no parquet")
    data = shards.read_dataset(spark, f"{tmp_path}/d")
    leaf = shards.read_leaf(data, {"corpus": "c d", "split": "train", "language": "007"}, ("text",))
    assert leaf.count() == 5 and "PartitionFilters: [" in leaf._jdf.queryExecution().toString()
    assert {(r["split"], len(r["files"]) > 0) for r in shards.leaves(data).collect()} == {("train", True), ("test", True)}
    sinks.write_tsv(data.groupBy("split").count(), f"{tmp_path}/t")
    assert shards.read_tsv(spark, f"{tmp_path}/t").count() == 2


def test_file_shards(spark, tmp_path, corpus):
    for i in range(20):
        raw_rows(spark, 1).coalesce(1).write.parquet(f"{tmp_path}/yor_batch/{i}")
    drawn = registry.Corpus(repo_id="r", languages={"yor_batch": None}, splits={"train": None}, split_weight=[0.5, 0.2, 0.3], dir_format="{lang}/{split}/**.parquet")
    found = shards.file_shards(spark, str(tmp_path), drawn)
    assert found.count() == 20 and {r["split"] for r in found.collect()} <= {"train", "validation", "test"}
    with pytest.raises(FileNotFoundError):
        shards.file_shards(spark, str(tmp_path), corpus)


def test_flags_and_archives(spark, tmp_path):
    lines = ["--rir-id r1 --room x RIRS/a.wav", "--loud --quiet --bg", "a b", "--k 'two words' c", "", "--k 1 --k 2"]
    (tmp_path / "list").write_text("\n".join(lines))
    records = [r["record"] for r in flags.read_flags(spark, f"{tmp_path}/list").collect()]
    assert records == [{"rir-id": "r1", "room": "x", "path": "RIRS/a.wav"}, {"loud": "true", "quiet": "true", "bg": "true"}, {"path": "b"}, {"k": "two words", "path": "c"}, {"k": "2"}]
    df = spark.createDataFrame([(x,) for x in lines if "'" not in x and x], "l string")
    for r in df.select("l", flags.flags_native(F.col("l")).alias("m")).collect():
        assert r["m"] == flags.parse_flags(r["l"])
    assert spark.createDataFrame([("--k 'open",)], "l string").select(flags.flags_column(F.col("l")).alias("m")).first()["m"] is None
    with zipfile.ZipFile(tmp_path / "a.zip", "w") as z:
        z.writestr("x/y.txt", "1")
    assert flags.extract_zip(str(tmp_path / "a.zip"), str(tmp_path / "o")) == ["x/y.txt"]
    with zipfile.ZipFile(tmp_path / "b.zip", "w") as z:
        z.writestr("../y.txt", "1")
    with pytest.raises(ValueError):
        flags.extract_zip(str(tmp_path / "b.zip"), str(tmp_path / "o"))


def test_upload_retries_and_reports(tmp_path):
    for n in ("a.parquet", "b.txt", "c.parquet"):
        (tmp_path / n).write_text(n)
    plan = sinks.plan_upload([str(tmp_path / n) for n in ("a.parquet", "b.txt", "c.parquet")], str(tmp_path), "p")
    assert sorted(plan.values()) == ["p/b.txt", "p/data/a.parquet", "p/data/c.parquet"]
    assert sinks.plan_upload([f"file:{tmp_path}/data/x.parquet"], f"file://{tmp_path}") == {f"file:{tmp_path}/data/x.parquet": "data/x.parquet"}
    for outside in ("/etc/hosts", f"{tmp_path}/../x"):
        with pytest.raises(ValueError):
            sinks.plan_upload([outside], str(tmp_path))
    waits, calls = [], []

    def commit(group):
        calls.append(sorted(group.values()))
        if "p/data/c.parquet" in group.values() or len(calls) == 1:
            raise ValueError

    failed = sinks.upload(plan, commit, group=2, tries=3, wait=1, sleep=waits.append)
    assert [f.rsplit("/", 1)[1] for f in failed] == ["c.parquet"] and waits == [1, 1, 2]
    sinks.upload(plan, sinks.copy_to(str(tmp_path / "to")))
    assert (tmp_path / "to/p/data/a.parquet").read_text() == "a.parquet"
    assert sinks.download(str(tmp_path / "to"), str(tmp_path / "back"), "p") and sinks.download(str(tmp_path), str(tmp_path), "none") is None
    assert sinks.repository_name("hf://datasets/org/x/") == "org/x"


def test_syllable_csv(spark, tmp_path):
    (tmp_path / "in.csv").write_text('id,transcription\n1,"Un nɔ́, ɖu nǔ"\n2,\n')
    sinks.syllable_csv(spark, f"{tmp_path}/in.csv", f"{tmp_path}/out")
    got = spark.read.csv(f"{tmp_path}/out", header=True).collect()
    assert [(r["ID"], r["Target"] or "") for r in got] == [("1", "un nɔ1 ɖu nu3"), ("2", "")]
    (tmp_path / "in.csv").write_text("a,b\n1,2\n")
    with pytest.raises(ValueError):
        sinks.syllable_csv(spark, f"{tmp_path}/in.csv", f"{tmp_path}/out")
    sinks.write_configs({"one": spark.range(3), "two": spark.range(2)}, f"{tmp_path}/c")
    assert spark.read.parquet(f"{tmp_path}/c/two").count() == 2


def test_card(spark, corpus):
    text = sinks.card(registry.registry_table(spark, {"demo": corpus}), "Demo", "cc-by-4.0", ["yo"])
    assert "- config_name: demo_yor" in text and "path: data/corpus=demo/split=validation/language=yor/*.parquet" in text


def test_arrivals_are_taken_once(spark, tmp_path):
    schema = "text string, corpus string, split string, language string, duration_sec double, snr_db double, noise_level_db double, speech_level_db double, speech_ratio double, spectral_bandwidth_hz double"
    spark.conf.set("spark.sql.streaming.schemaInference", "false")
    rows = spark.createDataFrame([("a", "c", "train", "yor", 2.0, 1.0, 1.0, 1.0, 1.0, 1.0)] * 3, schema)
    for i in range(2):
        rows.coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        follow(spark, f"{tmp_path}/in", f"{tmp_path}/out", f"{tmp_path}/ck", lambda df: df, schema, 1).awaitTermination(120)
    states = spark.read.parquet(f"{tmp_path}/out/state")
    assert states.agg(F.sum("count")).first()[0] == 6 and states.select("shard_id").distinct().count() == 2
