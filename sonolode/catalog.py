"""Queries of the corpus operators by name, and the SQL that each is held against.

Every query runs over its whole tables. Values that hang on the order of floating-point sums are rounded in both.
"""

from __future__ import annotations

import atexit
import unicodedata
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sonolode import sinks
from sonolode.functions import audio, hashing, tones
from sonolode.functions import text as texts
from sonolode.functions.names import CORPUS_SQL, LANGUAGE_SQL, corpus_name, language_code
from sonolode.functions.syllables import syllabified
from sonolode.operators import ledger, metrics, projection, sampling
from sonolode.session import _remove, shared_folder, table
from sonolode.sources import flags, shards

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}
_SQL: dict[str, str] = {}

#: Words that are written but not spoken, and spoken variants, as the queries use them.
UNUTTERED = ("laughter", "noise", "um", "uh")
PHRASES = {"plenty wahala": "wahala", "comot from": "komot", "the": "di", "talk": "tok", "small time": "smol taim"}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def keep(f: Query) -> Query:
        _QUERIES[f.__name__] = f
        if sql:
            _SQL[f.__name__] = sql
        return f

    return keep


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)


def records(spark: SparkSession, d: str) -> DataFrame:
    """Utterances, each record once, with canonical names; what a repeated delivery shares is taken from any."""
    names = {"corpus": corpus_name("corpus"), "language": language_code("language"), "split": F.nullif(F.lower(F.trim("split")), F.lit(""))}
    columns = ["text", "speaker_id", "shard_id", "corpus", "language", "split", *audio.METRICS]
    rows = table(spark, d, "utterances").withColumns(names)
    return rows.groupBy("utt_id").agg(*[F.min(c).alias(c) for c in columns])


_METRIC_LIST = ", ".join(f"min({m}) as {m}" for m in audio.METRICS)
_RECORDS = f"""records as (select utt_id, min(text) as text, min(speaker_id) as speaker_id, min(shard_id) as shard_id, min({CORPUS_SQL.format('corpus')}) as corpus,
 min({LANGUAGE_SQL.format('language')}) as language, min(nullif(lower(trim(split)), '')) as split, {_METRIC_LIST} from utterances group by utt_id)"""
_LONG = "long as (" + " union all ".join(f"select corpus, split, language, shard_id, '{m}' as metric, case when isfinite({m}) then {m}::double + 0.0::double end as x from records" for m in audio.METRICS) + ")"


def _wide(extra: str = "") -> str:
    parts = []
    for m in audio.METRICS:
        x = f"case when isfinite({m}) then {m}::double end"
        parts += [f"round(avg({x}), 6) as {m}_mean", f"round(stddev_pop({x}), 4) as {m}_std"]
    hours = "round(coalesce(sum(case when isfinite(duration_sec) then duration_sec::double end), 0) / 3600, 6) as hours"
    return f"with {_RECORDS} select corpus, split, language, {hours}, count(*) as count, {', '.join(parts)} from records group by corpus, split, language"


def _rounded(df: DataFrame) -> DataFrame:
    return df.withColumns({c: F.round(c, 4 if c.endswith("_std") else 6) for c, t in df.dtypes if t == "double"})


@query(_wide())
def corpus_metrics(spark: SparkSession, d: str) -> DataFrame:
    return _rounded(metrics.finalize(metrics.group_state(records(spark, d))))


@query(_wide())
def corpus_metrics_merged(spark: SparkSession, d: str) -> DataFrame:
    """The same from states per shard, merged; a shard that is added twice counts once."""
    by_shard = metrics.group_state(records(spark, d), ("shard_id", *metrics.KEYS))
    named = by_shard.filter("shard_id is not null")
    known = named.filter(F.pmod(F.xxhash64("shard_id"), F.lit(2)) == 0)
    both = metrics.add_shards(metrics.add_shards(known, named), known)
    # a null shard names none, so its state joins the merge directly
    nameless = by_shard.filter("shard_id is null")
    return _rounded(metrics.finalize(metrics.merge_states(both.unionByName(nameless).drop("shard_id"))))


@query(f"""with {_RECORDS}, {_LONG}, ranked as (select *, row_number() over (partition by corpus, split, language, metric order by x) - 1 as r, count(x) over (partition by corpus, split, language, metric) as k from long where x is not null),
 plain as (select corpus, split, language, metric, count(*) as count, count(x) as n, round(avg(x), 6) as mean, round(stddev_samp(x), 4) as std from long group by all),
 q as (select corpus, split, language, metric, max(case when r = round_even((k - 1) * 0.1, 0) then x end) as p10, median(x) as p50, max(case when r = round_even((k - 1) * 0.9, 0) then x end) as p90 from ranked group by all)
 select p.*, round(q.p10, 6) as p10, round(q.p50, 6) as p50, round(q.p90, 6) as p90 from plain p left join q on p.corpus is not distinct from q.corpus and p.split is not distinct from q.split and p.language is not distinct from q.language and p.metric = q.metric""")
def rich_metrics(spark: SparkSession, d: str) -> DataFrame:
    out = metrics.rich_metrics(records(spark, d))
    return out.withColumns({c: F.round(c, 4 if c == "std" else 6) for c in ("mean", "std", "p10", "p50", "p90")})


@query(f"""with {_RECORDS}, h as (select language, corpus, case when isfinite(duration_sec) then duration_sec::double end / 3600 as x from records)
 select language, case when grouping(corpus) = 1 then 'Total' else corpus end as corpus, round(sum(x), 6) as hours from h group by grouping sets ((language, corpus), (language))""")
def hours_with_totals(spark: SparkSession, d: str) -> DataFrame:
    return metrics.hours_with_totals(records(spark, d)).withColumn("hours", F.round("hours", 6)).orderBy("language", "hours")


@query(f"with {_RECORDS} select split, round(sum(case when isfinite(duration_sec) then duration_sec::double end), 4) as seconds from records group by split")
def seconds_per_split(spark: SparkSession, d: str) -> DataFrame:
    return records(spark, d).groupBy("split").agg(F.round(F.sum(metrics.finite("duration_sec")), 4).alias("seconds"))


_LEAVES = f"""{_RECORDS}, leaf as (select corpus, language, sum(case when isfinite(duration_sec) then duration_sec::double end) / 3600 as h from records where split = 'train' and corpus is not null and language is not null group by 1, 2),
 c as (select corpus, sum(h) as h from leaf group by 1 having sum(h) > 0), pc as (select corpus, pow(h, 0.25) / sum(pow(h, 0.25)) over () as pc from c),
 pl as (select corpus, language, pow(h, 0.2) / sum(pow(h, 0.2)) over (partition by corpus) as pl from leaf where h > 0)"""


def _leaf_weights(spark: SparkSession, d: str) -> DataFrame:
    state = metrics.group_state(records(spark, d), metrics.KEYS, ())
    return sampling.leaf_weights(state, 0.25, 0.2)


@query(f"with {_LEAVES} select corpus, language, round(pc * pl, 9) as p from pl join pc using (corpus)")
def leaf_weights(spark: SparkSession, d: str) -> DataFrame:
    return _leaf_weights(spark, d).withColumn("p", F.round("p", 9))


@query(f"""with {_LEAVES}, n as (select corpus, language, count(*) as n from records where split = 'train' group by 1, 2), w as (select corpus, language, pc * pl as p, n from pl join pc using (corpus) join n using (corpus, language)),
 e as (select *, sum(p) over (order by corpus, language) / sum(p) over () as upper, row_number() over (order by corpus, language) = count(*) over () as last from w),
 d as (select unnest(range(((select max(n / p) * sum(p) from w) * 3 + 20000)::bigint)) as position), u as (select position, ('0x' || substr(sha256('42:' || position::varchar), 1, 8))::bigint / 4294967296.0::double as u from d),
 b as (select corpus, language, n, case when last then 2.0 else upper end as upper, coalesce(lag(upper) over (order by corpus, language), 0) as lower from e),
 t as (select position, corpus, language, n, row_number() over (partition by corpus, language order by position) - 1 as turn from u asof join b on u.u >= b.lower)
 select position, corpus, language, turn % n as row from t where position <= (select max(position) from t where turn = n - 1)""")
def interleave_plan(spark: SparkSession, d: str) -> DataFrame:
    """Leaves drawn by their weights until each is used up."""
    sizes = records(spark, d).filter("split = 'train'").groupBy("corpus", "language").agg(F.count(F.lit(1)).alias("n"))
    return sampling.interleave_plan(_leaf_weights(spark, d).join(sizes, ["corpus", "language"]), seed=42)


@query(f"with {_LEAVES}, w as (select corpus, sum(h) as hours from leaf group by 1) select corpus, round(hours, 6) as hours, round(pow(hours / (select sum(hours) from w), 0.25), 9) as weight from w")
def smoothed_weights(spark: SparkSession, d: str) -> DataFrame:
    """Shares of hours smoothed without scaling to 1 again."""
    state = metrics.group_state(records(spark, d), metrics.KEYS, ()).filter("split = 'train' and corpus is not null and language is not null")
    out = sampling.smoothed_first(state.groupBy("corpus").agg(F.sum("hours").alias("hours")), 0.25)
    return out.select("corpus", F.round("hours", 6).alias("hours"), F.round("weight", 9).alias("weight"))


@query("select doc_id, row_number() over (order by sha256('42:' || doc_id::varchar), doc_id) - 1 as place from documents")
def seeded_shuffle(spark: SparkSession, d: str) -> DataFrame:
    keyed = table(spark, d, "documents").select("doc_id", F.sha2(F.concat_ws(":", F.lit("42"), F.col("doc_id").cast("string")), 256).alias("k"))
    return sampling.numbered(keyed, ["k", "doc_id"], name="place").select("doc_id", "place")


_PATH = "(source || '/' || doc_id::varchar)"


@query(f"""with b as (select doc_id, substr(sha256({_PATH}), 1, 20) as shard_id, {hashing.BUCKET_SQL.format(p=_PATH)} as bucket from documents)
 select *, case when bucket is null then null when bucket / 10000.0 < 0.7 then 'train' when bucket / 10000.0 < 0.7 + 0.1 then 'validation' else 'test' end as split from b""")
def split_assignment(spark: SparkSession, d: str) -> DataFrame:
    path = F.concat("source", F.lit("/"), F.col("doc_id").cast("string"))
    return table(spark, d, "documents").select("doc_id", hashing.shard_id(path).alias("shard_id"), hashing.split_bucket(path).alias("bucket"), hashing.assign_split(path).alias("split"))


@query(f"""select text, {LANGUAGE_SQL.format('language')} as language, nullif(lower(trim(split)), '') as split, {CORPUS_SQL.format('corpus')} as corpus, octet_length(audio.bytes) as n_bytes, audio.path as path,
 round(case when isfinite(duration_sec) then duration_sec::double + 0.0::double end, 6) as duration_sec, round(case when isfinite(snr_db) then snr_db::double + 0.0::double end, 6) as snr_db from utterances""")
def target_schema(spark: SparkSession, d: str) -> DataFrame:
    raw = table(spark, d, "utterances").withColumnRenamed("text", "utterance")
    shaped = projection.reshape(raw, {"utterance": "transcript"}, ["speaker_id"], drop_first=False)
    rows = projection.to_target(shaped, language_code("language"), F.nullif(F.lower(F.trim("split")), F.lit("")), corpus_name("corpus"))
    clip = [F.octet_length("audio.bytes").alias("n_bytes"), F.col("audio.path").alias("path")]
    return rows.select("text", "language", "split", "corpus", *clip, *[F.round(metrics.finite(m), 6).alias(m) for m in ("duration_sec", "snr_db")])


@query("""select corpus, t.unnest.key as source_language, coalesce(nullif(t.unnest.value, ''), t.unnest.key) as language, s.unnest.key as source_split, coalesce(nullif(s.unnest.value, ''), s.unnest.key) as split
 from registry, unnest(map_entries(languages)) as t, unnest(map_entries(splits)) as s""")
def registry_targets(spark: SparkSession, d: str) -> DataFrame:
    return shards.target_names(table(spark, d, "registry"))


@query("""with named as (select corpus, language, split, repo_id || '/' || language || '/' || split as path from (select corpus, repo_id, unnest(map_keys(languages)) as language, splits from registry where include_lang_as_arg), unnest(map_keys(splits)) as s(split)),
 plain as (select corpus, map_keys(languages)[1] as language, split, repo_id || '/' || split as path from registry, unnest(map_keys(splits)) as s(split) where not coalesce(include_lang_as_arg, false) and cardinality(languages) > 0)
 select *, substr(sha256(path), 1, 20) as shard_id from (from named union all from plain)""")
def pseudo_shards(spark: SparkSession, d: str) -> DataFrame:
    return shards.pseudo_shards(table(spark, d, "registry"))


@query("""with r as (select lower(coalesce(nullif(corpus, ''), split_part(repo_id, '/', -1))) as corpus, languages, splits from registry), l as (select corpus, unnest(map_entries(languages)) as e, splits from r),
 s as (select corpus, regexp_replace(coalesce(nullif(e.value, ''), e.key), '_ng$', '') as language, unnest(map_entries(splits)) as f from l),
 t as (select distinct corpus, language, coalesce(nullif(f.value, ''), f.key) as split from s)
 select corpus || '_' || language as config, split, 'data/corpus=' || corpus || '/split=' || split || '/language=' || language || '/*.parquet' as path from t""")
def card_configs(spark: SparkSession, d: str) -> DataFrame:
    return sinks.card_configs(table(spark, d, "registry"))


@query("""with a as (select corpus, repo_id, unnest(['', 'hf://datasets/', 'https://buckets/']) || repo_id || unnest(['', '/', '//']) as address from registry)
 select corpus, repo_id, address, trim(regexp_replace(case when contains(address, '://') then substr(address, strpos(address, '://') + 3) else address end, '^(datasets/)?(buckets/)?', ''), '/') as name, lower(coalesce(nullif(corpus, ''), split_part(repo_id, '/', -1))) as display from a""")
def display_names(spark: SparkSession, d: str) -> DataFrame:
    """Names of repositories from addresses of several kinds, and of what the corpora are shown as."""
    forms = F.array(F.col("repo_id"), F.concat(F.lit("hf://datasets/"), "repo_id", F.lit("/")), F.concat(F.lit("https://buckets/"), "repo_id", F.lit("//")))
    rows = table(spark, d, "registry").select("corpus", "repo_id", F.explode(forms).alias("address"))
    return rows.select("corpus", "repo_id", "address", sinks.repository_column(F.col("address")).alias("name"), projection.display_name(F.col("corpus"), F.col("repo_id")).alias("display"))


_NEWEST = "newest as (select * from shards qualify row_number() over (partition by shard_id order by updated_at desc, status desc) = 1)"


def _newest(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "shards").select("shard_id", "updated_at", "status", "repo_id", "filename", "local_dir", "row_count")
    return ledger.latest(rows)


@query(f"with {_NEWEST} select shard_id, status, repo_id, filename, row_count from newest")
def ledger_latest(spark: SparkSession, d: str) -> DataFrame:
    return _newest(spark, d).select("shard_id", "status", "repo_id", "filename", "row_count")


@query(f"with {_NEWEST} select status, count(*) as shards from newest group by status")
def ledger_stats(spark: SparkSession, d: str) -> DataFrame:
    return ledger.stats(_newest(spark, d))


@query(f"""with {_NEWEST} select shard_id, filename, status, row_number() over (order by case when status = 'pending' then 0 else 1 end, filename, shard_id) - 1 as turn from newest
 where status in ('pending', 'completed') and shard_id in (select shard_id from utterances)""")
def ledger_claim(spark: SparkSession, d: str) -> DataFrame:
    seen = table(spark, d, "utterances").select("shard_id")
    rows = ledger.claimed(_newest(spark, d), seen, "shard_id").withColumn("later", F.when(F.col("status") == "pending", 0).otherwise(1))
    return sampling.numbered(rows, ["later", "filename", "shard_id"], name="turn").select("shard_id", "filename", "status", "turn")


@query("select distinct shard_id from utterances where shard_id is not null and shard_id not in (select shard_id from shards where shard_id is not null)")
def ledger_unseen(spark: SparkSession, d: str) -> DataFrame:
    found = table(spark, d, "utterances").select("shard_id").filter("shard_id is not null").distinct()
    return ledger.unseen(table(spark, d, "shards"), found, "shard_id")


@query(f"""with {_NEWEST}, {_RECORDS}, c as (select shard_id, count(*) as n_records from records group by 1) select s.shard_id, s.row_count, coalesce(n_records, 0) as n_records from newest s left join c using (shard_id)""")
def shard_counts(spark: SparkSession, d: str) -> DataFrame:
    seen = records(spark, d).groupBy("shard_id").agg(F.count(F.lit(1)).alias("n_records"))
    return _newest(spark, d).join(seen, "shard_id", "left").select("shard_id", "row_count", F.coalesce("n_records", F.lit(0)).alias("n_records"))


@query("select distinct unnest(local_dir) as folder from shards")
def distinct_folders(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "shards").select(F.explode("local_dir").alias("folder")).distinct()


@query(f"""with {_RECORDS} select corpus, split, language, count(*) as n_rows, count(distinct shard_id) as n_shards from records group by all""")
def partition_inventory(spark: SparkSession, d: str) -> DataFrame:
    return records(spark, d).groupBy(*metrics.KEYS).agg(F.count(F.lit(1)).alias("n_rows"), F.countDistinct("shard_id").alias("n_shards"))


@query(f"with {_RECORDS} select corpus, split, language, count(*) as n_rows from records group by all")
def dataset_roundtrip(spark: SparkSession, d: str) -> DataFrame:
    """Records written in folders by corpus, split and language, and counted from what is read back."""
    root = f"{shared_folder(spark)}/dataset-{uuid.uuid4().hex}"
    sinks.write_dataset(records(spark, d).select("text", *metrics.KEYS), root)
    atexit.register(_remove, spark, root)
    counted = shards.read_dataset(spark, root).groupBy(*metrics.KEYS).agg(F.count(F.lit(1)).alias("n_rows"))
    return counted.select(*[F.col(k).cast("string").alias(k) for k in metrics.KEYS], "n_rows")


@query(f"with {_RECORDS} select utt_id, text, duration_sec from records where corpus = 'tonefield' and split = 'train' and language = 'yor'")
def one_leaf(spark: SparkSession, d: str) -> DataFrame:
    root = f"{shared_folder(spark)}/dataset-{uuid.uuid4().hex}"
    sinks.write_dataset(records(spark, d).select("utt_id", "text", "duration_sec", *metrics.KEYS), root)
    atexit.register(_remove, spark, root)
    return shards.read_leaf(shards.read_dataset(spark, root), {"corpus": "tonefield", "split": "train", "language": "yor"}, ("utt_id", "text", "duration_sec"))


_LINE = f"regexp_replace(regexp_replace(text, '[\\r\\n]+', ' ', 'g'), '^[{texts.char_class(texts.SPACE, java=True)}]+|[{texts.char_class(texts.SPACE, java=True)}]+$', '', 'g')"


@query(f"""select {CORPUS_SQL.format('corpus')} as corpus, nullif(lower(trim(split)), '') as split, {LANGUAGE_SQL.format('language')} as language, {_LINE} as line from utterances where {_LINE} <> ''""")
def manifest_lines(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "utterances").select(corpus_name("corpus").alias("corpus"), F.nullif(F.lower(F.trim("split")), F.lit("")).alias("split"), language_code("language").alias("language"), "text")
    return sinks.manifest_lines(rows)


@query("""select 'utterances' as dataset, utt_id as id, language, corpus as source, text from utterances union all select 'documents', doc_id, lang, source, text from documents union all select 'prompts', prompt_id, language, null, text from prompts""")
def union_catalogs(spark: SparkSession, d: str) -> DataFrame:
    one = table(spark, d, "utterances").select(F.lit("utterances").alias("dataset"), F.col("utt_id").alias("id"), "language", F.col("corpus").alias("source"), "text")
    two = table(spark, d, "documents").select(F.lit("documents").alias("dataset"), F.col("doc_id").alias("id"), F.col("lang").alias("language"), "source", "text")
    three = table(spark, d, "prompts").select(F.lit("prompts").alias("dataset"), F.col("prompt_id").alias("id"), "language", "text")
    return one.unionByName(two).unionByName(three, allowMissingColumns=True)


@query(f"""with {_RECORDS} select r.utt_id, r.corpus, g.repo_id, g.domain, coalesce(g.normalize, '*') as normalizer from records r left join registry g on r.corpus = g.corpus""")
def registry_lookup(spark: SparkSession, d: str) -> DataFrame:
    known = table(spark, d, "registry").select("corpus", "repo_id", "domain", F.coalesce("normalize", F.lit("*")).alias("normalizer"))
    return records(spark, d).select("utt_id", "corpus").join(known, "corpus", "left").select("utt_id", "corpus", "repo_id", "domain", F.coalesce("normalizer", F.lit("*")).alias("normalizer"))


_PUNCT = texts.char_class(texts.PUNCTUATION, java=True)
_SPACE = texts.char_class(texts.SPACE, java=True)
_DIGIT = texts.char_class(texts.DIGITS, java=True)
_FLAT = f"trim(regexp_replace(text, '[{_SPACE}]+', ' ', 'g'))"
_NORMAL = {
    "bracket_removal": (texts.without_numbered_brackets, "regexp_replace(text, '\\([^)]*[0-9][^)]*\\)', ' ', 'g')"),
    "entity_removal": (texts.without_entities, "regexp_replace(text, '&lt;|&gt;|&nbsp', '', 'g')"),
    "punctuation_to_blank": (texts.without_punctuation, f"regexp_replace(text, '[{_PUNCT}]', ' ', 'g')"),
    "whitespace_collapse": (texts.collapsed, _FLAT),
    "number_word_removal": (texts.without_number_words, f"case when contains({_FLAT}, ' ') then array_to_string(list_filter(string_split({_FLAT}, ' '), lambda w: not regexp_matches(w, '^[{_DIGIT}]+$')), ' ') else {_FLAT} end"),
}


def _step(name: str, step, sql: str) -> None:
    def run(spark: SparkSession, d: str) -> DataFrame:
        return table(spark, d, "documents").select("doc_id", step("text").alias("text"))

    run.__name__ = name
    query(f"select doc_id, {sql} as text from documents")(run)


for _name, (_f, _sql) in _NORMAL.items():
    _step(_name, _f, _sql)


# Without look-around a match takes the boundary along, so that of adjoining words every other one is left for a second pass.
_GONE = "(^|[^\\p{L}\\p{N}_])(?:" + "|".join(UNUTTERED) + ")($|[^\\p{L}\\p{N}_])"
_ONCE = f"regexp_replace(text, '{_GONE}', '\\1\\2', 'g')"
_TWICE = f"regexp_replace({_ONCE}, '{_GONE}', '\\1\\2', 'g')"


@query(f"select doc_id, trim(regexp_replace({_TWICE}, '[{_SPACE}]+', ' ', 'g')) as text from documents")
def unuttered_removal(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", texts.without_words("text", UNUTTERED).alias("text"))


# Phrases of one word and of two: of adjoining places where two-word phrases begin, every other one counts.
_PAIRS = "(values " + ", ".join(f"('{k}', '{v}')" for k, v in PHRASES.items()) + ")"


@query(f"""with docs as (select doc_id, text from documents where {LANGUAGE_SQL.format('lang')} = 'pcm'), phrases(k, v) as {_PAIRS}, lists as (select doc_id, list_filter(string_split({_FLAT}, ' '), lambda w: w <> '') as w from docs where text is not null),
 tokens as (select doc_id, generate_subscripts(w, 1) as i, unnest(w) as t from lists), pairs as (select *, t || ' ' || lead(t) over (partition by doc_id order by i) as two from tokens),
 begun as (select p.*, v as joined, v is not null as hit from pairs p left join phrases on k = two), islands as (select *, i - sum(hit::int) over (partition by doc_id order by i) as island from begun),
 places as (select *, hit and row_number() over (partition by doc_id, hit, island order by i) % 2 = 1 as taken from islands), gone as (select *, coalesce(lag(taken) over (partition by doc_id order by i), false) as over from places),
 done as (select doc_id, i, case when taken then joined else coalesce(v, t) end as t from gone left join phrases on k = t where not over)
 select doc_id, case when any_value(text) is not null then coalesce(string_agg(t, ' ' order by i), '') end as text from docs left join done using (doc_id) group by doc_id""")
def phrase_replacement(spark: SparkSession, d: str) -> DataFrame:
    """Pidgin documents with spoken variants replaced, longest phrase first."""
    rows = table(spark, d, "documents").filter(language_code("lang") == "pcm")
    return rows.select("doc_id", texts.with_phrases("text", PHRASES).alias("text"))


_APOSTROPHES = texts.char_class(texts.APOSTROPHES, java=True)
_BASIC = "regexp_replace(regexp_replace(lower(nfc_normalize(text)), '\\([^)]*[0-9][^)]*\\)', ' ', 'g'), '&lt;|&gt;|&nbsp', '', 'g')"
_DELETED = texts.char_class(texts.DELETED, java=True)
_CLEAN = f"regexp_replace(regexp_replace(regexp_replace({_BASIC}, '[{_APOSTROPHES}]', chr(39), 'g'), '[{_PUNCT}]', ' ', 'g'), '[{_DELETED}]', '', 'g')"


@query(f"select doc_id, coalesce(trim(regexp_replace(regexp_replace({_CLEAN}, '[^a-z0-9\\x27 ]', ' ', 'g'), ' +', ' ', 'g')), '') as text from documents")
def text_normalized_eng(spark: SparkSession, d: str) -> DataFrame:
    """All documents as if they were English, whose alphabet SQL can express."""
    return table(spark, d, "documents").select("doc_id", texts.normalized("text", F.lit("eng")).alias("text"))


def _admitted(language: str) -> str:
    """Characters whose decomposition stays within the alphabet of a language."""
    alphabet = {*texts.LETTERS[language], *texts.MARKS[language], *"0123456789' "}
    return texts.char_class("".join(c for c in map(chr, [*range(0x20, 0xD800), *range(0xE000, 0x10000)]) if alphabet.issuperset(unicodedata.normalize("NFD", c))), java=True)


def _alphabetic(language: str) -> None:
    def run(spark: SparkSession, d: str) -> DataFrame:
        return table(spark, d, "documents").select("doc_id", texts.normalized("text", F.lit(language)).alias("text"))

    run.__name__ = f"text_normalized_{language}"
    kept = f"regexp_replace({_CLEAN}, '[^{_admitted(language)}]', ' ', 'g')"
    bare = f"regexp_replace({kept}, '(^| )[\\x{{300}}-\\x{{36f}}]+', '\\1', 'g')"
    query(f"select doc_id, coalesce(trim(regexp_replace({bare}, ' +', ' ', 'g')), '') as text from documents")(run)


for _name in ("yor", "ibo", "hau", "pcm"):
    _alphabetic(_name)


@query()
def text_normalized(spark: SparkSession, d: str) -> DataFrame:
    """Utterances in the form of their language; needs Unicode forms that SQL engines do not share, so held against goldens."""
    rows = table(spark, d, "utterances")
    return rows.select("utt_id", texts.normalized("text", language_code("language"), unuttered={"eng": UNUTTERED, "pcm": UNUTTERED}, homophones=PHRASES).alias("text"))


@query()
def text_syllables(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "utterances").filter(language_code("language") == "fon")
    return rows.select("utt_id", syllabified("text").alias("syllables"))


_TONE = f"case when contains('{tones.carriers(chr(0x301))}', c) then 1 when contains('{tones.carriers(chr(0x300))}', c) then -1 else 0 end"
_VECTOR = f"list_transform(regexp_extract_all(text, '(?s).'), lambda c: {_TONE})"


@query(f"select utt_id, array_to_string({_VECTOR}, ',') as tones from utterances")
def tone_vector(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "utterances").select("utt_id", F.concat_ws(",", F.transform(tones.tone_vector("text"), lambda t: t.cast("string"))).alias("tones"), "text").select("utt_id", F.when(F.col("text").isNotNull(), F.col("tones")).alias("tones"))


@query(f"""with v as (select prompt_id, language, {_VECTOR} as ref from prompts), w as (select *, lag(ref) over (partition by language order by prompt_id) as hyp from v),
 p as (select prompt_id, list_filter(list_transform(generate_series(1, greatest(len(ref), len(hyp))), lambda i: [coalesce(hyp[i], 0), coalesce(ref[i], 0)]), lambda x: x[1] <> 0 or x[2] <> 0) as pairs from w where hyp is not null)
 select prompt_id, case when len(pairs) = 0 then null else round(len(list_filter(pairs, lambda x: x[1] <> x[2])) / len(pairs)::double, 9) end as rate from p""")
def tone_error_rate(spark: SparkSession, d: str) -> DataFrame:
    """Each prompt's tones against those of the prompt before it in its language."""
    from pyspark.sql import Window

    before = F.lag("ref").over(Window.partitionBy("language").orderBy("prompt_id"))  # a fixed table of sentences
    rows = table(spark, d, "prompts").select("prompt_id", "language", tones.tone_vector("text").alias("ref")).withColumn("hyp", before).filter("hyp is not null")
    rate = tones.tone_errors("hyp", "ref")
    return rows.select("prompt_id", F.when(~F.isnan(rate), F.round(rate, 9)).alias("rate"))


# The chunks of a WAV, walked one by one in hexadecimal.
_LE = "(('0x' || substr(h, 2 * ({at} + 1) + 1, 2))::bigint * 256 + ('0x' || substr(h, 2 * ({at}) + 1, 2))::bigint)"
_LE4 = f"({_LE} + 65536 * {_LE.replace('{at}', '{at} + 2')})"
_CHUNKS = f"""wavs as (select distinct utt_id, hex(audio.bytes) as h, octet_length(audio.bytes) as n from utterances where audio.bytes is not null),
 chunks(utt_id, h, n, spot) as (select utt_id, h, n, 12::bigint from wavs where substr(h, 1, 8) = '52494646' and substr(h, 17, 8) = '57415645'
  union all select utt_id, h, n, spot + 8 + {_LE4.format(at='spot + 4')} + {_LE4.format(at='spot + 4')} % 2 from chunks where spot + 8 <= n),
 inside as (select utt_id, h, n, spot, substr(h, 2 * spot + 1, 8) as name, least({_LE4.format(at='spot + 4')}, n - spot - 8) as size from chunks where spot + 8 <= n),
 formats as (select utt_id, min_by({_LE.format(at='spot + 8')}, spot) as kind, min_by({_LE.format(at='spot + 10')}, spot) as channels, min_by({_LE4.format(at='spot + 12')}, spot) as rate, min_by({_LE.format(at='spot + 22')}, spot) as bits from inside where name = '666D7420' and size >= 16 group by utt_id)"""


def _level_sql(size: int, hop: int) -> str:
    frame = f"list_transform(generate_series(1, len(x) - {size - 1}, {hop}), lambda i: sqrt(list_sum(list_transform(x[i:i + {size - 1}], lambda v: v * v)) / {size} + 1e-12))"
    rms = "sqrt(list_sum(list_transform({0}, lambda v: v * v)) / len({0}))"
    bodies = "bodies as (select utt_id, min_by(h, spot) as h, min(spot) as spot, min_by(size, spot) as size from inside where name = '64617461' group by utt_id)"
    sample = _LE.format(at="spot + 8 + 2 * i")
    return f"""with recursive {_CHUNKS}, {bodies}, fine as (select b.* from bodies b join formats f using (utt_id) where kind = 1 and channels = 1 and bits = 16 and rate > 0),
 points as (select utt_id, list(case when v >= 32768 then v - 65536 else v end / 32768.0::double order by i) as x from (select utt_id, i, {sample} as v from (select utt_id, h, spot, unnest(range(size // 2)) as i from fine)) group by utt_id),
 padded as (select utt_id, case when len(x) < {size} then list_concat(x, list_transform(range({size} - len(x)), lambda i: 0.0::double)) else x end as x from (select utt_id, coalesce(x, []) as x from fine left join points using (utt_id))),
 f as (select utt_id, {frame} as rms from padded), e as (select *, list_sort(rms) as s, (len(rms) - 1) * 0.1 as pos from f),
 t as (select *, s[floor(pos)::int + 1] + (pos - floor(pos)) * (s[least(floor(pos)::int + 2, len(s))] - s[floor(pos)::int + 1]) as edge from e),
 m as (select *, list_filter(rms, lambda r: r <= edge) as quiet from t), q as (select *, {rms.format('quiet')} as noise from m),
 l as (select *, list_filter(rms, lambda r: r > noise * pow(10, 6 / 20.0)) as loud from q), p as (select *, case when len(loud) > 0 then loud else rms end as speech from l)
 select utt_id, round(20 * log10(greatest(noise, 1e-10)), 6) as noise_level_db, round(20 * log10(greatest({rms.format('speech')}, 1e-10)), 6) as speech_level_db,
 round(20 * log10(greatest({rms.format('speech')}, 1e-10)) - 20 * log10(greatest(noise, 1e-10)), 6) as snr_db, round(len(speech) / len(rms)::double, 6) as speech_ratio from p"""


@query(_level_sql(64, 32))
def level_profile(spark: SparkSession, d: str) -> DataFrame:
    """Levels of every excerpt at its own rate: frames of 64 samples, 32 apart."""
    clips = table(spark, d, "utterances").groupBy("utt_id").agg(F.min("audio.bytes").alias("clip"))
    rows = clips.select("utt_id", audio.waveform("clip").alias("x")).filter("x is not null")
    levels = rows.select("utt_id", audio.level_struct(audio.frame_levels("x", 64, 32)).alias("m"))
    return levels.select("utt_id", *[F.round(f"m.{n}", 6).alias(n) for n in ("noise_level_db", "speech_level_db", "snr_db", "speech_ratio")])


@query()
def clip_metrics(spark: SparkSession, d: str) -> DataFrame:
    """The six metrics of every excerpt."""
    rows = table(spark, d, "utterances").select("utt_id", "audio")
    return audio.with_metrics(rows).select("utt_id", *audio.METRICS)


@query(f"with recursive {_CHUNKS} select u.utt_id, rate::int as rate, channels::int as channels from utterances u left join (select distinct * from formats) f on u.utt_id = f.utt_id")
def clip_headers(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "utterances").select("utt_id", F.col("audio.bytes").alias("content"))
    return audio.wav_header(rows, keep=("utt_id",))


@query("""with w as (select shard_id, list_filter(regexp_split_to_array(trim('--corpus ' || repo_id || ' --verified ' || filename), '\\s+'), lambda x: x <> '') as t from shards)
 select shard_id, t[2] as corpus, t[4] as verified from w""")
def flag_records(spark: SparkSession, d: str) -> DataFrame:
    line = F.concat(F.lit("--corpus "), "repo_id", F.lit(" --verified "), "filename")
    return table(spark, d, "shards").select("shard_id", flags.flags_native(line).alias("r")).select("shard_id", F.col("r")["corpus"].alias("corpus"), F.col("r")["verified"].alias("verified"))
