"""The queries of the problems, by name, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sonolode.functions.names import CORPUS_SQL, LANGUAGE_SQL
from sonolode.llm import budget, encode, mixing, overlap, packing, quantiles, skeleton, truncation, vocab
from sonolode.session import table


def p1_placements(spark: SparkSession, d: str) -> DataFrame:
    return packing.pack_clips(table(spark, d, "utterances"), table(spark, d, "containers"))[0]


def p1_fills(spark: SparkSession, d: str) -> DataFrame:
    return packing.pack_clips(table(spark, d, "utterances"), table(spark, d, "containers"))[1]


def p1_totals(spark: SparkSession, d: str) -> DataFrame:
    """(container, corpus, split, language, clips, parts, fill): what was placed in each group, from the placements, and the fills of its containers."""
    placements, fills = packing.pack_clips(table(spark, d, "utterances"), table(spark, d, "containers"))
    names = ["container", "corpus", "split", "language"]
    placed = placements.groupBy(*names).agg(F.countDistinct("utt_id").alias("clips"), F.count(F.lit(1)).alias("parts"))
    filled = fills.groupBy(*names).agg(F.sum("n_parts").alias("n"), F.round(F.sum("fill"), 6).alias("fill"))
    same = F.lit(True)
    for n in names:
        same = same & F.col(f"a.{n}").eqNullSafe(F.col(f"b.{n}"))
    return placed.alias("a").join(filled.alias("b"), same & (F.col("parts") == F.col("n")), "left").select(*[f"a.{n}" for n in names], "clips", "parts", "fill")


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    return overlap.overlaps(table(spark, d, "utterances"))


def p2_report(spark: SparkSession, d: str) -> DataFrame:
    return overlap.overlap_report(table(spark, d, "utterances"))


def p3_token_budget(spark: SparkSession, d: str) -> DataFrame:
    return budget.token_budget(p3_text_tokens(spark, d))


def p3_text_tokens(spark: SparkSession, d: str) -> DataFrame:
    return budget.text_tokens(table(spark, d, "utterances"), table(spark, d, "documents"), table(spark, d, "registry"))


def p4_percentiles(spark: SparkSession, d: str) -> DataFrame:
    return quantiles.percentiles(table(spark, d, "utterances"))


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    return skeleton.look_alikes(table(spark, d, "utterances"), table(spark, d, "prompts"))


def p5_forms(spark: SparkSession, d: str) -> DataFrame:
    spoken = skeleton.consistent_form(table(spark, d, "utterances"), "utt_id").distinct()
    fixed = skeleton.consistent_form(table(spark, d, "prompts"), "prompt_id")
    label = [F.lit("utterances").alias("dataset"), F.col("utt_id").alias("id"), "form"]
    return spoken.select(*label).unionByName(fixed.select(F.lit("prompts").alias("dataset"), F.col("prompt_id").alias("id"), "form"))


def p5_variants(spark: SparkSession, d: str) -> DataFrame:
    both = table(spark, d, "utterances").select("text").unionByName(table(spark, d, "prompts").select("text"))
    return skeleton.variants(both)


def p6_ids(spark: SparkSession, d: str) -> DataFrame:
    return encode.encode_documents(table(spark, d, "documents"))


def p7_choice(spark: SparkSession, d: str) -> DataFrame:
    return mixing.mix(table(spark, d, "documents"), table(spark, d, "mix_targets"))[0]


def p7_shares(spark: SparkSession, d: str) -> DataFrame:
    return mixing.mix(table(spark, d, "documents"), table(spark, d, "mix_targets"))[1]


def p8_found(spark: SparkSession, d: str) -> DataFrame:
    return truncation.cut_documents(table(spark, d, "documents"))


def p8_rates(spark: SparkSession, d: str) -> DataFrame:
    return truncation.cut_rates(table(spark, d, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = [p1_placements, p1_fills, p1_totals, p2_found, p2_report, p3_token_budget, p3_text_tokens, p4_percentiles, p5_found, p5_forms, p5_variants, p6_ids, p7_choice, p7_shares, p8_found, p8_rates]
    return {f.__name__: f for f in found}


# A token count per text, and ids, by SQL alone: the split pattern without look-ahead, words as bytes in hexadecimal, and the ranks of tokens read
# from the file of the other library, so that neither merge table nor code is shared. A run of white space before a word gives its last character to the word, or to a word of its own;
# the noncharacter U+FFFE, which no text holds, stands where the run is cut.
_BLANK = "\\t-\\r \\x{85}\\x{a0}\\x{1680}\\x{2000}-\\x{200a}\\x{2028}\\x{2029}\\x{202f}\\x{205f}\\x{3000}"
_WORDS = f"'s|'t|'re|'ve|'m|'ll|'d| ?\\p{{L}}+| ?\\p{{N}}+| ?[^{_BLANK}\\x{{fffe}}\\p{{L}}\\p{{N}}]+|[{_BLANK}]+".replace("'", "''")
_FILE = f"{vocab.folder()}/{vocab.DEFAULT}.tiktoken".replace("'", "''")


def _ids_sql(texts: str) -> str:
    """Common table expressions up to ``encoded`` (row, id, ids) for rows (row, id, text) of the query ``texts``."""
    return f"""with recursive texts as ({texts}),
 pieces as (select row, generate_subscripts(w, 1) as nth, unnest(w) as word from (select row, regexp_extract_all(regexp_replace(text, '([{_BLANK}])([{_BLANK}][^{_BLANK}])', '\\1' || chr(65534) || '\\2', 'g'), '{_WORDS}') as w from texts where text <> '')),
 vocabulary as (select word, row_number() over (order by word) as wid from (select distinct word from pieces)),
 ranks as (select hex(from_base64(token)) as tok, rank from read_csv('{_FILE}', delim = ' ', header = false, quote = '', escape = '', columns = {{'token': 'VARCHAR', 'rank': 'INTEGER'}})),
 start as (select wid, i as pos, substr(h, 2 * i::int + 1, 2) as tok from (select wid, unnest(range(octet_length(encode(word)))) as i, hex(encode(word)) as h from vocabulary)),
 bpe(wid, pos, tok, done) as (
  select wid, pos, tok, false from start
  union all
  (with near as (select wid, pos, tok, tok || lead(tok) over (partition by wid order by pos) as joined from bpe where not done),
   pairs as (select near.*, rank from near left join ranks on joined = ranks.tok),
   lowest as (select wid, min(rank) as low, min_by(pos, (rank, pos)) as spot from pairs group by wid),
   met as (select p.*, l.spot, l.low, lag(p.pos) over (partition by p.wid order by p.pos) as before from pairs p join lowest l on p.wid = l.wid)
   select wid, pos, case when pos = spot and low is not null then joined else tok end, low is null from met where low is null or before is distinct from spot)),
 words as (select wid, list(rank order by pos) as toks from bpe join ranks on bpe.tok = ranks.tok where done group by wid),
 encoded as (select t.row, any_value(t.id) as id, any_value(t.text) as text, coalesce(flatten(list(toks order by nth) filter (toks is not null)), []) as ids from texts t left join pieces p on t.row = p.row left join vocabulary v on p.word = v.word left join words w on v.wid = w.wid group by t.row)"""


_SPOKEN = f"(select utt_id, {CORPUS_SQL.format('corpus')} as source, {LANGUAGE_SQL.format('language')} as language, text from utterances)"
_TOKENS = f"""{_ids_sql("select row_number() over () as row, 0 as id, text from (select distinct text from utterances union select distinct text from documents)")},
 counted as (select text, case when text is not null then len(ids) end as n_tokens from encoded),
 spoken as (select utt_id, source, language, n_tokens from {_SPOKEN} u join counted c on u.text is not distinct from c.text),
 once as (select utt_id, unnest(min(row(source, language, n_tokens))) from spoken where utt_id is not null group by utt_id union all select * from spoken where utt_id is null),
 domains as (select {CORPUS_SQL.format('corpus')} as source, min(domain) as domain from registry group by 1),
 tokens as (select 'utterances' as dataset, utt_id as id, o.source, language, domain, n_tokens from (select utt_id, #2 as source, #3 as language, #4 as n_tokens from once) o left join domains d on o.source = d.source
  union all select 'documents', doc_id, {CORPUS_SQL.format('source')}, {LANGUAGE_SQL.format('lang')}, domain, n_tokens from documents d join counted c on d.text is not distinct from c.text)"""
_SUMS = "count(*) as texts, count(n_tokens) as with_text, coalesce(sum(n_tokens), 0)::bigint as tokens"
_WEIGHT = "greatest(0.05, coalesce(length(regexp_replace(text, '[^\\p{L}\\p{M} ]', '', 'g')) / nullif(length(text), 0)::double * least(1.0, length(text) / 100.0::double), 0.0))"
_MIX = f"""{_ids_sql("select row_number() over () as row, 0 as id, text from (select distinct text from documents)")},
 sized as (select doc_id, {CORPUS_SQL.format('source')} as source, len(ids) as n_tokens, {_WEIGHT.replace('text', 'd.text')} as weight from documents d join encoded e on d.text = e.text where len(ids) > 0),
 wanted as (select {CORPUS_SQL.format('source')} as source, sum(target_share) as target_share, min(max_repeats)::bigint as max_repeats from mix_targets where source is not null and target_share >= 0 and isfinite(target_share) group by 1),
 held as (select w.*, coalesce(available, 0)::bigint as available from wanted w left join (select source, sum(n_tokens) as available from sized group by 1) a using (source)),
 whole as (select coalesce(floor(min(max_repeats * available / target_share) filter (available > 0 and target_share > 0 and max_repeats >= 1)), sum(available))::bigint as total from held),
 plan as (select *, case when available = 0 then 0 when max_repeats is null then round(target_share * total)::bigint else least(round(target_share * total)::bigint, greatest(max_repeats, 0) * available) end as take from held, whole),
 keyed as (select s.*, take // available as epochs, take % available as rest, round(-ln((('0x' || substr(sha256('1:' || doc_id::varchar), 1, 13))::bigint + 0.5::double) / 4503599627370496.0::double) / weight, 9) as key from sized s join plan p on s.source = p.source),
 chosen as (select doc_id, source, n_tokens, (epochs + case when before + n_tokens / 2.0 <= rest and rest > 0 then 1 else 0 end)::bigint as repeats from (select *, sum(n_tokens) over (partition by source order by key, doc_id, n_tokens rows unbounded preceding) - n_tokens as before from keyed) where epochs > 0 or before + n_tokens / 2.0 <= rest and rest > 0)"""


def oracle_sql() -> dict[str, str]:
    """SQL for what SQL engines can express; the other queries are held against brute force in the tests.

    In look-alikes the order of marks under and above a letter is left as composition gives it, and so are decomposed dotless letters
    with a mark below, neither of which SQL can reorder.
    """
    k = skeleton.skeleton_sql("text")
    both = "select text from utterances union all select text from prompts"
    return {
        "p1_totals": f"""with once as (select utt_id, min(row({CORPUS_SQL.format('corpus')}, nullif(lower(trim(split)), ''), {LANGUAGE_SQL.format('language')}, duration_sec::double, octet_length(audio.bytes)::double)) as r from utterances where utt_id is not null group by utt_id),
 sizes as (select utt_id, r[1] as corpus, r[2] as split, r[3] as language, 'duration_sec' as field, ceil(r[4] * 1e6) as units, 1e6 as scale from once where isfinite(r[4]) and r[4] > 0 union all select utt_id, r[1], r[2], r[3], 'audio.bytes', r[5], 1 from once where r[5] > 0)
 select container, corpus, split, language, count(*) as clips, sum(ceil(units / floor(capacity * scale)))::bigint as parts, round(sum(units / scale), 6) as fill from sizes join containers using (field) group by all""",
        "p3_text_tokens": f"{_TOKENS} select * from tokens",
        "p3_token_budget": f"""{_TOKENS} select dataset, case grouping(dataset, source, language, domain) when 0 then 'slice' when 3 then 'source' when 5 then 'language' when 6 then 'domain' else 'dataset' end as level, source, language, domain, {_SUMS}
 from tokens group by grouping sets ((dataset, source, language, domain), (dataset, source), (dataset, language), (dataset, domain), (dataset))""",
        "p5_found": f"""with u as (select utt_id, text, {k} as k from utterances where text is not null and utt_id is not null),
 p as (select prompt_id, text, {k} as k from prompts where text is not null)
 select distinct utt_id, prompt_id from u join p on u.k = p.k where u.text <> p.text and u.k <> ''""",
        "p5_forms": f"select distinct 'utterances' as dataset, utt_id as id, {k} as form from utterances union all select 'prompts', prompt_id, {k} from prompts",
        "p5_variants": f"""with t as (select text as t, count(*) as n, {k} as form from ({both}) where text is not null group by text)
 select form, sum(n)::bigint as n_rows, count(*) as n_variants, max_by(t, (n, encode(t))) as most_common from t group by form having count(*) > 1""",
        "p6_ids": f"{_ids_sql('select doc_id as row, doc_id as id, text from documents')} select id as doc_id, ids from encoded",
        "p7_choice": f"{_MIX} select * from chosen",
        "p7_shares": f"""{_MIX}, given as (select source, count(*) as documents, sum(repeats)::bigint as copies, sum(repeats * n_tokens)::bigint as tokens, max(repeats) as most_repeats from chosen group by source)
 select source, target_share, max_repeats, available, total, coalesce(documents, 0) as documents, coalesce(copies, 0) as copies, coalesce(tokens, 0) as tokens, coalesce(most_repeats, 0) as most_repeats, coalesce(tokens, 0) / sum(tokens) over ()::double as actual_share from plan left join given using (source)""",
    }
