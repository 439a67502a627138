"""Problem 3: exact token counts of texts, rolled up by source, language and domain.

A text beyond ``chunk_chars`` is cut where the tokenizer provably starts anew, and its chunks are spread over
the workers by a salt of text and chunk number; shorter texts are counted where they are read. Chunk counts add
up to the count of the whole text, which the tests check against whole-text encoding.

Why the cuts are exact, by what the tokenizer's file says (``boundary``):

- Byte-level vocabularies split a text by the pattern in ``vocab`` from left to right before they merge,
  and merges never cross a split. No alternative of that pattern spans (1) a character that is not white space and a
  space after it, or (2) a letter and a number. The only look-ahead belongs to white-space runs; in (1) and (2)
  no such run ends at the cut, and in (1) the space is followed by no further white space, so that it opens the next
  word in either reading.
- Where the file's own pattern drops white space, no word spans it, and neither composition nor lower case looks across it.
- Where pieces hold the space as their first sign and none has one behind another sign, as a look at all pieces shows, no
  merge crosses from a word to a space. The space itself is left out, since the tokenizer puts one before every text.

A stretch with no such place stays whole, and so do the texts of a tokenizer of another kind.
"""

from __future__ import annotations

import json
import os
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sonolode.functions.names import corpus_name, language_code
from sonolode.llm import vocab
from sonolode.session import staged

#: Above this many characters a text is cut into chunks.
CHUNK_CHARS = 16_384


@lru_cache(maxsize=8)
def boundary(tokenizer: str, directory: str):
    """(pattern of the places where a text may be cut, characters left out there), or none where no place is proven."""
    import regex

    byte_level = regex.compile(rf"(?<=[^{vocab._S}])(?= [^{vocab._S}])|(?<=\p{{L}})(?=\p{{N}})"), 0
    base = os.path.join(directory, tokenizer)
    if os.path.exists(base + ".tiktoken"):
        return byte_level
    if os.path.exists(base + ".json"):
        with open(base + ".json", encoding="utf-8") as f:
            spec = json.load(f)
        before = spec.get("pre_tokenizer") or {}
        steps = before.get("pretokenizers", [before])
        if spec.get("normalizer") is None and steps == [{"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True}]:
            return byte_level
        known = {"NFC", "Lowercase", "Replace"}
        normal = spec.get("normalizer") or {}
        first = steps[0]
        # words are what the pattern matches, and no alternative of it has a place for white space
        drops = first.get("type") == "Split" and first.get("invert") and first.get("behavior") == "Removed" and first["pattern"].get("Regex") == vocab.WORDS
        if drops and {n["type"] for n in normal.get("normalizers", [normal]) if n} <= known:
            return regex.compile(r"(?<=\S)(?=\s)"), 0
        return None
    if os.path.exists(base + ".model"):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=base + ".model")
        whole = not any("▁" in sp.id_to_piece(i).lstrip("▁") for i in range(sp.get_piece_size()))
        # a space is put before every text, and two spaces stay two
        plain = sp.encode("a", out_type=str)[:1] == ["▁a"] and sum(x.count("▁") for x in sp.encode("a  b", out_type=str)) == 3
        if whole and plain:
            return regex.compile(r"(?<=[^\s▁])(?= [^\s▁])"), 1
    return None


def cut(text: str, chunk_chars: int = CHUNK_CHARS, places=None) -> list[str]:
    """Chunks of ``text`` of about ``chunk_chars`` characters, at ``places`` (a ``boundary``) only."""
    pattern, skip = places or boundary(vocab.DEFAULT, vocab.folder())
    chunks, start = [], 0
    while len(text) - start > chunk_chars:
        m = pattern.search(text, start + chunk_chars)
        if not m:
            break
        chunks.append(text[start : m.start()])
        start = m.start() + skip
    return [*chunks, text[start:]]


def counter(tokenizer: str, directory: str):
    """A function from texts to token counts; ``tokenizer`` is a name of the folder, of any kind."""
    if os.path.exists(os.path.join(directory, tokenizer + ".tiktoken")):
        enc = vocab.rank_encoder(directory, tokenizer)
        return lambda texts: [len(x) for x in enc.encode_ordinary_batch(texts, num_threads=1)]
    if os.path.exists(os.path.join(directory, tokenizer + ".model")):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=os.path.join(directory, tokenizer + ".model"))
        return lambda texts: [len(x) for x in sp.encode(texts, num_threads=1)]
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(os.path.join(directory, tokenizer + ".json"))
    tok.encode_special_tokens = True
    return lambda texts: [len(x.ids) for x in tok.encode_batch(texts, add_special_tokens=False)]


def _count_column(tokenizer: str, directory: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = None
        for batch in batches:
            count = count or counter(tokenizer, directory)
            texts = batch.column(batch.num_columns - 1).to_pylist()
            counts = count([t or "" for t in texts])
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array([None if t is None else n for t, n in zip(texts, counts)], pa.int64())], names=[*batch.schema.names[:-1], "n_tokens"])

    return run


def count_tokens(df: DataFrame, id_col: str, text_col: str, carry: dict[str, Column] | None = None, tokenizer: str = vocab.DEFAULT, directory: str | None = None, chunk_chars: int = CHUNK_CHARS) -> DataFrame:
    """(id, carried columns, n_tokens bigint) for each row of ``df``.

    A null text counts null, an empty one 0. Repeated rows give repeated results. Carried columns are
    named by the caller; all others, whatever their names, are dropped before anything moves. The texts are read once: short ones are counted
    there, the chunks of long ones are written out and spread.
    """
    directory = directory or vocab.folder()
    carry = carry or {}
    kinds = df.select(F.col(id_col), *[c.alias(n) for n, c in carry.items()])
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kinds.schema)
    rows = df.select(F.col(id_col), *[c.alias(n) for n, c in carry.items()], F.col(text_col).cast("string").alias("__text"))
    if boundary(tokenizer, directory) is None:
        return rows.mapInArrow(_count_column(tokenizer, directory), schema + ", n_tokens bigint")
    # Chunk -1 is a whole text. A long text has a name of its own, so that rows with equal or null ids are not added up together.
    extra = [("n_tokens", pa.int64()), ("__row", pa.int64()), ("__chunk", pa.int32()), ("__text", pa.string())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, named = TaskContext.get().partitionId() << 33, 0
        count = places = None
        for batch in batches:
            count, places = count or counter(tokenizer, directory), places or boundary(tokenizer, directory)
            texts = batch.column(batch.num_columns - 1).to_pylist()
            short = [t if t and len(t) <= chunk_chars else "" for t in texts]
            counts = [None if t is None else n for t, n in zip(texts, count(short))]
            long = [i for i, t in enumerate(texts) if t and len(t) > chunk_chars]
            names = [*batch.schema.names[:-1], *(n for n, _ in extra)]
            whole = batch.filter(pa.array([t is None or len(t) <= chunk_chars for t in texts], pa.bool_())) if long else batch
            ours = pa.array([n for t, n in zip(texts, counts) if t is None or len(t) <= chunk_chars], pa.int64())
            yield pa.RecordBatch.from_arrays([*whole.columns[:-1], ours, pa.nulls(len(ours), pa.int64()), pa.array([-1] * len(ours), pa.int32()), pa.nulls(len(ours), pa.string())], names=names)
            for i in long:
                chunks, one = cut(texts[i], chunk_chars, places), batch.slice(i, 1)
                same = [pa.concat_arrays([c] * len(chunks)) for c in one.columns[:-1]]
                yield pa.RecordBatch.from_arrays([*same, pa.nulls(len(chunks), pa.int64()), pa.array([task + named] * len(chunks), pa.int64()), pa.array(range(len(chunks)), pa.int32()), pa.array(chunks, pa.string())], names=names)
                named += 1

    read = staged(rows.mapInArrow(run, schema + ", n_tokens bigint, __row bigint, __chunk int, __text string"), "token-counts")
    counted = read.filter("__chunk = -1").select(*kinds.columns, "n_tokens")
    spread = read.filter("__chunk >= 0").select(*kinds.columns, "__row", "__chunk", "__text").repartition(F.xxhash64("__row", "__chunk"))
    parts = spread.mapInArrow(_count_column(tokenizer, directory), schema + ", __row bigint, __chunk int, n_tokens bigint")
    whole = parts.groupBy(*kinds.columns, "__row").agg(F.sum("n_tokens").alias("n_tokens")).drop("__row")
    return counted.unionByName(whole)


def text_tokens(utterances: DataFrame, documents: DataFrame, registry: DataFrame, **options) -> DataFrame:
    """(dataset, id, source, language, domain, n_tokens) for each record of both tables.

    A repeated delivery of an utterance counts once; rows without utt_id each count as a record. Names of
    corpora and languages are compared in canonical form; what is null stays null. The domain of an utterance is that of its corpus.
    """
    spoken = count_tokens(utterances, "utt_id", "text", {"source": corpus_name("corpus"), "language": language_code("language")}, **options)
    once = spoken.filter("utt_id is not null").groupBy("utt_id").agg(F.min(F.struct("source", "language", "n_tokens")).alias("r")).select("utt_id", "r.*")
    spoken = once.unionByName(spoken.filter("utt_id is null"))
    # one row per corpus, whatever the registry repeats
    domains = registry.groupBy(corpus_name("corpus").alias("source")).agg(F.min("domain").alias("domain")).filter("source is not null")
    spoken = spoken.join(domains, "source", "left").select(F.lit("utterances").alias("dataset"), F.col("utt_id").alias("id"), "source", "language", "domain", "n_tokens")
    written = count_tokens(documents, "doc_id", "text", {"source": corpus_name("source"), "language": language_code("lang"), "domain": F.col("domain")}, **options)
    written = written.select(F.lit("documents").alias("dataset"), F.col("doc_id").alias("id"), "source", "language", "domain", "n_tokens")
    return spoken.unionByName(written)


def token_budget(counts: DataFrame) -> DataFrame:
    """Totals of ``text_tokens`` per (source, language, domain) slice and per each of them alone.

    ``level`` names the grouping; columns outside it are null. ``texts`` counts all rows, ``with_text``
    those whose text is not null. Each slice is summed before anything is shuffled, so a source that
    holds a third of all rows sends a handful of rows per task.
    """
    slices = counts.groupBy("dataset", "source", "language", "domain").agg(F.count(F.lit(1)).alias("texts"), F.count("n_tokens").alias("with_text"), F.coalesce(F.sum("n_tokens"), F.lit(0)).alias("tokens"))
    sets = [("dataset", "source", "language", "domain"), ("dataset", "source"), ("dataset", "language"), ("dataset", "domain"), ("dataset",)]
    names = ["slice", "source", "language", "domain", "dataset"]
    rolled = slices.groupingSets([[F.col(c) for c in s] for s in sets], *[F.col(c) for c in sets[0]]).agg(F.grouping_id().alias("g"), *[F.sum(c).alias(c) for c in ("texts", "with_text", "tokens")])
    bits = {n: sum(1 << (3 - i) for i, c in enumerate(sets[0]) if c not in s) for n, s in zip(names, sets)}
    level = F.create_map(*[x for n, b in bits.items() for x in (F.lit(b), F.lit(n))])[F.col("g").cast("int")]
    return rolled.select("dataset", level.alias("level"), "source", "language", "domain", "texts", "with_text", "tokens")
