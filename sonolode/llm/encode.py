"""Problem 6: the ids of every document under a public byte-level tokenizer.

Each task splits its texts into words, keeps each distinct word once, and has DuckDB contract all new ones
together: a recursive query over token-position rows joins the merge table, contracts the leftmost
occurrences of each word's minimum-rank pair, and leaves a word out of the next round once no pair of it
can merge. Equal pairs of one word are contracted in one round, left to right without overlap; that equals
one at a time, since a pair made with a merged token always ranks behind that merge. An ordered read of the
rows gives the ids of each word, and an index gather those of each document. Nothing is shuffled but the chunks of texts over a
million characters, which are encoded by many tasks and put together again in order.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from heapq import heappop, heappush
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sonolode.llm import vocab
from sonolode.llm.budget import cut

#: Bytes of texts that are encoded together, about: bounds the rows of one recursive query, drops nothing.
BATCH_BYTES = 4_000_000
#: Texts of more characters are cut at proven boundaries and spread over tasks.
LONG_TEXT = 1 << 20
#: Encoded words that a worker keeps for its next texts; beyond, it starts anew.
KEPT = 400_000

#: A word of more bytes, such as a pasted blob without a blank, is contracted through a heap instead: its rounds would be too many.
LONG_WORD = 8192

_CONTRACT = """
with recursive bpe(wid, pos, tok, done) as (
    select wid, pos, tok, false from start
  union all
    (with near as (
        select wid, pos, tok, lead(tok) over (partition by wid order by pos) as nxt from bpe where not done),
     pairs as (
        select near.wid, near.pos, near.tok, merges.rank, merges.new
        from near left join merges on merges.pair = (near.tok::bigint << 20) | near.nxt),
     ranked as (
        select *, min(rank) over (partition by wid) as least,
               lag(rank) over (partition by wid order by pos) as before,
               row_number() over (partition by wid order by pos) as nth
        from pairs),
     runs as (
        select *, max(case when rank is distinct from before then nth end) over (partition by wid order by pos) as head
        from ranked),
     hits as (select *, coalesce(rank = least and (nth - head) % 2 = 0, false) as hit from runs),
     kept as (select *, coalesce(lag(hit) over (partition by wid order by pos), false) as gone from hits)
     select wid, pos, case when hit then new else tok end, least is null from kept where not gone)
)
select wid, tok from bpe where done order by pos
"""


def contract(tokens: list[int], merges: dict[int, tuple[int, int]]) -> list[int]:
    """Merges of one word, minimum rank first and leftmost among equals, in n log n steps; ``merges``: pair to (rank, new)."""
    after, before, alive = list(range(1, len(tokens) + 1)), list(range(-1, len(tokens) - 1)), [True] * len(tokens)
    heap: list[tuple[int, int, int]] = []

    def offer(i: int) -> None:
        j = after[i]
        if j < len(tokens) and (found := merges.get(tokens[i] << 20 | tokens[j])):
            heappush(heap, (found[0], i, tokens[i] << 20 | tokens[j]))

    for i in range(len(tokens) - 1):
        offer(i)
    while heap:
        _, i, pair = heappop(heap)
        j = after[i]
        if not alive[i] or j >= len(tokens) or tokens[i] << 20 | tokens[j] != pair:
            continue
        tokens[i], alive[j], after[i] = merges[pair][1], False, after[j]
        if after[j] < len(tokens):
            before[after[j]] = i
        offer(i)
        if before[i] >= 0:
            offer(before[i])
    return [t for t, a in zip(tokens, alive) if a]


class WordEncoder:
    """Ids of words by a recursive DuckDB query over the merge table; words once encoded are kept, ``KEPT`` at most."""

    def __init__(self, directory: str, name: str):
        import duckdb

        self.byte_ids, merges = vocab.merge_table(directory, name)
        self.db = duckdb.connect(config={"threads": 1, "memory_limit": "700MB"})
        pair = (merges[:, 0].astype(np.int64) << 20) | merges[:, 1]
        self.db.register("given", pa.table({"pair": pair, "rank": merges[:, 2], "new": merges[:, 3]}))
        self.db.execute("create table merges as select * from given")
        self.pairs = dict(zip(pair.tolist(), map(tuple, merges[:, 2:].tolist())))
        self.forget()

    def forget(self) -> None:
        self.code: dict[str, int] = {}
        self.sizes, self.ids = np.empty(0, np.int64), np.empty(0, np.int32)

    def encode(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(number of ids of each word, ids of all words)."""
        raw = [w.encode("utf-8", "surrogatepass") for w in words]
        if max(map(len, raw)) > LONG_WORD:
            return self._with_long(raw)
        return self._encode(raw)

    def _with_long(self, raw: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        short = [b for b in raw if len(b) <= LONG_WORD]
        sizes, ids = self._encode(short) if short else (np.empty(0, np.int64), np.empty(0, np.int32))
        parts = iter(np.split(ids, np.cumsum(sizes)[:-1]) if len(short) else [])
        found = [next(parts) if len(b) <= LONG_WORD else np.array(contract(self.byte_ids[np.frombuffer(b, np.uint8)].tolist(), self.pairs), np.int32) for b in raw]
        return np.array([len(f) for f in found]), np.concatenate(found)

    def _encode(self, raw: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        sizes = np.fromiter(map(len, raw), dtype=np.int64, count=len(raw))
        flat = np.frombuffer(b"".join(raw), dtype=np.uint8)
        start = pa.table({"wid": np.repeat(np.arange(len(raw), dtype=np.int32), sizes), "pos": np.arange(len(flat), dtype=np.int32), "tok": self.byte_ids[flat]})
        self.db.register("start", start)
        out = self.db.sql(_CONTRACT).to_arrow_table()
        self.db.unregister("start")
        return np.bincount(out.column("wid").to_numpy(), minlength=len(raw)), out.column("tok").to_numpy()

    def texts(self, texts: list[str | None]) -> list[np.ndarray]:
        """Ids per text; null and empty texts have none."""
        if len(self.code) > KEPT:
            self.forget()
        split, code, before = vocab.splitter().findall, self.code, len(self.code)
        pieces = [np.fromiter((code.setdefault(w, len(code)) for w in split(t)), dtype=np.int64) if t else np.empty(0, np.int64) for t in texts]
        if len(code) > before:
            sizes, ids = self.encode(list(islice(code, before, None)))
            self.sizes, self.ids = np.concatenate([self.sizes, sizes]), np.concatenate([self.ids, ids])
        starts = np.cumsum(self.sizes) - self.sizes
        out = []
        for p in pieces:
            n = self.sizes[p]
            ends = np.cumsum(n)
            # the position of each token: its word's start plus its place within the word
            out.append(self.ids[np.repeat(starts[p] - (ends - n), n) + np.arange(ends[-1])] if len(p) else np.empty(0, np.int32))
        return out


@lru_cache(maxsize=2)
def word_encoder(directory: str, name: str) -> WordEncoder:
    """One encoder per worker process, whatever number of tasks it runs."""
    return WordEncoder(directory, name)


def encode_documents(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", tokenizer: str = vocab.DEFAULT, directory: str | None = None) -> DataFrame:
    """(id, ids array<int>) for each row of ``documents``.

    Null and empty texts get the empty list; blanks are text like any other. Special tokens' strings are
    ordinary text. Repeated rows give repeated results, a null id stays null, and other columns of any
    name are ignored. Texts are encoded whole, whatever their length; an empty table gives an empty result.
    """
    directory = directory or vocab.folder()
    kind = documents.schema[id_col].dataType.simpleString()
    rows = documents.select(F.col(id_col), F.col(text_col).cast("string").alias("__text"))
    long = F.coalesce(F.length("__text") > LONG_TEXT, F.lit(False))
    whole = _encoded(rows.filter(~long), f"`{id_col}` {kind}", tokenizer, directory)

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i, text in enumerate(b.column(2).to_pylist()):
                for k, chunk in enumerate(cut(text, LONG_TEXT)):
                    yield pa.RecordBatch.from_arrays([b.column(0).slice(i, 1), b.column(1).slice(i, 1), pa.array([k], pa.int32()), pa.array([chunk], pa.string())], names=[id_col, "__row", "__chunk", "__text"])

    named = rows.filter(long).select(id_col, F.monotonically_increasing_id().alias("__row"), "__text")
    chunks = named.mapInArrow(split, f"`{id_col}` {kind}, __row bigint, __chunk int, __text string").repartition(F.xxhash64("__row", "__chunk"))
    parts = _encoded(chunks, f"`{id_col}` {kind}, __row bigint, __chunk int", tokenizer, directory)
    # the chunks' ids follow one another in the order of the chunks
    joined = parts.groupBy(id_col, "__row").agg(F.sort_array(F.collect_list(F.struct("__chunk", "ids"))).alias("c"))
    return whole.unionByName(joined.select(id_col, F.flatten("c.ids").alias("ids")))


def _encoded(rows: DataFrame, schema: str, tokenizer: str, directory: str) -> DataFrame:
    """``rows`` with ids in place of the text, which is the last column."""
    at = len(rows.columns) - 1
    names = [*rows.columns[:-1], "ids"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size = 0

        def flush() -> Iterator[pa.RecordBatch]:
            t = pa.Table.from_batches(held)
            lists = word_encoder(directory, tokenizer).texts(t.column(at).to_pylist())
            offsets = np.zeros(len(lists) + 1, dtype=np.int32)
            np.cumsum([len(x) for x in lists], out=offsets[1:])
            values = np.concatenate(lists) if lists else np.empty(0, np.int32)
            ids = pa.ListArray.from_arrays(pa.array(offsets), pa.array(values.astype(np.int32)))
            yield from pa.Table.from_arrays([*(c.combine_chunks() for c in t.columns[:-1]), ids], names=names).to_batches(max_chunksize=2000)

        for batch in batches:
            held.append(batch)
            size += batch.column(at).nbytes
            if size >= BATCH_BYTES:
                yield from flush()
                held, size = [], 0
        if held:
            yield from flush()

    return rows.mapInArrow(run, f"{schema}, ids array<int>")
