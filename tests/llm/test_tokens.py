import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sonolode.llm import budget, encode, vocab
from sonolode.session import table

ODD = [None, "", " ", "a", "  \n\t a", "\r\n\r\n x", "don't we'll I'M", "aaaaaaaa" * 200, "é" * 300, "😀👩‍👩‍👧" * 20, "<|endoftext|> [INST]", "x\x1cy\x1fz\x85 \xa0　end", "1234567890" * 30, "ọ̀rọ̀ ń ṣe", "!" * 999, " " * 500 + "x", "\x00\x01", "١٢٣ ४५", "tab\tnew\nline   "]


def reference(texts):
    enc = vocab.rank_encoder(vocab.folder(), vocab.DEFAULT)
    return [enc.encode_ordinary(t or "") for t in texts]


def test_odd_texts(spark):
    df = spark.createDataFrame([(i, t, "clash") for i, t in enumerate(ODD)] + [(None, "x", ""), (0, None, "")], "doc_id long, text string, ids string")
    got = encode.encode_documents(df)
    assert [f.name for f in got.schema] == ["doc_id", "ids"]
    rows = {r["doc_id"]: r["ids"] for r in got.collect()}
    assert got.count() == len(ODD) + 2 and rows[None] == reference(["x"])[0]
    for i, ids in enumerate(reference(ODD)):
        assert rows[i] == ids
    assert encode.encode_documents(df.limit(0)).count() == 0


@given(st.lists(st.text(max_size=80), max_size=8))
@settings(max_examples=60, deadline=None)
def test_any_text(texts):
    encoder = encode.WordEncoder(vocab.folder(), vocab.DEFAULT)
    assert [x.tolist() for x in encoder.texts(texts)] == reference(texts)


def test_kept_words(monkeypatch):
    monkeypatch.setattr(encode, "KEPT", 5)
    encoder = encode.word_encoder(vocab.folder(), vocab.DEFAULT)
    for _ in range(2):
        for part in (ODD[:6], [], ODD[3:], [None, ""], ODD):
            assert [x.tolist() for x in encoder.texts(part)] == reference(part)


@pytest.mark.parametrize("limit", [1, 8, encode.LONG_WORD])
def test_long_words(monkeypatch, limit):
    monkeypatch.setattr(encode, "LONG_WORD", limit)
    rng = random.Random(7)
    texts = ["".join(rng.choice("abehinrst") for _ in range(n)) for n in (9, 200, 9000)] + ["=" * 9001, "short words", "", "ọ́" * 5000]
    encoder = encode.WordEncoder(vocab.folder(), vocab.DEFAULT)
    assert [x.tolist() for x in encoder.texts(texts)] == reference(texts)


def test_the_other_library_agrees():
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(f"{vocab.folder()}/{vocab.DEFAULT}.json")
    tok.encode_special_tokens = True
    texts = [t for t in ODD if t]
    encoder = encode.WordEncoder(vocab.folder(), vocab.DEFAULT)
    assert [x.tolist() for x in encoder.texts(texts)] == [tok.encode(t, add_special_tokens=False).ids for t in texts]


@given(st.text(alphabet="ab1 \n'ọ́.!  ", max_size=300), st.integers(1, 40))
@settings(max_examples=300, deadline=None)
def test_cuts_are_exact(text, size):
    chunks = budget.cut(text, size)
    assert "".join(chunks) == text
    whole, *parts = reference([text, *chunks])
    assert [i for p in parts for i in p] == whole


@pytest.mark.parametrize("tokenizer", ["byte_bpe_50k", "byte_bpe_multi_50k", "word_bpe_49k", "piece_bpe_32k"])
def test_chunks_add_up(spark, tokenizer):
    rng = random.Random(1)
    texts = [*ODD, *(" ".join("abcdefg1 "[: rng.randrange(1, 9)] for _ in range(n)) for n in (10, 500, 4000))]
    df = spark.createDataFrame(list(enumerate(texts)) + [(0, texts[-1]), (None, texts[-1])], "id long, text string")
    got = sorted((r["id"] is None, r["id"] or 0, -1 if r["n_tokens"] is None else r["n_tokens"]) for r in budget.count_tokens(df, "id", "text", tokenizer=tokenizer, chunk_chars=100).collect())
    count = budget.counter(tokenizer, vocab.folder())
    own = [(i, t) for i, t in enumerate(texts)] + [(0, texts[-1]), (None, texts[-1])]
    assert got == sorted((i is None, i or 0, -1 if t is None else count([t])[0]) for i, t in own)


def test_budget(spark, small):
    u, d, r = (table(spark, small, n) for n in ("utterances", "documents", "registry"))
    each = budget.text_tokens(u, d, r)
    assert each.filter("dataset = 'utterances'").count() == u.select("utt_id").distinct().count()
    rolled = budget.token_budget(each).collect()
    total = each.groupBy("dataset").agg(F.sum("n_tokens").alias("t")).collect()
    for row in total:
        for level in ("slice", "source", "language", "domain", "dataset"):
            assert sum(x["tokens"] for x in rolled if x["dataset"] == row["dataset"] and x["level"] == level) == row["t"]
    clash = d.withColumns({n: F.lit(1) for n in ("n_tokens", "__row", "__chunk", "language", "weight", "id")})
    assert budget.token_budget(budget.text_tokens(u.limit(0), clash, r.limit(0))).count() > 0
    assert budget.token_budget(budget.text_tokens(u.limit(0), d.limit(0), r)).count() == 0


@pytest.mark.parametrize("tokenizer", ["byte_bpe_50k", "byte_bpe_multi_50k", "word_bpe_49k", "piece_bpe_32k"])
def test_boundaries_of_every_tokenizer(tokenizer):
    rng = random.Random(11)
    count, places = budget.counter(tokenizer, vocab.folder()), budget.boundary(tokenizer, vocab.folder())
    bits = ["word", "Ọ̀rọ̀", "e\u0301", "\u0301x", "12", "9a", " ", "  ", "\n", " \t", "'s", "!?", "\u3000", "\xa0", "ΑΣ", "<s>", "</w>", "▁", "ﬁ", "😀"]
    for _ in range(300):
        text = "".join(rng.choice(bits) + (" " if rng.random() < 0.4 else "") for _ in range(60))
        chunks = budget.cut(text, 10, places)
        assert len(chunks) > 1 and sum(count(chunks)) == count([text])[0]


def test_no_boundary_is_taken_for_granted(tmp_path):
    (tmp_path / "other.json").write_text('{"normalizer": null, "pre_tokenizer": {"type": "Metaspace"}, "model": {}}')
    assert budget.boundary("other", str(tmp_path)) is None and budget.boundary("absent", str(tmp_path)) is None


def test_long_texts_are_spread(spark, monkeypatch):
    monkeypatch.setattr(encode, "LONG_TEXT", 50)
    texts = [*ODD, "one two 3 four " * 300, "x" * 400]
    df = spark.createDataFrame([*enumerate(texts), (1, texts[-2])], "doc_id long, text string")
    got = {}
    for r in encode.encode_documents(df).collect():
        got.setdefault(r["doc_id"], []).append(r["ids"])
    want = {i: [x] for i, x in enumerate(reference(texts))}
    want[1] = [*want[1], want[len(texts) - 2][0]]
    assert {k: sorted(v) for k, v in got.items()} == {k: sorted(v) for k, v in want.items()}
