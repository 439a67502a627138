"""Public vocabularies: where they lie, how a worker loads them, how a text is split before merging."""

from __future__ import annotations

import base64
import json
import os
from functools import lru_cache

# The split pattern of the byte-level vocabularies, with Unicode White_Space written out
# because the library's own \s also takes in U+001C to U+001F.
_S = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
SPLIT = rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{_S}\p{{L}}\p{{N}}]+|[{_S}]+(?![^{_S}])|[{_S}]+"

# Fixed value: the same pattern as the libraries of the rank files take it.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

# Fixed value: the pattern of the words of a vocabulary that drops white space.
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"

DEFAULT = "byte_bpe_50k"


def folder() -> str:
    """``SONOLODE_TOKENIZERS`` or /opt/tokenizers; every operator also takes it as a parameter."""
    return os.environ.get("SONOLODE_TOKENIZERS", "/opt/tokenizers")


@lru_cache(maxsize=4)
def splitter():
    import regex

    return regex.compile(SPLIT)


@lru_cache(maxsize=4)
def rank_encoder(directory: str, name: str):
    """A tiktoken encoder of ``name``.tiktoken without special tokens; loaded once per worker."""
    import tiktoken

    with open(os.path.join(directory, name + ".tiktoken"), "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding(name, pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


@lru_cache(maxsize=2)
def merge_table(directory: str, name: str):
    """(ids of the 256 bytes, merges as left, right, rank, new) of ``name``.json, as numpy arrays."""
    import numpy as np

    with open(os.path.join(directory, name + ".json"), encoding="utf-8") as f:
        model = json.load(f)["model"]
    vocab = model["vocab"]
    pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
    byte_ids = np.array([vocab[c] for c in byte_letters()], dtype=np.int32)
    merges = np.array([(vocab[a], vocab[b], rank, vocab[a + b]) for rank, (a, b) in enumerate(pairs)], dtype=np.int32)
    return byte_ids, merges.reshape(-1, 4)


def byte_letters() -> list[str]:
    """The letter by which a byte-level vocabulary writes each byte: itself if printable, else U+0100 on."""
    printable = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(0x100, 0x200))
    return [chr(b) if b in printable else chr(next(spare)) for b in range(256)]
