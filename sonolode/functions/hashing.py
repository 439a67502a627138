"""Identities and splits by SHA-256, computed inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from sonolode.functions.names import _col

#: Splits in the order in which weights name them.
SPLITS = ("train", "validation", "test")


def shard_id(path: Column | str) -> Column:
    """The first 20 hexadecimal digits of the path's SHA-256."""
    return F.substring(F.sha2(_col(path), 256), 1, 20)


def split_bucket(path: Column | str) -> Column:
    """The path's SHA-256 as a number, modulo 10,000.

    Eight 32-bit pieces are folded from the left; a piece shifts what came before by 2**32, which is 7296 modulo 10,000.
    """
    digest = F.sha2(_col(path), 256)
    bucket = F.lit(0).cast("bigint")
    for i in range(8):
        piece = F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("bigint")
        bucket = F.pmod(bucket * 7296 + piece, F.lit(10_000))
    return bucket


def assign_split(path: Column | str, weights: tuple[float, ...] = (0.7, 0.1, 0.2)) -> Column:
    """The split in whose stretch of the cumulative weights the path's bucket falls; the last one beyond all."""
    place = split_bucket(path) / F.lit(10_000.0)
    upper, out = 0.0, None
    for name, weight in zip(SPLITS, weights):
        upper += weight
        out = F.when(place < upper, name) if out is None else out.when(place < upper, name)
    return F.when(_col(path).isNotNull(), out.otherwise(SPLITS[-1]))


BUCKET_SQL = "{p}"
for _i in range(8):
    BUCKET_SQL = (
        f"(({BUCKET_SQL if _i else '0'}) * 7296 + ('0x' || substr(sha256({{p}}), {8 * _i + 1}, 8))::bigint) % 10000"
    )
