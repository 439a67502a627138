"""The schema that every prepared row has."""

from __future__ import annotations

from pyspark.sql import types as T

from sonolode.functions.audio import METRICS

AUDIO = T.StructType([T.StructField("bytes", T.BinaryType()), T.StructField("path", T.StringType())])
TARGET = T.StructType(
    [T.StructField("text", T.StringType()), T.StructField("audio", AUDIO)]
    + [T.StructField(c, T.StringType()) for c in ("language", "split", "corpus")]
    + [T.StructField(m, T.FloatType()) for m in METRICS]
)
#: Columns whose values name the folders of a prepared dataset.
PARTITIONS = ("corpus", "split", "language")
#: Names of the text column in the order in which they are looked for.
TEXT_NAMES = ("transcription", "transcript", "text")
