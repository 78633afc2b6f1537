"""Encoding of a whole corpus with a public vocabulary."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from knotwork.llm.bpe import DEFAULT_VOCABULARY, encoder, share, spans


def encode_corpus(df: DataFrame, doc_id: Column, text: Column, *, vocabulary: str = DEFAULT_VOCABULARY) -> DataFrame:
    """(doc_id, ids) of every row: the ids of its text by the vocabulary, without special tokens.

    Empty and null texts have an empty list. Rows are neither dropped nor merged: repeated ids come out as often as
    they are given. Texts of any length are encoded whole.
    """

    share(df.sparkSession, vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(vocabulary)
        for batch in batches:
            for part in spans(batch, 1):
                ids = coder.encode(part.column(1).to_pylist())
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(ids, pa.list_(pa.int32()))], names=["doc_id", "ids"])

    return df.select(doc_id.cast("long").alias("doc_id"), text.cast("string").alias("text")).mapInArrow(run, "doc_id long, ids array<int>")


def token_counts(df: DataFrame, text: Column, *keep: Column, vocabulary: str = DEFAULT_VOCABULARY) -> DataFrame:
    """The columns ``keep`` and ``tokens``, the number of ids of the text (0 for empty and null texts)."""
    kept = df.select(*keep, text.cast("string").alias("_text"))
    names = kept.columns[:-1]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema.fields[:-1]) + ", tokens long"

    share(df.sparkSession, vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(vocabulary)
        for batch in batches:
            for part in spans(batch, len(names)):
                n = coder.lengths(part.column(len(names)).to_pylist())
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], pa.array(n, pa.int64())], names=[*names, "tokens"])

    return kept.mapInArrow(run, schema)
