"""Counts per key when a few keys hold most rows.

Rows are cut into equal splits by a row id, never by the counted key. Every split encodes its keys in a local
dictionary, counts the codes with bincount and gives out one array pair (keys, counts) a block of keys. Blocks are
summed into dense accumulators by a distributed reduction: a hot key reaches its reducer once a split, not once a row.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Keys of the dictionary a block, and distinct keys that a split gathers before it gives them out.
BLOCK_KEYS = 20_000
SPLIT_KEYS = 500_000
#: Splits whose arrays are summed in one step of the reduction.
LANE_SPLITS = 256


def _block(keys: np.ndarray, blocks: int) -> np.ndarray:
    """Spread keys evenly over blocks by a multiplicative hash."""
    return ((keys.astype("int64").view("uint64") * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(33)).astype("int64") % blocks


def _partial(key_columns: list[str], blocks: int, split_keys: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[tuple[np.ndarray, np.ndarray]]] = {k: [] for k in key_columns}
        size = 0

        def out() -> Iterator[pa.RecordBatch]:
            for name, parts in held.items():
                if not parts:
                    continue
                keys, code = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
                counts = np.bincount(code, weights=np.concatenate([p[1] for p in parts]), minlength=len(keys)).astype("int64")
                block = _block(keys, blocks)
                order = np.argsort(block, kind="stable")
                keys, counts, block = keys[order], counts[order], block[order]
                first = np.flatnonzero(np.diff(block, prepend=-1))
                offsets = pa.array(np.append(first, len(keys)).astype("int32"))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([name] * len(first), pa.string()), pa.array(block[first], pa.int64()), pa.ListArray.from_arrays(offsets, pa.array(keys)), pa.ListArray.from_arrays(offsets, pa.array(counts))],
                    names=["measure", "block", "keys", "counts"],
                )
                held[name] = []

        for batch in batches:
            for name in key_columns:
                column = batch.column(batch.schema.get_field_index(name)).drop_null()
                if len(column):
                    keys, code = np.unique(column.to_numpy(zero_copy_only=False), return_inverse=True)
                    held[name].append((keys, np.bincount(code, minlength=len(keys)).astype("float64")))
                    size += len(keys)
            if size > split_keys:
                yield from out()
                size = 0
        yield from out()

    return run


def _sum_arrays(parts: pa.Table) -> pa.Table:
    keys, code = np.unique(parts["keys"].combine_chunks().flatten().to_numpy(), return_inverse=True)
    counts = np.bincount(code, weights=parts["counts"].combine_chunks().flatten().to_numpy()).astype("int64")
    head = parts.slice(0, 1)
    ends = pa.array([0, len(keys)], pa.int32())
    return pa.table({"measure": head["measure"], "block": head["block"], "keys": pa.ListArray.from_arrays(ends, pa.array(keys)), "counts": pa.ListArray.from_arrays(ends, pa.array(counts))})


def count_keys(rows: DataFrame, row_id: str, key_columns: list[str], dictionary: DataFrame, key: str, *, block_keys: int = BLOCK_KEYS, split_keys: int = SPLIT_KEYS) -> DataFrame:
    """(key, measure, n) for every key of ``dictionary`` and every column of ``key_columns``: its number of different row ids.

    A row id given more than once counts once (its rows are taken to be alike). Null keys and keys that the dictionary
    lacks are not counted; keys without rows have 0. Repeated dictionary keys come out once. Keys are longs.
    """
    spark = rows.sparkSession
    blocks = max(1, -(-dictionary.select(key).filter(F.col(key).isNotNull()).count() // block_keys))
    splits = rows.select(F.col(row_id).cast("long").alias("row_id"), *(F.col(c).cast("long").alias(c) for c in key_columns)).filter(F.col("row_id").isNotNull()).dropDuplicates(["row_id"]).drop("row_id")
    partial = splits.mapInArrow(_partial(list(key_columns), blocks, split_keys), "measure string, block long, keys array<long>, counts array<long>")
    lanes = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")) // LANE_SPLITS)
    if lanes > 1:  # first sum the arrays of so many splits, that no block gathers those of all
        partial = partial.withColumn("lane", F.pmod(F.spark_partition_id(), F.lit(lanes))).groupBy("measure", "block", "lane").applyInArrow(_sum_arrays, partial.schema)
    codes = dictionary.select(F.col(key).cast("long").alias("k")).filter(F.col("k").isNotNull())
    names = list(key_columns)

    def add_block(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            k = batch.column(0).to_numpy(zero_copy_only=False)
            block = _block(k, blocks)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(block)], names=["k", "block"])

    codes = codes.mapInArrow(add_block, "k long, block long")

    def reduce(parts: pa.Table, words: pa.Table) -> pa.Table:
        keys = np.unique(words["k"].to_numpy())
        out = []
        for name in names:
            total = np.zeros(len(keys), "int64")
            own = parts.filter(pa.compute.equal(parts["measure"], name))
            if own.num_rows and len(keys):
                k, n = own["keys"].combine_chunks().flatten().to_numpy(), own["counts"].combine_chunks().flatten().to_numpy()
                spot = np.minimum(np.searchsorted(keys, k), len(keys) - 1)
                known = keys[spot] == k
                np.add.at(total, spot[known], n[known])
            out.append(pa.table({"key": pa.array(keys, pa.int64()), "measure": pa.array([name] * len(keys), pa.string()), "n": pa.array(total, pa.int64())}))
        return pa.concat_tables(out)

    return partial.groupBy("block").cogroup(codes.groupBy("block")).applyInArrow(reduce, "key long, measure string, n long")
