"""References to records that do not exist.

Keys are laid out in the order of a 64-bit code and cut into equal ranges; each range keeps its parents as one row of
sorted arrays. References are routed to the block of their range (hot ranges get several blocks, each with a copy of
the range's arrays) and a block's references are held against the arrays by binary search, a batch at a time.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Parents per range, references per block, and the most ranges (each range is one row on the driver).
RANGE_PARENTS = 50_000
BLOCK_ROWS = 60_000
MOST_RANGE_BITS = 16

#: Why a reference is an orphan, in the order of its code.
REASONS = ("missing", "late", "deleted")


def _range_of(code: Column, bits: int) -> Column:
    return F.shiftrightunsigned(code, 64 - bits).cast("int") if bits else F.lit(0)


def _parent_ranges(parents: DataFrame, bits: int, payload: str | None) -> DataFrame:
    fields = [F.col("code"), F.col("key"), F.col("born"), F.col("gone")] + ([F.col(payload).alias("payload")] if payload else [])
    rows = parents.groupBy(_range_of(F.col("code"), bits).alias("rng")).agg(F.sort_array(F.collect_list(F.struct(*fields))).alias("p"))
    return rows.select("rng", *(F.col(f"p.{n}").alias(f"p_{n}") for n in ["code", "key", "born", "gone"] + (["payload"] if payload else [])))


def _flat(column: pa.ChunkedArray) -> pa.Array:
    """The values of the one list that the block's parent row holds."""
    return column.combine_chunks().flatten() if isinstance(column, pa.ChunkedArray) else column.flatten()


def _numbers(array: pa.Array | pa.ChunkedArray, null: int) -> np.ndarray:
    return array.fill_null(null).to_numpy(zero_copy_only=False).astype("int64") if isinstance(array, pa.Array) else array.combine_chunks().fill_null(null).to_numpy(zero_copy_only=False).astype("int64")


_FAR, _NEAR = np.iinfo("int64").max, np.iinfo("int64").min


def _probe(refs: pa.Table, parents: pa.Table, keep_found: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows of ``refs`` to give out, the reason of each (index into REASONS, -1: there) and the parent found (-1: none)."""
    ids = refs["ref_id"].to_numpy()
    _, first = np.unique(ids, return_index=True)  # a repeated row counts once
    first.sort()
    refs = refs.take(pa.array(first))
    n = len(first)
    best = np.full(n, 3, "int8")  # 0 present, 1 late, 2 deleted, 3 missing
    at = np.full(n, -1, "int64")
    if parents.num_rows:
        codes = _flat(parents["p_code"]).to_numpy(zero_copy_only=False)
        keys, born, gone = _flat(parents["p_key"]), _numbers(_flat(parents["p_born"]), _NEAR), _numbers(_flat(parents["p_gone"]), _FAR)
        code, key = refs["code"].to_numpy(), refs["key"].combine_chunks()
        seen, timed = _numbers(refs["seen"], 0), ~np.asarray(refs["seen"].is_null())
        left, right = np.searchsorted(codes, code, "left"), np.searchsorted(codes, code, "right")
        step = 0
        while True:
            rows = np.flatnonzero(left + step < right)
            if not len(rows):
                break
            spot = left[rows] + step
            same = np.asarray(pa.compute.equal(keys.take(pa.array(spot)), key.take(pa.array(rows))))
            rows, spot = rows[same], spot[same]
            state = np.where(timed[rows] & (born[spot] > seen[rows]), 1, np.where(timed[rows] & (gone[spot] <= seen[rows]), 2, 0)).astype("int8")
            better = state < best[rows]
            best[rows[better]], at[rows[better]] = state[better], spot[better]
            step += 1
    reason = np.array([-1, 1, 2, 0], "int8")[best]
    out = np.arange(n) if keep_found else np.flatnonzero(reason >= 0)
    return first[out], reason[out], at[out]


def _prepare(refs: DataFrame, parents: DataFrame, payload: str | None, range_parents: int, block_rows: int) -> tuple[DataFrame, DataFrame]:
    """References with their block, and each block's arrays."""
    spark = refs.sparkSession
    n = parents.count()
    bits = min(MOST_RANGE_BITS, max(0, int(np.ceil(np.log2(max(1, n / range_parents))))))
    load = refs.groupBy(_range_of(F.col("code"), bits).alias("rng")).count().collect()  # at most 2 ** MOST_RANGE_BITS rows
    salts = {r["rng"]: max(1, -(-r["count"] // block_rows)) for r in load}
    start, table = 0, []
    for rng in sorted(salts):
        table.append((rng, start, salts[rng]))
        start += salts[rng]
    blocks = spark.createDataFrame(table, "rng int, start int, salts int")
    routed = refs.withColumn("rng", _range_of(F.col("code"), bits)).join(F.broadcast(blocks), "rng")
    routed = routed.withColumn("block", F.col("start") + F.pmod(F.xxhash64("ref_id", F.lit(11)), F.col("salts")).cast("int")).drop("rng", "start", "salts")
    ranges = _parent_ranges(parents, bits, payload).join(F.broadcast(blocks), "rng")
    ranges = ranges.withColumn("block", F.explode(F.sequence(F.col("start"), F.col("start") + F.col("salts") - 1))).drop("rng", "start", "salts")
    return routed, ranges


def keyed(df: DataFrame, ref_id: Column, key: Column, seen: Column | None = None) -> DataFrame:
    """References as (ref_id, key, code, seen in microseconds); rows without a key are no references."""
    when = F.unix_micros(seen.cast("timestamp")) if seen is not None else F.lit(None).cast("long")
    return df.select(ref_id.cast("long").alias("ref_id"), key.alias("key"), when.alias("seen")).filter(F.col("key").isNotNull() & F.col("ref_id").isNotNull()).withColumn("code", F.xxhash64("key"))


def parent_keys(df: DataFrame, key: Column, born: Column | None = None, gone: Column | None = None, **payload: Column) -> DataFrame:
    """Parents as (key, code, born, gone) and at most one payload column; null keys are dropped."""
    micros = lambda c: F.unix_micros(c.cast("timestamp")) if c is not None else F.lit(None).cast("long")
    out = df.select(key.alias("key"), micros(born).alias("born"), micros(gone).alias("gone"), *(c.alias(n) for n, c in payload.items()))
    return out.filter(F.col("key").isNotNull()).distinct().withColumn("code", F.xxhash64("key"))


def find_orphans(refs: DataFrame, parents: DataFrame, *, range_parents: int = RANGE_PARENTS, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(ref_id, reason, seen) of every reference in ``refs`` (see ``keyed``) that no row of ``parents`` answers.

    A reference is answered by a parent of its key that was born at or before ``seen`` and not gone at or before it.
    Where several parents share a key the most favourable counts. A null born means always, a null gone never, a
    null seen is answered by any parent. Repeated ref_ids count once. Null keys are no references; empty tables give
    an empty result (of references) or all references as missing (of parents).
    """
    routed, ranges = _prepare(refs, parents, None, range_parents, block_rows)

    def probe(left: pa.Table, right: pa.Table) -> pa.Table:
        rows, reason, _ = _probe(left, right, False)
        out = left.select(["ref_id", "seen"]).take(pa.array(rows))
        return pa.table({"ref_id": out["ref_id"], "reason": pa.array(np.array(REASONS)[reason] if len(reason) else np.array([], "U1"), pa.string()), "seen": out["seen"]})

    return routed.groupBy("block").cogroup(ranges.groupBy("block")).applyInArrow(probe, "ref_id long, reason string, seen long")


def resolve_keys(refs: DataFrame, parents: DataFrame, payload: str, *, range_parents: int = RANGE_PARENTS, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(ref_id, found) for every reference: the long ``payload`` of the parent that answers it, or null.

    The same routing and binary search as ``find_orphans``; times are not looked at.
    """
    routed, ranges = _prepare(refs.withColumn("seen", F.lit(None).cast("long")), parents, payload, range_parents, block_rows)

    def probe(left: pa.Table, right: pa.Table) -> pa.Table:
        rows, _, at = _probe(left, right, True)
        found = _flat(right["p_payload"]).to_numpy(zero_copy_only=False) if right.num_rows else np.zeros(1, "int64")
        value = found[np.maximum(at, 0)] if len(found) else np.zeros(len(at), "int64")
        return pa.table({"ref_id": left["ref_id"].take(pa.array(rows)), "found": pa.array(value.astype("int64"), pa.int64(), mask=at < 0)})

    return routed.groupBy("block").cogroup(ranges.groupBy("block")).applyInArrow(probe, "ref_id long, found long")


def orphan_report(found: DataFrame) -> DataFrame:
    """Misses per table, period and reason."""
    return found.groupBy("src", "period", "reason").agg(F.count("*").alias("n"))


def period(micros: Column) -> Column:
    """Year and month of a time in microseconds, as 2009-03."""
    return F.date_format(F.timestamp_micros(micros), "yyyy-MM")
