"""Mixing sources to target weights.

Sizes are summed by source and hash bucket. The bucket in which a source's budget is reached is refined level by level
until few records are left in it; all records of the buckets before it are under the threshold and a plain filter takes
them. The records behind the threshold are gone through in the order of their hash, and every one that still fits is
taken, so a large record at the boundary does not keep the smaller ones behind it out. Nothing is sorted but those few.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from knotwork.llm.bpe import DEFAULT_VOCABULARY
from knotwork.llm.encoding import token_counts
from knotwork.runtime import lookup_join, small, staged

#: Bits of the hash that one level looks at, and its levels (60 bits in all).
LEVEL_BITS = 10
LEVELS = 6
#: Most hash values of a source behind its threshold that are gone through one by one to fill what is left of its budget.
TAIL = 10_000


def source_key(col: Column) -> Column:
    """Sources are equal but for case and outer blanks; blank ones are null."""
    key = F.lower(F.trim(col))
    return F.when(key != "", key)


def plan_budgets(available: DataFrame, targets: DataFrame, total: float | None = None) -> DataFrame:
    """(source, target_share, max_repeats, available, wanted, rounds, rest): what each source has to give.

    ``available`` has source and tokens, ``targets`` source, target_share and max_repeats. Shares are taken over the
    targets with records, and scaled to 1. Without ``total`` it is the largest size at which every share is met within
    the repeats. With a larger ``total`` sources at their limit give all they may, and the rest is shared by the others
    in proportion to their targets. ``rounds`` copies of all records of a source and ``rest`` more tokens make ``wanted``.
    """
    given = targets.filter("target_share > 0 and max_repeats > 0").select(source_key(F.col("source")).alias("source"), "target_share", "max_repeats").filter("source is not null")
    merged = given.groupBy("source").agg(F.sum("target_share").alias("target_share"), F.max("max_repeats").alias("max_repeats"))
    have = available.select(F.col("source").alias("have"), F.col("tokens").alias("available"))
    table = staged(merged.join(have, F.col("source") == F.col("have"), "left").select("source", "target_share", "max_repeats", F.coalesce("available", F.lit(0)).cast("long").alias("available")))
    limit = F.col("available") * F.col("max_repeats")
    open_ = table.filter("available > 0")
    if total is None:
        level = open_.agg(F.min(limit / F.col("target_share"))).first()[0] or 0.0
    else:
        level, before = 0.0, -1.0
        while level > before:  # tokens for a share of 1; sources at their limit leave theirs to the others
            full = limit <= F.col("target_share") * F.lit(level)
            one = open_.agg(F.sum(F.when(full, limit).otherwise(0)).alias("fixed"), F.sum(F.when(full, 0.0).otherwise(F.col("target_share"))).alias("shares")).first()
            before, level = level, max(level, (total - one["fixed"]) / one["shares"]) if one["shares"] else level
    planned = table.withColumn("wanted", F.when(F.col("available") > 0, F.least(limit.cast("double"), F.col("target_share") * F.lit(float(level)))).otherwise(0.0))
    planned = planned.withColumn("rounds", F.when(F.col("available") > 0, F.least(F.floor(F.col("wanted") / F.col("available") + 1e-9), F.col("max_repeats").cast("long"))).otherwise(0).cast("int"))
    rest = F.when(F.col("rounds") < F.col("max_repeats"), F.col("wanted") - F.col("rounds") * F.col("available")).otherwise(0.0)
    return staged(planned.withColumn("rest", F.when(rest >= 1, rest).otherwise(0.0)))


def _pass(sized: DataFrame, state: DataFrame, tail: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(intervals, taken, state): what one pass takes of the records with a hash from ``low`` on and at most ``most`` tokens, and what is left to do."""
    fits = staged(lookup_join(sized, state, "source", "s", "inner").filter("h >= low and tokens <= most"))
    rows, ends = fits.withColumn("left", F.col("most")), []
    for level in range(LEVELS):
        shift = (LEVELS - 1 - level) * LEVEL_BITS
        # at most 2 ** LEVEL_BITS buckets a source
        sums = rows.groupBy("source", F.shiftright("h", shift).alias("bucket")).agg(F.sum("tokens").alias("tokens"), F.countDistinct("h").alias("n"), *(F.first(c).alias(c) for c in ("left", "low", "most")))
        upto = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)
        sums = sums.withColumn("upto", F.sum("tokens").over(upto)).withColumn("number", F.sum("n").over(upto))
        over = F.when(F.col("upto") > F.col("left"), F.col("bucket"))
        sums = staged(sums.withColumn("edge", F.min(over).over(Window.partitionBy("source"))))
        if not level:  # all that fit are taken
            ends.append(sums.filter("edge is null").groupBy("source").agg(F.first("low").alias("low"), F.first("most").alias("most"), F.lit(1 << LEVELS * LEVEL_BITS).alias("threshold"), F.lit(1 << LEVELS * LEVEL_BITS).alias("end"), F.lit(0.0).alias("rest")))
        at = sums.filter("bucket = edge").select(F.col("source").alias("es"), F.col("edge").alias("at"), (F.col("left") - F.col("upto") + F.col("tokens")).alias("rest"), F.col("n").alias("here"), (F.col("number") - F.col("n")).alias("ahead"))
        near = sums.join(at, F.col("source") == F.col("es")).filter((F.col("bucket") >= F.col("at")) & ((F.col("bucket") == F.col("at")) | (F.col("number") - F.col("ahead") <= tail)))
        found = staged(near.groupBy("source").agg(*(F.first(c).alias(c) for c in ("at", "rest", "here", "low", "most")), F.max("bucket").alias("last")))
        closed = (F.col("here") <= tail) | F.lit(shift == 0)
        ends.append(found.filter(closed).select("source", "low", "most", F.shiftleft("at", shift).alias("threshold"), F.shiftleft(F.col("last") + 1, shift).alias("end"), "rest"))
        more = found.filter(~closed).select(F.col("source").alias("ms"), "at", "rest")
        if more.isEmpty():
            break
        rows = staged(lookup_join(rows.drop("left"), more, "source", "ms", "inner").filter(F.shiftright("h", shift) == F.col("at")).withColumn("left", F.col("rest")).select(*fits.columns, "left"))
    every = ends[0]
    for end in ends[1:]:
        every = every.unionByName(end)
    every = staged(every)

    def fill(key: tuple, behind: pd.DataFrame) -> pd.DataFrame:
        left, taken = float(behind["rest"].iloc[0]), []
        for h, tokens in behind.sort_values("h")[["h", "tokens"]].itertuples(index=False):
            if tokens <= left:
                left -= tokens
                taken.append((key[0], h, left))
        return pd.DataFrame(taken, columns=["source", "h", "left"])

    open_ = every.select(F.col("source").alias("os"), "threshold", "end", F.col("rest"))
    behind = lookup_join(fits, open_.filter("end > threshold"), "source", "os", "inner").filter("h >= threshold and h < end").groupBy("source", "h").agg(F.sum("tokens").alias("tokens"), F.first("rest").alias("rest"))
    taken = staged(behind.groupBy("source").applyInPandas(fill, "source string, h long, left double"))
    after = taken.groupBy(F.col("source").alias("ts")).agg(F.min("left").alias("left"))
    left = F.coalesce("left", "rest")
    state = staged(open_.filter("end > threshold").join(after, F.col("os") == F.col("ts"), "left").filter(left >= 1).select(F.col("os").alias("s"), F.col("end").alias("low"), left.alias("most")))
    return every.select("source", "low", F.col("threshold").alias("high"), "most"), taken.select("source", "h"), state


def _thresholds(sized: DataFrame, plan: DataFrame, tail: int = TAIL) -> tuple[DataFrame, DataFrame]:
    """(intervals, taken) of the sources with a rest: records of ``source`` with a hash from ``low`` to under ``high`` and at most ``most`` tokens, and single hash values.

    The intervals of a source do not overlap. Usually it has one; it has another where the records behind its threshold
    did not fill what was left.
    """
    state = plan.filter("rest > 0").select(F.col("source").alias("s"), F.lit(0).cast("long").alias("low"), F.col("rest").alias("most"))
    intervals, taken = [], []
    while True:
        some, single, state = _pass(sized, state, tail)
        intervals.append(some)
        taken.append(single)
        if state.isEmpty():
            break
    for more in intervals[1:]:
        intervals[0] = intervals[0].unionByName(more)
    for more in taken[1:]:
        taken[0] = taken[0].unionByName(more)
    return intervals[0], taken[0]


def mix_sources(df: DataFrame, doc_id: Column, text: Column, source: Column, targets: DataFrame, *, total_tokens: float | None = None, vocabulary: str = DEFAULT_VOCABULARY) -> tuple[DataFrame, DataFrame]:
    """(chosen, report): the records to use with their number of copies, and the shares that come of it.

    ``targets`` has source, target_share and max_repeats; sources are compared but for case and outer blanks.
    Records without a source, or of one without a target, are not used; targets without records are reported with 0.
    Null and empty texts have size 0 and go with the hash. Copies of a record id share its hash and are chosen
    together. A source misses its budget by less than the smallest of its records behind the threshold that are not taken. A
    larger budget has the larger threshold; only the records that fill the gap behind a threshold may differ.
    ``chosen``: doc_id, source, tokens, copies. ``report``: source, target_share, max_repeats, available and used
    tokens, records, actual_share. See ``plan_budgets`` for ``total_tokens``.
    """
    h = F.shiftrightunsigned(F.xxhash64(doc_id.cast("long"), F.lit(23)), 4).alias("h")
    sized = staged(token_counts(df, text, doc_id.cast("long").alias("doc_id"), source_key(source).alias("source"), h, vocabulary=vocabulary))
    sized = sized.filter("source is not null")
    plan = plan_budgets(sized.groupBy("source").agg(F.sum("tokens").alias("tokens")), targets, total_tokens)
    intervals, taken = _thresholds(sized, plan)
    ranges = intervals.groupBy(F.col("source").alias("rs")).agg(F.collect_list(F.struct("low", "high", "most")).alias("ranges"))
    full = plan.join(ranges, F.col("source") == F.col("rs"), "left").select(F.col("source").alias("s"), "rounds", "ranges")
    extra = small(taken.select(F.col("source").alias("ts"), F.col("h").alias("th"), F.lit(1).alias("extra")))
    planned = lookup_join(sized, full, "source", "s", "inner").join(extra, (F.col("source") == F.col("ts")) & (F.col("h") == F.col("th")), "left")
    under = F.exists("ranges", lambda r: (F.col("h") >= r["low"]) & (F.col("h") < r["high"]) & (F.col("tokens") <= r["most"]))
    copies = F.col("rounds") + F.when(under | F.col("extra").isNotNull(), 1).otherwise(0)
    chosen = staged(planned.withColumn("copies", copies.cast("int")).filter("copies > 0").select("doc_id", "source", "tokens", "copies"))
    used = chosen.groupBy(F.col("source").alias("us")).agg(F.sum(F.col("tokens") * F.col("copies")).alias("used"), F.count("*").alias("records"), F.max("copies").alias("most_copies"))
    all_used = chosen.agg(F.sum(F.col("tokens") * F.col("copies")).alias("total"))
    report = plan.join(used, F.col("source") == F.col("us"), "left").join(F.broadcast(all_used), how="left").select(
        "source", "target_share", "max_repeats", "available", F.coalesce("used", F.lit(0)).alias("used"), F.coalesce("records", F.lit(0)).alias("records"), F.coalesce("most_copies", F.lit(0)).alias("most_copies"), (F.coalesce("used", F.lit(0)) / F.col("total")).alias("actual_share")
    )
    return chosen, report
