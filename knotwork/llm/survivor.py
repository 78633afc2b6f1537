"""One surviving record for each group of duplicates, field by field, by iterative truth discovery.

Every record with a real value in a field claims that value for its group; records that give the same value, but for
case, accents, signs and order, claim it together. A value is voted for by all sources that claim it, each with its
reliability, and by criteria (newest, most trusted, fullest record). A source is as reliable as the values it claims are
believed; criteria weigh as much as the values they point to are believed; and both are estimated in turn until they
settle. The record is chosen among those that claim the value with the highest support.

A record that no other of its group surpasses in any criterion is the best by definition, so an exact check follows: where
there is one, it wins whatever the votes say.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from knotwork.llm import bodies
from knotwork.runtime import lookup_join, small, staged

#: Rounds at most, and the change of any weight at which they end.
ROUNDS = 12
SETTLED = 1e-3
#: A criterion never weighs less than this.
LEAST_WEIGHT = 0.2
#: The reliability that a source starts from, counted as one claim of its own.
FIRST = 0.5

CRITERIA = ("newest", "trusted", "fullest")


def claims_of(records: DataFrame, trust: DataFrame, *, row: str = "concept_row", graph: str = "graph", key: str = "concept_key", source: str = "source", body: str = "body", updated: str = "updated_at") -> DataFrame:
    """(group_row, field, row, source, born, trust, size, value) of every claim in a group of at least two records.

    Groups are records of one graph with equal keys (``group_key``); a record delivered twice counts once. Sources
    without a trust have the lowest; so have claims without a time the oldest.
    """
    keyed = records.select(F.col(row).cast("long").alias("row"), F.col(graph).alias("graph"), bodies.group_key(F.col(key)).alias("key"), F.col(source).alias("source"), F.unix_micros(F.col(updated).cast("timestamp")).alias("born"))
    keyed = keyed.filter("row is not null and graph is not null and key is not null").groupBy("row").agg(F.min(F.struct("graph", "key", "source", "born")).alias("r")).select("row", "r.*")
    groups = keyed.groupBy("graph", "key").agg(F.min("row").alias("group_row"), F.count("*").alias("n")).filter("n > 1").select(F.col("graph").alias("g"), F.col("key").alias("k"), "group_row")
    members = lookup_join(keyed.withColumn("gk", F.to_json(F.array("graph", "key"))), groups.select(F.to_json(F.array("g", "k")).alias("hk"), "group_row"), "gk", "hk", "inner").select("row", "group_row", "source", "born")
    trusts = trust.groupBy(F.col("source").alias("ts")).agg(F.max("trust").alias("trust"))
    members = members.join(small(trusts), F.col("source") == F.col("ts"), "left").drop("ts")
    sizes = bodies.body_values(records, row=row, body=body).groupBy("row", "field").agg(F.max(F.struct("size", "value")).alias("v")).select("row", "field", "v.*")
    return members.join(sizes, "row").select("group_row", "field", "row", "source", F.coalesce("born", F.lit(-(2**62))).alias("born"), F.coalesce("trust", F.lit(-(2**31))).cast("long").alias("trust"), "size", "value")


def _with_votes(claims: DataFrame) -> DataFrame:
    top = claims.groupBy("group_row", "field").agg(F.max("born").alias("b"), F.max("trust").alias("t"), F.max("size").alias("s")).select(F.concat_ws("/", "group_row", "field").alias("tid"), "b", "t", "s")
    held = lookup_join(claims.withColumn("cid", F.concat_ws("/", "group_row", "field")), top, "cid", "tid", "inner")
    return held.select("group_row", "field", "row", "source", "born", "trust", "size", "value", (F.col("born") == F.col("b")).alias("newest"), (F.col("trust") == F.col("t")).alias("trusted"), (F.col("size") == F.col("s")).alias("fullest"))


def _valued(claimed: DataFrame, reliability: DataFrame | None, weights: dict[str, float]) -> DataFrame:
    """(gid, value, support, criteria) of every value: the reliabilities of its sources and the weights of the criteria that speak for one of its records."""
    rated = claimed.withColumn("rel", F.lit(FIRST)) if reliability is None else claimed.join(small(reliability), F.col("source").eqNullSafe(F.col("rs")), "left")
    valued = rated.groupBy("gid", "value").agg(F.sum("rel").alias("votes"), *(F.max(c).alias(c) for c in CRITERIA))
    support = F.col("votes")
    for c in CRITERIA:
        support = support + F.when(F.col(c), weights[c]).otherwise(0.0)
    return valued.select("gid", "value", support.alias("support"), *CRITERIA)


def discover(claims: DataFrame, *, rounds: int = ROUNDS, check: bool = True) -> tuple[DataFrame, dict[str, float], DataFrame]:
    """(winners, weights of the criteria, reliability of the sources).

    ``winners``: group_row, field, winner_row, support of its value, sources that claim the field. Among records that
    claim the value of the highest support the newest, most trusted, fullest one wins, and then the smallest row; values
    of equal support are parted alike. With ``check`` a record that is not surpassed in any criterion wins first.
    Groups of any size are only ever aggregated.
    """
    votes = staged(_with_votes(claims).withColumn("gid", F.concat_ws("/", "group_row", "field")))
    claimed = staged(votes.groupBy("gid", "value", "source").agg(*(F.max(c).alias(c) for c in CRITERIA)))
    weights = dict.fromkeys(CRITERIA, 1.0)
    reliability: DataFrame | None = None
    for _ in range(rounds):
        valued = staged(_valued(claimed, reliability, weights).withColumn("power", F.pow("support", F.lit(4.0))))
        sums = valued.groupBy(F.col("gid").alias("tid")).agg(F.sum("power").alias("all"))
        believed = staged(lookup_join(valued, sums, "gid", "tid", "inner").select(F.col("gid").alias("bg"), F.col("value").alias("bv"), (F.col("power") / F.when(F.col("all") > 0, F.col("all")).otherwise(1.0)).alias("belief"), *CRITERIA))
        one = believed.agg(F.sum("belief").alias("all"), *(F.sum(F.when(F.col(c), F.col("belief")).otherwise(0.0)).alias(c) for c in CRITERIA)).first()
        new = {c: max(LEAST_WEIGHT, (one[c] or 0.0) / one["all"]) if one["all"] else 1.0 for c in CRITERIA}
        rated = claimed.select("gid", "value", "source").join(believed.select("bg", "bv", "belief"), (F.col("gid") == F.col("bg")) & (F.col("value") == F.col("bv")))
        rated = staged(rated.groupBy(F.col("source").alias("rs")).agg(((F.sum("belief") + FIRST) / (F.count("*") + 1)).alias("rel")))
        change = rated.select(F.col("rs").alias("s"), F.col("rel").alias("now")).join(reliability, F.col("s").eqNullSafe(F.col("rs")), "left").agg(F.max(F.abs(F.col("now") - F.coalesce("rel", F.lit(FIRST))))).first()[0] if reliability is not None else 1.0
        moved = max(change or 0.0, *(abs(new[c] - weights[c]) for c in CRITERIA))
        weights, reliability = new, rated
        if moved < SETTLED:
            break
    final = _valued(claimed, reliability, weights).select(F.col("gid").alias("fg"), F.col("value").alias("fv"), "support")
    held = votes.join(final, (F.col("gid") == F.col("fg")) & (F.col("value") == F.col("fv")))
    first = (F.col("newest") & F.col("trusted") & F.col("fullest")).alias("first") if check else F.lit(False).alias("first")
    best = F.max_by(F.struct("row", "support"), F.struct(first, "support", "born", "trust", "size", -F.col("row")))
    sources = claimed.select("gid", "source").distinct().groupBy(F.col("gid").alias("sg")).agg(F.count("*").alias("sources"))
    winners = held.groupBy("gid", "group_row", "field").agg(best.alias("w"))
    winners = winners.join(sources, F.col("gid") == F.col("sg")).select("group_row", "field", F.col("w.row").alias("winner_row"), F.col("w.support").alias("support"), "sources")
    return winners, weights, reliability


def survivors(records: DataFrame, trust: DataFrame) -> DataFrame:
    """(group_row, field, winner_row): the record from which each field of a group's surviving record is taken.

    Null bodies, invalid JSON and values that say nothing claim nothing; a field that nobody claims has no row. Empty
    tables give an empty result.
    """
    winners, _, _ = discover(claims_of(records, trust))
    return winners.select("group_row", "field", "winner_row")
