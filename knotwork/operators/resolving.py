"""Concept resolution: which concept each of a request's texts means, by how its neighbours are named in the same request."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Neighbours kept of a concept.
NEIGHBOR_LIMIT = 500
#: Smallest neighbour distance of a concept without overlap.
NO_NEIGHBOR = 9999999


def nearest(neighbors: DataFrame, limit: int = NEIGHBOR_LIMIT) -> DataFrame:
    """The ``limit`` nearest neighbours of each concept (canonical, neighbor, quality)."""
    w = Window.partitionBy("canonical").orderBy("quality", "neighbor")
    return neighbors.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= limit)


def resolve_concepts(requests: DataFrame, aliases: DataFrame, neighbors: DataFrame) -> DataFrame:
    """(request, text, canonical, score) of every text that can be told.

    ``requests``: request, text. ``aliases``: alias, canonical, quality. ``neighbors``: canonical, neighbor, quality. A
    concept scores 100, and 100 more for every neighbour that another text of the request may mean, less the distances of
    these and of the alias. The best concept is accepted by its lead over the second and by the overlap of both; a
    second with a score under 0 counts as none. Ties go to the smaller canonical. Repeated rows count once.
    """
    cands = requests.select("request", "text").distinct().join(aliases.groupBy("alias", "canonical").agg(F.min("quality").alias("aq")), F.col("text") == F.col("alias")).select("request", "text", "canonical", "aq")
    kept = nearest(neighbors)
    sizes = kept.groupBy("canonical").agg(F.count("*").alias("n"))
    # neighbours that are another meaning of the same text do not count, so a request of one text has none
    several = requests.groupBy("request").agg(F.count_distinct("text").alias("texts")).filter("texts > 1")
    meant = cands.join(several, "request", "left_semi").groupBy("request", "canonical").agg(F.collect_set("text").alias("texts"))
    known = kept.select("canonical", "neighbor", F.col("quality").alias("nq")).join(meant.select(F.col("canonical").alias("neighbor")).distinct(), "neighbor", "left_semi")
    near = meant.join(known, "canonical").join(meant.select("request", F.col("canonical").alias("neighbor"), F.col("texts").alias("others")), ["request", "neighbor"])
    overlap = near.filter(~F.arrays_overlap("texts", "others")).groupBy("request", "canonical").agg(F.count("*").alias("ov"), F.sum("nq").alias("far"), F.min("nq").alias("closest"))
    scored = cands.join(overlap, ["request", "canonical"], "left").select("request", "text", "canonical", F.coalesce("ov", F.lit(0)).alias("ov"), F.coalesce("closest", F.lit(NO_NEIGHBOR)).alias("closest"), ((1 + F.coalesce("ov", F.lit(0))) * 100 - F.coalesce("far", F.lit(0)) - F.col("aq")).alias("score"))
    w = Window.partitionBy("request", "text").orderBy(F.desc("score"), "canonical")
    ranked = scored.withColumn("rank", F.row_number().over(w)).withColumn("s2", F.lead("score").over(w)).withColumn("o2", F.lead("ov").over(w)).filter("rank = 1")
    real = F.col("s2") > 0
    s2, o2 = F.when(real, F.col("s2")).otherwise(0), F.when(real, F.col("o2")).otherwise(0)
    d = F.col("score") - s2
    lead = (d > 75) | ((o2 == 0) & (F.col("ov") > 0) & (d > 50)) | ((F.col("ov") >= o2) & (F.col("score") > 190) & (o2 < 3))
    sure = (F.col("score") > 150) | (F.col("closest") < 50) | ((o2 == 0) & (d >= 50) & (F.coalesce("n", F.lit(0)) == NEIGHBOR_LIMIT))
    return ranked.join(sizes, "canonical", "left").filter(lead & sure).select("request", "text", "canonical", "score")
