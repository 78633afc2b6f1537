"""Whole jobs: from page sources to the concept graph, and from a dump to the files of a link index."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from knotwork.operators import concepts as C
from knotwork.operators import extraction, graph
from knotwork.operators import links as L
from knotwork.runtime import staged
from knotwork.sources import readers, sinks


def build_graph(pages: DataFrame, *, rules: str | None = None) -> dict[str, DataFrame]:
    """redirects, outlinks, distances, relations, aliases and about of pages (title, text).

    Pages are parsed once; emitted names are brought to the ends of their redirects, relations without a distance get that
    of the link graph (255 where it has none), and of relations of one pair and category the nearest is kept.
    """
    emitted = staged(extraction.extract_relations(pages, F.col("title"), F.col("text"), **({"rules": rules} if rules else {})))
    redirects = emitted.filter("kind = 'redirect'").select(F.col("name").alias("alias"), F.col("page").alias("target"))
    ends = staged(graph.ultimate_redirects(redirects).select("alias", "target"))
    out = emitted.filter("kind = 'outlink'").select(F.col("page").alias("src"), F.col("target").alias("dst"))
    out = C.canonicalize(out, ends, "src", "dst").filter("src <> dst").distinct()
    links = staged(out.select("src", "dst", F.lit(1).alias("count"), F.lit(True).alias("in_text")))
    distances = staged(L.edge_distances(links).select("src", "dst", "distance"))
    rel = emitted.filter("kind = 'relation'").select(F.col("page").alias("src"), F.col("target").alias("dst"), "category", "subcategory", "snippet", "distance", F.lit(0).alias("edge_distance"))
    rel = C.merge_relations(C.fill_distances(C.canonicalize(rel, ends, "src", "dst"), distances))
    named = emitted.filter("kind in ('redirect', 'alias')").select(F.col("page").alias("src"), F.col("name").alias("alias"), "distance")
    about = emitted.filter("kind in ('common_name', 'description', 'site', 'category')").select("page", "kind", "name", "target")
    return {"redirects": ends, "outlinks": links, "distances": distances, "relations": rel, "aliases": C.merge_aliases(C.canonicalize(named, ends, "src")), "about": about}


def category_sets(about: DataFrame) -> DataFrame:
    """(page, categories): the sorted categories of every page, joined by '|'."""
    return about.filter("kind = 'category' and name is not null").groupBy("page").agg(F.array_join(F.sort_array(F.collect_set(F.trim(F.replace("name", F.lit("|"), F.lit(""))))), "|").alias("categories"))


def build_index(spark: SparkSession, dump: str, out: str, *, neighbors: int = 10) -> None:
    """Pages, redirects, links, distances, neighbours, topics and link counts of an XML dump, as files under ``out``."""
    pages = readers.read_dump(spark, dump)
    flat = staged(extraction.flat_links(pages, F.col("title"), F.col("text")))
    redirects = flat.filter("redirect is not null").select(F.col("title").alias("alias"), F.col("redirect").alias("target"))
    articles = flat.filter("redirect is null")
    from knotwork.functions.titles import looks_like_entity

    dim = articles.select(F.col("title").alias("id"), "ambiguous", looks_like_entity(F.col("title")).alias("entity"))
    ends = graph.resolved_redirects(redirects, dim)
    aliases = dim.select(F.col("id").alias("alias"), F.col("id").alias("canonical")).unionByName(ends.select("alias", F.col("target").alias("canonical"))).dropDuplicates(["alias"])
    raw = articles.select(F.col("title").alias("src"), F.explode("outlinks").alias("o")).select("src", F.col("o.name").alias("target"), F.col("o.count").alias("count"), F.col("o.in_text").alias("in_text"))
    links = staged(L.resolve_links(raw, aliases))
    sinks.write_pages_index(dim.withColumn("title", F.col("id")).withColumn("id", F.abs(F.xxhash64("title"))), f"{out}/pages")
    sinks.write_redirects_index(ends, f"{out}/redirects")
    sinks.write_links(links, f"{out}/links")
    L.edge_distances(links).select("src", "dst", "distance").write.mode("overwrite").parquet(f"{out}/distances")
    L.bidi_edges(links, dim).write.mode("overwrite").parquet(f"{out}/bidi")
    L.top_neighbors(links, dim, neighbors).write.mode("overwrite").parquet(f"{out}/neighbors")
    sinks.write_topics(L.priority_topics(dim, links), f"{out}/topics")
    sinks.write_link_counts(L.link_counts(dim, links), f"{out}/link_counts")
