"""Queries p1, p3, p4 and p6 over the project tables, with SQL for the same results."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from knotwork.functions.titles import TITLE_KEY_SQL, title_key
from knotwork.operators import hierarchy, keycounts, orphans, shredding
from knotwork.sources.tables import table


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    """References of wiki_links and graph_edges to pages that are not there at seen_at."""
    pages = table(spark, d, "page_nodes", "page_id", "title", "created_at", "deleted_at")
    links = table(spark, d, "wiki_links", "link_id", "target", "seen_at")
    edges = table(spark, d, "graph_edges", "edge_id", "end_page", "seen_at")
    born, gone = F.col("created_at"), F.col("deleted_at")
    by_title = orphans.find_orphans(orphans.keyed(links, F.col("link_id"), title_key(F.col("target")), F.col("seen_at")), orphans.parent_keys(pages, title_key(F.col("title")), born, gone))
    by_id = orphans.find_orphans(orphans.keyed(edges, F.col("edge_id"), F.col("end_page"), F.col("seen_at")), orphans.parent_keys(pages, F.col("page_id"), born, gone))
    both = by_title.withColumn("src", F.lit("wiki_links")).unionByName(by_id.withColumn("src", F.lit("graph_edges")))
    return both.select("src", "ref_id", "reason", orphans.period(F.col("seen")).alias("period"))


def p1_report(spark: SparkSession, d: str) -> DataFrame:
    """Orphans per table, month and reason."""
    return orphans.orphan_report(p1_found(spark, d))


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    """Children of edge descriptors and concept bodies with their paths."""
    edges = shredding.shred(table(spark, d, "graph_edges", "edge_id", "descriptors"), F.col("edge_id"), F.col("descriptors"), shredding.edge_descriptors)
    docs = shredding.shred(table(spark, d, "concept_docs", "concept_row", "body"), F.col("concept_row"), F.col("body"), shredding.concept_bodies)
    both = edges.withColumn("src", F.lit("graph_edges")).unionByName(docs.withColumn("src", F.lit("concept_docs")))
    return both.select("src", "row_id", "child", "path")


def p3_descriptors(spark: SparkSession, d: str) -> DataFrame:
    """The flat descriptor table of graph_edges: one row a descriptor, scalar members as columns."""
    edges = shredding.shred(table(spark, d, "graph_edges", "edge_id", "descriptors"), F.col("edge_id"), F.col("descriptors"), shredding.edge_descriptors)
    return shredding.entity_table(edges, "descriptor", ["source", "type_category_mask", "type", "weight"])


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    """Pages whose stated num_edges or inlinks is not what graph_edges holds."""
    pages = table(spark, d, "page_nodes", "page_id", "num_edges", "inlinks")
    edges = table(spark, d, "graph_edges", "edge_id", "begin_page", "end_page")
    counts = keycounts.count_keys(edges, "edge_id", ["begin_page", "end_page"], pages, "page_id")
    measure = F.when(F.col("measure") == "begin_page", "num_edges").otherwise("inlinks")
    stated = pages.dropDuplicates(["page_id"]).select("page_id", F.explode(F.create_map(F.lit("num_edges"), F.col("num_edges"), F.lit("inlinks"), F.col("inlinks"))).alias("measure", "stated")).filter("stated is not null")
    return counts.select(F.col("key").alias("page_id"), measure.alias("measure"), "n").join(stated, ["page_id", "measure"]).filter(F.col("n") != F.col("stated")).select("page_id", "measure")


def p6_links(spark: SparkSession, d: str) -> DataFrame:
    """(node, parent) of every page of raw_pages, parent by the title that its redirect means."""
    pages = table(spark, d, "raw_pages", "page_id", "title", "redirect")
    refs = orphans.keyed(pages, F.col("page_id"), title_key(F.col("redirect")))
    found = orphans.resolve_keys(refs, orphans.parent_keys(pages, title_key(F.col("title")), page_id=F.col("page_id")), "page_id")
    nodes = pages.select(F.col("page_id").alias("node")).distinct()
    return nodes.join(found.select(F.col("ref_id").alias("node"), F.col("found").alias("parent")), "node", "left")


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    """Root and depth of every page with a redirect to a page; -1 and -1 in rings and on the way into one."""
    trees = hierarchy.resolve_hierarchy(p6_links(spark, d), with_paths=False)
    return trees.filter("root is null or depth > 0").select(F.col("node").alias("page_id"), F.coalesce("root", F.lit(-1)).cast("long").alias("root_id"), F.coalesce("depth", F.lit(-1)).cast("int").alias("depth"))


def p6_paths(spark: SparkSession, d: str) -> DataFrame:
    """Full path of every page as text, from the page to its root."""
    trees = hierarchy.resolve_hierarchy(p6_links(spark, d))
    return trees.select(F.col("node").alias("page_id"), F.array_join(F.col("path").cast("array<string>"), ">").alias("path"))


def p6_descendants(spark: SparkSession, d: str) -> DataFrame:
    """All descendants of every page that has some."""
    return hierarchy.descendants(hierarchy.resolve_hierarchy(p6_links(spark, d)))


_PARENTS = f"SELECT DISTINCT page_id, {TITLE_KEY_SQL.format(c='title')} AS k, created_at, deleted_at FROM page_nodes"
_P1 = f"""
WITH p AS ({_PARENTS}),
l AS (SELECT DISTINCT link_id AS ref_id, {TITLE_KEY_SQL.format(c='target')} AS k, seen_at FROM wiki_links),
e AS (SELECT DISTINCT edge_id AS ref_id, end_page AS k, seen_at FROM graph_edges),
j AS (SELECT 'wiki_links' AS src, l.ref_id, l.seen_at, p.page_id, p.created_at, p.deleted_at FROM l LEFT JOIN p ON l.k = p.k WHERE l.k IS NOT NULL
 UNION ALL SELECT 'graph_edges', e.ref_id, e.seen_at, p.page_id, p.created_at, p.deleted_at FROM e LEFT JOIN p ON e.k = p.page_id WHERE e.k IS NOT NULL)
SELECT src, ref_id, CASE WHEN page_id IS NULL THEN 'missing' WHEN created_at > seen_at THEN 'late' ELSE 'deleted' END AS reason, strftime(seen_at, '%Y-%m') AS period
FROM j WHERE page_id IS NULL OR created_at > seen_at OR deleted_at <= seen_at"""

_LINKS = f"""pg AS (SELECT DISTINCT page_id, {TITLE_KEY_SQL.format(c='title')} AS k, {TITLE_KEY_SQL.format(c='redirect')} AS r FROM raw_pages),
up AS (SELECT a.page_id AS node, b.page_id AS parent FROM pg a JOIN pg b ON a.r = b.k)"""
_WALK = f"""{_LINKS},
w AS (SELECT node, parent AS cur, 1 AS depth, [node] AS way FROM up
 UNION ALL SELECT w.node, up.parent, w.depth + 1, list_append(w.way, w.cur) FROM w JOIN up ON w.cur = up.node WHERE NOT list_contains(w.way, w.cur)),
fin AS (SELECT node, cur AS root, depth, way FROM w WHERE cur NOT IN (SELECT node FROM up))"""

SQL = {
    "p1_found": _P1,
    "p1_report": f"SELECT src, period, reason, count(*) AS n FROM ({_P1}) GROUP BY ALL",
    "p4_found": """
WITH e AS (SELECT DISTINCT edge_id, begin_page, end_page FROM graph_edges), p AS (SELECT DISTINCT page_id, num_edges, inlinks FROM page_nodes),
b AS (SELECT begin_page AS k, count(*) AS n FROM e GROUP BY 1), t AS (SELECT end_page AS k, count(*) AS n FROM e GROUP BY 1)
SELECT page_id, 'num_edges' AS measure FROM p LEFT JOIN b ON k = page_id WHERE num_edges <> coalesce(n, 0)
UNION ALL SELECT page_id, 'inlinks' FROM p LEFT JOIN t ON k = page_id WHERE inlinks <> coalesce(n, 0)""",
    "p6_found": f"""
WITH RECURSIVE {_WALK}
SELECT up.node AS page_id, coalesce(root, -1) AS root_id, CAST(coalesce(depth, -1) AS INTEGER) AS depth FROM up LEFT JOIN fin ON up.node = fin.node""",
    "p6_paths": f"""
WITH RECURSIVE {_WALK}
SELECT pg.page_id, CASE WHEN up.node IS NULL THEN CAST(pg.page_id AS VARCHAR) WHEN fin.node IS NOT NULL THEN array_to_string(list_append(way, root), '>') END AS path
FROM pg LEFT JOIN up ON up.node = pg.page_id LEFT JOIN fin ON fin.node = pg.page_id""",
    "p6_descendants": f"""
WITH RECURSIVE {_WALK}
SELECT CAST(x.ancestor AS BIGINT) AS ancestor, node AS descendant, CAST(x.distance AS INTEGER) AS distance FROM
 (SELECT node, unnest(list_append(way[2:], root)) AS ancestor, unnest(range(1, len(way) + 1)) AS distance FROM fin) x""",
}

QUERIES = {f.__name__: f for f in (p1_found, p1_report, p3_found, p3_descriptors, p4_found, p6_found, p6_paths, p6_descendants)}
