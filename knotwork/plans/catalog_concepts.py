"""Catalogue queries on concept documents and triples, with SQL for the same results."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from knotwork.functions.titles import TITLE_KEY_SQL
from knotwork.operators import concepts as C
from knotwork.operators import merging as M
from knotwork.plans import catalog_graph as CG
from knotwork.plans import catalog_links as CL
from knotwork.sources.concepts import parse_concepts
from knotwork.sources.tables import table


def concepts(spark: SparkSession, d: str) -> DataFrame:
    """All records with valid bodies, each once."""
    return parse_concepts(table(spark, d, "concept_docs", "concept_row", "graph", "concept_key", "source", "body", "updated_at").distinct()).drop("body")


def latest(spark: SparkSession, d: str) -> DataFrame:
    """The latest record of every key of a graph (a key-value table: the last put wins)."""
    c = concepts(spark, d).withColumnRenamed("concept_key", "key")
    fields = [f for f in c.columns if f not in ("graph", "key")]
    last = c.groupBy("graph", "key").agg(F.max_by(F.struct(*fields), F.struct("updated_at", "concept_row")).alias("r"))
    return last.select("graph", "key", "r.*")


def alias_to_canonicals(spark: SparkSession, d: str) -> DataFrame:
    """Concepts of every name and alias."""
    return C.alias_to_canonicals(concepts(spark, d))


def default_aliases(spark: SparkSession, d: str) -> DataFrame:
    """Aliases with their lower case."""
    return C.default_aliases(concepts(spark, d))


def concept_dict(spark: SparkSession, d: str) -> DataFrame:
    """Keys of every name, home page, blog and alias."""
    return C.concept_dict(concepts(spark, d), "directory")


def identifications(spark: SparkSession, d: str) -> DataFrame:
    """Sites and names that identify concepts."""
    return C.identifications(concepts(spark, d).drop("concept_row")).distinct()


def concept_urls(spark: SparkSession, d: str) -> DataFrame:
    """Names and addresses of concepts."""
    return C.concept_urls(concepts(spark, d))


def snippet_table(spark: SparkSession, d: str) -> DataFrame:
    """Snippets by pair and category."""
    return C.snippet_table(C.relations_of(concepts(spark, d)))


def concept_neighbors(spark: SparkSession, d: str) -> DataFrame:
    """Edges of every concept as text."""
    return C.concept_neighbors(concepts(spark, d))


def concept_merge(spark: SparkSession, d: str) -> DataFrame:
    """Relations merged by pair and category: line items as relations of orders' customers and parts."""
    li = table(spark, d, "lineitem", "l_orderkey", "l_partkey", "l_returnflag", "l_linestatus", "l_quantity", "l_shipdate")
    r = li.join(table(spark, d, "orders", "o_orderkey", "o_custkey"), F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.concat(F.lit("C"), "o_custkey").alias("src"), F.concat(F.lit("P"), "l_partkey").alias("dst"), F.when(F.col("l_returnflag") == "N", "UNCLASSIFIED").otherwise(F.col("l_returnflag")).alias("category"),
        F.col("l_linestatus").alias("subcategory"), F.concat(F.lit("order "), F.col("l_orderkey").cast("string")).alias("snippet"), F.col("l_quantity").cast("int").alias("distance"),
    )
    return C.merge_relations(r)


def canonicalize(spark: SparkSession, d: str) -> DataFrame:
    """Edge names of concepts by the ends of their redirects."""
    rel = C.relations_of(concepts(spark, d)).select("src", F.concat(F.lower(F.substring("dst", 1, 1)), F.substring("dst", 2, 10**6)).alias("dst"), "category")
    return C.canonicalize(rel, CG.redirect_closure(spark, d), "dst")


def fill_distances(spark: SparkSession, d: str) -> DataFrame:
    """Links whose distance is looked up where the link stands in no text."""
    lk = CL.links(spark, d).select("src", "dst", F.when(F.col("in_text"), F.col("count") * 10).otherwise(-1).alias("distance"), F.lit(0).alias("edge_distance"))
    back = CL.bidi_edges(spark, d)
    return C.fill_distances(lk, back)


def kv_diff(spark: SparkSession, d: str) -> DataFrame:
    """Common names of the two graphs by key."""
    kv = lambda g: latest(spark, d).filter(F.col("graph") == g).select("key", F.col("common_name").alias("value"))
    return C.kv_diff(kv("base"), kv("add"))


def _sides(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    return (latest(spark, d).filter("graph = 'base'"), latest(spark, d).filter("graph = 'add'"))


def graph_merge_candidates(spark: SparkSession, d: str) -> DataFrame:
    """Pairs of concepts of both graphs with their scores."""
    return M.match_scores(*_sides(spark, d))


def graph_merge_matches(spark: SparkSession, d: str) -> DataFrame:
    """One-to-one matches of both graphs."""
    return M.match_one_to_one(graph_merge_candidates(spark, d))


def graph_union(spark: SparkSession, d: str) -> DataFrame:
    """Keys, names and sizes of the merged graph."""
    base, add = _sides(spark, d)
    matches = M.match_one_to_one(M.match_scores(base, add))
    merged = M.merge_graphs(base, add, matches, M.rename_conflicts(base, add, matches))
    return merged.select("key", "common_name", F.size("aliases").alias("aliases"), F.size("edges").alias("edges"), F.size("descriptions").alias("descriptions"))


def _triples(spark: SparkSession, d: str) -> DataFrame:
    p = table(spark, d, "part")
    g = F.concat(F.lit("/guid/"), F.col("p_partkey"))
    t = lambda rel, val: F.struct(g.alias("s"), F.lit(rel).alias("p"), val.cast("string").alias("o"))
    rows = F.array(t("/part/name", F.col("p_name")), t("/part/size", F.col("p_size")), t("/part/year_founded", F.col("p_size") + 1950), t("/type/brand", F.col("p_brand")), t("/part/guid", F.col("p_partkey")), t("reverse_of:/part/kind", F.col("p_type")), t("/part/kind", F.col("p_type")))
    return p.select(F.explode(rows).alias("t")).select("t.*")


def relation_sample(spark: SparkSession, d: str) -> DataFrame:
    """Relations of parts that state something, with samples."""
    return C.relation_samples(C.relation_filter(_triples(spark, d)))


def freebase_fold(spark: SparkSession, d: str) -> DataFrame:
    """Names and keys of parts folded into one."""
    p = table(spark, d, "part", "p_partkey", "p_name", "p_brand", "p_type")
    row = lambda kind, a, b, seq: F.struct(F.lit(kind).alias("kind"), a.alias("a"), b.alias("b"), F.lit(seq).alias("seq"))
    rows = F.array(
        row("name", F.lit("/lang/de"), F.col("p_type"), 1), row("name", F.when(F.col("p_partkey") % 3 == 0, "/lang/en").otherwise("/lang/fr"), F.concat("p_name", F.lit(" (x)")), 2),
        row("key", F.concat(F.lit("/wikipedia/"), F.col("p_brand")), F.col("p_name"), 3), row("key", F.concat(F.lit("/own/"), F.col("p_type")), F.when(F.col("p_partkey") % 2 == 0, "best").otherwise("k"), 4),
    )
    return C.freebase_names(p.select(F.col("p_partkey").alias("id"), F.explode(rows).alias("t")).select("id", "t.*"))


_DOC = """doc AS (SELECT DISTINCT concept_row, graph, concept_key, source, body, updated_at FROM concept_docs WHERE json_valid(body) AND json_type(body) = 'OBJECT'),
al AS (SELECT *, CASE json_type(a) WHEN 'OBJECT' THEN a->>'$.name' ELSE a->>'$' END AS name, coalesce(CAST(CASE json_type(a) WHEN 'OBJECT' THEN a->>'$.distance' END AS INTEGER), 0) AS d
 FROM (SELECT concept_row, graph, concept_key, unnest(CASE json_type(body, '$.aliases') WHEN 'ARRAY' THEN CAST(body->'$.aliases' AS JSON[]) WHEN 'OBJECT' THEN [body->'$.aliases'] WHEN 'VARCHAR' THEN [body->'$.aliases'] ELSE [] END) AS a FROM doc) WHERE json_type(a) <> 'NULL'),
ed AS (SELECT concept_row, graph, concept_key, e.key AS name, e.value AS v, CAST(e.value->>'$.distance' AS INTEGER) AS d FROM (SELECT concept_row, graph, concept_key, unnest(map_entries(CAST(body->'$.edges' AS MAP(VARCHAR, JSON)))) AS e FROM doc WHERE json_type(body, '$.edges') = 'OBJECT')),
ds AS (SELECT concept_key AS src, name AS dst, x->>'$.relationship_category' AS category, x->>'$.relationship_subcategory' AS subcategory, x->>'$.snippet' AS snippet
 FROM (SELECT concept_key, name, unnest(CASE json_type(v, '$.descriptors') WHEN 'ARRAY' THEN CAST(v->'$.descriptors' AS JSON[]) WHEN 'OBJECT' THEN [v->'$.descriptors'] ELSE [] END) AS x FROM ed) WHERE json_type(x) <> 'NULL')"""
_LATEST = f"""WITH {_DOC}, lt AS (SELECT graph, concept_key AS key, body, concept_row FROM doc QUALIFY row_number() OVER (PARTITION BY graph, concept_key ORDER BY updated_at DESC, concept_row DESC) = 1)"""

SQL = {
    "alias_to_canonicals": f"""WITH {_DOC}, n AS (SELECT alias, name, min(d) AS d FROM (SELECT coalesce(body->>'$.common_name', concept_key) AS alias, concept_key AS name, 0 AS d FROM doc UNION ALL SELECT name, concept_key, d FROM al WHERE name IS NOT NULL) GROUP BY 1, 2)
SELECT alias, string_agg(name || '|' || d, '|' ORDER BY d, name) AS canonicals FROM n GROUP BY 1""",
    "default_aliases": f"""WITH {_DOC} SELECT DISTINCT key, alias FROM (SELECT concept_key AS key, lower(concept_key) AS alias FROM doc WHERE lower(concept_key) <> concept_key
 UNION ALL SELECT concept_key, lower(body->>'$.common_name') FROM doc WHERE lower(body->>'$.common_name') <> (body->>'$.common_name') UNION ALL SELECT concept_key, name FROM al WHERE name IS NOT NULL UNION ALL SELECT concept_key, lower(name) FROM al WHERE name IS NOT NULL)""",
    "concept_dict": f"""WITH {_DOC}, k AS (SELECT * FROM doc WHERE body->>'$.last_updates.directory' IS NOT NULL OR body->>'$.notes.entity' IS NOT NULL),
f AS (SELECT DISTINCT name, k FROM (SELECT body->>'$.common_name' AS name, concept_key AS k FROM k UNION ALL SELECT body->>'$.web_sites.home_page', concept_key FROM k UNION ALL SELECT body->>'$.web_sites.blog', concept_key FROM k UNION ALL SELECT al.name, al.concept_key FROM al JOIN k USING (concept_row)) WHERE name IS NOT NULL)
SELECT name, string_agg(k, '|' ORDER BY k) AS keys FROM f GROUP BY 1""",
    "identifications": f"""WITH {_DOC}, n AS (SELECT concept_row, concept_key, unnest(map_entries(CAST(body->'$.nomenclature' AS MAP(VARCHAR, VARCHAR)))) AS e FROM doc WHERE json_type(body, '$.nomenclature') = 'OBJECT'), w AS (SELECT concept_row, concept_key, unnest(map_entries(CAST(body->'$.web_sites' AS MAP(VARCHAR, VARCHAR)))) AS e FROM doc WHERE json_type(body, '$.web_sites') = 'OBJECT')
SELECT DISTINCT concept_key AS key, e.key AS kind, e.value AS value FROM (SELECT * FROM n UNION ALL SELECT * FROM w WHERE NOT EXISTS (SELECT 1 FROM n WHERE n.concept_row = w.concept_row AND n.e.key = w.e.key))""",
    "concept_urls": f"""WITH {_DOC}, g AS (SELECT concept_row, string_agg(DISTINCT name, '|' ORDER BY name) AS aliases FROM al WHERE regexp_matches(name, '^[A-Z]') GROUP BY 1)
SELECT concept_key AS key, body->>'$.common_name' AS common_name, body->>'$.web_sites.home_page' AS home_page, coalesce(aliases, '') AS aliases FROM doc LEFT JOIN g USING (concept_row)""",
    "snippet_table": f"WITH {_DOC} SELECT src || '|' || dst || '|' || coalesce(category, '') || '|' || coalesce(subcategory, '') AS key, snippet FROM ds WHERE snippet IS NOT NULL",
    "concept_neighbors": f"WITH {_DOC}, n AS (SELECT concept_key AS key, name, min(d) AS d FROM ed WHERE d IS NOT NULL AND name <> concept_key GROUP BY 1, 2) SELECT key, string_agg(name || '|' || d, '|' ORDER BY d, name) AS neighbors FROM n GROUP BY 1",
    "concept_merge": """WITH r AS (SELECT 'C' || o_custkey AS src, 'P' || l_partkey AS dst, CASE l_returnflag WHEN 'N' THEN 'UNCLASSIFIED' ELSE l_returnflag END AS category, l_linestatus AS subcategory, 'order ' || l_orderkey AS snippet, CAST(l_quantity AS INTEGER) AS distance FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
p AS (SELECT src, dst, category, subcategory, min(distance) AS distance, CASE WHEN category = 'UNCLASSIFIED' THEN arg_min(snippet, (length(snippet), snippet)) ELSE arg_min(snippet, (distance, length(snippet), snippet)) END AS snippet FROM r GROUP BY src, dst, category, subcategory)
SELECT *, CAST(min(distance) OVER (PARTITION BY src, dst) AS INTEGER) AS edge_distance FROM p""",
    "canonicalize": f"""WITH RECURSIVE {CG._RD}, rc AS (SELECT r.alias, coalesce(fin.target, '|') AS target FROM r LEFT JOIN fin ON r.alias = fin.alias), {_DOC}
SELECT src, coalesce(target, lower(substr(dst, 1, 1)) || substr(dst, 2)) AS dst, category FROM ds LEFT JOIN rc ON alias = lower(substr(dst, 1, 1)) || substr(dst, 2) WHERE coalesce(target, dst) <> '|'""",
    "fill_distances": f"""{CL._L}, bd AS ({CL.SQL['bidi_edges'].removeprefix(CL._L)}), f AS (SELECT lk.src, lk.dst, CASE WHEN in_text THEN count * 10 ELSE coalesce(bd.distance, 255) END AS distance FROM lk LEFT JOIN bd ON bd.src = lk.src AND bd.dst = lk.dst) SELECT src, dst, distance, distance AS edge_distance FROM f""",
    "kv_diff": f"""{_LATEST}, b AS (SELECT key, body->>'$.common_name' AS v FROM lt WHERE graph = 'base'), a AS (SELECT key, body->>'$.common_name' AS v FROM lt WHERE graph = 'add')
SELECT coalesce(b.key, a.key) AS key, b.v AS "left", a.v AS "right", CASE WHEN a.key IS NULL THEN 'only_left' WHEN b.key IS NULL THEN 'only_right' WHEN lower(b.v) IS NOT DISTINCT FROM lower(a.v) THEN 'identical' ELSE 'changed' END AS status FROM b FULL JOIN a ON a.key = b.key""",
    "graph_merge_candidates": f"""{_LATEST}, va AS (SELECT DISTINCT concept_row, v FROM (SELECT concept_row, lower(CASE WHEN instr(key, '(') > 1 THEN rtrim(split_part(key, '(', 1)) ELSE key END) AS v FROM lt UNION ALL SELECT concept_row, lower(body->>'$.common_name') FROM lt UNION ALL SELECT concept_row, lower(name) FROM al WHERE name NOT LIKE '%Wikipedia:%') WHERE v IS NOT NULL),
f AS (SELECT lt.graph, lt.key, va.v, ed.name, lower(regexp_replace(ed.name, '\\s\\(.+\\)', '')) AS e, ed.d FROM lt JOIN va USING (concept_row) JOIN ed USING (concept_row))
SELECT b, a, count(*) AS score FROM (SELECT DISTINCT x.key AS b, y.key AS a, x.name AS bn, y.name AS an FROM f x JOIN f y ON x.graph = 'base' AND y.graph = 'add' AND x.v = y.v AND x.e = y.e WHERE x.d IS NULL OR y.d IS NULL OR x.d < 45 OR y.d < 45) GROUP BY 1, 2""",
    "relation_sample": """WITH t AS (SELECT '/guid/' || p_partkey AS s, unnest([{'p': '/part/name', 'o': p_name}, {'p': '/part/year_founded', 'o': CAST(p_size + 1950 AS VARCHAR)}, {'p': '/part/kind', 'o': p_type}]) AS x FROM part),
q AS (SELECT x.p AS p, '"' || s || ' ' || x.p || ' ' || x.o || '"' AS t FROM t), r AS (SELECT *, row_number() OVER (PARTITION BY p ORDER BY t) AS r FROM q)
SELECT p, count(*) AS n, '(' || string_agg(t, ', ' ORDER BY t) FILTER (WHERE r <= 3) || ')' AS samples FROM r GROUP BY 1""",
    "freebase_fold": """WITH n AS (SELECT p_partkey AS id, CASE WHEN p_partkey % 3 = 0 THEN p_name ELSE p_type END AS name, CASE WHEN p_partkey % 2 = 0 THEN p_type ELSE p_brand || ' ' || p_name END AS k FROM part)
SELECT id, name, name || ' (' || CASE WHEN instr(k, ' ') > 1 AND split_part(k, ' ', -1) = name THEN regexp_replace(k, ' [^ ]*$', '') ELSE k END || ')' AS key FROM n""",
}

# one pair after the other by falling score, unless either side is taken
SQL["graph_merge_matches"] = f"""WITH RECURSIVE sc AS ({SQL['graph_merge_candidates']}), o AS (SELECT *, row_number() OVER (ORDER BY score DESC, b, a) AS i FROM sc),
g(i, ub, ua, b, a, score, took) AS (SELECT CAST(0 AS BIGINT), CAST([] AS VARCHAR[]), CAST([] AS VARCHAR[]), CAST(NULL AS VARCHAR), CAST(NULL AS VARCHAR), CAST(0 AS BIGINT), false
 UNION ALL SELECT o.i, CASE WHEN ok THEN list_append(ub, o.b) ELSE ub END, CASE WHEN ok THEN list_append(ua, o.a) ELSE ua END, o.b, o.a, o.score, ok FROM (SELECT g.i AS gi, ub, ua, o.*, NOT list_contains(ub, o.b) AND NOT list_contains(ua, o.a) AS ok FROM g JOIN o ON o.i = g.i + 1) o)
SELECT b, a, score FROM g WHERE took"""

QUERIES = {f.__name__: f for f in (alias_to_canonicals, default_aliases, concept_dict, identifications, concept_urls, snippet_table, concept_neighbors, concept_merge, canonicalize, fill_distances, kv_diff, graph_merge_candidates, graph_merge_matches, graph_union, relation_sample, freebase_fold)}
