"""Catalogue queries on the link graph and the pair store, with SQL for the same results.

The link graph is derived from orders and all their line items: customers link to parts, and parts back where the item
was returned. Customers are also sites whose linkers are parts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from knotwork.functions import text
from knotwork.functions.titles import TITLE_KEY_SQL, title_key
from knotwork.operators import links as L
from knotwork.operators import pairs as P
from knotwork.sources.tables import table


def _items(spark: SparkSession, d: str, *columns: str) -> DataFrame:
    """Line items with the customer of their order."""
    li = table(spark, d, "lineitem", "l_orderkey", "l_partkey", *columns)
    return li.join(table(spark, d, "orders", "o_orderkey", "o_custkey"), F.col("l_orderkey") == F.col("o_orderkey"))


def raw_links(spark: SparkSession, d: str) -> DataFrame:
    """(src, target, count, in_text) with repeats."""
    both = _items(spark, d, "l_returnflag", "l_linestatus")
    c, p = F.concat(F.lit("C"), "o_custkey"), F.concat(F.lit("P"), "l_partkey")
    rest = (F.lit(1).alias("count"), (F.col("l_linestatus") == "F").alias("in_text"))
    return both.select(c.alias("src"), p.alias("target"), *rest).unionByName(both.filter("l_returnflag = 'R'").select(p.alias("src"), c.alias("target"), *rest))


def pages(spark: SparkSession, d: str) -> DataFrame:
    """(id, ambiguous, entity) of customers and parts."""
    c = table(spark, d, "customer", "c_custkey").select(F.concat(F.lit("C"), "c_custkey").alias("id"), F.lit(False).alias("ambiguous"), F.lit(True).alias("entity"))
    p = table(spark, d, "part", "p_partkey", "p_size").select(F.concat(F.lit("P"), "p_partkey").alias("id"), (F.col("p_size") == 50).alias("ambiguous"), (F.col("p_size") != 49).alias("entity"))
    return c.unionByName(p)


def links(spark: SparkSession, d: str) -> DataFrame:
    """Resolved links."""
    return L.resolve_links(raw_links(spark, d), pages(spark, d).select(F.col("id").alias("alias"), F.col("id").alias("canonical")))


def resolve_links(spark: SparkSession, d: str) -> DataFrame:
    """Resolved links of the derived graph."""
    return links(spark, d)


def resolve_wiki_links(spark: SparkSession, d: str) -> DataFrame:
    """wiki_links resolved to pages by title, repeats merged."""
    raw = table(spark, d, "wiki_links", "link_id", "page_id", "target", "link_count", "in_text").dropDuplicates(["link_id"])
    raw = raw.select(F.col("page_id").alias("src"), title_key(F.col("target")).alias("target"), F.coalesce("link_count", F.lit(0)).alias("count"), F.coalesce("in_text", F.lit(False)).alias("in_text"))
    aliases = table(spark, d, "page_nodes", "page_id", "title").distinct().select(title_key(F.col("title")).alias("alias"), F.col("page_id").alias("canonical"))
    return L.resolve_links(raw, aliases)


def mutual_links(spark: SparkSession, d: str) -> DataFrame:
    """Links that are answered."""
    return L.mutual_links(links(spark, d)).select("src", "dst")


def bidi_edges(spark: SparkSession, d: str) -> DataFrame:
    """Bidirectional edge classes."""
    return L.bidi_edges(links(spark, d), pages(spark, d))


def edge_distance(spark: SparkSession, d: str) -> DataFrame:
    """Distances of all linked pairs."""
    return L.edge_distances(links(spark, d)).select("src", "dst", F.col("distance").cast("int").alias("distance"))


def edge_stats(spark: SparkSession, d: str) -> DataFrame:
    """Nine-column statistics of every linked pair."""
    lk = links(spark, d)
    out = lk.groupBy("src").agg(F.count("*").alias("n"))
    e = L.edge_distances(lk)
    e = e.join(out.select(F.col("src"), F.col("n").alias("out1")), "src", "left").join(out.select(F.col("src").alias("dst"), F.col("n").alias("out2")), "dst", "left")
    return e.select("src", "n1", F.coalesce("out1", F.lit(0)).alias("out1"), "dst", "n2", F.coalesce("out2", F.lit(0)).alias("out2"), "common", F.when(F.col("mutual"), "T").otherwise("F").alias("bidi"), F.col("distance").cast("int").alias("distance"))


def title_distance(spark: SparkSession, d: str) -> DataFrame:
    """Distances of customers to the parts that they ordered."""
    li = table(spark, d, "lineitem", "l_orderkey", "l_partkey")
    asked = li.join(table(spark, d, "orders", "o_orderkey", "o_custkey"), F.col("l_orderkey") == F.col("o_orderkey")).select(F.concat(F.lit("C"), "o_custkey").alias("a"), F.concat(F.lit("P"), "l_partkey").alias("b"))
    return L.title_distances(links(spark, d), pages(spark, d), asked)


def neighbors_topn(spark: SparkSession, d: str) -> DataFrame:
    """The ten nearest neighbours of every page."""
    return L.top_neighbors(links(spark, d), pages(spark, d), 10)


def link_counts(spark: SparkSession, d: str) -> DataFrame:
    """Inlinks and outlinks of every page."""
    return L.link_counts(pages(spark, d), links(spark, d))


def priority_topics(spark: SparkSession, d: str) -> DataFrame:
    """Unambiguous entities with their inlinks."""
    return L.priority_topics(pages(spark, d), links(spark, d))


def subgraph(spark: SparkSession, d: str) -> DataFrame:
    """The links around every twentieth customer."""
    seeds = table(spark, d, "customer", "c_custkey").filter("c_custkey % 20 = 0").select(F.concat(F.lit("C"), "c_custkey").alias("id"))
    return L.subgraph(links(spark, d), seeds).select("src", "dst", "count", "in_text")


def distance_dictionary(spark: SparkSession, d: str) -> DataFrame:
    """Pairs as 'a|b' with their distance."""
    return edge_distance(spark, d).select(F.concat_ws("|", "src", "dst").alias("key"), F.col("distance").cast("string").alias("value"))


def core_dump(spark: SparkSession, d: str) -> DataFrame:
    """One line for each page: id and degrees."""
    c = link_counts(spark, d)
    return c.select(F.format_string("('%s',%d,%d)", "id", "outlinks", "inlinks").alias("line"))


def outlink_names(spark: SparkSession, d: str) -> DataFrame:
    """Targets of wiki_links by page in their order, canonical and each once."""
    raw = table(spark, d, "wiki_links", "link_id", "page_id", "target").dropDuplicates(["link_id"])
    raw = raw.select(F.col("page_id").alias("src"), F.col("link_id").alias("pos"), title_key(F.col("target")).alias("target")).filter("target is not null")
    names = table(spark, d, "page_nodes", "title").distinct().select(title_key(F.col("title")).alias("alias"), F.col("title").alias("canonical"))
    return L.canonical_outlinks(raw, names)


def _linkers(spark: SparkSession, d: str) -> DataFrame:
    return _items(spark, d).select(F.concat(F.lit("C"), "o_custkey").alias("site"), F.concat(F.lit("P"), "l_partkey").alias("linker"))


def site_distance(spark: SparkSession, d: str) -> DataFrame:
    """Distances of customers by the parts they share."""
    return P.site_distances(_linkers(spark, d))


def pair_distances(spark: SparkSession, d: str) -> DataFrame:
    """Stored pairs within each nation's customers."""
    ids = table(spark, d, "customer", "c_custkey", "c_nationkey").select(F.col("c_nationkey").alias("batch"), F.concat(F.lit("C"), "c_custkey").alias("id"))
    return P.pair_distances(site_distance(spark, d), ids)


def pair_lookup(spark: SparkSession, d: str) -> DataFrame:
    """The distance of every customer to the next one."""
    asked = table(spark, d, "customer", "c_custkey").select(F.concat(F.lit("C"), F.col("c_custkey") + 1).alias("a"), F.concat(F.lit("C"), "c_custkey").alias("b"))
    return P.pair_lookup(P.asked_distances(_linkers(spark, d), asked), asked)


def close_sites(spark: SparkSession, d: str) -> DataFrame:
    """Number of sites within 240 of each."""
    return P.close_sites(site_distance(spark, d), most=240).groupBy("id").agg(F.count("*").alias("close"))


def pair_upsert(spark: SparkSession, d: str) -> DataFrame:
    """The store after every customer's distance to the next is set, and that of each tenth is deleted again."""
    c = table(spark, d, "customer", "c_custkey")
    a, b = F.concat(F.lit("C"), "c_custkey"), F.concat(F.lit("C"), F.col("c_custkey") + 1)
    store = c.select(F.lit(1).alias("seq"), a.alias("a"), b.alias("b"), (F.col("c_custkey") % 200).cast("int").alias("distance"))
    gone = c.filter("c_custkey % 10 = 0").select(F.lit(2).alias("seq"), b.alias("a"), a.alias("b"), F.lit(None).cast("int").alias("distance"))
    return P.upsert_pairs(site_distance(spark, d), store.unionByName(gone))


def key_pack(spark: SparkSession, d: str) -> DataFrame:
    """Order and part packed into one key and taken apart again."""
    li = table(spark, d, "lineitem", "l_orderkey", "l_partkey").distinct()
    key = text.composite_key(F.col("l_orderkey"), F.col("l_partkey"))
    hi, lo = text.decompose_key(key)
    return li.select(key.alias("key"), hi.alias("hi"), lo.alias("lo"))


_RAW = """raw AS (SELECT 'C' || o_custkey AS src, 'P' || l_partkey AS target, l_linestatus = 'F' AS in_text FROM lineitem JOIN orders ON l_orderkey = o_orderkey
 UNION ALL SELECT 'P' || l_partkey, 'C' || o_custkey, l_linestatus = 'F' FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE l_returnflag = 'R'),
pg AS (SELECT 'C' || c_custkey AS id, false AS ambiguous, true AS entity FROM customer UNION ALL SELECT 'P' || p_partkey, p_size = 50, p_size <> 49 FROM part)"""
_L = f"""WITH {_RAW},
lk AS (SELECT src, target AS dst, CAST(least(255, count(*)) AS INTEGER) AS count, bool_or(in_text) AS in_text FROM raw WHERE target IN (SELECT id FROM pg) AND src <> target GROUP BY 1, 2),
inl AS (SELECT dst AS id, count(*) AS n FROM lk GROUP BY 1), outl AS (SELECT src AS id, count(*) AS n FROM lk GROUP BY 1)"""


def _formula(n1: str, n2: str, common: str, mutual: str) -> str:
    den = f"CAST(greatest(1, CASE WHEN {mutual} THEN CASE WHEN {n1} <= {n2} THEN {n1} + 1 ELSE ({n1} + {n2}) // 2 + 1 END ELSE trunc(CAST(0.97 AS FLOAT) * CAST({n1} + 1 AS FLOAT) + CAST(0.03 AS FLOAT) * CAST({n2} AS FLOAT)) END) AS DOUBLE)"
    return f"CAST(trunc(50.0::DOUBLE * pow(greatest(0.0::DOUBLE, 1.0::DOUBLE - {common} / {den}), greatest(1.0::DOUBLE, least(12.0::DOUBLE, ln(293424.0::DOUBLE / {den}))))) AS INTEGER) + CASE WHEN {mutual} THEN 10 ELSE 15 END"


_E = f"""{_L},
pr AS (SELECT src, dst, max(f) + max(b) = 2 AS mutual FROM (SELECT src, dst, 1 AS f, 0 AS b FROM lk UNION ALL SELECT dst, src, 0, 1 FROM lk) GROUP BY 1, 2),
coc AS (SELECT a.dst AS p, b.dst AS q, count(*) AS n FROM lk a JOIN lk b ON a.src = b.src WHERE a.dst <> b.dst GROUP BY 1, 2),
e AS (SELECT pr.src, pr.dst, 1 + coalesce(coc.n, 0) AS common, mutual, coalesce(i1.n, 0) AS n1, coalesce(i2.n, 0) AS n2 FROM pr LEFT JOIN coc ON p = src AND q = dst LEFT JOIN inl i1 ON i1.id = src LEFT JOIN inl i2 ON i2.id = dst),
ed AS (SELECT *, {_formula('n1', 'n2', 'common', 'mutual')} AS distance FROM e)"""
_S = f"""WITH {_RAW}, st AS (SELECT DISTINCT site, linker FROM (SELECT src AS site, target AS linker FROM raw WHERE src LIKE 'C%' UNION ALL SELECT src, src FROM raw WHERE src LIKE 'C%')),
sz AS (SELECT site, count(*) AS n FROM st GROUP BY 1), sh AS (SELECT a.site AS lo, b.site AS hi, count(*) AS b FROM st a JOIN st b ON a.linker = b.linker AND a.site < b.site GROUP BY 1, 2),
sd AS (SELECT lo, hi, CAST(greatest(1, 256 - (b * 128) // x.n - (b * 128) // y.n) AS INTEGER) AS distance FROM sh JOIN sz x ON x.site = lo JOIN sz y ON y.site = hi WHERE greatest(1, 256 - (b * 128) // x.n - (b * 128) // y.n) <= 249)"""
_TK = TITLE_KEY_SQL

SQL = {
    "resolve_links": f"{_L} SELECT * FROM lk",
    "resolve_wiki_links": f"""WITH w AS (SELECT DISTINCT link_id, page_id, {_TK.format(c='target')} AS k, coalesce(link_count, 0) AS n, coalesce(in_text, false) AS t FROM wiki_links), p AS (SELECT DISTINCT page_id, {_TK.format(c='title')} AS k FROM page_nodes)
SELECT w.page_id AS src, p.page_id AS dst, CAST(least(255, sum(n)) AS INTEGER) AS count, bool_or(t) AS in_text FROM w JOIN p ON w.k = p.k WHERE w.page_id <> p.page_id GROUP BY 1, 2""",
    "mutual_links": f"{_L} SELECT a.src, a.dst FROM lk a JOIN lk b ON a.src = b.dst AND a.dst = b.src",
    "bidi_edges": f"{_L} SELECT a.src, a.dst, CASE WHEN b.src IS NOT NULL THEN 1 WHEN a.count > 2 THEN 2 WHEN a.count > 1 THEN 3 ELSE 4 END AS distance FROM lk a JOIN pg ON pg.id = a.dst AND NOT ambiguous AND entity LEFT JOIN lk b ON a.src = b.dst AND a.dst = b.src WHERE a.in_text",
    "edge_distance": f"{_E} SELECT src, dst, distance FROM ed",
    "edge_stats": f"{_E} SELECT src, n1, coalesce(o1.n, 0) AS out1, dst, n2, coalesce(o2.n, 0) AS out2, common, CASE WHEN mutual THEN 'T' ELSE 'F' END AS bidi, distance FROM ed LEFT JOIN outl o1 ON o1.id = src LEFT JOIN outl o2 ON o2.id = dst",
    "title_distance": f"""{_L}, q AS (SELECT DISTINCT 'C' || o_custkey AS a, 'P' || l_partkey AS b FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
th AS (SELECT q.a, q.b, count(*) AS n FROM q JOIN lk x ON x.dst = q.a JOIN lk y ON y.src = x.src AND y.dst = q.b GROUP BY 1, 2),
f AS (SELECT q.a, q.b, coalesce(i1.n, 0) AS n1, coalesce(i2.n, 0) AS n2, coalesce(th.n, 0) + CAST(ab.src IS NOT NULL AS INTEGER) + CAST(ba.src IS NOT NULL AS INTEGER) AS common, ab.src IS NOT NULL AND ba.src IS NOT NULL AS mutual, p1.id IS NOT NULL AND p2.id IS NOT NULL AS known
 FROM q LEFT JOIN th ON th.a = q.a AND th.b = q.b LEFT JOIN inl i1 ON i1.id = q.a LEFT JOIN inl i2 ON i2.id = q.b LEFT JOIN lk ab ON ab.src = q.a AND ab.dst = q.b LEFT JOIN lk ba ON ba.src = q.b AND ba.dst = q.a LEFT JOIN pg p1 ON p1.id = q.a LEFT JOIN pg p2 ON p2.id = q.b)
SELECT a, b, CAST(CASE WHEN known THEN {_formula('n1', 'n2', 'common', 'mutual')} ELSE 255 END AS INTEGER) AS distance FROM f""",
    "neighbors_topn": f"""{_L}, clear AS (SELECT id FROM pg WHERE NOT ambiguous),
own AS (SELECT a.src, a.dst, CASE WHEN b.src IS NOT NULL THEN CAST(trunc(greatest(4.0, coalesce(inl.n, 0) / 4.0 + 0.5)) AS BIGINT) ELSE 1 END AS s FROM lk a JOIN clear ON clear.id = a.dst LEFT JOIN lk b ON a.src = b.dst AND a.dst = b.src LEFT JOIN inl ON inl.id = a.dst),
two AS (SELECT x.dst AS src, y.dst, CAST(sum(y.count) AS BIGINT) AS s FROM lk x JOIN clear ON clear.id = x.src JOIN lk y ON y.src = x.src WHERE x.dst <> y.dst GROUP BY 1, 2),
sc AS (SELECT src, dst, CAST(sum(s) AS BIGINT) AS score FROM (SELECT * FROM own UNION ALL SELECT * FROM two) GROUP BY 1, 2),
f AS (SELECT src, dst, score, coalesce(i2.n, 0) AS n2, CAST(trunc(256 * (1.0::DOUBLE - least(1.0::DOUBLE, score / (coalesce(i1.n, 0) + 1)))) AS INTEGER) AS distance FROM sc JOIN pg ON pg.id = dst AND NOT ambiguous AND entity LEFT JOIN inl i1 ON i1.id = src LEFT JOIN inl i2 ON i2.id = dst)
SELECT * FROM (SELECT src, dst, score, distance, CAST(row_number() OVER (PARTITION BY src ORDER BY distance, n2, dst) AS INTEGER) AS rank FROM f) WHERE rank <= 10""",
    "link_counts": f"{_L} SELECT pg.id, coalesce(inl.n, 0) AS inlinks, coalesce(outl.n, 0) AS outlinks FROM pg LEFT JOIN inl ON inl.id = pg.id LEFT JOIN outl ON outl.id = pg.id",
    "priority_topics": f"{_L} SELECT pg.id, coalesce(inl.n, 0) AS inlinks FROM pg LEFT JOIN inl ON inl.id = pg.id WHERE NOT ambiguous AND entity",
    "subgraph": f"""{_L}, s AS (SELECT 'C' || c_custkey AS id FROM customer WHERE c_custkey % 20 = 0),
o AS (SELECT * FROM lk WHERE src IN (SELECT id FROM s)), i AS (SELECT * FROM lk WHERE dst IN (SELECT id FROM s)), w AS (SELECT * FROM lk WHERE src IN (SELECT src FROM i))
SELECT DISTINCT * FROM (SELECT * FROM o UNION ALL SELECT * FROM i UNION ALL SELECT * FROM w UNION ALL SELECT * FROM lk WHERE dst IN (SELECT dst FROM o UNION SELECT src FROM i UNION SELECT dst FROM w))""",
    "distance_dictionary": f"{_E} SELECT src || '|' || dst AS key, CAST(distance AS VARCHAR) AS value FROM ed",
    "core_dump": f"{_L} SELECT '(''' || pg.id || ''',' || coalesce(outl.n, 0) || ',' || coalesce(inl.n, 0) || ')' AS line FROM pg LEFT JOIN inl ON inl.id = pg.id LEFT JOIN outl ON outl.id = pg.id",
    "outlink_names": f"""WITH w AS (SELECT DISTINCT link_id, page_id, {_TK.format(c='target')} AS k FROM wiki_links), p AS (SELECT DISTINCT title, {_TK.format(c='title')} AS k FROM page_nodes),
n AS (SELECT page_id AS src, coalesce(title, w.k) AS name, min(link_id) AS pos FROM w LEFT JOIN p ON w.k = p.k WHERE w.k IS NOT NULL AND coalesce(title, w.k) <> '|' GROUP BY 1, 2) SELECT src, string_agg(name, '|' ORDER BY pos, name) AS outlinks FROM n GROUP BY 1""",
    "site_distance": f"{_S} SELECT * FROM sd",
    "pair_distances": f"{_S}, ids AS (SELECT c_nationkey AS batch, 'C' || c_custkey AS id FROM customer) SELECT x.batch, lo AS a, hi AS b, distance FROM sd JOIN ids x ON x.id = lo JOIN ids y ON y.id = hi AND y.batch = x.batch",
    "pair_lookup": f"{_S}, q AS (SELECT 'C' || (c_custkey + 1) AS a, 'C' || c_custkey AS b FROM customer) SELECT a, b, coalesce(distance, 255) AS distance FROM q LEFT JOIN sd ON lo = least(a, b) AND hi = greatest(a, b)",
    "close_sites": f"{_S} SELECT id, count(*) AS close FROM (SELECT lo AS id FROM sd WHERE distance <= 240 UNION ALL SELECT hi FROM sd WHERE distance <= 240) GROUP BY 1",
    "pair_upsert": f"""{_S}, ch AS (SELECT least('C' || c_custkey, 'C' || (c_custkey + 1)) AS lo, greatest('C' || c_custkey, 'C' || (c_custkey + 1)) AS hi, CAST(c_custkey % 200 AS INTEGER) AS distance, c_custkey % 10 = 0 AS gone FROM customer)
SELECT lo, hi, distance FROM sd ANTI JOIN ch USING (lo, hi) UNION ALL SELECT lo, hi, distance FROM ch WHERE NOT gone AND distance <= 249""",
    "key_pack": "SELECT DISTINCT (l_orderkey << 32) | l_partkey AS key, l_orderkey AS hi, l_partkey AS lo FROM lineitem",
}

QUERIES = {f.__name__: f for f in (resolve_links, resolve_wiki_links, mutual_links, bidi_edges, edge_distance, edge_stats, title_distance, neighbors_topn, link_counts, priority_topics, subgraph, distance_dictionary, core_dump, outlink_names, site_distance, pair_distances, pair_lookup, close_sites, pair_upsert, key_pack)}
