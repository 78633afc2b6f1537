"""Catalogue queries on batches of chains, store services, listings with their links, and files that are written and read again."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from knotwork.functions import titles as T
from knotwork.operators import graph as G
from knotwork.operators import links as L
from knotwork.operators import pairs as P
from knotwork.operators import spotting
from knotwork.plans import catalog_graph as CG
from knotwork.plans import catalog_links as CL
from knotwork.plans import catalog_text as CT
from knotwork.runtime import shared_folder
from knotwork.sources import readers, sinks
from knotwork.sources.tables import table


def _place(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def _nodes(spark: SparkSession, d: str) -> DataFrame:
    return CL.pages(spark, d).select(F.col("id").alias("alias"), F.col("id").alias("node"))


def topic_chains(spark: SparkSession, d: str) -> DataFrame:
    """Shortest chains of every ordered pair of a list of topics: of each region the customer with the smallest key."""
    c = table(spark, d, "customer", "c_custkey", "c_nationkey").join(table(spark, d, "nation", "n_nationkey", "n_regionkey"), F.col("c_nationkey") == F.col("n_nationkey"))
    topics = [f"C{r['k']}" for r in c.groupBy("n_regionkey").agg(F.min("c_custkey").alias("k")).collect()]  # one a region
    pairs = spark.createDataFrame([(f"{a}>{b}", a, b) for a, b in G.topic_pairs(sorted(topics))], "query string, a string, b string")
    asked = pairs.select("query", F.explode(F.array(F.struct(F.lit("a").alias("side"), F.col("a").alias("alias")), F.struct(F.lit("b").alias("side"), F.col("b").alias("alias")))).alias("e")).select("query", "e.side", "e.alias", F.lit(0).alias("pos"))
    return G.shortest_chains(CG._edges(spark, d), asked, _nodes(spark, d)).select("query", "dist")


def nearest_topic(spark: SparkSession, d: str) -> DataFrame:
    """Shortest chain of every twentieth customer to the nearest of a set of topics: the first customer of each nation."""
    c = table(spark, d, "customer", "c_custkey", "c_nationkey")
    topics = c.groupBy("c_nationkey").agg(F.min("c_custkey").alias("k")).agg(F.collect_list(F.concat(F.lit("C"), "k")).alias("topics"))  # one a nation
    who = c.filter("c_custkey % 20 = 0").select("c_custkey").join(F.broadcast(topics), how="left")
    a = who.select(F.col("c_custkey").alias("query"), F.lit("a").alias("side"), F.concat(F.lit("C"), "c_custkey").alias("alias"), F.lit(0).alias("pos"))
    b = who.select(F.col("c_custkey").alias("query"), F.lit("b").alias("side"), F.explode("topics").alias("alias"), F.lit(0).alias("pos"))
    return G.shortest_chains(CG._edges(spark, d), a.unionByName(b), _nodes(spark, d), max_links=2).select("query", "dist")


def link_limit(spark: SparkSession, d: str) -> DataFrame:
    """The first thousand links by falling count: what an index with a limit of links holds."""
    return L.limited_links(CL.links(spark, d), 1000).select("src", "dst", "count")


def store_statistics(spark: SparkSession, d: str) -> DataFrame:
    """Entries and sites of the pair store."""
    return P.store_statistics(CL.site_distance(spark, d))


def float_pair_lookup(spark: SparkSession, d: str) -> DataFrame:
    """Distances as fractions, 1.0 where the store has none."""
    store = CL.site_distance(spark, d).select("lo", "hi", (F.col("distance") / 256.0).alias("distance"))
    asked = table(spark, d, "customer", "c_custkey").select(F.concat(F.lit("C"), F.col("c_custkey") + 1).alias("a"), F.concat(F.lit("C"), "c_custkey").alias("b"))
    return P.pair_lookup(store, asked, unknown=1.0)


def listing_links(spark: SparkSession, d: str) -> DataFrame:
    """Every page of the listing with its folder and the pages before and after it."""
    return spotting.listing_links(CT.listing_pages(spark, d))


def biggest_bucket(spark: SparkSession, d: str) -> DataFrame:
    """The first letter with the most listed titles."""
    return spotting.biggest_bucket(CT.listing_pages(spark, d))


def flat_link_file(spark: SparkSession, d: str) -> DataFrame:
    """Targets of wiki_links, written as one link a line and read again."""
    raw = table(spark, d, "wiki_links", "link_id", "page_id", "target").dropDuplicates(["link_id"]).select(F.col("page_id").cast("string").alias("src"), T.title_key(F.col("target")).alias("target")).filter("target is not null")
    path = _place(spark, "flat-links")
    sinks.write_flat_links(raw.distinct(), path)
    return readers.read_flat_links(spark, path)


def pages_index_file(spark: SparkSession, d: str) -> DataFrame:
    """Pages, written as an index and read again."""
    path = _place(spark, "pages")
    sinks.write_pages_index(table(spark, d, "page_nodes", "page_id", "title", "ambiguous").distinct().select(F.col("page_id").alias("id"), "title", F.coalesce("ambiguous", F.lit(False)).alias("ambiguous")), path)
    return readers.read_pages_index(spark, path)


def redirects_index_file(spark: SparkSession, d: str) -> DataFrame:
    """Redirects that end at a page, written as an index and read again."""
    path = _place(spark, "redirects")
    sinks.write_redirects_index(CG.redirect_aliases(spark, d), path)
    return readers.read_redirects_index(spark, path)


def images_index_file(spark: SparkSession, d: str) -> DataFrame:
    """Image paths of titles, written as an index and read again."""
    path = _place(spark, "images")
    sinks.write_images_index(table(spark, d, "page_nodes", "title").distinct().select("title", F.concat(F.lit("/"), F.md5("title"), F.lit("/x|y.jpg")).alias("path")), path)
    return readers.read_images_index(spark, path)


def topics_file(spark: SparkSession, d: str) -> DataFrame:
    """Unambiguous entities, written as a list and read again."""
    path = _place(spark, "topics")
    sinks.write_topics(CL.priority_topics(spark, d), path)
    return readers.read_topics(spark, path)


def distance_file(spark: SparkSession, d: str) -> DataFrame:
    """Distances as key-value rows, kept in a versioned store and read again; of repeated keys the last counts."""
    path = _place(spark, "distances")
    rows = CL.distance_dictionary(spark, d)
    sinks.put_all(rows.withColumn("seq", F.lit(2)).unionByName(rows.select("key", F.lit("0").alias("value"), F.lit(1).alias("seq"))), f"{path}/table")
    store = sinks.Store(spark, f"{path}/store")
    store.persist(rows.limit(0))
    store.persist(readers.read_distance_dictionary(spark.read.parquet(f"{path}/table")))
    return store.load()


def triples_file(spark: SparkSession, d: str) -> DataFrame:
    """Triples of parts, written as tab-separated lines and read again."""
    path = _place(spark, "triples")
    p = table(spark, d, "part", "p_partkey", "p_name", "p_size")
    rows = p.select(F.explode(F.array(F.struct(F.lit("/part/name").alias("p"), F.col("p_name").alias("o")), F.struct(F.lit("/part/size").alias("p"), F.col("p_size").cast("string").alias("o")))).alias("t"), "p_partkey")
    rows.select(F.concat_ws("\t", F.concat(F.lit("/guid/"), "p_partkey"), "t.p", "t.o").alias("value")).write.text(path)
    return readers.read_tsv_triples(spark, path).select("s", "p", "o")


_TOPICS = "tp AS (SELECT 'C' || min(c_custkey) AS t FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY n_regionkey)"
_MEET = "SELECT a.query, CAST(min(a.dist + b.dist) AS BIGINT) AS dist FROM {s} a JOIN {s} b ON a.query = b.query AND a.node = b.node WHERE a.side = 'a' AND b.side = 'b' GROUP BY 1"
_LP = CT.SQL["listing_pages"]

SQL = {
    "topic_chains": f"""{CG._ED}, {_TOPICS}, s0 AS (SELECT x.t || '>' || y.t AS query, unnest(['a', 'b']) AS side, unnest([x.t, y.t]) AS node, 0 AS dist FROM tp x JOIN tp y ON x.t <> y.t),
{CG._LEVELS}
{_MEET.format(s='s7')}""",
    "nearest_topic": f"""{CG._ED}, tp AS (SELECT 'C' || min(c_custkey) AS t FROM customer GROUP BY c_nationkey),
s0 AS (SELECT c_custkey AS query, 'a' AS side, 'C' || c_custkey AS node, 0 AS dist FROM customer WHERE c_custkey % 20 = 0 UNION ALL SELECT c_custkey, 'b', t, 0 FROM customer, tp WHERE c_custkey % 20 = 0),
{CG._LEVELS}
{_MEET.format(s='s3')}""",
    "link_limit": f"{CL._L} SELECT src, dst, count FROM lk ORDER BY count DESC, src, dst LIMIT 1000",
    "store_statistics": f"{CL._S} SELECT (SELECT count(*) FROM sd) AS entries, (SELECT count(DISTINCT s) FROM (SELECT lo AS s FROM sd UNION ALL SELECT hi FROM sd)) AS sites",
    "float_pair_lookup": f"{CL._S}, q AS (SELECT 'C' || (c_custkey + 1) AS a, 'C' || c_custkey AS b FROM customer) SELECT a, b, coalesce(distance / 256.0::DOUBLE, 1.0::DOUBLE) AS distance FROM q LEFT JOIN sd ON lo = least(a, b) AND hi = greatest(a, b)",
    "listing_links": f"WITH lp AS ({_LP}), p AS (SELECT bucket, page, count(*) AS titles FROM lp GROUP BY 1, 2) SELECT bucket, page, CAST(page // 1024 AS INTEGER) AS folder, titles, lag(page) OVER w AS prev, lead(page) OVER w AS next FROM p WINDOW w AS (PARTITION BY bucket ORDER BY page)",
    "biggest_bucket": f"WITH lp AS ({_LP}) SELECT bucket, count(*) AS titles FROM lp GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 1",
    "flat_link_file": f"SELECT DISTINCT CAST(page_id AS VARCHAR) AS src, {CL._TK.format(c='target')} AS target FROM wiki_links WHERE {CL._TK.format(c='target')} IS NOT NULL",
    "pages_index_file": "SELECT DISTINCT page_id AS id, title, coalesce(ambiguous, false) AS ambiguous FROM page_nodes",
    "redirects_index_file": CG.SQL["redirect_aliases"],
    "images_index_file": "SELECT DISTINCT title, '/' || md5(title) || '/x|y.jpg' AS path FROM page_nodes",
    "topics_file": f"SELECT id AS topic FROM ({CL.SQL['priority_topics']})",
    "distance_file": CL.SQL["edge_distance"],
    "triples_file": "SELECT '/guid/' || p_partkey AS s, unnest(['/part/name', '/part/size']) AS p, unnest([p_name, CAST(p_size AS VARCHAR)]) AS o FROM part",
}

QUERIES = {f.__name__: f for f in (topic_chains, nearest_topic, link_limit, store_statistics, float_pair_lookup, listing_links, biggest_bucket, flat_link_file, pages_index_file, redirects_index_file, images_index_file, topics_file, distance_file, triples_file)}
