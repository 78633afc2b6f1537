"""Catalogue queries on titles, texts, page sources, names in texts, directory records and streams, with SQL where it can express them."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from knotwork.functions import text as X
from knotwork.functions import titles as T
from knotwork.operators import directory, extraction, spotting
from knotwork.plans import jobs
from knotwork.runtime import shared_folder
from knotwork.sources import readers
from knotwork.sources.tables import table
from knotwork.streaming import queues


def _titles(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "page_nodes", "page_id", "title").distinct()


def _sources(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "raw_pages", "page_id", "title", "content").dropDuplicates(["page_id"])


def title_filter(spark: SparkSession, d: str) -> DataFrame:
    """What the title rules say of every page."""
    t = F.col("title")
    return _titles(spark, d).select("page_id", T.useful_title(t).alias("useful"), T.invalid_title(t).alias("invalid"), T.is_meta_page(t).alias("meta"), T.looks_like_entity(t).alias("entity"), T.bucket(t).alias("bucket"), T.lower_alias(t).alias("lower_alias"), T.strip_parenthetical(t).alias("short"), T.sanitize_title(t).alias("clean"), T.listing_key(t).alias("listing"))


def clean_text(spark: SparkSession, d: str) -> DataFrame:
    """Documents as one line of ASCII text."""
    return table(spark, d, "documents", "doc_id", "text").select("doc_id", F.md5(X.clean_string(F.col("text"))).alias("clean"))


def names(spark: SparkSession, d: str) -> DataFrame:
    """Names made of permalinks, query words and rule keys."""
    link = F.concat(F.regexp_replace(F.lower("title"), " ", "-"), F.lit("-"), F.col("page_id").cast("string"))
    return _titles(spark, d).select("page_id", X.permalink_to_name(link).alias("name"), X.convert_to_query(F.col("title")).alias("query"), X.keyify(F.regexp_replace("title", " ", "_")).alias("rule_key"), X.matches_acronym(F.col("title"), F.lit("UV")).alias("uv"))


def url_codec(spark: SparkSession, d: str) -> DataFrame:
    """Titles in addresses and back."""
    e = X.url_encode(F.col("title"))
    return _titles(spark, d).select("page_id", e.alias("encoded"), F.url_decode(e).alias("decoded"))


def web_site(spark: SparkSession, d: str) -> DataFrame:
    """Home pages and handles as addresses."""
    p = table(spark, d, "page_nodes", "page_id", "home_page", "twitter").distinct()
    return p.select("page_id", X.web_site(F.col("home_page")).alias("site"), X.twitter_url(F.col("twitter")).alias("twitter"))


def image_path(spark: SparkSession, d: str) -> DataFrame:
    """Image paths of titles."""
    return _titles(spark, d).select("page_id", X.image_path(F.concat("title", F.lit(".jpg"))).alias("path"), X.image_name(F.concat("title", F.lit(".JPG more"))).alias("image"))


def date_render(spark: SparkSession, d: str) -> DataFrame:
    """Order dates in words."""
    o = table(spark, d, "orders", "o_orderkey", "o_orderdate")
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    return o.select("o_orderkey", X.date_string(F.dayofmonth("o_orderdate"), F.month("o_orderdate"), F.year("o_orderdate")).alias("by_parts"), X.iso_date_string(day).alias("by_day"), X.iso_date_string(F.substring(day, 1, 7)).alias("by_month"))


def entity_classes(spark: SparkSession, d: str) -> DataFrame:
    """Entity class of part types and names as categories."""
    p = table(spark, d, "part", "p_partkey", "p_name", "p_type")
    c = F.concat_ws(" ", F.when(F.col("p_partkey") % 5 == 0, "Living people of").when(F.col("p_partkey") % 5 == 1, "Software companies of").when(F.col("p_partkey") % 5 == 2, "States established in").when(F.col("p_partkey") % 5 == 3, "University alumni of"), "p_name")
    return p.select("p_partkey", X.entity_class(c).alias("entity"))


def topic_suggest(spark: SparkSession, d: str) -> DataFrame:
    """The first twenty titles of every prefix by their links."""
    w = table(spark, d, "page_nodes", "title", "inlinks").groupBy("title").agg(F.coalesce(F.max("inlinks"), F.lit(0)).alias("weight"))
    return spotting.prefix_topics(w.select(F.col("title").alias("topic"), "weight"))


def listing_pages(spark: SparkSession, d: str) -> DataFrame:
    """Titles on listing pages of fifty."""
    return spotting.listing_pages(_titles(spark, d).select("title"))


def _aliases(spark: SparkSession, d: str) -> DataFrame:
    pages = _titles(spark, d).select("title")
    r = table(spark, d, "raw_pages", "title", "redirect").distinct().filter("redirect is not null").select(F.col("title").alias("alias"), F.trim(F.translate("redirect", "_", " ")).alias("canonical")).filter("canonical <> ''")
    empty = spark.createDataFrame([], "alias string, canonical string")
    return spotting.alias_table(pages, r, empty, spark.createDataFrame([("this",), ("unknown",)], "word string"))


def alias_table(spark: SparkSession, d: str) -> DataFrame:
    """Titles and redirects as names of pages."""
    return _aliases(spark, d)


def entity_spotting(spark: SparkSession, d: str) -> DataFrame:
    """Names in the link texts of wiki_links."""
    s = table(spark, d, "wiki_links", "link_id", "alias").dropDuplicates(["link_id"]).filter("alias is not null").select(F.col("link_id").alias("id"), F.concat_ws(" ", F.lit("See"), "alias", F.lit("for more about it here")).alias("text"))
    return spotting.spot_entities(s, _aliases(spark, d))


def concept_frequency(spark: SparkSession, d: str) -> DataFrame:
    """How often documents mention each page."""
    t = table(spark, d, "documents", "doc_id", "title", "text").select(F.col("doc_id").alias("id"), "title", "text")
    return spotting.concept_frequency(t, _aliases(spark, d))


def near_spellings(spark: SparkSession, d: str) -> DataFrame:
    """Common names of graph add that are one edit from one of graph base, in lower case."""
    names = table(spark, d, "concept_docs", "graph", "body").select("graph", F.lower(F.try_variant_get(F.try_parse_json("body"), "$.common_name", "string")).alias("word")).filter("word <> ''").distinct()
    return spotting.near_spellings(names.filter("graph = 'add'").select("word"), names.filter("graph = 'base'").select("word"))


def phase1(spark: SparkSession, d: str) -> DataFrame:
    """Relations, aliases, descriptions and outlinks of all page sources."""
    return extraction.extract_relations(_sources(spark, d), F.col("title"), F.col("content"))


def parsed_pages(spark: SparkSession, d: str) -> DataFrame:
    """Section trees of all page sources."""
    return extraction.parse_pages(_sources(spark, d), F.col("title"), F.col("content")).select("title", "ok", F.length("sections").alias("size"))


def flat_links(spark: SparkSession, d: str) -> DataFrame:
    """Redirects, links and images of all page sources."""
    p = extraction.flat_links(_sources(spark, d), F.col("title"), F.col("content"))
    return p.select("title", "redirect", "ambiguous", F.size("outlinks").alias("outlinks"), F.size("images").alias("images"))


def plain_pages(spark: SparkSession, d: str) -> DataFrame:
    """Plain text of all pages that are no redirects."""
    return extraction.plain_pages(_sources(spark, d), F.col("title"), F.col("content"))


def source_links(spark: SparkSession, d: str) -> DataFrame:
    """Links of page sources by the plain scan."""
    return readers.dump_links(_sources(spark, d).select("title", F.col("content").alias("text")).filter("text is not null"))


def graph_build(spark: SparkSession, d: str) -> DataFrame:
    """Relations of the concept graph that all page sources give."""
    return jobs.build_graph(_sources(spark, d).select("title", F.col("content").alias("text")))["relations"]


def directory_relations(spark: SparkSession, d: str) -> DataFrame:
    """Relations of directory records that are made of suppliers, their nations and parts."""
    s, n = table(spark, d, "supplier", "s_suppkey", "s_name", "s_nationkey"), table(spark, d, "nation", "n_nationkey", "n_name")
    both = s.join(n, F.col("s_nationkey") == F.col("n_nationkey"))
    link = F.regexp_replace(F.lower("s_name"), "[^a-z0-9]+", "-")
    value = F.to_json(F.struct(F.col("s_name").alias("name"), (F.col("s_suppkey") % 60 + 1950).cast("int").alias("founded_year"), F.array(F.struct(F.col("n_name").alias("city"))).alias("offices"), F.array(F.struct(F.struct(F.lit("Rival").alias("name"), F.lit("rival-works").alias("permalink")).alias("competitor"))).alias("competitions")))
    return directory.relations(directory.parse_records(both.select(F.concat(F.lit("company/"), link).alias("key"), value.alias("value"))))


def stream_event_counts(spark: SparkSession, d: str) -> DataFrame:
    """Running counts of event types after the events have come as a stream of files."""
    root = f"{shared_folder(spark)}/stream-{uuid.uuid4().hex}"
    table(spark, d, "events", "event_id", "event_type", "ts").write.option("maxRecordsPerFile", 5000).parquet(f"{root}/in")
    stream = spark.readStream.schema("event_id long, event_type string, ts timestamp").option("maxFilesPerTrigger", 2).parquet(f"{root}/in")
    queues.running_counts(stream, "event_type", f"{root}/out", f"{root}/state").awaitTermination()
    return spark.read.parquet(f"{root}/out")


def token_index(spark: SparkSession, d: str) -> DataFrame:
    """Documents of every word of page titles."""
    return readers.token_index(_titles(spark, d), "page_id", "title")


_US = r"(?i)^((?:January|February|March|April|May|June|July|August|September|October|November|December|Jan|Feb|Mar|Apr|Jun|Jul|Aug|Sep|Oct|Nov|Dec)\s+\d{1,2}|\d{4}(?:\s+BC)?|\d+|\d+\s+\(number\)|January|February|March|April|May|June|July|August|September|October|November|December)$"
_AL = """al AS (SELECT alias, arg_min(canonical, (p, canonical)) AS canonical FROM (SELECT DISTINCT title AS alias, title AS canonical, 2 AS p FROM page_nodes WHERE lower(title) NOT IN ('this', 'unknown')
 UNION ALL SELECT DISTINCT title, trim(replace(redirect, '_', ' ')), 1 FROM raw_pages WHERE trim(replace(redirect, '_', ' ')) <> '') GROUP BY 1)"""

SQL = {
    "title_filter": rf"""SELECT page_id, NOT contains(title, ':') AND NOT regexp_matches(title, '{_US}') AS useful, regexp_matches(title, '[:#]|disambiguation|^\d{{4}}$|^\d{{4}} in|^(?:January|February|March|April|May|June|July|August|September|October|November|December)\b') AS invalid,
 regexp_matches(title, '^(Wikipedia:|Portal:|File:|MediaWiki:|Category:|UN/LOCODE:|Book:|Help:|P:|List of )') AS meta, len([w FOR w IN string_split_regex(title, '\s+') IF w = 'List' OR (regexp_matches(w, '^[a-z]') AND w NOT IN ('of', 'in', 'the', 'with', 'for', 'or', 'and'))]) = 0 AND len(string_split_regex(title, '\s+')) < 6 AS entity,
 CASE WHEN regexp_matches(upper(substr(title, 1, 1)), '^[A-Z0-9]$') THEN upper(substr(title, 1, 1)) ELSE '_' END AS bucket, CASE WHEN regexp_matches(title, '^[A-Z][a-z]') THEN lower(title) END AS lower_alias, CASE WHEN title LIKE '(%' THEN title ELSE regexp_replace(title, '\s*\([^(]+\)$', '') END AS short,
 replace(trim(title), '_', ' ') AS clean, regexp_replace(upper(title), '[^ A-Z0-9]', '', 'g') AS listing FROM (SELECT DISTINCT page_id, title FROM page_nodes)""",
    "clean_text": r"""SELECT doc_id, md5(regexp_replace(regexp_replace(replace(replace(regexp_replace(regexp_replace(trim(text), '<[^>]*>', '', 'g'), '\n', ' ', 'g'), '"', '&quot;'), '’', ''''), '[^\x00-\x7F]+', ' ', 'g'), '\s+', ' ', 'g')) AS clean FROM documents""",
    "url_codec": "SELECT page_id, replace(replace(replace(replace(replace(url_encode(title), '%28', '('), '%29', ')'), '%21', '!'), '%27', ''''), '%2A', '*') AS encoded, title AS decoded FROM (SELECT DISTINCT page_id, title FROM page_nodes)",
    "web_site": r"SELECT page_id, CASE WHEN regexp_matches(home_page, '(?i)^https?://[^.]+\.[^.]+') THEN lower(regexp_extract(home_page, '^([^/]*//[^/]*)', 1)) || substr(home_page, length(regexp_extract(home_page, '^([^/]*//[^/]*)', 1)) + 1) END AS site, CASE WHEN regexp_matches(twitter, '^\w+$') THEN 'http://twitter.com/' || twitter END AS twitter FROM (SELECT DISTINCT page_id, home_page, twitter FROM page_nodes)",
    "image_path": "WITH t AS (SELECT DISTINCT page_id, replace(title, ' ', '_') || '.jpg' AS n, title FROM page_nodes) SELECT page_id, '/' || substr(md5(n), 1, 1) || '/' || substr(md5(n), 1, 2) || '/' || n AS path, CASE WHEN regexp_matches(title, '^[ -~]+$') THEN title || '.JPG' END AS image FROM t",
    "date_render": "SELECT o_orderkey, strftime(o_orderdate, '%-d %B %Y') AS by_parts, strftime(o_orderdate, '%-d %B %Y') AS by_day, strftime(o_orderdate, '%B %Y') AS by_month FROM orders",
    "entity_classes": "SELECT p_partkey, CASE p_partkey % 5 WHEN 0 THEN 'person' WHEN 1 THEN 'nonperson' END AS entity FROM part",
    "topic_suggest": """WITH w AS (SELECT title AS topic, coalesce(max(inlinks), 0) AS weight FROM page_nodes GROUP BY 1), f AS (SELECT topic, weight, unnest([substr(lower(topic), 1, n) FOR n IN range(1, least(5, length(topic)) + 1)]) AS prefix FROM w)
SELECT prefix, CAST(row_number() OVER (PARTITION BY prefix ORDER BY weight DESC, topic) AS INTEGER) AS rank, topic FROM f QUALIFY rank <= 20""",
    "listing_pages": "WITH o AS (SELECT min(title) AS title FROM page_nodes WHERE title IS NOT NULL GROUP BY regexp_replace(upper(title), '[^ A-Z0-9]', '', 'g')), b AS (SELECT title, CASE WHEN regexp_matches(upper(substr(title, 1, 1)), '^[A-Z0-9]$') THEN upper(substr(title, 1, 1)) ELSE '_' END AS bucket FROM o), r AS (SELECT *, row_number() OVER (PARTITION BY bucket ORDER BY title) - 1 AS n FROM b) SELECT bucket, CAST(n // 50 AS INTEGER) AS page, CAST(n % 50 AS INTEGER) AS place, title FROM r",
    "alias_table": f"WITH {_AL} SELECT * FROM al",
    "directory_relations": """WITH s AS (SELECT s_name, regexp_replace(lower(s_name), '[^a-z0-9]+', '-', 'g') AS l, CAST(s_suppkey % 60 + 1950 AS VARCHAR) AS y, n_name FROM supplier JOIN nation ON s_nationkey = n_nationkey),
k AS (SELECT *, list_aggregate([CASE WHEN i = len(string_split(l, '-')) AND i > 1 AND regexp_matches(w, '^\\d+$') THEN '(' || w || ')' ELSE upper(substr(w, 1, 1)) || substr(w, 2) END FOR w, i IN string_split(l, '-')], 'string_agg', ' ') AS key FROM s),
r AS (SELECT key AS a, y AS b, 'FOUNDING_DATE' AS subcategory, '[[' || s_name || ']] was founded in [[' || y || ']]' AS snippet, 40 AS d1, 60 AS d2 FROM k UNION ALL SELECT key, n_name, 'LOCATION', '[[' || s_name || ']] has a location in [[' || n_name || ']]', 50, 60 FROM k UNION ALL SELECT key, 'Rival Works', 'COMPETITION', '[[' || s_name || ']] and [[Rival]] are competitors', 40, 40 FROM k)
SELECT a AS src, b AS dst, 'BUSINESS' AS category, subcategory, snippet, d1 AS distance FROM r UNION ALL SELECT b, a, 'BUSINESS', subcategory, snippet, d2 FROM r""",
    "stream_event_counts": "SELECT event_type, count(*) AS n FROM events GROUP BY 1",
    "source_links": r"""WITH p AS (SELECT DISTINCT page_id, title, content FROM raw_pages), l AS (SELECT title, unnest(regexp_extract_all(content, '\[\[([^:#\]|]+)[|\]]', 1)) AS target FROM p)
SELECT DISTINCT title, target FROM l WHERE NOT regexp_matches(title, '[:#]|disambiguation|^\d{4}$|^\d{4} in|^(January|February|March|April|May|June|July|August|September|October|November|December)\b') AND NOT regexp_matches(target, '[:#]|disambiguation|^\d{4}$|^\d{4} in|^(January|February|March|April|May|June|July|August|September|October|November|December)\b')""",
    # by characters, as the SQL function for edit distances counts bytes
    "near_spellings": """WITH n AS (SELECT DISTINCT graph, lower(body->>'$.common_name') AS word FROM concept_docs WHERE json_valid(body) AND body->>'$.common_name' <> ''),
g AS (SELECT graph, word, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest FROM (SELECT *, unnest(range(1, length(word) + 1)) AS i FROM n))
SELECT word, suggestion, CAST(1 AS INTEGER) AS distance FROM (SELECT x.word, y.word AS suggestion FROM g x JOIN g y ON x.graph = 'add' AND y.graph = 'base' AND x.i = y.i AND x.rest = y.rest AND x.word <> y.word
 UNION SELECT x.word, y.word FROM g x JOIN n y ON x.graph = 'add' AND y.graph = 'base' AND x.rest = y.word UNION SELECT y.word, x.word FROM g x JOIN n y ON x.graph = 'base' AND y.graph = 'add' AND x.rest = y.word)""",
    "token_index": r"SELECT DISTINCT unnest([t FOR t IN string_split_regex(lower(title), '[^\p{L}\p{N}]+') IF t <> '']) AS term, page_id FROM (SELECT DISTINCT page_id, title FROM page_nodes)",
}

QUERIES = {f.__name__: f for f in (title_filter, clean_text, names, url_codec, web_site, image_path, date_render, entity_classes, topic_suggest, listing_pages, alias_table, entity_spotting, concept_frequency, near_spellings, phase1, parsed_pages, flat_links, plain_pages, source_links, graph_build, directory_relations, stream_event_counts, token_index)}
