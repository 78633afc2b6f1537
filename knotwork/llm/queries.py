"""Queries p2, p5, p7, p8, p9 and p10 over the project tables, with SQL where it can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from knotwork.llm import encoding, linkage, markup, mixture, splitting, survivor
from knotwork.llm.bodies import NOTHING
from knotwork.sources.tables import table


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    """Elements of markup that page contents and link aliases hold."""
    pages = markup.find_elements(table(spark, d, "raw_pages", "page_id", "content"), F.col("page_id"), F.col("content"))
    links = markup.find_elements(table(spark, d, "wiki_links", "link_id", "alias"), F.col("link_id"), F.col("alias"))
    both = pages.withColumn("src", F.lit("raw_pages")).unionByName(links.withColumn("src", F.lit("wiki_links")))
    return both.select("src", F.col("row_id"), "element")


def p2_clean(spark: SparkSession, d: str) -> DataFrame:
    """Clean text of every page content and link alias."""
    pages = table(spark, d, "raw_pages", "page_id", "content").dropDuplicates(["page_id"])
    links = table(spark, d, "wiki_links", "link_id", "alias").dropDuplicates(["link_id"])
    pages = markup.clean_documents(pages, F.col("page_id"), F.col("content")).withColumn("src", F.lit("raw_pages"))
    both = pages.unionByName(markup.clean_documents(links, F.col("link_id"), F.col("alias")).withColumn("src", F.lit("wiki_links")))
    return both.select("src", "row_id", "text")


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    """Records of graph base and graph add about the same thing."""
    return linkage.link_rows(table(spark, d, "concept_docs", "concept_row", "graph", "concept_key", "body")).select("row_lo", "row_hi")


def p5_confidence(spark: SparkSession, d: str) -> DataFrame:
    """The same pairs with their confidence."""
    return linkage.link_rows(table(spark, d, "concept_docs", "concept_row", "graph", "concept_key", "body"))


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    """The record from which each field of a concept is taken."""
    return survivor.survivors(table(spark, d, "concept_docs", "concept_row", "graph", "concept_key", "source", "body", "updated_at"), table(spark, d, "source_trust"))


def p8_ids(spark: SparkSession, d: str) -> DataFrame:
    """Ids of every document by byte_bpe_50k."""
    return encoding.encode_corpus(table(spark, d, "documents", "doc_id", "text"), F.col("doc_id"), F.col("text"))


def p9_mixture(spark: SparkSession, d: str) -> DataFrame:
    """The records of the mixture with their number of copies."""
    docs = table(spark, d, "documents", "doc_id", "text", "source")
    return mixture.mix_sources(docs, F.col("doc_id"), F.col("text"), F.col("source"), table(spark, d, "mix_targets"))[0]


def p9_shares(spark: SparkSession, d: str) -> DataFrame:
    """Target and actual share of every source of the mixture."""
    docs = table(spark, d, "documents", "doc_id", "text", "source")
    return mixture.mix_sources(docs, F.col("doc_id"), F.col("text"), F.col("source"), table(spark, d, "mix_targets"))[1]


def p10_pieces(spark: SparkSession, d: str) -> DataFrame:
    """Every document as pieces of at most 2,000 tokens."""
    return splitting.split_documents(table(spark, d, "documents", "doc_id", "text"), F.col("doc_id"), F.col("text"))


def p10_found(spark: SparkSession, d: str) -> DataFrame:
    """Documents that the splitter cut."""
    return p10_pieces(spark, d).filter("pieces > 1 and piece = 0").select("doc_id")


_NOTHING = ", ".join("'" + " ".join("".join(c if c.isalnum() else " " for c in x).split()) + "'" for x in NOTHING)
_WORDS = r"trim(regexp_replace(lower({c}), '[^\p{{L}}\p{{N}}]+', ' ', 'g'))"
_REAL = f"{_WORDS} <> '' AND {_WORDS} NOT IN ({_NOTHING})"

SQL: dict[str, str] = {
    "p7_found": f"""
WITH r AS (SELECT DISTINCT concept_row, graph, lower(trim(replace(concept_key, '_', ' '))) AS k, source, body, updated_at FROM concept_docs),
g AS (SELECT graph, k, min(concept_row) AS group_row FROM r GROUP BY 1, 2 HAVING count(*) > 1),
m AS (SELECT group_row, concept_row, updated_at, coalesce(trust, -1) AS trust, body FROM r JOIN g ON g.graph = r.graph AND g.k = r.k LEFT JOIN source_trust t ON t.source = r.source WHERE json_valid(body) AND json_type(body) = 'OBJECT'),
c AS (SELECT *, 'common_name' AS field, length(trim(x)) AS size FROM (SELECT * EXCLUDE (body), body->>'$.common_name' AS x FROM m WHERE json_type(body, '$.common_name') = 'VARCHAR') WHERE {_REAL.format(c='x')}
 UNION ALL SELECT *, 'descriptions', length(x) FROM (SELECT * EXCLUDE (body), unnest(CASE json_type(body, '$.descriptions') WHEN 'ARRAY' THEN CAST(body->'$.descriptions' AS JSON[]) ELSE [] END)->>'$.text' AS x FROM m) WHERE {_REAL.format(c='x')}
 UNION ALL SELECT *, 'edges', 1 FROM (SELECT * EXCLUDE (body), unnest(json_keys(body, '$.edges')) AS x FROM m WHERE json_type(body, '$.edges') = 'OBJECT') WHERE {_REAL.format(c='x')}),
s AS (SELECT group_row, field, concept_row, updated_at, trust, sum(size) AS size FROM c GROUP BY ALL)
SELECT group_row, field, concept_row AS winner_row FROM s WINDOW w AS (PARTITION BY group_row, field) QUALIFY updated_at = max(updated_at) OVER w AND trust = max(trust) OVER w AND size = max(size) OVER w""",
}

QUERIES = {f.__name__: f for f in (p2_found, p2_clean, p5_found, p5_confidence, p7_found, p8_ids, p9_mixture, p9_shares, p10_pieces, p10_found)}
