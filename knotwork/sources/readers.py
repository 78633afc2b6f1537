"""Readers of dumps, indexes, triples and key-value tables. Schemas are fixed; nothing is inferred."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

DUMP_SCHEMA = "title string, id long, revision struct<id: long, timestamp: string, text: struct<_VALUE: string>>"


def read_dump(spark: SparkSession, path: str) -> DataFrame:
    """(title, text) of the pages of an XML dump."""
    pages = spark.read.format("xml").option("rowTag", "page").schema("title string, revision struct<text: string>").load(path)
    return pages.select("title", F.col("revision.text").alias("text"))


def dump_links(pages: DataFrame) -> DataFrame:
    """(title, target) of the plain link scan over page texts, each once; titles and targets that are no articles are left out."""
    from knotwork.functions.titles import invalid_title

    found = pages.filter(~invalid_title(F.col("title"))).select("title", F.explode(F.regexp_extract_all("text", F.lit("\\[\\[([^:#\\]|]+)[|\\]]"), F.lit(1))).alias("target"))
    return found.filter(~invalid_title(F.col("target"))).distinct()


def _lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path)


def read_pages_index(spark: SparkSession, path: str) -> DataFrame:
    """(id, title, ambiguous) from lines 'id|title|0'; titles may hold '|'."""
    m = lambda k: F.regexp_extract("value", "^(\\d+)\\|(.*)\\|([01])$", k)
    return _lines(spark, path).filter(F.col("value").rlike("^\\d+\\|.*\\|[01]$")).select(m(1).cast("long").alias("id"), m(2).alias("title"), (m(3) == "1").alias("ambiguous"))


def read_redirects_index(spark: SparkSession, path: str) -> DataFrame:
    """(alias, target) from lines 'alias>target', cut at the first '>'; the target is an id or a title."""
    return _lines(spark, path).filter(F.col("value").contains(">")).select(F.substring_index("value", ">", 1).alias("alias"), F.expr("substring(value, instr(value, '>') + 1)").alias("target"))


def read_images_index(spark: SparkSession, path: str) -> DataFrame:
    """(title, path) from lines 'title|path'."""
    return _lines(spark, path).filter(F.col("value").contains("|")).select(F.substring_index("value", "|", 1).alias("title"), F.expr("substring(value, instr(value, '|') + 1)").alias("path"))


def read_flat_links(spark: SparkSession, path: str) -> DataFrame:
    """(src, target) from lines with one link each, cut at the first tab."""
    return _lines(spark, path).filter(F.col("value").contains("\t")).select(F.substring_index("value", "\t", 1).alias("src"), F.expr("substring(value, instr(value, '\t') + 1)").alias("target"))


def read_topics(spark: SparkSession, path: str) -> DataFrame:
    """(topic) of a list with one title a line."""
    return _lines(spark, path).filter("value <> ''").select(F.col("value").alias("topic"))


def read_packed_links(spark: SparkSession, path: str, fields: int = 4) -> DataFrame:
    """(src, dst, in_text, count) of packed little-endian 32-bit records; distances (fields=3) come as (src, dst, distance).

    Files are read whole, one a task; a cut record at the end is left out.
    """
    import numpy as np
    import pyarrow as pa

    names = ["src", "dst", "in_text", "count"] if fields == 4 else ["src", "dst", "distance"]

    def run(batches):
        for batch in batches:
            for content in batch.column(0).to_pylist():
                rows = np.frombuffer(content[: len(content) // (4 * fields) * 4 * fields], "<u4").reshape(-1, fields).astype("int64")
                yield pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(rows[:, k])) for k in range(fields)], names=names)

    return spark.read.format("binaryFile").load(path).select("content").mapInArrow(run, ", ".join(f"{n} long" for n in names))


def read_outlink_dictionary(pairs: DataFrame) -> DataFrame:
    """(src, target, count, in_text) from key-value rows title -> 'a|b|c'."""
    return pairs.select(F.col("key").alias("src"), F.explode(F.split("value", "[|]")).alias("target")).filter("target <> ''").select("src", "target", F.lit(1).alias("count"), F.lit(True).alias("in_text"))


def read_distance_dictionary(pairs: DataFrame) -> DataFrame:
    """(src, dst, distance) from key-value rows 'a|b' -> distance."""
    p = F.split("key", "[|]")
    return pairs.filter(F.size(p) == 2).select(p[0].alias("src"), p[1].alias("dst"), F.col("value").try_cast("int").alias("distance"))


def read_ranked(pairs: DataFrame, key: str, name: str) -> DataFrame:
    """(key, name, quality) from rows whose value is 'name|quality|name|quality'."""
    parts = F.split("value", "[|]")
    both = F.transform(F.sequence(F.lit(0), F.greatest(F.floor(F.size(parts) / 2).cast("int") - 1, F.lit(0))), lambda i: F.struct(F.get(parts, i * 2).alias("n"), F.get(parts, i * 2 + 1).try_cast("int").alias("q")))
    return pairs.select(F.col("key").alias(key), F.explode(both).alias("x")).select(key, F.col("x.n").alias(name), F.col("x.q").alias("quality")).filter("quality is not null")


def read_tsv_triples(spark: SparkSession, path: str) -> DataFrame:
    """(s, p, o, q) from tab-separated lines; q is null where there is no fourth part."""
    p = F.split(F.regexp_replace("value", "\\s+$", ""), "\\t+")
    return _lines(spark, path).filter(F.size(p) >= 3).select(p[0].alias("s"), p[1].alias("p"), p[2].alias("o"), F.get(p, F.lit(3)).alias("q"))


def read_ntriples_subjects(spark: SparkSession, path: str) -> DataFrame:
    """(title) of the different subjects of ontology triples."""
    from knotwork.functions.titles import resource_title

    return _lines(spark, path).select(resource_title(F.col("value")).alias("title")).filter("title is not null").distinct()


def read_jdbc_range(spark: SparkSession, url: str, table: str, key: str, step: int = 1000, most: int = 2000, **options: str) -> DataFrame:
    """A relational table in ranges of ``step`` ids: bounds are asked first, every range is one partition; wider ranges where there would be over ``most``."""
    base = spark.read.format("jdbc").option("url", url).options(**options)
    low, high = base.option("query", f"SELECT MIN({key}) AS a, MAX({key}) AS b FROM {table}").load().first()
    parts = min(most, max(1, -(-(int(high or 0) - int(low or 0) + 1) // step)))
    return base.option("dbtable", table).option("partitionColumn", key).option("lowerBound", int(low or 0)).option("upperBound", int(high or 0) + 1).option("numPartitions", parts).load()


def token_index(df: DataFrame, key: str, text: str) -> DataFrame:
    """(term, key): the inverted index of a text column, for equi-joins with search terms."""
    return df.select(F.col(key), F.explode(F.array_distinct(F.filter(F.split(F.lower(text), "[^\\p{L}\\p{N}]+"), lambda t: t != ""))).alias("term")).select("term", key)


def parse_list(value, sep: str = "[|]"):
    """A delimited argument as an array; empty parts are kept."""
    return F.split(value, sep)


def json_list(value):
    """A JSON array of strings as an array."""
    return F.from_json(value, "array<string>")


def json_map(value):
    """A JSON object of strings as a map."""
    return F.from_json(value, "map<string,string>")


def zone_rules(lines: DataFrame) -> DataFrame:
    """(zone, name, value) from lines 'zone|json object'."""
    return lines.select(F.substring_index("value", "|", 1).alias("zone"), F.explode(json_map(F.expr("substring(value, instr(value, '|') + 1)"))).alias("name", "value"))


def random_pairs(nodes: DataFrame, n: int, seed: int = 7) -> DataFrame:
    """(a, b): n random pairs of nodes (id), the same for the same seed; a sampling operator."""
    from pyspark.sql import Window

    order = F.xxhash64("id", F.lit(seed))
    top = nodes.select("id", order.alias("h")).orderBy("h", "id").limit(2 * n)
    ranked = top.withColumn("k", F.row_number().over(Window.orderBy("h", "id")) - 1)
    return ranked.groupBy(F.floor(F.col("k") / 2).alias("p")).agg(F.min_by("id", "k").alias("a"), F.max_by("id", "k").alias("b"), F.count("*").alias("c")).filter("c = 2").select("a", "b")
