"""Writers of key-value tables, indexes, listings and versioned stores."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def put_all(pairs: DataFrame, path: str, seq: str = "seq") -> None:
    """Write a key-value table (key, value): of repeated keys the last by ``seq`` wins."""
    pairs.groupBy("key").agg(F.max_by("value", seq).alias("value")).write.mode("overwrite").parquet(path)


def write_pages_index(pages: DataFrame, path: str) -> None:
    """Lines 'id|title|0'."""
    pages.select(F.concat_ws("|", F.col("id").cast("string"), "title", F.col("ambiguous").cast("int").cast("string")).alias("value")).write.mode("overwrite").text(path)


def write_redirects_index(redirects: DataFrame, path: str) -> None:
    """Lines 'alias>target'."""
    redirects.select(F.concat_ws(">", "alias", F.col("target").cast("string")).alias("value")).write.mode("overwrite").text(path)


def write_link_counts(counts: DataFrame, path: str) -> None:
    """Lines 'title|inlinks'."""
    counts.select(F.concat_ws("|", "id", F.col("inlinks").cast("string")).alias("value")).write.mode("overwrite").text(path)


def write_topics(topics: DataFrame, path: str) -> None:
    """One topic a line by falling inlinks; the file order is the priority."""
    topics.orderBy(F.desc("inlinks"), "id").select(F.col("id").alias("value")).write.mode("overwrite").text(path)


def write_images_index(images: DataFrame, path: str) -> None:
    """Lines 'title|path'."""
    images.select(F.concat_ws("|", "title", "path").alias("value")).write.mode("overwrite").text(path)


def write_flat_links(links: DataFrame, path: str) -> None:
    """One link a line: 'src', a tab, 'target'."""
    links.select(F.concat_ws("\t", "src", "target").alias("value")).write.mode("overwrite").text(path)


def write_links(links: DataFrame, path: str) -> None:
    """Links, each pair once."""
    links.dropDuplicates(["src", "dst"]).write.mode("overwrite").parquet(path)


def write_parsed(parsed: DataFrame, good: str, bad: str) -> None:
    """Parsed pages as key-value rows, and the titles that failed with their errors beside them."""
    parsed.filter("ok").select(F.col("title").alias("key"), F.col("sections").alias("value")).write.mode("overwrite").parquet(good)
    parsed.filter(~F.col("ok")).select("title", "error").write.mode("overwrite").json(bad)


def html_page(title, text):
    """A plain HTML page: one paragraph a line."""
    return F.concat(F.lit("<html><head><title>"), title, F.lit("</title></head><body><p>"), F.regexp_replace(text, "\\n+", "</p><p>"), F.lit("</p></body></html>"))


def write_images_xml(images: DataFrame, path: str) -> None:
    """Image records as XML rows."""
    images.write.format("xml").option("rowTag", "image").option("rootTag", "images").mode("overwrite").save(path)


class Store:
    """A table in versions: a new one is written whole before readers are pointed to it, and the old one goes last."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def _fs(self):
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.root)
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()), self.spark._jvm.org.apache.hadoop.fs.Path

    def _versions(self) -> list[str]:
        fs, path = self._fs()
        if not fs.exists(path(self.root)):
            return []
        return sorted(s.getPath().getName() for s in fs.listStatus(path(self.root)) if s.getPath().getName().startswith("v") and fs.exists(path(f"{self.root}/{s.getPath().getName()}/_SUCCESS")))

    def persist(self, df: DataFrame, keep: int = 1) -> str:
        """Write the next version; older ones beyond ``keep`` are removed once it stands."""
        old = self._versions()
        name = f"v{(int(old[-1][1:9]) if old else 0) + 1:08d}-{uuid.uuid4().hex[:8]}"
        df.write.parquet(f"{self.root}/{name}")
        fs, path = self._fs()
        for v in old[: len(old) - keep + 1] if keep else old:
            fs.delete(path(f"{self.root}/{v}"), True)
        return name

    def load(self) -> DataFrame:
        """The latest complete version."""
        return self.spark.read.parquet(f"{self.root}/{self._versions()[-1]}")
