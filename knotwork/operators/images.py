"""Image records: which exist, which are new, and their categories."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from knotwork.functions.text import category_image, image_path


def existing_images(names: DataFrame, stored: DataFrame) -> DataFrame:
    """Rows (name, …) whose image is stored (name)."""
    return names.join(stored.select("name").distinct(), "name", "left_semi")


def new_images(names: DataFrame, known: DataFrame) -> DataFrame:
    """Different names that are not known yet (processed or waiting)."""
    return names.select("name").filter("name is not null").distinct().join(known.select("name"), "name", "left_anti")


def image_records(pages: DataFrame, categories: DataFrame) -> DataFrame:
    """(page, title, path, categories) of image pages (page, title); categories are (page, category), sorted and joined."""
    sets = categories.groupBy("page").agg(F.array_join(F.sort_array(F.collect_set("category")), "|").alias("categories"))
    return pages.filter(category_image(F.col("title"))).select("page", "title", image_path(F.col("title")).alias("path")).join(sets, "page", "left")
