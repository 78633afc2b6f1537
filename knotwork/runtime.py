"""Session helpers: size-checked broadcast, staged tables and skew-safe look-ups."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Largest estimated size, in bytes, of a side that may be broadcast.
BROADCAST_BYTES = 8 << 20
#: A key is hot when it holds more rows than this and more than 1/10,000 of all rows.
HOT_ROWS = 100_000


def get_spark(app: str = "knotwork", master: str | None = None, **conf: str) -> SparkSession:
    """A session with adaptive execution on; ``conf`` keys use ``__`` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.ui.enabled": "false",
    } | {k.replace("__", "."): str(v) for k, v in conf.items()}
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Give this package's code to all executors of the application, once; they need no copy of it on their path."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    root = Path(__file__).resolve().parent
    folder = tempfile.mkdtemp(prefix="knotwork-code-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    with zipfile.ZipFile(f"{folder}/{root.name}.zip", "w") as z:
        for f in sorted(root.rglob("*.py")):
            z.write(f, f.relative_to(root.parent))
    context.addPyFile(f"{folder}/{root.name}.zip")
    _shipped.add(context.applicationId)


def shared_folder(spark: SparkSession) -> str:
    """The folder that the cluster names in spark.checkpoint.dir; a temporary one only where it is unset."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    context = spark.sparkContext
    current = context._jsc.sc().getCheckpointDir()
    if current.isDefined():
        return current.get().rstrip("/")
    if context.master.split("[")[0] != "local":
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    made = tempfile.mkdtemp(prefix="knotwork-")
    atexit.register(shutil.rmtree, made, ignore_errors=True)
    context.setCheckpointDir(made)
    return context._jsc.sc().getCheckpointDir().get().rstrip("/")


def staged(df: DataFrame, *, partitions: int | None = None) -> DataFrame:
    """Write ``df`` as a table into the shared folder and read it again: cuts lineage and survives lost executors."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/staged-{uuid.uuid4().hex}"
    if partitions:
        df = df.coalesce(partitions)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def unstage(df: DataFrame) -> None:
    """Remove the files of a staged table that nothing reads any more."""
    spark = df.sparkSession
    for name in df.inputFiles()[:1]:
        folder = name.rsplit("/", 1)[0]
        if "/staged-" in folder:
            path = spark._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def estimated_bytes(df: DataFrame) -> int:
    """Catalyst's size estimate of a plan."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def small(df: DataFrame, limit: int = BROADCAST_BYTES) -> DataFrame:
    """``df`` with a broadcast hint when its estimated size is under ``limit``, else unchanged (a shuffled join)."""
    return F.broadcast(df) if estimated_bytes(df) <= limit else df


def hot_keys(df: DataFrame, key: Column, hot_rows: int = HOT_ROWS) -> tuple[DataFrame | None, int]:
    """Keys that hold over ``max(hot_rows, rows / 10,000)`` rows with their number of salts.

    At most 10,000 keys can pass that threshold, so the result has a proven bound and may be broadcast.
    Returns (None, 0) when no key is hot.
    """
    counts = df.groupBy(key.alias("hot_key")).count().filter(F.col("hot_key").isNotNull())
    total = counts.agg(F.sum("count").alias("n"), F.max("count").alias("m")).first()
    limit = max(hot_rows, (total["n"] or 0) // 10_000)
    if not total["m"] or total["m"] <= limit:
        return None, 0
    rows = counts.filter(F.col("count") > limit).withColumn("salts", F.ceil(F.col("count") / F.lit(limit)).cast("int")).drop("count").collect()
    return df.sparkSession.createDataFrame([tuple(r) for r in rows], counts.select("hot_key", F.lit(1).alias("salts")).schema), limit


def lookup_join(left: DataFrame, right: DataFrame, left_key: str, right_key: str, how: str = "left", hot_rows: int = HOT_ROWS) -> DataFrame:
    """Join a large skewed ``left`` to ``right`` with unique keys; hot keys of ``left`` are salted and their rows on the right repeated.

    Null keys match nothing; in a left join their rows pass by the join. Column names of both sides must differ.
    """
    if estimated_bytes(right) <= BROADCAST_BYTES:
        return left.join(F.broadcast(right), left[left_key] == right[right_key], how)
    if how == "left":  # rows without a key would all meet in one task
        nulls = left.filter(left[left_key].isNull()).select(*left.columns, *(F.lit(None).cast(f.dataType).alias(f.name) for f in right.schema.fields))
        return lookup_join(left.filter(left[left_key].isNotNull()), right, left_key, right_key, "left_outer", hot_rows).unionByName(nulls)
    hot, _ = hot_keys(left, F.col(left_key), hot_rows)
    if hot is None:
        return left.join(right, left[left_key] == right[right_key], how)
    hot = F.broadcast(hot)
    l = left.join(hot, left[left_key] == hot["hot_key"], "left").withColumn("_salt", F.when(F.col("salts").isNull(), F.lit(0)).otherwise((F.rand(7) * F.col("salts")).cast("int"))).drop("hot_key", "salts")
    r = right.join(hot, right[right_key] == hot["hot_key"], "left").withColumn("_rsalt", F.explode(F.sequence(F.lit(0), F.coalesce(F.col("salts"), F.lit(1)) - 1))).drop("hot_key", "salts")
    return l.join(r, (l[left_key] == r[right_key]) & (l["_salt"] == r["_rsalt"]), how).drop("_salt", "_rsalt")
