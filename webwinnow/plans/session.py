"""Session helpers: recommended settings, lineage cuts, skew-safe lookup joins."""

from __future__ import annotations

import re
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

import webwinnow

# Pages are wide rows, so Python batches are kept short; AQE sizes the shuffles.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.maxRecordsPerBatch": "256",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(32 << 20),
    "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "1m",  # wide rows: filter before a shuffle
    "spark.sql.session.timeZone": "UTC",
}


def ship(spark: SparkSession) -> None:
    """Send this package to the Python workers of all executors, once per Spark context."""
    context = spark.sparkContext
    if getattr(ship, "sent_to", None) == context.applicationId:
        return
    root = Path(webwinnow.__file__).resolve().parent
    archive = Path(tempfile.mkdtemp(prefix="webwinnow-")) / "webwinnow.zip"
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as out:
        for file in sorted(root.rglob("*.py")):
            out.write(file, file.relative_to(root.parent))
    context.addPyFile(str(archive))
    ship.sent_to = context.applicationId


def configure(spark: SparkSession) -> SparkSession:
    """Apply the recommended runtime settings to a session and ship the package to its executors."""
    ship(spark)
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def spread(table: DataFrame) -> DataFrame:
    """*table* dealt to ``spark.webwinnow.readSplits`` tasks where that is set, else as its files are split.

    For tables of few row groups whose rows are costly; a large table has splits enough and needs no shuffle.
    """
    splits = table.sparkSession.conf.get("spark.webwinnow.readSplits", None)
    return table.repartition(int(splits)) if splits else table


def cut_lineage(df: DataFrame) -> DataFrame:
    """*df* written to the checkpoint folder and read back, by a job that runs now.

    The folder is ``spark.checkpoint.dir``, which has to be storage that all executors share.
    """
    shared_folder(df.sparkSession)
    return df.checkpoint()


def shared_folder(spark: SparkSession) -> str:
    """The checkpoint folder: ``spark.checkpoint.dir``; a temporary one where it is unset, on a local master only."""
    context = spark.sparkContext
    if not context.getCheckpointDir():
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if not folder and re.match(r"local(\[|$)", context.master) is None:
            raise ValueError("spark.checkpoint.dir has to name storage that all executors share")
        context.setCheckpointDir(folder or tempfile.mkdtemp(prefix="webwinnow-"))
    return context.getCheckpointDir()


#: Entries of the list of hot keys that joins broadcast: hashes of eight bytes, so it stays under a few MB at any size.
MOST_HOT = 100_000


def hot_hashes(table: DataFrame, key: str, hot_rows: int, weigh: Column | None, hot_bytes: int) -> DataFrame:
    """``(_h)``: hashes of the keys of more than *hot_rows* rows, or more than *hot_bytes* by *weigh*; heaviest first.

    At most ``MOST_HOT`` of them; the order is total, so each evaluation gives the same list.
    """
    size = F.sum(weigh.cast("long")) if weigh is not None else F.lit(0)
    sizes = table.groupBy(F.xxhash64(key).alias("_h")).agg(F.count("*").alias("n"), F.coalesce(size, F.lit(0)).alias("bytes"))
    hot = sizes.where((F.col("n") > hot_rows) | (F.col("bytes") > hot_bytes))
    return hot.orderBy(F.desc("bytes"), F.desc("n"), "_h").limit(MOST_HOT).select("_h", F.lit(True).alias("_hot"))


def lookup_join(
    left: DataFrame, right: DataFrame, key: str, spread_by: str,
    hot_rows: int = 10_000, fan_out: int = 64, population: DataFrame | None = None,
    weigh: Column | None = None, hot_bytes: int = 256 << 20,
) -> DataFrame:
    """Left join onto *right*, which has one row per *key*, without piling hot keys on one task.

    Keys with more than ``hot_rows`` left rows, or more than ``hot_bytes`` by ``weigh`` (a column of bytes per row), are
    found by a pre-aggregated sum; their left rows spread over ``fan_out`` salts and only their right rows are repeated.
    The broadcast list of their hashes is bounded by ``MOST_HOT``; keys beyond it are joined without salts, where adaptive
    execution splits skewed partitions. ``population`` may name a table, cheaper to read than *left*, that holds all of
    its keys (and what ``weigh`` reads).
    """
    hot = hot_hashes(left if population is None else population, key, hot_rows, weigh, hot_bytes)

    def marked(df):
        return df.join(F.broadcast(hot), F.xxhash64(df[key]) == F.col("_h"), "left").drop("_h")

    # a null key matches nothing, so its rows may go anywhere
    salt = F.when(F.col("_hot") | F.col(key).isNull(), F.pmod(F.xxhash64(spread_by), F.lit(fan_out)).cast("int")).otherwise(0)
    salts = F.when(F.col("_hot"), F.sequence(F.lit(0), F.lit(fan_out - 1))).otherwise(F.array(F.lit(0)))
    salted = marked(left).withColumn("_salt", salt).drop("_hot")
    repeated = marked(right).withColumn("_salt", F.explode(salts)).drop("_hot")
    return salted.join(repeated, [key, "_salt"], "left").drop("_salt")
