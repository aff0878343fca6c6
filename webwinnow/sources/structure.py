"""The structure table: per-URL selectors and scores, reused on the next crawl."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from webwinnow import constants as K
from webwinnow.functions.text import structure_key
from webwinnow.plans.extract import STORED
from webwinnow.plans.session import cut_lineage, lookup_join
from webwinnow.schemas import STRUCTURE

# A row with one of these missing is malformed and counts as a miss.
REQUIRED = (
    "url", "selector", "noise_selectors", "mapper_confidence", "scorer_confidence", "validator_confidence",
    "validation_pass", "scored_blocks_count",
)


def read_structure(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(STRUCTURE).parquet(path)


def fresh_structure(structure: DataFrame, as_of: str, ttl_hours: int = K.STRUCTURE_TTL_HOURS) -> DataFrame:
    """Rows that are well formed and not older than the time to live."""
    age = F.unix_micros(F.lit(as_of).cast("timestamp")) - F.unix_micros("cached_at")
    usable = age <= ttl_hours * 3_600_000_000
    for name in REQUIRED:
        usable = usable & F.col(name).isNotNull()
    return structure.where(usable)


def latest_structure(structure: DataFrame) -> DataFrame:
    """The last written row per key."""
    newest = Window.partitionBy("key").orderBy(F.desc("cached_at"), F.desc("url"))
    return structure.withColumn("_rank", F.row_number().over(newest)).where("_rank = 1").drop("_rank")


def lookup_structure(
    pages: DataFrame, structure: DataFrame, as_of: str, ttl_hours: int = K.STRUCTURE_TTL_HOURS,
    population: DataFrame | None = None,
) -> DataFrame:
    """Left join of pages to their stored structure, as ``stored_*`` columns (null = miss).

    ``population`` is the table *pages* was filtered from: hot URLs are counted
    there, on the URL column alone. Rows hold html, so a key is hot from 1,000 pages on.
    """
    stored = fresh_structure(latest_structure(structure), as_of, ttl_hours).select(
        "key", *[F.col(name).cast(kind).alias(f"stored_{name}") for name, kind in STORED.items()]
    )
    keyed = pages.withColumn("key", structure_key(F.col("url")))
    every = (pages if population is None else population).select(structure_key(F.col("url")).alias("key"))
    return lookup_join(keyed, stored, "key", "page_id", hot_rows=1_000, population=every).drop("key")


def structure_rows(extracted: DataFrame, as_of: str) -> DataFrame:
    """Structure rows of the cacheable full-path results."""
    m = F.col("metadata")
    cacheable = (
        F.col("error").isNull()
        & (F.coalesce(m["selector"], F.lit("")) != "")
        & m["empty_content"].isNull()
        & ~F.coalesce(m["structure_cache_hit"], F.lit(False))
    )
    return extracted.where(cacheable).select(
        structure_key(F.col("url")).alias("key"),
        "url",
        m["selector"].alias("selector"),
        "noise_selectors",
        *[m[name].alias(name) for name in (
            "mapper_confidence", "scorer_confidence", "validator_confidence", "validation_pass",
            "validation_warning", "scored_blocks_count",
        )],
        "scored_blocks",
        F.lit(as_of).cast("timestamp").alias("cached_at"),
    )


def upsert_structure(structure: DataFrame, rows: DataFrame) -> DataFrame:
    """Old and new rows, the latest per key."""
    return latest_structure(structure.unionByName(rows))


def next_structure(structure: DataFrame, extracted: DataFrame, as_of: str) -> DataFrame:
    """The table after a crawl: entries that had to be healed go, the crawl's cacheable rows come in.

    A page that stays thin is therefore not served from its starved entry again.
    """
    crawl = cut_lineage(extracted.select("url", "error", "metadata", "noise_selectors", "scored_blocks", "healed"))
    kept = invalidate_structure(structure, crawl.where("healed").select("url"))
    return upsert_structure(kept, structure_rows(crawl, as_of))


def invalidate_structure(structure: DataFrame, urls: DataFrame) -> DataFrame:
    """Drop the rows of the given URLs; unknown URLs change nothing."""
    keys = urls.select(structure_key(F.col("url")).alias("key")).distinct()
    return structure.join(keys, "key", "left_anti")


def clear_structure(structure: DataFrame) -> tuple[DataFrame, int]:
    """An empty table and the number of rows dropped."""
    return structure.limit(0), structure.count()


def write_structure(structure: DataFrame, path: str) -> None:
    """Write a new version of the table; *path* must be a new directory."""
    structure.write.mode("errorifexists").parquet(path)
