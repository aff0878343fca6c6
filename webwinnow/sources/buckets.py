"""Pages and structure stored in the same buckets of the structure key.

A crawl that is looked up again and again is written once, dealt by key. A structure table in the same layout then meets
it bucket by bucket: neither the html nor the structure is shuffled for a lookup, and only the buckets' structure rows,
which hold no html, are hashed. Keys whose pages add up to too many bytes for one bucket stay out of the buckets; their
pages lie beside them and are joined with salts.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from webwinnow import constants as K
from webwinnow.functions.text import structure_key
from webwinnow.plans.extract import STORED, extract
from webwinnow.plans.session import lookup_join
from webwinnow.sources.structure import fresh_structure, latest_structure

HOT_BYTES = 256 << 20


@dataclass(frozen=True)
class Layout:
    """Names of the tables, and the number of buckets that both share."""

    pages: str
    structure: str
    buckets: int

    @property
    def hot_pages(self) -> str:
        return f"{self.pages}_hot"


def _write(rows: DataFrame, name: str, buckets: int, path: str | None) -> None:
    writer = rows.repartition(buckets, "key").write.mode("errorifexists").bucketBy(buckets, "key")
    (writer.option("path", f"{path}/{name}") if path else writer).saveAsTable(name)


def write_pages(pages: DataFrame, layout: Layout, path: str | None = None, hot_bytes: int = HOT_BYTES) -> None:
    """Store ``(page_id, url, html)`` by key; keys of more than *hot_bytes* of html go to the table beside it.

    *path* is a folder that all executors share; without it the tables lie in the warehouse.
    """
    keyed = pages.withColumn("key", structure_key(F.col("url")))
    sizes = keyed.groupBy("key").agg(F.sum(F.coalesce(F.octet_length("html"), F.lit(0)).cast("long")).alias("bytes"))
    hot = sizes.where(F.col("bytes") > hot_bytes).select("key")
    _write(keyed.join(hot, "key", "left_anti"), layout.pages, layout.buckets, path)
    writer = keyed.join(hot, "key", "left_semi").write.mode("errorifexists")
    (writer.option("path", f"{path}/{layout.hot_pages}") if path else writer).saveAsTable(layout.hot_pages)


def write_structure(structure: DataFrame, layout: Layout, path: str | None = None) -> None:
    """Store the latest structure row of each key in the layout's buckets."""
    _write(latest_structure(structure), layout.structure, layout.buckets, path)


def stored_lookup(spark: SparkSession, layout: Layout, as_of: str, ttl_hours: int = K.STRUCTURE_TTL_HOURS):
    """A lookup of pages of the layout: rows of its buckets meet their structure without a shuffle."""
    stored = fresh_structure(spark.table(layout.structure), as_of, ttl_hours).select(
        "key", *[F.col(name).cast(kind).alias(f"stored_{name}") for name, kind in STORED.items()])
    # the structure's side of a bucket is hashed, so pages are neither sorted nor moved
    return lambda pages: pages.join(stored.hint("shuffle_hash"), "key", "left").drop("key")


def extract_stored(spark: SparkSession, layout: Layout, as_of: str, ttl_hours: int = K.STRUCTURE_TTL_HOURS, embeds: bool = True) -> DataFrame:
    """``extract`` of all pages of the layout with its structure: hits take the cached path."""
    cold, hot = spark.table(layout.pages), spark.table(layout.hot_pages)
    web = cold.unionByName(hot).drop("key")
    done = extract(cold, as_of, lookup=stored_lookup(spark, layout, as_of, ttl_hours), embeds=embeds, web=web)
    if hot.isEmpty():
        return done
    stored = fresh_structure(spark.table(layout.structure), as_of, ttl_hours).select(
        "key", *[F.col(name).cast(kind).alias(f"stored_{name}") for name, kind in STORED.items()])
    spread = extract(hot, as_of, lookup=lambda pages: lookup_join(pages, stored, "key", "page_id", hot_rows=0, population=hot.select("key")).drop("key"), embeds=embeds, web=web)
    return done.unionByName(spread)
