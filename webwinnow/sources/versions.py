"""The structure table as a store of versions.

Rows lie in parts by the leading digits of their key. A version is a manifest: one row per part with the folder that
holds the part's rows, and their number. A change writes the parts it touches to a new folder and then the next
manifest, which names the old folders for all other parts. Files are neither changed nor removed, so a reader keeps the
version that it opened. A manifest is one file: its version is seen whole or not at all, and rows that a stopped job
left without a manifest are never read.

One writer at a time: the second one to commit the same version fails. A writer that dies within the commit leaves a
manifest folder without a file, which has to be removed before the next change.
"""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import Column, DataFrame, Row, SparkSession, Window, functions as F

from webwinnow.functions.text import structure_key
from webwinnow.plans.session import cut_lineage
from webwinnow.schemas import STRUCTURE
from webwinnow.sources.structure import latest_structure

MANIFEST = "part int, folder string, n_rows long, version long"


def part_of(key: Column, parts: int) -> Column:
    """Part of a key: the number in its first eight hexadecimal digits, modulo *parts*; 0 without a key."""
    number = F.conv(F.substring(key, 1, 8), 16, 10).cast("long")
    return F.coalesce(F.pmod(number, F.lit(parts)), F.lit(0)).cast("int")


def manifests(spark: SparkSession, root: str) -> DataFrame:
    """``(version, part, folder, n_rows)`` of all versions; a part without rows has no folder."""
    return spark.read.schema(MANIFEST).parquet(f"{root}/manifest").select("version", "part", "folder", "n_rows")


def history(spark: SparkSession, root: str) -> DataFrame:
    """``(version, part, n_rows, rewritten)``: rows of each part, and whether the version wrote the part anew."""
    before = F.lag("folder").over(Window.partitionBy("part").orderBy("version"))
    return manifests(spark, root).select("version", "part", "n_rows", (~F.col("folder").eqNullSafe(before)).alias("rewritten"))


def create_store(spark: SparkSession, root: str, parts: int = 256) -> int:
    """Version 0, without rows. *parts* holds for the store's life; a part's rows should fit one task."""
    none = spark.range(parts).select(
        F.col("id").cast("int").alias("part"), F.lit(None).cast("string").alias("folder"), F.lit(0).cast("long").alias("n_rows"))
    _commit(none, root, 0)
    return 0


def read_store(spark: SparkSession, root: str, version: int | None = None) -> DataFrame:
    """The rows of a version, by default the newest one."""
    return _rows(spark, root, _state(spark, root, version)[1])


def lookup_store(spark: SparkSession, root: str, urls: DataFrame, version: int | None = None) -> DataFrame:
    """The rows of the given URLs; parts that hold none of their keys are not read."""
    keys = urls.select(structure_key(F.col("url")).alias("key")).distinct()
    _, state = _state(spark, root, version)
    return _rows(spark, root, _touched(state, keys)).join(keys, "key", "left_semi")


def upsert_store(spark: SparkSession, root: str, rows: DataFrame) -> int:
    """The version in which *rows* are added, the latest row per key; without rows the present one."""
    at, state = _state(spark, root)
    incoming = cut_lineage(latest_structure(rows.select(*STRUCTURE.fieldNames())))
    touched = _touched(state, incoming)
    return _change(spark, root, at, state, touched, _rows(spark, root, touched).unionByName(incoming))


def invalidate_store(spark: SparkSession, root: str, urls: DataFrame) -> int:
    """The version without the rows of the given URLs; unknown URLs change nothing."""
    at, state = _state(spark, root)
    keys = cut_lineage(urls.select(structure_key(F.col("url")).alias("key")).distinct())
    known = _rows(spark, root, _touched(state, keys)).select("key").join(keys, "key", "left_semi")
    touched = _touched(state, known)
    return _change(spark, root, at, state, touched, _rows(spark, root, touched).join(keys, "key", "left_anti"))


def clear_store(spark: SparkSession, root: str) -> tuple[int, int]:
    """The version without any rows, and the number of rows dropped; no row is read for it."""
    at, state = _state(spark, root)
    none = manifests(spark, root).where(F.col("version") == at).select(
        "part", F.lit(None).cast("string").alias("folder"), F.lit(0).cast("long").alias("n_rows"))
    _commit(none, root, at + 1)
    return at + 1, sum(part.n_rows for part in state)


def _state(spark: SparkSession, root: str, version: int | None = None) -> tuple[int, list[Row]]:
    """A version and its manifest: one row per part, so no more than the store has parts."""
    known = manifests(spark, root)
    at = known.agg(F.max("version")).first()[0] if version is None else version
    state = known.where(F.col("version") == F.lit(at)).orderBy("part").collect()
    if [part.part for part in state] != list(range(len(state))) or not state:
        raise ValueError(f"{root} holds no whole version {at}")
    return at, state


def _touched(state: list[Row], keyed: DataFrame) -> list[Row]:
    """The parts that the keys fall into."""
    found = keyed.select(part_of(F.col("key"), len(state)).alias("part")).distinct().collect()
    return [state[part] for part in sorted(row.part for row in found)]


def _rows(spark: SparkSession, root: str, parts: list[Row]) -> DataFrame:
    paths = [f"{root}/rows/{part.folder}/part={part.part}" for part in parts if part.folder]
    return spark.read.schema(STRUCTURE).parquet(*paths) if paths else spark.createDataFrame([], STRUCTURE)


def _change(spark: SparkSession, root: str, at: int, state: list[Row], touched: list[Row], rows: DataFrame) -> int:
    """Write the touched parts, which hold *rows* from now on, and the next manifest."""
    if not touched:
        return at
    folder, numbers = uuid4().hex, [part.part for part in touched]
    newest = Window.partitionBy("part", "key").orderBy(F.desc("cached_at"), F.desc("url"))  # no second shuffle: dealt by part
    dealt = rows.withColumn("part", part_of(F.col("key"), len(state))).repartition(len(touched), "part")
    latest = dealt.withColumn("_rank", F.row_number().over(newest)).where("_rank = 1").drop("_rank")
    latest.write.mode("errorifexists").partitionBy("part").parquet(f"{root}/rows/{folder}")

    written = spark.read.schema("key string, part int").parquet(f"{root}/rows/{folder}").groupBy("part").agg(F.count(F.lit(1)).alias("n"))
    anew = F.col("part").isin(numbers)
    after = manifests(spark, root).where(F.col("version") == at).join(written, "part", "left").select(
        "part",
        F.when(anew, F.when(F.col("n") > 0, F.lit(folder))).otherwise(F.col("folder")).alias("folder"),
        F.when(anew, F.coalesce("n", F.lit(0))).otherwise(F.col("n_rows")).alias("n_rows"),
    )
    _commit(after, root, at + 1)
    return at + 1


def _commit(manifest: DataFrame, root: str, version: int) -> None:
    manifest.repartition(1).write.mode("errorifexists").parquet(f"{root}/manifest/version={version}")
