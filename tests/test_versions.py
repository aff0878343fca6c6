"""The structure store: versions, rewritten parts, readers beside writers."""

import pytest
from pyspark.sql import functions as F

from webwinnow.functions.text import structure_key
from webwinnow.schemas import STRUCTURE
from webwinnow.sources import structure as S
from webwinnow.sources import versions as V

T0, T1 = "2026-01-01T00:00:00+00:00", "2026-01-02T00:00:00+00:00"
PARTS = 32


def rows(spark, ids, as_of=T0, selector="main"):
    url = F.concat(F.lit("https://h.example/"), F.col("id"))
    given = {"key": structure_key(url), "url": url, "selector": F.lit(selector), "cached_at": F.lit(as_of).cast("timestamp")}
    return spark.createDataFrame([(i,) for i in ids], "id long").select(
        *[given.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in STRUCTURE.fields])


def urls(spark, ids):
    return spark.createDataFrame([(f"https://h.example/{i}",) for i in ids], "url string")


def seen(table):
    return sorted((r.key, r.selector) for r in table.collect())


@pytest.fixture
def store(spark, tmp_path):
    root = str(tmp_path / "store")
    V.create_store(spark, root, PARTS)
    assert V.upsert_store(spark, root, rows(spark, range(3000))) == 1
    return root


def rewritten(spark, root, version):
    return {r.part for r in V.history(spark, root).where(f"version = {version} and rewritten").collect()}


def folders(spark, root, version):
    return {r.part: r.folder for r in V.manifests(spark, root).where(f"version = {version}").collect()}


def test_an_upsert_rewrites_only_the_parts_of_its_keys(spark, store):
    """30 of 3,000 keys, all of them in two parts."""
    home = rows(spark, range(3000)).select("url", V.part_of(F.col("key"), PARTS).alias("part")).collect()
    ids = [int(r.url.rsplit("/", 1)[1]) for r in home if r.part in (5, 17)][:30]
    new = rows(spark, ids, T1, "article")
    want = seen(S.upsert_structure(rows(spark, range(3000)), new))
    assert V.upsert_store(spark, store, new) == 2
    assert rewritten(spark, store, 2) == {r.part for r in home if int(r.url.rsplit("/", 1)[1]) in ids} <= {5, 17}
    assert seen(V.read_store(spark, store)) == want
    before, after = folders(spark, store, 1), folders(spark, store, 2)
    assert all(before[p] == after[p] for p in range(PARTS) if p not in (5, 17))
    assert V.history(spark, store).where("version = 2").agg(F.sum("n_rows")).first()[0] == 3000


def test_old_rows_do_not_replace_newer_ones_and_repeated_rows_count_once(spark, store):
    V.upsert_store(spark, store, rows(spark, [1, 1, 2], T1, "newer"))
    V.upsert_store(spark, store, rows(spark, [1, 2, 2], T0, "older"))
    got = V.lookup_store(spark, store, urls(spark, [1, 2, 2, 99_999]))
    assert [r.selector for r in got.collect()] == ["newer", "newer"]
    assert V.read_store(spark, store).count() == 3000


def test_a_reader_keeps_its_version(spark, store):
    opened = V.read_store(spark, store)
    V.upsert_store(spark, store, rows(spark, range(3000, 3100)))
    V.invalidate_store(spark, store, urls(spark, range(50)))
    V.clear_store(spark, store)
    assert opened.count() == 3000
    assert [V.read_store(spark, store, v).count() for v in range(5)] == [0, 3000, 3100, 3050, 0]


def test_invalidate_and_clear(spark, store):
    assert V.invalidate_store(spark, store, urls(spark, [5000, 6000])) == 1  # unknown: nothing is written
    assert V.invalidate_store(spark, store, urls(spark, [])) == 1
    assert V.invalidate_store(spark, store, urls(spark, [7, 7, 5000])) == 2
    assert len(rewritten(spark, store, 2)) == 1 and V.lookup_store(spark, store, urls(spark, [7])).count() == 0
    assert V.clear_store(spark, store) == (3, 2999)
    assert V.clear_store(spark, store) == (4, 0)
    assert V.upsert_store(spark, store, rows(spark, [])) == 4
    assert V.upsert_store(spark, store, rows(spark, [7])) == 5 and seen(V.read_store(spark, store)) == seen(rows(spark, [7]))


def test_a_part_that_loses_all_rows_has_no_folder(spark, tmp_path):
    root = str(tmp_path / "one")
    V.create_store(spark, root, 4)
    V.upsert_store(spark, root, rows(spark, [1]))
    V.invalidate_store(spark, root, urls(spark, [1]))
    assert set(folders(spark, root, 2).values()) == {None} and V.read_store(spark, root).count() == 0


def test_lookups_open_only_their_parts(spark, store):
    got = V.lookup_store(spark, store, urls(spark, [1]))
    assert len({f.rsplit("part=", 1)[1].split("/")[0] for f in got.inputFiles()}) == 1
    assert len({f.rsplit("part=", 1)[1].split("/")[0] for f in V.read_store(spark, store).inputFiles()}) == PARTS


def test_only_committed_rows_are_seen_and_a_version_is_committed_once(spark, store):
    rows(spark, [9000]).withColumn("part", F.lit(0)).write.partitionBy("part").parquet(f"{store}/rows/stopped")
    assert V.read_store(spark, store).count() == 3000
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        V._commit(V.manifests(spark, store).where("version = 0").drop("version"), store, 1)
    with pytest.raises(ValueError, match="no whole version 9"):
        V.read_store(spark, store, 9)


def test_rows_without_a_key_and_extra_columns(spark, store):
    odd = rows(spark, [1]).withColumns({"key": F.lit(None).cast("string"), "url": F.lit(None).cast("string")})
    extra = odd.unionByName(odd).withColumns({"part": F.lit("x"), "_rank": F.lit(1), "version": F.lit(2), "n": F.lit(3)})
    V.upsert_store(spark, store, extra)
    assert V.read_store(spark, store).where("key is null").count() == 1 and V.read_store(spark, store).count() == 3001


def test_a_change_shuffles_rows_once(spark, store):
    """The latest row per key is taken where the part is written."""
    dealt = V.read_store(spark, store).withColumn("part", V.part_of(F.col("key"), PARTS)).repartition(PARTS, "part")
    newest = V.Window.partitionBy("part", "key").orderBy(F.desc("cached_at"))
    plan = dealt.withColumn("_rank", F.row_number().over(newest))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
