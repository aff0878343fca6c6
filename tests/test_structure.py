"""Structure table: cached path, expiry, healing, upsert; lookup joins under skew."""

import math

import pytest
from pyspark.sql import functions as F

from webwinnow.functions.text import structure_key
from webwinnow.operators import report
from webwinnow.plans.extract import extract
from webwinnow.plans import session
from webwinnow.plans.session import hot_hashes, lookup_join
from webwinnow.schemas import PAGES, STRUCTURE
from webwinnow.sources import buckets as B
from webwinnow.sources import structure as S

T0, T1 = "2026-01-01T00:00:00+00:00", "2026-01-02T00:00:00+00:00"
WORDS = "alpha beta, gamma delta, epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho. " * 4
HTML = {
    "links": f'<main><div><a href="/1">one linked line of words</a></div><p>{WORDS}</p></main>',
    "plain": f"<article><h1>T</h1><p>{WORDS}</p></article>",
    "thin": "<main>short text here</main>",
    "blank": "<title>B</title>",
    "bot": f"<title>Robot check</title><main>{WORDS}</main>",
}


def page_rows(spark, html, copies=1):
    rows = [(i, f"https://h.example/{n}", h) for i, (n, h) in enumerate(list(html.items()) * copies)]
    return spark.createDataFrame(rows, PAGES)


@pytest.fixture(scope="module")
def first(spark):
    return extract(page_rows(spark, HTML), T0, embeds=False).cache()


@pytest.fixture(scope="module")
def stored(first):
    return S.structure_rows(first, T0).cache()


def name(row):
    return row.url.rsplit("/", 1)[1]


def test_only_clean_results_are_stored(stored):
    rows = {name(r): r for r in stored.collect()}
    assert set(rows) == {"links", "plain"}
    assert rows["links"].noise_selectors == ["div"] and rows["links"].selector == "main"
    assert [b.selector for b in rows["links"].scored_blocks] == ["p", "div"]
    assert rows["links"].scored_blocks[1].link_density == 1.0


def test_cached_path_repeats_the_full_path(spark, first, stored):
    second = extract(page_rows(spark, HTML), T1, stored, embeds=False)
    a, b = ({name(r): r for r in df.collect()} for df in (first, second))
    for key in HTML:
        hit = key in ("links", "plain")
        assert bool(b[key].metadata.structure_cache_hit) is hit
        assert a[key].content.replace(T0, T1) == b[key].content and a[key].error == b[key].error
        for field in ("selector", "confidence", "pruned_static", "pruned_dynamic", "validation_pass", "text_length"):
            assert a[key].metadata[field] == b[key].metadata[field]
    assert b["links"].metadata.pipeline == "cached_structure->text->iframe->md->wrap"
    assert S.structure_rows(second, T1).count() == 0


def test_starved_hits_take_the_full_path(spark, stored):
    """One stored page is empty now, one holds few characters, one has lost its container."""
    changed = {"links": "", "plain": "<p>four</p>"}
    rows = {name(r): r for r in extract(page_rows(spark, changed), T1, stored, embeds=False).collect()}
    assert rows["links"].metadata.structure_cache_hit is False
    assert rows["links"].error == "Empty content extracted (0 chars) — page may be JS-rendered or blocked"
    assert rows["plain"].metadata.structure_cache_hit is False
    assert rows["plain"].error.startswith("Low content (4 chars)")
    moved = {"plain": f"<section><p>{WORDS}</p></section>"}
    row = extract(page_rows(spark, moved), T1, stored, embeds=False).collect()[0]
    assert row.metadata.structure_cache_hit is True and row.metadata.selector == "body" and row.error is None


def test_healed_entries_leave_the_table(spark, stored):
    """A page that moved its text is stored anew; one that stays thin is not served from the old entry again."""
    changed = {"links": "", "plain": f"<main><p>{WORDS}</p></main>"}
    crawl = extract(page_rows(spark, changed), T1, stored.withColumn("selector", F.lit("article")), embeds=False).cache()
    healed = {name(r) for r in crawl.where("healed").collect()}
    after = {name(r) for r in S.next_structure(stored, crawl, T1).collect()}
    assert "links" in healed and "links" not in after and "plain" in after


def test_challenge_page_is_not_healed(spark, stored):
    row = extract(page_rows(spark, {"plain": HTML["bot"]}), T1, stored, embeds=False).collect()[0]
    assert row.error == "Anti-bot challenge detected (title:robot)"


def structure_row(spark, url, cached_at, **changes):
    values = dict(
        key="", url=url, selector="main", noise_selectors=[], mapper_confidence=1.0, scorer_confidence=0.5,
        validator_confidence=0.2, validation_pass=3, validation_warning=None, scored_blocks_count=1,
        scored_blocks=[], cached_at=None,
    )
    values.update(changes)
    df = spark.createDataFrame([tuple(values[f.name] for f in STRUCTURE.fields)], STRUCTURE)
    return df.withColumns({"key": structure_key(F.lit(url)), "cached_at": F.lit(cached_at).cast("timestamp")})


def test_expiry_edge_and_malformed_rows(spark):
    table = (
        structure_row(spark, "fresh", "2026-01-01T00:00:00+00:00")
        .unionByName(structure_row(spark, "edge", "2025-12-25T00:00:00+00:00"))
        .unionByName(structure_row(spark, "expired", "2025-12-24T23:59:59.999+00:00"))
        .unionByName(structure_row(spark, "malformed", "2026-01-01T00:00:00+00:00", selector=None))
    )
    assert {r.url for r in S.fresh_structure(table, T0).collect()} == {"fresh", "edge"}


def test_upsert_invalidate_clear_and_storage(spark, tmp_path):
    old = structure_row(spark, "a", T0).unionByName(structure_row(spark, "b", T0))
    new = structure_row(spark, "a", T1, selector="article")
    table = S.upsert_structure(old, new)
    assert {(r.url, r.selector) for r in table.collect()} == {("a", "article"), ("b", "main")}
    S.write_structure(table, str(tmp_path / "v1"))
    again = S.read_structure(spark, str(tmp_path / "v1"))
    assert again.count() == 2
    urls = spark.createDataFrame([("a",), ("unknown",)], "url string")
    assert [r.url for r in S.invalidate_structure(again, urls).collect()] == ["b"]
    empty, dropped = S.clear_structure(again)
    assert (empty.count(), dropped) == (0, 2)


@pytest.mark.parametrize("hot_rows", [2, 10_000])
def test_lookup_join_keeps_every_row_under_skew(spark, hot_rows):
    left = spark.range(300).select(
        F.col("id").alias("page_id"), F.when(F.col("id") % 3 > 0, "hot").otherwise(F.col("id").cast("string")).alias("k")
    )
    right = spark.createDataFrame([("hot", 1), ("0", 2), ("nobody", 3)], "k string, v int")
    rows = lookup_join(left, right, "k", "page_id", hot_rows=hot_rows, fan_out=4).collect()
    assert sorted(r.page_id for r in rows) == list(range(300))
    assert {r.page_id: r.v for r in rows} == {i: 1 if i % 3 else 2 if i == 0 else None for i in range(300)}


def test_copies_of_a_url_all_get_their_structure(spark, stored):
    rows = extract(page_rows(spark, {"plain": HTML["plain"]}, copies=5), T1, stored, embeds=False).collect()
    assert len(rows) == 5 and all(r.metadata.structure_cache_hit for r in rows)


def test_filters_on_results_stay_cheap(first, spark):
    """A filter on derived columns is not expanded through the extraction."""
    df = extract(page_rows(spark, HTML), T0, embeds=False).where("error is null and metadata.confidence > 0.1")
    assert {name(r) for r in df.select("url").collect()} == {"links", "plain"}
    assert len(df._jdf.queryExecution().optimizedPlan().toString()) < 400_000


@pytest.mark.parametrize("outliers", [[], [1e300], [1e300, -1e300, 0.5]])
def test_median_ranges_are_even(spark, outliers):
    """A far outlier does not move the other values into one range."""
    values = spark.range(1, 200_001).select(F.col("id").cast("double").alias("v"))
    extra = spark.createDataFrame([(x,) for x in outliers], "v double")
    rows = values.unionByName(extra).select("v", F.lit("success").alias("status"))
    counts = report.value_counts(rows, ("v",))
    cuts = F.array(*[F.lit(k / 512) for k in range(1, 512)])
    whole = counts.groupBy("measure").agg(F.sum("n").alias("total"), F.percentile_approx("x", cuts, F.lit(10_240)).alias("splitters"))
    largest = report.dealt_ranges(counts, whole).groupBy("range").count().agg(F.max("count"), F.count("*")).first()
    assert largest[0] <= 0.01 * 200_000 and largest[1] >= 500
    got = report.overall_report(rows, ("v",)).first()
    everything = sorted([float(x) for x in range(1, 200_001)] + outliers)
    assert (got["median"], got["min"], got["max"]) == (everything[len(everything) // 2], everything[0], everything[-1])


def crawl_layout(spark, name, pages, structure, hot_bytes=B.HOT_BYTES):
    layout = B.Layout(f"{name}_pages", f"{name}_structure", 4)
    B.write_pages(pages, layout, hot_bytes=hot_bytes)
    B.write_structure(structure, layout)
    return layout


def test_bucketed_lookup_moves_no_html(spark):
    pages = page_rows(spark, HTML, 6).cache()
    stored = S.structure_rows(extract(pages.where("page_id < 5"), T0), T0).cache()
    layout = crawl_layout(spark, "cold", pages, stored)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        met = B.stored_lookup(spark, layout, T1)(spark.table(layout.pages))
        plan = met._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and "ShuffledHashJoin" in plan and "Sort " not in plan
        want = sorted(map(str, S.lookup_structure(pages, stored, T1).select(*sorted(met.columns)).collect()))
        assert sorted(map(str, met.select(*sorted(met.columns)).collect())) == want
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_keys_of_many_bytes_stay_out_of_the_buckets(spark):
    """Few rows, but wide ones: the key is hot by its bytes."""
    wide = [(100 + i, "https://h.example/wide", f"<article><p>{WORDS * 200}</p></article>") for i in range(8)]
    pages = page_rows(spark, HTML).unionByName(spark.createDataFrame(wide, PAGES))
    stored = S.structure_rows(extract(pages.where("page_id < 101"), T0), T0).cache()
    layout = crawl_layout(spark, "wide", pages, stored, hot_bytes=100_000)
    assert spark.table(layout.hot_pages).count() == 8 and spark.table(layout.pages).count() == len(HTML)
    got = B.extract_stored(spark, layout, T1).select("page_id", "content", "metadata", "error")
    want = extract(pages, T1, stored).select("page_id", "content", "metadata", "error")
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    assert got.where("page_id >= 100 and metadata.structure_cache_hit").count() == 8


def test_lookup_join_spreads_few_wide_rows(spark):
    """Eighty rows of 100 KB on one key: hot by bytes, though not by rows; each salt gets a part of them."""
    wide = F.when(F.col("id") < 80, F.repeat(F.lit("x"), 100_000)).otherwise("y")
    left = spark.range(400).select(F.col("id").alias("page_id"), F.when(F.col("id") < 80, "wide").otherwise(F.col("id").cast("string")).alias("k"), wide.alias("html"))
    right = spark.createDataFrame([("wide", 1), ("100", 2), ("nobody", 3), (None, 4)], "k string, v int")
    weigh, limit = F.octet_length("html"), 1 << 20
    assert [r["_h"] for r in hot_hashes(left, "k", 10_000, weigh, limit).collect()] == [spark.range(1).select(F.xxhash64(F.lit("wide"))).first()[0]]
    joined = lookup_join(left, right, "k", "page_id", fan_out=4, weigh=weigh, hot_bytes=limit)
    rows = joined.select("page_id", "v").collect()
    assert sorted(r["page_id"] for r in rows) == list(range(400))
    assert {r["page_id"]: r["v"] for r in rows if r["v"]} == {**{k: 1 for k in range(80)}, 100: 2}
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        shares = joined.where("v = 1").groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert len(shares) > 1 and max(r["count"] for r in shares) < 80


def test_list_of_hot_keys_is_bounded(spark, monkeypatch):
    """More hot keys than the list holds: the heaviest are salted, the others joined as they are, and no row is lost."""
    monkeypatch.setattr(session, "MOST_HOT", 3)
    left = spark.range(600).select(F.col("id").alias("page_id"), F.floor(F.sqrt("id")).cast("string").alias("k"))
    right = spark.range(30).select(F.col("id").cast("string").alias("k"), F.col("id").alias("v"))
    heaviest = {r["_h"] for r in hot_hashes(left, "k", 5, None, 1 << 20).collect()}
    assert heaviest == {r[0] for r in spark.createDataFrame([("23",), ("22",), ("21",)], "k string").select(F.xxhash64("k")).collect()}
    got = {r["page_id"]: r["v"] for r in lookup_join(left, right, "k", "page_id", hot_rows=5, fan_out=4).collect()}
    assert got == {k: math.isqrt(k) for k in range(600)}
