"""Deduplication of archives by blocks of files: payloads are neither shuffled nor read twice."""

import hashlib

import pytest
from pyspark.sql import functions as F

from webwinnow.llm import warc_revisits as W

PAGES = "page_id bigint, url string, html string"


def plain(rows, least):
    """Per page: bytes, digest, type, and the page that it refers to."""
    largest, out = {}, {}
    for page, _, html in rows:
        body = (html or "").encode()
        if len(body) >= least:
            largest[body] = max(largest.get(body, -1), page)
    for page, _, html in rows:
        body = (html or "").encode()
        first = largest.get(body, page)
        out[page] = (len(body), hashlib.sha1(body).hexdigest(), "response" if first == page else "revisit", None if first == page else first)
    return out


@pytest.fixture(scope="module")
def rows():
    """A third of all rows are one payload; others come in pairs, short ones repeat, some are null."""
    hot = [(i, f"https://h.example/{i}", "hot é" * 300) for i in range(0, 120, 3)]
    pairs = [(i, f"https://h.example/{i}", f"{i // 6} " * 500) for i in range(1, 120, 3)]
    rest = [(i, None if i % 2 else "u", [None, "short", "", f"<p>{i}</p>" * 200][i % 4]) for i in range(2, 120, 3)]
    return hot + pairs + rest


@pytest.fixture(scope="module")
def raw(spark, rows, tmp_path_factory):
    path = f"{tmp_path_factory.mktemp('warc')}/raw"
    pages = spark.createDataFrame(rows, PAGES).repartition(6)
    return W.write_responses(pages, path, W.Archive(records=5))


@pytest.mark.parametrize("verdicts", [1, 7, 500_000])
def test_blocks_of_files_give_the_same_archives(spark, rows, raw, tmp_path, verdicts):
    W.deduplicate(spark, raw, str(tmp_path / "out"), W.Archive(records=5, verdicts=verdicts))
    got = W.resolved(spark, str(tmp_path / "out")).collect()
    assert len(got) == len(rows)
    assert {r.page_id: (r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got} == plain(rows, 1000)


@pytest.mark.parametrize("size, joined", [(10, "BroadcastHashJoin"), (10**7, "SortMergeJoin")])
def test_payloads_are_joined_where_they_are_read(spark, raw, size, joined):
    """Without automatic broadcasts: a list of checked size is sent to the payloads, a longer one meets them by key."""
    verdicts = spark.createDataFrame([("a", "b", "c")], "record_id string, of string, original string")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = W._rewritten(spark, raw, verdicts, size, (0, 2), W.Archive())._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert joined in plan and ("Exchange hashpartitioning" in plan) is (joined == "SortMergeJoin")


def test_a_block_opens_only_its_files(spark, raw):
    opened = []
    for n in range(4):
        block = W._files(spark, raw, (n, 4))
        names = {r.file for r in block.select("file").collect()}
        leaf = block._jdf.queryExecution().executedPlan().collectLeaves().head()
        block._jdf.queryExecution().executedPlan().executeCollect()
        assert leaf.metrics().get("numFiles").get().value() == len(names)
        opened.append(names)
    every = {r.file for r in W._files(spark, raw, None).select("file").collect()}
    assert set.union(*opened) == every and sum(map(len, opened)) == len(every) > 12


def test_repeated_records_and_ids(spark, tmp_path):
    """A record id that comes twice, with one payload or with two, neither adds nor drops records."""
    body = "x" * 1500
    one = spark.createDataFrame([(1, "u", body), (2, "u", body), (3, "v", "y" * 1200)], PAGES)
    rows = one.select(
        F.lit("urn:same").alias("record_id"), "page_id", F.col("url").alias("uri"), F.sha1("html").alias("digest"),
        F.lit(None).cast("string").alias("refers_to"), F.col("html").alias("payload"))
    source = W._write(rows.select(W._record(F.lit("response"), F.col("payload")).alias("value")), str(tmp_path / "in"), W.Archive())
    W.deduplicate(spark, source, str(tmp_path / "out"))
    got = W.read_archives(spark, str(tmp_path / "out"), payloads=True).collect()
    assert sorted(int(r.page_id) for r in got) == [1, 2, 3]
    assert {r.page_id: r.payload for r in got} == {"1": body, "2": body, "3": "y" * 1200}
