"""Envelopes written as ordered lines: no request is gathered."""

import json
from pathlib import Path

from pyspark.sql import functions as F

from webwinnow.sources import sinks

REQUESTS = "request_id long, urls array<string>"


def written(path):
    """One text per request folder: its files in the order of their names."""
    found = {}
    for folder in Path(path).glob("request_id=*"):
        files = sorted(folder.glob("part-*"), key=lambda f: f.name)
        found[int(folder.name.split("=")[1])] = (len(files), "".join(f.read_text() for f in files))
    return found


def item_rows(spark, n, request):
    at = F.col("id")
    return spark.range(n).select(
        F.lit(request).cast("long").alias("request_id"), (at * 7 % n).cast("int").alias("pos"),
        F.concat(F.lit("https://h.example/"), at).alias("url"),
        F.when(at % 3 == 0, F.lit('two\nlines, "quoted" ❌')).alias("error"),
    )


def test_a_large_request_is_written_in_order_over_many_files(spark, tmp_path):
    """100,000 items in one request beside small, empty and invalid ones."""
    requests = spark.createDataFrame([(0, ["a"]), (1, ["b"]), (2, []), (3, None), (4, ["c"])], REQUESTS)
    results = item_rows(spark, 100_000, 0).unionByName(item_rows(spark, 3, 1)).unionByName(item_rows(spark, 2, 99))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        sinks.write_envelopes(requests, results, str(tmp_path / "out"), "results")
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    got = written(tmp_path / "out")
    assert set(got) == {0, 1, 2, 3, 4} and got[0][0] > 1
    large = json.loads(got[0][1])
    assert large["success"] is True and len(large["results"]) == 100_000
    position = {i * 7 % 100_000: i for i in range(100_000)}
    assert [x["url"] for x in large["results"]] == [f"https://h.example/{position[p]}" for p in range(100_000)]
    assert large["results"][0]["error"] == 'two\nlines, "quoted" ❌'
    assert json.loads(got[4][1]) == {"success": True, "results": []}
    for request in (2, 3):
        assert json.loads(got[request][1]) == {"success": False, "error": "urls required (list of strings)"}


def test_lines_give_the_envelopes(spark):
    requests = spark.createDataFrame([(0, ["a"]), (1, ["b"]), (2, [])], REQUESTS)
    results = item_rows(spark, 8, 0).unionByName(item_rows(spark, 1, 1).withColumn("pos", F.lit(6)))
    lines = {}
    for r in sinks.envelope_lines(requests, results).orderBy("request_id", "place").collect():
        lines[r.request_id] = lines.get(r.request_id, "") + r.line
    assert lines == {r.request_id: r.envelope for r in sinks.request_envelopes(requests, results).collect()}


def test_digests_are_written_in_order_over_many_files(spark, tmp_path):
    results = item_rows(spark, 20_000, 0).unionByName(item_rows(spark, 1, 1)).withColumns(
        {"title": F.when(F.col("pos") % 2 == 0, F.lit("T")), "content": F.when(F.col("pos") % 5 > 0, F.lit("a\n\nb"))})
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        sinks.write_digests(results, str(tmp_path / "out"))
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    got = written(tmp_path / "out")
    assert got[0][0] > 1
    assert {k: text for k, (_, text) in got.items()} == {r.request_id: r.digest for r in sinks.extract_digest(results).collect()}


def test_no_requests(spark, tmp_path):
    none = spark.createDataFrame([], REQUESTS)
    sinks.write_envelopes(none, item_rows(spark, 2, 0), str(tmp_path / "out"))
    assert written(tmp_path / "out") == {}
