"""Scalar text functions, score formulas, gates, search and reports."""

import hashlib
import json

import pytest
from pyspark.sql import functions as F

from webwinnow.functions import scores
from webwinnow.functions import text as tx
from webwinnow.operators import quality, report, search
from webwinnow.plans.catalog import AS_OF
from webwinnow.schemas import HITS, PAGES
from webwinnow.sources import sinks
from webwinnow.sources.pages import explode_request, read_pages, requested_pages


@pytest.fixture(scope="module")
def apply(spark):
    def run(function, values):
        df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, x string")
        return [r[0] for r in df.select("i", function(F.col("x")).alias("y")).orderBy("i").select("y").collect()]

    return run


def test_language(apply):
    texts = ["the cat and the dog", "yang ini dan itu", "the dan", "", "zzz", " \n the " + "x " * 200 + "and or for dan yang",
             "dan, the"]
    assert apply(tx.language, texts) == ["en", "id", "unknown", "unknown", "unknown", "en", "en"]


def test_quality_score_steps(apply):
    sizes = [0, 1, 49, 50, 199, 200, 999, 1000, 2000, 2500]
    expected = [0.0, 0.2, 0.2, 0.5, 0.5, 0.7, 0.7, 1000 / 2000 * 0.8 + 0.2, 1.0, 1.0]
    assert apply(tx.quality_score, [" ".join(["w"] * n) for n in sizes]) == expected
    assert apply(tx.quality_score, [" \n"]) == [0.2]


def test_boilerplate(apply):
    text = "keep\nOur COOKIE \t policy\nWe use cookies\nGDPR\r\nads\nAdvertisement here\n"
    assert apply(tx.remove_boilerplate, [text, "", "a\n\nb\n"]) == ["keep\nads\n", "", "a\n\nb\n"]


def test_main_paragraphs(apply):
    assert apply(tx.main_paragraphs, ["x" * 51 + "\n\n" + "y" * 50 + "\n\n " + "z" * 51]) == ["x" * 51 + "\n\n " + "z" * 51]


def test_titles(apply):
    pages = ["<TITLE a=b> A\n B </TITLE><title>c</title>", "<title></title><h1>x</h1>", "<h1 k>a <b>b</b>\n</h1>", "<p>"]
    assert apply(tx.title_from_html, pages) == ["A B", "", "a b", ""]
    texts = ["abc\n  abcd  \nx", "# head\r\n title two", "y" * 300, "", "ab\u000bcdef"]
    assert apply(tx.title_from_text, texts) == ["abcd", "title two", "y" * 200, "", "cdef"]


def test_key_schema_and_escape(apply):
    url = "https://a.example/?q=1"
    assert apply(tx.structure_key, [url]) == [hashlib.sha256(url.encode()).hexdigest()[:16]]
    marks = ['<p itemtype="https://schema.org/X">', "<p ITEMTYPE='http://schema.org/'>", '{"@type" : "A"}', "x", None]
    assert apply(tx.has_schema, marks) == [True, True, True, False, False]
    assert apply(tx.escape_markup, ["a & <b>"]) == ["a & <b>"]
    assert apply(lambda c: tx.escape_markup(c, True), ["a & <b>"]) == ["a &amp; &lt;b&gt;"]


BLOCKS = {
    "b1": ("div.article", 500, 5, 10, 3), "b2": ("nav.links", 30, 2, 25, 0),
    "b3": ("span.tiny", 10, 1, 0, 0), "b4": ("p.para", 100, 2, 5, 1),
    "short_p": ("p", 14, 1, 14, 0), "long_p": ("p", 15, 1, 15, 0), "none": ("div", 0, 0, 0, 0),
}


def test_block_formulas(spark):
    df = spark.createDataFrame([(k, *v) for k, v in BLOCKS.items()], "id string, s string, t int, g int, l int, c int")
    df = df.withColumns({
        "score": scores.block_score(F.col("t"), F.col("g"), F.col("l"), F.col("c")),
        "ld": scores.link_density(F.col("t"), F.col("l")), "td": scores.text_density(F.col("t"), F.col("g")),
    }).withColumn("noise", scores.is_likely_noise(F.col("s"), F.col("t"), F.col("ld"), F.col("score")))
    rows = {r.id: r for r in df.collect()}
    assert [round(rows[b].score, 6) for b in ("b1", "b2", "b3", "b4")] == [1.116667, 0.016667, 0.0, 0.416667]
    assert {k: r.noise for k, r in rows.items()} == {
        "b1": False, "b2": True, "b3": False, "b4": False, "short_p": True, "long_p": False, "none": False}
    assert rows["b2"].ld == 25 / 30 and rows["none"].td == 0.0


@pytest.mark.parametrize("names, expected", [
    (("b1", "b4"), 0.336), (("b2", "b3"), 0.006), (("b1", "b2", "b4"), 0.259), (("b1", "b2", "b3"), 0.237),
    (("b1", "b2", "b3", "b4"), 0.219), ((), 0.0),
])
def test_scorer_confidence(spark, names, expected):
    from webwinnow.operators.scorer import confidence

    values = {"b1": 67 / 60, "b2": 1 / 60, "b3": 0.0, "b4": 5 / 12}
    row = spark.createDataFrame(
        [([(values[n], BLOCKS[n][1]) for n in names],)], "blocks array<struct<score:double,text_length:int>>"
    )
    assert row.select(confidence(F.col("blocks"))).first()[0] == expected


def test_round3_matches_python(spark):
    values = [i / 10000 + j * 0.0005 for i in range(0, 3000, 7) for j in range(3)] + [0.0005, 0.0015, 1.0005, 2.6745, 0.4505, 12.3455]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    for x, y in df.select("x", scores.round3(F.col("x"))).collect():
        assert y == round(x, 3), x


def test_gates(spark, apply):
    leaks = ["var a = 1", "var a = 1; let b = 2; const c = 3", "var a = 1; let b = 2; const c = 3; function f (", "  ", None]
    failures = apply(quality.text_gate, leaks)
    assert failures == [
        None, None, "ZeroNoiseAssertionGate (text): 4 noise patterns detected", "Text is empty after extraction",
        "Text is empty after extraction"]
    good = "<extraction_result>\n<main_body>\n# T\nx\n</main_body>\n</extraction_result>\n"
    cases = [good, good.replace("<extraction", "<e"), good.replace("</extraction_result>", ""), good.replace("# T", "#T"),
             good.replace("# T\nx", ""), good.replace("<main_body>", ""), good.replace("</main_body>", ""),
             good.replace("<main_body>", "</main_body>", 1).replace("x\n</main_body>", "x\n<main_body>"),
             "pre " + good, good + "post"]
    assert apply(quality.boundary_gate, cases) == [
        None, "XML: missing <extraction_result> opening tag", "XML: missing </extraction_result> closing tag",
        "ZeroNoiseAssertionGate (XML): <main_body> has no Markdown heading", "XML: <main_body> is empty",
        "XML: missing <main_body> opening tag", "XML: missing </main_body> closing tag", "XML: malformed <main_body>",
        "XML: missing <extraction_result> opening tag", None]
    assert apply(quality.main_body, [good]) == ["# T\nx"]


HIT_ROWS = [
    ("q", 1, "a", "u1", "d1", 1.0), ("q", 2, "b", "u2", "", 3.0), ("q", 3, None, "u3", None, None),
    ("q", 4, "d", "u4", "d4", 3.0), ("r", 1, "e", "u5", "d5", -1.0), ("r", 2, "f", "u6", "d6", None),
]


def test_search_topk_and_digest(spark):
    hits = spark.createDataFrame(HIT_ROWS, HITS)
    top = search.topk_hits(hits, 3)
    assert [(r.query, r.position, r.url) for r in top.orderBy("query", "position").collect()] == [
        ("q", 1, "u2"), ("q", 2, "u4"), ("q", 3, "u1"), ("r", 1, "u6"), ("r", 2, "u5")]
    assert search.topk_hits(hits, 0).count() == 0 and search.topk_hits(hits, 25).count() == 6
    per_row = search.topk_hits(hits.withColumn("limit", F.when(F.col("query") == "q", 1).otherwise(5)), None)
    assert per_row.count() == 3
    asked = spark.createDataFrame([("q",), ("z",)], "query string")
    texts = {r["query"]: r.digest for r in search.search_digest(asked, search.topk_hits(hits, 2)).collect()}
    assert texts["z"] == "No results found."
    assert texts["q"] == "## Search Results: q\n\n### 1. [b](u2)\n*No description*\n\n### 2. [d](u4)\nd4\n"
    plan = top._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2  # bounded before and after the shuffle


def test_search_requests(spark):
    rows = spark.createDataFrame([("q", 50), ("", 3), (None, None), ("x", None)], "query string, limit int")
    assert [(r["limit"], r.error) for r in search.search_requests(rows).collect()] == [
        (20, None), (3, "query required (string)"), (5, "query required (string)"), (5, None)]


def test_reports(spark):
    rows = spark.createDataFrame(
        [("a", "success", 0.1, 1), ("a", "success", 0.4, 2), ("a", "error", 0.9, 3), ("b", "error", 0.5, 0),
         ("c", "success", 0.2, 3), ("c", "success", 0.3, 0)],
        "category string, status string, confidence double, validation_pass int",
    )
    by = {r.category: r for r in report.category_report(rows).collect()}
    assert (by["a"].ok, by["a"].fail, round(by["a"].rate, 6), by["a"].avg_confidence) == (2, 1, 66.666667, 0.25)
    assert (by["b"].ok, by["b"].rate, by["b"].avg_confidence) == (0, 0.0, 0.0)
    total = report.overall_report(rows, ("confidence",)).first()
    assert (total["min"], total["max"], total["mean"], total["median"]) == (0.1, 0.4, 0.25, 0.3)
    histogram = {r.validation_pass: (r.n, r.percent) for r in report.pass_histogram(rows).collect()}
    assert histogram == {1: (1, 25.0), 2: (1, 25.0), 3: (1, 25.0)}
    nobody = report.pass_histogram(rows.where("false")).collect()
    assert [(r.n, r.percent) for r in nobody] == [(0, 0.0)] * 3


def test_requests_envelopes_and_digests(spark, tmp_path):
    pages = spark.createDataFrame(
        [(1, "u1", "old"), (2, "u1", "new"), (3, "u2", "two"), (4, "u3", "no")], PAGES)
    asked = spark.createDataFrame([(7, ["u2", "u1", "missing", "u2"]), (8, []), (9, None)], "request_id long, urls array<string>")
    urls = explode_request(asked)
    found = requested_pages(urls, pages).orderBy("pos").collect()
    assert [(r.pos, r.url, r.html) for r in found] == [
        (0, "u2", "two"), (1, "u1", "new"), (2, "missing", None), (3, "u2", "two")]
    assert [r.pos for r in requested_pages(urls, pages, cap=2).orderBy("pos").collect()] == [0, 1]
    items = requested_pages(urls, pages).select(
        F.lit(7).alias("request_id"), "pos", "url", F.lit("T").alias("title"), F.col("html").alias("content"),
        F.when(F.col("html").isNull(), "Failed to open tab").alias("error"))
    texts = {r.request_id: json.loads(r.envelope) for r in sinks.request_envelopes(asked, items).collect()}
    assert texts[8] == texts[9] == {"success": False, "error": "urls required (list of strings)"}
    assert [i["url"] for i in texts[7]["data"]] == ["u2", "u1", "missing", "u2"]
    assert texts[7]["data"][0] == {"url": "u2", "title": "T", "content": "two", "error": None}
    digest = sinks.extract_digest(items).first().digest
    assert digest.startswith("### 📄 T\n\ntwo\n\n---\n### 📄 T\n\nnew\n\n---\n### ❌ missing\nFailed to open tab\n")
    sinks.write_results(items, str(tmp_path / "out"), "json")
    assert spark.read.json(str(tmp_path / "out")).count() == 4


@pytest.mark.parametrize("fmt", ["parquet", "json", "csv"])
def test_page_sources(spark, tmp_path, fmt):
    pages = spark.createDataFrame([(1, "u", '<p class="a">x,\ny</p>'), (2, "v", None)], PAGES)
    writer = pages.write.option("header", True).option("escape", '"')
    writer.format(fmt).save(str(tmp_path / "p"))
    rows = sorted(tuple(r) for r in read_pages(spark, str(tmp_path / "p"), fmt).collect())
    assert rows[0] == (1, "u", '<p class="a">x,\ny</p>') and rows[1][2] is None


def test_report_sink(spark, tmp_path):
    rows = spark.createDataFrame([("success",), ("error",)], "status string")
    sinks.write_report(rows, "1", str(tmp_path / "r"))
    row = spark.read.json(str(tmp_path / "r" / "summary")).first()
    assert (row.version, row.total, row.success, row.failed) == ("1", 2, 1, 1)
    assert AS_OF.startswith("2026")
