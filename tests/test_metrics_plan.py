"""What the metrics of a crawl cost: each check once, no column that is not read, patterns that pass the marks only."""

import random

import pytest
from pyspark.sql import functions as F

from webwinnow import constants as K
from webwinnow.functions import dom
from webwinnow.functions import markdown as md
from webwinnow.functions.text import SPACE, collapse, strip
from webwinnow.operators.embeds import embed_texts
from webwinnow.plans import extract as X
from webwinnow.plans.catalog import AS_OF, extract_metrics
from webwinnow.sources import sinks

BODY = "<p>" + "One, two, three and <b>four</b> more words. " * 8
PAGES = [
    (1, "u1", f"<title>T</title><article><h1>A</h1>{BODY}</article><footer>f</footer>"),
    (2, "u2", "<title>Are you a robot?</title><p>x"),
    (3, "u3", None),
    (4, "u4", "<p>tiny"),
    (5, "u5", f'<title>F</title><article>{BODY}</article><iframe src="u1" width="600" height="400"></iframe>'),
    (5, "u5", f"<title></title><ul><li><a href=x>l</a></ul><div class=content>{BODY}<table><tr><td>1<td>2</table>"),
]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("pages"))
    spark.createDataFrame(PAGES, "page_id long, url string, html string").coalesce(1).write.parquet(f"{path}/pages.parquet")
    return path


def test_each_check_once_and_no_unread_column(spark, folder):
    plan = extract_metrics(spark, folder)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count(K.ERR_ANTI_BOT.split("%")[0]) == 1
    for unread in ("scored_blocks", "validator_confidence", "validation_warning", "pruned_static"):
        assert unread not in plan


def test_lean_metrics_equal_those_of_the_whole_path(spark, folder):
    whole = sinks.metrics(X.extract(spark.read.parquet(f"{folder}/pages.parquet"), AS_OF)).collect()
    assert sorted(map(repr, extract_metrics(spark, folder).collect())) == sorted(map(repr, whole))
    assert {r.url for r in whole} >= {"u1", "u5"} and not {r.url for r in whole} & {"u2", "u3"}


def _marked(seed: int, marks: list[str]) -> list[tuple]:
    rnd = random.Random(seed)
    text = ["a", "b c", " ", "  ", "\n", " \t", "x ", "é ", "漢", "\U0001f600 z", "$1", "\\", "**", "](u)", "\x0b", " ", "1. ", ""]
    return [("".join(rnd.choice(rnd.choice((text, marks))) for _ in range(rnd.randint(0, 14))),) for _ in range(3000)] + [(None,)]


def _same(spark, rows, got, want):
    table = spark.createDataFrame(rows, "s string").select("s", got.alias("got"), want.alias("want"))
    assert table.where(~F.col("got").eqNullSafe(F.col("want"))).collect() == []


def test_markdown_equals_the_patterns_over_the_whole_text(spark):
    prefixes = ("", ">" + K.T_SPACE, K.T_SPACE * 2)
    marks = [m + p + K.M_STOP for m in (K.M_PARA, K.M_LINE, K.M_LIST, K.M_BREAK) for p in prefixes]
    marks += [K.M_ITEM + p + "- " + K.M_STOP for p in prefixes] + [K.T_NEWLINE, K.T_TAB, "```" + K.T_NEWLINE]
    marks += [K.M_OPEN + x + K.M_END for x in ("**", "[", "## ")] + [K.M_CLOSE + x + K.M_END for x in ("**", "](a b $1)", "")]
    _same(spark, _marked(1, marks), md.markdown(F.col("s")), strip(md._resolved(dom.collapsed(F.col("s")))))


def test_rendered_text_equals_the_patterns_over_the_whole_text(spark):
    marks = [K.T_BLOCK, K.T_PARA, K.T_BR, K.T_CELL, K.T_ROW, K.T_TABLE, K.T_TABLE + K.T_BLOCK, K.T_NEWLINE, K.T_SPACE, K.T_TAB]
    marks += [K.T_HIDE + x + K.T_SHOW for x in ("", " h ", "\n")]
    shown = F.regexp_replace("s", f"{K.T_HIDE}[^{K.T_SHOW}]*{K.T_SHOW}", "")
    plain = dom._broken(F.trim(F.regexp_replace(shown, r"[\t\n\r\f][ \t\n\r\f]*| [ \t\n\r\f]+", " ")))
    _same(spark, _marked(2, marks), dom.rendered_text(F.col("s")), plain)


def test_patterns_pass_one_character_for_a_stretch_of_text(spark):
    seen = []
    long = "word " * 1000 + K.M_PARA + K.M_STOP + "end"
    got = spark.createDataFrame([(long,)], "s string").select(
        dom.between_text(F.col("s"), lambda c: seen.append(1) or F.concat(c, F.length(c).cast("string")), md._MARKS).alias("x")
    ).first().x
    assert got == long + "5" and seen == [1]


def test_collapse_knows_every_space(spark):
    rows = [(f"x{chr(i)}{chr(i)}y",) for i in range(1, 0x3100)]
    _same(spark, rows, collapse(F.col("s")), strip(F.regexp_replace("s", f"{SPACE}+", " ")))


def test_pages_without_frames_are_not_shuffled(spark):
    schema = "page_id long, url string, html string"
    with_frames, without = (spark.createDataFrame([p for p in PAGES if ("iframe" in (p[2] or "")) == x or p[0] == 1], schema) for x in (True, False))
    got, none = embed_texts(with_frames), embed_texts(without)
    assert [(r.page_id, len(r.embeds)) for r in got.collect()] == [(5, 1)] and none.collect() == []
    assert got.schema.simpleString() == none.schema.simpleString()
    plan = none._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan and "Aggregate" not in plan
