"""Pages and requests that used to stop a job."""

import pytest
from pyspark.sql import functions as F

from webwinnow import constants as K
from webwinnow.functions.markdown import markdown
from webwinnow.operators.report import overall_report
from webwinnow.operators.search import search_requests
from webwinnow.sources.dom_tokens import list_start

BREAK, PARA, LINE, LIST = (m + K.M_STOP for m in (K.M_BREAK, K.M_PARA, K.M_LINE, K.M_LIST))
ITEM = K.M_ITEM + "- " + K.M_STOP
OPEN, CLOSE = K.M_OPEN + "**" + K.M_END, K.M_CLOSE + "**" + K.M_END


@pytest.mark.parametrize("joined,head,size", [
    ("a" + BREAK * 100_000 + "b", "a  \n  \n", 300_002),
    ("a" + PARA * 100_000 + "b", "a\n\nb", 4),
    ("a" + LINE * 100_000 + "b", "a\nb", 3),
    ("a" + (LIST + ITEM + LINE + PARA) * 20_000 + "b", "a\n\n- b", 6),
    ("x" + (BREAK + CLOSE) * 20_000, "x**", 99_995),
    ("a" + OPEN + "b" + BREAK + CLOSE + LINE + BREAK + "c", "a**b**  \n  \nc", 13),
    ("a" + LINE + PARA + ITEM + "c" + LINE, "a\n- c", 6),
])
def test_long_runs_of_breaks(spark, joined, head, size):
    got = spark.createDataFrame([(joined,), ("plain",)], "s string").select(markdown(F.col("s")).alias("m")).collect()
    assert got[1].m == "plain"
    assert got[0].m.startswith(head) and abs(len(got[0].m) - size) <= 1


@pytest.mark.parametrize("value,number", [
    (None, 1), ("", 1), ("7", 7), (" 12x", 12), ("-5", -5), ("+3", 3), ("\u00b2", 1), ("--5", 1), ("99999999999", 1), ("9" * 5000, 1), ("x", 1),
])
def test_list_start(value, number):
    assert list_start(value) == number


def test_odd_limits(spark):
    rows = [("3000000000", 20, None), ("abc", 5, "limit must be a whole number"), (None, 5, None), ("-1", -1, None), ("007", 7, None), ("1.5", 5, "limit must be a whole number")]
    got = search_requests(spark.createDataFrame([("q", x) for x, _, _ in rows], "query string, limit string")).collect()
    assert [(r.limit, r.error) for r in got] == [(n, e) for _, n, e in rows]
    assert search_requests(spark.createDataFrame([("q", 3_000_000_000)], "query string, limit bigint")).first().limit == 20


def test_median_of_many_values(spark):
    rows = spark.range(5000).select(F.lit("success").alias("status"), (F.pmod(F.xxhash64("id"), F.lit(1_000_003)) / 7).alias("x"))
    values = sorted(r.x for r in rows.collect())
    got = overall_report(rows, ("x",)).first()
    assert (got.min, got.max, got.median) == (values[0], values[-1], values[2500])
    assert got.mean == pytest.approx(sum(values) / 5000)
