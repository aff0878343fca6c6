"""Running-sum measures against rendering, and sweeps over many matches."""

import random
import time

import pytest
from pyspark.sql import functions as F

from webwinnow import extract
from webwinnow.functions.binding import running
from webwinnow.functions.dom import inner_text, trimmed_text
from webwinnow.functions.text import comma_count
from webwinnow.operators.pruner import dynamic_prune, static_count, static_gone, static_matches
from webwinnow.functions.dom import first_match, no_spans, parse_selector
from webwinnow.sources.pages import scan_dom

PAGES = "page_id bigint, url string, html string"
TAGS = ("div p span section article table tr td th br pre ul li a b script style template textarea video h1 main hr iframe title").split()
TEXTS = ["x", "a, b", " ", "\n", "  two  words ", " ", " y　", "\x0b", "tab\tq", " , ", "\n\n end\n", "é漢😀", "﻿", "&nbsp;", "&lt;", "word"]


def random_html(r, depth=0):
    out = []
    for _ in range(r.randrange(1, 6)):
        if r.random() < 0.45 or depth > 6:
            out.append(r.choice(TEXTS))
            continue
        tag, extra = r.choice(TAGS), r.choice([""] * 8 + [" hidden", " style='display:none'"])
        out.append(f"<{tag}{extra}>" if tag in ("br", "hr") else f"<{tag}{extra}>{random_html(r, depth + 1)}</{tag}>")
    return "".join(out)


def test_measures_equal_rendered_text(spark):
    r = random.Random(5)
    rows = [(i, "http://x/", random_html(r)) for i in range(150)]
    x = scan_dom(spark.createDataFrame(rows, PAGES).repartition(8)).select("page_id", "nodes", "tok_t", F.explode("nodes").alias("n"))
    n, tok = F.col("n"), F.col("tok_t")
    links = F.filter(F.slice("nodes", n["id"] + 2, n["last"] - n["id"]), lambda a: a["tag"] == "a")
    rendered = F.struct(
        F.length(trimmed_text(tok, n)).alias("size"), comma_count(trimmed_text(tok, n)).alias("commas"), F.length(inner_text(tok, n)).alias("inner"),
        F.aggregate(links, F.lit(0), lambda total, a: total + F.length(trimmed_text(tok, a))).alias("links"))
    got = x.select("n.size", "n.commas", "n.links", "n.inner", rendered.alias("want")).collect()
    assert len(got) > 2000 and sum(g.inner is not None for g in got) > 300
    assert all((g.size, g.commas, g.links) == (g.want.size, g.want.commas, g.want.links) for g in got)
    assert all(g.inner is None or g.inner == g.want.inner for g in got)


def test_running(spark):
    r = random.Random(6)
    rows = [([r.randrange(-9, 9) for _ in range(n)],) for n in (0, 1, 2, 3, 7, 50, 1000)]
    df = spark.createDataFrame(rows, "x array<int>").select("x", running(F.col("x"), lambda a, b: a + b).alias("s"), running(F.col("x"), F.greatest).alias("m"))
    for x, s, m in df.collect():
        assert s == [sum(x[: i + 1]) for i in range(len(x))] and m == [max(x[: i + 1]) for i in range(len(x))]


def brute_static(nodes, rules):
    """Removals selector by selector: a match that is detached by then does not count."""
    gone, count = [], 0
    for rule in sorted({k for _, k in rules}):
        for n in [n for n, k in rules if k == rule]:
            if not any(o["id"] < n["id"] <= o["last"] for o, earlier in gone if earlier < rule):
                count += 1
        gone += [(n, rule) for n, k in rules if k == rule]
    return count


def test_static_sweep(spark):
    r = random.Random(7)

    def nest(depth):
        tag = r.choice(["nav", "aside", "footer", "div", "form", "p"])
        inside = "".join(nest(depth + 1) for _ in range(r.randrange(3))) if depth < 6 else ""
        return f"<{tag}>t{inside}</{tag}>"

    rows = [(i, "http://x/", "<main>" + "".join(nest(0) for _ in range(4)) + "</main>") for i in range(60)]
    dom = scan_dom(spark.createDataFrame(rows, PAGES))
    css = parse_selector(F.lit("main"))
    found = static_matches(F.col("nodes"), first_match(F.col("nodes"), css))
    for x in dom.select("nodes", found.alias("found"), static_count(found).alias("n"), static_gone(found).alias("gone")).collect():
        assert x.n == brute_static(x.nodes, [(m, m.rule) for m in x.found])
        top = [m.id for m in x.found if not any(o.id < m.id <= o.last for o in x.found)]
        assert [g.id for g in x.gone] == top


def cells(n):
    """A table of *n* short cells of one class, each with a nested fixed-noise element, inside an article."""
    rows = "".join("<tr>" + "<td class='c'>ab<nav>x</nav></td>" * 16 + "</tr>" for _ in range(n // 16))
    return "<article><p>" + "Some words, in a sentence. " * 20 + "</p><table>" + rows + "</table></article>"


def test_sixteen_thousand_cells(spark):
    nodes, css = F.col("nodes"), parse_selector(F.lit("article"))
    took = {}
    for n in (160, 4_000, 16_000):
        dom = scan_dom(spark.createDataFrame([(1, "http://x/", cells(n))], PAGES)).withColumn("container", first_match(nodes, css)).cache()
        dom.count()
        sheet = F.array(parse_selector(F.lit("td.c")), parse_selector(F.lit("tr")))
        found = static_matches(nodes, F.col("container"))
        began = time.time()
        one = dom.select(static_count(found).alias("count"), F.size(static_gone(found)).alias("gone")).first()
        two = dom.select(dynamic_prune(nodes, F.col("tok_t"), F.col("container"), no_spans(), sheet).alias("d")).select("d.removed", F.size("d.gone").alias("gone")).first()
        took[n] = time.time() - began
        assert tuple(one) == (n, n) and two.removed == n + n // 16 and two.gone == n // 16
    assert took[16_000] - took[160] < 3


@pytest.mark.parametrize("n", [8_000])
def test_a_large_table_is_extracted(spark, n):
    got = extract(spark.createDataFrame([(1, "http://x/", cells(n))], PAGES), "2026-01-01T00:00:00+00:00").first()
    assert got.error is None and got.metadata.pruned_static == n
