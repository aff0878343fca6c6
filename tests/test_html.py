"""Tree building, inner text, HTML and Markdown of hand-written pages."""

import pytest
from pyspark.sql import functions as F

from webwinnow.functions.dom import first_match, inner_text, join_tokens, parse_selector
from webwinnow.functions.markdown import markdown
from webwinnow.schemas import PAGES
from webwinnow.sources.html_tree import VOID, parse_html
from webwinnow.sources.pages import dom_nodes, scan_dom


def tree(source):
    def show(n):
        if n.text is not None:
            return n.text
        inner = "".join(map(show, n.kids))
        return f"<{n.tag}>{inner}" + ("" if n.tag in VOID else f"</{n.tag}>")

    return show(parse_html(source)).removeprefix("<html><head></head><body>").removesuffix("</body></html>")


@pytest.mark.parametrize("source, expected", [
    ("<p>a<p>b", "<p>a</p><p>b</p>"),
    ("<p><b>a<br><p>c</p><p><b>d<br><p>e</p>", "<p><b>a<br></b></p><p><b>c</b></p><p><b><b>d<br></b></b></p><p><b><b>e</b></b></p>"),
    ("<p>" + "<b>" * 5 + "a<p>b", "<p>" + "<b>" * 5 + "a" + "</b>" * 5 + "</p><p><b><b><b>b</b></b></b></p>"),
    ("<b><p>t</b>m</p>", "<b></b><p><b>t</b>m</p>"),
    ("<p>1<b>2<i>3</b>4</i>5</p>", "<p>1<b>2<i>3</i></b><i>4</i>5</p>"),
    ("<ul><li>a<li>b<ul><li>c</ul><li>d</ul>", "<ul><li>a</li><li>b<ul><li>c</li></ul></li><li>d</li></ul>"),
    ("<table><tr><td>a<td>b<tr><td>c</table>z",
     "<table><tbody><tr><td>a</td><td>b</td></tr><tr><td>c</td></tr></tbody></table>z"),
    ("<table>foo<tr><td>x</table>", "foo<table><tbody><tr><td>x</td></tr></tbody></table>"),
    ("<a href=1>x<a href=2>y</a>", "<a>x</a><a>y</a>"),
    ("<div><span>a<div>b</span>c</div>d", "<div><span>a<div>bc</div>d</span></div>"),
    ("<dl><dt>a<dd>b<dt>c</dl>", "<dl><dt>a</dt><dd>b</dd><dt>c</dt></dl>"),
    ("x</p>y", "x<p></p>y"),
    ("a &lt; b &copy; c", "a < b © c"),
    ("<script>var t='</p>';</script>k", "<html><head><script>var t='</p>';</script></head><body>k"),
])
def test_tree(source, expected):
    assert tree(source) == expected


@pytest.fixture(scope="module")
def render(spark):
    def run(pages, selector):
        df = spark.createDataFrame([(i, "http://h.example/x/", p) for i, p in enumerate(pages)], PAGES)
        node = first_match(F.col("nodes"), parse_selector(F.lit(selector)))
        rows = scan_dom(df).withColumn("n", node).select(
            "page_id",
            inner_text(F.col("tok_t"), F.col("n")).alias("text"),
            join_tokens(F.col("tok_h"), F.col("n")).alias("html"),
            markdown(join_tokens(F.col("tok_m"), F.col("n"))).alias("md"),
        ).orderBy("page_id").collect()
        return rows

    return run


INNER_TEXT = [
    ("<p>a  b\n c</p>", "a b c"),
    ("<p>a</p><p>b</p>", "a\n\nb"),
    ("<div>a</div><div>b</div>", "a\nb"),
    ("<div>a</div><p>b</p>", "a\n\nb"),
    ("a<br>b<br><br>c", "a\nb\n\nc"),
    ("a <b> b </b> c", "a b c"),
    ("x<script>y</script>z<style>q</style><span hidden>h</span><i style='display: none'>k</i>", "xz"),
    ("<table><tr><td>a</td><td>b</td></tr><tr><td>c</td><td>d</td></tr></table>e", "a\tb\nc\td\ne"),
    ("<pre>a  b\n  c</pre>d", "a  b\n  c\nd"),
    ("<ul><li>a<li>b</ul>", "a\nb"),
    ("&nbsp;a&nbsp;b", " a b"),
    ("<div>a<div> </div></div> <div>b</div>", "a\nb"),
    ("<select><option>1<option>2</select>", "1\n2"),
]


def test_inner_text(render):
    rows = render([p for p, _ in INNER_TEXT], "body")
    assert [r.text for r in rows] == [t for _, t in INNER_TEXT]


def test_inner_text_of_hidden_element_is_its_text_content(render):
    rows = render(["<div id=k hidden><p>a</p> <p>b</p></div>"], "div#k")
    assert rows[0].text == "a b"


def test_html_is_serialised(render):
    rows = render(['<p title=\'a"b\'>x &amp; y &lt; &nbsp;<img src=a><!-- c --></p>'], "p")
    assert rows[0].html == '<p title="a&quot;b">x &amp; y &lt; &nbsp;<img src="a"><!-- c --></p>'


MARKDOWN = [
    ("<h1>T</h1><p>a <b>b</b> <i>c</i></p><p>d</p>", "# T\n\na **b** *c*\n\nd"),
    ("<h2> x <br> y </h2>z", "## x y\n\nz"),
    ("<ul><li>a</li><li>b</li></ul><p>c</p>", "- a\n- b\n\nc"),
    ("<p>x</p><ul><li><p>1</p><p><a href='/k'>t</a></p></li><li><p>2</p></li></ul>",
     "x\n\n- 1\n\n  [t](/k)\n- 2"),
    ("<ol><li>a<li>b</ol>", "1. a\n2. b"),
    ("<ol start=4><li>a<li>b</ol>", "4. a\n5. b"),
    ("<ul><li>a<ul><li>b</ul><li>c</ul>", "- a\n  - b\n- c"),
    ("<a href='/x'><img src='i.png' alt='p q'></a>", "[![p q](i.png)](/x)"),
    ("<a href='/x'><img src='i.png'></a>", "[![](i.png)](/x)"),
    ("<p>a</p><hr><p>b</p>", "a\n\n---\n\nb"),
    ("<p>a<br>b</p>", "a  \nb"),
    ("<p><b>a<br></b></p><p>c</p>", "**a**\n\nc"),
    ("<p>x<b> y </b>z</p>", "x **y** z"),
    ("<p>a*b_c</p>", "a\\*b\\_c"),
    ("<pre>a\n  b*</pre>", "```\na\n  b*\n```"),
    ("<p>k <code>a*b</code></p>", "k `a*b`"),
    ("<blockquote><p>a</p><p>b</p></blockquote>c", "> a\n\n> b\n\nc"),
    ("<table><tr><th>a<th>b<tr><td>1<td>2</table>", "| a | b |\n| --- | --- |\n| 1 | 2 |"),
    ("<a href='/x'><h3>t</h3></a>", "[### t](/x)"),
    ("<b></b>x<a href='/y'> </a>", "x"),
    ("<script>s</script><div>a</div><div>b</div>", "a\n\nb"),
]


def test_markdown_shapes(render):
    rows = render([p for p, _ in MARKDOWN], "body")
    got = [(p, r.md) for (p, _), r in zip(MARKDOWN, rows)]
    assert got == MARKDOWN


def test_node_table_and_failed_rows(spark):
    df = spark.createDataFrame(
        [(1, "u", "<div id=a class='x y'><p>t</p></div>"), (2, "v", None), (3, "w", "")], PAGES
    )
    dom = scan_dom(df).cache()
    nodes = [(r.node_id, r.last_id, r.parent_id, r.tag, r.elem_id, r.classes)
             for r in dom_nodes(dom).where("page_id = 1").orderBy("node_id").collect()]
    assert nodes == [
        (0, 4, -1, "html", None, []), (1, 1, 0, "head", None, []), (2, 4, 0, "body", None, []),
        (3, 4, 2, "div", "a", ["x", "y"]), (4, 4, 3, "p", None, []),
    ]
    errors = {r.page_id: r.scan_error for r in dom.select("page_id", "scan_error").collect()}
    assert errors == {1: None, 2: "Failed to open tab", 3: None}
