"""Golden pages for the extraction plan: mapping, scoring, pruning, validation, floors, embeds."""

import pytest
from pyspark.sql import functions as F

from webwinnow.plans import extract as X
from webwinnow.plans.extract import extract, extract_requested
from webwinnow.schemas import PAGES
from webwinnow.sources.sinks import metrics

AS_OF = "2026-01-01T00:00:00+00:00"
WORDS = "alpha beta, gamma delta, epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho. "
T = lambda n: ("x" * 9 + " ") * (n // 10) + "y" * (n % 10)  # noqa: E731  text of exactly n characters (n % 10 > 0)
LONG = WORDS * 4
FRAME = '<p>{}</p><iframe src="{}" {}></iframe>'.format
SIZE = 'width="300" height="200"'

PAGES_HTML = {
    # mapping
    "main49": f"<main>{T(49)}</main><article>{LONG}</article>",
    "main51": f"<main>{T(51)}</main><article>{LONG}</article>",
    "role_main": f'<div role="main"><p>{LONG}</p></div><section>{LONG}{LONG}</section>',
    "role_article": f'<div role="article"><p>{LONG}</p></div>',
    "pattern_tie": f'<div id="content"><div class="post-body story">{LONG}</div></div>',
    "pattern_class": f'<section><div class="x My-Post post2"><p>{LONG}</p></div></section><p>{LONG}</p>',
    "token_order": f'<div id="main" class="content-box"><p>{LONG}</p></div>',
    "same_selector": f'<div class="post"><p>{T(55)}</p></div><div class="post"><p>{LONG}</p></div>',
    "density": f"<section><p>{LONG}</p></section><div><p>{T(61)}</p></div>",
    "body_only": f"<p>{LONG}</p>",
    "bad_id": f'<div id="1content"><p>{LONG}</p></div>',
    # challenge pages
    "bot_title": f"<title>Please Verify: are you a robot?</title><main>{LONG}</main>",
    "bot_body": f"<title>Hi</title><main>{LONG} Verify you are  human now</main>",
    "bot_script": f"<title>Hi</title><script>access denied</script><main><p>{LONG}</p></main>",
    # static prune
    "nested_nav": f"<main><nav>a<nav>b</nav></nav><p>{LONG}</p></main>",
    "aside_modal": f'<main><aside><div class="modal">m</div></aside><div class="modal"><aside>q</aside></div><p>{LONG}</p></main>',
    "outside": f"<nav>menu</nav><main><p>{LONG}</p></main><footer>f</footer>",
    # dynamic prune
    "short_links": f'<main><ul><li><a href="/1">one</a></li><li><a href="/2">two</a></li><li>{T(61)}</li></ul><p>{LONG}</p></main>',
    "div_links": f'<main><div><a href="/1">a link to elsewhere one</a></div><div class="k"><div><a href="/2">a second link elsewhere</a></div><p>{LONG}</p></div></main>',
    "numbered": f'<main><ol start="3"><li>{T(61)}</li><li><a href="/1">one</a></li><li>{T(62)}</li></ol><p>{LONG}</p></main>',
    "odd_class": f'<main><div class="a :"><a href="/1">a link to elsewhere one</a></div><p>{LONG}</p></main>',
    "nested_div": '<main><section><div><p>a</p><div><a href="/1">linked text one two</a></div></div></section>' + f"<p>{LONG}</p></main>",
    # floors
    "empty": "<title>E</title>",
    "thin": "<main>short text here</main>",
    "healed": f'<div class="content"><nav>{LONG}</nav>tiny</div><p>{T(75)}</p>',
    # titles
    "empty_title": f"<title></title><main><h1>Head</h1><p>{LONG}</p></main>",
    "h1_title": f"<main><h1>He<b>ad</b> &amp; more</h1><p>{LONG}</p></main>",
    "text_title": f"<main><p>ab</p><p>First good line</p><p>{LONG}</p></main>",
    # frames
    "frame_ok": FRAME(LONG, "/embedded", SIZE),
    "frame_small": FRAME(LONG, "/embedded", 'width="299" height="200"'),
    "frame_default": FRAME(LONG, "/embedded", ""),
    "frame_tracking": FRAME(LONG, "https://uploads.h.example/x", SIZE),
    "frame_blank": FRAME(LONG, "about:blank", SIZE),
    "frame_missing": FRAME(LONG, "/nowhere", SIZE),
    "frame_thin": FRAME(LONG, "/thin100", SIZE),
    "frame_pruned": f'<main><p>{LONG}</p><aside><iframe src="/embedded" {SIZE}></iframe></aside></main>',
    "embedded": f"<title>Em  bed</title><p>{T(101)}</p>",
    "thin100": f"<p>{'z' * 100}</p>",
    # other
    "boiler": f"<title>Our Cookie Policy</title><main><p>{LONG}</p><p>read the privacy policy</p></main>",
}


@pytest.fixture(scope="module")
def pages(spark):
    rows = [(i, f"https://h.example/{name}", html) for i, (name, html) in enumerate(PAGES_HTML.items())]
    rows.append((len(rows), "https://h.example/gone", None))
    return spark.createDataFrame(rows, PAGES)


@pytest.fixture(scope="module")
def extracted(pages):
    return extract(pages, AS_OF).cache()


@pytest.fixture(scope="module")
def got(extracted):
    return {r.url.rsplit("/", 1)[1]: r for r in extracted.collect()}


def test_every_page_has_one_row(got):
    assert set(got) == set(PAGES_HTML) | {"gone"}


@pytest.mark.parametrize("name, selector, confidence", [
    ("main49", "article", 1.0),
    ("main51", "main", 1.0),
    ("role_main", '[role="main"]', 1.0),
    ("role_article", '[role="article"]', 1.0),
    ("pattern_tie", "div#content", 0.6),
    ("pattern_class", "div.My-Post.post2", 0.6),
    ("token_order", "div.content-box", 0.6),
    ("same_selector", "div.post", 0.6),
    ("density", "section", 0.4),
    ("body_only", "body", 0.2),
])
def test_mapping(got, name, selector, confidence):
    m = got[name].metadata
    assert (m.selector, m.mapper_confidence) == (selector, confidence)


def test_selector_is_resolved_again(got):
    """The longer element was chosen, but its selector finds the first one."""
    assert got["same_selector"].metadata.text_length == 55


def test_invalid_selector_matches_nothing_then_heals(got):
    m = got["bad_id"].metadata
    assert (m.mapper_confidence, m.scored_blocks_count, m.validator_confidence) == (0.6, 0, 0.1)
    assert m.validation_warning == "Content check returned empty"
    assert m.selector == "body" and got["bad_id"].error is None


def test_challenge_pages(got):
    r = got["bot_title"]
    assert r.error == "Anti-bot challenge detected (title:robot)"
    assert (r.title, r.content, r.metadata.anti_bot_detected, r.metadata.confidence) == (
        "Please Verify: are you a robot?", "", True, 0.0)
    assert got["bot_body"].error == "Anti-bot challenge detected (body:verify you are human)"
    assert got["bot_script"].error is None


def test_static_prune(got):
    assert got["nested_nav"].metadata.pruned_static == 2
    # The modal under the aside is detached with it; the aside under the modal goes first.
    assert got["aside_modal"].metadata.pruned_static == 3
    assert got["outside"].metadata.pruned_static == 0
    assert "menu" not in got["outside"].content


def test_dynamic_prune(got):
    m = got["short_links"].metadata
    assert (m.noise_selectors_found, m.pruned_dynamic) == (2, 2)
    assert got["short_links"].noise_selectors == ["li", "li"]
    assert "[one]" not in got["short_links"].content and "xxxxxxxxx y" in got["short_links"].content
    m = got["div_links"].metadata
    assert (m.noise_selectors_found, m.pruned_dynamic) == (2, 2)
    assert "elsewhere" not in got["div_links"].content


def test_item_numbers_close_up(got):
    assert got["numbered"].metadata.pruned_dynamic == 1
    assert f"3. {T(61)}\n4. {T(62)}\n" in got["numbered"].content


def test_sanitised_selector_that_is_not_valid_css_removes_nothing(got):
    assert got["odd_class"].noise_selectors == ["div.a."]
    assert got["odd_class"].metadata.pruned_dynamic == 0 and "elsewhere" in got["odd_class"].content


def test_dynamic_prune_counts_detached_matches(got):
    """The outer div goes with its inner div; both are counted."""
    m = got["nested_div"].metadata
    assert got["nested_div"].noise_selectors == ["div"]
    assert m.pruned_dynamic == 2


def test_floors(got):
    r = got["empty"]
    assert r.error.startswith("Empty content extracted (0 chars)") and r.content == ""
    assert r.metadata.empty_content and r.language is None
    r = got["thin"]
    assert r.error == "Low content (15 chars) — returned what's available"
    assert r.metadata.low_content and r.metadata.confidence <= 0.15 and r.quality_score is None
    assert r.content.count("<extraction_result>") == 2 and r.content.count("Timestamp:") == 1
    r = got["healed"]
    assert (r.error, r.metadata.selector) == (None, "body")
    assert r.metadata.pruned_static == 1 and LONG[:40] not in r.content


def test_titles(got):
    # An empty title hides the page's h1, and the container's h1 comes next.
    assert got["empty_title"].title == "Head"
    assert got["h1_title"].title == "Head &amp; more"
    assert got["text_title"].title == "First good line"
    assert got["gone"].title == "" and got["gone"].error == "Failed to open tab" and got["gone"].metadata is None


@pytest.mark.parametrize("name, frames", [
    ("frame_ok", 1), ("frame_small", 0), ("frame_default", 0), ("frame_tracking", 0), ("frame_blank", 0),
    ("frame_missing", 0), ("frame_thin", 0), ("frame_pruned", 0),
])
def test_frames(got, name, frames):
    r = got[name]
    assert r.metadata.iframes_extracted == frames == len(r.embeds)
    if frames:
        section = f"\n\n---\n\n### Embedded: Em bed\n\n{T(101)}"
        assert r.embeds[0].text == T(101)
        assert r.metadata.text_length == len(LONG.strip()) + len(section)
        assert "### Embedded" not in r.content  # Markdown comes from the container's HTML alone


def test_content_format(got):
    r = got["role_article"]
    assert r.content == (
        "<extraction_result>\n  <metadata>\n  Title: " + LONG.strip()[:200] + "\n"
        "  URL: https://h.example/role_article\n  Timestamp: 2026-01-01T00:00:00+00:00\n  </metadata>\n\n"
        "  <main_body>\n" + LONG.strip() + "\n  </main_body>\n</extraction_result>\n"
    )
    assert r.has_schema is False and r.raw_content == ""


def test_boilerplate_can_delete_the_title_line(got):
    assert "Title:" not in got["boiler"].content and "privacy" not in got["boiler"].content
    assert got["boiler"].title == "Our Cookie Policy"


def test_final_confidence(got):
    m = got["main51"].metadata
    assert m.confidence == round(m.mapper_confidence * 0.3 + m.scorer_confidence * 0.3 + m.validator_confidence * 0.4, 3)


def test_metrics_skip_unfinished_rows(extracted, got):
    urls = {r.url.rsplit("/", 1)[1] for r in metrics(extracted).collect()}
    assert urls == set(got) - {"gone", "empty", "bot_title", "bot_body"}


def test_partitioning_does_not_change_results(pages, extracted):
    again = extract(pages.repartition(3, "url"), AS_OF).select("page_id", "content", "metadata")
    assert again.exceptAll(extracted.select("page_id", "content", "metadata")).count() == 0


def test_requested_urls_are_extracted_by_position(spark, pages):
    """Frames load from the whole page table, though only the framing page is asked for."""
    base = "https://h.example/"
    urls = spark.createDataFrame(
        [(0, base + "frame_ok"), (1, base + "nope"), (2, base + "frame_ok"), (3, base + "thin"), (4, base + "gone")],
        "pos int, url string",
    )
    rows = extract_requested(urls, pages, AS_OF, cap=4).orderBy("pos").collect()
    assert [(r.pos, r.error) for r in rows] == [
        (0, None), (1, "Failed to open tab"), (2, None), (3, "Low content (15 chars) — returned what's available")]
    assert rows[0].metadata.iframes_extracted == 1 and rows[0].content == rows[2].content
    assert rows[1].content == "" and rows[1].metadata is None


def test_full_path_has_no_shuffle_and_no_join(pages):
    plan = extract(pages, AS_OF, embeds=False)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Join" not in plan


def test_no_nested_loop_join(pages):
    plan = extract(pages, AS_OF)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_block_edges(spark):
    """Pass edges of the validation cascade on given metrics."""
    from webwinnow.functions.scores import validate

    cases = [
        (200, 2, 0.4, 3.0, (1, 0.79)), (199, 2, 0.4, 3.0, (2, 0.49)), (200, 1, 0.4, 3.0, (2, 0.49)),
        (200, 2, 0.41, 3.0, (2, 0.49)), (100, 1, 0.6, 1.0, (2, 0.43)), (100, 1, 0.61, 1.0, (3, 0.2)),
        (100, 1, 0.6, 0.99, (3, 0.2)), (31, 9, 0.0, 9.0, (3, 0.1)), (32, 0, 1.0, 0.0, (3, 0.2)),
        (500, 5, 0.0, 50.0, (1, 1.0)), (0, 0, 0.0, 0.0, (3, 0.1)),
    ]
    df = spark.createDataFrame([c[:4] for c in cases], "t int, c int, d double, a double")
    v = validate(F.lit(True), F.col("t"), F.col("c"), F.col("d"), F.col("a"))
    rows = df.select(v.alias("v")).collect()
    assert [(r.v.pass_used, r.v.confidence) for r in rows] == [c[4] for c in cases]
    assert rows[7].v.text_length == 0 and rows[7].v.warning.startswith("Content too short (31 chars)")
    assert X.RESULT_COLUMNS[0] == "page_id"
