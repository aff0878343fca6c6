"""Embedded frames: which count as content, and their text joined from the page table."""

from __future__ import annotations

from functools import cache

from pyspark.sql import Column, DataFrame, functions as F

from webwinnow import constants as K
from webwinnow.functions.binding import let
from webwinnow.functions.dom import inner_text, join_tokens, text_content
from webwinnow.functions.text import fill
from webwinnow.plans.session import cut_lineage, lookup_join
from webwinnow.sources.pages import requested_pages, scan_dom

EMBEDS = "array<struct<node_id:int,title:string,text:string>>"


def is_tracking(src: Column) -> Column:
    def listed(low):
        rule = F.lit(False)
        for part in K.TRACKING_SUBSTRINGS:
            rule = rule | low.contains(part)
        return rule

    return let(F.lower(src), listed)


def is_significant(frame: Column) -> Column:
    """Large enough, with a real and non-tracking source."""
    src = frame["src"]
    return (
        ~is_tracking(src)
        & (frame["width"] >= K.MIN_IFRAME_WIDTH)
        & (frame["height"] >= K.MIN_IFRAME_HEIGHT)
        & (src != "")
        & (src != "about:blank")
    )


def page_frames(dom: DataFrame) -> DataFrame:
    """``(page_id, node_id, src)`` of the significant frames of scanned pages."""
    return dom.select("page_id", F.explode(F.filter("frames", is_significant)).alias("f")).select(
        "page_id", "f.node_id", "f.src"
    )


def document_title(nodes: Column, tok_t: Column) -> Column:
    """Text of the first title element, ASCII white space collapsed."""
    title = F.get(F.filter(nodes, lambda n: (n["tag"] == "title") & ~n["foreign"]), F.lit(0))
    raw = let(title, lambda n: text_content(join_tokens(tok_t, n)))
    return F.coalesce(F.trim(F.regexp_replace(raw, r"[ \t\n\r\f]+", " ")), F.lit(""))


def body_text(nodes: Column, tok_t: Column) -> Column:
    body = F.get(F.filter(nodes, lambda n: n["tag"] == "body"), F.lit(0))
    return F.coalesce(let(body, lambda n: inner_text(tok_t, n)), F.lit(""))


def has_frame(html: Column) -> Column:
    return F.coalesce(F.lower(html).contains("<iframe"), F.lit(False))


@cache
def _target_columns() -> tuple[Column, Column]:
    return document_title(F.col("nodes"), F.col("tok_t")), body_text(F.col("nodes"), F.col("tok_t"))


def embed_texts(pages: DataFrame, web: DataFrame | None = None) -> DataFrame:
    """``(page_id, embeds)``: title and body text of each significant frame's page, in document order.

    Frames load from *web* (by default the same page table).  A frame whose
    source is not there, or whose body text is 100 characters or less, yields
    nothing.  Without a significant frame no page is looked up.
    """
    title, text = _target_columns()
    framed = pages.select("page_id", "url", "html").where(has_frame(F.col("html")))
    frames = cut_lineage(page_frames(scan_dom(framed)))
    if frames.isEmpty():  # no page is asked for, so none is shuffled
        return frames.select("page_id", F.lit(None).cast(EMBEDS).alias("embeds")).limit(0)
    sources = frames.select(F.col("src").alias("url")).distinct().withColumn("pos", F.xxhash64("url"))
    targets = (
        scan_dom(requested_pages(sources, pages if web is None else web).where(F.col("html").isNotNull()))
        .select(
            F.col("url").alias("src"),
            title.alias("title"),
            text.alias("text"),
        )
        .where(F.length("text") > K.MIN_EMBED_TEXT)
    )
    found = lookup_join(frames, targets, "src", "page_id").where(F.col("text").isNotNull())
    return found.groupBy("page_id").agg(
        F.sort_array(F.collect_list(F.struct("node_id", "title", "text"))).cast(EMBEDS).alias("embeds")
    )


def embed_sections(embeds: Column) -> Column:
    """Text appended to the page text, one section per frame."""
    return F.array_join(F.transform(embeds, lambda e: fill(K.EMBED_SECTION, e["title"], e["text"])), "")
