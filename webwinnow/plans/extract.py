"""The extraction plans: full path, cached-structure path, and the healing of starved cache hits.

One narrow chain of projections per page.  Pages are shuffled only for the
structure lookup and, for pages that hold a frame, for the embed join.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import cache

from pyspark.sql import Column, DataFrame, functions as F

from webwinnow import constants as K
from webwinnow.functions import scores
from webwinnow.functions import text as tx
from webwinnow.functions.binding import fixed_columns
from webwinnow.functions.dom import first_match, inner_text, join_tokens, parse_selector
from webwinnow.functions.markdown import markdown, renumbered
from webwinnow.operators import mapper, pruner, scorer, validator
from webwinnow.operators.antibot import anti_bot_error, may_hold_phrase
from webwinnow.operators.embeds import EMBEDS, body_text, document_title, embed_sections, embed_texts, has_frame
from webwinnow.operators.heal import heal_ladder
from webwinnow.operators.quality import with_quality
from webwinnow.plans.session import cut_lineage
from webwinnow.schemas import BLOCK_ROW
from webwinnow.sources.pages import requested_pages, scan_dom

_c = F.col
STORED = {
    "selector": "string", "noise_selectors": "array<string>", "mapper_confidence": "double",
    "scorer_confidence": "double", "validator_confidence": "double", "validation_pass": "int",
    "validation_warning": "string", "scored_blocks_count": "int",
}
RESULT_COLUMNS = (
    "page_id", "url", "title", "content", "raw_content", "metadata", "error",
    "language", "quality_score", "main_content", "has_schema",
)


# Column expressions over fixed column names are built once per process.

@cache
def _scan_columns() -> dict[str, Column]:
    nodes, tok_t = _c("nodes"), _c("tok_t")
    return {
        "html_title": tx.title_from_html(F.array_join("tok_h", "")),
        "anti_bot": anti_bot_error(
            document_title(nodes, tok_t), F.when(may_hold_phrase(tok_t), body_text(nodes, tok_t))
        ),
    }


def scanned(pages: DataFrame) -> DataFrame:
    """Page scan plus titles and the challenge check; flagged pages lose their DOM (early exit)."""
    dom = scan_dom(pages).withColumns(_scan_columns())
    return dom.withColumn("nodes", F.when(_c("anti_bot").isNull() & _c("scan_error").isNull(), _c("nodes")))


@cache
def _map_column() -> Column:
    return F.when(_c("nodes").isNotNull(), mapper.map_container(_c("nodes")))


def mapped(dom: DataFrame) -> DataFrame:
    """Add selector, mapper_confidence and the container node the selector resolves to."""
    found = dom.withColumn("found", _map_column())
    return resolved(
        found.withColumns(
            {"selector": _c("found.selector"), "mapper_confidence": _c("found.mapper_confidence")}
        ).drop("found")
    )


@cache
def _container_columns() -> tuple[Column, Column]:
    return parse_selector(_c("selector")), first_match(_c("nodes"), _c("css"))


def resolved(df: DataFrame) -> DataFrame:
    """Add the container: the first node the selector matches."""
    css, container = _container_columns()
    return df.withColumn("css", css).withColumn("container", container).drop("css")


@cache
def _score_columns() -> tuple[Column, dict[str, Column]]:
    return scorer.ranked_blocks(_c("nodes"), _c("container")), {
        "noise_selectors": scorer.noise_selectors(_c("blocks")),
        "scorer_confidence": scorer.confidence(_c("blocks")),
        "scored_blocks_count": F.size("blocks"),
        "scored_blocks": scorer.stored_blocks(_c("blocks")),
    }


def scored(df: DataFrame) -> DataFrame:
    """Add ranked blocks, noise selectors and scorer confidence."""
    blocks, derived = _score_columns()
    return df.withColumn("blocks", blocks).withColumns(derived)


@cache
def _prune_columns() -> list[dict[str, Column]]:
    nodes, tok_t, container = _c("nodes"), _c("tok_t"), _c("container")
    return [
        {"noise_nodes": pruner.static_matches(nodes, container)},
        {
            "pruned_static": pruner.static_count(_c("noise_nodes")),
            "static_gone": pruner.static_gone(_c("noise_nodes")),
            "sheet": F.transform("noise_selectors", parse_selector),
        },
        {"dynamic": pruner.dynamic_prune(nodes, tok_t, container, _c("static_gone"), _c("sheet"))},
        {
            "gone": F.coalesce(_c("dynamic.gone"), _c("static_gone")),
            "pruned_dynamic": F.coalesce(_c("dynamic.removed"), F.lit(0)),
        },
        {"raw_text": F.coalesce(inner_text(tok_t, container, _c("gone")), F.lit(""))},
    ]


def pruned(df: DataFrame) -> DataFrame:
    """Add the removed subtrees, the removal counts and the remaining text."""
    for columns in _prune_columns():
        df = df.withColumns(columns)
    return df.drop("noise_nodes", "static_gone", "sheet", "dynamic")


@cache
def _validation_columns() -> list[dict[str, Column]]:
    stats = validator.container_stats(_c("nodes"), _c("tok_t"), _c("container"), _c("gone"), _c("raw_text"))
    return [
        {"stats": stats},
        {"validation": validator.validation(_c("stats"), _c("blocks"))},
        {
            "validator_confidence": _c("validation.confidence"),
            "validation_pass": _c("validation.pass_used"),
            "validation_warning": _c("validation.warning"),
        },
    ]


def validated(df: DataFrame) -> DataFrame:
    """Add the validation struct of the pruned container and its confidence, pass and warning."""
    for columns in _validation_columns():
        df = df.withColumns(columns)
    return df.drop("stats")


@cache
def _text_columns() -> list[dict[str, Column]]:
    nodes, tok_t, gone = _c("nodes"), _c("tok_t"), _c("gone")
    alive = F.filter(
        F.coalesce(_c("all_embeds"), F.array().cast(EMBEDS)),
        lambda e: ~F.exists(gone, lambda r: (e["node_id"] >= r["id"]) & (e["node_id"] <= r["last"])),
    )
    return [
        {
            "target": heal_ladder(nodes, tok_t, gone, _c("selector"), _c("container"), _c("raw_text")),
            "embeds": F.when(nodes.isNotNull(), alive),
        },
        {
            "text_size": _c("target.size"),
            "merged_text": F.concat(_c("target.text"), embed_sections(_c("embeds"))),
        },
    ]


def _read_out(df: DataFrame) -> DataFrame:
    """Text of the pruned container, healed when thin, with the surviving embeds appended."""
    for columns in _text_columns():
        df = df.withColumns(columns)
    return df


def full_path(dom: DataFrame, lean: bool = False) -> DataFrame:
    """Map, score, prune, validate and read out; ``lean`` leaves out what only metadata and structure rows show."""
    read = _read_out(validated(pruned(scored(mapped(dom)))))
    return fixed_columns(read, (*(TEXT_COLUMNS if lean else PATH_COLUMNS), "nodes", "html_title", "anti_bot"))


PATH_COLUMNS = (
    "selector", "mapper_confidence", "noise_selectors", "scorer_confidence", "scored_blocks_count",
    "validator_confidence", "validation_pass", "validation_warning", "scored_blocks", "gone", "pruned_static",
    "pruned_dynamic", "target", "embeds", "text_size", "merged_text",
)
#: What the text and the floors of a result need; a generator's columns are worked out whether they are read or not.
TEXT_COLUMNS = ("gone", "target", "text_size", "merged_text")


def cached_path(dom: DataFrame) -> DataFrame:
    """Prune and read out with the stored selector and noise selectors (columns ``stored_*``)."""
    df = dom.withColumns({name: _c(f"stored_{name}") for name in STORED}).withColumn(
        "scored_blocks", F.lit(None).cast(f"array<{BLOCK_ROW.simpleString()}>")
    )
    return _read_out(pruned(resolved(df)))


def is_starved(size: Column, merged: Column) -> Column:
    """A cache hit that must fall back to the full path."""
    return (size < K.EMPTY_FLOOR) | ((size < K.SHORT_FLOOR) & (F.length(merged) < K.STARVED_FLOOR))


def cached_or_full(dom: DataFrame) -> DataFrame:
    """Cached path for hits; full path for misses and for starved hits, each row computed once.

    Both paths run in the same pass: a row's DOM is null on the path it does
    not take, so that path's expressions end at once.
    """
    keep = [name for name in dom.columns if name != "nodes"]
    first = cached_path(
        dom.withColumns({"dom_nodes": _c("nodes"), "nodes": F.when(_c("stored_selector").isNotNull(), _c("nodes"))})
    )
    first = first.withColumn("hit", F.struct(*PATH_COLUMNS)).select(*keep, "dom_nodes", "hit")
    first = fixed_columns(first, ("hit", "html_title", "anti_bot", "dom_nodes")).withColumn(
        "served",
        _c("stored_selector").isNotNull()
        & (_c("dom_nodes").isNull() | ~is_starved(_c("hit.text_size"), _c("hit.merged_text"))),
    )
    second = full_path(first.withColumn("nodes", F.when(~_c("served"), _c("dom_nodes"))))
    merged = {name: F.when(_c("served"), _c(f"hit.{name}")).otherwise(_c(name)) for name in PATH_COLUMNS}
    out = second.withColumns(merged).withColumns({
        "structure_cache_hit": _c("served"), "nodes": _c("dom_nodes"),
        "healed": _c("stored_selector").isNotNull() & ~_c("served"),
    })
    return out.drop("hit", "served", "dom_nodes")


@cache
def _finish_columns() -> list[dict[str, Column]]:
    target, live = _c("target"), _c("nodes").isNotNull()
    empty = live & (_c("text_size") < K.EMPTY_FLOOR)
    titles = (
        _c("html_title"), tx.title_from_html(_c("raw_html")), tx.title_from_text(_c("merged_text")), _c("url")
    )
    return [
        {
            "raw_html": F.coalesce(join_tokens(_c("tok_h"), target["node"], _c("gone")), F.lit("")),
            "tok_m": renumbered(_c("tok_m"), _c("nodes"), _c("gone")),
        },
        {
            "title": F.when(live, tx.first_filled(*titles))
            .when(_c("anti_bot").isNotNull(), tx.first_filled(_c("html_title"), _c("url")))
            .otherwise(""),
            "md": F.when(
                live & ~empty,
                F.when(
                    F.length("raw_html") > K.MARKDOWN_MIN_HTML,
                    markdown(join_tokens(_c("tok_m"), target["node"], _c("gone"))),
                ).otherwise(_c("merged_text")),
            ),
            "confidence": scores.final_confidence(
                _c("mapper_confidence"), _c("scorer_confidence"), _c("validator_confidence")
            ),
        },
    ]


@cache
def _result_columns() -> dict[str, Column]:
    target, size, live = _c("target"), _c("text_size"), _c("nodes").isNotNull()
    bot, hit = _c("anti_bot").isNotNull(), _c("structure_cache_hit")
    empty = live & (size < K.EMPTY_FLOOR)
    thin = live & (size >= K.EMPTY_FLOOR) & (size < K.SHORT_FLOOR)
    whole = live & (size >= K.SHORT_FLOOR)

    def on_path(c):
        return F.when(live, c)

    metadata = F.struct(
        F.when(bot, "").otherwise(target["selector"]).alias("selector"),
        F.lit(K.EXTRACTOR).alias("extractor"),
        F.when(live & hit, K.PIPELINE_CACHED).otherwise(K.PIPELINE_FULL).alias("pipeline"),
        F.when(bot, 0.0)
        .when(thin, F.least(_c("confidence"), F.lit(K.SOFT_CONFIDENCE_CAP)))
        .otherwise(_c("confidence"))
        .alias("confidence"),
        *[on_path(_c(n)).alias(n) for n in (
            "mapper_confidence", "scorer_confidence", "validator_confidence", "validation_pass",
            "validation_warning", "scored_blocks_count",
        )],
        on_path(F.size("noise_selectors")).alias("noise_selectors_found"),
        on_path(_c("pruned_static")).alias("pruned_static"),
        on_path(_c("pruned_dynamic")).alias("pruned_dynamic"),
        on_path(_c("pruned_static") + _c("pruned_dynamic")).alias("pruned_total"),
        on_path(F.size("embeds")).alias("iframes_extracted"),
        on_path(F.length("merged_text")).alias("text_length"),
        F.lit(True).alias("content_aware"),
        F.lit(None).cast("int").alias("fetch_ms"),
        F.lit(None).cast("int").alias("parse_ms"),
        on_path(hit).alias("structure_cache_hit"),
        F.when(empty, True).alias("empty_content"),
        F.when(thin, True).alias("low_content_healed"),
        F.when(thin, True).alias("low_content"),
        F.when(bot, True).alias("anti_bot_detected"),
    )
    error = (
        F.when(_c("scan_error").isNotNull(), _c("scan_error"))
        .when(bot, _c("anti_bot"))
        .when(empty & hit, tx.fill(K.ERR_EMPTY_CACHED, size))
        .when(empty, tx.fill(K.ERR_EMPTY, size))
        .when(thin, tx.fill(K.ERR_LOW, size))
    )
    content = (
        F.when(thin, tx.wrap_low_content(_c("content"), _c("title"), _c("url")))
        .when(whole, _c("content"))
        .otherwise("")
    )
    return {
        "metadata": F.when(live | bot, metadata),
        "error": error,
        "finished": thin | whole,
        "finish_quality": _c("quality_score"),
        "content": content,
        "raw_content": F.lit(""),
        **{n: F.when(whole, _c(n)) for n in ("language", "quality_score", "main_content", "has_schema")},
    }


def finished(df: DataFrame, as_of: str) -> DataFrame:
    """Titles, confidence, Markdown, boundary wrap, quality columns, floors and errors."""
    for columns in _finish_columns():
        df = df.withColumns(columns)
    df = df.withColumn("content", tx.wrap_boundary(_c("md"), _c("title"), _c("url"), F.lit(as_of)))
    return with_quality(df).withColumns(_result_columns()).select(
        *RESULT_COLUMNS, "embeds", "noise_selectors", "scored_blocks", "finished", "finish_quality", "healed"
    )


def _run(pages: DataFrame, as_of: str, cached: bool, lean: bool) -> DataFrame:
    dom = scanned(pages)
    if cached:
        return finished(cached_or_full(dom), as_of)
    return finished(full_path(dom, lean).withColumns({"structure_cache_hit": F.lit(False), "healed": F.lit(False)}), as_of)


def extract(
    pages: DataFrame,
    as_of: str,
    structure: DataFrame | None = None,
    embeds: bool = True,
    ttl_hours: int = K.STRUCTURE_TTL_HOURS,
    web: DataFrame | None = None,
    lookup: Callable[[DataFrame], DataFrame] | None = None,
    lean: bool = False,
) -> DataFrame:
    """Extract every page of ``(page_id, url, html)``; ``page_id`` is unique.

    ``structure`` is the stored structure table: hits take the cached path,
    and starved hits are healed through the full path.  ``as_of`` is the
    timestamp written into results and used for expiry.  Frames load from
    ``web``, by default *pages*.  Rows fail alone: the reason is in ``error``.
    ``lookup`` replaces the join with *structure* where pages and structure
    are stored in the same buckets.  ``lean`` is for readers of few columns: the
    full path's confidences, counts and blocks are then worked out only if read.
    """
    from webwinnow.sources.structure import lookup_structure

    cached = structure is not None or lookup is not None

    def prepared(rows):
        if lookup is not None:
            return lookup(rows)
        return rows if structure is None else lookup_structure(rows, structure, as_of, ttl_hours, pages)

    no_embeds = F.lit(None).cast(EMBEDS)
    if not embeds:
        return _run(prepared(pages).withColumn("all_embeds", no_embeds), as_of, cached, lean)
    framed = has_frame(_c("html"))
    plain = prepared(pages.where(~framed)).withColumn("all_embeds", no_embeds)
    texts = cut_lineage(embed_texts(pages, web).withColumnRenamed("embeds", "all_embeds"))
    with_frames = prepared(pages.where(framed)).join(texts, "page_id", "left")
    return _run(plain.unionByName(with_frames), as_of, cached, lean)


def extract_requested(
    urls: DataFrame, pages: DataFrame, as_of: str, cap: int | None = None, **options
) -> DataFrame:
    """Extract the requested ``(pos, url)`` rows from the page table, one result per position.

    A URL asked for twice gives two rows; one without a page gives an error row.
    """
    found = requested_pages(urls, pages, cap).select(_c("pos").cast("long").alias("page_id"), "url", "html")
    if options.get("embeds", True):
        found = cut_lineage(found)  # read by the frame scan and by both branches of the main pass
    return extract(found, as_of, web=pages, **options).withColumnRenamed("page_id", "pos")


def results(extracted: DataFrame) -> DataFrame:
    """The public result columns."""
    return extracted.select(*RESULT_COLUMNS)


