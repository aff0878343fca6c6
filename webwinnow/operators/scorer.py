"""Leaf-block scoring, ranking, noise selection and scorer confidence."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from webwinnow import constants as K
from webwinnow.functions import scores
from webwinnow.functions.dom import node_selector, topmost


def is_leaf_block(n: Column) -> Column:
    """A text-bearing tag, or a ``div`` without block children."""
    breakers = F.array(*map(F.lit, K.DIV_BREAKERS))
    return n["tag"].isin(*K.LEAF_TAGS) | ((n["tag"] == "div") & ~F.arrays_overlap(n["kids"], breakers))


def leaf_blocks(nodes: Column, container: Column) -> Column:
    """Outermost leaf blocks of the container (which may itself be one), in document order."""
    inside = F.slice(nodes, container["id"] + 1, container["last"] - container["id"] + 1)
    return topmost(F.filter(inside, is_leaf_block))


def ranked_blocks(nodes: Column, container: Column) -> Column:
    """Scored leaf blocks, best first, ties in document order; empty without a container.

    Text, link and comma counts are the element's own measures, summed up by the page scan; no text is rendered here.
    """
    counted = F.transform(
        leaf_blocks(nodes, container),
        lambda n: F.struct(
            n["id"].alias("id"),
            node_selector(n).alias("selector"),
            n["size"].alias("text"),
            (n["last"] - n["id"]).alias("tags"),
            n["links"].alias("link"),
            n["commas"].alias("commas"),
        ),
    )
    scored = F.transform(
        counted,
        lambda b: F.struct(
            (-scores.block_score(b["text"], b["tags"], b["link"], b["commas"])).alias("order"),
            b["id"].alias("node_id"),
            b["selector"].alias("selector"),
            b["text"].alias("text_length"),
            b["tags"].alias("tag_count"),
            b["link"].alias("link_text_length"),
            b["commas"].alias("comma_count"),
        ),
    )
    ranked = F.array_sort(F.coalesce(scored, F.array()))
    derived = F.transform(
        ranked,
        lambda b: F.struct(
            b["node_id"], b["selector"], b["text_length"], b["tag_count"], b["link_text_length"], b["comma_count"],
            scores.link_density(b["text_length"], b["link_text_length"]).alias("link_density"),
            scores.text_density(b["text_length"], b["tag_count"]).alias("text_density"),
            (F.lit(0.0) - b["order"]).alias("score"),
        ),
    )
    return F.transform(
        derived,
        lambda b: F.struct(
            *[b[f] for f in (
                "node_id", "selector", "text_length", "tag_count", "link_text_length", "comma_count",
                "link_density", "text_density", "score",
            )],
            scores.is_likely_noise(b["selector"], b["text_length"], b["link_density"], b["score"]).alias("is_noise"),
        ),
    )


def noise_selectors(ranked: Column, cap: int = K.MAX_NOISE_BLOCKS) -> Column:
    """Selectors of the first noise blocks in rank order, repeats kept."""
    return F.slice(F.transform(F.filter(ranked, lambda b: b["is_noise"]), lambda b: b["selector"]), 1, cap)


def mean_top_score(ranked: Column, k: int) -> Column:
    """Mean score of the first *k* blocks; 0 without blocks."""
    total = F.aggregate(F.slice(ranked, 1, k), F.lit(0.0), lambda acc, b: acc + b["score"])
    return F.when(F.size(ranked) == 0, 0.0).otherwise(total / F.least(F.size(ranked), F.lit(k)))


def confidence(ranked: Column) -> Column:
    return scores.scorer_confidence(
        F.size(ranked),
        F.size(F.filter(ranked, lambda b: b["score"] >= K.SCORE_THRESHOLD)),
        mean_top_score(ranked, 3),
        F.aggregate(ranked, F.lit(0), lambda acc, b: acc + b["text_length"]),
    )


def stored_blocks(ranked: Column) -> Column:
    """Block records of the structure table, rounded to 3 decimals."""
    return F.transform(
        ranked,
        lambda b: F.struct(
            b["selector"].alias("selector"),
            scores.round3(b["score"]).alias("score"),
            b["text_length"].alias("text_length"),
            b["tag_count"].alias("tag_count"),
            scores.round3(b["link_density"]).alias("link_density"),
            scores.round3(b["text_density"]).alias("text_density"),
            b["comma_count"].alias("comma_count"),
        ),
    )
