"""Main-container search: semantic tags and roles, id/class pattern, density, body."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from webwinnow import constants as K
from webwinnow.functions.binding import let
from webwinnow.functions.dom import (
    first_match, node_selector, parse_selector, pattern_selector,
)


def _choice(selector: Column, confidence: float) -> Column:
    return let(
        selector,
        lambda s: F.when(s.isNotNull(), F.struct(s.alias("selector"), F.lit(confidence).alias("mapper_confidence"))),
    )


def semantic_container(nodes: Column) -> Column:
    """First semantic selector whose first match holds enough text; later ones are not looked at."""
    probes = F.array(*[
        F.struct(F.lit(s).alias("selector"), parse_selector(F.lit(s)).alias("css")) for s in K.SEMANTIC_SELECTORS
    ])

    def probe(found, p):
        size = first_match(nodes, p["css"])["size"]
        return F.coalesce(found, F.when(size >= K.MIN_CONTAINER_TEXT, p["selector"]))

    return F.aggregate(probes, F.lit(None).cast("string"), probe)


def pattern_container(nodes: Column) -> Column:
    """Longest element whose id or class holds a content token; the earliest on a tie."""
    named = F.filter(
        F.transform(
            nodes,
            lambda n: F.struct(pattern_selector(n).alias("selector"), n.alias("node")),
        ),
        lambda x: x["selector"].isNotNull(),
    )
    sized = F.transform(
        named,
        lambda x: F.struct(
            x["node"]["size"].alias("size"), (-x["node"]["id"]).alias("first"), x["selector"]
        ),
    )
    return F.array_max(F.filter(sized, lambda x: x["size"] >= K.MIN_CONTAINER_TEXT))["selector"]


def density_container(nodes: Column) -> Column:
    """Element with the most text per element among the sectioning tags; the earliest on a tie."""
    sized = F.transform(
        F.filter(nodes, lambda n: n["tag"].isin(*K.DENSITY_TAGS)),
        lambda n: F.struct(n["inner"].alias("size"), n.alias("node")),
    )
    ranked = F.transform(
        F.filter(sized, lambda x: x["size"] >= K.MIN_CONTAINER_TEXT),
        lambda x: F.struct(
            (x["size"] - (x["node"]["last"] - x["node"]["id"])).alias("rank"),
            (-x["node"]["id"]).alias("first"),
            node_selector(x["node"]).alias("selector"),
        ),
    )
    return F.array_max(ranked)["selector"]


def map_container(nodes: Column) -> Column:
    """struct(selector, mapper_confidence) of the first search that finds a container."""
    return F.coalesce(
        _choice(semantic_container(nodes), K.SEMANTIC_CONFIDENCE),
        _choice(pattern_container(nodes), K.PATTERN_CONFIDENCE),
        _choice(density_container(nodes), K.DENSITY_CONFIDENCE),
        _choice(F.lit("body"), K.BODY_CONFIDENCE),
    )
