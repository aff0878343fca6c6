"""Validation of the pruned container."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from webwinnow.functions import scores
from webwinnow.functions.binding import let
from webwinnow.functions.dom import link_text_length
from webwinnow.functions.text import comma_count, trim_js
from webwinnow.operators.scorer import mean_top_score


def container_stats(nodes: Column, tok_t: Column, container: Column, gone: Column, text: Column) -> Column:
    """struct(found, text, commas, density) of the container, given its remaining *text*."""
    measured = F.struct(
        container.isNotNull().alias("found"),
        trim_js(text).alias("text"),
        F.coalesce(link_text_length(nodes, tok_t, container, gone), F.lit(0)).alias("link"),
    )

    def derive(m):
        size = F.length(m["text"])
        return F.struct(
            m["found"].alias("found"),
            size.alias("text"),
            comma_count(m["text"]).alias("commas"),
            scores.link_density(size, m["link"]).alias("density"),
        )

    return let(measured, derive)


def validation(stats: Column, ranked: Column) -> Column:
    return let(
        mean_top_score(ranked, 5),
        lambda avg: scores.validate(stats["found"], stats["text"], stats["commas"], stats["density"], avg),
    )
