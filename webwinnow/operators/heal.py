"""Fallback ladder for thin text."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from webwinnow import constants as K
from webwinnow.functions.binding import let
from webwinnow.functions.dom import first_match, inner_text, parse_selector, remaining
from webwinnow.functions.text import strip



def heal_ladder(nodes: Column, tok_t: Column, gone: Column, selector: Column, container: Column, text: Column) -> Column:
    """struct(size, rank, selector, node, text): the current text, or the longest ladder text that beats it.

    Ties go to the current selector, then to the earlier rung; the current
    selector is not tried again.
    """
    page = F.get(nodes, F.lit(0))
    alive = F.concat(F.array(page), remaining(nodes, page, gone))

    def option(rank, chosen, node, words):
        return F.struct(
            F.length(strip(words)).alias("size"), (-rank).alias("rank"),
            chosen.alias("selector"), node.alias("node"), words.alias("text"),
        )

    def rung(r):
        def measure(node):
            return let(
                inner_text(tok_t, node, gone),
                lambda words: F.when(words.isNotNull(), option(r["rank"], r["selector"], node, words)),
            )

        return F.when(selector != r["selector"], let(first_match(alive, r["css"]), measure))

    ladder = F.array(*[
        F.struct(F.lit(rank).alias("rank"), F.lit(s).alias("selector"), parse_selector(F.lit(s)).alias("css"))
        for rank, s in enumerate(K.HEAL_LADDER, 1)
    ])
    current = option(F.lit(0), selector, container, text)
    best = F.array_max(F.concat(F.array(current), F.transform(ladder, rung)))
    return F.when(F.length(strip(text)) < K.SHORT_FLOOR, best).otherwise(current)
