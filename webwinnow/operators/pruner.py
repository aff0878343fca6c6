"""Noise removal inside the container: fixed selectors, then the scorer's selectors in order."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from webwinnow import constants as K
from webwinnow.functions.binding import let
from webwinnow.functions.dom import (
    descendants, inner_text, join_tokens, matches, reached, remaining, spans, static_noise_index, text_content, text_size,
    topmost, with_touched,
)
from webwinnow.functions.text import trim_js
from webwinnow.schemas import NODE

_NODE = NODE.simpleString()
_MATCH = "struct<id:int,last:int,s:int,e:int,rule:int>"


def static_matches(nodes: Column, container: Column) -> Column:
    """Container descendants that match a fixed noise selector, with the selector's position."""
    tagged = F.transform(
        descendants(nodes, container),
        lambda n: F.struct(n["id"], n["last"], n["s"], n["e"], static_noise_index(n).alias("rule")),
    ).cast(f"array<{_MATCH}>")
    return F.coalesce(F.filter(tagged, lambda m: m["rule"].isNotNull()), F.array().cast(f"array<{_MATCH}>"))


def static_gone(found: Column) -> Column:
    """Matches -> disjoint removed subtrees."""
    return spans(topmost(found))


def static_count(found: Column) -> Column:
    """Number of removals: a match below one removed by an earlier selector is not counted.

    One sweep per selector position that occurs, over how far the matches of earlier selectors reach.
    """
    def counted(total, rule):
        ends = reached(F.transform(found, lambda m: F.when(m["rule"] < rule, m["last"]).otherwise(-1)))
        free = F.zip_with(found, ends, lambda m, end: (m["rule"] == rule) & (m["id"] > end))
        return total + F.size(F.filter(free, lambda x: x))

    nested = F.exists(found, lambda m: m["last"] > m["id"])
    rules = F.array_distinct(F.transform(found, lambda m: m["rule"]))
    return F.when(nested, F.aggregate(rules, F.lit(0), counted)).otherwise(F.size(found))


def dynamic_prune(nodes: Column, tok_t: Column, container: Column, gone: Column, sheet: Column) -> Column:
    """Remove, selector by selector, matches whose own text is at most 60 characters.

    ``sheet`` holds the parsed noise selectors.  Returns struct(gone, removed).  Each selector sees the page as the earlier
    ones left it.  Within one selector an outer match is judged before the
    matches inside it; those inside a removed match are detached by then and
    are judged (and counted) by their plain text content.
    """
    candidates = F.filter(
        remaining(nodes, container, gone), lambda n: F.exists(sheet, lambda css: matches(n, css))
    )
    state = F.struct(
        candidates.cast(f"array<{_NODE}>").alias("left"), gone.alias("gone"), F.lit(0).alias("removed")
    )

    def step(acc, css):
        def plain_short(n):
            return F.length(trim_js(text_content(join_tokens(tok_t, n, acc["gone"])))) <= K.NOISE_TEXT_CAP

        marked = F.transform(
            with_touched(acc["left"], acc["gone"]),
            lambda x: let(
                matches(x["n"], css),
                lambda hit: F.struct(
                    x["n"],
                    hit.alias("hit"),
                    F.when(hit, text_size(tok_t, x["n"], acc["gone"], x["touched"]) <= K.NOISE_TEXT_CAP)
                    .otherwise(False)
                    .alias("short"),
                ),
            ),
        )

        def swept(m):
            """A short hit is cut unless it lies in an earlier one; hits inside a cut are judged by their plain text."""
            ends = reached(F.transform(m, lambda x: F.when(x["short"], x["n"]["last"]).otherwise(-1)))
            return F.zip_with(m, ends, lambda x, end: F.struct(x["n"], x["hit"], x["short"], (x["n"]["id"] <= end).alias("inside")))

        def picked(tagged, which):
            return F.transform(F.filter(tagged, which), lambda x: x["n"])

        def commit(run):
            return F.struct(
                run["left"].alias("left"),
                F.when(F.size(run["cut"]) == 0, acc["gone"])
                .otherwise(topmost(F.array_sort(F.concat(acc["gone"], run["cut"]))))
                .alias("gone"),
                (acc["removed"] + F.size(run["cut"]) + run["inner"]).alias("removed"),
            )

        def outcome(tagged):
            below = F.filter(tagged, lambda x: x["inside"] & x["hit"])
            return F.struct(
                picked(tagged, lambda x: ~x["inside"] & ~x["short"]).alias("left"),
                spans(picked(tagged, lambda x: ~x["inside"] & x["short"])).alias("cut"),
                F.size(F.filter(below, lambda x: plain_short(x["n"]))).alias("inner"),
            )

        return let(let(let(marked, swept), outcome), commit)

    untouched = F.struct(gone.alias("gone"), F.lit(0).alias("removed"))
    folded = F.aggregate(
        sheet, state, step, lambda acc: F.struct(acc["gone"].alias("gone"), acc["removed"].alias("removed"))
    )
    return F.when(F.size(sheet) > 0, folded).otherwise(untouched)


def prune_and_text(nodes: Column, tok_t: Column, container: Column) -> Column:
    """Fixed-selector prune, then text: struct(text, removed)."""
    def build(found):
        return F.struct(
            F.coalesce(inner_text(tok_t, container, static_gone(found)), F.lit("")).alias("text"),
            static_count(found).alias("removed"),
        )

    return let(static_matches(nodes, container), build)


