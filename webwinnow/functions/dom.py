"""Column functions over a page's nested DOM: selectors, subtrees, text, HTML, Markdown.

A node's subtree is the slice ``id .. last`` of ``nodes`` and the slice
``s .. e`` of each token array, so containment is arithmetic on two integers
and needs no join.  ``gone`` arguments are the removed subtrees: disjoint,
sorted by ``s``, each with ``id``, ``last``, ``s`` and ``e``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, functions as F

from webwinnow import constants as K
from webwinnow.functions.binding import let, running
from webwinnow.functions.text import trim_js

# The shape of the simple selectors in use.
_NAME = r"(?:--|-?(?:[_a-zA-Z]|[^\x00-\x7f]))(?:[-_a-zA-Z0-9]|[^\x00-\x7f])*"
_SELECTOR = rf"^([a-zA-Z][a-zA-Z0-9-]*)?(?:#({_NAME}))?((?:\.{_NAME})*)(?:\[role=\"([^\"]*)\"\])?$"

_REMOVED = "array<struct<s:int,e:int,id:int,last:int>>"


# -- selectors -----------------------------------------------------------

def node_selector(n: Column) -> Column:
    """``tag#id``, else ``tag.c1.c2`` with unusual characters dropped, else ``tag``."""
    classes = F.regexp_replace(F.array_join(n["classes"], "."), r"[^a-zA-Z0-9_\-.]", "")
    return (
        F.when(n["elem_id"].isNotNull(), F.concat(n["tag"], F.lit("#"), n["elem_id"]))
        .when(n["foreign"] | (F.size(n["classes"]) == 0), n["tag"])
        .otherwise(F.regexp_replace(F.concat(n["tag"], F.lit("."), classes), r"^([^.]*)\.$", "$1"))
    )


def pattern_selector(n: Column) -> Column:
    """Selector of the first content token found in the id or in a class, else null."""
    def choice(token):
        found = F.filter(n["classes"], lambda c: F.lower(c).contains(token))
        return F.when(F.lower(n["elem_id"]).contains(token), F.concat(n["tag"], F.lit("#"), n["elem_id"])).when(
            ~n["foreign"] & (F.size(found) > 0), F.concat(n["tag"], F.lit("."), F.array_join(found, "."))
        )

    return F.coalesce(*map(choice, K.PATTERN_TOKENS))


def parse_selector(selector: Column) -> Column:
    """Selector text -> struct(tag, id, classes, role); null when it is not valid CSS."""
    def part(i):
        return F.nullif(F.regexp_extract(selector, _SELECTOR, i), F.lit(""))

    classes = F.coalesce(F.split(F.substring(part(3), 2, 1 << 30), r"\."), F.array().cast("array<string>"))
    return F.when(
        selector.rlike(_SELECTOR) & (selector != ""),
        F.struct(part(1).alias("tag"), part(2).alias("id"), classes.alias("classes"), part(4).alias("role")),
    )


def matches(n: Column, css: Column) -> Column:
    """Does the node match a parsed selector?"""
    return F.coalesce(
        (css["tag"].isNull() | (n["tag"] == F.lower(css["tag"])))
        & (css["id"].isNull() | n["elem_id"].eqNullSafe(css["id"]))
        & (css["role"].isNull() | n["role"].eqNullSafe(css["role"]))
        & (F.size(F.array_except(css["classes"], n["classes"])) == 0)
        & css.isNotNull(),
        F.lit(False),
    )


def static_noise_index(n: Column) -> Column:
    """Position of the first static noise selector the node matches, else null."""
    rule = None
    for index, selector in enumerate(K.STATIC_NOISE):
        if selector.startswith("."):
            hit = F.array_contains(n["classes"], selector[1:])
        elif selector.startswith("#"):
            hit = n["elem_id"].eqNullSafe(selector[1:])
        elif selector.startswith("link["):
            hit = (n["tag"] == "link") & n["rel"].eqNullSafe("import")
        else:
            hit = n["tag"] == selector
        rule = F.when(hit, index) if rule is None else rule.when(hit, index)
    return rule


# -- subtrees ------------------------------------------------------------

def within(n: Column, outer: Column) -> Column:
    """Is *n* the node *outer* or inside it?"""
    return (n["id"] >= outer["id"]) & (n["id"] <= outer["last"])


def is_gone(n: Column, gone: Column) -> Column:
    return F.exists(gone, lambda r: within(n, r))


def descendants(nodes: Column, n: Column) -> Column:
    return F.slice(nodes, n["id"] + 2, n["last"] - n["id"])


def around(items: Column, first: Column, last: Column, holes: Column, start: str, stop: str) -> Column:
    """Elements ``first .. last`` (1-based) of *items* without the holes, by slices between them."""
    def piece(i):
        begin = F.when(i == 0, first).otherwise(F.get(holes, i - 1)[stop] + 1)
        end = F.when(i == F.size(holes), last).otherwise(F.get(holes, i)[start] - 1)
        return F.slice(items, begin, end - begin + 1)

    return F.flatten(F.transform(F.sequence(F.lit(0), F.size(holes)), piece))


def remaining(nodes: Column, n: Column, gone: Column) -> Column:
    """Descendants of *n* outside the removed subtrees, in one linear pass."""
    holes = F.transform(
        F.filter(gone, lambda r: (r["id"] > n["id"]) & (r["last"] <= n["last"])),
        lambda r: F.struct((r["id"] + 1).alias("a"), (r["last"] + 1).alias("b")),
    )
    return let(holes, lambda h: around(nodes, n["id"] + 2, n["last"] + 1, h, "a", "b"))


def first_match(nodes: Column, css: Column) -> Column:
    """First node in document order that matches, or null."""
    return F.get(F.filter(nodes, lambda n: matches(n, css)), F.lit(0))


def reached(ends: Column) -> Column:
    """Per element in document order, how far the subtrees of the elements before it reach; -1 where there are none."""
    return let(running(ends, F.greatest), lambda x: F.concat(F.array(F.lit(-1)), F.slice(x, 1, F.greatest(F.size(x) - 1, F.lit(0)))))


def topmost(found: Column) -> Column:
    """Drop the elements that lie inside an earlier one (input in document order): one sweep by the furthest end so far."""
    def swept(items):
        free = F.zip_with(items, reached(F.transform(items, lambda n: n["last"])), lambda n, end: F.struct(n.alias("n"), (n["id"] > end).alias("free")))
        return F.transform(F.filter(free, lambda x: x["free"]), lambda x: x["n"])

    return let(found, lambda items: F.when(F.size(items) < 2, items).otherwise(swept(items)))


def spans(found: Column) -> Column:
    """Nodes -> removed-subtree records."""
    return F.transform(found, lambda n: F.struct(n["s"], n["e"], n["id"], n["last"])).cast(_REMOVED)


def no_spans() -> Column:
    return F.array().cast(_REMOVED)


_RESERVED = "\ufdd0-\ufdef"  # no page text holds them: the tree builder replaces them

# What the character markers stand for.
PRESERVED = ((K.T_NEWLINE, "\n"), (K.T_TAB, "\t"), (K.T_SPACE, " "))
_RENDERED = PRESERVED + ((K.T_BR, "\n"), (K.T_CELL, "\t"), (K.T_ROW, "\n"))


def put_back(c: Column, marks: tuple[tuple[str, str], ...]) -> Column:
    """Replace single-character markers (plain replacement is far faster than ``translate``)."""
    for mark, text in marks:
        c = F.replace(c, F.lit(mark), F.lit(text))
    return c


# -- tokens --------------------------------------------------------------

def join_tokens(tokens: Column, n: Column, gone: Column | None = None) -> Column:
    """Concatenate a subtree's tokens, leaving out the removed subtrees."""
    whole = F.array_join(F.slice(tokens, n["s"], n["e"] - n["s"] + 1), "")
    if gone is None:
        return whole
    return let(
        F.filter(gone, lambda r: (r["s"] >= n["s"]) & (r["e"] <= n["e"])),
        lambda holes: F.when(F.size(holes) == 0, whole).otherwise(
            F.array_join(around(tokens, n["s"], n["e"], holes, "s", "e"), "")
        ),
    )


def collapsed(joined: Column) -> Column:
    """Each run of white space as one space; texts without such a run skip the pattern."""
    odd = joined.contains("  ")
    for c in "\t\n\r\f":
        odd = odd | joined.contains(c)
    return F.when(odd, F.regexp_replace(joined, r"[\t\n\r\f][ \t\n\r\f]*+| [ \t\n\r\f]++", " ")).otherwise(joined)


def between_text(joined: Column, resolve: Callable[[Column], Column], marks: str = "") -> Column:
    """``resolve(joined)``, worked out with one character for each stretch of text, which is put back afterwards.

    For *resolve* that changes markers and the spaces beside them only, so its patterns pass the markers and not the
    text.  A stretch begins and ends with a visible character.  ``marks`` is the pattern of markers whose contents
    are no text.
    """
    head = rf"(\G(?:{marks}[ {_RESERVED}])*+)"
    text = rf"([^ {_RESERVED}](?:[^{_RESERVED}]*[^ {_RESERVED}])?)"
    parts = F.split(resolve(F.regexp_replace(joined, head + text, "$1" + K.T_HELD)), K.T_HELD, -1)
    texts = F.regexp_extract_all(joined, F.lit(head + text), F.lit(2))
    return F.array_join(F.flatten(F.zip_with(parts, texts, lambda part, text: F.array(part, text))), "")


def rendered_text(joined: Column) -> Column:
    """Resolve text tokens to what a browser reports as inner text."""
    shown = F.when(
        joined.contains(K.T_HIDE), F.regexp_replace(joined, f"{K.T_HIDE}[^{K.T_SHOW}]*{K.T_SHOW}", "")
    ).otherwise(joined)
    return let(F.trim(let(shown, collapsed)), lambda spaced: between_text(spaced, _broken))


def _broken(spaced: Column) -> Column:
    soft = f"[{K.T_BLOCK}-{K.T_PARA}]"
    # No spaces beside a break, no separator after a last cell or a last row.
    lines = F.regexp_replace(spaced, f" ?([{K.T_BLOCK}-{K.T_NEWLINE}]) ?", "$1")
    cells = F.regexp_replace(lines, f"{K.T_CELL}(?={K.T_ROW})|{K.T_ROW}(?={K.T_TABLE})|{K.T_TABLE}", "")
    inner = F.btrim(cells, F.lit(K.T_BLOCK + K.T_PARA))
    paras = F.regexp_replace(inner, f"(?={soft}){K.T_BLOCK}*{K.T_PARA}{soft}*", "\n\n")
    joined = F.regexp_replace(paras, f"{K.T_BLOCK}+", "\n")
    return put_back(joined, _RENDERED)


def text_content(joined: Column) -> Column:
    """Resolve text tokens to plain text content (no layout)."""
    drop = (K.T_BLOCK, K.T_PARA, K.T_BR, K.T_CELL, K.T_ROW, K.T_TABLE, K.T_HIDE, K.T_SHOW)
    return put_back(joined, PRESERVED + tuple((mark, "") for mark in drop))


def inner_text(tok_t: Column, n: Column, gone: Column | None = None) -> Column:
    """Inner text of a node; null for a null node."""
    return let(
        join_tokens(tok_t, n, gone),
        lambda joined: F.when(n["hidden"], text_content(joined)).otherwise(rendered_text(joined)),
    )


def trimmed_text(tok_t: Column, n: Column, gone: Column | None = None) -> Column:
    return trim_js(inner_text(tok_t, n, gone))


def text_size(tok_t: Column, n: Column, gone: Column, touched: Column) -> Column:
    """Length of a node's trimmed text; rendered again only where removed subtrees touch it."""
    return F.when(touched, F.length(trimmed_text(tok_t, n, gone))).otherwise(n["size"])


def with_touched(found: Column, gone: Column) -> Column:
    """Nodes in document order -> struct(n, touched): does a removed subtree start inside the node?

    One sweep from the end over nodes and removed subtrees together tells the next start after each node.
    """
    far = F.lit((1 << 31) - 1)

    def marks(items: Column, kind: int) -> Column:
        return F.transform(items, lambda x: F.struct(x["id"].alias("id"), F.lit(kind).alias("kind")))

    def flagged(both):
        starts = F.reverse(running(F.reverse(F.transform(both, lambda x: F.when(x["kind"] == 0, x["id"]).otherwise(far))), F.least))
        near = F.zip_with(both, starts, lambda x, start: F.when(x["kind"] == 1, start))
        return F.zip_with(found, F.filter(near, lambda x: x.isNotNull()), lambda n, start: F.struct(n.alias("n"), (start <= n["last"]).alias("touched")))

    untouched = F.transform(found, lambda n: F.struct(n.alias("n"), F.lit(False).alias("touched")))
    return F.when(F.size(gone) == 0, untouched).otherwise(let(F.array_sort(F.concat(marks(gone, 0), marks(found, 1))), flagged))


def link_text_length(nodes: Column, tok_t: Column, n: Column, gone: Column) -> Column:
    """Sum of the trimmed text lengths of the links inside a node, outside the removed subtrees."""
    def summed(links):
        return F.aggregate(links, F.lit(0), lambda total, x: total + text_size(tok_t, x["n"], gone, x["touched"]))

    links = F.filter(remaining(nodes, n, gone), lambda a: a["tag"] == "a")
    whole = F.exists(gone, lambda r: (r["id"] > n["id"]) & (r["last"] <= n["last"]))
    return F.when(whole, summed(with_touched(links, gone))).otherwise(n["links"])
