"""Markdown tokens -> Markdown text."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from webwinnow import constants as K
from webwinnow.functions.binding import let
from webwinnow.functions.dom import PRESERVED, between_text, collapsed, put_back
from webwinnow.functions.text import strip

# Break tokens end in M_STOP, inline marks in M_END. Repeated groups are possessive throughout: Java matches those in
# a loop, while a backtracking group costs a stack frame per repetition and overflows on long runs.
_MARK = f"[^{K.M_END}]*+{K.M_END}"
_BODY = f"[^{K.M_STOP}]*+{K.M_STOP}"
_KEEP = f"([^{K.M_STOP}]*+){K.M_STOP}"
_ANY = f"[{K.M_PARA}-{K.M_ITEM}]"
_MARKS = f"{_ANY}{_BODY}|[{K.M_OPEN}-{K.M_CLOSE}]{_MARK}|"
_SOFT = f"[{K.M_PARA}-{K.M_BREAK}]"
_NOT_LIST = f"[{K.M_PARA}{K.M_LINE}{K.M_BREAK}{K.M_ITEM}]"
_GAP = f"(?: |{_ANY}{_BODY})++"
_RUN = f"(?<!{K.M_STOP})(?={_ANY})"  # the start of a break run, once inline marks are gone
_ITEMS = f"(?:(?:{_SOFT}{_BODY})*+{K.M_ITEM}{_KEEP})++(?:{_SOFT}{_BODY})*+"  # group: prefix of the last item

# White space moves out of inline marks, then empty pairs go.
_TIDY = (
    (
        f"((?:{K.M_OPEN}{_MARK})++)({_GAP})"
        f"|(?<![ {K.M_STOP}])(?= ?[{K.M_PARA}-{K.M_ITEM}{K.M_CLOSE}])({_GAP})((?:{K.M_CLOSE}{_MARK})++)",
        "$2$1$4$3",
    ),
    (f"{K.M_OPEN}{_MARK}{K.M_CLOSE}{_MARK}", ""),
)
_STEPS = (
    _TIDY * 2
    + (
        (f"[{K.M_OPEN}-{K.M_CLOSE}]([^{K.M_END}]*+){K.M_END}", "$1"),
        (f" ++(?={_ANY})|(?<={K.M_STOP}) ++", ""),
        # A break run resolves to its strongest break and its last line prefix.
        (f"{_RUN}(?=(?:{_NOT_LIST}{_BODY})*+{K.M_LIST}{_BODY}(?:{_SOFT}{_BODY})*+{K.M_ITEM}){_ITEMS}", "\n\n$1"),
        (f"{_RUN}{_ITEMS}", "\n$1"),
        (f"{_RUN}(?=(?:[{K.M_LINE}{K.M_BREAK}]{_BODY})*+[{K.M_PARA}{K.M_LIST}])(?:{_SOFT}{_KEEP})++", "\n\n$1"),
        (f"{_RUN}(?:{K.M_LINE}{_BODY})++(?={K.M_BREAK})", ""),
        (f"{K.M_BREAK}{_KEEP}(?:{K.M_LINE}{_BODY})*+", "  \n$1"),
        (f"(?:{K.M_LINE}{_KEEP})++", "\n$1"),
    )
)


def renumbered(tok_m: Column, nodes: Column, gone: Column) -> Column:
    """Markdown tokens with the numbers of ordered items closed up over removed items."""
    def close_up(removed):
        shifted = F.transform(
            F.filter(nodes, lambda n: n["number"].isNotNull()),
            lambda n: F.struct(
                n["s"].alias("s"), n["number"].alias("number"),
                F.size(
                    F.filter(removed, lambda r: (r["parent"] == n["parent"]) & (r["id"] < n["id"]))
                ).alias("by"),
            ),
        )

        def ending(number):
            return F.concat(number.cast("string"), F.lit(". " + K.M_STOP))

        def rewrite(tokens, item):
            token = F.get(tokens, item["s"] - 1)
            head = F.substring(token, F.lit(1), F.length(token) - F.length(ending(item["number"])))
            new = F.when(F.endswith(token, ending(item["number"])), F.concat(head, ending(item["number"] - item["by"]))).otherwise(token)
            return F.concat(
                F.slice(tokens, F.lit(1), item["s"] - 1), F.array(new),
                F.slice(tokens, item["s"] + 1, F.size(tokens)),
            )

        fixed = F.aggregate(F.filter(shifted, lambda item: item["by"] > 0), tok_m, rewrite)
        return F.when(F.size(removed) > 0, fixed).otherwise(tok_m)

    heads = F.transform(gone, lambda r: F.get(nodes, r["id"]))
    return let(F.filter(heads, lambda n: n["number"].isNotNull()), close_up)


def markdown(joined: Column) -> Column:
    """Resolve Markdown tokens: ATX headings, ``-`` bullets, at most one blank line, stripped."""
    return let(collapsed(joined), lambda spaced: strip(between_text(spaced, _resolved, _MARKS)))


def _resolved(joined: Column) -> Column:
    for pattern, put in _STEPS:
        joined = F.regexp_replace(joined, pattern, put)
    return F.regexp_replace(put_back(joined, PRESERVED), r"\n{3,}", "\n\n")
