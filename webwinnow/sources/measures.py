"""Text measures of all elements of a page from running sums over its tokens.

A character is visible unless it is white space to a browser's ``trim`` or a token marker. What is rendered between two
neighbouring visible characters depends on the gap between them alone, so every visible character has one place in the
rendered page, and the trimmed text of an element is as long as the distance of its last visible character from its
first. Places are summed up once per page; an element costs two look-ups, however deep elements are nested.
"""

from __future__ import annotations

import re
from functools import lru_cache
from itertools import accumulate

from webwinnow import constants as K
from webwinnow.functions.text import JS_SPACE

_SOFT = K.T_BLOCK + K.T_PARA
_HARD = K.T_BR + K.T_CELL + K.T_ROW + K.T_TABLE + K.T_NEWLINE + K.T_SPACE + K.T_TAB
_EDGE = JS_SPACE + _SOFT + _HARD
_SPACES = re.compile(r"[ \t\n\r\f]+")
_AROUND = re.compile(f" ?([{K.T_BLOCK}-{K.T_NEWLINE}]) ?")
_CELLS = re.compile(f"{K.T_CELL}(?={K.T_ROW})|{K.T_ROW}(?={K.T_TABLE})|{K.T_TABLE}")
_SOFT_RUN = re.compile(f"[{_SOFT}]+")
_ODD = re.compile(f"[\t\n\r\f{K.T_BLOCK}-{K.T_TAB}]|  ")
_KEPT = re.compile(f"[{_HARD}{''.join(c for c in JS_SPACE if c not in ' \t\n\r\f')}]")


def rendered_size(text: str) -> int:
    """Length of the inner text that text tokens without hidden parts stand for."""
    if not _ODD.search(text):
        return len(text.strip(" "))
    lines = _AROUND.sub(r"\1", _SPACES.sub(" ", text).strip(" "))
    inner = _CELLS.sub("", lines).strip(_SOFT)
    return len(inner) + sum(1 + (K.T_PARA in run) - len(run) for run in _SOFT_RUN.findall(inner))


@lru_cache(4096)
def _short_gap(gap: str) -> int:
    return rendered_size("x" + gap + "x") - 2


def _gap(gap: str) -> int:
    return _short_gap(gap) if len(gap) <= 64 else rendered_size("x" + gap + "x") - 2


class _Places:
    """Places of visible characters: per token where its first one begins and its last one stops."""

    def __init__(self, tokens: int):
        self.begin, self.stop, self.commas = {}, {}, [0] * (tokens + 1)

    def close(self, tokens: int) -> None:
        """Per token, the next token at or after it and the last at or before it that hold a visible character."""
        self.next, self.last = [0] * (tokens + 2), [0] * (tokens + 1)
        for i in range(tokens, 0, -1):
            self.next[i] = i if i in self.begin else self.next[i + 1]
        for i in range(1, tokens + 1):
            self.last[i] = i if i in self.stop else self.last[i - 1]
        self.commas = list(accumulate(self.commas))

    def size(self, s: int, e: int) -> int:
        first = self.next[s]
        return self.stop[self.last[e]] - self.begin[first] if first and first <= e else 0


class TextMeasures:
    """Measures of elements, told by their first and last token (from 1)."""

    def __init__(self, tokens: list[str]):
        self.tokens = tokens
        self.shown, self.raw = _Places(len(tokens)), _Places(len(tokens))
        kept, place, raw_place, gap, seen = [0] * (len(tokens) + 1), 0, 0, [], False
        for i, x in enumerate(tokens, 1):
            if not x:
                continue
            if x[0] == K.T_HIDE:
                data = x[1:-1]
                body = data.strip(JS_SPACE)
                if body:
                    self.raw.begin[i] = raw_place + len(data) - len(data.lstrip(JS_SPACE))
                    self.raw.stop[i] = self.raw.begin[i] + len(body)
                    self.raw.commas[i] = body.count(",")
                raw_place += len(data)
                continue
            body = x.strip(_EDGE)
            if not body:
                gap.append(x)
                kept[i] = len(_KEPT.findall(x))
                continue
            lead = len(x) - len(x.lstrip(_EDGE))
            if seen:
                place += _gap("".join(gap) + x[:lead])
            self.shown.begin[i] = place
            place += rendered_size(body)
            self.shown.stop[i] = place
            self.shown.commas[i] = body.count(",")
            gap, seen = [x[lead + len(body) :]], True
        self.shown.close(len(tokens))
        self.raw.close(len(tokens))
        self.kept = list(accumulate(kept))

    def size(self, s: int, e: int, hidden: bool) -> int:
        """Length of the trimmed text."""
        return (self.raw if hidden else self.shown).size(s, e)

    def comma_count(self, s: int, e: int, hidden: bool) -> int:
        commas = (self.raw if hidden else self.shown).commas
        return commas[e] - commas[s - 1]

    def inner_size(self, s: int, e: int, hidden: bool) -> int:
        """Length of the text with the breaks that trimming drops at its ends."""
        if hidden:
            return sum(len(x) - 2 for x in self.tokens[s - 1 : e] if x[:1] == K.T_HIDE)
        first, last = self.shown.next[s], self.shown.last[e]
        if not first or first > e:
            return rendered_size(self._joined(s, e)) if self.kept[e] > self.kept[s - 1] else 0
        head, tail = self.tokens[first - 1], self.tokens[last - 1]
        lead = head[: len(head) - len(head.lstrip(_EDGE))]
        trail = tail[len(tail.rstrip(_EDGE)) :]
        size = self.shown.size(s, e)
        if self.kept[first - 1] > self.kept[s - 1] or _KEPT.search(lead):
            size += rendered_size(self._joined(s, first - 1) + lead + "x") - 1
        if self.kept[e] > self.kept[last] or _KEPT.search(trail):
            size += rendered_size("x" + trail + self._joined(last + 1, e)) - 1
        return size

    def _joined(self, s: int, e: int) -> str:
        return "".join(x for x in self.tokens[s - 1 : e] if x[:1] != K.T_HIDE)


def add_measures(nodes: dict[str, list], base: int, tokens: list[str]) -> None:
    """Append ``size``, ``commas``, ``links`` and ``inner`` of the nodes from *base* on, whose page has *tokens*."""
    text = TextMeasures(tokens)
    spans = list(zip(nodes["s"][base:], nodes["e"][base:], nodes["hidden"][base:]))
    sizes = [text.size(*x) for x in spans]
    tags = nodes["tag"][base:]
    linked = list(accumulate(size if tag == "a" else 0 for size, tag in zip(sizes, tags)))
    nodes["size"] += sizes
    nodes["commas"] += [text.comma_count(*x) for x in spans]
    nodes["links"] += [linked[last] - linked[me] for me, last in enumerate(nodes["last"][base:])]
    nodes["inner"] += [text.inner_size(*x) if tag in K.DENSITY_TAGS else None for x, tag in zip(spans, tags)]
