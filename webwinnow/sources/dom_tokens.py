"""Element tree -> node rows and document-order tokens (the payload of the page scan).

Each page yields one node record per element (preorder ``id``, ``last`` =
highest id in its subtree, ``s``/``e`` = its first and last token) and, per
token, three renderings: ``t`` for rendered text, ``h`` for HTML and ``m`` for
Markdown.  A subtree is a contiguous slice of both arrays.
"""

from __future__ import annotations

import re
from urllib.parse import urljoin

from webwinnow import constants as K
from webwinnow.sources.html_tree import RAW_TEXT, VOID
from webwinnow.sources.measures import add_measures

# Rendering groups of the HTML standard's default style sheet.
BLOCK = frozenset(
    "html body address article aside blockquote caption center dd details dialog dir div dl dt fieldset "
    "figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 header hgroup hr legend li listing main menu "
    "nav ol optgroup option plaintext pre search section summary table ul xmp".split()
)
NOT_RENDERED = frozenset(
    "area base basefont datalist head link meta noembed noframes noscript param rp script style template title".split()
)
NO_INNER_TEXT = frozenset("iframe video audio canvas textarea".split())
MD_SILENT = frozenset("head script style template title noscript iframe noframes noembed".split())
MD_INLINE = {
    "b": "**", "strong": "**", "i": "*", "em": "*", "s": "~~", "del": "~~",
    "code": "`", "kbd": "`", "samp": "`",
}
MD_BLOCK = (BLOCK | {"p"}) - {"html", "body", "table", "li", "ul", "ol", "option", "optgroup"}
VIEWPORT = {"width": 1280, "height": 720}
DEFAULT_FRAME = {"width": 300, "height": 150}

_NO_DISPLAY = re.compile(r"(?:^|;)\s*display\s*:\s*none", re.I)
_PRESERVE = str.maketrans({" ": K.T_SPACE, "\n": K.T_NEWLINE, "\t": K.T_TAB})
_HTML_TEXT = (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ("\xa0", "&nbsp;"))
_HTML_ATTR = (("&", "&amp;"), ('"', "&quot;"), ("\xa0", "&nbsp;"))
_INTEGER = re.compile(r"[ \t\n\f\r]*([+-]?[0-9]{1,12})(?![0-9])")
_MD_ESCAPE = (("*", "\\*"), ("_", "\\_"))


def _escaped(text, marks):
    """*text* with each character of *marks* replaced; ``&`` comes first, so no escape is escaped again."""
    for char, escape in marks:
        if char in text:
            text = text.replace(char, escape)
    return text


def _hides(node):
    attrs = node.attrs
    return (
        node.tag in NOT_RENDERED
        or "hidden" in attrs
        or (node.tag == "dialog" and "open" not in attrs)
        or (node.tag == "input" and attrs.get("type", "").lower() == "hidden")
        or ("style" in attrs and _NO_DISPLAY.search(attrs["style"]) is not None)
    )


def frame_size(attrs, side):
    """Declared frame size in pixels; a percentage is taken of a 1280x720 view."""
    found = re.search(r"(?:^|;)\s*%s\s*:\s*([\d.]+)(px|%%)" % side, attrs.get("style", ""), re.I) or re.match(
        r"\s*([\d.]+)(%)?", attrs.get(side, "")
    )
    if not found:
        return DEFAULT_FRAME[side]
    try:
        size = float(found.group(1))
    except ValueError:
        return DEFAULT_FRAME[side]
    return round(size * VIEWPORT[side] / 100 if found.group(2) == "%" else size)


class Context:
    """What an element passes on to its children."""

    __slots__ = ("hidden", "pre", "prefix", "flat", "code", "styles", "in_item")

    def __init__(self, hidden=False, pre=False, prefix="", flat=False, code=False, styles=frozenset(), in_item=False):
        self.hidden, self.pre, self.prefix, self.flat = hidden, pre, prefix, flat
        self.code, self.styles, self.in_item = code, styles, in_item

    def child(self, **changes):
        out = Context(self.hidden, self.pre, self.prefix, self.flat, self.code, self.styles, self.in_item)
        for key, value in changes.items():
            setattr(out, key, value)
        return out


def _text_edges(node, hidden):
    tag = node.tag
    if hidden:
        return "", ""
    if tag == "p":
        return K.T_PARA, K.T_PARA
    if tag == "br":
        return K.T_BR, ""
    if tag in ("td", "th"):
        return "", K.T_CELL
    if tag == "tr":
        return "", K.T_ROW
    if tag == "table":
        return K.T_BLOCK, K.T_TABLE + K.T_BLOCK
    if tag in BLOCK:
        return K.T_BLOCK, K.T_BLOCK
    return "", ""


def list_start(value):
    """The first item number of an ordered list: the leading integer of *value* if it fits in 32 bits, else 1."""
    found = _INTEGER.match(value or "")
    number = int(found[1]) if found else 1
    return number if abs(number) < 1 << 31 else 1


def _item_number(node, counters):
    """The number of an item of an ordered list, before pruning; none for other elements."""
    if node.tag != "li" or node.foreign or node.parent is None or node.parent.tag != "ol":
        return None
    at = id(node.parent)
    counters[at] = counters.get(at, list_start(node.parent.attrs.get("start")) - 1) + 1
    return counters[at]


def _markdown_edges(node, ctx, tables, numbers):
    """Opening and closing Markdown of an element, and the context of its children."""
    tag, prefix = node.tag, ctx.prefix
    para = K.M_PARA + prefix + K.M_STOP
    line = K.M_LINE + prefix + K.M_STOP
    if node.foreign:
        return "", "", ctx
    if tag in MD_INLINE:
        mark = MD_INLINE[tag]
        if ctx.code or mark in ctx.styles:
            return "", "", ctx
        inner = ctx.child(styles=ctx.styles | {mark}, code=ctx.code or mark == "`")
        return K.M_OPEN + mark + K.M_END, K.M_CLOSE + mark + K.M_END, inner
    if tag == "a":
        href = node.attrs.get("href")
        if not href or ctx.code:
            return "", "", ctx
        return K.M_OPEN + "[" + K.M_END, K.M_CLOSE + "](" + href + ")" + K.M_END, ctx
    if tag == "img":
        alt = " ".join(node.attrs.get("alt", "").split())
        return (alt if ctx.flat else "![%s](%s)" % (alt, node.attrs.get("src", ""))), "", ctx
    if tag == "br":
        return (" " if ctx.flat else K.M_BREAK + prefix + K.M_STOP), "", ctx
    if ctx.flat:
        return (" ", " ", ctx) if tag in BLOCK or tag == "p" else ("", "", ctx)
    if tag in ("ul", "ol"):
        if ctx.in_item:
            return line, line, ctx
        return K.M_LIST + prefix + K.M_STOP, para, ctx
    if tag == "li":
        number = numbers.get(id(node))
        bullet = "- " if number is None else "%d. " % number
        return K.M_ITEM + prefix + bullet + K.M_STOP, line, ctx.child(prefix=prefix + K.T_SPACE * len(bullet), in_item=True)
    if tag in ("h1", "h2", "h3", "h4", "h5", "h6"):
        mark = "#" * int(tag[1]) + " "
        return para + K.M_OPEN + mark + K.M_END, K.M_CLOSE + K.M_END + para, ctx.child(flat=True)
    if tag == "blockquote":
        inner = ctx.child(prefix=prefix + ">" + K.T_SPACE)
        return K.M_PARA + inner.prefix + K.M_STOP, para, inner
    if tag in ("pre", "listing", "xmp"):
        fence = "```"
        opened = para + fence + K.T_NEWLINE + prefix
        return opened, K.T_NEWLINE + prefix + fence + para, ctx.child(code=True)
    if tag == "hr":
        return para + "---" + para, "", ctx
    if tag == "table":
        return para, para, ctx
    if tag == "tr":
        table = node.parent
        while table is not None and table.tag != "table":
            table = table.parent
        close = line
        if table is not None and tables.setdefault(id(table), node) is node:
            width = sum(k.tag in ("td", "th") for k in node.kids)
            close = line + "|" + " --- |" * max(width, 1) + line
        return line + "|", close, ctx
    if tag in ("td", "th"):
        return " ", " |", ctx.child(flat=True)
    if tag in MD_BLOCK:
        return para, para, ctx
    return "", "", ctx


class PageRows:
    """Flat output columns of a batch of pages."""

    NODE_FIELDS = ("id", "parent", "tag", "elem_id", "classes", "foreign", "role", "rel", "hidden", "kids", "s", "number")
    ENDS = ("last", "e")  # per element, known when it closes
    MEASURES = ("size", "commas", "links", "inner")  # per element, added when its page is done
    FRAME_FIELDS = ("node_id", "src", "width", "height")

    def __init__(self):
        self.nodes = {f: [] for f in self.NODE_FIELDS + self.ENDS + self.MEASURES}
        self.frames = {f: [] for f in self.FRAME_FIELDS}
        self.t, self.h, self.m = [], [], []
        self.node_ends, self.frame_ends, self.token_ends = [0], [0], [0]

    def close_page(self):
        self.node_ends.append(len(self.nodes["id"]))
        self.frame_ends.append(len(self.frames["node_id"]))
        self.token_ends.append(len(self.t))

    def drop_open_page(self):
        """Forget what a failed page has written so far."""
        for columns, ends in ((self.nodes, self.node_ends), (self.frames, self.frame_ends)):
            for values in columns.values():
                del values[ends[-1] :]
        for values in (self.t, self.h, self.m):
            del values[self.token_ends[-1] :]

    def add_page(self, root, url):
        n, base_n, base_t = self.nodes, len(self.nodes["id"]), len(self.t)
        made, last, end = [], [], []  # per element; its subtree's last element and token are known when it closes
        tables: dict = {}
        counters: dict = {}
        numbers: dict = {}
        work = [(root, -1, Context(), None)]
        while work:
            node, parent, ctx, closing = work.pop()
            if closing is not None:
                me, t, h, m = closing
                self._token(t, h, m)
                last[me], end[me] = len(made) - 1, len(self.t) - base_t
                continue
            if node.text is not None:
                self._text(node, ctx)
                continue
            tag, attrs = node.tag, node.attrs
            hidden = ctx.hidden or _hides(node)
            me = len(made)
            t_open, t_close = _text_edges(node, hidden)
            numbers[id(node)] = number = _item_number(node, counters)
            m_open, m_close, inner = _markdown_edges(node, ctx, tables, numbers)
            h_open = "<" + tag + "".join([' %s="%s"' % (k, _escaped(v, _HTML_ATTR)) for k, v in attrs.items()]) + ">"
            self._token(t_open, h_open, m_open)
            kids = []
            if tag == "div":
                kids = list(dict.fromkeys(k.tag for k in node.kids if k.text is None))
            at = len(self.t) - base_t
            made.append((
                me, parent, tag, attrs.get("id") or None, (attrs.get("class") or "").split(), node.foreign,
                attrs.get("role"), attrs.get("rel"), hidden, kids, at, number,
            ))
            last.append(me)
            end.append(at)
            if tag == "iframe":
                self._frame(me, attrs, url, hidden)
            if tag in VOID and not node.foreign:
                if m_close or t_close:
                    self.m[-1] += m_close
                continue
            pre, unseen = ctx.pre or tag in ("pre", "listing", "xmp"), hidden or tag in NO_INNER_TEXT
            if inner.hidden != unseen or inner.pre != pre:
                inner = inner.child(hidden=unseen, pre=pre)
            work.append((node, parent, ctx, (me, t_close, "</" + tag + ">", m_close)))
            if tag != "template":
                work.extend([(kid, me, inner, None) for kid in reversed(node.kids)])
        for field, values in zip(self.NODE_FIELDS, zip(*made)):
            n[field] += values
        n["last"] += last
        n["e"] += end
        add_measures(n, base_n, self.t[base_t:])
        self.close_page()

    def _token(self, t, h, m):
        self.t.append(t)
        self.h.append(h)
        self.m.append(m)

    def _text(self, node, ctx):
        data, parent = node.text, node.parent.tag
        if node.tag == "#comment":
            return self._token("", "<!--" + data + "-->", "")
        h = data if parent in RAW_TEXT else _escaped(data, _HTML_TEXT)
        if ctx.hidden:
            t = K.T_HIDE + data + K.T_SHOW
        else:
            t = data.translate(_PRESERVE) if ctx.pre else data
        if parent in MD_SILENT:
            m = ""
        elif ctx.pre:
            m = data.replace("\n", "\n" + ctx.prefix).translate(_PRESERVE)
        else:
            m = data if ctx.code else _escaped(data, _MD_ESCAPE)
        self._token(t, h, m)

    def _frame(self, me, attrs, url, hidden):
        src = (attrs.get("src") or "").strip()
        try:
            src = urljoin(url or "", src) if src else ""
        except ValueError:
            pass
        size = (0, 0) if hidden else (frame_size(attrs, "width"), frame_size(attrs, "height"))
        for field, value in zip(self.FRAME_FIELDS, (me, src, *size)):
            self.frames[field].append(value)
