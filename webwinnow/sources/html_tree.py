"""HTML text -> element tree, for the page scan.

Only the tree-building rules of the HTML standard that change what a page
query sees are kept: void and raw-text elements, implied end tags, html / head
/ body synthesis, table sections, and the list of active formatting elements
(an unclosed ``<b>`` is re-opened in each later paragraph, at most three
copies).  Frames, quirks mode and template contents are left out.
"""

from __future__ import annotations

import html as _html
import re

# Element groups of the HTML standard.
VOID = frozenset(
    "area base basefont bgsound br col embed frame hr img input keygen link meta param source track wbr".split()
)
RAW_TEXT = frozenset("script style xmp iframe noembed noframes noscript".split())
ESCAPABLE_TEXT = frozenset(("title", "textarea"))
HEADINGS = frozenset(("h1", "h2", "h3", "h4", "h5", "h6"))
HEAD_ONLY = frozenset(
    "base basefont bgsound link meta title script style noscript noframes template".split()
)
CLOSES_P = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer "
    "form header hgroup hr listing main menu nav ol p plaintext pre search section summary table ul xmp "
    "h1 h2 h3 h4 h5 h6 li dd dt".split()
)
FORMATTING = frozenset("a b big code em font i nobr s small strike strong tt u".split())
SPECIAL = CLOSES_P | HEAD_ONLY | frozenset(
    "applet area body br button caption col colgroup embed frame frameset head html iframe img input keygen "
    "marquee noembed object param select source tbody td textarea tfoot th thead tr track wbr".split()
)
IMPLIED_END = frozenset("dd dt li optgroup option p rb rp rt rtc".split())
SCOPE = frozenset("applet caption html table td th marquee object template svg math".split())
BUTTON_SCOPE = SCOPE | {"button"}
LIST_SCOPE = SCOPE | {"ol", "ul"}
TABLE_SCOPE = frozenset(("html", "table", "template"))
TABLE_PARTS = frozenset(("table", "tbody", "tfoot", "thead", "tr"))
TABLE_TAGS = frozenset("caption colgroup col tbody tfoot thead td th tr".split())
IN_TABLE_OK = TABLE_TAGS | {"table", "script", "style", "template"}
MARKED = frozenset(("td", "th", "caption", "applet", "marquee", "object"))

_MARKUP = re.compile(
    r"<!--(?:>|->|.*?(?:--!?>|\Z))"
    r"|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>\x00]*+)"
    r"(?P<attrs>(?:\s++|/|=|[^\s/>=][^\s/>=]*+(?:\s*+=\s*+(?:\"[^\"]*+\"|'[^']*+'|[^\s>\"'][^\s>]*+)?)?)*+)>"
    r"|<[!?/][^>]*>?",
    re.S,
)
_ATTR = re.compile(r"([^\s/>=][^\s/>=]*)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"'][^\s>]*))?)?")
_ATTR_REF = re.compile(r"&(?:#[0-9]+;?|#[xX][0-9a-fA-F]+;?|[A-Za-z][A-Za-z0-9]*;)")
_RESERVED = re.compile("[\ufdd0-\ufdef\x00]")
_MARKER = None


class Node:
    """One element, text run or comment."""

    __slots__ = ("tag", "attrs", "kids", "parent", "text", "foreign")

    def __init__(self, tag, attrs=None, text=None, foreign=False):
        self.tag, self.attrs, self.text, self.foreign = tag, attrs or {}, text, foreign
        self.kids, self.parent = [], None

    def append(self, kid):
        kid.parent = self
        self.kids.append(kid)

    def detach(self):
        if self.parent is not None:
            self.parent.kids.remove(self)
            self.parent = None


def _attributes(source):
    out = {}
    for name, dq, sq, bare in _ATTR.findall(source):
        value = dq or sq or bare
        if "&" in value:
            value = _ATTR_REF.sub(lambda m: _html.unescape(m.group()), value)
        out.setdefault(name.lower(), value)
    return out


class _Builder:
    def __init__(self):
        self.root = Node("html")
        self.stack, self.formatting = [self.root], []
        self.head = self.body = None

    # -- stack helpers -------------------------------------------------
    def in_scope(self, tags, barrier=SCOPE):
        for node in reversed(self.stack):
            if node.tag in tags:
                return True
            if node.tag in barrier:
                return False
        return False

    def pop(self):
        node = self.stack.pop()
        if node.tag in MARKED:
            while self.formatting and self.formatting.pop() is not _MARKER:
                pass
        return node

    def pop_through(self, tags):
        while len(self.stack) > 1 and self.pop().tag not in tags:
            pass

    def pop_back_to(self, tags):
        while len(self.stack) > 1 and self.stack[-1].tag not in tags:
            self.pop()

    def imply_ends(self, keep=""):
        while self.stack[-1].tag in IMPLIED_END and self.stack[-1].tag != keep:
            self.pop()

    def close_p(self):
        if self.in_scope(("p",), BUTTON_SCOPE):
            self.imply_ends("p")
            self.pop_through(("p",))

    # -- insertion -----------------------------------------------------
    def place(self, node, parent=None):
        parent = parent or self.stack[-1]
        blank = node.text is not None and not node.text.strip(" \t\n\r\f")
        if parent.tag in TABLE_PARTS and node.tag not in IN_TABLE_OK and node.tag != "#comment" and not blank:
            tables = [n for n in self.stack if n.tag == "table"]
            if tables and tables[-1].parent is not None:
                host = tables[-1].parent
                node.parent = host
                host.kids.insert(host.kids.index(tables[-1]), node)
                return
        parent.append(node)

    def insert(self, tag, attrs=None, foreign=False):
        node = Node(tag, attrs, foreign=foreign)
        self.place(node)
        self.stack.append(node)
        if tag in MARKED and not foreign:
            self.formatting.append(_MARKER)
        return node

    def open_body(self, attrs=None):
        if self.body is None:
            self.open_head()
            self.stack = [self.root]
            self.body = self.insert("body")
        for key, value in (attrs or {}).items():
            self.body.attrs.setdefault(key, value)

    def open_head(self, attrs=None):
        if self.head is None:
            self.head = Node("head", attrs)
            self.root.append(self.head)
            self.stack.append(self.head)

    # -- formatting elements ---------------------------------------------
    def reconstruct(self):
        entries, i = self.formatting, len(self.formatting)
        while i and entries[i - 1] is not _MARKER and entries[i - 1] not in self.stack:
            i -= 1
        for j in range(i, len(entries)):
            entries[j] = self.insert(entries[j].tag, dict(entries[j].attrs))

    def remember(self, node):
        same = []
        for entry in reversed(self.formatting):
            if entry is _MARKER:
                break
            if entry.tag == node.tag and entry.attrs == node.attrs:
                same.append(entry)
        if len(same) >= 3:
            self.formatting.remove(same[-1])
        self.formatting.append(node)

    def end_formatting(self, tag):
        """The adoption procedure for a formatting end tag."""
        if self.stack[-1].tag == tag and self.stack[-1] not in self.formatting:
            self.pop()
            return
        for _ in range(8):
            entry = None
            for candidate in reversed(self.formatting):
                if candidate is _MARKER:
                    break
                if candidate.tag == tag:
                    entry = candidate
                    break
            if entry is None:
                return self.end_other(tag)
            if entry not in self.stack:
                self.formatting.remove(entry)
                return
            at = self.stack.index(entry)
            if any(n.tag in SCOPE for n in self.stack[at + 1 :]):
                return
            block = next((n for n in self.stack[at + 1 :] if n.tag in SPECIAL), None)
            if block is None:
                del self.stack[at:]
                self.formatting.remove(entry)
                return
            ancestor, last = self.stack[at - 1], block
            slot = self.formatting.index(entry)
            chain = self.stack[at + 1 : self.stack.index(block)]
            for depth, node in enumerate(reversed(chain), 1):
                if node not in self.formatting or depth > 3:
                    if node in self.formatting:
                        self.formatting.remove(node)
                    self.stack.remove(node)
                    continue
                clone = Node(node.tag, dict(node.attrs))
                if last is block:
                    slot = self.formatting.index(node) + 1
                self.formatting[self.formatting.index(node)] = clone
                self.stack[self.stack.index(node)] = clone
                last.detach()
                clone.append(last)
                last = clone
            last.detach()
            self.place(last, ancestor)
            clone = Node(entry.tag, dict(entry.attrs))
            for kid in block.kids:
                clone.append(kid)
            block.kids = []
            block.append(clone)
            self.formatting.insert(slot, clone)
            self.formatting.remove(entry)
            self.stack.remove(entry)
            self.stack.insert(self.stack.index(block) + 1, clone)

    # -- events -----------------------------------------------------------
    def text(self, data):
        blank = not data.strip(" \t\n\r\f")
        if self.body is None:
            if blank:
                if self.head is not None:
                    self.place(Node("#text", text=data))
                return
            self.open_body()
        if not blank and self.stack[-1].tag not in RAW_TEXT and self.stack[-1].tag not in ESCAPABLE_TEXT:
            self.reconstruct()
        self.place(Node("#text", text=data))

    def start(self, tag, attrs, self_closing):
        if tag == "html":
            for key, value in attrs.items():
                self.root.attrs.setdefault(key, value)
            return
        if tag == "head":
            if self.body is None:
                self.open_head(attrs)
            return
        if tag == "body":
            return self.open_body(attrs)
        if self.body is None:
            if tag in HEAD_ONLY:
                self.open_head()
                if self.stack[-1] is self.root:
                    self.stack.append(self.head)
                self.insert(tag, attrs)
                if tag in VOID:
                    self.pop()
                return
            self.open_body()
        top = self.stack[-1]
        if top.foreign and top.tag not in ("foreignobject", "desc", "title"):
            if tag not in CLOSES_P and tag not in ("b", "br", "img", "span", "strong", "em", "i"):
                self.insert(tag, attrs, True)
                if self_closing:
                    self.pop()
                return
            while self.stack[-1].foreign:
                self.pop()
        if tag in TABLE_TAGS:
            return self.start_table_part(tag, attrs)
        if tag in ("li", "dd", "dt"):
            kin = ("li",) if tag == "li" else ("dd", "dt")
            for node in reversed(self.stack):
                if node.tag in kin:
                    self.imply_ends(node.tag)
                    self.pop_through((node.tag,))
                    break
                if node.tag in SPECIAL and node.tag not in ("address", "div", "p"):
                    break
        if tag in CLOSES_P:
            self.close_p()
            if tag in HEADINGS and self.stack[-1].tag in HEADINGS:
                self.pop()
        elif tag == "a" and any(
            n is not _MARKER and n.tag == "a" for n in self._since_marker()
        ):
            stale = next(n for n in self._since_marker() if n.tag == "a")
            self.end_formatting("a")
            if stale in self.formatting:
                self.formatting.remove(stale)
            if stale in self.stack:
                self.stack.remove(stale)
        elif tag == "button" and self.in_scope(("button",)):
            self.imply_ends()
            self.pop_through(("button",))
        elif tag in ("option", "optgroup") and self.stack[-1].tag == "option":
            self.pop()
        if tag == "image":
            tag = "img"
        if tag not in CLOSES_P and tag not in HEAD_ONLY and tag not in ("param", "source", "track", "textarea", "iframe"):
            self.reconstruct()
        foreign = tag in ("svg", "math")
        node = self.insert(tag, attrs, foreign)
        if tag in VOID or (foreign and self_closing):
            self.pop()
        elif tag in FORMATTING:
            self.remember(node)

    def _since_marker(self):
        out = []
        for entry in reversed(self.formatting):
            if entry is _MARKER:
                break
            out.append(entry)
        return out

    def start_table_part(self, tag, attrs):
        if not self.in_scope(("table",), TABLE_SCOPE):
            return
        if tag in ("td", "th"):
            self.pop_back_to(TABLE_PARTS)
            if self.stack[-1].tag == "table":
                self.insert("tbody")
            if self.stack[-1].tag != "tr":
                self.insert("tr")
        elif tag == "tr":
            self.pop_back_to(("table", "tbody", "tfoot", "thead"))
            if self.stack[-1].tag == "table":
                self.insert("tbody")
        elif tag == "col":
            self.pop_back_to(("table", "colgroup"))
            if self.stack[-1].tag == "table":
                self.insert("colgroup")
        else:
            self.pop_back_to(("table",))
        self.insert(tag, attrs)
        if tag == "col":
            self.pop()

    def end(self, tag):
        if tag in ("html", "body"):
            return
        if self.body is None:
            if self.stack[-1].tag == tag and tag != "html":
                self.pop()
            elif tag == "br":
                self.open_body()
                self.start("br", {}, False)
            return
        if tag == "br":
            self.start("br", {}, False)
        elif tag in FORMATTING:
            self.end_formatting(tag)
        elif tag == "p":
            if not self.in_scope(("p",), BUTTON_SCOPE):
                self.insert("p")
            self.close_p()
        elif tag in HEADINGS:
            if self.in_scope(HEADINGS):
                self.imply_ends()
                self.pop_through(HEADINGS)
        elif tag in ("table", "tr", "tbody", "thead", "tfoot", "td", "th", "caption"):
            if self.in_scope((tag,), TABLE_SCOPE):
                self.pop_through((tag,))
        elif tag in CLOSES_P or tag in ("button", "applet", "marquee", "object"):
            if self.in_scope((tag,), LIST_SCOPE if tag == "li" else SCOPE):
                self.imply_ends(tag if tag in ("li", "dd", "dt") else "")
                self.pop_through((tag,))
        else:
            self.end_other(tag)

    def end_other(self, tag):
        for node in reversed(self.stack):
            if node.tag == tag and node is not self.body and node is not self.root:
                self.imply_ends(tag)
                self.pop_through((tag,))
                return
            if node.tag in SPECIAL and not node.foreign:
                return


def parse_html(source: str) -> Node:
    """Return the ``html`` element of *source*."""
    source = source.replace("\r\n", "\n").replace("\r", "\n")
    if _RESERVED.search(source):
        source = _RESERVED.sub("\ufffd", source)
    build, pos, size = _Builder(), 0, len(source)
    while pos < size:
        found = _MARKUP.search(source, pos)
        stop = found.start() if found else size
        if stop > pos:
            data = source[pos:stop]
            if pos and build.stack[-1].tag in ("pre", "listing") and not build.stack[-1].kids and data[0] == "\n":
                data = data[1:]
            if data:
                build.text(_html.unescape(data) if "&" in data else data)
        if not found:
            break
        pos = found.end()
        tag = found.group("tag")
        if tag is None:
            raw = found.group()
            if raw[:4] == "<!--":
                body = raw[4:]
                body = body[:-4] if body.endswith("--!>") else body[:-3] if body.endswith("-->") else body.rstrip("->")
                if build.head is not None:
                    build.place(Node("#comment", text=body))
            continue
        tag = tag.lower()
        if found.group("end"):
            build.end(tag)
            continue
        attr_source = found.group("attrs")
        build.start(tag, _attributes(attr_source) if attr_source else {}, attr_source.endswith("/"))
        top = build.stack[-1]
        if top.tag == tag and not top.foreign and (tag in RAW_TEXT or tag in ESCAPABLE_TEXT):
            close = re.compile("</" + tag + r"(?=[\s/>])[^>]*>", re.I).search(source, pos)
            stop = close.start() if close else size
            data = source[pos:stop]
            if tag == "textarea" and data[:1] == "\n":
                data = data[1:]
            if tag in ESCAPABLE_TEXT and "&" in data:
                data = _html.unescape(data)
            if data:
                top.append(Node("#text", text=data))
            build.pop()
            pos = close.end() if close else size
    build.open_body()
    return build.root
