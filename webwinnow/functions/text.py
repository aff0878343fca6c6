"""Text column functions: trimming, titles, language, quality, boundary wrapping."""

from __future__ import annotations

import re

from pyspark.sql import Column, functions as F

from webwinnow import constants as K
from webwinnow.functions.binding import let

# White space as Python's str.strip/split and as a browser's trim see it.
_WIDE = "\u00a0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
_PY_SPACE = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85" + _WIDE
JS_SPACE = "\t\n\x0b\x0c\r \ufeff" + _WIDE
SPACE = r"[\t-\r\x1c-\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"
# The same set, laid out so that Java's matcher tells a letter by two tests instead of nine.
_FAST_SPACE = r"[\t\n\x0b\f\r\x1c\x1d\x1e\x1f\x20\x85\xa0[\u1680-\u3000&&[\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]]]"
_LINE_ENDS = r"\r\n|[\n\r\x0b\f\x1c-\x1e\u0085\u2028\u2029]"


def strip(c: Column) -> Column:
    """Drop Unicode white space at both ends."""
    return F.btrim(c, F.lit(_PY_SPACE))


def trim_js(c: Column) -> Column:
    """Drop white space at both ends the way a browser's ``trim`` does."""
    return F.btrim(c, F.lit(JS_SPACE))


def collapse(c: Column) -> Column:
    """Every white-space run becomes one space; ends are stripped."""
    return strip(F.regexp_replace(c, f"{_FAST_SPACE}+", " "))


def folded(c: Column) -> Column:
    """Lower case in which every letter that a case-blind pattern accepts is the plain one."""
    special = F.lit(False)
    for letter in "\u0130\u0131\u017f\u212a":
        special = special | c.contains(letter)
    return F.lower(F.when(special, F.translate(c, "\u0130\u0131\u017f\u212a", "iisk")).otherwise(c))


def holds_pattern(c: Column, low: Column, pattern: str) -> Column:
    """Case-blind pattern search in *c*, tried only where its longest literal is in ``low = folded(c)``."""
    return low.contains(_literal(pattern)) & c.rlike("(?iU)" + pattern)


def _literal(pattern: str) -> str:
    """Longest run of letters (or the brace) that every match contains."""
    fixed = re.sub(r"\[[^]]*\][+*]?|\([^)]*\)|\\[bsw]", " ", pattern)
    return max(re.findall(r"[a-z]+|\{", fixed), key=len)


def comma_count(c: Column) -> Column:
    return F.length(c) - F.length(F.replace(c, F.lit(","), F.lit("")))


def words(c: Column, limit: int = -1) -> Column:
    """White-space separated tokens, the text beyond ``limit`` - 1 tokens in one piece; [''] for blank text."""
    return F.split(strip(c), f"{_FAST_SPACE}+", limit)


def remove_boilerplate(c: Column) -> Column:
    """Drop the lines that match a boilerplate pattern."""
    def clean(line, low):
        hit = F.lit(False)
        for pattern in K.BOILERPLATE:
            hit = hit | holds_pattern(line, low, pattern)
        return ~hit

    def kept(low):
        lines = F.filter(F.split(c, "\n", -1), lambda line: let(folded(line), lambda l: clean(line, l)))
        listed = F.lit(False)
        for pattern in K.BOILERPLATE:
            listed = listed | low.contains(_literal(pattern))
        return F.when(listed, F.array_join(lines, "\n")).otherwise(c)

    return let(folded(c), kept)


def main_paragraphs(c: Column) -> Column:
    """Keep paragraphs whose stripped length exceeds 50."""
    return F.array_join(
        F.filter(F.split(c, "\n\n", -1), lambda p: F.length(strip(p)) > K.MIN_PARAGRAPH), "\n\n"
    )


def language(c: Column) -> Column:
    """Word-list vote over the distinct words among the first 200 tokens."""
    def margin(head):
        def votes(listed):
            return F.size(F.array_intersect(head, F.array(*map(F.lit, listed))))

        return votes(K.WORDS_ID) - votes(K.WORDS_EN)

    return let(
        let(F.slice(words(F.lower(c), K.LANGUAGE_WINDOW + 1), 1, K.LANGUAGE_WINDOW), margin),
        lambda m: F.when(m > 0, "id").when(m < 0, "en").otherwise("unknown"),
    )


def quality_score(c: Column) -> Column:
    """Length-band score; a step down at 1000 words is part of the definition."""
    def band(n):
        return (
            F.when(n < 50, 0.2)
            .when(n < 200, 0.5)
            .when(n < 1000, 0.7)
            .otherwise(F.least(F.lit(1.0), n / F.lit(2000) * F.lit(0.8) + F.lit(0.2)))
        )

    return F.when(c == "", 0.0).otherwise(let(F.size(words(c)), band))


def has_schema(html: Column) -> Column:
    """Schema.org microdata or JSON-LD in *html*."""
    return F.coalesce(html.rlike("(?i)" + K.SCHEMA_ITEMTYPE) | html.rlike(K.SCHEMA_JSONLD), F.lit(False))


def title_from_html(html: Column) -> Column:
    """Body of the first ``<title>`` (even when empty), else of the first ``<h1>``, else ''."""
    title, h1 = r"(?is)<title[^>]*>(.*?)</title>", r"(?is)<h1[^>]*>(.*?)</h1>"
    return let(
        html,
        lambda h: F.when(h.rlike(title), collapse(F.regexp_extract(h, title, 1)))
        .when(h.rlike(h1), strip(F.regexp_replace(F.regexp_extract(h, h1, 1), r"<[^>]+>", "")))
        .otherwise(""),
    )


def title_from_text(c: Column) -> Column:
    """First line longer than 3 characters that is not a heading, cut to 200."""
    lines = F.transform(F.split(c, _LINE_ENDS, -1), strip)
    good = F.filter(lines, lambda s: (F.length(s) > 3) & ~s.startswith("#"))
    return F.coalesce(F.substring(F.get(good, F.lit(0)), 1, 200), F.lit(""))


def first_filled(*candidates: Column) -> Column:
    """First candidate that is neither null nor empty."""
    return F.coalesce(*[F.nullif(c, F.lit("")) for c in candidates[:-1]], candidates[-1])


def escape_markup(c: Column, escape: bool = False) -> Column:
    """Field values pass unchanged; ``escape=True`` really escapes ``& < >``."""
    if not escape:
        return c
    for raw, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        c = F.replace(c, F.lit(raw), F.lit(entity))
    return c


def fill(template: str, *values: Column) -> Column:
    """Put columns into the ``%s`` / ``%d`` places of a fixed template."""
    parts = template.replace("%d", "%s").split("%s")
    out = [F.lit(parts[0])]
    for value, part in zip(values, parts[1:]):
        out += [value.cast("string"), F.lit(part)]
    return F.concat(*out)


def wrap_boundary(markdown: Column, title: Column, url: Column, as_of: Column, escape: bool = False) -> Column:
    """Markdown inside the boundary tags, under its title, URL and timestamp."""
    return fill(K.BOUNDARY, escape_markup(title, escape), escape_markup(url, escape), as_of, markdown)


def wrap_low_content(wrapped: Column, title: Column, url: Column) -> Column:
    return fill(K.BOUNDARY_LOW, title, url, wrapped)


def structure_key(url: Column) -> Column:
    return F.substring(F.sha2(url, 256), 1, 16)
