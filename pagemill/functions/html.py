"""HTML to text by column expressions.

Markup is read by regular expressions. Pages with an angle bracket inside a quoted attribute
value, where these would end a tag too early, first pass a small state machine that writes such
brackets as entities. A ``<`` that opens no tag, and a tag or comment that is never closed, is
text. Every pattern is given only text in which it must succeed where it begins, so the work
grows with the length of the page.
"""

from __future__ import annotations

import functools
import json
from collections import defaultdict
from collections.abc import Callable
from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import bind

# Elements that end a line of text.
BLOCK_TAGS = (
    "address", "article", "aside", "blockquote", "br", "dd", "div", "dl", "dt",
    "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6",
    "header", "hr", "li", "main", "nav", "ol", "p", "pre", "section", "table",
    "td", "th", "title", "tr", "ul",
)

# Stand-ins, noncharacters: the end of what is searched, an opener without a closer.
END, OPENER = "\ufdd0", "\ufdd1"
HIDDEN = (
    rf"<script(?=[\s/>])[^>]*>.*?(?:</script\s*>|{END})"
    rf"|<style(?=[\s/>])[^>]*>.*?(?:</style\s*>|{END})"
    r"|<!--.*?-->"
)
# Tags are read along, so that nothing begins inside one.
INVISIBLE = rf"(?is){HIDDEN}|(<(?:/?[a-z]|[!?/])[^>]*>)"
# Any tag; the group is filled when it ends a line. Any tag or hidden part.
TAGS = rf"<(?:/?({'|'.join(BLOCK_TAGS)})(?=[\s/>])|/?[a-z]|[!?/])[^>]*>"
MARKUP = rf"(?is){HIDDEN}|{TAGS}"
FOUND, NAMED = "\ufdd2", "\ufdd3"
# Where a page has such characters itself, they are spelled with this one meanwhile.
SPELLED = "\ufdd4"
ENTITY_PIECES = r"&#[0-9]+;?|&#[xX][0-9A-Fa-f]+;?|&[0-9A-Za-z]{1,32};?|[^&]+|&"

# What a page is cut into for the state machine, and the kinds of these pieces.
_PIECES = (r"(?is)<!--|-->|</?(?:script|style)(?=[\s/>])|</?[a-z]|</|<[!?]|[<>\"'=/]|\s+|[^<>\"'=/\s\-]+|-")
_KINDS = ("other", "space", '"', "'", "=", "/", ">", "<a", "<", "<!--", "-->", "<script", "</script", "<style", "</style", "</")
# A start tag with a quoted value that holds an angle bracket. What is possessive keeps this
# linear: no part of a tag is read twice.
_SUSPECT = (r"""(?i)<[a-z][^<>"']*+(?:"[^"<>]*+"[^<>"']*+|'[^'<>]*+'[^<>"']*+)*+"""
            r"""(?:"[^"<>]*+[<>]|'[^'<>]*+[<>])""")

# Where the article body and its title are found.
ARTICLE_BODY = ("div", "itemprop", "articleBody")
H1 = "<h1>(.*?)</h1>"
MARK = "\u0001"


@functools.cache
def _transitions() -> tuple[list[int], list[int]]:
    """``next[state * kinds + kind]``, and the states inside a quoted value.

    Outside: ``text``, ``end`` (an end tag or declaration, up to ``>``), ``comment``, and the raw
    content of scripts and styles. In a start tag: its ``name``; a ``gap`` before an attribute;
    the ``attr`` name, and ``after`` it; ``eq`` behind a sign of equality; a ``bare`` value; the
    quoted ones. A script's and a style's own tag have such states too, which end in raw content.
    """
    inside = ("name", "gap", "attr", "after", "eq", "bare", "dq", "sq")
    outer = ("text", "end", "comment", "raw:script", "raw:style")
    states = [*outer, *(f"{of}:{s}" for of in ("a", "script", "style") for s in inside)]

    def follow(state: str, kind: str) -> str:
        if state == "text":
            return {"<a": "a:name", "<script": "script:name", "<style": "style:name", "<!--": "comment",
                    "</": "end", "</script": "end", "</style": "end"}.get(kind, "text")
        if state == "end":
            return "text" if kind in (">", "-->") else "end"
        if state == "comment":
            return "text" if kind == "-->" else "comment"
        if state.startswith("raw"):
            return "end" if kind == "</" + state[4:] else state
        of, at = state.split(":")
        if at in ("dq", "sq"):
            return f"{of}:gap" if kind == {"dq": '"', "sq": "'"}[at] else state
        if kind in (">", "-->"):
            return "text" if of == "a" else f"raw:{of}"
        if at == "eq":
            to = {"space": "eq", "=": "eq", '"': "dq", "'": "sq"}.get(kind, "bare")
        elif kind == "space":
            to = {"attr": "after", "after": "after"}.get(at, "gap")
        elif at == "bare":
            to = "bare"
        elif kind == "/":
            to = "gap"
        elif at == "name":
            to = "name"
        else:
            to = "eq" if kind == "=" and at in ("attr", "after") else "attr"
        return f"{of}:{to}"

    number = {s: i for i, s in enumerate(states)}
    return [number[follow(s, k)] for s in states for k in _KINDS], [number[s] for s in states if s.endswith(("dq", "sq"))]


@functools.cache
def _bracket_scan() -> str:
    """SQL lambda: the state machine over the pieces of a page.

    It goes over blocks of pieces, so that no long text is built piece by piece. The number of
    a piece's kind is its place in ``_KINDS``.
    """
    quote = lambda s: "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"
    table, quoted = _transitions()
    inside = f"IN ({', '.join(map(str, quoted))})"
    width = "cast(ceil(sqrt(size(ps))) AS int)"
    single = " ".join(f"WHEN {quote(c)} THEN {_KINDS.index(c)}" for c in ('>', '"', "'", "=", "/", "-->"))
    tags = " ".join(f"WHEN {quote(c)} THEN {_KINDS.index(c)}" for c in ("<", "<!--", "<script", "</script", "<style", "</style"))
    kind = f"""CASE p {single} ELSE CASE WHEN startswith(p, '<') THEN
      CASE lower(p) {tags} ELSE CASE WHEN p RLIKE '^<[!?/]' THEN {_KINDS.index("</")} ELSE {_KINDS.index("<a")} END END
      WHEN p RLIKE {quote(chr(94) + chr(92) + "s")} THEN {_KINDS.index("space")} ELSE 0 END END"""
    step = f"""(s, p) -> named_struct(
      'state', element_at(array({', '.join(map(str, table))}), s.state * {len(_KINDS)} + {kind} + 1),
      'text', concat(s.text, CASE WHEN s.state {inside} THEN replace(replace(p, '<', '&lt;'), '>', '&gt;') ELSE p END))"""
    scan = f"""aggregate(
      transform(sequence(0, cast(ceil(size(ps) / {width}) AS int) - 1), b -> slice(ps, b * {width} + 1, {width})),
      named_struct('state', 0, 'parts', cast(array() AS array<string>)),
      (done, block) -> element_at(transform(array(aggregate(block, named_struct('state', done.state, 'text', ''), {step})),
        r -> named_struct('state', r.state, 'parts', concat(done.parts, array(r.text)))), 1))"""
    return f"""h -> CASE WHEN NOT h RLIKE {quote(_SUSPECT)} THEN h ELSE element_at(transform(
      array(regexp_extract_all(h, {quote(_PIECES)}, 0)), ps -> element_at(transform(array({scan}),
        f -> CASE WHEN f.state {inside} THEN h ELSE array_join(f.parts, '') END), 1)), 1) END"""


def quoted_brackets(html: Column) -> Column:
    """``html`` with ``<`` and ``>`` inside quoted attribute values as entities. A quote that is
    never closed is no quote: such a page stays as it is."""
    return F.element_at(F.call_function("transform", F.array(html), F.expr(_bracket_scan())), 1)


def _spelled(text: Column) -> Column:
    """Stand-ins that a page has itself, spelled with another one."""
    def all_of(t: Column) -> Column:
        for i, c in enumerate((SPELLED, END, OPENER, FOUND, NAMED)):
            t = F.replace(t, F.lit(c), F.lit(f"{SPELLED}{i}"))
        return t
    return bind(text, lambda t: F.when(F.rlike(t, F.lit(f"[{END}-{SPELLED}]")), all_of(t)).otherwise(t))


def _unspelled(text: Column) -> Column:
    def all_of(t: Column) -> Column:
        for i, c in reversed(list(enumerate((SPELLED, END, OPENER, FOUND, NAMED)))):
            t = F.replace(t, F.lit(f"{SPELLED}{i}"), F.lit(c))
        return t
    return bind(text, lambda t: F.when(F.contains(t, F.lit(SPELLED)), all_of(t)).otherwise(t))


def _upto_last(text: Column, mark: str, body: Callable[[Column, Column], Column]) -> Column:
    """``body(head, tail)``, cut behind the last ``mark``; without one all is tail."""
    def cut(tail: Column) -> Column:
        return body(F.substring(text, F.lit(1), F.length(text) - F.length(tail)), tail)
    return bind(F.substring_index(text, mark, -1), cut)


def _replaced(html: Column, pattern: str, replacement: str) -> Column:
    """``html`` with the pattern replaced where it can close.

    What follows the last ``>`` holds no tag, and a comment opened behind the last ``-->``
    is none. An unclosed script or style reaches to the end of the page.
    """
    def searched(head: Column, tail: Column) -> Column:
        closed = _upto_last(head, "-->", lambda h, t: F.concat(h, F.replace(t, F.lit("<!--"), F.lit(OPENER)), F.lit(END)))
        seen = F.replace(F.regexp_replace(closed, pattern, replacement), F.lit(OPENER), F.lit("<!--"))
        return bind(seen, lambda s: F.when(F.endswith(s, F.lit(END)), F.concat(F.rtrim(s, F.lit(END)), tail)).otherwise(s))

    return bind(html, lambda h: _upto_last(h, ">", searched))


def strip_invisible(html: Column) -> Column:
    """Remove scripts, styles and comments, whose content is not page text."""
    def stripped(h: Column) -> Column:
        wanted = F.rlike(h, F.lit("(?i)<script|<style|<!--"))
        return F.when(wanted, _unspelled(_replaced(_spelled(h), INVISIBLE, "$1"))).otherwise(h)

    return bind(quoted_brackets(html), stripped)


def element(
    html: Column, tag: str, attribute: str | None = None, value: str | None = None
) -> Column:
    """The first ``tag`` element, nested ones included; null when there is none.

    With ``attribute`` the opening tag must carry that attribute and value. An
    element that is never closed reaches to the end of the page. Scripts, styles
    and comments are not part of the result.
    """
    boundary = rf"(?i)(?=</?{tag}[\s/>])"
    opening = rf"(?i)^<{tag}[\s/>]"
    wanted = opening
    if attribute:
        quoted = rf"(?:\"{value}\"|'{value}'|{value}(?=[\s/>]))"
        wanted = rf"(?is)^<{tag}\s(?:[^>]*?\s)?{attribute}\s*=\s*{quoted}"
    closing = rf"(?i)^</{tag}[\s/>]"

    def cut(pieces: Column) -> Column:
        first = F.array_position(F.transform(pieces, lambda p: p.rlike(wanted)), True)
        tail = F.slice(pieces, F.greatest(first, F.lit(1)).cast("int"), F.size(pieces))
        return F.when(first > 0, bind(tail, balanced))

    def balanced(tail: Column) -> Column:
        def step(acc: Column, piece: Column) -> Column:
            depth = (
                acc["depth"]
                + F.when(piece.rlike(opening), 1).when(piece.rlike(closing), -1).otherwise(0)
            )
            return F.when(acc["open"], F.struct(
                depth.alias("depth"),
                (acc["n"] + 1).alias("n"),
                (depth > 0).alias("open"),
            )).otherwise(acc)

        start = F.struct(F.lit(0).alias("depth"), F.lit(0).alias("n"), F.lit(True).alias("open"))
        walk = F.aggregate(tail, start, step)
        return bind(walk, lambda w: F.when(
            w["open"], F.array_join(tail, "")
        ).otherwise(F.concat(
            F.array_join(F.slice(tail, 1, w["n"] - 1), ""),
            F.regexp_extract(F.element_at(tail, w["n"]), "^<[^>]*>", 0),
        )))

    return bind(F.split(strip_invisible(html), boundary), cut)


@functools.cache
def _decode_piece() -> str:
    """SQL lambda: one character reference to its character, other pieces unchanged.

    Named references lie in one constant map for each first letter, because the look-up
    in a map is linear. A few old names need no semicolon; the longest that a piece begins with
    counts. Numbers follow the HTML rule: those of the C1 range mean the Windows characters,
    what is no code point becomes U+FFFD, and control characters and noncharacters vanish.
    """
    tables: dict[str, dict[str, str]] = defaultdict(dict)
    for name, char in html5.items():
        if name.endswith(";"):
            tables[name[0]][f"&{name}"] = char
    literal = lambda table: json.dumps(table).replace("'", r"\u0027")
    named = " ".join(f"WHEN '{first}' THEN try_element_at(from_json(r'{literal(t)}', 'map<string,string>'), p)"
                     for first, t in sorted(tables.items()))
    windows = {n: bytes([n]).decode("cp1252", "replace") for n in range(0x80, 0xA0)}
    special = " ".join(f"WHEN {n} THEN '{c}'" for n, c in windows.items() if c != "\ufffd")

    old = sorted((name for name in html5 if not name.endswith(";")), key=lambda name: (-len(name), name))
    begins = f"^&({'|'.join(old)})"
    short = f"try_element_at(from_json(r'{literal({name: html5[name] for name in old})}', 'map<string,string>'), regexp_extract(p, r'{begins}', 1))"

    def character(number: str) -> str:
        valid = f"{number} BETWEEN 1 AND 1114111 AND {number} NOT BETWEEN 55296 AND 57343"
        gone = (f"{number} BETWEEN 1 AND 8 OR {number} = 11 OR {number} BETWEEN 14 AND 31 OR {number} = 127 "
                f"OR {number} BETWEEN 64976 AND 65007 OR {number} % 65536 >= 65534")
        return (f"CASE {number} {special} ELSE CASE WHEN ({valid}) AND ({gone}) THEN '' WHEN {valid} THEN "
                f"decode(unhex(lpad(hex({number}), 8, '0')), 'UTF-32') ELSE '\ufffd' END END")

    decimal = character("try_cast(regexp_extract(p, '([0-9]+)', 1) AS BIGINT)")
    # Digits beyond these are no code point; the longest number that still fits stands for them.
    hexa = character("try_cast(conv(left(regexp_extract(p, '[xX]0*([0-9A-Fa-f]*)', 1), 12), 16, 10) AS BIGINT)")
    return f"""p -> CASE
        WHEN NOT startswith(p, '&') OR p = '&' THEN p
        WHEN p = '&amp;' THEN '&' WHEN p = '&lt;' THEN '<' WHEN p = '&gt;' THEN '>'
        WHEN p = '&quot;' THEN '"' WHEN p = '&nbsp;' THEN chr(160)
        WHEN p RLIKE '^&#[0-9]' THEN {decimal}
        WHEN p RLIKE '^&#[xX][0-9A-Fa-f]' THEN {hexa}
        ELSE coalesce(CASE WHEN endswith(p, ';') THEN CASE substr(p, 2, 1) {named} END END,
          CASE WHEN p RLIKE r'{begins}' THEN concat({short}, regexp_replace(p, r'{begins}', '')) END, p) END"""


def decode_entities(text: Column) -> Column:
    """Decode each character reference once, so ``&amp;lt;`` stays ``&lt;``."""
    def pieces(t: Column) -> Column:
        found = F.regexp_extract_all(t, F.lit(ENTITY_PIECES), F.lit(0))
        return F.array_join(F.call_function("transform", found, F.expr(_decode_piece())), "")

    def usual(t: Column) -> Column:
        # The ampersand comes last, so that nothing is decoded twice.
        for name, char in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&nbsp;", "\u00a0"), ("&amp;", "&")):
            t = F.replace(t, F.lit(name), F.lit(char))
        return t

    rare = F.lit("&(?!amp;|lt;|gt;|quot;|nbsp;|[^#0-9A-Za-z]|$)")
    return bind(text, lambda t: F.when(~F.contains(t, F.lit("&")), t).when(F.rlike(t, rare), pieces(t)).otherwise(usual(t)))


def html_to_text(html: Column, stripped: bool = False) -> Column:
    """Plain text: block tags end a line; other tags, scripts, styles and comments vanish;
    entities are decoded. ``stripped`` markup went through ``strip_invisible`` before."""
    safe, pattern = (html, f"(?is){TAGS}") if stripped else (quoted_brackets(html), MARKUP)
    named = _replaced(_spelled(safe), pattern, f"{FOUND}$1{NAMED}")
    lines = F.regexp_replace(named, f"{FOUND}[^{NAMED}]+{NAMED}", "\n")
    return decode_entities(_unspelled(F.replace(lines, F.lit(FOUND + NAMED), F.lit(""))))


def page_title(html: Column, pattern: str = H1) -> Column:
    """Text of the first heading the pattern finds, ``''`` when there is none."""
    return html_to_text(F.regexp_extract(html, pattern, 1))


def mark_sections(html: Column, tag: str) -> Column:
    """Put ``MARK`` before every opening ``tag``, so that text can be split there."""
    clean = F.translate(strip_invisible(html), MARK, "")
    return F.regexp_replace(clean, rf"(?i)(<{tag}[\s/>])", f"{MARK}$1")
