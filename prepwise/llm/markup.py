"""Leaf blocks of a web page: texts with the elements around them, in page order, in one pass."""
from __future__ import annotations

import html
import re
from dataclasses import dataclass, field

BLOCK = frozenset("""address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption figure
    footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html label legend li main menu nav ol optgroup option p pre search section
    select summary table tbody td textarea tfoot th thead tr ul""".split())
VOID = frozenset("area base basefont bgsound br col embed frame hr img input keygen link meta param source track wbr".split())
#: Elements whose content is no text of the page; it ends at their own end tag only.
RAW = frozenset("script style noscript template title iframe noembed noframes xmp textarea svg object".split())
_SHOWN_RAW = frozenset(("textarea", "xmp"))
_ENDS = {name: re.compile(f"</{name}(?=[\\s/>])[^>]*>?", re.I) for name in RAW}
#: A start tag on the left ends an open element on the right, up to the nearest element of _SCOPE.
_IMPLIED = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"),
            "option": ("option",), "optgroup": ("option", "optgroup"), "tbody": ("tr", "td", "th", "thead", "tbody"),
            "tfoot": ("tr", "td", "th", "tbody"), "body": ("head",)}
_STOPS = {"li": ("ul", "ol", "menu", "dir"), "dt": ("dl",), "dd": ("dl",), "option": ("select",), "optgroup": ("select",)}
_SCOPE = frozenset(("table", "html"))
_CELLS = frozenset(("table", "td", "th", "caption", "html"))
_TABLE = frozenset("table caption tbody thead tfoot tr td th".split())
_TAG = re.compile(r"""<(/?)([A-Za-z][^\s/>]*+)((?:[^>"']|"[^"]*"|'[^']*')*+)>""")
_LOOSE_TAG = re.compile(r"<(/?)([A-Za-z][^\s/>]*+)([^>]*+)>")
_ASIDE = re.compile(r"<!--(?:>|->|.*?--!?>)|<[!?/][^>]*+>", re.S)
_ATTRIBUTE = re.compile(r"""([^\s"'=/]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
_NAME_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|[0-9]+")


@dataclass
class Page:
    """Elements as (parent, depth, tokens) and blocks as (element, text, letters inside links)."""
    parents: list = field(default_factory=lambda: [-1])
    depths: list = field(default_factory=lambda: [0])
    tokens: list = field(default_factory=lambda: [()])
    names: list = field(default_factory=lambda: [""])
    blocks: list = field(default_factory=list)


def _tokens(name: str, attributes: str) -> tuple:
    """What the tag path says of an element: its name, the words of its class, id and role, and whether it is hidden."""
    found = ["<" + name]
    if attributes and not attributes.isspace():
        for key, *values in _ATTRIBUTE.findall(attributes):
            key, value = key.lower(), html.unescape("".join(values))
            if key in ("class", "id", "role", "itemprop"):
                for word in value.split():
                    parts = [p.lower() for p in _NAME_PART.findall(word)]
                    found += {*parts, "".join(p for p in parts if not p.isdigit())} - {""}
            elif key == "hidden" or key == "style" and "none" in value and "display" in value:
                found.append("=hidden")
    return tuple(found)


def parse(source: str) -> Page:
    """Blocks of a page: runs of text between the tags of block elements, references decoded and white space
    (also ``br``) as one space; unclosed, misplaced and cut-off tags are taken as browsers take them."""
    page = Page()
    stack = [(0, "")]
    places: dict[str, list] = {"": [0]}                          # of the open elements in the stack, by name; "" for all block elements
    run, linked, links, at, n = [], 0, 0, 0, len(source)

    def end_block():
        nonlocal run, linked
        if run:
            text = " ".join(html.unescape("".join(run)).split())
            if text:
                page.blocks.append((stack[-1][0], text, linked))
        run, linked = [], 0

    def push(node: int, name: str):
        nonlocal links
        places.setdefault(name, []).append(len(stack))
        if name in BLOCK:
            places[""].append(len(stack))
        links += name == "a"
        stack.append((node, name))

    def drop(down_to: int):
        nonlocal links
        while len(stack) > down_to:
            name = stack.pop()[1]
            places[name].pop()
            if name in BLOCK:
                places[""].pop()
            links -= name == "a"

    def close(down_to: int):
        end_block()
        drop(down_to)

    def add(text: str):
        nonlocal linked
        run.append(text)
        if links:
            linked += len(text)

    def innermost(names) -> int:
        return max((places[name][-1] for name in names if places.get(name)), default=0)

    def find(names, stops) -> int:
        """Place in the stack of the innermost of ``names`` above any of ``stops``, or 0."""
        k = innermost(names)
        return k if k > innermost(stops) else 0

    while at < n:
        lt = source.find("<", at)
        if lt < 0:
            add(source[at:])
            break
        if lt > at:
            add(source[at:lt])
        after = source[lt + 1:lt + 2]
        if after in ("!", "?") or after == "/" and not source[lt + 2:lt + 3].isalpha():
            m = _ASIDE.match(source, lt)
            if not m:
                if after == "/" and lt + 2 >= n:
                    add("</")
                break
            at = m.end()
            continue
        if not (after == "/" or after.isascii() and after.isalpha()):
            add("<")
            at = lt + 1
            continue
        m = _TAG.match(source, lt) or _LOOSE_TAG.match(source, lt)
        if not m:                                                # cut off inside a tag
            break
        at = m.end()
        ending, name, attributes = m.group(1), m.group(2).lower(), m.group(3)
        if ending:
            if name == "br":
                add(" ")
            elif name in BLOCK:
                k = find((name,), () if name in _TABLE else _CELLS - {name})
                if k:
                    close(k)
                else:
                    end_block()
            else:
                k = find((name,), ("",))
                if k:
                    drop(k)
            continue
        if name == "br":
            add(" ")
            continue
        if name in BLOCK:
            end_block()
            k = find(("p",), _CELLS | {"button"}) if name not in ("label", "button", "option", "select", "textarea") else 0
            if k:
                close(k)
            if name in _IMPLIED:
                while k := find(_IMPLIED[name], (*_SCOPE, *_STOPS.get(name, ()))):
                    close(k)
        if name in VOID:
            continue
        page.parents.append(stack[-1][0])
        page.depths.append(len(stack))
        page.tokens.append(_tokens(name, attributes))
        page.names.append(name)
        node = len(page.parents) - 1
        if name in RAW:
            m = _ENDS[name].search(source, at)
            if name in _SHOWN_RAW:
                end_block()
                push(node, name)
                add(source[at:m.start() if m else n])
                close(len(stack) - 1)
            at = m.end() if m else n
            continue
        if attributes.endswith("/") and name not in BLOCK and name != "a":
            continue
        push(node, name)
    end_block()
    return page
