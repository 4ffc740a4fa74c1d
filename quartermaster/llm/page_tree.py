"""A tolerant HTML reader: block elements as a tree, with each block's text."""

from __future__ import annotations

import html
import re

#: Fixed values of the markup language.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset(
    "html body address article aside blockquote center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 "
    "h4 h5 h6 header hgroup hr li main menu nav ol p pre search section summary table caption tbody td tfoot th thead tr ul".split())
RAW = frozenset("script style textarea title noscript iframe template xmp noembed noframes svg math select object canvas audio video".split())
RAW_END = {tag: re.compile(f"</{tag}", re.I | re.A) for tag in RAW}
CLOSES_P = BLOCK - {"html", "body"}
#: An opening tag closes an open one of these, up to the nearest of the fence.
IMPLIED = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
    "tbody": ({"tbody", "thead", "tfoot", "tr", "td", "th"}, {"table"}), "tfoot": ({"tbody", "thead", "tr", "td", "th"}, {"table"}),
}
FURNITURE = frozenset("nav aside footer form menu dialog head button label search".split())
FURNITURE_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar form".split())
FURNITURE_NAMES = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner menu nav navbar navigation breadcrumb breadcrumbs "
    "sidebar footer masthead topbar cookie cookies consent gdpr notice notices popup modal overlay newsletter subscribe subscription signup "
    "login share sharing social comment comments respond replies disqus related recommended recommendations widget pagination pager".split())

TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*)>|[^<]+|<""", re.S)
ATTRIBUTE = re.compile(r"""\b(class|id|role|hidden|aria-hidden|style)\b(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""", re.I)


class Node:
    __slots__ = ("label", "children", "texts", "parent", "furniture", "landmark", "linked", "path")

    def __init__(self, label, parent, furniture, landmark):
        self.label, self.parent, self.furniture, self.landmark = label, parent, furniture, landmark
        self.children, self.texts, self.linked = [], [], 0
        self.path = f"{parent.path}/{label}" if parent else label


def furniture_of(tag: str, attributes: dict, inside_landmark: bool) -> bool:
    if tag in FURNITURE or tag == "header" and not inside_landmark:
        return True
    if "hidden" in attributes or attributes.get("aria-hidden") == "true" or "display:none" in attributes.get("style", "").replace(" ", "").lower():
        return True
    if attributes.get("role", "").lower() in FURNITURE_ROLES:
        return True
    names = re.split(r"[\s_-]+", f"{attributes.get('class', '')} {attributes.get('id', '')}".lower())
    return tag not in ("html", "body", "article", "main") and not FURNITURE_NAMES.isdisjoint(names)


def parse(page: str) -> tuple[Node, list[tuple[Node, str, int]]]:
    """The tree of block elements, and its blocks in page order: (node,
    text, characters inside links)."""
    root = Node("", None, False, False)
    blocks: list[tuple[Node, str, int]] = []
    stack: list[tuple[str, Node]] = [("", root)]  # open elements and the block each lies in
    buffer: list[str] = []
    linked = links = skip = 0  # skip: open inline furniture

    def flush():
        nonlocal linked
        if buffer:
            text = " ".join(html.unescape("".join(buffer)).split())
            if text:
                node = stack[-1][1]
                node.texts.append(text)
                blocks.append((node, text, linked))
            buffer.clear()
        linked = 0

    def close(depth: int):
        nonlocal links, skip
        for tag, _ in reversed(stack[depth:]):
            if tag in BLOCK:
                flush()
            elif tag == "a":
                links -= 1
            elif tag in ("button", "label"):
                skip -= 1
            stack.pop()

    at = 0
    while at < len(page):
        m = TOKEN.match(page, at)
        at = m.end()
        raw = m[0]
        if raw[0] != "<" or raw == "<":
            if not skip:
                buffer.append(raw)
                if links:
                    linked += len(raw)
            continue
        if m[2] is None:
            continue  # a comment, a doctype or the like
        tag = m[2].lower()
        if m[1]:
            if tag == "br":
                buffer.append(" ")
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth][0] == tag:
                    close(depth)
                    break
                if stack[depth][0] in ("td", "th", "table", "article", "body") and tag not in BLOCK:
                    break
            continue
        if tag in VOID:
            if tag == "hr":
                flush()
            elif tag in ("br", "wbr"):
                buffer.append(" " if tag == "br" else "")
            continue
        if tag in RAW:
            if not m[3].endswith("/"):
                end = RAW_END[tag].search(page, at)  # in the page itself: lower() may change its length
                at = (page.find(">", end.start()) + 1 or len(page)) if end else len(page)
            continue
        if tag in CLOSES_P:
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth][0] == "p":
                    close(depth)
                    break
                if stack[depth][0] in BLOCK:
                    break
        if tag in IMPLIED:
            ends, fence = IMPLIED[tag]
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth][0] in fence:
                    break
                if stack[depth][0] in ends:
                    close(depth)
                    if tag not in ("tr", "tbody", "tfoot"):
                        break
        if tag in BLOCK:
            flush()
            attributes = {k.lower(): v.strip("\"'") for k, v in ATTRIBUTE.findall(m[3])} if m[3] else {}
            up = stack[-1][1]
            landmark = up.landmark or tag in ("article", "main") or attributes.get("role") == "main"
            name = (attributes.get("class") or attributes.get("id") or "").split()
            node = Node(f"{tag}.{name[0]}" if name else tag, up, up.furniture or furniture_of(tag, attributes, up.landmark), landmark)
            up.children.append(node)
            stack.append((tag, node))
        elif tag == "head":
            stack.append((tag, Node("head", stack[-1][1], True, False)))
        else:
            links += tag == "a"
            skip += tag in ("button", "label")
            stack.append((tag, stack[-1][1]))
    close(1)
    flush()
    return root, blocks
