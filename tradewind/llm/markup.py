"""HTML as a tree of elements with text, tolerant of missing and stray tags."""

from __future__ import annotations

import html
import re

#: Fixed values of HTML: elements without content, elements whose content is not markup, and elements that end a line.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
BLOCKS = frozenset(
    "address article aside blockquote body br caption center dd details dialog dir div dl dt fieldset figcaption figure footer "
    "form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre section select summary table "
    "tbody td tfoot th thead title tr ul".split())
#: What an opening tag closes, if that is the innermost open element.
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
          "th": {"td", "th"}, "option": {"option"}}
_PARAGRAPH_ENDS = BLOCKS - {"br", "body", "html", "title", "option", "optgroup", "select"}
#: A closing tag that has no opening one inside these is ignored.
_SCOPES = frozenset("article aside body div footer header main nav section table td th ul ol form html".split())

_TOKEN = re.compile(
    r"<!--(?:>|->|.*?(?:--!?>|\Z))|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<end>/?)(?P<tag>[A-Za-z][^\s/>]*)(?P<attrs>(?>(?:[^>\"'=]|=\s*\"[^\"]*\"|=\s*'[^']*'|[=\"'])*))>", re.S)
_CUT_TAG = re.compile(r"<[A-Za-z/!?][^<>]*\Z")
#: Elements deeper than this are put beside each other, as browsers do.
DEPTH = 200
_NAMES = re.compile(r"""\b(class|id|role|hidden|aria-hidden)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""", re.I)
_WORDS = re.compile(r"[a-z]+")


class Node:
    """An element: its key (tag and the words of class, id and role), and children, which are nodes and strings."""

    __slots__ = ("tag", "names", "children")

    def __init__(self, tag: str, names: tuple[str, ...] = ()):
        self.tag, self.names, self.children = tag, names, []

    @property
    def key(self) -> str:
        return ".".join((self.tag, *self.names))


def names_of(attrs: str) -> tuple[str, ...]:
    """Words of class, id and role in order, once each; numbers in them are left out, as they tell pages apart, not kinds."""
    if not attrs or "=" not in attrs and "hidden" not in attrs.lower():
        return ()
    found: dict[str, None] = {}
    for name, *values in _NAMES.findall(attrs):
        if name.lower() in ("hidden", "aria-hidden"):
            if name.lower() == "hidden" or "true" in (v.lower() for v in values):
                found["hidden"] = None
        else:
            found.update(dict.fromkeys(_WORDS.findall("".join(values).lower())))
    return tuple(sorted(found))


def parse(page: str) -> Node:
    """The tree of a page. Comments, declarations and contents of scripts and styles are left out; unclosed ones take the rest."""
    root = Node("#root")
    stack, at, length = [root], 0, len(page)
    while at < length:
        match = _TOKEN.search(page, at)
        if match is None:
            break
        if match.start() > at:
            stack[-1].children.append(html.unescape(page[at:match.start()]))
        at = match.end()
        tag = match["tag"]
        if tag is None:
            if match[0].startswith("<![CDATA["):
                stack[-1].children.append(match[0][9:].removesuffix("]]>"))
            continue
        tag = tag.lower()
        if match["end"]:
            if tag == "br":
                stack[-1].children.append(Node("br"))
            _close(stack, tag)
            continue
        _make_room(stack, tag)
        node = Node(tag, names_of(match["attrs"]))
        stack[-1].children.append(node)
        if tag in RAW:
            end = re.compile(rf"</{tag}(?=[\s/>])[^>]*>|\Z", re.I).search(page, at)
            if tag in ("textarea", "title"):
                node.children.append(html.unescape(page[at:end.start()]))
            at = end.end()
        elif tag not in VOID and len(stack) < DEPTH and (tag in BLOCKS or not match["attrs"].rstrip().endswith("/")):
            stack.append(node)
    if at < length:
        stack[-1].children.append(html.unescape(_CUT_TAG.sub("", page[at:])))
    return root


def _make_room(stack: list[Node], tag: str) -> None:
    if tag in _PARAGRAPH_ENDS:
        for depth in range(len(stack) - 1, 0, -1):
            if stack[depth].tag == "p":
                del stack[depth:]
                break
            if stack[depth].tag in BLOCKS:
                break
    closes = CLOSES.get(tag)
    while closes and len(stack) > 1 and (stack[-1].tag in closes or stack[-1].tag not in BLOCKS):
        if stack[-1].tag in closes:
            stack.pop()
        elif any(n.tag in closes for n in stack[-4:]):
            stack.pop()
        else:
            break


def _close(stack: list[Node], tag: str) -> None:
    for depth in range(len(stack) - 1, 0, -1):
        if stack[depth].tag == tag:
            del stack[depth:]
            return
        if tag not in BLOCKS and stack[depth].tag in BLOCKS or tag not in _SCOPES and stack[depth].tag in _SCOPES:
            return
