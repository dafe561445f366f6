"""Main text of web pages, by wrappers inferred for each host.

A wrapper is a union-free regular expression over the tags of a host's pages: a tree whose nodes may be optional or repeated,
and whose texts are fixed or slots. It begins as the first page itself; every further page is aligned with it, and each
mismatch makes a text a slot, a run of tags optional, or a square of tags a repeated group.
"""

from __future__ import annotations

import json
import sys
from collections.abc import Callable, Iterator

import pandas as pd
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewind.llm.markup import BLOCKS, DEPTH, Node, parse
from tradewind.llm.url_templates import host_and_path
from tradewind.llm.util import arrow_batches, text_or_empty

#: Elements, and words of class, id and role, that are not part of an article.
DROPPED_TAGS = frozenset(
    "audio aside button canvas datalist dialog embed footer form head header iframe input menu nav noscript object option script "
    "select style svg template textarea title video".split())
DROPPED_NAMES = frozenset(
    "ad ads adsense advert advertisement adverts alert banner breadcrumb breadcrumbs comment comments consent cookie cookies "
    "disqus footer gdpr header hidden login masthead menu modal nav navbar navigation newsletter notice notification overlay "
    "pager pagination popup promo promotion recommended related reply respond search share sharing sidebar signup social sponsor "
    "sponsored subscribe toolbar widget".split())
#: With these words a name tells of something else in the page, as in has-sidebar.
NEGATIONS = frozenset("has no with without".split())
#: Most children of a node of a wrapper; more are folded into one repeated group of optional children, (a? b? c?)+.
WIDTH = 48
#: Most different children in such a group. With more, keys lose the words of class and id: first those that few pages have, as
#: they tell pages apart, then all; tags that are still too many become one.
KINDS = 256
ANY = "#any"
GROUP = 3
#: A text is fixed if so many of 100 pages that have its place have it there, and these are ``LEAST`` pages and a tenth of the
#: host's; within an article or main part, ``SURE`` pages and half of the host's, as a page may be there in some copies.
SHARE, LEAST, SURE = 95, 3, 20
#: Texts on at most one page in so many aren't kept.
RARE = 20
TEXT = "#text"


def dropped(node: Node) -> bool:
    if node.tag in DROPPED_TAGS:
        return True
    if node.tag in ("article", "main", "body", "html"):
        return "hidden" in node.names
    return not DROPPED_NAMES.isdisjoint(node.names) and NEGATIONS.isdisjoint(node.names)


# --- wrappers: [key, pages, optional, repeated, whether a text is fixed, children, {text: [pages, pages it may have besides]}] ---

KEY, PAGES, OPTIONAL, REPEATED, FIXED, CHILDREN, TEXTS = range(7)


def of_page(node: Node) -> list:
    """The wrapper of one page, with its squares folded."""
    children = []
    for child in node.children:
        if isinstance(child, str):
            if words := child.split():
                children.append([TEXT, 1, False, False, True, [], {xxhash.xxh64_hexdigest(" ".join(words)): [1, 0]}])
        elif not dropped(child):
            children.append(of_page(child))
        else:
            children.append([child.key, 1, False, False, False, [], {}])
    return [node.key, 1, False, False, False, folded(children, 1), {}]


def folded(children: list[list], pages: int) -> list[list]:
    """Children of a node that ``pages`` have, with adjacent equal ones, and groups of up to ``GROUP`` that follow each other, made one repeated one."""
    for size in range(1, GROUP + 1):
        out: list[list] = []
        for child in children:
            out.append(child)
            while len(out) >= 2 * size and _keys(out[-size:]) == _keys(out[-2 * size:-size]):
                tail = out[-size:]
                del out[-size:]
                for n, one in enumerate(tail, len(out) - size):
                    out[n] = merged(out[n], one, pages)
                if size == 1:
                    out[-1][REPEATED] = True
                else:
                    out[-size:] = [_group(out[-size:])]
            if size > 1 and len(out) > size and out[-size - 1][KEY] == _group_key(out[-size:]):
                tail = out[-size:]
                del out[-size:]
                out[-1] = merged(out[-1], _group(tail), pages)
        children = out
    return [_any([children], pages)] if len(children) > WIDTH else children


def _any(sides: list[list[list]], pages: int) -> list:
    """All children of a node in one group (a? b? c?)+, united by key, never one group within another. ``sides``: children
    from the same pages, or of two sets of pages."""
    united: dict[str, list] = {}
    for side in sides:
        own: dict[str, list] = {}
        for child in _flat(side):
            own[child[KEY]] = merged(own[child[KEY]], child, pages) if child[KEY] in own else child
        for key, child in own.items():
            united[key] = merged(united[key], child) if key in united else child
    for rare in (True, False):
        if len(united) > KINDS:
            united = _renamed(united, pages, lambda c: general(c[KEY]) if not rare or c[PAGES] * 10 < pages else c[KEY])
    if len(united) > KINDS:
        united = _renamed(united, pages, lambda c: c[KEY] if c[KEY] == TEXT else "*")
    return [ANY, pages, False, True, False, [[*c[:OPTIONAL], True, *c[REPEATED:]] for c in united.values()], {}]


def _flat(children: list[list]) -> Iterator[list]:
    for child in children:
        if child[KEY] == ANY or child[KEY].startswith("#("):
            yield from _flat(child[CHILDREN])
        else:
            yield child


def _renamed(children: dict[str, list], pages: int, name: Callable[[list], str]) -> dict[str, list]:
    out: dict[str, list] = {}
    for child in children.values():
        key = name(child)
        child = [key, *child[1:]]
        out[key] = merged(out[key], child, pages) if key in out else child
    return out


def general(key: str) -> str:
    """A key without the words of class, id and role."""
    tag, words, _ = key.partition(".")
    return f"{tag}.*" if words else key


def _keys(children: list[list]) -> list[str]:
    return [c[KEY] for c in children]


def _group_key(children: list[list]) -> str:
    return "#(" + " ".join(_keys(children)) + ")"


def _group(children: list[list]) -> list:
    return [_group_key(children), max(c[PAGES] for c in children), False, True, False, children, {}]


def merged(one: list, other: list, within: int = 0) -> list:
    """Two wrappers of the same key in one. ``within``: both lie in an element that so many pages have, and are of the same pages."""
    pages = min(one[PAGES] + other[PAGES], within) if within else one[PAGES] + other[PAGES]
    texts = _counted(one, other, pages)
    return [one[KEY], pages, one[OPTIONAL] or other[OPTIONAL], one[REPEATED] or other[REPEATED], bool(common(texts, pages)),
            aligned(one[CHILDREN], other[CHILDREN], pages, bool(within)), texts]


def _counted(one: list, other: list, pages: int) -> dict[str, list[int]]:
    """Texts of two nodes with the pages that have them there. A text is forgotten when it is on at most one page in ``RARE``, so
    what comes anew may have been on as many before."""
    missed = one[PAGES] // RARE, other[PAGES] // RARE
    out = {t: [c, most + missed[1]] for t, (c, most) in one[TEXTS].items()}
    for t, (c, most) in other[TEXTS].items():
        old = one[TEXTS].get(t)
        out[t] = [min(old[0] + c, pages), old[1] + most] if old else [c, most + missed[0]]
    if pages // RARE > max(missed):
        out = {t: n for t, n in out.items() if sum(n) > pages // RARE}
    return out


def common(texts: dict[str, list[int]], pages: int) -> list[str]:
    """Texts that are fixed: all that are on ``SHARE`` of 100 pages that have the place, and none that lacks ``100 / RARE`` more."""
    return [t for t, n in texts.items() if sum(n) * 100 >= SHARE * pages]


def aligned(one: list[list], other: list[list], pages: int, within: bool = False) -> list[list]:
    """Children of two nodes on a longest common sequence of their keys; what only one has becomes optional. Together ``pages`` have
    the node; ``within``: the two are of the same pages."""
    if any(c[KEY] == ANY for c in (*one, *other)):
        return [_any([[*one, *other]] if within else [one, other], pages)]
    of_both = pages if within else 0
    if [c[KEY] for c in one] == [c[KEY] for c in other]:
        return [merged(a, b, of_both) for a, b in zip(one, other)]
    one, other = _grouped_as(one, other), _grouped_as(other, one)
    n, m = len(one), len(other)
    best = [[0] * (m + 1) for _ in range(n + 1)]
    for i in range(n - 1, -1, -1):
        for j in range(m - 1, -1, -1):
            best[i][j] = best[i + 1][j + 1] + 1 if one[i][KEY] == other[j][KEY] else max(best[i + 1][j], best[i][j + 1])
    out, i, j = [], 0, 0
    while i < n or j < m:
        if i < n and j < m and one[i][KEY] == other[j][KEY]:
            out.append(merged(one[i], other[j], of_both))
            i, j = i + 1, j + 1
        elif j == m or i < n and best[i + 1][j] >= best[i][j + 1]:
            out.append([*one[i][:OPTIONAL], True, *one[i][REPEATED:]])
            i += 1
        else:
            out.append([*other[j][:OPTIONAL], True, *other[j][REPEATED:]])
            j += 1
    return folded(out, pages)


def _grouped_as(children: list[list], other: list[list]) -> list[list]:
    """A run that the other side has as a repeated group is one here too."""
    groups = {c[KEY]: _keys(c[CHILDREN]) for c in other if c[KEY].startswith("#(")}
    for key, inside in groups.items():
        out: list[list] = []
        for child in children:
            out.append(child)
            if _keys(out[-len(inside):]) == inside:
                out[-len(inside):] = [_group(out[-len(inside):])]
        children = out
    return children


# --- extraction ---

class Place:
    """A chain of keys in a wrapper: the fixed texts there, those sure enough to be left out of an article, and what is below."""

    __slots__ = ("fixed", "sure", "below")

    def __init__(self) -> None:
        self.fixed, self.sure, self.below = set(), set(), {}


class Pattern:
    """A wrapper made ready to look up. Optional and repeated groups are seen through: their texts lie in the element around them."""

    def __init__(self, wrapper: list):
        self.pages, self.root = wrapper[PAGES], Place()
        for child in wrapper[CHILDREN]:
            self._read(child, self.root)

    def _read(self, node: list, place: Place) -> None:
        if node[KEY] == TEXT:
            # What nearly all pages have that have the place is of the template, if enough of the host's pages have it.
            if node[PAGES] >= max(LEAST, self.pages / 10):
                texts = common(node[TEXTS], node[PAGES])
                place.fixed.update(texts)
                if node[PAGES] >= max(SURE, self.pages / 2):
                    place.sure.update(texts)
            return
        if not node[KEY].startswith(("#(", ANY)):
            place = place.below.setdefault(node[KEY], Place())
        for child in node[CHILDREN]:
            self._read(child, place)


def text_of(root: Node, pattern: Pattern | None) -> str:
    """Text of the innermost articles of a page, or of its main part, or else of the whole page, without the host's template.

    Where nothing is left without the template, the template stays."""
    place = pattern.root if pattern else None
    found = list(_regions(root, place))
    for tag in ("article", "main"):
        picked = [(n, p) for n, p, kind in found if kind == tag]
        for known in (True, False) if pattern else (False,):
            if text := " ".join(t for n, p in picked if (t := _blocks(n, p if known else None, True))):
                return text
    return _blocks(root, place, False) or _blocks(root, None, False)


def _regions(node: Node, place: Place | None) -> Iterator[tuple[Node, Place | None, str]]:
    kind = "article" if node.tag == "article" else "main"
    if node.tag in ("article", "main") or "main" in node.names:
        inside = [] if kind == "article" else [r for r in _below(node, place) if r[2] == "article"]
        yield from inside
        yield node, place, kind
    else:
        yield from _below(node, place)


def _below(node: Node, place: Place | None) -> Iterator[tuple[Node, Place | None, str]]:
    for child in node.children:
        if not isinstance(child, str) and not dropped(child):
            yield from _regions(child, _at(place, child))


def _at(place: Place | None, child: Node) -> Place | None:
    """The place of a child: that of its key, or else of what rare keys were generalised to."""
    if not place or not place.below:
        return None
    return place.below.get(child.key) or place.below.get(general(child.key)) or place.below.get("*")


def _blocks(node: Node, place: Place | None, in_article: bool) -> str:
    out: list[str] = []

    def walk(node: Node, place: Place | None) -> None:
        fixed = (place.sure if in_article else place.fixed) if place else None
        for child in node.children:
            if isinstance(child, str):
                if fixed and xxhash.xxh64_hexdigest(" ".join(child.split())) in fixed:
                    out.append(" ")
                else:
                    out.append(child)
            elif dropped(child):
                if child.tag in BLOCKS:
                    out.append(" ")
            else:
                line = child.tag in BLOCKS
                if line:
                    out.append(" ")
                walk(child, _at(place, child))
                if line:
                    out.append(" ")

    walk(node, place)
    return " ".join("".join(out).split())


# --- on Spark ---

WRAPPERS = "host string, part int, wrapper string"
#: Characters of pages after which a task hands on its wrappers.
HELD = 64 << 20


def _room() -> None:
    """Calls for elements in each other, up to ``DEPTH`` of them with several calls each."""
    sys.setrecursionlimit(max(sys.getrecursionlimit(), 20 * DEPTH))


def _folding(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Wrappers of a host, which come one after the other, aligned into one."""
    _room()
    host, whole = None, None
    for batch in batches:
        out = []
        for name, wrapper in zip(batch["host"], batch["wrapper"]):
            if whole is not None and name == host:
                whole = merged(whole, json.loads(wrapper))
            else:
                if whole is not None:
                    out.append((host, 0, json.dumps(whole)))
                host, whole = name, json.loads(wrapper)
        yield pd.DataFrame(out, columns=["host", "part", "wrapper"])
    if whole is not None:
        yield pd.DataFrame([(host, 0, json.dumps(whole))], columns=["host", "part", "wrapper"])


def infer(pages: DataFrame, lanes: int = 32) -> DataFrame:
    """A wrapper (JSON) for each ``host`` of ``pages`` (``host``, ``html``).

    Pages are aligned where they lie, into one wrapper for each host and task; these are aligned in ``lanes`` for each host, and
    then the lanes. A node of a wrapper has at most ``WIDTH`` children, or ``KINDS`` in one group, and its depth is bounded too; an
    element whose class or id few pages have counts as any of its tag there. Of the texts of a place, those on more than one page in
    ``RARE`` are kept. Null, empty and blank pages tell nothing; a host with no others has no wrapper.
    """
    def learn(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        _room()
        known: dict[str, list] = {}
        held = 0
        part = TaskContext.get().partitionId()
        for batch in batches:
            for host, page in zip(batch["host"], batch["html"]):
                own = of_page(parse(page))
                if own[CHILDREN]:  # an empty page tells nothing
                    known[host] = merged(known[host], own) if host in known else own
                    held += len(page)
            if len(known) > 10_000 or held > HELD:
                yield pd.DataFrame([(h, part, json.dumps(w)) for h, w in known.items()], columns=["host", "part", "wrapper"])
                known, held = {}, 0
        yield pd.DataFrame([(h, part, json.dumps(w)) for h, w in known.items()], columns=["host", "part", "wrapper"])

    partial = pages.mapInPandas(learn, WRAPPERS).withColumn("part", F.col("part") % lanes)
    lane = partial.repartition("host", "part").sortWithinPartitions("host", "part").mapInPandas(_folding, WRAPPERS)
    whole = lane.repartition("host").sortWithinPartitions("host").mapInPandas(_folding, WRAPPERS)
    return whole.select("host", "wrapper")


def extract(pages: DataFrame) -> DataFrame:
    """``pages`` (``url``, ``html`` and any others) with ``text`` and ``n_chars``, its code points.

    Other columns stay, except that one named like a column of the result is replaced. A null or empty page has an empty text.
    Pages without a host share a wrapper. Repeated pages are extracted alike; an empty table gives no rows. Left out are what
    ``dropped`` names and the texts that the host's wrapper calls fixed, within articles only from ``SURE`` pages on.
    """
    arrow_batches(pages.sparkSession, 500)
    host = host_and_path(F.col("url"))[0]
    wrappers = infer(pages.select(host.alias("host"), text_or_empty("html").alias("html"))).select(
        F.col("host").alias("_host"), F.col("wrapper").alias("_wrapper"))

    @F.pandas_udf("string")
    def text(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        _room()
        for html, wrapper in batches:
            patterns = {w: Pattern(json.loads(w)) if w else None for w in set(wrapper)}
            yield pd.Series([text_of(parse(h), patterns[w]) for h, w in zip(html, wrapper)], dtype=object)

    joined = pages.withColumn("_of", host).join(wrappers, F.col("_of") == F.col("_host"), "left")
    found = joined.withColumn("text", text(text_or_empty("html"), F.coalesce("_wrapper", F.lit(""))))
    return found.withColumn("n_chars", F.length("text").cast("long")).drop("_of", "_host", "_wrapper")
