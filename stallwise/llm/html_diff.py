"""Main text of web pages: what a page does not share with the nearest pages of its host.

A page is read into lines, one per block, each with its kind (inside a content element, inside an element that is
not content by its name, role or class, or neither; a class does not decide for a content element inside) and the
innermost content element it is in. Pages are paired within a host by the longest common part of the URL path. All
lines of a page are aligned with all lines of its nearest pages by longest common subsequence: what is shared is the
template, what is not is the page's own. A page of which all lines are shared is a copy and tells nothing.

The lines that are the page's own say which places of the template it fills; the elements say which of these
places can hold the main text. A content element with lines of its own is the article and comes whole, as an
article may quote another; one whose lines are all template, such as a teaser on all pages, goes. Without
content elements the own lines that no element rules out are the text.
"""

from __future__ import annotations

import html as references
import re
from bisect import bisect_left
from urllib.parse import urlsplit

import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stallwise.llm.arrow import with_python
from stallwise.sources.scratch import materialized

_TOKEN = re.compile(
    r"<!--.*?(?:--!?>|\Z)"
    r"|<(?P<raw>script|style|template|noscript|iframe|textarea|svg)(?=[\s/>])(?P<rawattr>(?:[^>\"']++|\"[^\"]*(?:\"|\Z)|'[^']*(?:'|\Z))*+)>.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<(?P<close>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<attr>(?:[^>\"']++|\"[^\"]*(?:\"|\Z)|'[^']*(?:'|\Z))*+)(?:>|\Z)"
    r"|<[!?/][^>]*(?:>|\Z)",
    re.S | re.I,
)
_ATTR = re.compile(r"""([^\s"'>/=][^\s>/=]*)(?:\s*=\s*("[^"]*(?:"|\Z)|'[^']*(?:'|\Z)|[^\s>]+))?""")
#: Names of elements.
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_BLOCK = frozenset(
    "address article aside blockquote body br center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6"
    " head header hr html li main menu nav ol option p pre section summary table tbody td tfoot th thead title tr ul".split()
)
_ASIDE = frozenset("nav footer header aside form menu dialog button select fieldset head title".split())
_CONTENT = frozenset("article main".split())
_ASIDE_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alertdialog alert menu menubar".split())
_ASIDE_WORDS = frozenset(
    "ad ads advert advertisement adverts sponsor sponsored banner promo cookie cookies consent gdpr notice popup modal overlay newsletter"
    " subscribe subscription menu nav navbar navigation breadcrumb breadcrumbs sidebar widget share sharing social related recommended"
    " footer header masthead comment comments discussion replies respond pagination pager toolbar skip login".split()
)
CONTENT, NEITHER, ASIDE = 0, 1, 2
#: An element that is not content by its class or id alone: content elements inside it are content.
LOOSE = 3
#: Start tags that close an open element whose end tag may be left out, if no other element of the last set is between.
_CLOSES_P = frozenset(
    "address article aside blockquote center details dialog div dl dd dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr li"
    " main menu nav ol p pre section summary table ul".split()
)
_P_LIMIT = frozenset("table caption td th button object html".split())
_ITEM_LIMIT = _BLOCK - frozenset("address div p".split())
_ROW_GROUPS = frozenset("tbody thead tfoot".split())
_CLOSES = {
    "li": (frozenset(["li"]), _ITEM_LIMIT - {"li"}),
    "dd": (frozenset(["dd", "dt"]), _ITEM_LIMIT - {"dd", "dt"}),
    "dt": (frozenset(["dd", "dt"]), _ITEM_LIMIT - {"dd", "dt"}),
    "td": (frozenset(["td", "th"]), frozenset(["table", "tr"])),
    "th": (frozenset(["td", "th"]), frozenset(["table", "tr"])),
    "tr": (frozenset(["tr"]), frozenset(["table"])),
} | {name: (_ROW_GROUPS, frozenset(["table"])) for name in _ROW_GROUPS}


def _left_out(stack: list[tuple[str, int]], name: str) -> None:
    """Close the elements whose end tag is left out before a start tag of ``name``."""
    none = frozenset(), frozenset()
    for names, limit in (_CLOSES.get(name, none), (frozenset(["p"]), _P_LIMIT) if name in _CLOSES_P else none):
        for k in range(len(stack) - 1, -1, -1):
            if stack[k][0] in names:
                del stack[k:]
                break
            if stack[k][0] in limit:
                break


def _kind(name: str, attr: str) -> int:
    """CONTENT, ASIDE, LOOSE or NEITHER, of an element by itself."""
    words: set[str] = set()
    role = ""
    for m in _ATTR.finditer(attr):
        key, value = m[1].lower(), (m[2] or "").strip("\"'").lower()
        if key == "role":
            role = value
        elif key in ("hidden", "aria-hidden"):
            if value != "false":
                return ASIDE
        elif key in ("class", "id"):
            words.update(re.split(r"[^a-z0-9]+", value))
    if name in _ASIDE or role in _ASIDE_ROLES:
        return ASIDE
    if name in _CONTENT or role == "main":
        return CONTENT
    return LOOSE if words & _ASIDE_WORDS and name not in ("html", "body") else NEITHER


def lines_of(html: str | None) -> list[tuple[str, int]]:
    """(text, kind) of each block with text; what an unclosed tag or comment at the end holds is markup."""
    return [(text, kind) for text, kind, _ in placed_lines(html)]


def placed_lines(html: str | None) -> list[tuple[str, int, int]]:
    """(text, kind, place) of each block with text; place is the number of the innermost content element, 0 outside."""
    out: list[tuple[str, int, int]] = []
    text: list[str] = []
    stack: list[tuple[str, int]] = []
    places: list[int] = []
    kind, place, made, at, html = NEITHER, 0, 0, 0, html or ""

    def flush() -> None:
        if line := " ".join("".join(text).split()):
            out.append((line, kind, place))
        text.clear()

    for m in _TOKEN.finditer(html):
        if m.start() > at:
            text.append(references.unescape(html[at : m.start()]))
        at = m.end()
        name = (m["name"] or "").lower()
        if not name:
            continue
        if name in _BLOCK:
            flush()
        if not m["close"]:
            _left_out(stack, name)
        if m["close"]:
            if any(n == name for n, _ in stack):
                while stack.pop()[0] != name:
                    pass
        elif name not in _VOID and not m["attr"].endswith("/"):
            own = _kind(name, m["attr"]) if m["attr"] or name in _ASIDE or name in _CONTENT else NEITHER
            above = stack[-1][1] if stack else NEITHER
            if above == ASIDE or (above == LOOSE and own == LOOSE):
                inside = above
            else:
                inside = own if own != NEITHER else above
            if own == ASIDE and above == CONTENT and name == "header" and "=" not in m["attr"]:
                inside = CONTENT  # the title of an article
            stack.append((name, inside))
            del places[len(stack) - 1 :]
            if own == CONTENT:
                made += 1
            places.append(made if own == CONTENT else places[-1] if places else 0)
        new = min(stack[-1][1], ASIDE) if stack else NEITHER
        here = places[len(stack) - 1] if stack else 0
        if new != kind or here != place:
            flush()
            kind, place = new, here
    if at < len(html):
        text.append(references.unescape(html[at:]))
    flush()
    return out


def shared(mine: list[str], other: list[str]) -> list[int]:
    """Places in ``mine`` of a longest common subsequence of two lists of lines."""
    places: dict[str, list[int]] = {}
    for k, line in enumerate(other):
        places.setdefault(line, []).append(k)
    ends: list[int] = []  # least end in other of a common subsequence of each length
    tails: list[tuple] = []  # and its links
    for k, line in enumerate(mine):
        for p in reversed(places.get(line, ())):
            n = bisect_left(ends, p)
            link = (k, tails[n - 1] if n else None)
            if n == len(ends):
                ends.append(p)
                tails.append(link)
            else:
                ends[n], tails[n] = p, link
    out = []
    link = tails[-1] if tails else None
    while link:
        out.append(link[0])
        link = link[1]
    return out[::-1]


def prefixes(url: str | None) -> tuple[str, list[str]]:
    """The path of a URL, and the host with each part of the path from none to all."""
    try:
        parts = urlsplit(url or "")
        host, path = (parts.hostname or ""), parts.path
    except ValueError:
        host, path = "", url or ""
    steps = [s for s in path.split("/") if s]
    return "/".join(steps), [host + "".join("/" + s for s in steps[:k]) for k in range(len(steps) + 1)]


def _key(url: str | None, html: str | None) -> bytes:
    return xxhash.xxh3_128_digest(f"{url or ''}\n{html or ''}")


def _marks(lines: list[tuple[str, int, int]]) -> list[int]:
    """A number for each line, equal for lines of equal text and kind."""
    return [xxhash.xxh3_64_intdigest(t, kind) - (1 << 63) for t, kind, _ in lines]


def nearest_lines(pages: DataFrame) -> DataFrame:
    """(__key, __others): the marks of all lines of the one or two pages nearest to each page.

    A page's nearest pages are those that agree with it in the longest part of host and path; of several the
    first and the last by path are taken. Equal pages count once. Only the two ends of a group carry their lines.
    """

    def make():
        def each(urls, htmls):
            for url, html in zip(urls, htmls, strict=True):
                path, steps = prefixes(url)
                yield _key(url, html), path, steps, _marks(placed_lines(html))

        return each

    def place():
        return lambda urls, htmls: ((_key(u, h), prefixes(u)[1]) for u, h in zip(urls, htmls, strict=True))

    d = pages.select(F.col("url").alias("__url"), F.col("html").alias("__html"))
    inputs = ["__url", "__html"]
    read = with_python(d, inputs, "__key binary, __path string, __steps array<string>, __lines array<bigint>", make, drop=inputs)
    page = F.struct(F.col("__path").alias("path"), F.col("__key").alias("key"), F.col("__lines").alias("lines"))
    groups = read.select(F.explode("__steps").alias("step"), page.alias("page")).groupBy("step")
    ends = materialized(groups.agg(F.min("page").alias("lo"), F.max("page").alias("hi")).filter("lo.key != hi.key"))
    steps = with_python(d, inputs, "__key binary, __steps array<string>", place, drop=inputs)
    near = steps.select("__key", F.posexplode("__steps").alias("depth", "step")).join(ends, "step")
    others = F.array_compact(F.array(*[F.when(F.col(f"{end}.key") != F.col("__key"), F.col(f"{end}.lines")) for end in ("lo", "hi")]))
    deepest = near.groupBy("__key").agg(F.max(F.struct("depth", others.alias("lines"))).alias("m"))
    return deepest.select("__key", F.col("m.lines").alias("__others"))


def own_lines(mine: list[int], others: list[list[int]]) -> set[int]:
    """Places in ``mine`` (marks of a page's lines) that no page of ``others`` shares; pages that share all are copies and tell nothing."""
    own = set(range(len(mine)))
    for other in others:
        both = shared(mine, other)
        if len(both) < len(mine):
            own.difference_update(both)
    return own


def chosen(kinds: list[int], places: list[int], own: set[int]) -> list[int]:
    """The lines of the main text: of content elements with lines of the page's own all, else own lines that no element rules out.

    If no content element has a line of its own, another page has the same article, and all of them count.
    """
    content = {places[k] for k, kind in enumerate(kinds) if kind == CONTENT}
    if content:
        filled = {places[k] for k in own if kinds[k] == CONTENT} or content
        return [k for k, kind in enumerate(kinds) if kind == CONTENT and places[k] in filled]
    return [k for k, kind in enumerate(kinds) if kind == NEITHER and k in own]


def main_text(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars of each row of ``pages``.

    Every row's text comes from the alignment of all its lines with those of its nearest pages (see above). NULL
    and empty html give the empty text; a NULL url is a host of its own; a page alone on its host shares nothing.
    Repeated rows are treated alike. Further columns play no part.
    """

    def make():
        def each(urls, htmls):
            for url, html in zip(urls, htmls, strict=True):
                lines = placed_lines(html)
                kinds = [kind for _, kind, _ in lines]
                wanted = CONTENT if CONTENT in kinds else NEITHER  # no other line can be chosen
                yield _key(url, html), [t if kind == wanted else None for t, kind, _ in lines], kinds, [p for _, _, p in lines], _marks(lines)

        return each

    def differ():
        def each(texts, kinds, places, marks, others):
            for lines, k, p, mine, other in zip(texts, kinds, places, marks, others, strict=True):
                yield (" ".join(lines[at] for at in chosen(k, p, own_lines(mine, other or []))),)

        return each

    d = pages.select("page_id", "url", F.col("html").alias("__html"))
    added = "__key binary, __lines array<string>, __kinds array<tinyint>, __places array<int>, __marks array<bigint>"
    read = with_python(d, ["url", "__html"], added, make, drop=["__html"])
    both = read.join(nearest_lines(pages), "__key", "left").drop("__key")
    inputs = ["__lines", "__kinds", "__places", "__marks", "__others"]
    out = with_python(both, inputs, "text string", differ, drop=inputs)
    return out.select("page_id", "url", "text").withColumn("n_chars", F.length("text").cast("long"))
