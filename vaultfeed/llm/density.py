"""HTML extraction by composite text density: the subtree with the largest sum of its children's densities is the text."""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape
from math import e, log

import pyarrow as pa
from pyspark.sql import DataFrame

from .common import mapped, slices

# Fixed values of HTML: which elements have no content, hold raw text, end a block, and end an open element before them.
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = frozenset("iframe noembed noframes noscript script style textarea title xmp".split())
_BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form"
    " h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre search section summary table tbody"
    " tfoot thead tr ul".split()
)
_HEADING = frozenset("h1 h2 h3 h4 h5 h6".split())
_CELL = frozenset(("td", "th"))
_CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "option": ({"option"}, {"select", "datalist"}),
    "optgroup": ({"option", "optgroup"}, {"select"}),
    "tr": ({"tr", "td", "th", "caption"}, {"table"}),
    "td": ({"td", "th"}, {"table", "tr"}),
    "th": ({"td", "th"}, {"table", "tr"}),
    **{t: ({"tr", "td", "th", "tbody", "thead", "tfoot", "caption"}, {"table"}) for t in ("tbody", "thead", "tfoot")},
}
#: A paragraph is open inside inline elements only, so any of these ends the search for one to close.
_SCOPE = frozenset("button caption html object table td th template".split())
# Elements that never hold the article's text, and those that stand around it.
_NEVER = frozenset("audio button canvas datalist head iframe input noembed noframes noscript object script select style svg template textarea title video xmp".split())
_AROUND = frozenset("aside dialog footer menu nav search".split())
_HEAD = frozenset("base link meta noscript script style template title".split())
#: Elements deeper than this take no children of their own, as in browsers; their text stays.
DEPTH = 512
# Words of a class, id or role that name a part beside the article.
_BESIDE = frozenset(
    "ad ads adbox adsense adslot adunit advert adverts advertisement advertisements advertising advertorial alert alertdialog alerts banner breadcrumb"
    " breadcrumbs comment comments commentlist complementary consent contentinfo cookie cookies dialog disclaimer disqus footer gdpr header lightbox login"
    " masthead menu menubar modal nav navbar navigation navmenu newsletter notice notices notification pager pagination popup promo promos"
    " promoted recommended related reply replies respond search share sharing sidebar sidebars signup skip social sponsor sponsored"
    " sponsors subscribe subscription teaser teasers toolbar topbar tracking widget widgets".split()
)
#: Those of them that name a place for several texts beside the article, so an article in it is none of the page's own.
_PLACES = frozenset("comment comments commentlist disqus recommended related replies reply respond sidebar sidebars teaser teasers".split())
_MODIFIERS = frozenset("has have with no not without is can show hide enable enabled".split())
_WORD = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|[0-9]+")
_TAG = re.compile(r"<(/?)([A-Za-z][^\s/>\x00]*)((?:[^>=]++|=\s*+(?:\"[^\"]*+\"|'[^']*+'|(?![\"'])))*+)>")
_ATTRIBUTE = re.compile(r"([^\s=\"'/>]++)\s*+(?:=\s*+(?:\"([^\"]*+)\"|'([^']*+)'|([^\s\"'>]++)))?+")
_NAMED = ("class", "id", "role")


class Page:
    """A parsed page: nodes in page order, every parent before its children; node 0 is the page itself."""

    def __init__(self, html: str):
        self.tag, self.parent, self.attributes = ["html"], [-1], [{}]
        self.text: list[tuple[int, str]] = []  # node that holds the text directly, in page order
        self.breaks: list[tuple[int, int]] = []  # (number of texts before it, node): a node begins or ends there
        self._open = [0]
        self._parse(html)

    def _parse(self, html: str) -> None:
        at, n = 0, len(html)
        while at < n:
            mark = html.find("<", at)
            if mark < 0:
                self._add(html[at:])
                return
            if mark > at:
                self._add(html[at:mark])
            if tag := _TAG.match(html, mark):
                at = tag.end()
                name = tag[2].lower()
                if tag[1]:
                    self._close(name)
                    continue
                self._start(name, tag[3])
                if name in _RAW:
                    end = re.compile(rf"</{re.escape(name)}(?=[\s/>])", re.I).search(html, at)
                    stop = end.start() if end else n
                    if name in ("title", "textarea"):
                        self._add(html[at:stop])
                    at = stop
                    if not end:
                        return
            elif html.startswith("<!--", mark):
                end = html.find("-->", mark + 4)
                if end < 0:
                    return
                at = end + 3
            elif html[mark + 1 : mark + 2] in ("!", "?", "/") or html[mark + 1 : mark + 2].isalpha():
                end = html.find(">", mark)
                if end < 0:
                    return  # a tag that the page's end cuts off
                at = end + 1
            else:
                self._add("<")
                at = mark + 1

    def _end_head(self) -> None:
        if self.tag[self._open[-1]] == "head":
            self._cut(len(self._open) - 1)

    def _add(self, text: str) -> None:
        if not text.isspace():
            self._end_head()
        self.text.append((self._open[-1], unescape(text)))

    def _start(self, name: str, rest: str) -> None:
        if name in ("html", "body") and name in (self.tag[k] for k in self._open):
            return
        if name not in _HEAD:
            self._end_head()
        if name in _BLOCK:
            self._end_open({"p"}, _SCOPE)
            if name in _HEADING and self.tag[self._open[-1]] in _HEADING:
                self._open.pop()
        if name in _CLOSES:
            self._end_open(*_CLOSES[name])
        self.tag.append(name)
        self.parent.append(self._open[-1])
        known = {}
        for key, *values in _ATTRIBUTE.findall(rest) if rest.strip(" /") else ():
            if key.lower() in (*_NAMED, "itemprop"):
                known.setdefault(key.lower(), unescape("".join(values)))
        self.attributes.append(known)
        node = len(self.tag) - 1
        self.breaks.append((len(self.text), node))
        if name not in _VOID and len(self._open) < DEPTH:
            self._open.append(node)

    def _end_open(self, names: set[str], stop) -> None:
        """Ends the innermost open element of these names and all within it, unless one of `stop` lies between."""
        for k in range(len(self._open) - 1, 0, -1):
            tag = self.tag[self._open[k]]
            if tag in names:
                self._cut(k)
                self._end_open(names, stop)
                return
            if tag in stop:
                return

    def _close(self, name: str) -> None:
        if name in ("html", "body"):
            return  # what follows still belongs to the page
        for k in range(len(self._open) - 1, 0, -1):
            tag = self.tag[self._open[k]]
            if tag == name or (name in _HEADING and tag in _HEADING):
                self._cut(k)
                return
            if tag in _SCOPE and name not in ("table", "tr", "tbody", "thead", "tfoot", "object", "template"):
                return
        if name in ("p", "br"):  # without a start, it still breaks the block
            self._start(name, "")
            if name == "p":
                self._cut(len(self._open) - 1)

    def _cut(self, k: int) -> None:
        for node in reversed(self._open[k:]):
            self.breaks.append((len(self.text), node))
        del self._open[k:]


def _words(attributes: dict[str, str]) -> set[str]:
    """Words of class, id and role that name a part beside the article; not those of what an element has or lacks."""
    found: set[str] = set()
    for name in _NAMED:
        for value in attributes.get(name, "").split():
            words = [w.lower() for w in _WORD.findall(value)]
            if words and words[0] not in _MODIFIERS:
                found.update(_BESIDE.intersection(words))
    return found


def beside(page: Page) -> list[bool]:
    """Nodes that are no part of the article, by element or by the words of their class, id and role.

    An element so named stays if it holds the main part, the first heading, or an article and is no place for comments
    and the like. The header of an article or main part stays, that of the page goes.
    """
    n = len(page.tag)
    words = [_words(a) if a else set() for a in page.attributes]
    heading, article, inside, out = ([False] * n for _ in range(4))
    for k in range(n - 1, 0, -1):
        up = page.parent[k]
        heading[up] |= heading[k] or page.tag[k] in ("h1", "main")
        article[up] |= article[k] or page.tag[k] == "article" and (heading[k] or not words[k])
    for k in range(1, n):
        tag, up = page.tag[k], page.parent[k]
        inside[k] = inside[up] or page.tag[up] in ("article", "main")
        held = heading[k] or article[k] and not words[k] & _PLACES
        if tag in ("body", "main"):
            around = False
        elif tag == "header" or words[k] == {"header"}:
            around = not inside[k] and (tag == "header" or not held)
        elif tag in _AROUND:
            around = True
        elif tag == "article":
            around = bool(words[k]) and not heading[k]
        else:
            around = (tag == "form" or bool(words[k])) and not held
        out[k] = out[up] or tag in _NEVER or around
    return out


def densities(page: Page, left_out: list[bool]) -> tuple[list[float], list[float], list[int]]:
    """Composite density of every node, the sum of its children's (its own text counts as one child), its own characters.

    Density is characters a tag, raised where few of the characters and tags are links, and weighed against the share
    of links in the whole page. Nodes that are left out count as if they were not there, but for that share.
    """
    n = len(page.tag)
    chars, tags, own = [0] * n, [1] * n, [0] * n
    link = [False] * n
    for k in range(1, n):
        link[k] = page.tag[k] == "a" or link[page.parent[k]]
    all_chars = all_links = 0
    for node, text in page.text:
        count = len("".join(text.split()))
        if page.tag[node] not in _NEVER:
            all_chars += count
            all_links += count * link[node]
        if not left_out[node]:
            own[node] += count
    share = all_links / all_chars if all_chars else 0.0
    link_chars, link_tags = [0] * n, [0] * n
    for k in range(n - 1, -1, -1):
        if left_out[k]:
            continue
        chars[k] += own[k]
        link_chars[k] += own[k] * link[k]
        link_tags[k] += link[k]
        if k:
            up = page.parent[k]
            for counts in (chars, tags, link_chars, link_tags):
                counts[up] += counts[k]
    density, total = [0.0] * n, [float(x) for x in own]
    for k in range(n - 1, -1, -1):
        if left_out[k] or not chars[k]:
            continue
        plain = chars[k] / tags[k]
        base = log(e + chars[k] / max(1, chars[k] - link_chars[k]) * link_chars[k] + share * chars[k])
        rest = log(max(e, chars[k] / max(1, link_chars[k]) * tags[k] / max(1, link_tags[k])))
        density[k] = plain * rest / max(base, 1.0)
        if k:
            total[page.parent[k]] += density[k]
    return density, total, own


def chosen(page: Page, left_out: list[bool]) -> list[bool]:
    """Nodes whose own text is taken: the subtree with the largest sum, and what is as dense beside its way to the body.

    The threshold is the least density on the way from that subtree to the body. Beside the way, subtrees that reach it
    and headings are taken as well. Where the subtree lies in an article element, or in the main one, that is taken whole.
    """
    n = len(page.tag)
    density, total, own = densities(page, left_out)
    top = max(range(n), key=lambda k: (total[k] if not left_out[k] else -1.0, -k))
    way = [top]
    while way[-1]:
        way.append(page.parent[way[-1]])
    body = next((k for k in way if page.tag[k] == "body"), 0)
    way = way[: way.index(body) + 1]
    whole = [k for k in way if page.tag[k] == "article" or "articleBody" in page.attributes[k].get("itemprop", "")]
    whole = whole or [k for k in way if page.tag[k] == "main" or page.attributes[k].get("role") == "main"]
    taken, direct = [False] * n, [False] * n
    if whole:
        taken[whole[-1]] = True
    else:
        threshold, on_way = min(density[k] for k in way), set(way)
        taken[top] = True
        for k in range(1, n):
            if page.parent[k] in on_way and k not in on_way:
                taken[k] = density[k] >= threshold or page.tag[k] in _HEADING
        for k in way[1:]:
            direct[k] = own[k] >= threshold > 0
    for k in range(1, n):
        taken[k] = (taken[k] or taken[page.parent[k]]) and not left_out[k]
    return [a or b for a, b in zip(taken, direct, strict=True)]


def extract(html: str) -> str:
    """The blocks of the article's text, in page order, two line breaks between them; empty if there is none."""
    page = Page(html)
    taken = chosen(page, beside(page))
    blocks: list[str] = []
    pieces: list[str] = []
    at = 0

    def end() -> None:
        if block := " ".join("".join(pieces).split()):
            blocks.append(block)
        pieces.clear()

    for before, node in [*page.breaks, (len(page.text), 0)]:
        pieces.extend(text for holder, text in page.text[at:before] if taken[holder])
        at = before
        if page.tag[node] in _BLOCK:
            end()
        elif page.tag[node] in _CELL or page.tag[node] == "br":
            pieces.append(" ")
    return "\n\n".join(blocks)


def main_text(pages: DataFrame, html: str = "html") -> DataFrame:
    """page_id, url, text, n_chars of every row: the article of the page without what stands around it.

    Character references are decoded, white space within a block is one space, rows of a table are blocks and its cells
    are parted by a space. A null, empty or textless page has an empty text. Broken markup is read as browsers do in the
    usual cases: elements that are not closed end with their parent or where the next of their kind begins, a tag that
    the page's end cuts off is dropped. Of equal sums the outer, then the earlier subtree wins. A page of any length is
    one row of one task, read once from front to back. Repeated rows are all kept; other columns are not looked at.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "html"):
            texts = [extract(h) if h else "" for h in part.column("html").to_pylist()]
            counts = pa.array(map(len, texts), pa.int64(), size=len(texts))
            yield pa.RecordBatch.from_arrays([part.column("page_id"), part.column("url"), pa.array(texts, pa.string()), counts], names=["page_id", "url", "text", "n_chars"])

    rows = pages.select("page_id", "url", pages[html].alias("html"))
    return mapped(rows, run, f"page_id {dict(rows.dtypes)['page_id']}, url string, text string, n_chars long")


#: For pages whose article is an article element of headings and paragraphs, as those of the given tables.
SQL = r"""
with parts as (
  select page_id, url, string_split_regex(regexp_extract(coalesce(html, ''), '<article>(.*?)</article>', 1, 's'), '</?(?:p|h1)>') as cut
  from pages
), blocks as (
  select page_id, url, list_filter(list_transform(cut, lambda x: trim(regexp_replace(
    replace(replace(replace(replace(replace(replace(regexp_replace(x, '<[^>]*>', '', 'g'),
      '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#x27;', ''''), '&#39;', ''''), '&amp;', '&'), '\s+', ' ', 'g'))), lambda x: x <> '') as b
  from parts
)
select page_id, url, coalesce(array_to_string(b, chr(10) || chr(10)), '') as text, length(coalesce(array_to_string(b, chr(10) || chr(10)), '')) as n_chars
from blocks
"""
