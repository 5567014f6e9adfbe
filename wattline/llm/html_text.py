"""Main text of web pages by tag-path ratios.

Wu et al., "Content extraction via tag path ratios" (2013) and its extended form. The path of a piece of
text is the list of block elements from the root to it, each with its class.

1. One pass over the tags cuts a page into blocks of text: runs that no block element begins or ends in.
   Elements that HTML closes by itself, as a ``p`` before the next ``p``, are closed here too.
2. Elements that are never part of the article go with all they hold: those whose name says so (scripts,
   menus, forms, asides, footers), whose role or style does (navigation, hidden), and whose class or id
   holds a word as ``comments`` or ``cookie``. A class or a form that wraps the article itself, or most
   of the page, doesn't count; that is how some pages name their frame.
3. Per path: characters per block, punctuation per block and the share of text outside links. The three
   are fused into one value, smoothed along the blocks of the page by a Gaussian and averaged per path.
   Paths that reach a share of the page's level, weighted by characters, are content paths.
4. The article is the smallest element that holds the text of all content paths, or the page's
   ``article`` or ``main`` with most of it. Its blocks are kept: those of content paths, and headings,
   paragraphs, list items, cells and the like of any path, if they aren't mostly links. A page's heading
   right above belongs to it.

Character references are decoded, white space within a block becomes one space, a ``br`` is white space,
blocks are joined by an empty line. Whole pages are read, broken ones too: an open comment or script ends
with the page, elements deeper than ``DEPTH`` count as their parent's text. A null or empty page and one
without article have the text ''. Null ids and urls stay, repeated rows stay. An empty table gives an
empty result. Other columns are ignored.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattline.llm import words as W
from wattline.llm.tables import picked

DEPTH = 512
SHARE = 0.15  # of the page's level that a content path reaches
WHOLE = 0.98  # of the content that the smallest element with "all" of it holds
MOST = 0.5  # of the text that makes an article the one of the page
FRAME = 0.9  # of the text, in several blocks, that makes an element the page's frame
LINKED = 0.5  # share of links from which a block outside content paths goes
_SMOOTH = np.exp(-0.5 * np.arange(-2, 3) ** 2)

_TAG = re.compile(
    r"<!--(?:>|->|.*?--!?>|.*\Z)|<[!?][^>]*>?|<(/?)([a-zA-Z][^\s/>]*)((?:[^>=]++|=\s*+(?:\"[^\"]*+\"|'[^']*+')?+)*+)>?", re.S
)
_ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_RAW = {n: re.compile(rf"</{n}(?=[\s/>])", re.I) for n in ("script", "style", "textarea", "title", "xmp", "iframe", "noembed", "noframes")}
_PUNCTUATION = re.compile(r"[.,;:!?…¿¡。，、；：！？]")

_VOID = frozenset("area base br col embed hr img input link meta param source track wbr basefont bgsound frame keygen".split())
_INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark nobr q rb rp rt rtc ruby s samp"
    " small span strike strong sub sup time tt u var".split()
)
_TEXTUAL = frozenset(
    "p h1 h2 h3 h4 h5 h6 li dt dd blockquote pre td th caption figcaption summary address".split()
)
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6 hgroup".split())
# Whatever stands in them is no article.
_NEVER = frozenset(
    "head script style title noscript template nav footer aside menu button select textarea option datalist dialog svg"
    " canvas iframe object applet audio video map noembed noframes".split()
)
_ENDS_P = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3"
    " h4 h5 h6 header hgroup hr li dd dt main menu nav ol p pre search section summary table ul xmp".split()
)
# Which open elements a start tag closes, and the elements beyond which it doesn't look for them.
_CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir", "table", "td", "th"}),
    "dt": ({"dt", "dd"}, {"dl", "table", "td", "th"}),
    "dd": ({"dt", "dd"}, {"dl", "table", "td", "th"}),
    "tr": ({"tr"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "thead": ({"thead", "tbody", "tfoot"}, {"table"}),
    "tbody": ({"thead", "tbody", "tfoot"}, {"table"}),
    "tfoot": ({"thead", "tbody", "tfoot"}, {"table"}),
    "option": ({"option"}, {"select", "datalist"}),
    "body": ({"head"}, set()),
}
_CELLS = frozenset({"table", "td", "th", "caption"})
_IN_HEAD = frozenset("base basefont bgsound link meta title style script noscript template head".split())

# Words of a class or id that name something beside the article.
_BESIDE = frozenset(
    "ad ads adv adsense adslot adbox banner sponsor sponsored promo promoted promotion cookie cookies consent gdpr notice"
    " notices alert popup modal overlay newsletter subscribe signup paywall comment comments commentlist disqus respond"
    " reply replies share sharing sharebar social related recommended recommendations recirculation trending popular"
    " outbrain taboola breadcrumb breadcrumbs pagination pager paginator nav navbar navigation menu submenu sidebar sidenav"
    " widget widgets toolbar footer masthead topbar login search searchform skip teaser teasers".split()
)
_BESIDE_PREFIX = ("advert", "adsby", "cookie", "sponsor", "comment", "breadcrumb", "newsletter")
_HEADERS = frozenset({"header", "site-header", "page-header", "global-header", "main-header", "top-header", "siteheader", "pageheader"})
# An article element of these is one beside the page's own; for an inline element only these count.
_SMALL = frozenset("ad ads adv advert advertisement sponsor sponsored promo comment comments reply related teaser hidden".split())
_ROLES = frozenset(
    "navigation banner contentinfo complementary search dialog alertdialog alert menu menubar toolbar form status".split()
)
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)
_DIGITS = re.compile(r"\d+")

_GOES, _BESIDE_IT = 2, 1


def _attributes(raw: str) -> dict[str, str]:
    found: dict[str, str] = {}
    for name, a, b, c in _ATTRIBUTE.findall(raw):
        found.setdefault(name.lower(), html.unescape(a or b or c))
    return found


def _standing(tag: str, own: dict[str, str]) -> int:
    """_GOES: never article. _BESIDE_IT: not article, unless it wraps the article. 0: may be."""
    if tag in _NEVER:
        return _GOES
    if not own:
        return _BESIDE_IT if tag == "form" else 0
    if "hidden" in own or own.get("aria-hidden") == "true" or _HIDDEN.search(own.get("style", "")):
        return _GOES
    if tag in ("html", "body", "main"):
        return 0
    if tag == "form" or own.get("role", "").lower() in _ROLES:
        return _BESIDE_IT
    names = f"{own.get('class', '')} {own.get('id', '')}"
    marks = {w.lower() for w in _WORD.findall(names)}
    if tag in _INLINE or tag == "article":
        return _BESIDE_IT if marks & _SMALL and (tag == "article" or not marks & {"comment", "comments"}) else 0
    if marks & _BESIDE or any(m.startswith(_BESIDE_PREFIX) for m in marks) or _HEADERS & set(names.lower().split()):
        return _BESIDE_IT
    return 0


class Page:
    """Blocks of text of one page, and the block elements that they stand in.

    Per element: tag, parent, path, standing. Per block: element, text, characters outside and inside links.
    """

    def __init__(self, source: str):
        self.tags, self.parents, self.paths, self.standing = ["html"], [0], [0], [0]
        self.elements: list[int] = []
        self.texts: list[str] = []
        self.plain: list[int] = []
        self.linked: list[int] = []
        self._known: dict[tuple[int, str], int] = {}
        self._run: list[str] = []
        self._links = 0
        # Open elements: tag, its block element, and whether the text is in a link or skipped.
        self._open: list[tuple[str, int, bool, bool]] = [("html", 0, False, False)]
        self._counts: dict[str, int] = {}
        self._read(source)

    def _read(self, source: str) -> None:
        at = 0
        while True:
            found = _TAG.search(source, at)
            self._text(source[at : found.start()] if found else source[at:])
            if not found:
                break
            at = found.end()
            slash, name, rest = found.groups()
            if name is None:
                continue
            name = name.lower()
            if slash:
                self._end(name)
                continue
            self._start(name, rest)
            if (raw := _RAW.get(name)) is not None:
                close = raw.search(source, at)
                at = close.start() if close else len(source)
        self._flush()

    def _text(self, raw: str) -> None:
        if raw and not self._open[-1][3]:
            text = html.unescape(raw) if "&" in raw else raw
            self._run.append(text)
            if self._open[-1][2]:
                self._links += len(text.strip())

    def _flush(self) -> None:
        if self._run:
            text = " ".join("".join(self._run).split())
            if text:
                linked = min(self._links, len(text))
                self.elements.append(self._open[-1][1])
                self.texts.append(text)
                self.plain.append(len(text) - linked)
                self.linked.append(linked)
            self._run = []
            self._links = 0

    def _cut(self, size: int) -> None:
        """Close all open elements from place ``size`` on."""
        for tag, *_ in self._open[size:]:
            self._counts[tag] -= 1
        del self._open[size:]

    def _place(self, tags: set[str], beyond: set[str] | frozenset[str]) -> int:
        """Place of the innermost open element of one of these tags, 0 if there is none in reach."""
        if any(self._counts.get(t) for t in tags):
            for k in range(len(self._open) - 1, 0, -1):
                if self._open[k][0] in tags:
                    return k
                if self._open[k][0] in beyond:
                    return 0
        return 0

    def _start(self, tag: str, rest: str) -> None:
        inline = tag in _INLINE
        if not inline and tag not in ("br", "wbr", "img") and not (tag in _VOID and tag != "hr"):
            self._flush()
            if self._counts.get("head") and tag not in _IN_HEAD and (k := self._place({"head"}, frozenset())):
                self._cut(k)
            if tag in _ENDS_P and (k := self._place({"p"}, _CELLS)):
                self._cut(k)
            if tag in _CLOSES and (k := self._place(*_CLOSES[tag])):
                self._cut(k)
        if tag in _VOID:
            if tag == "br":
                self._text(" ")
            return
        if tag in ("html",) or len(self._open) > DEPTH:
            return
        _, block, link, skip = self._open[-1]
        own = _attributes(rest) if "=" in rest or "hidden" in rest else {}
        if inline:
            if tag == "a" and link and (k := self._place({"a"}, frozenset())):
                # Links don't nest: the open one ends here.
                self._open[k] = ("", *self._open[k][1:])
                self._counts["a"] -= 1
                self._counts[""] = self._counts.get("", 0) + 1
            skip = skip or bool(own) and _standing(tag, own) > 0
            link = tag == "a" or link
        else:
            label = " ".join(sorted(_DIGITS.sub("", own.get("class", "")).split()))
            key = (self.paths[block], f"{tag}.{label}")
            path = self._known.setdefault(key, len(self._known) + 1)
            self.tags.append("main" if own.get("role") == "main" or own.get("itemprop") == "articleBody" else tag)
            self.parents.append(block)
            self.paths.append(path)
            self.standing.append(_standing(tag, own))
            block = len(self.tags) - 1
        self._open.append((tag, block, link, skip))
        self._counts[tag] = self._counts.get(tag, 0) + 1

    def _end(self, tag: str) -> None:
        inline = tag in _INLINE
        if not inline:
            if tag in ("br", "p") and not self._counts.get(tag):
                self._text(" ") if tag == "br" else self._flush()
                return
            self._flush()
        if not self._counts.get(tag):
            return
        of_table = tag in _CELLS or tag in _CLOSES and "table" in _CLOSES[tag][1] and tag not in ("li", "dt", "dd")
        k = self._place({tag}, frozenset({"table"} - {tag}) if of_table else _CELLS)
        if not k:
            return
        if inline and any(o[0] and o[0] not in _INLINE for o in self._open[k + 1 :]):
            # It ends across a block, which goes on: what is inside stands no longer in it.
            outer = self._open[k - 1]
            self._counts[tag] -= 1
            self._counts[""] = self._counts.get("", 0) + 1
            self._open[k] = ("", outer[1], outer[2], outer[3])
            if tag == "a":
                self._open[k:] = [(t, b, outer[2], s) for t, b, _, s in self._open[k:]]
            return
        self._cut(k)


def _below(values: np.ndarray, parents: list[int]) -> np.ndarray:
    """Sums over each element and all that it holds; parents come before their children."""
    total = values.astype(float)
    for k in range(len(parents) - 1, 0, -1):
        total[parents[k]] += total[k]
    return total


def _allowed(page: Page, mass: np.ndarray) -> np.ndarray:
    """Elements whose text may be part of the article; ``mass`` is the text that stands right in each."""
    tags, parents, standing, size = page.tags, page.parents, page.standing, len(page.tags)
    own = [t in ("article", "main") and s == 0 for t, s in zip(tags, standing)]
    wraps, never = own[:], [False] * size
    for k in range(1, size):
        never[k] = never[parents[k]] or standing[k] == _GOES
    for k in range(size - 1, 0, -1):
        wraps[parents[k]] = wraps[parents[k]] or (wraps[k] and not never[k])
    held = _below(np.where(never, 0, mass), parents)
    filled = _below(np.where(never, 0, mass > 0), parents)
    gone, inside, header, title = never[:], own[:], [False] * size, [False] * size
    for k in range(1, size):
        up = parents[k]
        frame = wraps[k] or (not wraps[0] and held[k] > FRAME * held[0] and filled[k] > 2)
        gone[k] = gone[k] or gone[up] or (standing[k] == _BESIDE_IT and not frame)
        inside[k] = inside[k] or inside[up]
        header[k] = header[up] or (tags[k] == "header" and not wraps[k])
        title[k] = title[up] or tags[k] in _HEADINGS
    # Of a header the article's own title stays.
    return np.array([not g and (not h or (i and t)) for g, h, i, t in zip(gone, header, inside, title)])


def _levels(path: np.ndarray, plain: np.ndarray, linked: np.ndarray, marks: np.ndarray) -> np.ndarray:
    """Value of each block's path: its ratios fused, smoothed along the blocks, both taken together."""
    _, of = np.unique(path, return_inverse=True)
    blocks, text = np.bincount(of), np.bincount(of, plain)
    per_block, punctuation = text / blocks, np.bincount(of, marks) / blocks
    outside = text / np.maximum(text + np.bincount(of, linked), 1)
    fused = per_block * (1 + punctuation) * outside
    along = fused[of]
    reach = len(_SMOOTH) // 2
    smooth, weight = (np.convolve(v, _SMOOTH)[reach : reach + len(along)] for v in (along, np.ones(len(along))))
    smooth = smooth / weight
    return np.sqrt(fused * np.bincount(of, smooth) / blocks)[of]


def _article(page: Page, held: np.ndarray, allowed: np.ndarray) -> int:
    """The element that is the article."""
    named = [k for k, t in enumerate(page.tags) if t in ("article", "main") and allowed[k] and page.standing[k] == 0]
    if named:
        best = max(named, key=lambda k: (held[k], k))
        if held[best] >= MOST * held[0]:
            # Of nested ones the innermost with most of the text.
            chosen = best
            for k in named:
                up = page.parents[k]
                while up > chosen:
                    up = page.parents[up]
                if up == chosen and k != chosen and page.tags[k] == "article" and held[k] >= MOST * held[chosen]:
                    chosen = k
            return chosen
    chosen = 0
    for k in range(1, len(page.tags)):
        if page.parents[k] == chosen and page.tags[k] not in _TEXTUAL and held[k] >= WHOLE * held[0] and held[0] > 0:
            chosen = k
    return chosen


def article_text(source: str | None) -> str:
    """The main text of one page."""
    page = Page(source or "")
    if not page.texts:
        return ""
    element, plain, linked = np.array(page.elements), np.array(page.plain), np.array(page.linked)
    allowed = _allowed(page, np.bincount(element, plain, len(page.tags)))
    rows = np.flatnonzero(allowed[element])
    if not len(rows):
        return ""
    element, plain, linked = element[rows], plain[rows], linked[rows]
    texts = [page.texts[k] for k in rows.tolist()]
    marks = np.array([len(_PUNCTUATION.findall(t)) for t in texts])
    level = _levels(np.array(page.paths)[element], plain, linked, marks)
    content = level >= SHARE * (level * plain).sum() / max(plain.sum(), 1)
    article = _article(page, _below(np.bincount(element, plain * content, len(page.tags)), page.parents), allowed)
    inside = [k == article for k in range(len(page.tags))]
    for k in range(1, len(inside)):
        inside[k] = inside[k] or inside[page.parents[k]]
    chosen = []
    for k, e in enumerate(element.tolist()):
        kind = page.tags[e]
        wordy = kind in _TEXTUAL or kind in ("article", "main")
        mine = kind in _HEADINGS or content[k] or (wordy and linked[k] < LINKED * (plain[k] + linked[k]))
        chosen.append(inside[e] and bool(mine))
    if page.tags[article] != "article" and any(chosen):
        first = chosen.index(True)
        if page.tags[element[first]] != "h1":
            for k in range(first - 1, max(first - 5, -1), -1):
                if page.tags[element[k]] in ("h1", "h2"):
                    chosen[k] = True
                    break
    return "\n\n".join(t for t, c in zip(texts, chosen) if c)


EXTRACTED = pa.schema([("id", pa.int64()), ("url", pa.string()), ("text", pa.string()), ("n_chars", pa.int64())])


def _extractor(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in source:
        pages = batch.column(2)
        for low, high in W.batches(pages, 4 << 20):
            texts = [article_text(p) for p in pages.slice(low, high - low).to_pylist()]
            part = batch.slice(low, high - low)
            yield pa.record_batch([*part.columns[:2], texts, [len(t) for t in texts]], schema=EXTRACTED)


def extract(pages: DataFrame, id: str = "page_id", url: str = "url", source: str = "html") -> DataFrame:
    """``id, url, text, n_chars`` of every page."""
    rows = picked(pages, id=id, url=url, source=source).withColumn("id", F.col("id").cast("long"))
    return rows.mapInArrow(_extractor, "id long, url string, text string, n_chars long")
