"""Main text of web pages: containers are scored per page, hosts vote on their paths, pages are extracted by the winner."""

from __future__ import annotations

import functools
import html
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vecframe.llm.common import batch_of, modest_batches, small_side, stored

# Element names by their role in HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript template iframe svg math object canvas select option button head".split())
BLOCK = frozenset("address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr html li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split())
#: Elements that are noise by their tag, but for a form that holds the page.
NOISE = frozenset("nav footer aside menu dialog".split())
#: A container must be one of these to be voted for.
CONTAINER = frozenset("article main section div td body blockquote center".split())
#: Words of class, id and role that mark what is not the article.
NOISE_WORD = re.compile(
    r"(?:^|[\s_-])(?:ads?|advert\w*|adsense|sponsor\w*|banner|popup|modal|overlay|newsletter|subscribe|sidebar|side-?bar|rail|widget|menu|nav|navbar|navigation|topbar|breadcrumbs?|pagination|pager|toolbar"
    r"|footer|masthead|site-?header|page-?header|respond|share|sharing|more-?stories|login|signup|complementary|contentinfo|skip-?link|copyright)(?:$|[\s_-])"
)
#: Words of parts that are not the article, however long they are, if there is another one.
FOREIGN_WORD = re.compile(r"(?:^|[\s_-])(?:cookies?|consent|gdpr|comments?|commentlist|comment-?\w*|disqus|replies)(?:$|[\s_-])")
#: Words that inside an article mark what is not part of it only if it is links for the most part; the first group also if it is a small part.
LINKS_WORD = re.compile(r"(?:^|[\s_-])(?:(promo\w*|notices?|alert)|social|related|recommend\w*|search|legal)(?:$|[\s_-])")
#: Forms that tell the layout or state of what is around: no-sidebar, has-ads, with-menu, ad-free, comments-open.
LAYOUT = re.compile(r"(?:^|(?<=[\s_-]))(?:no|non|has|have|with|without)[_-]\S*|[^\s_-]+[_-](?:free|open|closed|enabled|disabled)(?=$|[\s_-])")
SHARE = 0.6
NEARLY = 0.9
#: A notice or advert in an article is less than this share of it.
ASIDE = 0.05
#: A page's own container is taken if the host's path holds less than this share of what that has.
TEASER = 0.05
HEADING = frozenset("h1 h2 h3 h4 h5 h6".split())
TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|<[!?][^>]*>", re.S)
ATTRIBUTE = re.compile(r"(?:^|\s)(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)


@dataclass
class Element:
    tag: str
    path: int  # see Page.paths
    parent: int
    kind: str  # of noise, see Page._mark_noise
    inside: bool  # of an article or main element, or one itself
    noise: bool = False  # itself or by an element around it
    blocks: list[int] = field(default_factory=list)


@functools.lru_cache(4096)
def kind_of(words: str) -> str:
    """What values of class, id and role say of an element."""
    words = LAYOUT.sub("", words)
    links = LINKS_WORD.search(words)
    return "foreign" if FOREIGN_WORD.search(words) else "word" if NOISE_WORD.search(words) else "" if not links else "notice" if links[1] else "links"


class Page:
    """Elements and text blocks of a page. A block knows the element that holds it, and how much of it is links.

    ``blocks`` are those without noise. All text is kept in ``runs`` of (element, text, whether in a link) until the whole
    page is read, since only then it is known what is noise. ``paths`` are the number of the path above, the last part, and how many
    parts there are; ``steps`` finds the number of a path by these, so that a page is read in time and space that grow with its length.
    """

    def __init__(self, source: str):
        self.paths: list[tuple[int, str, int]] = [(-1, "", 0)]
        self.steps: dict[tuple[int, str], int] = {}
        self.elements = [Element("", 0, -1, "", False)]
        self.runs: list[tuple[int, list[tuple[int, str, bool]]]] = []
        self._stack, self._parts, self._opened = [0], [], Counter()
        at, endless = 0, set()
        for match in TOKEN.finditer(source):
            if match.start() < at:
                continue
            if match.start() > at:
                self._text(source[at : match.start()])
            at = match.end()
            tag = match[2]
            if tag is None:
                continue
            tag = tag.lower()
            if match[1]:
                self._close(tag)
            elif tag in RAW:
                end = None if tag in endless else re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(source, at)
                if not end:
                    endless.add(tag)
                # A raw element that is never closed ends with its own tag, so that it swallows nothing.
                at = end.end() if end else at
                if tag in BLOCK:
                    self._flush()
            else:
                self._open(tag, match[3], match[3].endswith("/"))
        self._text(source[at:])
        self._flush()
        self._mark_noise()
        self.blocks: list[tuple[int, str, int]] = []
        for holder, parts in self.runs:
            parts = [part for part in parts if not self.elements[part[0]].noise]
            text = " ".join("".join(part[1] for part in parts).split())
            if text:
                self.blocks.append((holder, text, min(sum(len(part[1]) for part in parts if part[2]), len(text))))

    def _text(self, text: str) -> None:
        self._parts.append((self._stack[-1], html.unescape(text), self._opened["a"] > 0))

    def _flush(self) -> None:
        if self._parts:
            holder = next(i for i in reversed(self._stack) if i == 0 or self.elements[i].tag in BLOCK)
            self.runs.append((holder, self._parts))
            self._parts = []

    def _mark_noise(self) -> None:
        """Settles which elements are noise.

        Elements of a kind may be: "tag" and "word" by these, "foreign" by words of what is not the article unless nothing else is (see ``_rescue``), "links"
        by words that count in an article only if half of the text is links, "notice" by those that count there also if it is a small part. What holds a main element is none. A "word" is none
        if its articles have more text than those outside of such elements, and are one or more than half of the page; a
        "tag" only if there are no others and it is more than half of the page. Nor is a "word" with more than half of the
        page, in an article or if there is none outside. Text is that outside links.
        """
        elements = self.elements
        if not any(e.kind for e in elements):
            return
        own, linked = [0] * len(elements), [0] * len(elements)
        for _, parts in self.runs:
            for i, text, link in parts:
                (linked if link else own)[i] += len(text.strip())
        plain, links = own.copy(), linked.copy()
        for i in range(len(elements) - 1, 0, -1):
            plain[elements[i].parent] += plain[i]
            links[elements[i].parent] += links[i]
        outer = list(range(len(elements)))  # the outermost article or main element around each
        for i, e in enumerate(elements[1:], 1):
            outer[i] = outer[e.parent] if elements[e.parent].inside else i
        for i, e in enumerate(elements):
            if e.kind in ("links", "notice"):
                small = e.kind == "notice" and plain[i] < ASIDE * plain[outer[i]]
                e.kind = "word" if not elements[e.parent].inside or links[i] >= plain[i] or small else ""
        self._rescue(own, plain)
        # Of each element: text, whether it holds a main element, number and text of the outermost articles.
        size, main, count, article = own.copy(), [False] * len(elements), [0] * len(elements), [0] * len(elements)
        for i in range(len(elements) - 1, 0, -1):
            e = elements[i]
            if e.tag == "article":
                count[i], article[i] = int(size[i] > 0), size[i]
            main[i] |= e.tag == "main" and size[i] > 0
            if not main[i] and (e.kind == "foreign" or e.kind == "tag" and not count[i]):
                continue
            size[e.parent] += size[i]
            main[e.parent] |= main[i]
            count[e.parent] += count[i]
            article[e.parent] += article[i]
        clean, outside = [True] * len(elements), 0
        for i, e in enumerate(elements[1:], 1):
            clean[i] = clean[e.parent] and not e.kind
            outside += own[i] if clean[i] and e.inside else 0
        for i, e in enumerate(elements[1:], 1):
            most = 2 * size[i] > size[0]
            holds = main[i] or bool(count[i]) and (e.kind == "word" and article[i] > outside and (most or count[i] == 1) or e.kind == "tag" and most and not outside)
            whole = e.kind == "word" and most and (elements[e.parent].inside or not outside)
            e.noise = elements[e.parent].noise or bool(e.kind) and not holds and not whole

    def _rescue(self, own: list[int], plain: list[int]) -> None:
        """Foreign elements that are the article after all lose their kind.

        Such a one is the outermost of its kind, and nothing but headings has text outside of it and of noise; or it holds an h1 and
        more than half of the page's text, and no article or main element has text outside. So do those within it that hold all of its text.
        """
        elements = self.elements
        if not any(e.kind == "foreign" for e in elements):
            return
        clean, heading, titled = [True] * len(elements), [False] * len(elements), [False] * len(elements)
        rest = articles = 0
        for i, e in enumerate(elements[1:], 1):
            clean[i] = clean[e.parent] and not e.kind
            heading[i] = heading[e.parent] or e.tag in HEADING
            rest += own[i] if clean[i] and not heading[i] else 0
            articles += own[i] if clean[i] and e.inside else 0
        rest += own[0]
        for i in range(len(elements) - 1, 0, -1):
            titled[i] |= elements[i].tag == "h1" and plain[i] > 0
            titled[elements[i].parent] |= titled[i]
        whole = {0: plain[0]}  # of rescued elements, their text
        for i, e in enumerate(elements[1:], 1):
            if e.kind == "foreign" and plain[i]:
                first = clean[e.parent] and (not rest or titled[i] and not articles and 2 * plain[i] > plain[0])
                if first or whole.get(e.parent) == plain[i] and e.parent:
                    e.kind, whole[i] = "", plain[i]
            elif e.parent and whole.get(e.parent) == plain[i]:
                whole[i] = plain[i]

    def _open(self, tag: str, attributes: str, closed: bool) -> None:
        if tag in VOID:
            if tag == "br":
                self._text(" ")
            elif tag == "hr":
                self._flush()
            return
        if tag in BLOCK:
            self._flush()
            if self._opened["p"]:
                self._pop_to("p")
            if tag in ("li", "dt", "dd", "tr", "td", "th"):
                self._pop_sibling(tag)
        if closed:
            return
        parent = self.elements[self._stack[-1]]
        named = {m[1].lower(): next(g for g in m.groups()[1:] if g is not None) for m in ATTRIBUTE.finditer(attributes)} if attributes else {}
        words = " ".join(named.values()).lower()
        inside = parent.inside or tag in ("article", "main")
        kind = "tag" if tag in NOISE or tag == "header" and not parent.inside else kind_of(words) if words and tag not in ("body", "html", "article", "main") else ""
        kind = "word" if tag == "form" and kind != "foreign" else kind
        classes = ".".join(sorted(re.sub(r"\d+|>", "#", named.get("class", "").lower()).split()))
        path = parent.path
        if tag in BLOCK:
            step = (path, f"{tag}.{classes}" if classes else tag)
            path = self.steps.setdefault(step, len(self.paths))
            if path == len(self.paths):
                self.paths.append((*step, self.paths[step[0]][2] + 1))
        self._stack.append(len(self.elements))
        self.elements.append(Element(tag, path, self._stack[-2], kind, inside))
        self._opened[tag] += 1

    def _close(self, tag: str) -> None:
        if tag in BLOCK:
            self._flush()
        if self._opened[tag]:
            self._pop_to(tag)

    def _pop_to(self, tag: str) -> None:
        while len(self._stack) > 1:
            top = self.elements[self._stack.pop()].tag
            self._opened[top] -= 1
            if top == tag:
                return

    def _pop_sibling(self, tag: str) -> None:
        ends = {"li": ("ul", "ol", "menu"), "dt": ("dl",), "dd": ("dl",)}.get(tag, ("table", "tbody", "thead", "tfoot") if tag == "tr" else ("tr", "table"))
        same = {"dt": ("dt", "dd"), "dd": ("dt", "dd"), "td": ("td", "th"), "th": ("td", "th")}.get(tag, (tag,))
        if not any(self._opened[t] for t in same):
            return
        for i in reversed(self._stack):
            if self.elements[i].tag in ends:
                return
            if self.elements[i].tag in same:
                self._pop_to(self.elements[i].tag)
                return

    def best(self) -> int:
        """The container of the main text; the page itself if there is none.

        From the deepest container with a SHARE of the page's text outside links to every one around it that adds such
        text, as far as the article, or the main element, that all of it is in. Around an article, a main element is
        taken only for blocks of its own, such as a headline, or if less than NEARLY all were without it; around others, a body.
        """
        score, own, nearest = self._scores(), [0] * len(self.elements), list(range(len(self.elements)))
        for i, e in enumerate(self.elements[1:], 1):
            nearest[i] = i if e.tag in CONTAINER else nearest[e.parent]
        for holder, text, linked in self.blocks:
            own[nearest[holder]] += len(text) - linked
        found = [i for i, e in enumerate(self.elements) if e.tag in CONTAINER and score[i] > 0 and score[i] >= SHARE * score[0]]
        if not found:
            return 0
        best = max(found, key=lambda i: (self.paths[self.elements[i].path][2], i))
        around, at = [], best
        while at >= 0 and self.elements[at].tag != "body":
            around.append(at)
            at = self.elements[at].parent
        outer = [i for i in around if self.elements[i].tag == "article"]
        mains = [i for i in around if self.elements[i].tag == "main"]
        if outer:
            best = outer[-1]
            return next((i for i in mains if i < best and (own[i] or score[best] < NEARLY * score[i])), best)
        if mains:
            return mains[-1]
        for i in around:
            if i and self.elements[i].tag in CONTAINER and score[i] > score[best]:
                best = i
        page = max(at, 0)
        return page if score[page] > score[best] and (own[page] or score[best] < NEARLY * score[page]) else best

    def _scores(self) -> list[int]:
        """Text outside links in each element."""
        score = [0] * len(self.elements)
        for holder, text, linked in self.blocks:
            score[holder] += len(text) - linked
        for i in range(len(self.elements) - 1, 0, -1):
            score[self.elements[i].parent] += score[i]
        return score

    def path_of(self, i: int) -> str:
        parts, at = [], self.elements[i].path
        while at:
            parts.append(self.paths[at][1])
            at = self.paths[at][0]
        return "".join(f">{part}" for part in reversed(parts))

    def _held(self, roots: set[int]) -> list[bool]:
        held = [False] * len(self.elements)
        for i, e in enumerate(self.elements):
            held[i] = i in roots or e.parent >= 0 and held[e.parent]
        return held

    def text(self, path: str | None) -> str:
        """Blocks, in order, of the elements with that path; of the page's own best container without one, or if it has less than TEASER of that one's text."""
        number = 0
        for part in path.split(">")[1:] if path else []:
            number = self.steps.get((number, part), -1)
        roots = {i for i, e in enumerate(self.elements) if i and e.tag in BLOCK and e.path == number} if number > 0 else set()
        own = self.best()
        held = self._held(roots or {own})
        if roots and not roots == {own}:
            there = sum(len(text) - linked for holder, text, linked in self.blocks if held[holder])
            held = self._held({own}) if there < TEASER * self._scores()[own] else held
        return "\n".join(text for holder, text, _ in self.blocks if held[holder])


def host_of(url):
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]+)", 1))


def extract_main_text(pages: DataFrame, *, key: str = "page_id", url: str = "url", source: str = "html") -> DataFrame:
    """One row (key, url, host, path, text) per page.

    A page's containers are scored by the text they hold outside links; the page's vote is the deepest one with most of
    it, widened as far as its article or main element, or by whatever around it has more such text (see ``Page.best``). Paths are tags with their classes, numbers made alike. A host's path is the one with most votes
    (ties: the first by code point). Pages are read again by that path; a page without it, or with next to nothing there, by its own best container.
    Elements for menus, page headers, footers, sidebars, notices, adverts, forms, comments, scripts and styles do not count, by
    tag, class, id and role, unless the article is in them or they are most of the page (see ``Page._mark_noise``). Character references are decoded, white space within a block is one space, blocks are lines. Formulas as ``math`` elements are markup and go.

    A null html is empty, an empty one has the text ''. A null or odd url has the host ''. Rows with equal keys are
    pages of their own. An empty table gives no rows. Other columns are not read.
    """
    modest_batches(pages.sparkSession)
    rows = pages.select(F.col(key).alias("id"), F.col(url).alias("url"), host_of(F.col(url)).alias("host"), F.coalesce(F.col(source), F.lit("")).alias("html"))
    votes = rows.select("host", "html").mapInArrow(_votes, "host string, path string").groupBy("host", "path").agg(F.count("*").alias("votes"))
    winners = votes.groupBy("host").agg(F.min(F.struct((-F.col("votes")).alias("votes"), "path")).alias("best")).select(F.col("host").alias("of"), "best.path")
    chosen = rows.join(small_side(stored(winners, "main-text-paths"), 200), rows.host == F.col("of"), "left").select("id", "url", "host", "path", "html")
    return chosen.mapInArrow(_texts, f"{key} {dict(pages.dtypes)[key]}, url string, host string, path string, text string")


def _votes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("host", pa.string()), ("path", pa.string())])
    for batch in batches:
        voted = [(host, page.path_of(best)) for host, source in zip(batch.column("host").to_pylist(), batch.column("html").to_pylist(), strict=True) if (best := (page := Page(source)).best())]
        yield batch_of(schema, [h for h, _ in voted], [p for _, p in voted])


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [Page(source).text(path) for source, path in zip(batch.column("html").to_pylist(), batch.column("path").to_pylist(), strict=True)]
        yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(4)), pa.array(texts, pa.string())], names=[*(batch.schema.names[:4]), "text"])
