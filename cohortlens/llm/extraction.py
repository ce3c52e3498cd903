"""Main text of web pages by paths on which the pages of a host agree.

1. Each page's containers are scored by the text of the paragraphs in them.
2. The page votes for the path of its best container: tags and classes from
   the page downwards, numbers generalised. Spark counts the votes of a host.
3. Every page is read again, and the elements at the winning path of its host
   give its text; a page that has none there uses its own best container.

Menus, footers, adverts, comments and the like go by tag or by a name that says
nothing else. A name that is also an ordinary word (``notice``, ``form``, ``respond``) is
one vote: such an element goes if its structure says the same (mostly links, form
controls, or a few words only), or if its text stands on most pages of the host.

Votes and repeated texts are counted map-side. The winners are one row per host
and are joined by host, so that Spark broadcasts them only while they are small."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stored
from .markup import BLOCK, RAW, Element, ancestors, parse, path, path_mark

# Elements that never hold main text, and words of classes, ids
# and roles that name menus, headers, footers, sidebars, notices, adverts,
# forms and reader comments.
SKIPPED = RAW | frozenset("""nav footer aside form button select datalist dialog svg math canvas audio video object
    embed head menu input label fieldset""".split())
BOILERPLATE = re.compile(r"""(?<![a-z])(?:
    ad|ads|adv|adverts?|advertisements?|advertising|adsense|adslot|sponsor|sponsors|sponsored|
    nav|navbar|navs|navigation|menu|menus|menubar|breadcrumbs?|pagination|pager|skip-?link|skip-?links|
    masthead|topbar|site-?header|page-?header|footer|footers|site-?footer|page-?footer|colophon|
    sidebar|sidebars|side-?bar|widgets?|complementary|
    cookies?|consent|gdpr|notification|notifications|paywall|popup|popover|modal|
    newsletter|newsletters|subscribe|subscription|subscribe-?box|sign-?up|signin|sign-?in|login|searchbox|search-?box|search-?form|
    comments?|comment-?list|disqus|disqus_thread|
    share-?buttons?|sharing|share-?bar|socials?|social-?links?|related-?posts|related-?articles|related-?stories|more-?stories
    )(?![a-z])""", re.X)
# Names that are ordinary words too: one vote among others.
ALSO_WORDS = re.compile(r"""(?<![a-z])(?:
    banner|banners|promo|promos|promotion|promotions|header|aside|rail|toc|copyright|notice|notices|alert|alerts|overlay|form|forms|
    search|commentary|respond|reply|replies|discussion|share|social|related|recommended|recommendations|trending|tags?|meta|byline|
    header-\S+|skip
    )(?![a-z])""", re.X)
#: Characters of an element with such a name that are too few for prose, and the
#: share of link text in hundredths that makes it a list of links.
FEW, LINKED = 80, 40
_CONTROLS = frozenset("input button select textarea".split())
# Names that tell a state of what they stand on, and names of what readers and notices say.
_STATE = re.compile(r"(?<![^\s])(?:(?:has|with|no|without|is|hide|show)-\S+|\S+-(?:open|closed|enabled|active|layout|page|wrap|wrapper|container))(?![^\s])")
_SAID = re.compile(r"""(?<![a-z])(?:comments?|comment-?list|commentary|disqus\w*|respond|reply|replies|discussion|cookies?|consent|gdpr)(?![a-z])""")
_TALK = re.compile(r"""(?<![a-z])(?:comments?|comment-?list|disqus\w*|cookies?|consent|gdpr)(?![a-z])""")
_FORMS = frozenset("form fieldset".split())
_FORM_NAMES = re.compile(r"(?<![a-z])form(?![a-z])")
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Characters that no longer count further up.
NEGLIGIBLE = 0.5
_SEMANTIC = {"article": 1.5, "main": 1.3}


def host_of(url: Column) -> Column:
    """The host of an address in lower case; empty where there is none."""
    return F.lower(F.coalesce(F.regexp_extract(url, r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1), F.lit("")))


def _weigh(node: Element, linked: bool, sizes: dict[int, int], skipped) -> int:
    """Characters of text below the node outside links, kept per element."""
    total = 0
    linked = linked or node.tag == "a"
    stack = [(node, linked, iter(node.children))]
    counts = [0]
    while stack:
        current, in_link, rest = stack[-1]
        child = next(rest, None)
        if child is None:
            stack.pop()
            done = counts.pop()
            sizes[id(current)] = done
            if counts:
                counts[-1] += done
            else:
                total = done
        elif isinstance(child, str):
            if not in_link:
                counts[-1] += len(child.strip())
        elif not skipped(child):
            stack.append((child, in_link or child.tag == "a", iter(child.children)))
            counts.append(0)
    return total


class Page:
    """A parsed page and what of it counts as boilerplate."""

    def __init__(self, source: str, repeated: frozenset[int] = frozenset()):
        self.root = parse(source)
        #: marks of texts that most pages of the host have
        self.repeated = repeated
        self._named: dict[int, bool] = {}
        #: marks of the texts that only a name speaks against
        self.marks: set[int] = set()
        #: elements around the rest of the page, which stay whatever their tag or name
        self.wraps: set[int] = set()
        self.through = True  # forms are looked through
        forms = self._measure()
        main = self._main()
        self.through = False
        if forms:
            self.wraps -= {id(f) for f in forms}
            self.wraps |= {id(a) for a in (ancestors(main) if main is not None else ()) if a.tag in _FORMS}
            self._measure()

    def _measure(self) -> list[Element]:
        """Weigh the page and note the named wrappers; its forms."""
        self.sizes: dict[int, int] = {}
        self.total = _weigh(self.root, False, self.sizes, self.skipped)
        forms, articles, first = [], [], None
        stack = [(self.root, False)]
        while stack:
            node, said = stack.pop()
            if node.hidden or self.skipped(node) and node.tag not in _FORMS:
                continue
            if node.words and node.tag not in ("html", "body"):
                said = said or bool(_SAID.search(_STATE.sub(" ", node.words)))
            if node.tag in _FORMS:
                forms.append(node)
            elif node.tag == "main":
                for a in ancestors(node):
                    if id(a) in self.wraps:
                        break
                    if a.tag not in _FORMS:
                        self.wraps.add(id(a))
            elif node.tag == "article" and not said:
                articles.append(node)
            elif node.tag == "h1" and first is None:
                first = node
            stack += [(c, said) for c in reversed(node.children) if isinstance(c, Element)]
        for anchor in (max(articles, key=lambda n: self.sizes.get(id(n), 0), default=None), first):
            if anchor is not None:
                self.wraps.update(id(a) for a in ancestors(anchor) if a is not anchor and a.tag not in _FORMS and self._most(a))
        return forms

    def _main(self) -> Element | None:
        """The best container without anything named; if there is none, the best
        one in a named element, whose wrappers then stay."""
        best, _ = self.best()
        if best is None and self.total:
            self.names, self._named = _TALK, {}
            best, _ = self.best()
            self.names, self._named = BOILERPLATE, {}
            if best is not None:
                self.wraps.update(id(a) for a in ancestors(best) if a.tag not in SKIPPED)
        return best

    names = BOILERPLATE

    def _most(self, node: Element) -> bool:
        return 2 * self.sizes.get(id(node), 0) > self.total

    def skipped(self, node: Element) -> bool:
        """Elements that hold no main text by their tag."""
        return node.tag in SKIPPED and not (node.tag in _FORMS and (self.through or id(node) in self.wraps))

    def dropped(self, node: Element) -> bool:
        """Menus and the like, by tag or by name, whatever their size, unless they
        wrap the rest of the page. A state in a name doesn't drop an element with
        most of the page's text."""
        if node.hidden or self.skipped(node):
            return True
        if node.tag in ("html", "body", "article", "main") or id(node) in self.wraps:
            return False
        if node.tag == "header":
            return self.names is BOILERPLATE
        if not node.words:
            return False
        if id(node) not in self._named:
            self._named[id(node)] = self._by_name(node)
        return self._named[id(node)]

    def _by_name(self, node: Element) -> bool:
        words = _FORM_NAMES.sub(" ", node.words) if node.tag in _FORMS else node.words
        if self.names.search(words):
            return not self._most(node) or bool(self.names.search(_STATE.sub(" ", words)))
        return self.names is BOILERPLATE and bool(ALSO_WORDS.search(words)) and not self._most(node) and self._agrees(node)

    def _agrees(self, node: Element) -> bool:
        """Whether the structure of an element, or the host's other pages, say what
        its name may mean."""
        chars, links, controls, text = 0, 0, False, []
        stack: list[tuple[object, bool]] = [(node, False)]
        while stack:
            item, linked = stack.pop()
            if isinstance(item, str):
                size = len(item.strip())
                chars += size
                links += size if linked else 0
                text.append(item)
            else:
                controls = controls or item.tag in _CONTROLS
                if item.tag not in RAW:
                    stack += [(c, linked or item.tag == "a") for c in reversed(item.children)]
        if controls or chars < FEW or 100 * links >= LINKED * chars:
            return True
        mark = text_mark(text)
        self.marks.add(mark)
        return mark in self.repeated

    def elements(self, top: Element) -> Iterator[Element]:
        """Elements below ``top`` in page order, without those dropped."""
        stack = [c for c in reversed(top.children) if isinstance(c, Element)]
        while stack:
            node = stack.pop()
            if not self.dropped(node):
                yield node
                stack += [c for c in reversed(node.children) if isinstance(c, Element)]

    def best(self) -> tuple[Element | None, float]:
        """The container with the highest score. A paragraph's characters count
        for its parent, by half for the next one above, and so on."""
        scores: dict[int, tuple[float, Element]] = {}
        for node in (self.root, *self.elements(self.root)):
            own = sum(len(c.strip()) if isinstance(c, str) else 0 if c.tag in BLOCK or self.dropped(c) else self.sizes.get(id(c), 0)
                      for c in node.children)
            if not own or node.tag not in BLOCK and node is not self.root:
                continue
            share, above = float(own), iter([*ancestors(node), self.root] if node is not self.root else [node])
            if node.tag in ("p", "li", "blockquote", "pre", "dd", "figcaption") or node.tag in _HEADINGS:
                next(above)
            for a in above:
                if a.tag in BLOCK or a is self.root:
                    scores[id(a)] = (scores.get(id(a), (0.0,))[0] + share, a)
                    share /= 2
                    if share < NEGLIGIBLE:
                        break
        best, most = None, 0.0
        for score, node in scores.values():
            score *= _SEMANTIC.get(node.tag, 0.5 if node.tag in ("#page", "html", "body", "li", "ul", "ol") else 1.0)
            if score > most:
                best, most = node, score
        return best, most

    def at(self, wanted: str) -> list[Element]:
        """Outermost elements at a path, in page order."""
        mark, found = path_mark(wanted), []
        stack = [c for c in reversed(self.root.children) if isinstance(c, Element)]
        while stack:
            node = stack.pop()
            if self.dropped(node):
                continue
            if node.mark == mark and path(node) == wanted:
                found.append(node)
            else:
                stack += [c for c in reversed(node.children) if isinstance(c, Element)]
        return found

    def text(self, top: Element) -> list[str]:
        """Blocks of text below ``top``."""
        blocks: list[str] = []
        line: list[str] = []

        def end():
            if line:
                block = " ".join("".join(line).split())
                if block:
                    blocks.append(block)
                line.clear()

        stack: list[object] = [(top, False)]
        while stack:
            item = stack.pop()
            if item is None:
                end()
            elif isinstance(item, str):
                line.append(item)
            else:
                node, headings_only = item
                if node.tag in BLOCK:
                    end()
                    stack.append(None)
                elif node.tag == "br":
                    line.append(" ")
                for child in reversed(node.children):
                    if isinstance(child, str):
                        if not headings_only or node.tag in _HEADINGS:
                            stack.append(child)
                    elif child.tag == "header":  # an article's own: its title stays
                        stack.append((child, True))
                    elif not self.dropped(child):
                        stack.append((child, headings_only and child.tag not in _HEADINGS and node.tag not in _HEADINGS))
        end()
        return blocks


def text_mark(parts: list[str]) -> int:
    """A number for a text, white space aside."""
    return int.from_bytes(hashlib.blake2b(" ".join("".join(parts).split()).encode(), digest_size=8).digest(), "big", signed=True)


def main_text(source: str | None, wanted: str | None, repeated: frozenset[int] = frozenset()) -> str:
    """Text of a page at the wanted path, or of its best container."""
    page = Page(source or "", repeated)
    blocks = [b for node in (page.at(wanted) if wanted else []) for b in page.text(node)]
    if not blocks:
        best, _ = page.best()
        blocks = page.text(best) if best is not None else []
    return "\n".join(blocks)


def votes(pages: DataFrame) -> DataFrame:
    """``host, path, score, mark``: each page's vote (a null path without any text),
    and a row with a mark for each text that only its name speaks against."""
    def run(batches):
        for b in batches:
            out = []
            for host, source in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                page = Page(source or "")
                node, score = page.best()
                out.append((host, path(node) if node is not None and node.parent is not None else None, score, None))
                out += [(host, None, 0.0, m) for m in page.marks]
            columns = list(zip(*out, strict=True)) or [(), (), (), ()]
            kinds = (pa.string(), pa.string(), pa.float64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["host", "path", "score", "mark"])

    return pages.select("host", "html").mapInArrow(run, "host string, path string, score double, mark long")


def host_rules(pages: DataFrame) -> DataFrame:
    """``host, path, repeated``: the path with most votes (then score, then its
    name), and the marks of texts that more than half of the host's pages have (of
    three pages at least): no more than twice those of an average page."""
    # one row per host, path and mark, counted map-side
    counted = stored(votes(pages).groupBy("host", "path", "mark").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("score")).alias("score")), "host-votes")
    best = counted.where("path IS NOT NULL").groupBy("host").agg(F.max(F.struct("n", "score", "path")).alias("best"))
    sizes = counted.where("mark IS NULL").groupBy("host").agg(F.sum("n").alias("pages")).where("pages >= 3")
    often = counted.where("mark IS NOT NULL").join(sizes, "host").where("2 * n > pages").groupBy("host").agg(F.collect_list("mark").alias("repeated"))
    return stored(best.join(often, "host", "full").select("host", F.col("best.path").alias("path"), "repeated"), "host-rules")


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row per page: ``page_id, url, text``.

    A null or empty page, and one without any text, gives an empty text. Pages
    without a readable address vote together. Repeated rows are extracted each
    for itself (their votes count as often); an empty table gives an empty
    result; further columns are ignored."""
    pages = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"),
                         F.col(html_col).alias("html")).withColumn("host", host_of(F.col("url")))
    chosen = pages.join(host_rules(pages), "host", "left").select("page_id", "url", "html", "path", "repeated")

    def run(batches):
        for b in batches:
            rows = zip(*(b.column(c).to_pylist() for c in ("html", "path", "repeated")), strict=True)
            texts = [main_text(s, p, frozenset(r or ())) for s, p, r in rows]
            yield pa.RecordBatch.from_arrays([b.column("page_id"), b.column("url"), pa.array(texts, pa.string())], ["page_id", "url", "text"])

    return chosen.mapInArrow(run, "page_id long, url string, text string")
