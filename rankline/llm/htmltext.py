"""Main text of pages, with site template removal.

Element subtrees are hashed per page and counted per host in Spark. Subtrees that recur on many pages of
their host are template: they do not count when the main element is chosen, and are deleted inside it.
"""

from __future__ import annotations

import html as entities
import re

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored, table

SALTS = 8
MIN_PAGES = 5
MIN_SHARE = 0.5

# Fixed lists of HTML element names.
QUIET = set("script style noscript template svg input button select option wbr area param source track".split())  # no block ends at these
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style textarea title noscript template iframe xmp".split())
INLINE = set("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q ruby rb rp rt s samp small span strike strong sub sup time tt u var wbr img".split())
CLOSED_BY = {  # an open element of the first kind ends where one of the second kind starts
    "p": set("address article aside blockquote div dl fieldset footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p pre section table ul li td th tr dt dd figure".split()),
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "td": {"td", "th", "tr", "tbody", "tfoot"}, "th": {"td", "th", "tr", "tbody", "tfoot"},
    "tr": {"tr", "tbody", "tfoot"}, "option": {"option", "optgroup"}, "head": {"body"},
}
SCOPE = {"li": {"ul", "ol", "menu"}, "td": {"table"}, "th": {"table"}, "tr": {"table"}, "dt": {"dl"}, "dd": {"dl"}}
CONTAINERS = set("div section nav header footer aside form ul ol dl table center details figure menu".split())
# Elements that never hold main text, and words in class, id or role that mark such a part.
NEVER = set("head nav header footer aside form button select option datalist input svg canvas dialog menu object audio video map fieldset".split()) | RAW
WRAPPERS = set("form fieldset header".split())  # these may stand around a whole page
# A name with one of these as its first or last word marks a part, unless it says that there is none.
STRONG = set(
    "comment comments commentlist disqus respond replies sidebar sidenav cookie cookies consent gdpr newsletter breadcrumb breadcrumbs advert adverts advertisement advertising "
    "adsense ads sponsor sponsored sponsors pagination navbar masthead popup modal overlay paywall toolbar topbar".split()
)
# These mark a part if the name has no other words but these, the ones above, and words of place and shape.
WEAK = set(
    "ad adv promo promos promotion promoted banner navigation nav menu menus header footer aside rail notice notices notification alert subscribe subscription signup login share "
    "sharing social related recommended recommendations trending widget widgets pager paging skip copyright disclaimer contentinfo complementary search searchbox form reply".split()
)
SHAPES = set(
    "site page global main top bottom left right inner outer box block list item items bar area region wrap wrapper container section panel link links button buttons icon icons "
    "group slot unit zone frame holder posts stories primary secondary sticky fixed mobile desktop small large big mini user col column row".split()
)
DENIALS = set("no not non with without has have hide show js".split())
REMARKS = {"comment", "comments", "commentlist", "disqus", "respond", "reply", "replies"}
TEASERS = REMARKS | {"related", "teaser", "ad", "advert", "promo"}
DEPTH = 512  # open elements; deeper ones are leaves, as in browsers
WHOLE = 0.8  # of a page's text: a marked wrapper with so much is the page
FEW = 0.25  # articles with less of the clean text than this are not what the page is about

_OPEN = re.compile(r"""=\s*(["'])|>""")
_NAME = re.compile(r"[a-zA-Z][^\s/>]*")
_NAMED = re.compile(r"""(?<![\w-])(class|id|role|itemprop|hidden|aria-hidden|style)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""", re.I)
_WORD = re.compile(r"[a-z0-9]+")


def marks(names: str) -> set[str]:
    """The marking words among the names of a class, id or role attribute."""
    out = set()
    for name in names.split():
        words = _WORD.findall(name)
        if not words or words[0] in DENIALS:
            continue
        out |= {w for w in (words[0], words[-1]) if w in STRONG}
        if all(w in WEAK or w in STRONG or w in SHAPES or w.isdigit() for w in words):
            out |= {w for w in words if w in WEAK}
    return out


class Page:
    """Elements of one page in order (parents first), its text in blocks of (element, text) pieces, and a hash of every element.

    One scan from left to right: raw elements (scripts and the like) are skipped as they come, so nothing in them is markup; comments end at
    ``-->``, or where there is none at the next ``>``; what looks like a tag and never ends is text.
    """

    __slots__ = ("source", "tags", "parents", "contents", "bad", "wrapper", "remark", "teaser", "main", "blocks", "_lower", "_missing")

    def __init__(self, source: str):
        self.source, self._lower, self._missing = source, None, set()
        self.tags, self.parents, self.contents, self.bad, self.wrapper, self.remark, self.teaser, self.main = ["html"], [-1], [["html"]], [False], [False], [False], [False], [False]
        self.blocks: list[list[tuple[int, str]]] = []
        self._scan()

    def _find(self, text: str, at: int, key: str | None = None) -> int:
        """Place of ``text`` from ``at`` on, -1 if there is none; what is missing once is missing for the rest."""
        if text in self._missing:
            return -1
        place = self.source.find(text, at)
        if place < 0:
            self._missing.add(text)
        return place

    def _tag_end(self, at: int) -> int:
        """Place after the ``>`` that ends a tag; quoted values may hold others. -1 if it does not end."""
        first = self._find(">", at)
        if first < 0:
            return -1
        while found := _OPEN.search(self.source, at):
            if not found[1]:
                return found.end()
            close = self._find(found[1], found.end()) if found[1] not in self._missing else -1
            if close < 0:
                return first + 1
            at = close + 1
        return first + 1

    def _raw_end(self, name: str, at: int) -> int:
        """Place of the end tag of a raw element, -1 if there is none."""
        if self._lower is None:
            self._lower = self.source.lower()
            if len(self._lower) != len(self.source):  # lower-casing changed the length of some character
                self._lower = re.sub("[A-Z]", lambda m: chr(ord(m[0]) + 32), self.source)
        if f"</{name}" in self._missing:
            return -1
        place = self._lower.find(f"</{name}", at)
        if place < 0:
            self._missing.add(f"</{name}")
        return place

    def _scan(self) -> None:
        source, stack, block, at, size = self.source, [0], [], 0, len(self.source)
        open_names: dict[str, int] = {}
        blocked: set[str] = set()  # inline names whose end tag meets a block first, as long as the open elements stay

        def close(depth: int) -> None:
            blocked.clear()
            while len(stack) > depth:
                open_names[self.tags[stack.pop()]] -= 1

        def text(piece: str) -> None:
            block.append((stack[-1], piece))
            self.contents[stack[-1]].append(piece)

        while at < size:
            begin = self._find("<", at)
            if begin < 0:
                text(source[at:])
                break
            if begin > at:
                text(source[at:begin])
            after = source[begin + 1:begin + 2]
            if after == "!" or after == "?":
                at = begin + 2
                if source.startswith("<!--", begin):
                    if source.startswith((">", "->"), begin + 4):
                        at = source.index(">", begin + 4) + 1
                        continue
                    end = self._find("-->", begin + 4)
                    if end >= 0:
                        at = end + 3
                        continue
                elif source.startswith("<![CDATA[", begin):
                    end = self._find("]]>", begin)
                    if end >= 0:
                        text(entities.escape(source[begin + 9:end]))
                        at = end + 3
                        continue
                end = self._find(">", at)
                if end < 0:
                    text(source[begin:])
                    break
                at = end + 1
                continue
            ending = after == "/"
            found = _NAME.match(source, begin + 1 + ending)
            if not found:
                text("<")
                at = begin + 1
                continue
            at = self._tag_end(found.end())
            if at < 0:
                text(source[begin:])
                break
            name, attributes = found[0].lower(), source[found.end():at - 1]
            if name not in INLINE and name not in QUIET and block:
                self.blocks.append(block)
                block = []
            if ending:
                if not open_names.get(name) or name in blocked:
                    continue
                depth = len(stack) - 1
                while depth and self.tags[stack[depth]] != name:
                    if name in INLINE and self.tags[stack[depth]] not in INLINE:
                        depth = 0  # an inline end tag does not close the blocks around it
                        break
                    depth -= 1
                if depth:
                    close(depth)
                else:
                    blocked.add(name)
                continue
            if name in ("html", "body") and not attributes.strip():
                if name == "body" and len(stack) > 1 and self.tags[stack[1]] == "head":
                    close(1)
                if name == "html":
                    continue
            depth = len(stack) - 1
            while depth and name not in INLINE:
                open_tag = self.tags[stack[depth]]
                if name in CLOSED_BY.get(open_tag, ()):
                    close(depth)
                    break
                if open_tag in SCOPE.get(name, ()) or (open_tag not in INLINE and name not in SCOPE):
                    break
                depth -= 1
            here = self._element(name, attributes, stack[-1])
            if name in VOID or attributes.endswith("/") and name not in ("p", "div", "span", "a"):
                continue
            if name in RAW:
                stop = self._raw_end(name, at)
                if stop >= 0:
                    end = source.find(">", stop)
                    end = end + 1 if end >= 0 else size
                elif name in ("script", "style"):
                    end = size
                else:  # without an end, what follows is the page
                    continue
                self.contents[here].append(source[at:end])
                at = end
                continue
            if len(stack) < DEPTH:
                stack.append(here)
                blocked.clear()
                open_names[name] = open_names.get(name, 0) + 1
        if block:
            self.blocks.append(block)

    def _element(self, name: str, attributes: str, parent: int) -> int:
        found, hidden, itemprop, names = set(), False, "", ""
        if attributes and ("=" in attributes or "hidden" in attributes):
            values = {m[1].lower(): (m[2] or "").strip("\"'").lower() for m in _NAMED.finditer(attributes)}
            if values:
                names = " ".join(values.get(k, "") for k in ("class", "id", "role"))
                found = marks(names)
                hidden = "hidden" in values or values.get("aria-hidden") == "true" or "display:none" in values.get("style", "").replace(" ", "")
                itemprop = values.get("itemprop", "")
        here = len(self.tags)
        root = name in ("html", "body", "main")
        words = set(_WORD.findall(names)) if name == "article" else ()
        teaser = name == "article" and bool(TEASERS & set(words))
        self.tags.append(name)
        self.parents.append(parent)
        self.contents.append([name, " ".join(attributes.split())])
        self.contents[parent].append(here)
        marked = (bool(found) or teaser) if name == "article" else bool(found) and not root
        self.bad.append(name in NEVER or hidden or marked)
        self.remark.append(bool(found & REMARKS) or hidden)
        self.teaser.append(teaser)
        self.wrapper.append((name in WRAPPERS or marked and name in CONTAINERS and name not in NEVER) and not found & REMARKS and not hidden)
        self.main.append(name == "main" or itemprop == "articlebody" or name in CONTAINERS and "main" in names.split())
        return here

    def subtrees(self) -> dict[int, int]:
        """Signed hash of every container element with something in it: its tag, attributes, texts and the hashes of the elements in it."""
        digests: list[int] = [0] * len(self.tags)
        for i in range(len(self.tags) - 1, -1, -1):
            parts = [f"\0{digests[p]:x}" if isinstance(p, int) else " ".join(p.split()) for p in self.contents[i]]
            digests[i] = xxhash.xxh3_64_intdigest("\1".join(parts))
        held = lambda i: any(isinstance(p, int) or p.strip() for p in self.contents[i][2:])
        return {i: d - (1 << 64) if d >> 63 else d for i, d in enumerate(digests) if self.tags[i] in CONTAINERS and held(i)}

    def text(self, template: set[int]) -> str:
        """Main text: blocks of the main elements, without what is marked, never text, or template."""
        count = len(self.tags)
        total = [0] * count
        raw = [False] * count
        for i in range(1, count):
            raw[i] = raw[self.parents[i]] or self.tags[i] in RAW
        for block in self.blocks:
            for i, text in block:
                if not raw[i]:
                    total[i] += len(text.strip())
        holds = [False] * count  # an article or main element that is no remark
        for i in range(count - 1, 0, -1):
            parent = self.parents[i]
            total[parent] += total[i]
            holds[parent] |= not self.remark[i] and (holds[i] or self.main[i] or self.tags[i] == "article" and not self.teaser[i])
        cut = [b and not (w and (h or t >= WHOLE * total[0] > 0)) for b, w, h, t in zip(self.bad, self.wrapper, holds, total, strict=True)]
        if template:
            for i, value in self.subtrees().items():
                cut[i] |= value in template
        clean = [False] * count  # nothing cut on the way from the root
        for i, parent in enumerate(self.parents):
            clean[i] = not cut[i] and (parent < 0 or clean[parent])
        fair = [0] * count
        for block in self.blocks:
            for i, text in block:
                fair[i] += len(text.strip()) if clean[i] else 0
        for i in range(count - 1, 0, -1):
            fair[self.parents[i]] += fair[i]
        inside = [False] * count
        for i in self._regions(clean, total, fair):
            inside[i] = True
        for i in range(1, count):
            inside[i] = inside[i] or inside[self.parents[i]] and not cut[i]
        lines = []
        for block in self.blocks:
            parts = [text for i, text in block if inside[i]]
            if parts:
                joined = "".join(parts)
                line = " ".join((entities.unescape(joined) if "&" in joined else joined).split())
                if line:
                    lines.append(line)
        return "\n".join(lines)

    def _outermost(self, chosen: list[bool]) -> list[int]:
        under, out = [False] * len(chosen), []
        for i, parent in enumerate(self.parents):
            under[i] = parent >= 0 and (under[parent] or chosen[parent])
            if chosen[i] and not under[i]:
                out.append(i)
        return out

    def _regions(self, clean, total, fair) -> list[int]:
        """The elements whose clean text is the main text: all articles, else the main elements, else the page."""
        count = range(len(self.tags))
        articles = self._outermost([self.tags[i] == "article" and clean[i] and total[i] > 0 for i in count])
        mains = self._outermost([self.main[i] and clean[i] and total[i] > 0 for i in count])
        whole = sum(fair[i] for i in mains) or fair[0]
        if articles and sum(fair[i] for i in articles) >= FEW * whole:
            return articles
        if mains and sum(fair[i] for i in mains) >= FEW * fair[0]:
            return mains
        if fair[0]:
            return [0]
        # All is marked: an article or main element that is not itself of such a kind is still the best there is.
        return self._outermost([(self.tags[i] == "article" or self.main[i]) and not self.bad[i] and self.tags[self.parents[i]] not in NEVER and total[i] > 0 for i in count])


def page_rows(pages: DataFrame) -> DataFrame:
    host = F.lower(F.regexp_extract(F.col("url").cast("string"), r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1))
    return pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.coalesce(host, F.lit("")).alias("host"),
        F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"),
    )


def site_templates(pages: DataFrame, min_pages: int = MIN_PAGES, min_share: float = MIN_SHARE) -> DataFrame:
    """host and the hashes of its template subtrees: on ``min_pages`` pages and ``min_share`` of the host's pages or more.

    A hash is on a large share of a host's pages, so a host has few of them, however many pages it has.
    Every task counts its own pages first; a common subtree reaches the shuffle once per task.
    """

    def hashes(batches):
        for batch in batches:
            hosts, values = [], []
            for host, source in zip(batch["host"].to_pylist(), batch["html"].to_pylist(), strict=True):
                own = {0, *Page(source).subtrees().values()}  # 0 counts the page itself
                hosts += [host] * len(own)
                values += own
            yield pa.RecordBatch.from_arrays([pa.array(hosts, pa.string()), pa.array(values, pa.int64())], names=["host", "subtree"])

    rows = page_rows(pages).where("host <> ''").select("host", "html").mapInArrow(hashes, "host string, subtree long")
    counts = rows.groupBy("host", "subtree").agg(F.count("*").alias("n")).where(F.col("n") >= min_pages)
    counts = stored(counts)
    whole = counts.where("subtree = 0").select("host", F.col("n").alias("pages"))
    common = counts.where("subtree <> 0").join(whole, "host").where(F.col("n") >= min_share * F.col("pages"))
    return common.groupBy("host").agg(F.array_sort(F.collect_set("subtree")).alias("template"))


def extract_text(pages: DataFrame, min_pages: int = MIN_PAGES, min_share: float = MIN_SHARE) -> DataFrame:
    """page_id, url, text and n_chars of every page.

    A null or empty html gives an empty text; repeated rows are extracted each; a page whose url is null or without host
    has no site template. Broken markup and very long pages take time in proportion to their length: see ``Page``. Paragraphs, headings and list items
    inside the main element are content even when they recur, only containers are template. Other columns are left out,
    so their names cannot clash. An empty table gives an empty result.
    """
    templates = stored(site_templates(pages, min_pages, min_share).withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))))
    rows = page_rows(pages).withColumn("salt", F.pmod(F.xxhash64("page_id", "url"), F.lit(SALTS)).cast("int"))
    # The written size of the template table decides between broadcast and shuffle; salts spread a large host.
    rows = rows.join(templates, ["host", "salt"], "left").select("page_id", "url", "html", "template")

    def extract(batches):
        for batch in batches:
            texts = [Page(source).text(set(template or ())) for source, template in zip(batch["html"].to_pylist(), batch["template"].to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch["page_id"], batch["url"], pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"]
            )

    return rows.mapInArrow(extract, "page_id long, url string, text string, n_chars long")


def op6(spark, folder: str) -> DataFrame:
    return extract_text(table(spark, folder, "pages"))
