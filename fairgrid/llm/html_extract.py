"""Main text of web pages: a style tree for each site finds low-importance branches, structure marks the rest."""

from __future__ import annotations

import bisect
import re
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, plus

#: A branch of a site's style tree is judged if so many distinct pages have it. It is noise if its importance stays below these shares of the
#: most possible: what surrounds the article differs on nearly every page or it is furniture; inside an article only what hardly ever differs goes.
MIN_PAGES, MIN_IMPORTANCE, MIN_IMPORTANCE_INSIDE = 5, 0.94, 0.2
#: Pages that the prior counts for: an element that is never main text by its kind starts with as many pages of importance 0, one made for text with as many of importance 1.
PRIOR_PAGES = 10
#: Text blocks of so many characters tell copies of a page without article or main apart from pages of their own.
LONG_BLOCK = 200
#: Number of pages at which the most possible importance of a branch inside an article or main stops growing: a heading of a few wordings does not become noise as its site grows.
INNER_PAGES = 100
#: Judged branches of all sites up to which they are broadcast, 8 bytes each; beyond that each part of a site's pages follows one row that has its site's.
BROADCAST_BRANCHES = 2_000_000
#: Pages of a part of a site, and copies that a worker remembers.
PART_PAGES, COPIES_KEPT = 2_000, 100_000

# Element names of HTML by their role in a page.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style textarea title noscript iframe xmp".split())
BLOCK = set(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header"
    " hr html legend li main menu nav ol p pre search section summary table tbody td tfoot th thead tr ul".split()
)
CLOSES_P = BLOCK - set("body html head td th tr tbody thead tfoot caption".split())
SIBLINGS = {
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}), "option": ({"option"}, {"select"}),
}
DROPPED = set(
    "head script style noscript template nav footer aside form iframe svg math canvas object audio video select button input textarea menu dialog search".split()
)
DROPPED_ROLES = set("navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar toolbar".split())

#: Elements made for text, a prior in their favour.
FOR_TEXT = set("p h1 h2 h3 h4 h5 h6 blockquote pre dd figcaption caption".split())

#: Class and id names (a choice of ours) that stand for what is never main text, wherever they are.
STRONG_NAMES = set(
    "ad ads adbox adslot adsense advert adverts advertisement advertising sponsor sponsored nav navbar navigation menubar breadcrumb breadcrumbs sidebar sidenav topnav subnav aside footer"
    " masthead topbar cookie cookies consent gdpr newsletter subscribe subscription signup login popup modal overlay comment comments commentlist commentbox disqus"
    " discussion replies respond related recommended sharing social pagination pager toolbar toc outbrain taboola".split()
)
#: Names that genuine content has, too: inside an article or main such a branch goes only if it is short or mostly links.
WEAK_NAMES = set("announcement alert banner copyright form legal menu notice notices promo promotion reply search share skip widget widgets".split())
WEAK_WORDS = 30
#: Words that go with the above in one name.
BESIDE = set(
    "area articles bar block bottom box btn button buttons col column container content footer form group head header icons inner item items label left links list main more"
    " outer page panel policy posts right row section site slot small stories tags text title top unit wrap wrapper zone".split()
)
CONTRARY = {"has", "with", "no", "without"}
#: Elements that are never noise themselves; their children may be.
PROTECTED = {"", "html", "body", "main", "article"}

NAME_END = re.compile(r"[\s/>]")
TAG_STOP = re.compile(r"=\s*+[\"']|>")
ATTRIBUTE = re.compile(r"([^\s=/]++)(?:\s*+=\s*+(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]++)))?")
RAW_ENDS = {tag: re.compile(rf"</{tag}\s*+>", re.I) for tag in RAW}


def name_strength(names: str, inside: bool) -> int:
    """2 if a class or id stands for what is no main text, 1 if it may, else 0.

    A name counts if its last part does, or if all its parts do or go with such words (``share-buttons``, not ``share-price``).
    """
    strength = 0
    for name in names.lower().split():
        parts = [x for x in re.split(r"[^a-z0-9]+", name) if x]
        if not parts or CONTRARY.intersection(parts):
            continue
        for least, known in ((2, STRONG_NAMES), (1, WEAK_NAMES)):
            whole = known.intersection(parts) and all(x in known or x in BESIDE or x.isdigit() for x in parts)
            if parts[-1] in known or whole:
                strength = max(strength, least)
        if not inside and parts[-1] == "header":
            strength = max(strength, 1)
    return strength


def tokens(html: str) -> Iterator[tuple[str, str, str]]:
    """("text", raw, ""), ("open", tag, attributes) and ("close", tag, "") in page order, in time linear in the page.

    A quoted attribute value hides a ``>`` inside a tag. If one tag does not end that way, this and all later tags
    end at their first ``>``, so no part of a broken page is searched twice. Comments, declarations and the inside of raw
    elements (scripts, styles) are left out.
    """
    start = at = 0
    n, quoted = len(html), True
    while True:
        lt = html.find("<", at)
        if lt < 0 or lt + 1 == n:
            break
        first = html[lt + 1]
        if first in "!?":
            mark, skip = ("-->", 4) if html.startswith("<!--", lt) else ("]]>", 9) if html.startswith("<![CDATA[", lt) else (">", 2)
            end = html.find(mark, lt + skip)
            if lt > start:
                yield "text", html[start:lt], ""
            start = at = n if end < 0 else end + len(mark)
            continue
        closing = first == "/"
        name_at = lt + 1 + closing
        if not (name_at < n and html[name_at].isascii() and html[name_at].isalpha()):
            at = lt + 1
            continue
        end = -1
        if quoted:
            stop = TAG_STOP.search(html, name_at)
            while stop and stop[0] != ">":
                close = html.find(stop[0][-1], stop.end())
                stop = TAG_STOP.search(html, close + 1) if close >= 0 else None
            end, quoted = (stop.start(), True) if stop else (-1, False)
        if end < 0:
            end = html.find(">", name_at)
            if end < 0:
                break
        if lt > start:
            yield "text", html[start:lt], ""
        start = at = end + 1
        name_end = NAME_END.search(html, name_at, end + 1).start()
        tag = html[name_at:name_end].lower()
        if closing:
            yield "close", tag, ""
            continue
        attributes = html[name_end:end]
        yield "open", tag, attributes
        if tag in RAW and not attributes.endswith("/"):
            close = RAW_ENDS[tag].search(html, at)
            start = at = close.end() if close else n
            yield "close", tag, ""
    if start < n:
        yield "text", html[start:], ""


def branch_id(parent: int, style: str) -> int:
    """The number of the branch of a style tree that ``style`` (a tag with its first class or id) is below the branch ``parent``; the root is 0."""
    return xxhash.xxh64_intdigest(f"{parent} {style}".encode("utf-8", "replace")) - (1 << 63)


class Element:
    """An open element: what it is, what its ancestors decide for it, and in tree mode the digest of its texts."""

    __slots__ = ("tag", "branch", "dropped", "article", "main", "link", "root", "noise", "weak_from", "content", "shape")

    def __init__(self, tag: str, branch: int, dropped: bool, article: int, main: bool, link: bool, root: int, noise: bool = False):
        self.tag, self.branch, self.dropped, self.article, self.main, self.link, self.root, self.noise = tag, branch, dropped, article, main, link, root, noise
        self.weak_from, self.content, self.shape = -1, None, None


class Page:
    """One page, read once in order: its text blocks, or with ``tree`` the shape and text of every branch of its style tree.

    ``noise`` has the site's branches of low importance, ``kept`` those of high importance right below such ones: a branch goes with all below
    it, but for what its own importance keeps. Branches that the site's tree does not judge follow the one they are in.
    """

    def __init__(self, html: str, noise: frozenset | set = frozenset(), by_name: bool = True, tree: bool = False, kept: frozenset | set = frozenset()):
        self.noise, self.kept, self.by_name, self.tree = noise, kept, by_name, tree
        #: branch -> branch of its parent and prior (-1: never main text, 1: made for text), in tree mode; whether it has long blocks and their digest; blocks that the tree removed
        self.parents: dict[int, tuple[int, int]] = {}
        self.long = xxhash.xxh3_128()
        self.any_long = False
        self.by_tree = 0
        self.stack = [Element("", 0, False, 0, False, False, 0)]
        #: places in the stack of the open elements of each tag, and of all block elements
        self.places: dict[str, list[int]] = {}
        self.block_places = [0]
        #: text, number of the article, whether in main, characters in links
        self.blocks: list[tuple[str, int, bool, int]] = []
        self.parts: list[str] = []
        self.linked = self.articles = 0
        #: branch -> (digest of its child styles, digest of its texts) over all its elements, and branch -> branch of the article or main around it
        self.branches: dict[int, tuple] = {}
        self.inner: dict[int, int] = {}
        for kind, what, attributes in tokens(html):
            if kind == "text":
                self._text(what)
            elif kind == "open":
                self._open(what, attributes)
            else:
                self._close(what)
        self._pop(1)
        self._flush()

    def _flush(self) -> None:
        if self.parts:
            if text := " ".join("".join(self.parts).split()):
                top, holder = self.stack[-1], self.stack[self.block_places[-1]]
                if not holder.noise:
                    self.blocks.append((text, top.article, top.main, self.linked))
                else:
                    self.by_tree += 1
            self.parts, self.linked = [], 0

    def _text(self, raw: str) -> None:
        top = self.stack[-1]
        if self.tree:
            if (text := " ".join(raw.split())) and top.content is not None:
                data = text.encode("utf-8", "replace")
                top.content.update(data)
                if len(text) >= LONG_BLOCK:
                    self.any_long = True
                    self.long.update(data)
        elif not top.dropped:
            text = unescape(raw) if "&" in raw else raw
            self.parts.append(text)
            if top.link:
                self.linked += len(text.strip())

    def _pop(self, depth: int) -> None:
        while len(self.stack) > depth:
            top = self.stack[-1]
            if top.tag in BLOCK:
                self._flush()
                self.block_places.pop()
            self.places[top.tag].pop()
            self.stack.pop()
            if self.tree:
                shape, content = self.branches[top.branch]
                data = top.content.digest()
                shape.update(top.shape.digest())
                content.update(data)
                if self.stack[-1].content is not None:
                    self.stack[-1].content.update(data)
            elif top.weak_from >= 0:
                branch = self.blocks[top.weak_from :]
                size = sum(len(t) for t, *_ in branch)
                if sum(len(t.split()) for t, *_ in branch) < WEAK_WORDS or 2 * sum(b[3] for b in branch) >= size:
                    del self.blocks[top.weak_from :]

    def _open(self, tag: str, attributes: str) -> None:
        if tag in CLOSES_P and self.stack[self.block_places[-1]].tag == "p":
            self._pop(self.block_places[-1])
        if tag in SIBLINGS:
            same, within = SIBLINGS[tag]
            bound = max((self.places[t][-1] for t in within if self.places.get(t)), default=0)
            beyond = [own[i] for t in same if (own := self.places.get(t)) and (i := bisect.bisect_right(own, bound)) < len(own)]
            if beyond:
                self._pop(min(beyond))
        if tag in BLOCK:
            self._flush()
        up = self.stack[-1]
        names = role = ""
        hidden = False
        if attributes and ("=" in attributes or "hidden" in attributes):
            found = {k.lower(): a or b or c for k, a, b, c in ATTRIBUTE.findall(attributes)}
            names, role = f"{found.get('class', '')} {found.get('id', '')}".strip(), found.get("role", "").lower()
            hidden = "hidden" in found or found.get("aria-hidden") == "true" or "display:none" in found.get("style", "").replace(" ", "").lower()
        if tag == "br":
            if not self.tree and not up.dropped:
                self.parts.append(" ")
            return
        style = f"{tag}.{names.split()[0]}" if names else tag
        branch = branch_id(up.branch, style)
        if self.tree:
            if up.shape is not None:
                up.shape.update(style.encode("utf-8", "replace") + b"|")
            if branch not in self.branches:
                self.branches[branch] = (xxhash.xxh64(), xxhash.xxh64())
                never = tag in DROPPED or tag == "header" or role in DROPPED_ROLES
                self.parents[branch] = (up.branch, -1 if never else int(tag in FOR_TEXT))
            if up.root:
                self.inner[branch] = up.root
        if tag in VOID:
            return
        inside = bool(up.article or up.main)
        dropped = up.dropped or tag in DROPPED or hidden or role in DROPPED_ROLES
        weak = False
        if not dropped and self.by_name:
            strength = name_strength(names, inside) if names and tag not in ("html", "body", "main") else 0
            weak = strength == 1 and inside and tag in BLOCK
            dropped = strength == 2 or strength == 1 and not inside or tag == "header" and not inside
        article, root = up.article, up.root
        if tag == "article" and not article and not dropped:
            self.articles += 1
            article, root = self.articles, branch
        main = tag == "main" or role == "main"
        if not root and main:
            root = branch
        noise = False if tag in PROTECTED or main else True if branch in self.noise else False if branch in self.kept else up.noise
        own = Element(tag, branch, dropped, article, up.main or main, up.link or tag == "a", root, noise)
        if weak:
            own.weak_from = len(self.blocks)
        if self.tree:
            own.content, own.shape = xxhash.xxh64(), xxhash.xxh64()
        self.places.setdefault(tag, []).append(len(self.stack))
        if tag in BLOCK:
            self.block_places.append(len(self.stack))
        self.stack.append(own)

    def _close(self, tag: str) -> None:
        if own := self.places.get(tag):
            if tag in BLOCK or own[-1] > self.block_places[-1]:
                self._pop(own[-1])

    def main_text(self) -> str:
        """All blocks of articles and main in page order; without either all blocks that are not mere links.

        An article that is mostly links, a teaser, goes if there is another.
        """
        size, linked = {}, {}
        for text, article, _, n in self.blocks:
            size[article] = size.get(article, 0) + len(text)
            linked[article] = linked.get(article, 0) + n
        teasers = {k for k in size if k and 2 * linked[k] >= size[k]}
        if teasers == set(size) - {0}:
            teasers = set()
        if any(article or main for _, article, main, _ in self.blocks):
            return "\n".join(t for t, article, main, _ in self.blocks if (article or main) and article not in teasers)
        return "\n".join(t for t, _, _, n in self.blocks if n < 0.8 * len(t))


def extract(html: str | None, noise: frozenset | set = frozenset(), kept: frozenset | set = frozenset()) -> str:
    """The main text of one page; if names in the page mark all of it for dropping, only the tree and its elements judge, and where the tree leaves nothing, elements alone."""
    if not html:
        return ""
    found = Page(html, noise, kept=kept).main_text() or Page(html, noise, by_name=False, kept=kept).main_text()
    return found or not noise and "" or Page(html).main_text() or Page(html, by_name=False).main_text()


def host_of(url):
    """The lower-case host of a URL column; empty where there is none."""
    return F.coalesce(F.lower(F.regexp_extract(url.cast("string"), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)), F.lit(""))


def _units(html: str) -> Iterator[tuple[bytes, bool, list, list, list, list, list]]:
    """Digest, whether inside an article or main, and branches with their parents, priors and the hashes of their shapes and texts: the
    page without its articles and main by all its html (by its long blocks where it has neither article nor main), each of these by its own branches."""
    page, groups = Page(html, tree=True), {}
    for branch, (shape, content) in page.branches.items():
        groups.setdefault(page.inner.get(branch, 0), []).append((branch, *page.parents[branch], shape.intdigest() - (1 << 63), content.intdigest() - (1 << 63)))
    for root, nodes in groups.items():
        data = repr((root, nodes)) if root else html
        unit = page.long.digest() if not page.inner and page.any_long else xxhash.xxh3_128_digest(data.encode("utf-8", "replace"))
        yield unit, bool(root), *map(list, zip(*nodes, strict=True))


def style_tree(pages: DataFrame, min_pages: int = MIN_PAGES) -> DataFrame:
    """(host, branch, parent, inner, pages, seen, importance) of every branch of each site's style tree that ``min_pages`` distinct pages have.

    Pages of a host are merged by the styles (tag, first class or id) from the root down. Presentation
    is the sequence of child styles below a branch, content the texts below it. A branch's
    importance is the larger of the two entropies over the pages that have it,
    by the logarithm of their number: 0 if all agree, 1 if all differ. Copies count once:
    a page by its html, the branches inside an article or main by that element's own branches, so that
    copies under changing menus are copies as well, and a page without these by its long blocks. Inside them the logarithm stops at INNER_PAGES. Elements that are
    never main text (navigation, asides, forms) or are made for it (paragraphs, headings) are the prior: such a branch counts PRIOR_PAGES pages of importance 0 or 1 more; ``seen`` is without it. A task
    hands on a copy once, and counts are combined before each shuffle, so neither a copied page nor a host with a third of all pages is a hot key.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: set[tuple[str, bytes]] = set()
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part, rows = batch.slice(at, 256), []
                if len(known) > COPIES_KEPT:
                    known.clear()
                for host, html in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                    copy = (host, xxhash.xxh3_128_digest((html or "").encode("utf-8", "replace")))
                    if copy in known:
                        continue
                    known.add(copy)
                    for unit, inner, *nodes in _units(html or ""):
                        if not inner or (host, unit) not in known:
                            known.add((host, unit))
                            rows.append((host, unit, inner, *nodes))
                longs = pa.list_(pa.int64())
                types = (pa.string(), pa.binary(), pa.bool_(), longs, longs, pa.list_(pa.int8()), longs, longs)
                cols = list(zip(*rows, strict=True)) or [()] * len(types)
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types, strict=True)], ["host", "unit", "inner", "branches", "parents", "priors", "shapes", "texts"])

    schema = "host string, unit binary, inner boolean, branches array<long>, parents array<long>, priors array<tinyint>, shapes array<long>, texts array<long>"
    seen = pages.select(host_of(F.col("url")).alias("host"), F.col("html").cast("string")).mapInArrow(run, schema)
    units = seen.groupBy("host", "unit", "inner").agg(F.first(F.struct("branches", "parents", "priors", "shapes", "texts")).alias("u"))
    nodes = units.select("host", "inner", F.explode(F.arrays_zip("u.branches", "u.parents", "u.priors", "u.shapes", "u.texts")).alias("v"))
    kinds = nodes.select("host", "inner", F.col("v.branches").alias("branch"), F.col("v.parents").alias("parent"), F.col("v.priors").alias("prior"), F.posexplode(F.array("v.shapes", "v.texts")).alias("kind", "hash"))
    told = [F.max(c).alias(c) for c in ("inner", "parent", "prior")]
    counts = kinds.groupBy("host", "branch", "kind", "hash").agg(F.count("*").alias("n"), *told)
    sums = counts.groupBy("host", "branch", "kind").agg(F.sum("n").alias("pages"), F.sum(F.col("n") * F.log("n")).alias("s"), *told)
    sums = sums.where(F.col("pages") >= min_pages)
    most = F.when(F.col("inner"), F.least("pages", F.lit(INNER_PAGES))).otherwise(F.col("pages"))
    importance = F.least((F.log("pages") - F.col("s") / F.col("pages")) / F.log(most), F.lit(1.0))
    merged = sums.groupBy("host", "branch").agg(F.max("pages").alias("pages"), F.max(importance).alias("seen"), *told)
    with_prior = (F.col("seen") * F.col("pages") + F.when(F.col("prior") > 0, PRIOR_PAGES).otherwise(0)) / (F.col("pages") + F.abs("prior") * PRIOR_PAGES)
    return merged.select("host", "branch", "parent", "inner", "pages", "seen", with_prior.alias("importance"))


def judged_branches(tree: DataFrame, least: float = MIN_IMPORTANCE, least_inside: float = MIN_IMPORTANCE_INSIDE) -> DataFrame:
    """(host, noise, kept): a row for each site with noise; its branches of low importance, and those of high importance right below one of them."""
    bar = F.when(F.col("inner"), least_inside).otherwise(least)
    weak = cut(tree.select("host", "branch", "parent", (F.col("importance") < bar).alias("noise"), (F.col("seen") >= bar).alias("high")))
    above = weak.where("noise").select("host", F.col("branch").alias("parent"), F.lit(True).alias("below"))
    rows = weak.join(above, ["host", "parent"], "left").where("noise or (high and below)")
    listed = lambda c: F.collect_list(F.when(c, F.col("branch")))
    return rows.groupBy("host").agg(listed(F.col("noise")).alias("noise"), listed(~F.col("noise")).alias("kept")).where(F.size("noise") > 0)


def extract_main_text(pages: DataFrame, min_pages: int = MIN_PAGES, min_importance: float = MIN_IMPORTANCE) -> DataFrame:
    """``pages`` (page_id, url, html, more) with ``text``: the main text, blocks in page order joined by a line feed.

    First the site's style tree judges: a branch of low importance goes with all below it, but for branches below it whose own importance is high, and
    what varies from page to page stays (html, body, main and article never go). Elements are the tree's prior; where a site has
    too few pages for its tree, they judge by themselves, and so do class names. What is left of the articles and of main is the text. Character references
    are decoded, white space inside a block becomes one space.

    Null or empty html gives empty text; very long and broken pages take time in proportion; null and bad urls are one site without
    name. Copies of a page count once in the tree and each get their text. An incoming ``text`` is replaced, other columns pass through. Empty in, empty out.

    A site's branches reach its pages once for a task: as one broadcast map where all are few, else as a row of their own ahead of each
    part of PART_PAGES of the site's pages.
    """
    spark, pages = pages.sparkSession, pages.drop("text")
    judged = cut(judged_branches(style_tree(pages, min_pages), min_importance))
    size = judged.agg(F.sum(F.size("noise") + F.size("kept") + 8)).first()[0] or 0
    schema, n, at = plus(pages.schema, text="string"), len(pages.columns), pages.columns.index("html")
    named = pages.withColumn("__host", host_of(F.col("url")))

    if size <= BROADCAST_BRANCHES:
        sites = spark.sparkContext.broadcast({r.host: (r.noise, r.kept) for r in judged.toLocalIterator()})

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            sets: dict = {}
            for batch in batches:
                texts = []
                for html, host in zip(batch.column(at), batch.column(n).to_pylist(), strict=True):
                    if host not in sets:
                        sets[host] = tuple(map(frozenset, sites.value.get(host, ((), ()))))
                    texts.append(extract(html.as_py(), *sets[host]))
                yield pa.RecordBatch.from_arrays([*batch.columns[:n], pa.array(texts, pa.string())], [*batch.schema.names[:n], "text"])

        return named.mapInArrow(run, schema)

    counts = pages.groupBy(host_of(F.col("url")).alias("__host")).agg(F.ceil(F.count("*") / PART_PAGES).alias("__parts"))
    rows = named.join(counts, "__host").withColumn("__part", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.col("__parts")))
    none = F.lit(None).cast("array<bigint>")
    rows = rows.select(*pages.columns, "__host", "__part", none.alias("__noise"), none.alias("__kept"))
    heads = judged.join(counts, judged["host"] == counts["__host"]).select("__host", F.explode(F.sequence(F.lit(0).cast("long"), F.col("__parts") - 1)).alias("__part"), F.col("noise").alias("__noise"), F.col("kept").alias("__kept"))
    both = rows.unionByName(heads, allowMissingColumns=True).withColumn("__page", F.col("__noise").isNull())
    dealt = both.repartition("__host", "__part").sortWithinPartitions("__host", "__part", "__page")

    def follow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, sets = None, ((), ())
        for batch in batches:
            texts, kept = [], []
            for i, (html, host, part, is_page) in enumerate(zip(batch.column(at), *(batch.column(k).to_pylist() for k in (n, n + 1, n + 4)), strict=True)):
                if not is_page:
                    known, sets = (host, part), (frozenset(batch.column(n + 2)[i].as_py()), frozenset(batch.column(n + 3)[i].as_py()))
                    continue
                kept.append(i)
                texts.append(extract(html.as_py(), *(sets if known == (host, part) else (frozenset(), frozenset()))))
            own = batch.take(pa.array(kept, pa.int64()))
            yield pa.RecordBatch.from_arrays([*own.columns[:n], pa.array(texts, pa.string())], [*batch.schema.names[:n], "text"])

    return dealt.select(*pages.columns, "__host", "__part", "__noise", "__kept", "__page").mapInArrow(follow, schema)
