"""Main text of web pages by consensus of their host (operator 10).

A page's containers are scored and its best one votes with its path of tags and classes; a host's pages are extracted at the
path with most votes, or at one above it where the containers beside it hold text of their own on most pages too. The host
decides in the same way what is left out within: text that is the same at a path on most of its pages. What the article
excludes by its names is left out on every page.
"""

import html
import re
from collections import Counter

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from .common import Carried, flat_slices, map_slices, name, saved, table

TAG = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*\"|'[^']*'|[\"'])*+)(?:>|\Z)", re.S)
ATTRIBUTE = re.compile(r"""(?:^|\s)(class|id|role|hidden|aria-hidden|style)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""", re.I)
# Element names of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe xmp noembed noframes".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol option p pre section summary table tbody td tfoot th thead tr ul".split()
)
DROPPED = frozenset("head nav header footer aside form script style noscript iframe template svg canvas button select textarea title object menu dialog xmp noembed noframes".split())
CONTAINER = frozenset("article main section div body td center".split())
ENDS_P = BLOCK - {"option", "summary", "caption", "tbody", "thead", "tfoot", "tr", "td", "th", "dd", "dt", "li", "body", "html"} | {"li", "dd", "dt"}
# Words of class names. A name is unwanted if it holds a word of the first list, and others of these lists alone.
UNWANTED = frozenset(
    "ad ads advert adverts advertisement advertisements advertising sponsor sponsors sponsored promo promos banner banners cookie cookies consent gdpr notice notices alert alerts popup popups modal modals overlay sidebar sidebars menu menus nav navbar navigation breadcrumb breadcrumbs footer masthead topbar comment comments disqus respond replies related recommended share sharing social newsletter subscribe signup login pagination pager skip widget widgets toolbar".split()
)
GENERIC = frozenset("area bar bottom box block blocks btn button buttons col column container content form group header inner icons item items left link links list main message panel post posts reader right section site slot text title top unit user wrap wrapper".split())
ZEROS = re.compile(r"&#([xX]?)0++(?=[0-9a-fA-F])")
LONG_NUMBER = re.compile(r"&#(?:[xX]0*+[0-9a-fA-F]{7,}|0*+[0-9]{8,});?")
HREF = re.compile(r"(?:^|\s)href\s*=", re.I)
WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|[0-9]+")
LEAST_PAGES = 3  # of a host, to judge a path
SAME, LINKS = 0.5, 0.8  # pages of a path with one text, to leave that out; letters in links, for a list of links
BESIDE, CLIMBS = 0.1, 3  # letters of a container beside the chosen one, against that, to count as a part of the article
LONGEST_PATH = 1000
MODULUS, BASE = (1 << 61) - 1, 0x1B873593CC9E2D51 % ((1 << 61) - 1)  # of the digests of ranges of blocks
ROLES = frozenset("navigation banner contentinfo complementary search dialog alert menu menubar form".split())


class Node:
    """An open or closed element. Its blocks are those from start to end of the page's; home is the container it is or
    stands in."""

    __slots__ = ("end", "home", "links", "path", "score", "start", "tag", "unwanted")

    def __init__(self, tag: str, path: str, home: "Node | None", unwanted: bool, start: int):
        self.tag, self.path, self.unwanted, self.start, self.end = tag, path, unwanted, start, start
        self.home = home or self
        self.links, self.score = 0, 0.0


class Page:
    """The wanted containers of a page in order, and its wanted blocks, with running sums of lengths and digests, so that
    size and digest of any range cost the same however long it is."""

    def __init__(self, nodes: list[Node], blocks: list[str]):
        self.nodes, self.blocks = nodes, blocks
        self.sizes, self.sums, self.powers = [0], [0], [1]
        for b in blocks:
            self.sizes.append(self.sizes[-1] + len(b))
            self.sums.append((self.sums[-1] * BASE + xxh64_intdigest(b.encode("utf-8", "surrogatepass")) % MODULUS) % MODULUS)
            self.powers.append(self.powers[-1] * BASE % MODULUS)

    def size(self, node: Node) -> int:
        return self.sizes[node.end] - self.sizes[node.start]

    def digest(self, nodes: list[Node]) -> int:
        out = 0
        for n in nodes:
            own = (self.sums[n.end] - self.sums[n.start] * self.powers[n.end - n.start]) % MODULUS
            out = (out * self.powers[n.end - n.start] + own) % MODULUS
        return out

    def linked(self, node: Node) -> bool:
        return node.links >= LINKS * max(1, self.size(node))

    def best(self) -> Node | None:
        """The container with the highest score; of equal ones the innermost, which comes later."""
        return max(enumerate(self.nodes), key=lambda x: (x[1].score, x[0]))[1] if self.nodes else None

    def by_path(self) -> dict[str, list[Node]]:
        out: dict[str, list[Node]] = {}
        for n in self.nodes:
            out.setdefault(n.path, []).append(n)
        return out


def unescaped(text: str) -> str:
    """Character references decoded. A number beyond all code points, of any length, is the replacement character."""
    if "&" not in text:
        return text
    return html.unescape(LONG_NUMBER.sub("\ufffd", ZEROS.sub(r"&#\1", text)))


def attributes(text: str) -> dict[str, str]:
    return {k.lower(): unescaped(v.strip("\"'")) for k, v in ATTRIBUTE.findall(text)} if text else {}


def generalised(tag: str, classes: str) -> str:
    """tag.class: the first class, digits as #."""
    first = classes.split()[0] if classes.split() else ""
    return f"{tag}.{re.sub(r'[0-9]+', '#', first)}" if first else tag


def named_unwanted(names: str) -> bool:
    """Whether one of the class names or ids says that this is no part of an article: cookie-notice does, alert-level and
    share-price-table do not."""
    for one in names.split():
        words = [w.lower() for w in WORDS.findall(one) if not w.isdigit()]
        if not UNWANTED.isdisjoint(words) and all(w in UNWANTED or w in GENERIC for w in words):
            return True
    return False


def parse(page: str) -> Page:
    """The page's containers and blocks, in time and memory that grow with its length, however deep it is nested. The root
    is the last resort."""
    root = Node("html", "html", None, False, 0)
    stack, nodes, blocks = [root], [root], []
    open_tags: Counter = Counter()
    buffer: list[str] = []
    linked = 0
    link_depth = 0  # elements that stood open as the link began; 0 outside links

    def flush() -> None:
        nonlocal linked
        if buffer:
            raw = "".join(buffer)
            buffer.clear()
            node = stack[-1]
            if not node.unwanted and (text := " ".join(unescaped(raw).split())):
                blocks.append(text)
                node.home.links += min(linked, len(text))
                node.home.score += len(text) + 25
        linked = 0

    def close(depth: int) -> None:
        """Ends the elements from depth on. What a container holds counts for the one around it, a little less."""
        nonlocal link_depth
        flush()
        while len(stack) > depth:
            node = stack.pop()
            open_tags[node.tag] -= 1
            node.end = len(blocks)
            if node.home is node and not node.unwanted:
                around = stack[-1].home
                around.score += 0.6 * node.score
                around.links += node.links
        if len(stack) < link_depth:
            link_depth = 0

    at, end, search = 0, len(page), TAG.search
    while at < end:
        m = search(page, at)
        piece = page[at : m.start()] if m else page[at:]
        if piece:
            buffer.append(piece)
            if link_depth:
                linked += len(piece)
        if m is None:
            break
        at = m.end()
        tag = (m[2] or "").lower()
        if not tag:
            continue
        if m[1]:
            if tag == "a":
                link_depth = 0
            elif tag == "br":
                buffer.append(" ")
            elif tag in BLOCK or tag in DROPPED:
                if open_tags[tag]:
                    close(next(k for k in range(len(stack) - 1, 0, -1) if stack[k].tag == tag))
                else:
                    flush()
            continue
        if tag in RAW:
            stop = RAW_ENDS[tag].search(page, at)
            at = stop.end() if stop else end
            continue
        if tag == "a":  # it ends the one before; without an address it is no link
            link_depth = len(stack) if HREF.search(m[3]) else 0
        if tag == "br":
            buffer.append(" ")
        if tag not in BLOCK and tag not in DROPPED:
            continue
        if tag in ENDS_P and stack[-1].tag == "p":
            close(len(stack) - 1)
        flush()
        if tag in ALIKE and any(open_tags[x] for x in ALIKE[tag]):
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].tag in LISTS:
                    break
                if stack[k].tag in ALIKE[tag]:
                    close(k)
                    break
        if tag in VOID or m[3].endswith("/") and tag in ("svg", "hr"):
            continue
        own = attributes(m[3])
        hidden = "hidden" in own or own.get("aria-hidden", "") == "true" or "display:none" in own.get("style", "").lower().replace(" ", "")
        named = tag not in ("body", "html", "article", "main") and named_unwanted(f"{own.get('class', '')} {own.get('id', '')}")
        bad = tag in DROPPED or hidden or named or own.get("role", "").lower() in ROLES
        if tag == "html" or tag == "body" and len(stack) > 1:
            continue
        parent = stack[-1]
        path = extended(parent.path, generalised(tag, own.get("class", ""))) if tag in CONTAINER else parent.path
        node = Node(tag, path, None if tag in CONTAINER else parent.home, parent.unwanted or bad, len(blocks))
        stack.append(node)
        open_tags[tag] += 1
        if tag in CONTAINER and not node.unwanted:
            nodes.append(node)
    close(1)
    root.end = len(blocks)
    out = Page([n for n in nodes if n.end > n.start], blocks)
    for n in out.nodes:
        n.score = (n.score + 1) * max(0.0, 1 - n.links / max(1, out.size(n))) ** 2 * {"article": 2.0, "main": 1.5}.get(n.tag, 1.0)
    return out


ALIKE = {**{t: (t,) for t in ("li", "tr", "option")}, **{t: ("dd", "dt") for t in ("dd", "dt")}, **{t: ("td", "th") for t in ("td", "th")}}
LISTS = ("ul", "ol", "dl", "table", "select", "menu")
RAW_ENDS = {t: re.compile(rf"</{t}\b[^>]*>?", re.I) for t in RAW}


def extended(path: str, step: str) -> str:
    """path/step; one that would grow too long is told by a digest, which ends what paths say of each other."""
    out = f"{path}/{step}"
    return out if len(out) <= LONGEST_PATH else f"~{xxh64_intdigest(out):016x}"


def text_at(page: str, path: str | None, away: list[str] | None = None) -> str:
    """Blocks of the containers at path but those of links alone, without the texts that away names (path, a blank, digest)
    beneath it; where there are none, of the page's own best container."""
    found = parse(page)
    chosen = [n for n in found.nodes if n.path == path]
    chosen = [n for n in chosen if not found.linked(n)] or chosen
    if not chosen and found.nodes:
        chosen = [found.best()]
    gone = bytearray(len(found.blocks))
    if away:
        known, judged = set(away), {a.partition(" ")[0] for a in away}
        for own, nodes in found.by_path().items():
            if own in judged and f"{own} {found.digest(nodes)}" in known:
                for n in nodes:
                    gone[n.start : n.end] = b"\1" * (n.end - n.start)
    out, done = [], 0
    for n in sorted(chosen, key=lambda n: n.start):
        out += [found.blocks[k] for k in range(max(done, n.start), n.end) if not gone[k]]
        done = max(done, n.end)
    return "\n".join(out)


def verdicts(given: DataFrame) -> DataFrame:
    """host, path, away: the path at which a host's pages are extracted, and the repeated texts beneath it that are left
    out. Most votes win; equal votes go to the longer text, then to the smaller path. The path above takes over where
    containers beside the chosen one stand on most of its pages with text of their own, which are no lists of links and
    are not much shorter: the article has several parts.

    A page emits a row for each path of its containers: what it holds and whether it is the page's best. Rows combine by
    (host, path, text, page) and then by (host, path), so that a large host is never gathered; a path leaves out one text at
    most, that of more than a share SAME of its pages."""

    def survey():
        def make(hosts, pages_):
            out: list[list] = [[] for _ in range(7)]
            for host, page in zip(hosts, pages_, strict=True):
                found = parse(page or "")
                top = found.best()
                own = xxh64_intdigest((page or "").encode("utf-8", "surrogatepass")) >> 1
                for path, some in found.by_path().items():
                    size = sum(map(found.size, some))
                    row = (host, path, found.digest(some), own, size, min(size, sum(n.links for n in some)), int(top is not None and top.path == path))
                    for values, v in zip(out, row, strict=True):
                        values.append(v)
            return out

        return make

    found = flat_slices(given, {"host": "string", "path": "string", "digest": "bigint", "page": "bigint", "size": "bigint", "links": "bigint", "votes": "bigint"}, survey)
    sums = [F.sum(c).alias(c) for c in ("size", "links", "votes")]
    by_page = found.groupBy("host", "path", "digest", "page").agg(*sums)  # copies of a page are one page where texts are compared
    by_text = by_page.groupBy("host", "path", "digest").agg(F.count("*").alias("pages"), *sums)
    most_text = F.max(F.struct("pages", "digest")).alias("same")
    by_path = saved(by_text.groupBy("host", "path").agg(F.sum("pages").alias("pages"), F.count("*").alias("texts"), most_text, *sums))
    hosts = by_path.groupBy("host").agg(F.min_by(F.struct("path", "pages", "size"), F.struct(-F.col("votes"), -F.col("size"), F.col("path"))).alias("won")).select("host", "won.path", F.col("won.pages").alias("own_pages"), F.col("won.size").alias("own_size"))
    above = F.regexp_replace("path", "/[^/]*$", "")
    parted = (F.col("pages") >= LEAST_PAGES) & (F.col("same.pages") <= SAME * F.col("pages")) & (F.col("links") < LINKS / 2 * F.col("size"))
    parts = by_path.where(parted).select(F.col("host").alias("part_host"), F.col("path").alias("part"), above.alias("part_above"), F.col("pages").alias("part_pages"), F.col("size").alias("part_size"))
    for _ in range(CLIMBS):
        beside = (F.col("host") == F.col("part_host")) & (above == F.col("part_above")) & (F.col("path") != F.col("part")) & (F.col("part_pages") > SAME * F.col("own_pages")) & (F.col("part_size") >= BESIDE * F.col("own_size"))
        moved = hosts.join(parts, beside, "left_semi").select("host", above.alias("path"))
        whole = by_path.select("host", "path", F.col("pages").alias("own_pages"), F.col("size").alias("own_size"))
        hosts = saved(moved.join(whole, ["host", "path"]).unionByName(hosts.join(moved.select("host"), "host", "left_anti")))
    judged = by_path.select("host", F.col("path").alias("beneath"), "pages", "same").join(hosts.select("host", "path"), "host")
    same = (F.col("same.pages") >= LEAST_PAGES) & (F.col("same.pages") > SAME * F.col("pages")) & F.startswith("beneath", F.concat("path", F.lit("/")))
    away = judged.where(same).groupBy("host").agg(F.collect_set(F.concat_ws(" ", "beneath", F.col("same.digest").cast("string"))).alias("away"))
    return saved(hosts.select("host", "path").join(away, "host", "left"))


def extract_text(pages: DataFrame, url: str = "url", html_column: str = "html", keep: list[str] | None = None) -> DataFrame:
    """keep columns of pages (all unless given), then text: the article's blocks joined by line feeds.

    First pass: verdicts of each host. Second pass: each page is extracted by them. A null html counts as empty and gives
    the empty text. A null url, or one without host, belongs to the host "". Repeated pages vote each; a page of any length
    is parsed whole. Without rows there are none. A column of pages named text is replaced, others may have any name.
    """
    carried = Carried(pages, keep, ["text"])
    host = F.lower(F.regexp_extract(F.coalesce(pages[name(url)], F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))
    given = pages.select(*carried.columns, host.alias("host"), pages[name(html_column)].alias("html"))
    # Small verdicts are broadcast by their size on disk, larger ones joined by a shuffle whose hot hosts can be split.
    both = given.join(verdicts(given.select("host", "html")), "host", "left").select(*carried.inner, "path", "away", "html")

    def extract():
        def make(*columns):
            return ([text_at(page or "", path, away) for path, away, page in zip(*columns, strict=True)],)

        return make

    return map_slices(both, {"text": "string"}, extract, keep=carried.inner, rows=128, inputs=["path", "away", "html"]).select(*carried.back, "text")


def op10_consensus_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = extract_text(table(spark, sf_dir, "pages"), keep=["page_id", "url"])
    return found.select("page_id", "url", "text", F.length("text").cast("bigint").alias("n_chars"))
