"""Main text of web pages: site templates are removed, then what is boilerplate by its markup."""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator
from urllib.parse import urlsplit

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import with_columns, written

# A subtree is a template of its host if so many distinct pages have it, whatever the size of the host. On a host of few
# pages, half of them are enough, but for the least number that tells of a recurrence.
MIN_PAGES = 10
LEAST_PAGES = 3
# Share of the host's pages that a template must be on besides.
MIN_SHARE = 0.0
# Templates that are broadcast at most; more are joined to the pages.
BROADCAST = 1 << 17

# Elements by their role in HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe template svg math object select".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span "
    "strike strong sub sup time tt u var wbr img".split()
)
CELLS = frozenset(["td", "th"])
MAIN = frozenset(["article", "main"])
# What an article is made of: kept there, however often it recurs.
PROSE = frozenset("p h1 h2 h3 h4 h5 h6".split())
# Start tags that end an open element of the same set, up to a container.
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
}
# Block elements that end an open paragraph.
ENDS_P = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 "
    "h4 h5 h6 header hr main menu nav ol p pre search section table ul".split()
)
# Boilerplate: by element, by ARIA role, by a word of class or id.
DROPPED = frozenset(["nav", "footer", "aside", "form", "head", "button", "dialog", "menu"])
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert menu menubar".split())
NAMES = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner nav navbar navigation menu "
    "breadcrumb breadcrumbs sidebar footer cookie cookies consent notice notices popup modal newsletter subscribe "
    "comment comments disqus replies share sharing social related".split()
)

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<(/?)([a-zA-Z][^\s/>]*)([^>]*+)>",
    re.S,
)
_ATTRIBUTE = re.compile(r"([^\s=/>\"']+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
_NAME_WORDS = re.compile(r"[a-z]+")
# A compound class with one of these says something about its element, as in "with-sidebar".
STATES = frozenset("with has no without free enabled disabled open closed".split())


class Node:
    """An element: tag, attributes, and children that are nodes or texts."""

    __slots__ = ("tag", "attributes", "children", "hash")

    def __init__(self, tag: str, attributes: str = ""):
        self.tag, self.attributes, self.children, self.hash = tag, attributes, [], 0


def parse(page: str) -> Node:
    """The element tree of a page; unclosed and misnested elements are closed as browsers do for common cases."""
    root = Node("")
    open_ = [root]
    at, n = 0, len(page)
    while at < n:
        found = _TOKEN.search(page, at)
        if not found:
            open_[-1].children.append(page[at:])
            break
        if found.start() > at:
            open_[-1].children.append(page[at: found.start()])
        at = found.end()
        tag = found[2] or found[5]
        if not tag:
            if found[0].startswith("<![CDATA["):
                open_[-1].children.append(found[0][9:].removesuffix("]]>"))
            continue
        tag = tag.lower()
        if found[1] or found[4]:
            for depth in range(len(open_) - 1, 0, -1):
                if open_[depth].tag == tag:
                    del open_[depth:]
                    break
            continue
        if tag in ENDS_P:
            _close(open_, {"p"}, {"button", "td", "th", "table", "li", "article", "section", "div"})
        if tag in CLOSES:
            _close(open_, *CLOSES[tag])
        node = Node(tag, (found[3] or found[6] or "").strip())
        open_[-1].children.append(node)
        if tag in RAW:
            end = re.compile(rf"</{tag}[\s/>]", re.I).search(page, at)
            stop = end.start() if end else n
            node.children.append(page[at:stop])
            at = stop
            if end:
                at = page.find(">", stop) + 1 or n
        elif tag not in VOID and not node.attributes.endswith("/"):
            open_.append(node)
    return root


def _close(open_: list[Node], names: set, within: set) -> None:
    """End the innermost open element of ``names``, unless an element of ``within`` stands between."""
    for depth in range(len(open_) - 1, 0, -1):
        if open_[depth].tag in names:
            del open_[depth:]
            return
        if open_[depth].tag in within:
            return


def _order(root: Node) -> list[Node]:
    """All nodes, parents before children, without recursion: pages may nest deeply."""
    out, left = [], [root]
    while left:
        node = left.pop()
        out.append(node)
        left.extend(c for c in node.children if isinstance(c, Node))
    return out


def hash_subtrees(root: Node) -> None:
    """Give each node the hash of its tag, attributes, texts and children's hashes."""
    from xxhash import xxh64_intdigest

    for node in reversed(_order(root)):
        parts = [node.tag, node.attributes]
        parts += [f"#{c.hash}" if isinstance(c, Node) else " ".join(c.split()) for c in node.children]
        node.hash = xxh64_intdigest("\0".join(parts).encode("utf-8", "replace"))


def _main_nodes(root: Node) -> list[Node]:
    """The article or main elements that are not boilerplate and lie in no other one."""
    out, left = [], [root]
    while left:
        node = left.pop()
        if _is_boilerplate(node, False):
            continue
        if node.tag in MAIN:
            out.append(node)
        else:
            left.extend(c for c in reversed(node.children) if isinstance(c, Node))
    return out


def _own_nodes(root: Node, mains: list[Node]) -> set[int]:
    """Identities of the nodes that are no template: main elements, headings and paragraphs of articles, all above them.

    What lies in such a heading or paragraph is kept with it. A main element without
    an article in it is the article.
    """
    own = {id(root)}
    if not mains:
        return own
    articles = set()
    for main in mains:
        nodes = _order(main)
        within = [n for n in nodes if n.tag == "article"]
        articles |= {id(n) for n in within or [main]}
    of_mains = {id(m) for m in mains}
    # (node, in an article, in its prose), then whether anything below is kept: parents come first, so backwards
    order: list[tuple[Node, Node | None]] = []
    left: list[tuple[Node, Node | None, bool, bool]] = [(root, None, False, False)]
    while left:
        node, parent, inside, prose = left.pop()
        order.append((node, parent))
        inside = inside or id(node) in articles
        prose = prose or inside and node.tag in PROSE
        if prose or id(node) in of_mains:
            own.add(id(node))
        left.extend((c, node, inside, prose) for c in node.children if isinstance(c, Node))
    for node, parent in reversed(order):
        if parent is not None and id(node) in own:
            own.add(id(parent))
    return own


def template_hashes(page: str) -> np.ndarray:
    """Distinct hashes of the subtrees that a site's template may hold.

    These are the block elements without the main element or a heading or paragraph of
    the article in them; a page that marks no article gives all of its blocks.
    """
    return _page_hashes(page)[1]


def _page_hashes(page: str) -> tuple[int, np.ndarray]:
    """The hash of the whole page, and ``template_hashes``."""
    root = parse(page)
    hash_subtrees(root)
    own = _own_nodes(root, _main_nodes(root))
    found = {
        n.hash for n in _order(root)
        if id(n) not in own and n.tag not in INLINE and n.tag not in VOID and n.tag not in ("html", "body")
    }
    return int(np.uint64(root.hash).astype(np.int64)), np.array(sorted(found), np.uint64).view(np.int64)


def _named_boilerplate(names: str, parts: bool) -> bool:
    """Whether a class or id list holds a boilerplate name; with ``parts``, also as a part of a compound."""
    for name in names.split():
        if name in NAMES:
            return True
        words = set(_NAME_WORDS.findall(name))
        if parts and words & NAMES and not words & STATES:
            return True
    return False


def _is_boilerplate(node: Node, in_main: bool) -> bool:
    """Boilerplate by element, role or name. What may hold the article goes by whole names only."""
    if node.tag in DROPPED or node.tag in RAW or node.tag == "header" and not in_main:
        return True
    if not node.attributes or node.tag in ("", "html", "body"):
        return False
    parts = node.tag not in MAIN and not any(n.tag in MAIN for n in _order(node))
    for name, a, b, c in _ATTRIBUTE.findall(node.attributes):
        name, value = name.lower(), (a or b or c).lower()
        if name in ("class", "id") and _named_boilerplate(value, parts):
            return True
        if name == "role" and value.strip() in ROLES:
            return True
        if name == "hidden" or name == "aria-hidden" and value == "true":
            return True
    return False


def main_text(page: str, templates: frozenset[int] | set[int] = frozenset()) -> str:
    """The blocks of the article, one a line.

    Subtrees whose hash is in ``templates`` go, as does boilerplate; the headings and paragraphs of an
    article stay, as does what holds one.
    Without an article or main element the whole page is read. Character references are
    decoded; white space in a block becomes one blank.
    """
    root = parse(page)
    hash_subtrees(root)
    mains = _main_nodes(root)
    own = _own_nodes(root, mains) if templates else set()
    blocks, line = [], []

    def end_block() -> None:
        if text := " ".join(entities.unescape("".join(line)).split()):
            blocks.append(text)
        line.clear()

    # (node, entering): an explicit stack keeps deep pages from overflowing
    left: list = [(m, True) for m in reversed(mains or [root])]
    while left:
        node, entering = left.pop()
        if isinstance(node, str):
            line.append(node)
            continue
        block = node.tag not in INLINE
        if node.tag in CELLS:
            line.append(" ")
        elif block:
            end_block()
        if not entering:
            continue
        if node not in mains and (_is_boilerplate(node, bool(mains)) or node.hash in templates and id(node) not in own):
            continue
        if block:
            left.append((node, False))
        left.extend((c, True) for c in reversed(node.children))
    end_block()
    return "\n".join(blocks)


def host_of(url: str | None) -> str:
    """The host of a URL in lower case, without ``www.`` and port; empty if there is none."""
    try:
        return (urlsplit(url or "").hostname or "").removeprefix("www.")
    except ValueError:
        return ""


def site_templates(
    pages: DataFrame, url: str = "url", html: str = "html", min_pages: int = MIN_PAGES, min_share: float = MIN_SHARE,
) -> DataFrame:
    """``(host, hash, pages)``: subtrees that recur across pages of a host.

    A template is on at least ``min_pages`` pages that differ; on a host of fewer than
    2 * ``min_pages`` such pages, on half of them and LEAST_PAGES. Copies of one page
    are no recurrence, but count in ``pages`` and for ``min_share``, a share of the
    host's rows. Counts are aggregated before they are shuffled, first per page, so a
    host of any size is no more than a row per subtree and task.
    """

    def hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hosts, whole, found, sizes = [], [], [], []
            for u, h in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                page, mine = _page_hashes(h or "")
                hosts.append(host_of(u))
                whole.append(page)
                # 0 stands for the page itself and counts the pages of the host
                found.append(np.append(mine, 0))
                sizes.append(len(found[-1]))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.repeat(np.array(hosts, object), sizes), pa.string()),
                    pa.array(np.concatenate(found)), pa.array(np.repeat(np.array(whole, np.int64), sizes)),
                ],
                names=["host", "hash", "page"],
            )

    counts = (
        pages.select(url, html).mapInArrow(hashes, schema="host string, hash bigint, page bigint").groupBy("host", "hash")
        .agg(F.count("*").alias("pages"), F.countDistinct("page").alias("differ"))
        .where(f"differ >= {min(min_pages, LEAST_PAGES)} OR hash = 0")
    )
    counts = written(counts, "html-counts")
    totals = counts.where("hash = 0").select("host", F.col("pages").alias("total"), F.col("differ").alias("distinct"))
    enough = F.least(F.lit(min_pages), F.greatest(F.lit(LEAST_PAGES), F.ceil(F.col("distinct") / 2)))
    return counts.where("hash != 0").join(totals, "host").where(
        (F.col("differ") >= enough) & (F.col("pages") >= min_share * F.col("total"))
    ).select("host", "hash", "pages")


def extract_main_text(
    pages: DataFrame, url: str = "url", html: str = "html", out: str = "text", min_pages: int = MIN_PAGES,
    min_share: float = MIN_SHARE, broadcast_limit: int = BROADCAST,
) -> DataFrame:
    """All rows with their main text as ``out``.

    The templates are counted over all pages first. Up to ``broadcast_limit`` of them
    travel to every task; more are joined to the pages' own hashes, gathered per
    (every column but the page itself). Both ways give the same text.

    A NULL or empty page has an empty text; rows with a NULL or hostless URL are one
    site; repeated rows are extracted each; an empty table gives no row. A column named
    like ``out`` is replaced.
    """
    spark = pages.sparkSession
    templates = written(site_templates(pages, url, html, min_pages, min_share).select("host", "hash"), "html-templates")
    if templates.count() <= broadcast_limit:
        known: dict[str, set] = {}
        for row in templates.collect():
            known.setdefault(row["host"], set()).add(row["hash"] % (1 << 64))
        shared = spark.sparkContext.broadcast(known)

        def make():
            def work(batch: pa.RecordBatch) -> list:
                nothing: set = set()
                rows = zip(batch.column("__in_0").to_pylist(), batch.column("__in_1").to_pylist())
                return [[main_text(h or "", shared.value.get(host_of(u), nothing)) for u, h in rows]]

            return work

        return with_columns(pages, [url, html], f"{out} string", make)

    def own_hashes():
        def work(batch: pa.RecordBatch) -> list:
            urls, htmls = batch.column("__in_0").to_pylist(), batch.column("__in_1").to_pylist()
            return [[host_of(u) for u in urls], [template_hashes(h or "").tolist() for h in htmls]]

        return work

    # templates of each URL; a site's hashes may serve all its pages, so equal URLs may share them
    hashed = with_columns(pages.select(F.col(url).alias("__url"), F.col(html).alias("__html")), ["__url", "__html"],
                          "host string, hashes array<bigint>", own_hashes)
    mine = hashed.select("__url", "host", F.explode("hashes").alias("hash")).distinct()
    found = mine.join(templates, ["host", "hash"], "left_semi").groupBy("__url").agg(F.collect_set("hash").alias("__known"))
    joined = pages.join(found, pages[url].eqNullSafe(F.col("__url")), "left").drop("__url")

    def make_joined():
        def work(batch: pa.RecordBatch) -> list:
            rows = zip(batch.column("__in_0").to_pylist(), batch.column("__in_1").to_pylist())
            return [[main_text(h or "", {x % (1 << 64) for x in k or ()}) for h, k in rows]]

        return work

    return with_columns(joined, [html, "__known"], f"{out} string", make_joined).drop("__known")
