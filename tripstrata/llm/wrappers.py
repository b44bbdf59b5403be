"""Main text of web pages by wrappers learned from all pages of a host.

A page becomes a tree of its block elements; inline elements are part of their block, and
like siblings in a row are one repeated node. The trees of a host's pages are aligned by
simple tree matching and merged: every task merges its own pages first, and only one small
tree per host and task is shuffled, so a host may have any number of pages. Nodes that are
aligned have the same elements above them, so blocks are compared under that path of elements,
whose classes and ids may differ from page to page: a block is
template if the same text stands there on nearly all different pages of the host, which are
counted; copies of a page count once. All other blocks are content.
A page is then aligned with its host's wrapper, and the text of content slots is kept, without
what stands in menus, headers, footers, side bars, notices, adverts, forms, scripts, styles
and comments, which vary from page to page too and are told by element and class.

A class, id or role tells such a part only by a whole word (``sidebar``) or one with agreed
words around it (``user-comments``); ``has-sidebar`` and ``long-form`` tell nothing. Names never
count on html, body, main and article, nor on what holds all main parts of a page, nor on a
node whose varying text is more than half of all that its host's wrapper has. Digits are no part
of a class or id, so numbers of posts and slots do not part what is aligned.

Main parts (``article``, ``main``) are a hint. Where they hold at least half of a page's text that
is neither template nor told above, other text goes, but for its ``h1`` if they have none; where
they hold less, they are teasers beside the story, and all such text is kept.

Blocks of any length, several of one element and those of like siblings are all compared, from
two different pages of a host on. Below ``MIN_PAGES`` different pages, a page that shares more
than half of its text with nearly all others is taken for their near copy and keeps that text,
and main parts keep what they share.

Defined results: a null html is empty; a null url has a host of its own kind, ''. Where all
pages of a host are alike, nothing counts as template by its
text alone. Cut-off markup at the end is dropped. Tables without rows give none. Pages of any
length and depth are read whole. Rows of one id stay apart; columns other than id, url and html
are left out, whatever their names.
"""

from __future__ import annotations

import hashlib
import html as entities
import json
import re
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripstrata.llm.blocks import keep

#: Different pages of a host from which unchanging text counts as template even if it is most of a page.
MIN_PAGES = 10
#: Share of a host's different pages on which a block must stand to be template.
NEARLY_ALL = 0.9
#: Hosts a task merges before it passes on what it has, and how widely partial trees are dealt.
HOSTS_HELD, SPREAD = 20_000, 64

# Elements of HTML by their part in a page.
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd mark q rp rt "
    "ruby s samp small span strike strong sub sup time tt u var wbr".split()
)
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe template xmp noframes".split())
NO_CONTENT = frozenset(
    "head nav header footer aside form script style noscript iframe template textarea title button "
    "select option menu dialog svg canvas object audio video xmp noframes".split()
)
MAIN = frozenset(["article", "main"])
CLOSES = {
    "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"),
    "td": ("td", "th"), "th": ("td", "th"), "option": ("option",),
}
NO_CONTENT_NAMES = frozenset(
    "ad ads advert adverts advertisement sponsor sponsored promo banner cookie cookies consent "
    "notice alert nav navbar navigation menu breadcrumb breadcrumbs header footer sidebar aside "
    "widget related recommended share sharing social comment comments respond newsletter "
    "subscribe signup login search form popup modal overlay pagination copyright".split()
)
#: What may stand before or after such a name, parted by - or _, as digits may.
AFFIXES = frozenset(
    "area bar block bottom box button buttons center col column container content entry global "
    "group holder inner item items left link links list lower main middle mobile modules outer "
    "page panel policy posts primary region right row secondary section site slot sticky "
    "tertiary text top unit upper user users wrap wrapper zone".split()
)
NEVER_NAMED = frozenset("page html body main article".split())

_TAG = re.compile(
    r"<(?:!--.*?(?:-->|\Z)|[!?][^>]*(?:>|\Z)"
    r"|(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<rest>(?:[^>\"']|\"[^\"]*\"|'[^']*')*|[^>]*)(?P<close>>|\Z))",
    re.DOTALL,
)
_NAMES = re.compile(r"""(?:^|\s)(?:class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s>]+)""", re.I)
VARIES = "*"
#: Where content may stand: beside main parts or in them.
BESIDE, MAIN_PART = 1, 2
#: Levels of a tree; elements further inside are put beside one another.
DEPTH = 150


class Node:
    __slots__ = ("name", "label", "path", "children", "blocks", "depth", "home")

    def __init__(self, name: str, label: str, above: Node | None = None) -> None:
        """An element below another; one deeper than ``DEPTH`` stands beside those at that depth.

        There it takes over the label of an element above it that holds no content, so that
        what is inside a menu stays inside it.
        """
        self.name, self.children, self.blocks = name, [], []
        deep = above is not None and above.depth > DEPTH
        if deep and (above.label.split(".")[0] in NO_CONTENT or is_named(above.label)):
            label = above.label
        self.home = above.home if deep else above
        self.depth = self.home.depth + 1 if self.home else 0
        self.label, self.path = label, f"{self.home.path if self.home else ''}/{name}"
        if self.home:
            self.home.children.append(self)


def _label(name: str, rest: str) -> str:
    """An element with its classes, ids and roles without digits, which are the page's own."""
    if "=" not in rest or name in NEVER_NAMED:
        return name
    words = {w for v in _NAMES.findall(rest) for w in v.strip("\"'").lower().split()}
    return ".".join([name, *sorted({re.sub(r"[-_]*\d+", "", w) for w in words} - {""})])


def parse(page: str) -> tuple[Node, list[tuple[Node, str]]]:
    """The tree of block elements, and all text blocks in page order with their elements."""
    root = Node("page", "page")
    stack, blocks, text, at = [root], [], [], 0

    def flush() -> None:
        words = " ".join(entities.unescape("".join(text)).split())
        text.clear()
        if words:
            blocks.append((stack[-1], words))
            stack[-1].blocks.append(words)

    while found := _TAG.search(page, at):
        text.append(page[at : found.start()])
        at = found.end()
        name = found["name"]
        if name is None:
            continue
        if not found["close"]:
            break
        name = name.lower()
        if name in INLINE:
            if name == "br":
                text.append(" ")
            continue
        flush()
        if found["end"]:
            _close(stack, (name,))
            continue
        if name in CLOSES:
            _close(stack, CLOSES[name], within=True)
        _close(stack, ("p",), within=True)
        node = Node(name, _label(name, found["rest"]), stack[-1])
        if name in RAW:
            stop = re.compile(f"</{name}[^>]*(?:>|\\Z)", re.I).search(page, at)
            at = stop.end() if stop else len(page)
        elif name not in VOID and not found["rest"].endswith("/"):
            stack.append(node)
    else:
        text.append(page[at:])
    flush()
    return root, blocks


def _close(stack: list[Node], names: tuple[str, ...], within: bool = False) -> None:
    """Close the innermost of the named elements; ``within`` stops at elements that hold it."""
    for i in range(len(stack) - 1, 0, -1):
        name = stack[i].name
        if name in names:
            del stack[i:]
            return
        if within and name not in ("p", "li", "td", "th", "dt", "dd", "tr"):
            return


def _hash(*parts: str) -> int:
    digest = hashlib.blake2b("\n".join(parts).encode("utf-8", "replace"), digest_size=8).digest()
    return int.from_bytes(digest, "big", signed=True)


def block_keys(blocks: list[tuple[Node, str]]) -> list[int]:
    """For every block a hash of the elements above it and of its text."""
    return [_hash(node.path, words) for node, words in blocks]


# A wrapper's node: [label, text, children, chars]; text is None, the one text seen, or VARIES,
# and chars the length of all texts seen. Texts of one page that share a node are one text.


def _text_of(blocks: list[str]) -> str | None:
    if not blocks:
        return None
    return "=" + blocks[0] if len(blocks) == 1 and len(blocks[0]) <= 200 else _one_text(*blocks)


def _one_text(*texts: str) -> str:
    return f"#{_hash(*texts)}"


def _join_text(a: str | None, b: str | None, page: bool) -> str | None:
    if a is None or b is None:
        return b if a is None else a
    return _one_text(a, b) if page else a if a == b else VARIES


def skeleton(node: Node) -> list:
    """A page's tree with like siblings in a row as one."""
    children: list[list] = []
    for child in node.children:
        made = skeleton(child)
        if children and children[-1][0] == made[0]:
            children[-1] = merge(children[-1], made, page=True)
        else:
            children.append(made)
    return [node.label, _text_of(node.blocks), children, sum(map(len, node.blocks))]


def matching(a: list, b: list) -> tuple[int, list[tuple[int, int]]]:
    """Simple tree matching: size of the largest matching, and the children it pairs."""
    if a[0] != b[0]:
        return 0, []
    one, two = a[2], b[2]
    if [c[0] for c in one] == [c[0] for c in two]:
        pairs = [(i, i) for i in range(len(one))]
        return 1 + sum(matching(x, y)[0] for x, y in zip(one, two)), pairs
    table = [[0] * (len(two) + 1) for _ in range(len(one) + 1)]
    score = [[matching(x, y)[0] for y in two] for x in one]
    for i in range(len(one)):
        for j in range(len(two)):
            table[i + 1][j + 1] = max(table[i][j + 1], table[i + 1][j], table[i][j] + score[i][j])
    pairs, i, j = [], len(one), len(two)
    while i and j:
        if table[i][j] == table[i - 1][j]:
            i -= 1
        elif table[i][j] == table[i][j - 1]:
            j -= 1
        else:
            i, j = i - 1, j - 1
            pairs.append((i, j))
    return 1 + table[-1][-1], pairs[::-1]


def merge(a: list, b: list, page: bool = False) -> list:
    """One wrapper of two with the same root label; unpaired children are optional parts.

    With ``page`` both are parts of one page, whose texts do not vary by being different.
    """
    pairs = matching(a, b)[1]
    children, i, j = [], 0, 0
    for x, y in [*pairs, (len(a[2]), len(b[2]))]:
        children += a[2][i:x] + b[2][j:y]
        if x < len(a[2]) and y < len(b[2]):
            children.append(merge(a[2][x], b[2][y], page))
        i, j = x + 1, y + 1
    return [a[0], _join_text(a[1], b[1], page), children, _chars(a) + _chars(b)]


def _chars(node: list) -> int:
    return node[3] if len(node) > 3 else 0


def varying(node: list, sums: dict[int, int]) -> int:
    """Characters of varying text in a wrapper's subtree, noted for every node in ``sums``."""
    if node[0].split(".")[0] in NO_CONTENT:
        return 0
    own = _chars(node) if node[1] == VARIES else 0
    sums[id(node)] = own + sum(varying(c, sums) for c in node[2])
    return sums[id(node)]


def is_named(label: str) -> bool:
    """Does a class, id or role say that the element is no content?"""
    name, *words = label.split(".")
    if name in NEVER_NAMED:
        return False
    parts = [[p for p in re.split("[-_]+", w) if p and not p.isdigit()] for w in words]
    return any(
        not NO_CONTENT_NAMES.isdisjoint(p) and NO_CONTENT_NAMES.union(AFFIXES).issuperset(p)
        for p in parts
    )


def _mains(node: list, named: bool, skip: set[int], out: list) -> bool:
    """Notes of every main part whether a name stands above it; is there one in the node?"""
    name = node[0].split(".")[0]
    if name in NO_CONTENT:
        return False
    named = named or id(node) not in skip and is_named(node[0])
    if name in MAIN:
        out.append(named)
    below = [_mains(c, named, skip, out) for c in node[2]]
    return name in MAIN or any(below)


@lru_cache(maxsize=4096)
def content_slots(wrapper: str, shape: str) -> tuple[int, ...]:
    """For every node of a page's shape, in document order, whether it may hold content.

    That is ``MAIN_PART`` in main parts, or anywhere if there are none, and ``BESIDE`` elsewhere.
    """
    tree, page = json.loads(wrapper), json.loads(shape)
    sums: dict[int, int] = {}
    total = varying(tree, sums)
    bulk: set[int] = set()

    def weigh(node: list, part: list | None) -> None:
        if part and 2 * sums.get(id(part), 0) > total:
            bulk.add(id(node))
        of = {i: part[2][j] for i, j in matching(node, part)[1]} if part else {}
        for i, child in enumerate(node[2]):
            weigh(child, of.get(i))

    weigh(page, tree if tree[0] == page[0] else None)
    mains: list[bool] = []
    inside_main = not _mains(page, False, bulk, mains)
    # Where all main parts stand below names, these names do not count.
    free = all(mains)
    out: list[int] = []

    def walk(node: list, ok: bool, main: bool) -> None:
        name = node[0].split(".")[0]
        told = id(node) not in bulk and is_named(node[0])
        if told and free:
            told = not _mains(node, False, set(), [])
        ok = ok and name not in NO_CONTENT and not told
        main = main or name in MAIN
        out.append((MAIN_PART if main else BESIDE) if ok else 0)
        for child in node[2]:
            walk(child, ok, main)

    walk(page, True, inside_main)
    return tuple(out)


def main_text(
    page: str, wrapper: str | None, fixed: frozenset[int] = frozenset(), sure: bool = True
) -> str:
    """Blocks in content slots but the ``fixed``; without a wrapper the page is its own.

    Unless ``sure``, fixed blocks stay in main parts and where they are more than half of the text.
    """
    root, blocks = parse(page)
    shape = skeleton(root)
    bare = json.dumps(_bare(shape))
    flags = content_slots(wrapper or bare, bare)
    wanted: dict[int, int] = {}
    spot = 0

    def walk(nodes: list[Node]) -> None:
        """Nodes that one node of the shape stands for."""
        nonlocal spot
        for n in nodes:
            wanted[id(n)] = flags[spot]
        spot += 1
        for group in _groups(nodes):
            walk(group)

    walk([root])
    keys = block_keys(blocks) if fixed else [0] * len(blocks)
    held = []
    for (node, words), key in zip(blocks, keys):
        same = key in fixed and (sure or MAIN.isdisjoint(node.path.split("/")))
        if wanted[id(node)]:
            held.append((node, words, wanted[id(node)], same))
    chars = sum(len(words) for _, words, _, _ in held)
    if sure or 2 * sum(len(words) for _, words, _, same in held if same) <= chars:
        held = [h for h in held if not h[3]]
    inside = [h for h in held if h[2] == MAIN_PART]
    if 2 * sum(len(h[1]) for h in inside) >= sum(len(h[1]) for h in held):
        titled = any(node.name == "h1" for node, *_ in inside)
        held = [h for h in held if h[2] == MAIN_PART or not titled and h[0].name == "h1"]
    return "\n".join(words for _, words, _, _ in held)


def _bare(node: list) -> list:
    return [node[0], None, [_bare(c) for c in node[2]]]


def _groups(nodes: list[Node]) -> list[list[Node]]:
    """Children of merged nodes in the order of their merged tree."""
    merged: list[tuple[list, list[Node]]] = []
    for node in nodes:
        own: list[tuple[list, list[Node]]] = []
        for child in node.children:
            made = skeleton(child)
            if own and own[-1][0][0] == made[0]:
                own[-1] = merge(own[-1][0], made), [*own[-1][1], child]
            else:
                own.append((made, [child]))
        if not merged:
            merged = own
            continue
        left, right = ["", None, [m[0] for m in merged]], ["", None, [m[0] for m in own]]
        pairs, out, i, j = matching(left, right)[1], [], 0, 0
        for x, y in [*pairs, (len(merged), len(own))]:
            out += merged[i:x] + own[j:y]
            if x < len(merged) and y < len(own):
                out.append((merge(merged[x][0], own[y][0]), merged[x][1] + own[y][1]))
            i, j = x + 1, y + 1
        merged = out
    return [group for _, group in merged]


def _host(url_col: str):
    found = F.regexp_extract(F.col(url_col), r"^(?:[A-Za-z][\w+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)", 1)
    return F.coalesce(F.lower(found), F.lit(""))


_PARTIAL = "host string, wrapper string"
_BLOCKS = "page long, block long"
#: Block of every page, to count pages by.
PAGE = 0


def learn_wrappers(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One wrapper per host, merged from all its pages, and its template blocks in ``fixed``.

    ``sure`` tells whether at least ``MIN_PAGES`` different pages were compared.
    """
    rows = pages.select(_host(url_col).alias("host"), F.col(html_col).alias("html"))

    def partial(batches):
        held: dict[str, list] = {}
        for batch in batches:
            hosts, ones, keys = [], [], []
            for host, page in zip(batch["host"].to_pylist(), batch["html"].to_pylist()):
                root, blocks = parse(page or "")
                made = skeleton(root)
                held[host] = merge(held[host], made) if host in held else made
                own = block_keys(blocks)
                distinct = {PAGE, *own}
                hosts += [host] * len(distinct)
                ones += [_hash(*map(str, own))] * len(distinct)
                keys += distinct
                if len(held) >= HOSTS_HELD:
                    yield _partial_rows(list(held), list(map(json.dumps, held.values())))
                    held = {}
            yield _partial_rows(hosts, None, ones, keys)
        yield _partial_rows(list(held), list(map(json.dumps, held.values())))

    def combine(table: pa.Table) -> pa.Table:
        host, total = table["host"][0].as_py(), None
        for part in map(json.loads, table["wrapper"].to_pylist()):
            total = part if total is None else merge(total, part)
        return pa.table({"host": pa.array([host]), "wrapper": pa.array([json.dumps(total)])})

    read = keep(rows.mapInArrow(partial, f"{_PARTIAL}, {_BLOCKS}"), "blocks")
    parts = read.where("wrapper is not null").select(
        "host", "wrapper", F.pmod(F.xxhash64("wrapper"), F.lit(SPREAD)).alias("salt")
    )
    some = parts.groupBy("host", "salt").applyInArrow(
        lambda table: combine(table.drop(["salt"])), _PARTIAL
    )
    trees = some.groupBy("host").applyInArrow(combine, _PARTIAL)
    return trees.join(_template_blocks(read.where("wrapper is null")), "host", "left")


def _template_blocks(read: DataFrame) -> DataFrame:
    """Of every host with two different pages the blocks that stand on nearly all of them."""
    counts = read.select("host", "block", "page").distinct().groupBy("host", "block")
    # Pages of which all are different; blocks of a single one are never template.
    counts = counts.agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    hosts = counts.where(F.col("block") == PAGE).select("host", F.col("n").alias("n_pages"))
    found = counts.where(F.col("block") != PAGE).join(hosts, "host")
    found = found.where(F.col("n") >= NEARLY_ALL * F.col("n_pages"))
    sure = (F.max("n_pages") >= MIN_PAGES).alias("sure")
    return found.groupBy("host").agg(F.collect_list("block").alias("fixed"), sure)


def _partial_rows(hosts: list, trees: list | None, pages=None, blocks=None) -> pa.RecordBatch:
    none = [None] * len(hosts)
    return pa.RecordBatch.from_arrays(
        [
            pa.array(hosts, pa.string()),
            pa.array(none if trees is None else trees, pa.string()),
            pa.array(none if pages is None else pages, pa.int64()),
            pa.array(none if blocks is None else blocks, pa.int64()),
        ],
        ["host", "wrapper", "page", "block"],
    )


def extract_main_text(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``page_id``, ``url``, ``text`` and ``n_chars`` (code points) of every page."""
    wrappers = keep(learn_wrappers(pages, url_col, html_col), "wrappers")
    rows = pages.select(
        F.col("page_id"),
        F.col(url_col).cast("string").alias("url"),
        F.col(html_col).alias("html"),
        _host(url_col).alias("host"),
    ).join(wrappers, "host", "left")

    def extract(batches):
        for batch in batches:
            columns = (batch[c].to_pylist() for c in ("html", "wrapper", "fixed", "sure"))
            texts = [main_text(h or "", w, frozenset(f or ()), bool(s)) for h, w, f, s in zip(*columns)]
            yield pa.RecordBatch.from_arrays(
                [batch["page_id"], batch["url"], pa.array(texts, pa.string())],
                ["page_id", "url", "text"],
            )

    kind = pages.schema["page_id"].dataType.simpleString()
    done = rows.select("page_id", "url", "html", "wrapper", "fixed", "sure").mapInArrow(
        extract, f"page_id {kind}, url string, text string"
    )
    return done.withColumn("n_chars", F.length("text").cast("long"))
